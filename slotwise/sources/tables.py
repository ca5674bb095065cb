"""Reading and writing tables — A1–A4, A9–A12.

A source maps a table *name* to a DataFrame. Production reads a database
over JDBC (connection options come from the caller, never from code); tests
and the bench read parquet files or already-built frames.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.operators import audience

# Fixed values (must equal the reference's): the configuration tables.
CONFIG_TABLES = (
    "campaign_definition", "template_definition", "segment_module",
    "module_variable_definition", "segment_definition", "module_definition",
)


class TableSource:
    def read(self, spark: SparkSession, name: str) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError


@dataclass
class JdbcSource(TableSource):
    """Tables of one database. ``options`` carry url/driver/user/password;
    ``partitioning`` maps a table to (column, lower, upper, numPartitions) so a
    large table is read by parallel range queries instead of one connection;
    ``predicates`` maps a table to the ranges of ``plan_ranges``, which hold
    about equally many rows however the column is distributed."""

    url: str
    options: dict = field(default_factory=dict)
    prefix: str = ""
    partitioning: dict = field(default_factory=dict)
    predicates: dict = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        if name in self.predicates:
            return spark.read.jdbc(self.url, self.prefix + name, predicates=self.predicates[name], properties=self.options)
        r = spark.read.format("jdbc").option("url", self.url).option("dbtable", self.prefix + name).options(**self.options)
        if name in self.partitioning:
            col, lo, hi, n = self.partitioning[name]
            r = r.option("partitionColumn", col).option("lowerBound", lo).option("upperBound", hi).option("numPartitions", n)
        return r.load()


@dataclass
class ParquetSource(TableSource):
    root: str

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.root.rstrip('/')}/{name}.parquet")


@dataclass
class FrameSource(TableSource):
    """Already-built DataFrames by name (fixtures, tests)."""

    frames: dict

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return self.frames[name]


def read_table(spark: SparkSession, name: str, source: TableSource) -> DataFrame:
    """A1: a table by name from a source."""
    return source.read(spark, name)


def _literal(value) -> str:
    return str(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else "'" + str(value).replace("'", "''") + "'"


def plan_ranges(df: DataFrame, column: str, n: int, accuracy: int = 10_000) -> list[str]:
    """A1: predicates that cut a table into at most ``n`` ranges of about equal size.

    The boundaries are quantiles of the column, from a mergeable sketch over one
    pass of that column, so skewed or sparse keys do not fill one range. The
    predicates are disjoint and cover every row, null keys included; a value
    with more rows than a range should hold gets one by itself.
    """
    c = F.col(f"`{column}`")
    if df.schema[column].dataType.typeName() in ("date", "timestamp", "timestamp_ntz", "string"):
        raise ValueError(f"ranges are planned over numbers, {column} is {df.schema[column].dataType.simpleString()}")
    cuts = df.agg(F.percentile_approx(c, [i / n for i in range(1, n)], accuracy).alias("q")).first()["q"] if n > 1 else None
    cuts = sorted(set(cuts or []))
    if not cuts:
        return ["1 = 1"]
    at = [_literal(x) for x in cuts]
    first = f"{column} <= {at[0]} OR {column} IS NULL"
    return [first, *[f"{column} > {a} AND {column} <= {b}" for a, b in zip(at, at[1:])], f"{column} > {at[-1]}"]


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """A table written once in buckets of its key and sorted within them: a join on
    that key shuffles only its other side, run after run (C16, C19)."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def load_config(spark: SparkSession, source: TableSource, environment: str | None = None) -> dict[str, DataFrame]:
    """A2: the six configuration tables ``{table}_{environment}``, ``id`` dropped."""
    out = {}
    for t in CONFIG_TABLES:
        name = f"{t}_{environment}" if environment else t
        df = read_table(spark, name, source)
        out[t] = df.drop("id")
    return out


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """A3: active recipient profiles at a run-time path (filter pushed to parquet)."""
    return audience.read_profiles(spark.read.parquet(path))


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """A4: recipient–segment map at a run-time path."""
    return spark.read.parquet(path)


def load_lookups(spark: SparkSession, names, source: TableSource) -> dict[str, DataFrame]:
    """Read each lookup table a launch needs (names come from the configuration)."""
    return {n: read_table(spark, n, source) for n in names}


def write_output(df: DataFrame, path: str, max_files: int | None = None, max_records_per_file: int = 5_000_000) -> None:
    """Overwrite parquet.

    By default the final stage keeps its parallelism: file count follows the
    (AQE-sized) partitions and no file exceeds ``max_records_per_file`` rows.
    ``max_files`` reproduces the reference's cap (``coalesce``), which is only
    sensible for small outputs: ``coalesce`` runs the whole last stage — here
    the dedupe window and the loyalty join — in that many tasks.
    """
    out = df.coalesce(max_files) if max_files else df
    out.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).parquet(path)


def manifest_frame(spark: SparkSession, output_path: str) -> DataFrame:
    """A10: the one-row manifest ``path = <output>/*``."""
    return spark.createDataFrame([(output_path.rstrip("/") + "/*",)], "path string")


def write_manifest(spark: SparkSession, output_path: str, dest: str) -> None:
    manifest_frame(spark, output_path).coalesce(1).write.mode("overwrite").parquet(dest)


def write_snapshot(df: DataFrame, path: str) -> None:
    """Expanded campaign metadata snapshot for later analysis."""
    df.write.mode("overwrite").parquet(path)
