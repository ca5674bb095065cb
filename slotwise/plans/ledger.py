"""Resuming a run: stage outputs in shared storage, found again by a ledger.

A run's stages are kept under a fingerprint of what decides them: the parameters,
the rows of its configuration and the files of its large inputs. A stage that the
ledger holds is read instead of computed, so a run that was killed goes on after
its last whole stage; any change of input or parameter is another fingerprint.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = "fingerprint string, stage string, path string, row_count bigint"


def rows_digest(frames: dict[str, DataFrame]) -> list[tuple]:
    """Per frame its row count and an order-free checksum of its rows, in one query."""
    parts = None
    for name, df in sorted(frames.items()):
        h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
        one = df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.sum(h).cast("string").alias("h"), F.lit(df.schema.simpleString()).alias("s"))
        parts = one if parts is None else parts.unionByName(one)
    return sorted(map(tuple, parts.collect())) if parts is not None else []


def fingerprint(params, small: dict[str, DataFrame], large: dict[str, DataFrame | None]) -> str:
    """Digest of the parameters, the rows of ``small`` frames and the files of ``large`` ones.

    A large frame that comes from no files (a database) is known by its schema
    alone: give such a run's source a version among the parameters.
    """
    files = [(name, None if df is None else (df.schema.simpleString(), sorted(df.inputFiles()))) for name, df in sorted(large.items())]
    return hashlib.sha256(repr((params, rows_digest(small), files)).encode()).hexdigest()[:32]


class StageLedger:
    """Finished stages of one fingerprint under a shared folder."""

    def __init__(self, spark: SparkSession, root: str, fingerprint: str):
        self.spark, self.root, self.fingerprint = spark, root.rstrip("/"), fingerprint
        self.rows: dict[str, int] = {}
        self.resumed: list[str] = []

    def finished(self) -> DataFrame:
        try:
            all_ = self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.root}/ledger")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            all_ = self.spark.createDataFrame([], LEDGER_SCHEMA)
        return all_.filter(F.col("fingerprint") == self.fingerprint)

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stage's rows: as kept, or built, written and entered."""
        kept = self.finished().filter(F.col("stage") == name).orderBy("path").first()
        if kept is not None:
            self.rows[name] = kept.row_count
            self.resumed.append(name)
            return self.spark.read.parquet(kept.path)
        df = build()
        path = f"{self.root}/stages/{self.fingerprint}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.rows[name] = out.count()  # from the files' footers
        entry = self.spark.createDataFrame([(self.fingerprint, name, path, self.rows[name])], LEDGER_SCHEMA)
        entry.coalesce(1).write.mode("append").parquet(f"{self.root}/ledger")
        return out
