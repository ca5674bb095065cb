"""Run control — A5–A8, B2, D-9, I10.

The reference resolves its inputs through run-log tables (newest successful
output of a producer) and appends one log row per step. Those lookups are
top-1 queries over control tables; the log rows are a handful of values
written in one small append.
"""

from __future__ import annotations

import datetime as _dt
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from slotwise.config import Scope

# Fixed values (must equal the reference's): columns of the step log.
LOG_SCHEMA = StructType(
    [
        StructField("SourceName", StringType(), True),
        StructField("SourceID", IntegerType(), True),
        StructField("IsComplete", IntegerType(), True),
        StructField("Status", StringType(), True),
        StructField("StartDate", TimestampType(), True),
        StructField("EndDate", TimestampType(), True),
        StructField("ErrorMessage", StringType(), True),
        StructField("RowCounts", LongType(), True),
        StructField("FilePath", StringType(), True),
    ]
)
# The central log has one row per state of a run (its path once it is complete).
CENTRAL_SCHEMA = StructType(
    [
        StructField("LogID", LongType(), True),
        StructField("SourceID", IntegerType(), True),
        StructField("SourceName", StringType(), True),
        StructField("IsComplete", IntegerType(), True),
        StructField("StartDate", TimestampType(), True),
        StructField("EndDate", TimestampType(), True),
        StructField("FilePath", StringType(), True),
    ]
)
# Fixed value (must equal the reference's): log times are written in Pacific time.
LOG_TIMEZONE = "America/Los_Angeles"


def clean_column_names(df: DataFrame) -> DataFrame:
    """Strip stray spaces from column names (the schedule table has some)."""
    return df.withColumnsRenamed({c: c.strip() for c in df.columns if c != c.strip()})


def latest_schedule(schedules: DataFrame, locale: str) -> DataFrame:
    """A5 + B6: the final schedule of the locale with a non-blank job, newest first.

    ``NOT LIKE ' '`` also drops null job names. ``limit(1)`` after the sort
    plans as a top-1 (TakeOrderedAndProject), not a full sort. Ties on the
    time are broken by ``ID`` descending.
    """
    return (
        clean_column_names(schedules)
        .filter(F.col("Locale") == F.lit(locale))
        .filter(F.col("IsFinal") == 1)
        .filter(~F.col("Job_Name").like(" "))
        .orderBy(F.col("ScheduleTimes").desc(), F.col("ID").desc())
        .limit(1)
    )


def latest_run(log: DataFrame, source_id: int, source_name: str, order_col: str = "StartDate", as_of=None) -> DataFrame:
    """Newest complete run of a source (ties: highest ``LogID``); with ``as_of``
    of those that had ended by then."""
    if as_of is not None:
        log = log.filter(F.col("EndDate") <= F.lit(as_of))
    return (
        log.filter((F.col("SourceID") == F.lit(source_id)) & (F.col("IsComplete") == 1) & (F.col("SourceName") == F.lit(source_name)))
        .orderBy(F.col(order_col).desc(), F.col("LogID").desc())
        .limit(1)
        .select("LogID", "FilePath")
    )


def latest_run_all(log: DataFrame, order_col: str = "StartDate") -> DataFrame:
    """A6, batch form: newest complete run of every (source id, source name).

    ``max_by`` over a (time, LogID) struct is a single hash aggregate with
    partial aggregation — one row per group leaves each map task.
    """
    return (
        log.filter(F.col("IsComplete") == 1)
        .groupBy("SourceID", "SourceName")
        .agg(F.max_by(F.struct("LogID", "FilePath"), F.struct(order_col, "LogID")).alias("r"))
        .select("SourceID", "SourceName", "r.LogID", "r.FilePath")
    )


def runs_as_of(log: DataFrame, dates: DataFrame, order_col: str = "EndDate") -> DataFrame:
    """A6 for many dates at once: ``as_of, SourceID, SourceName, LogID, FilePath``, the
    newest run of every source that was complete by each date (column ``as_of``).

    The dates are few and sorted into one array; a run belongs to the first date
    it is not after, so the log is aggregated to one row per source and date
    (map-side first) whatever its length. What is newest up to a date is then
    the running maximum over those rows. Ties: highest ``LogID``. A source
    without a complete run by a date has no row for it.
    """
    days = dates.select(F.col("as_of").cast("timestamp").alias("as_of")).filter("as_of is not null").agg(F.array_sort(F.collect_set("as_of")).alias("days"))
    ended = F.col("EndDate").cast("timestamp")
    first = F.array_min(F.filter("days", lambda d: d >= ended))
    seen = log.filter((F.col("IsComplete") == 1) & F.col("EndDate").isNotNull()).join(F.broadcast(days)).withColumn("as_of", first).filter("as_of is not null")
    run = F.struct(F.col(order_col).alias("at"), "LogID", "FilePath")
    best = seen.groupBy("SourceID", "SourceName", "as_of").agg(F.max(run).alias("run"))
    # one row per source and date, null where the source has no run since the date before
    every = best.select("SourceID", "SourceName").distinct().join(F.broadcast(days)).select("SourceID", "SourceName", F.explode("days").alias("as_of"))
    filled = every.join(best, ["SourceID", "SourceName", "as_of"], "left")
    so_far = Window.partitionBy("SourceID", "SourceName").orderBy("as_of").rowsBetween(Window.unboundedPreceding, 0)
    newest = filled.withColumn("run", F.max("run").over(so_far)).filter("run is not null")
    return newest.select("as_of", "SourceID", "SourceName", "run.LogID", "run.FilePath")


def scheduled_runs_as_of(schedules: DataFrame, log: DataFrame, dates: DataFrame, source_name: str, order_col: str = "StartDate") -> DataFrame:
    """A5 + A6 for a list of dates: each locale's scheduled producer and what it had complete by then.

    ``Locale, ID, as_of, LogID, FilePath``: a re-run of an old day reads what
    that day could read, not what is newest now.
    """
    final = clean_column_names(schedules).filter((F.col("IsFinal") == 1) & ~F.col("Job_Name").like(" "))
    newest = final.groupBy("Locale").agg(F.max(F.struct("ScheduleTimes", "ID")).alias("s")).select("Locale", "s.ID")
    runs = runs_as_of(log.filter(F.col("SourceName") == F.lit(source_name)), dates, order_col)
    return newest.join(runs, F.col("ID") == F.col("SourceID")).select("Locale", "ID", "as_of", "LogID", "FilePath")


def process_identity(process_config: DataFrame, locale: str, brand: str) -> DataFrame:
    """A7 + H19: process row of the locale (``xx_YY`` form) and brand (lowest id)."""
    lang, _, country = locale.partition("_")
    display = f"{lang}_{country.upper()}"
    return (
        process_config.filter((F.col("Locale") == F.lit(display)) & F.col("brand").like(brand))
        .orderBy("id")
        .limit(1)
        .select("id", "ProcessName")
    )


def derive_scope(profiles: DataFrame) -> DataFrame:
    """B2: the distinct non-null (locale, tpid, eapid) triples of the profiles.

    The reference takes an arbitrary first row; a run must have exactly one
    triple, which ``scope_of`` enforces.
    """
    return (
        profiles.select(F.lower("locale").alias("locale"), "tpid", "eapid")
        .filter(F.col("locale").isNotNull() & F.col("tpid").isNotNull() & F.col("eapid").isNotNull())
        .distinct()
    )


def scope_of(profiles: DataFrame) -> Scope:
    rows = derive_scope(profiles).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"profiles must hold exactly one (locale, tpid, eapid); found {len(rows)}+")
    r = rows[0]
    return Scope(r.locale, int(r.tpid), int(r.eapid))


def in_log_time(df: DataFrame) -> DataFrame:
    """UTC times shifted to the log's time zone."""
    return df.withColumns({c: F.from_utc_timestamp(c, LOG_TIMEZONE) for c in ("StartDate", "EndDate")})


@dataclass
class RunLog:
    """A8 + I10: step rows of one run; written in one append.

    ``clock`` returns UTC ``datetime`` values (injectable for tests); times are
    shifted to Pacific time when the rows are materialised.
    """

    source_name: str
    source_id: int
    clock: callable = field(default=lambda: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
    rows: list = field(default_factory=list)

    def append(self, is_complete: int, status: str, start, end=None, error: str = " ", row_count: int = 0, path: str = " "):
        self.rows.append(
            (self.source_name, self.source_id, is_complete, status, start, end or self.clock(), error, int(row_count), path)
        )

    @contextmanager
    def step(self, name: str, path: str = " "):
        """Log a step with start/end time and row count; on failure log it and re-raise."""
        start = self.clock()
        box = {"rows": 0}
        try:
            yield box
        except Exception as e:  # noqa: BLE001 - logged and re-raised
            self.append(0, name, start, error=f"{type(e).__name__}: {e}", path=path)
            raise
        self.append(1, name, start, row_count=box["rows"], path=path)

    def frame(self, spark: SparkSession) -> DataFrame:
        return in_log_time(spark.createDataFrame(self.rows, LOG_SCHEMA))

    def central_frame(self, spark: SparkSession, log_id: int, is_complete: int, start, path: str = " ") -> DataFrame:
        """The run's row of the central log, as ``latest_run`` reads it."""
        row = (log_id, self.source_id, self.source_name, is_complete, start, self.clock(), path)
        return in_log_time(spark.createDataFrame([row], CENTRAL_SCHEMA))

    def write(self, spark: SparkSession, writer) -> None:
        """Append the rows through ``writer(df)``."""
        if self.rows:
            writer(self.frame(spark))

    def append_parquet(self, spark: SparkSession, path: str) -> None:
        """Append the step rows to a parquet log table (one small file)."""
        self.write(spark, lambda df: df.coalesce(1).write.mode("append").parquet(path))

    def append_jdbc(self, spark: SparkSession, url: str, table: str, options: dict) -> None:
        """Append the step rows to a database log table."""
        self.write(spark, lambda df: df.write.mode("append").jdbc(url=url, table=table, properties=options))
