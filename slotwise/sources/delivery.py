"""Delivering a result so that readers always find a whole one — A9–A11.

A run writes into a folder of its own, reads the row count back from the files
and compares it with the rows that were written, and only then appends its row
to the manifest. The manifest names the newest whole delivery; nothing that it
names is ever overwritten, so a run that fails anywhere leaves the delivery
before it as it was. Running again under the same id replaces the failed
attempt; an id that has been published is refused.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from slotwise.sources import tables

MANIFEST_SCHEMA = "path string, run_id string, row_count bigint, published timestamp"


class DeliveryError(RuntimeError):
    """A delivery that is not whole, or would replace a published one."""


@dataclass(frozen=True)
class Delivery:
    run_id: str
    path: str
    rows: int


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """All published deliveries under ``root``, none yet being no error."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root.rstrip('/')}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def current(spark: SparkSession, root: str) -> Delivery | None:
    """The newest published delivery (A10: its path is ``<folder>/*``)."""
    row = manifest(spark, root).orderBy(F.col("published").desc(), F.col("run_id").desc()).first()
    return Delivery(row.run_id, row.path, row.row_count) if row else None


def read_current(spark: SparkSession, root: str) -> DataFrame:
    found = current(spark, root)
    if found is None:
        raise DeliveryError(f"nothing is published under {root}")
    return spark.read.parquet(found.path.removesuffix("/*"))


def write_delivery(df: DataFrame, root: str, run_id: str, max_files: int | None = None) -> Delivery:
    """The run's rows in its own folder, counted as they are written and again in the files."""
    spark = df.sparkSession
    if not manifest(spark, root).filter(F.col("run_id") == run_id).isEmpty():
        raise DeliveryError(f"run {run_id} is published under {root}")
    path, obs = f"{root.rstrip('/')}/runs/{run_id}", Observation()
    tables.write_output(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, max_files)
    # Tasks run again after a loss may be observed twice; the files are the truth, and may not hold fewer or none.
    written, found = obs.get["rows"], spark.read.parquet(path).count()
    if found > written or (written and not found):
        raise DeliveryError(f"run {run_id}: {written} rows written, {found} found in {path}")
    return Delivery(run_id, path, found)


def write_run_snapshot(df: DataFrame, root: str, run_id: str) -> None:
    """A11 beside the delivery it belongs to."""
    tables.write_snapshot(df, f"{root.rstrip('/')}/snapshots/{run_id}")


def publish(spark: SparkSession, root: str, done: Delivery, now: _dt.datetime | None = None) -> Delivery:
    """A10, last of all: the manifest's row. One small file appears with the commit of its write."""
    at = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = (f"{done.path}/*", done.run_id, done.rows, at)
    spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/manifest")
    return done
