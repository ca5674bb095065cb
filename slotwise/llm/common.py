"""Helpers shared by the text operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.session import ensure_checkpoint_dir

# Fixed by the query contracts: a word is a run of anything but these blanks.
BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where this machine keeps a public tokenizer's file; an absolute path is taken as it is.

    Called inside the tasks, as executors may keep the file elsewhere.
    """
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def words(text: Column) -> Column:
    """Array of the words of a text; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), rf"[{BLANKS}]+"), "")


def text_key(text: Column) -> Column:
    """Two independent 64-bit hashes as one value: equal only for equal texts
    (the chance of one collision among 10^11 texts is below 10^-16)."""
    return F.struct(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a Parquet table in ``spark.checkpoint.dir``, whose columns are read as needed.

    Like a checkpoint it stays until the folder's owner clears it.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package sent to the executors (once a session)."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _SHIPPED:
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        path = os.path.join(tempfile.mkdtemp(prefix="slotwise-"), "slotwise.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, files in os.walk(os.path.join(top, "slotwise")):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(folder, f)
                        z.write(full, os.path.relpath(full, top))
        sc.addPyFile(path)  # Spark's own file server sends it; executors never read the driver's folder
        _SHIPPED.add(sc.applicationId)
    return df.mapInArrow(run, schema)


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on keys that may be null; the right side's keys are dropped."""
    names = {k: f"_right_{k}" for k in keys}
    r = right.withColumnsRenamed(names)
    on = None
    for k, rk in names.items():
        c = F.col(k).eqNullSafe(F.col(rk))
        on = c if on is None else on & c
    out = left.join(r, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*names.values())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge list.

    Returns ``(node, component)`` for every node on an edge; ``component`` is
    the smallest node id reachable. Alternating large-star and small-star
    steps: each replaces edges by edges to the smallest neighbour, so a
    long chain shrinks by a constant factor per round and the edge count never
    grows. Minima are combined map-side before each shuffle, so a node with
    very many edges costs no single task. Null ids and self-edges are ignored;
    an empty edge list gives an empty result.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = checkpointed(e.filter("u is not null and v is not null and u <> v").distinct())
    state = _fingerprint(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = checkpointed(small.unionByName(low.withColumnRenamed("m", "v")).distinct())
        new = _fingerprint(e)
        if new == state:
            break
        state = new
    roots = e.select("v").distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component"))
    )


def _fingerprint(e: DataFrame) -> tuple:
    """Row count and order-free checksum of an edge list (one row to the driver)."""
    h = F.xxhash64("u", "v").cast(T.DecimalType(38, 0))
    r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(h).alias("h")).first()
    return r["n"], r["h"]
