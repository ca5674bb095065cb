"""Mix sources to target weights (native expressions only).

Every document gets a hash-random key. Documents of a source are range-cut by
key into buckets, sorted inside them, and a two-level prefix sum (bucket totals,
then rows inside a bucket) gives the words before each document. A source's
budget buys whole epochs first; the rest is cut at the exact word.

Defined cases: a null text has size 0 and takes 0; a null source is a source
like any other and comes last; sources without words have target 0; rows equal
in id and size are interchangeable; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.llm.common import WORD, join_null_safe, table

WEIGHTS = (1, 2, 3)  # fixed by the query contract, repeating over the sources in order
CAP = 3  # no source is taken more often than this
MIN_BUCKET = 4096  # documents per key range, at least


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size, weight, target`` from ``source, size``.

    The total of all sizes is shared by weight; a source above ``cap`` times
    its size is held there and the excess reshared. In the order of
    ``cap * size / weight`` the held sources come first, so one sorted pass over
    the (pre-aggregated) sources finds the level instead of repeated rounds.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int")))
    s = s.withColumns({"_top": cap * F.col("source_size"), "_all": F.sum("source_size").over(W.partitionBy())})
    by = [F.col("_top") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = F.coalesce(F.sum("_top").over(W.orderBy(*by).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(W.orderBy(*by).rowsBetween(0, W.unboundedFollowing))
    s = s.withColumns({"_pos": F.row_number().over(W.orderBy(*by)), "_level": (F.col("_all") - before) / rest})
    fits = F.when(F.col("_level") * F.col("weight") <= F.col("_top"), F.struct("_pos", "_level"))
    s = s.withColumn("_first", F.min(fits).over(W.partitionBy()))
    held = F.col("_first").isNull() | (F.col("_pos") < F.col("_first._pos"))
    return s.select(
        "source",
        "source_size",
        "weight",
        F.when(held, F.col("_top").cast("double")).otherwise(F.col("_first._level") * F.col("weight")).alias("target"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = CAP,
    min_bucket: int = MIN_BUCKET,
) -> DataFrame:
    """``doc_id, source, size, source_size, weight, target, taken`` per input row."""
    n = docs.count()
    # About sqrt(n) documents per key range, so neither level of the prefix sum grows with n.
    digits = math.ceil(math.log(max(n, 1) / max(min_bucket, math.isqrt(n)), 16)) if n > min_bucket else 0
    d = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("key"),
    ).withColumn("bucket", F.substring("key", 1, digits) if digits else F.lit(""))
    totals = d.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
    offsets = totals.select(
        "source",
        "bucket",
        F.coalesce(F.sum("size").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
    )
    targets = source_targets(totals, weights, cap)
    plan = join_null_safe(offsets, targets, ["source"])
    inside = W.partitionBy("source", "bucket").orderBy("key", "size").rowsBetween(W.unboundedPreceding, -1)
    d = d.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = join_null_safe(d, plan, ["source", "bucket"])
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    d = d.withColumns({"_epochs": epochs, "_left": budget - epochs * F.col("source_size") - (F.col("offset") + F.col("before"))})
    taken = F.col("_epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("_left")))
    return d.select("doc_id", "source", "size", "source_size", "weight", "target", taken.cast("bigint").alias("taken"))


def op7_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def mixing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document as often as the mix takes it.

    Documents stay whole: a document cut by its source's budget comes once more
    if at least half of it is taken. A document whose rows repeat shares the
    words taken by its rows evenly.
    """
    m = mix(docs).groupBy("doc_id", "source").agg(F.sum("taken").alias("t"), F.sum("size").alias("s"))
    n = F.when(F.col("s") > 0, F.floor(F.col("t") / F.col("s") + 0.5)).otherwise(F.lit(0)).cast("int")
    out = join_null_safe(docs, m.select("doc_id", "source", n.alias("_n")).filter("_n > 0"), ["doc_id", "source"])
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_n"))).select(*docs.columns)


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, 3 * source_size AS top_, sum(source_size) OVER () AS all_,
         1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS weight
  FROM s
), l AS (
  SELECT *, row_number() OVER o AS pos,
         (all_ - coalesce(sum(top_) OVER (ORDER BY top_::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER (ORDER BY top_::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM r WINDOW o AS (ORDER BY top_::DOUBLE / weight, source ASC NULLS LAST)
), f AS (
  SELECT min(pos) AS pos, arg_min(level, pos) AS level FROM l WHERE level * weight <= top_
), t AS (
  SELECT source, source_size, CASE WHEN f.pos IS NULL OR l.pos < f.pos THEN top_::DOUBLE ELSE f.level * weight END AS target FROM l, f
), b AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM b
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
FROM e
"""
