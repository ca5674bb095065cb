"""Joins whose left side has a few very frequent keys.

Which keys are frequent is found by counting them: every task adds up its own
rows, the counts are shuffled by key, and only keys above the share (a bounded
number) reach the driver. Rows of a frequent key get a salt, and the right side's
rows of that key are repeated once per salt, so they spread over the partitions;
all other rows keep salt 0 and join as before. One exchange a side, as in a
plain join, and no reliance on the run-time splitting of skewed partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with this share of the rows would keep a partition busy beyond the others.
HEAVY_SHARE = 0.01
MAX_HEAVY = 100  # no more keys can have that share; what is collected is bounded by it


def key_name(df: DataFrame, keys: list[str], null_safe: bool = False) -> Column:
    """A row's keys as one text. A null key makes it null (it joins with nothing),
    or with ``null_safe`` is a value of its own."""
    text = [F.col(k).cast("string") for k in keys]
    if null_safe:
        return F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), t), F.lit("")) for t in text])
    return F.when(reduce(lambda a, b: a & b, [t.isNotNull() for t in text]), F.concat_ws("\x1f", *text))


def counted_keys(df: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """``item, count``: the rows of every key."""
    return df.select(key_name(df, keys, null_safe).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("count"))


def top_keys(counted: DataFrame, rows: int, share: float = HEAVY_SHARE) -> list:
    """The most frequent items of ``counted_keys`` that may have ``share`` of so many rows."""
    found = counted.filter(F.col("item").isNotNull() & (F.col("count") >= F.lit(share * rows)))
    return found.orderBy(F.desc("count"), "item").limit(min(MAX_HEAVY, int(1 / share))).collect()


def heavy_of(top, rows: int, share: float = HEAVY_SHARE) -> list[str]:
    """The names of ``top_keys`` with at least ``share`` of the rows."""
    return [x["item"] for x in top or [] if x["item"] is not None and x["count"] >= share * rows]


def heavy_keys(df: DataFrame, keys: list[str], share: float = HEAVY_SHARE, null_safe: bool = False) -> list[str]:
    """The keys of at least ``share`` of the rows, as text; at most ``MAX_HEAVY``. One pass over the rows."""
    counted = counted_keys(df, keys, null_safe).persist()
    try:
        rows = counted.agg(F.sum("count")).first()[0] or 0
        return heavy_of(top_keys(counted, rows, share), rows, share)
    finally:
        counted.unpersist()


def salts_for(df: DataFrame) -> int:
    """Four salts a shuffle partition: hashed, they fill the partitions evenly enough."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def busy_partitions(df: DataFrame) -> int:
    """Two partitions for each shuffle partition of the session: for rows that are few bytes and much work.
    Spark may join them in the session's own number, but does not coalesce them."""
    return 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, heavy: list[str], salts: int, null_safe: bool = False, partitions: int | None = None) -> DataFrame:
    """``left.join(right, keys, how)`` (inner or left) with the rows of ``heavy`` keys spread over ``salts``.

    A left row's salt is a hash of the row, so a repeated computation deals the
    same; equal rows get equal salts. ``null_safe``: null keys match each other.
    ``partitions``: into so many the rows go, however few bytes they are (for joins
    whose rows cost much work afterwards).
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a salted join is inner or left, not {how}")
    if not heavy and not null_safe:
        return (left.repartition(partitions, *keys) if partitions else left).join(right, keys, how)
    a, b, on = left, right.withColumnsRenamed({k: f"_right_{k}" for k in keys}), []
    if heavy:
        simple = [F.col(f"`{f.name}`") for f in left.schema if "map<" not in f.dataType.simpleString()]
        own = F.when(key_name(left, keys, null_safe).isin(heavy), F.pmod(F.xxhash64(*simple), F.lit(salts)))
        copies = F.when(key_name(right, keys, null_safe).isin(heavy), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        a = left.withColumn("_salt", F.coalesce(own, F.lit(0)).cast("int"))
        b = right.withColumn("_right_salt", F.explode(copies)).withColumnsRenamed({k: f"_right_{k}" for k in keys})
        on = [F.col("_salt") == F.col("_right_salt")]
    for k in keys:
        on.append(F.col(k).eqNullSafe(F.col(f"_right_{k}")) if null_safe else F.col(k) == F.col(f"_right_{k}"))
    if partitions:
        a = a.repartition(partitions, *(["_salt"] if heavy else []), *keys)
    return a.join(b, on, how).drop("_salt", "_right_salt", *[f"_right_{k}" for k in keys])


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", share: float = HEAVY_SHARE, salts: int | None = None) -> DataFrame:
    """Join with the frequent keys of ``left`` found and spread (four salts a shuffle partition)."""
    return salted_join(left, right, keys, how, heavy_keys(left, keys, share), salts_for(left) if salts is None else salts)
