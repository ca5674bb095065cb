"""Ranking, suppression and seeding — E2–E4, B14, C17, G1, I6, I7.

Windows here are rank-≤-k windows: Spark plans them with WindowGroupLimit,
which also runs a partial limit *before* the shuffle, so a recipient (or a
campaign) holding a third of all rows only ships its top rows.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.operators.render import SUPPRESSED_PRIORITY
from slotwise.operators.slots import PLACEHOLDER_ID
from slotwise.operators.util import DEFAULT_MAX_BROADCAST_BYTES, broadcast_checked

# Fixed values (must equal the reference's): account id of seed rows, seed category.
SEED_ACCOUNT = 999999999
SEED_CATEGORY = "Merch"
# Addresses numbered in one task, and ranges a longer list is cut into, at most.
MAX_SEEDS = 100_000
CUT_SAMPLE = 16  # addresses looked at for each cut between ranges


def best_campaign(df: DataFrame) -> DataFrame:
    """Each recipient's lowest ``campaign_priority``; ties stay (``rank``, as the reference)."""
    w = Window.partitionBy("email_address").orderBy("campaign_priority")
    return df.withColumn("_rank", F.rank().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def suppress(df: DataFrame, required_slots=(1, 2)) -> DataFrame:
    """Drop suppressed campaigns and rows whose required slots are empty.
    Applied after ranking (Q18): a recipient whose best campaign fails gets nothing."""
    cond = F.col("campaign_priority") != F.lit(SUPPRESSED_PRIORITY)
    cols = {c.lower() for c in df.columns}
    for s in required_slots:
        if f"s{s}_module_id" in cols:
            cond = cond & (F.col(f"S{s}_module_id") != F.lit(PLACEHOLDER_ID))
    return df.filter(cond)


def top_k(df: DataFrame, partition: list[str], order: list, k: int, name: str = "row_id") -> DataFrame:
    """First ``k`` rows per partition by a total order, numbered 1..k."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def active_seeds(seeds: DataFrame, scope) -> DataFrame:
    """Active seed addresses of the scope, numbered 1..n by address.

    Up to ``MAX_SEEDS`` addresses are numbered by one window over the list, which
    never sees recipient data. A longer list is numbered range by range
    (``numbered_in_ranges``), so that no task holds much of it. Refused is only a
    list of more ranges than the driver should hold, or whose numbers are no ints.
    """
    from slotwise.operators.campaigns import in_scope
    from slotwise.functions.keys import normalize_locale

    s = seeds.filter((F.col("CampaignCategory") == F.lit(SEED_CATEGORY)) & (F.col("IsActive") == 1))
    s = in_scope(normalize_locale(s), scope).select("tpid", "eapid", "locale", "SeedEmail").distinct()
    n, most = s.count(), min(MAX_SEEDS**2, 2**31 - 1)
    if n > most:
        raise ValueError(f"{n} seed addresses; at most {most} are numbered")
    if n > MAX_SEEDS:
        return numbered_in_ranges(s, "SeedEmail", -(-n // max(1, MAX_SEEDS // 4)))
    return s.withColumn("row_id", F.row_number().over(Window.orderBy("SeedEmail")))


def in_ranges(df: DataFrame, column: str, ranges: int) -> DataFrame:
    """Rows with the number (``_range``, from 0) of the range their text value falls into; a null is in the first.

    The cuts between ranges are taken from the values with the smallest hashes: they
    only decide how evenly distinct values fill the ranges.
    """
    value = F.col(column)
    some = df.filter(value.isNotNull()).orderBy(F.xxhash64(value), value).select(value).limit(ranges * CUT_SAMPLE).collect()
    cuts = F.array(*[F.lit(c) for c in sorted(r[0] for r in some)[CUT_SAMPLE::CUT_SAMPLE]]).cast("array<string>")
    # Binary search: how many cuts are below the value.
    steps = F.array(*[F.lit(2**i) for i in reversed(range(ranges.bit_length()))])
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) < value, at + step).otherwise(at))
    return df.withColumn("_range", below)


def numbered_in_ranges(df: DataFrame, column: str, ranges: int, name: str = "row_id") -> DataFrame:
    """Rows numbered 1..n by a text column of distinct values (a null comes first), as one
    window over all of them would, in so many ranges of values.

    A row's number is its place in its range plus the counted rows of the ranges
    before it: a few cuts and a count for each range are all that reaches the driver.
    """
    placed = in_ranges(df, column, ranges)
    counts = {r["_range"]: r["count"] for r in placed.groupBy("_range").count().collect()}
    before = F.array(*[F.lit(x) for x in accumulate((counts.get(i, 0) for i in range(ranges)), initial=0)])
    place = F.row_number().over(Window.partitionBy("_range").orderBy(column))
    return placed.withColumn(name, (F.get(before, F.col("_range")) + place).cast("int")).drop("_range")


def seed_rows(df: DataFrame, seeds: DataFrame, n_seeds: int, max_broadcast_rows: int = 2_000_000, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """C17 + E4: the first n_seeds recipients of each campaign (by bucket, then
    address — Q9) re-addressed to the seed addresses, account ``999999999``."""
    from slotwise.operators.deliver import row_hash

    sample = top_k(df, ["campaign_id"], ["test_keys", "email_address", row_hash(df)], n_seeds)
    return (
        sample.join(broadcast_checked(seeds, max_broadcast_rows, max_bytes=max_broadcast_bytes), ["tpid", "eapid", "locale", "row_id"])
        .drop("row_id", "email_address")
        .withColumnRenamed("SeedEmail", "email_address")
        .withColumn("paid", F.lit(SEED_ACCOUNT))
    )


def append_seeds(df: DataFrame, seeded: DataFrame) -> DataFrame:
    """G1: bag union by column name."""
    return df.unionByName(seeded.select(*df.columns))
