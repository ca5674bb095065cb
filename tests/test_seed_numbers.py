"""Seed lists of any length: longer than one task numbers."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from slotwise.config import Scope
from slotwise.operators import select

SCOPE = Scope("en_us", 1, 0)
SCHEMA = "CampaignCategory string, IsActive int, tpid int, eapid int, locale string, SeedEmail string"


def seed_list(spark, addresses):
    return spark.createDataFrame([("Merch", 1, 1, 0, "en_US", a) for a in addresses], SCHEMA)


def numbers(df):
    return {r.SeedEmail: r.row_id for r in df.collect()}


ADDRESSES = [None, "", " ", *[f"seed{i}@example.com" for i in range(400)], *["é" * i for i in range(1, 30)], *["z" * i for i in range(1, 60)], "\U0001f600", "￮"]


@pytest.mark.parametrize("most", [25, 100, len(ADDRESSES) - 1])
def test_a_long_list_is_numbered_as_by_one_window(spark, monkeypatch, most):
    seeds = seed_list(spark, ADDRESSES * 2).unionByName(spark.createDataFrame([("Merch", 0, 1, 0, "en_us", "gone"), ("Other", 1, 1, 0, "en_us", "other"), ("Merch", 1, 2, 0, "en_us", "far")], SCHEMA))
    one = numbers(select.active_seeds(seeds, SCOPE))
    assert sorted(one.values()) == list(range(1, len(ADDRESSES) + 1)) and one[None] == 1
    monkeypatch.setattr(select, "MAX_SEEDS", most)
    many = select.active_seeds(seeds, SCOPE)
    assert numbers(many) == one
    assert many.schema["row_id"].dataType.simpleString() == "int" and many.columns == ["tpid", "eapid", "locale", "SeedEmail", "row_id"]
    assert "SinglePartition" not in many._jdf.queryExecution().executedPlan().toString()


def test_ranges_are_filled_evenly(spark):
    df = spark.range(40_000).select(F.concat(F.lit("seed"), F.col("id").cast("string"), F.lit("@example.com")).alias("a"))
    sizes = {r["_range"]: r["count"] for r in select.in_ranges(df, "a", 16).groupBy("_range").count().collect()}
    assert sorted(sizes) == list(range(16)) and max(sizes.values()) < 4 * 40_000 / 16
    got = select.numbered_in_ranges(df, "a", 16)
    assert got.join(df.withColumn("at", F.row_number().over(Window.orderBy("a"))), "a").filter("at = row_id").count() == 40_000


def test_more_seeds_than_one_task_numbers(spark):
    """With the bound as it is: every address gets its number and seeds its recipient."""
    n = select.MAX_SEEDS + 20_000
    seeds = spark.range(n).select(
        F.lit("Merch").alias("CampaignCategory"), F.lit(1).alias("IsActive"), F.lit(1).alias("tpid"), F.lit(0).alias("eapid"), F.lit("en_us").alias("locale"),
        F.format_string("seed%06d@example.com", F.col("id")).alias("SeedEmail"),
    )
    found = select.active_seeds(seeds, SCOPE)
    assert found.filter(F.col("SeedEmail") != F.format_string("seed%06d@example.com", F.col("row_id") - 1)).isEmpty() and found.count() == n
    people = spark.range(7).select(
        F.lit("1").alias("campaign_id"), F.lit(1).alias("tpid"), F.lit(0).alias("eapid"), F.lit("en_us").alias("locale"), F.col("id").cast("int").alias("test_keys"),
        F.concat(F.lit("r"), F.col("id")).alias("email_address"), F.col("id").alias("paid"),
    )
    rows = select.seed_rows(people, found, n).orderBy("test_keys").collect()
    assert [(r.test_keys, r.email_address, r.paid) for r in rows] == [(i, f"seed{i:06d}@example.com", select.SEED_ACCOUNT) for i in range(7)]
