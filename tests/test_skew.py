"""Salted joins and Bloom-filtered lookups against plain joins."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from slotwise.operators import bloom, skew


@pytest.fixture()
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def mail(n):
    return F.concat(F.lit("r"), n.cast("string"), F.lit("@x"))


def tables(spark, n=30_000):
    """A third of the left rows have one address; addresses without a partner and nulls on both sides."""
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit("hot@x")).when(i % 101 == 1, F.lit(None)).otherwise(mail(i % 7000))
    left = spark.range(n).select(key.alias("email"), (i % 5).cast("int").alias("bucket"), i.alias("v"))
    people = spark.range(6000).select(mail(F.col("id")).alias("email"), F.col("id").alias("w"))
    right = people.unionByName(spark.createDataFrame([("hot@x", -1), (None, -2)], "email string, w bigint"))
    return left, right.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(4))))


def counted(df):
    return Counter(map(tuple, df.select("email", "bucket", "v", "w").collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("keys", [["email"], ["email", "bucket"]])
def test_salted_join_equals_the_plain_join(spark, how, keys):
    left, right = tables(spark, 6000)
    if keys == ["email"]:
        right = right.filter("bucket = 1").drop("bucket")
    got = skew.skew_join(left, right, keys, how, share=0.02, salts=7)
    assert counted(got) == counted(left.join(right, keys, how))


def test_a_third_of_the_rows_is_spread(no_aqe):
    left, right = tables(no_aqe)
    right = right.filter("bucket = 1").drop("bucket")

    def sizes(df):
        rows = sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        return rows[-1], rows[len(rows) // 2]

    assert skew.heavy_keys(left, ["email"]) == ["hot@x"]
    plain, spread = left.join(right, "email", "left"), skew.skew_join(left, right, ["email"], "left")
    worst, median = sizes(plain)
    assert worst > 2 * median
    worst, median = sizes(spread)
    assert worst < 2 * median
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # one a side, as the plain join


def test_frequent_keys_are_certain(spark):
    keys = [("a",)] * 500 + [("b",)] * 300 + [(None,)] * 400 + [(f"k{i}",) for i in range(2000)]
    df = spark.createDataFrame(keys, "k string").repartition(6)
    assert set(skew.heavy_keys(df, ["k"], 0.05)) == {"a", "b"}
    assert skew.heavy_keys(df.filter("k like 'k%'"), ["k"], 0.05) == [] and skew.heavy_keys(df.limit(0), ["k"]) == []
    two = df.withColumn("n", F.length("k"))
    assert set(skew.heavy_keys(two, ["k", "n"], 0.05)) == {"a\x1f1", "b\x1f1"}
    with pytest.raises(ValueError):
        skew.salted_join(df, df, ["k"], "full", ["a"], 3)


def test_filter_keeps_every_partner_and_few_others(spark):
    lookup = spark.range(60_000).select(F.col("id").cast("string").alias("k1"), (F.col("id") % 7).cast("string").alias("k2"), F.col("id").alias("v"))
    rows = spark.range(0, 60_000, 30).select(F.col("id").cast("string").alias("k1"), (F.col("id") % 7).cast("string").alias("k2"))
    rows = rows.unionByName(spark.createDataFrame([("5", None), (None, None)], "k1 string, k2 string"))
    keys = ["k1", "k2"]
    blocks = bloom.blocks_for(2000, 1 << 20)
    kept = bloom.may_match(lookup, keys, bloom.key_filter(rows, keys, blocks), blocks)
    partners = lookup.join(rows, keys, "left_semi")
    assert kept.columns == lookup.columns and partners.exceptAll(kept).isEmpty()
    false = kept.count() - partners.count()
    assert false < 0.03 * 58_000  # 1 % expected
    assert bloom.blocks_for(10**9, 1 << 20) is None and bloom.blocks_for(0, 1 << 20) == 1


def test_filter_over_nothing_passes_nothing(spark):
    lookup = spark.range(10).select(F.col("id").cast("string").alias("k"))
    assert bloom.may_match(lookup, ["k"], bloom.key_filter(lookup.limit(0), ["k"], 1), 1).count() == 0


def test_counts_are_exact_among_very_many_keys(spark):
    # 60,000 keys: more than a sketch of bounded size keeps apart; one just reaches the share, one just fails it
    keys = spark.range(98_001).select(F.when(F.col("id") < 1000, F.lit("in")).when(F.col("id") < 1999, F.lit("out")).otherwise(F.concat(F.lit("k"), F.col("id") % 60_000)).alias("k"))
    df = keys.unionByName(spark.range(1999).select(F.lit(None).cast("string").alias("k"))).repartition(7)
    assert df.count() == 100_000 and skew.heavy_keys(df, ["k"], 0.01) == ["in"]
    assert {r["item"]: r["count"] for r in skew.counted_keys(df, ["k"]).filter("item in ('in', 'out')").collect()} == {"in": 1000, "out": 999}


def test_the_audience_sends_no_sketches_to_the_driver(spark):
    from slotwise.plans import fixture_run as fr
    from tests.conftest import SMALL

    fr._RUNS.clear()
    run = fr.fixture_run(spark, SMALL)
    plan = run.audience._jdf.queryExecution().toString()
    assert "CollectMetrics" in plan and "approx_top_k" not in plan
    assert "approx_top_k" not in run.with_tokens._jdf.queryExecution().toString()
    fr._RUNS.clear()
