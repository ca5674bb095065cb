"""Row work that must be done once a row: rendering, allocation, the recipients the seeds are drawn from."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from slotwise.functions import text as T
from slotwise.operators import allocate
from slotwise.operators.util import broadcast_checked, exploded
from slotwise.plans import fixture_run as fr
from tests.conftest import SMALL


def optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["rendered_content", "demoted_modules", "demoted_modules_strict"])
def test_rendered_rows_are_not_rendered_again_by_a_filter(spark, name):
    filters = [line for line in optimised(E.queries()[name](spark, SMALL)).splitlines() if " Filter " in line or "+- Filter" in line]
    assert not any("transform_values(" in line for line in filters)


def test_exploded_equals_explode(spark):
    df = spark.createDataFrame([(1, {1: "a", 2: None}), (2, {}), (3, None)], "k int, m map<int,string>")
    want = df.select("k", F.explode("m").alias("i", "v")).collect()
    assert sorted(exploded(df, ["k"], "m", "i", "v").collect()) == sorted(want) and len(want) == 2


def test_allocation_is_computed_once_and_counts_cohorts_with_candidates(spark):
    run = fr.fixture_run(spark, SMALL)
    strangers = spark.createDataFrame([(run.cohorts.first()["campaign_id"], 3, "-5")], run.cohorts.schema)
    alloc = allocate.allocation(run.cohorts.unionByName(strangers), run.content, 11)
    assert not any("transform" in line for line in optimised(alloc).splitlines() if "Filter (" in line and "chosen" in line)
    assert alloc.filter("segment_type_id = '-5'").first()["slot_cands"] == {}
    assert run.allocation_size[0] == run.allocation.count() == run.allocated.filter(F.size("slot_cands") > 0).count()
    assert allocate.allocate_modules(strangers, run.content, 11).count() == 0


def test_gates_do_not_depend_on_what_ran_before(spark):
    """A pass that reads a part of a stage must not decide its count."""
    fr._RUNS.clear()
    run = fr.fixture_run(spark, SMALL)
    run.cohorts.limit(3).collect()
    run.audience.limit(3).collect()
    assert run.check_gate("cohorts") == run.audience.select("campaign_id", "test_keys", "segment_type_id").distinct().count() > 3
    assert run.check_gate("audience") == run.audience.count() > 3
    fr._RUNS.clear()


def test_recipients_are_kept_for_output_and_seeds(spark):
    run = fr.fixture_run(spark, SMALL)
    assert run.n_seeds > 0 and run.seeded.count() > 0 and run.sendable.is_cached
    assert "transform_values(" not in run.seeded._jdf.queryExecution().withCachedData().toString().split("InMemoryRelation")[0]


def test_value_texts(spark):
    df = spark.createDataFrame([({"a": "x", "b": "", "c": None},)], "m map<string,string>")
    keys = ("a", "b", "c", "d")
    texts = lambda mode: tuple(df.select(*[T.text_for_key(T.value_texts("m", mode), F.lit(k)).alias(k) for k in keys]).first())
    assert texts("compat") == ("x", "value_not_found", "None", "value_not_found")
    assert texts("strict") == ("x", "value_not_found", "value_not_found", "value_not_found")


def test_a_small_part_of_large_configuration_is_broadcast(spark):
    df = spark.range(5)
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert not hinted(broadcast_checked(df, 10, (1000, 10)))
    assert hinted(broadcast_checked(df, 10, (1000, 10), closer=True)) and not hinted(broadcast_checked(df, 4, (1000, 10), closer=True))
