"""Plan shape: JVM-only execution, partial top-k before shuffles, checked broadcasts."""

from slotwise.plans.fixture_run import fixture_run
from tests.conftest import SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_runs_without_python(spark):
    plan = _plan(fixture_run(spark, SMALL).output)
    for op in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert op not in plan


def test_rank_is_limited_before_the_shuffle(spark):
    plan = _plan(fixture_run(spark, SMALL).best)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_join_back_is_broadcast_when_small(spark):
    plan = _plan(fixture_run(spark, SMALL).personalised)
    assert "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_layout_is_configuration_metadata(spark):
    run = fixture_run(spark, SMALL)
    assert run.slots == [(1, 2), (2, 2), (3, 2), (4, 2)]
    assert run.attributes == ["first_name", "home_city", "nation_key"]
    assert [(s.table, s.left, s.right, s.columns) for s in run.lookup_specs] == [
        ("fx_nation_lookup", ("nation_key",), ("nation_key",), ("label",)),
        ("fx_offer_lookup", ("nation_key", "first_name"), ("nation_key", "segment"), ("offer",)),
    ]


def test_unused_profile_columns_are_not_shuffled_or_cached(spark):
    run = fixture_run(spark, SMALL)
    assert "profile_note" in run.inputs.profiles.columns and "profile_note" not in run.audience.columns
    plan = _plan(run.audience)
    assert "InMemoryTableScan" in plan and "profile_note" not in plan


def test_oversized_sides_are_not_broadcast(spark):
    from pyspark.sql import functions as F

    from slotwise.operators import allocate, select

    def hinted(df):
        return "strategy=broadcast" in df._jdf.queryExecution().optimizedPlan().toString()

    run = fixture_run(spark, SMALL)
    rows = run.with_tokens.limit(5).persist()  # hides the hints of earlier stages
    wide = run.seeds.withColumn("pad", F.repeat(F.lit("x"), 5000))
    assert hinted(select.seed_rows(rows, run.seeds, run.n_seeds))
    assert not hinted(select.seed_rows(rows, wide, run.n_seeds, max_broadcast_bytes=1000))
    cohorts, content = run.cohorts.limit(5).persist(), run.content
    assert hinted(allocate.allocation(cohorts, content, 11, 2_000_000, (10, 1000)))
    assert not hinted(allocate.allocation(cohorts, content, 11, 2_000_000, (10, 10**9)))  # few modules, long templates


def test_slot_contents_are_rendered_without_being_kept(spark):
    from slotwise.plans import fixture_run as fr
    from slotwise.plans.catalog import QUERIES

    fr._RUNS.clear()
    got = QUERIES["slot_choice"](spark, SMALL)
    run = fr.fixture_run(spark, SMALL)
    assert "rendered" not in run.__dict__ and not run.slot_contents.is_cached and got.count() == run.key_rows
    fr._RUNS.clear()


def test_row_width_turns_only_nested_fields_into_text(spark):
    from slotwise.operators.util import measured_size, row_width

    df = spark.createDataFrame([(1, "x" * 100, None, None), (2, None, [1, 2], b"abc")], "a int, b string, c array<int>, d binary")
    widths = [r[0] for r in df.orderBy("a").select(row_width(df)).collect()]
    assert widths[0] >= 180 and widths[1] >= 80 + 3 + len("[1,2]")
    assert measured_size(df) == (2, sum(widths)) and measured_size(df.limit(0)) == (0, 0)
    plain = df.drop("c")
    assert "to_json" not in plain.select(row_width(plain))._jdf.queryExecution().analyzed().toString()
