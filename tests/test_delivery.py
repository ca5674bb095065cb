"""Atomic delivery, resumable runs, observed counts (A9–A11, I10, I11, D-9)."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from slotwise.operators import audience, skew
from slotwise.operators.util import EmptyStageError
from slotwise.plans import pipeline
from slotwise.plans.fixture_run import daily_run, fixture_inputs, fixture_params, fixture_source
from slotwise.plans.ledger import StageLedger, fingerprint
from slotwise.plans.pipeline import CampaignRun, OutputPaths, daily_inputs, run_campaign
from slotwise.sources import delivery, fixtures as fx, runlog, tables
from tests.conftest import SMALL
from tools.oracle_check import rows_of


def scratch():
    return tempfile.mkdtemp(prefix="slotwise-test-", dir="/tmp")


def breaking(df):
    """Fails in the middle of the rows, when some of them have been written."""
    return df.withColumn("x", F.when(F.col("id") == 700, F.raise_error(F.lit("lost"))).otherwise(F.lit(1)))


def test_a_failed_write_leaves_the_delivery_before_it(spark):
    root = scratch()
    assert delivery.current(spark, root) is None
    with pytest.raises(delivery.DeliveryError):
        delivery.read_current(spark, root)
    first = delivery.publish(spark, root, delivery.write_delivery(spark.range(10), root, "a"), dt.datetime(2024, 3, 5))
    with pytest.raises(Exception, match="lost"):
        delivery.write_delivery(breaking(spark.range(0, 1000, 1, 4)), root, "b")
    assert delivery.current(spark, root) == delivery.Delivery("a", f"{root}/runs/a/*", 10)
    assert delivery.read_current(spark, root).count() == first.rows == 10
    # written but not published: still the one before
    second = delivery.write_delivery(spark.range(20), root, "b")
    assert delivery.current(spark, root).run_id == "a"
    delivery.publish(spark, root, second, dt.datetime(2024, 3, 6))
    assert delivery.current(spark, root).run_id == "b" and delivery.read_current(spark, root).count() == 20
    assert spark.read.parquet(f"{root}/runs/a").count() == 10
    with pytest.raises(delivery.DeliveryError, match="published"):
        delivery.write_delivery(spark.range(1), root, "b")


def test_empty_deliveries_are_whole(spark):
    root = scratch()
    done = delivery.publish(spark, root, delivery.write_delivery(spark.range(0), root, "none"))
    assert done.rows == 0 and delivery.read_current(spark, root).count() == 0


def test_a_run_that_fails_while_delivering_is_not_published(spark, monkeypatch):
    root, f = scratch(), fx.Fixtures(spark, SMALL)
    run_campaign(spark, fixture_params(), fixture_inputs(f), paths=OutputPaths(root, run_id="one"))
    want = rows_of(delivery.read_current(spark, root).toPandas())
    monkeypatch.setattr(pipeline.delivery, "write_run_snapshot", lambda *a: (_ for _ in ()).throw(OSError("disk")))
    log = runlog.RunLog("campaign run", 1)
    with pytest.raises(OSError):
        run_campaign(spark, fixture_params(), fixture_inputs(f), log=log, paths=OutputPaths(root, run_id="two"))
    assert log.rows[-1][3] == "write snapshot" and log.rows[-1][2] == 0
    assert delivery.current(spark, root).run_id == "one" and rows_of(delivery.read_current(spark, root).toPandas()) == want


def test_a_killed_run_goes_on_after_its_last_stage(spark, monkeypatch):
    f, root = fx.Fixtures(spark, SMALL), scratch()
    want = rows_of(run_campaign(spark, fixture_params(), fixture_inputs(f)).toPandas())
    keep = pipeline.allocate.allocation
    monkeypatch.setattr(pipeline.allocate, "allocation", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        run_campaign(spark, fixture_params(), fixture_inputs(f), ledger_root=root)
    monkeypatch.setattr(pipeline.allocate, "allocation", keep)
    monkeypatch.setattr(pipeline.audience, "build_audience", lambda *a: (_ for _ in ()).throw(AssertionError("built again")))
    assert rows_of(run_campaign(spark, fixture_params(), fixture_inputs(f), ledger_root=root).toPandas()) == want
    kept = spark.read.parquet(f"{root}/ledger").collect()
    assert sorted(r.stage for r in kept) == ["audience", "best"] and len({r.fingerprint for r in kept}) == 1
    # whole again: both stages are read
    monkeypatch.setattr(pipeline.select, "best_campaign", lambda *a: (_ for _ in ()).throw(AssertionError("ranked again")))
    assert rows_of(run_campaign(spark, fixture_params(), fixture_inputs(f), ledger_root=root).toPandas()) == want


def test_other_inputs_are_another_run(spark):
    f = fx.Fixtures(spark, SMALL)
    small, large = {"t": f.fx_templates}, {"p": f.fx_profiles, "none": None}
    one = fingerprint(fixture_params(), small, large)
    assert one == fingerprint(fixture_params(), {"t": f.fx_templates.repartition(3)}, large)
    assert one != fingerprint(fixture_params(as_of="2024-03-06"), small, large)
    assert one != fingerprint(fixture_params(), {"t": f.fx_templates.filter("template_id > 1")}, large)
    assert one != fingerprint(fixture_params(), small, {"p": f.fx_seeds, "none": None})
    ledger, other = (StageLedger(spark, scratch(), x) for x in ("a", "b"))
    other.root = ledger.root
    assert ledger.stage("s", lambda: spark.range(5)).count() == 5 and ledger.rows == {"s": 5}
    assert other.stage("s", lambda: spark.range(7)).count() == 7
    again = StageLedger(spark, ledger.root, "a")
    assert again.stage("s", lambda: 1 / 0).count() == 5 and again.resumed == ["s"]


def test_gates_need_no_job_of_their_own(spark):
    """Every gated count comes from a pass that the run makes anyway."""
    run = CampaignRun(spark, fixture_params(), fixture_inputs(fx.Fixtures(spark, SMALL)))
    run.rendered_size  # noqa: B018 - the plan of the output needs it
    spark.sparkContext.setJobGroup("gates", "gates")
    counts = {name: run.check_gate(name) for name in pipeline.GATED}
    spark.sparkContext.setJobGroup("none", "none")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("gates")) == 0
    assert counts["audience"] == run.audience.count() and counts["cohorts"] == audience.cohorts(run.audience).count()
    assert counts["expanded content"] == run.content.count() and counts["allocation"] == run.allocation.count()
    run.release()


def test_an_empty_stage_ends_the_run(spark):
    inputs = fixture_inputs(fx.Fixtures(spark, SMALL))
    inputs.config.templates = inputs.config.templates.filter("template_id > 99")
    with pytest.raises((EmptyStageError, IndexError, ValueError)) as e:
        run_campaign(spark, fixture_params(), inputs)
    assert "campaign metadata" in str(e.value)


def test_the_daily_run_reads_each_table_once_and_delivers(spark):
    source = fixture_source(spark, SMALL)
    names, read = [], source.read
    source.read = lambda s, n: (names.append(n), read(s, n))[1]
    params, inputs = daily_inputs(spark, source, fx.LOCALE, fx.LAUNCH_DATE, "Brand A", pipeline.ControlTables(environment="test"))
    run_campaign(spark, params, inputs)
    assert len(names) == len(set(names)) and {"fx_nation_lookup", "fx_offer_lookup", "tokens_0"} <= set(names)
    root = daily_run(spark, SMALL)
    assert delivery.read_current(spark, root).count() == delivery.current(spark, root).rows > 0


def test_a_back_dated_run_reads_what_was_complete_then(spark):
    log = spark.createDataFrame(
        [(1, 5, "ETL", 1, "2024-01-01", "2024-01-02", "/a"), (2, 5, "ETL", 1, "2024-01-03", "2024-02-09", "/b"), (3, 5, "ETL", 0, "2024-01-05", "2024-01-06", "/c")],
        "LogID int, SourceID int, SourceName string, IsComplete int, StartDate string, EndDate string, FilePath string",
    ).withColumns({c: F.to_timestamp(c) for c in ("StartDate", "EndDate")})
    assert runlog.latest_run(log, 5, "ETL").first().LogID == 2
    assert runlog.latest_run(log, 5, "ETL", as_of=dt.datetime(2024, 2, 1)).first().LogID == 1
    days = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("2024-02-09",), ("2030-01-01",), (None,)], "as_of string").withColumn("as_of", F.to_timestamp("as_of"))
    got = {(str(r.as_of)[:10], r.LogID) for r in runlog.runs_as_of(log, days, "StartDate").collect()}
    assert got == {("2024-01-02", 1), ("2024-02-09", 2), ("2030-01-01", 2)}
    assert runlog.runs_as_of(log, days.limit(0)).count() == 0 and runlog.runs_as_of(log.limit(0), days).count() == 0


@pytest.mark.parametrize("values", [
    [i * i for i in range(5000)], [7] * 900 + list(range(100)), [1], [None] * 50 + list(range(1000)), [0.5 * i for i in range(999)],
])
def test_ranges_cover_every_row_once(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "k double").repartition(4)
    ranges = tables.plan_ranges(df, "k", 8)
    sizes = [df.filter(r).count() for r in ranges]
    assert sum(sizes) == len(values) and len(ranges) <= 8
    hits = sum((F.coalesce(F.expr(r), F.lit(False)).cast("int") for r in ranges), F.lit(0))
    assert df.filter(hits != 1).isEmpty()
    most = max(values.count(v) for v in set(values[:1000]))
    assert max(sizes) <= 1.2 * len(values) / 8 + most + 50 * (None in values)


def test_ranges_of_nothing(spark):
    assert tables.plan_ranges(spark.createDataFrame([], "k int"), "k", 8) == ["1 = 1"]
    with pytest.raises(ValueError, match="numbers"):
        tables.plan_ranges(spark.createDataFrame([], "k string"), "k", 8)


def test_bucketed_tables_are_not_shuffled_again(spark):
    from slotwise.operators import deliver

    f = fx.Fixtures(spark, SMALL)
    rows = spark.range(300).select(F.col("id").alias("paid"), F.lit("x").alias("v"))
    accounts = tables.write_bucketed(f.fx_account_tokens, "bucketed_accounts", "ProtoAccountID", 8)
    plain = deliver.add_tokens(rows, f.fx_account_tokens, None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = deliver.add_tokens(rows, accounts, None)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
        assert rows_of(df.toPandas()) == rows_of(plain.toPandas())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_accounts")


def test_duplicate_configuration_keys_end_the_run(spark):
    f = fx.Fixtures(spark, SMALL)
    log = runlog.RunLog("campaign run", 3)
    run_campaign(spark, fixture_params(check_config=True), fixture_inputs(f), log=log)
    assert log.rows[0][3] == "configuration integrity"
    inputs = fixture_inputs(f)
    inputs.config.templates = f.fx_templates.unionByName(f.fx_templates.filter("template_id = 1"))
    with pytest.raises(ValueError, match=r"template 1 \(2\)"):
        run_campaign(spark, fixture_params(check_config=True), inputs)


def test_too_many_seeds_are_refused(spark, monkeypatch):
    from slotwise.config import Scope
    from slotwise.operators import select

    monkeypatch.setattr(select, "MAX_SEEDS", 2)
    with pytest.raises(ValueError, match="seed addresses"):
        select.active_seeds(fx.Fixtures(spark, SMALL).fx_seeds, Scope("en_us", 1, 0))


def test_a_hot_account_and_content_key_give_the_same_rows(spark):
    """Salted joins inside the run: half of the audience has one account, and few contents (with a null) serve all."""
    f = fx.Fixtures(spark, SMALL)

    def result(**params):
        inputs = fixture_inputs(f)
        paid = F.when(F.col("paid") % 2 == 0, F.lit(6)).otherwise(F.col("paid"))
        same = {"test_keys": F.col("test_keys") % 2, "nation_key": F.lit("3"), "home_city": F.lit("Town"), "first_name": F.lit(None).cast("string")}
        inputs.profiles = inputs.profiles.withColumns({"paid": paid, **same})
        inputs.segments = inputs.segments.withColumn("test_keys", same["test_keys"])
        run = CampaignRun(spark, fixture_params(max_broadcast_rows=0, share_content=True, **params), inputs)
        rows = rows_of(run.with_tokens.toPandas())
        heavy = run._heavy("accounts"), run._heavy("contents")
        run.release()
        return rows, heavy

    plain, none = result(heavy_share=None)
    salted, (accounts, contents) = result(heavy_share=0.02)
    assert none == ([], []) and accounts == ["6"] and contents
    assert salted == plain and len(plain[1]) > 0
    assert skew.heavy_of(None, 0) == []
