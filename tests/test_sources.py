"""Sinks, run log and control-table lookups (A5–A11, D-9, I10, I11)."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from slotwise.operators.util import EmptyStageError, broadcast_checked, gate
from slotwise.plans.fixture_run import fixture_inputs, fixture_params
from slotwise.plans.pipeline import run_campaign
from slotwise.sources import fixtures as fx
from slotwise.sources import runlog, tables
from tests.conftest import SMALL


def scratch():
    return tempfile.mkdtemp(prefix="slotwise-test-", dir="/tmp")


def test_run_writes_output_manifest_and_snapshot(spark):
    out_dir = scratch()
    f = fx.Fixtures(spark, SMALL)
    log = runlog.RunLog("campaign run", 42, clock=lambda: dt.datetime(2024, 3, 5, 20, 0, 0))
    path = os.path.join(out_dir, "result")
    df = run_campaign(spark, fixture_params(), fixture_inputs(f), writer=lambda d: tables.write_output(d, path, 3), log=log)
    back = spark.read.parquet(path)
    assert back.count() == df.count() > 0
    assert len([p for p in os.listdir(path) if p.endswith(".parquet")]) <= 3
    tables.write_manifest(spark, path, os.path.join(out_dir, "manifest"))
    assert spark.read.parquet(os.path.join(out_dir, "manifest")).first().path == path + "/*"
    rows = log.frame(spark).collect()
    counts = {r.Status: r.RowCounts for r in rows}
    assert all(r.IsComplete == 1 for r in rows) and counts["audience"] == f_audience(spark) > 1
    # 20:00 UTC is 12:00 in Los Angeles in March (PST)
    assert rows[0].StartDate == dt.datetime(2024, 3, 5, 12, 0, 0)


def f_audience(spark):
    from slotwise.plans.fixture_run import fixture_run

    return fixture_run(spark, SMALL).audience.count()


def failing_run(spark, inputs):
    log, steps, central = runlog.RunLog("campaign run", 9), [], []
    with pytest.raises(Exception) as e:
        run_campaign(spark, fixture_params(), inputs, log=log, log_writer=lambda d: steps.extend(d.collect()), central_writer=lambda d: central.extend(d.collect()))
    assert [r.IsComplete for r in central] == [0, 0]
    return str(e.value), steps[-1]


def test_failures_leave_a_failed_row(spark):
    inputs = fixture_inputs(fx.Fixtures(spark, SMALL))
    del inputs.lookups["fx_offer_lookup"]
    text, row = failing_run(spark, inputs)
    assert "fx_offer_lookup.*" in text and row.IsComplete == 0 and row.Status == "launch layout" and "fx_offer_lookup.*" in row.ErrorMessage
    inputs = fixture_inputs(fx.Fixtures(spark, SMALL))
    inputs.profiles = inputs.profiles.filter("mer_status = 7")
    text, row = failing_run(spark, inputs)
    assert row.IsComplete == 0 and row.Status == "audience" and "'audience' produced 0 rows" in row.ErrorMessage


def test_error_text_and_counts_are_whole(spark):
    log = runlog.RunLog("x", 1)
    with pytest.raises(ValueError):
        with log.step("long"):
            raise ValueError("y" * 10_000)
    log.append(1, "many", log.clock(), row_count=5_000_000_000)
    rows = log.frame(spark).collect()
    assert len(rows[0].ErrorMessage) > 10_000 and rows[1].RowCounts == 5_000_000_000


def test_optional_inputs_may_be_missing(spark):
    inputs = fixture_inputs(fx.Fixtures(spark, SMALL))
    inputs.account_tokens = inputs.subscriber_tokens = inputs.seeds = inputs.members = None
    out = run_campaign(spark, fixture_params(), inputs)
    row = out.first()
    assert row.UserToken == "" and row.LoyaltyMemberID is None and row.LoyaltyMemberStatus == "0"
    assert out.filter("EmailAddress like 'seed%'").count() == 0


@pytest.mark.parametrize("binding", ["traveler.nation_key|fx_nation_lookup.nation_key;fx_nation_lookup.label", "traveler.|fx_nation_lookup.nation_key"])
def test_uneven_key_lists_fail_with_the_binding(spark, binding):
    f = fx.Fixtures(spark, SMALL)
    inputs = fixture_inputs(f)
    inputs.config.module_vars = f.fx_module_vars.withColumn("var_source", F.when(F.col("var_source") != "", F.lit(binding)).otherwise(""))
    text, row = failing_run(spark, inputs)
    assert "key columns" in text and "key columns" in row.ErrorMessage


def test_lookup_join_never_changes_the_row_count(spark):
    from slotwise.operators import render
    from slotwise.plans.fixture_run import fixture_run

    run = fixture_run(spark, SMALL)
    rows = render.attach_values(run.content_keys, run.attributes, run.lookup_specs, run.inputs.lookups, run.params.scope)
    assert rows.count() == run.content_keys.count()


def test_daily_run_from_sources(spark):
    from slotwise.plans.pipeline import ControlTables, daily_inputs
    from tools.oracle_check import rows_of

    d = scratch()
    f = fx.Fixtures(spark, SMALL)
    frames = {
        "campaign_definition_test": f.fx_campaigns, "template_definition_test": f.fx_templates, "segment_module_test": f.fx_segment_modules,
        "module_variable_definition_test": f.fx_module_vars, "segment_definition_test": f.fx_segment_defs, "module_definition_test": f.fx_modules,
        "fx_nation_lookup": f.fx_nation_lookup, "fx_offer_lookup": f.fx_offer_lookup, "process_config": f.fx_process_config,
        "subscriber_tokens": f.fx_subscriber_tokens, "accounts": f.fx_account_tokens, "seed_list": f.fx_seeds, "loyalty_members": f.fx_members,
        "token_config": spark.createDataFrame([("en_us", 1, 0, "accounts"), ("fr_fr", 1, 0, "other")], "locale string, tpid int, eapid int, UserTokenTableName string"),
        "schedule_config": spark.createDataFrame([(5, "en_us", 1, "job", 2.0), (6, "en_us", 1, "old", 1.0)], "ID int, Locale string, IsFinal int, Job_Name string, ScheduleTimes double"),
        "run_log": spark.createDataFrame(
            [(1, 5, "ETL", 1, 1, 1, f"{d}/old"), (2, 5, "ETL", 1, 2, 2, f"{d}/profiles"), (3, 5, "ETL", 0, 3, 3, f"{d}/none"), (4, 0, "Segment_mapping", 1, 1, 1, f"{d}/segments")],
            "LogID int, SourceID int, SourceName string, IsComplete int, StartDate int, EndDate int, FilePath string",
        ),
    }
    f.fx_profiles.write.parquet(f"{d}/profiles")
    f.fx_segments.write.parquet(f"{d}/segments")
    for name, df in frames.items():
        df.write.parquet(f"{d}/db/{name}.parquet")
    params, inputs = daily_inputs(spark, tables.ParquetSource(f"{d}/db"), fx.LOCALE, fx.LAUNCH_DATE, "Brand A", ControlTables(environment="test"))
    assert params.scope == fixture_params().scope
    central = []
    out = run_campaign(spark, params, inputs, central_writer=lambda df: central.extend(df.collect()))
    assert set(inputs.lookups) == {"fx_nation_lookup", "fx_offer_lookup"}  # as the bindings name them
    want = run_campaign(spark, fixture_params(), fixture_inputs(f))
    assert rows_of(out.toPandas()) == rows_of(want.toPandas())
    assert [r.IsComplete for r in central] == [0, 1]
    with pytest.raises(LookupError):
        daily_inputs(spark, tables.ParquetSource(f"{d}/db"), fx.LOCALE, fx.LAUNCH_DATE, "No brand", ControlTables(environment="test"))


def test_run_delivers_paths_with_observed_count(spark):
    from slotwise.plans.pipeline import OutputPaths

    d = scratch()
    f = fx.Fixtures(spark, SMALL)
    log = runlog.RunLog("campaign run", 7)
    paths = OutputPaths(os.path.join(d, "out"), os.path.join(d, "manifest"), os.path.join(d, "snapshot"))
    run_campaign(spark, fixture_params(), fixture_inputs(f), log=log, paths=paths)
    n = spark.read.parquet(paths.output).count()
    steps = {r[3]: r for r in log.rows}
    assert steps["write output"][7] == n > 0
    assert spark.read.parquet(paths.snapshot).count() > 0
    assert spark.read.parquet(paths.manifest).first().path == paths.output + "/*"


def test_step_logs_failure_and_reraises(spark):
    log = runlog.RunLog("x", 1)
    with pytest.raises(ValueError):
        with log.step("boom"):
            raise ValueError("no data")
    assert log.rows[0][2] == 0 and "no data" in log.rows[0][6]


def test_gate_and_broadcast_check(spark):
    empty = spark.range(0)
    with pytest.raises(EmptyStageError):
        gate(empty, "empty")
    assert gate(spark.range(5), "five") == 5
    small = spark.range(10)
    big = spark.range(100)
    plan_small = spark.range(3).join(broadcast_checked(small, 50), "id")._jdf.queryExecution().optimizedPlan().toString()
    plan_big = spark.range(3).join(broadcast_checked(big, 50), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan_small and "broadcast" not in plan_big
    wide = spark.range(10).withColumn("pad", F.repeat(F.lit("x"), 1000))
    plan_wide = spark.range(3).join(broadcast_checked(wide, 50, max_bytes=5000), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan_wide


def test_scope_must_be_unique(spark):
    f = fx.Fixtures(spark, SMALL)
    s = runlog.scope_of(f.fx_profiles)
    assert (s.locale, s.tpid, s.eapid) == ("en_us", 1, 0)
    two = f.fx_profiles.withColumn("tpid", F.col("test_keys") % 2)
    with pytest.raises(ValueError):
        runlog.scope_of(two)


def test_parquet_source_and_config_bundle(spark):
    d = scratch()
    f = fx.Fixtures(spark, SMALL)
    f.fx_templates.withColumn("id", F.lit(1)).write.parquet(os.path.join(d, "template_definition_test.parquet"))
    got = tables.read_table(spark, "template_definition_test", tables.ParquetSource(d))
    assert "id" in got.columns
    src = tables.FrameSource({f"{t}_test": got for t in tables.CONFIG_TABLES})
    cfg = tables.load_config(spark, src, "test")
    assert all("id" not in df.columns for df in cfg.values())


def test_profile_filter_reaches_parquet_scan(spark):
    d = scratch()
    f = fx.Fixtures(spark, SMALL)
    path = os.path.join(d, "profiles")
    f.fx_profiles.write.parquet(path)
    plan = tables.read_profiles(spark, path).select("email_address", "locale")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(mer_status), EqualTo(mer_status,1)]" in plan
    assert "ReadSchema: struct<email_address:string,locale:string,mer_status:int>" in plan


def test_checkpointed_audience_matches_cached(spark):
    from slotwise.plans.pipeline import CampaignRun
    from tools.oracle_check import rows_of

    f = fx.Fixtures(spark, SMALL)
    a = CampaignRun(spark, fixture_params(), fixture_inputs(f)).audience
    b = CampaignRun(spark, fixture_params(checkpoint_audience=True), fixture_inputs(f)).audience
    assert rows_of(a.toPandas()) == rows_of(b.toPandas())


def test_schedule_columns_with_trailing_spaces(spark):
    df = spark.createDataFrame(
        [(1, "en_us", 1, "job a", 5.0), (2, "en_us", 1, " ", 9.0), (3, "en_us", 1, None, 9.5), (4, "en_us", 1, "job b", 7.0)],
        "`ID ` int, Locale string, IsFinal int, `Job_Name ` string, `ScheduleTimes ` double",
    )
    assert runlog.latest_schedule(df, "en_us").first().ID == 4


def test_run_log_parquet_append_and_token_table(spark):
    from slotwise.config import Scope
    from slotwise.operators.deliver import token_table_for_scope

    d = scratch()
    log = runlog.RunLog("x", 3, clock=lambda: dt.datetime(2024, 1, 1))
    log.append(1, "a", dt.datetime(2024, 1, 1))
    log.append_parquet(spark, os.path.join(d, "log"))
    log.append_parquet(spark, os.path.join(d, "log"))
    assert spark.read.parquet(os.path.join(d, "log")).count() == 2
    cfg = spark.createDataFrame([("EN_US", 1, 0, "tokens_us"), ("fr_fr", 1, 0, "tokens_fr")], "locale string, tpid int, eapid int, UserTokenTableName string")
    assert token_table_for_scope(cfg, Scope("en_us", 1, 0)).first().UserTokenTableName == "tokens_us"
