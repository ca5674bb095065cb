"""The daily run wired to the fixture tables of a scale-factor directory."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.config import RunParams, Scope
from slotwise.operators.campaigns import CampaignConfig
from slotwise.plans.pipeline import CampaignRun, ControlTables, Inputs, OutputPaths, daily_inputs, run_campaign
from slotwise.session import ensure_checkpoint_dir
from slotwise.sources import fixtures as fx
from slotwise.sources import tables
from slotwise.sources.runlog import RunLog


def fixture_params(**overrides) -> RunParams:
    base = dict(scope=Scope(fx.LOCALE, fx.TPID, fx.EAPID), launch_date=fx.LAUNCH_DATE, as_of=fx.AS_OF)
    base.update(overrides)
    return RunParams(**base)


def fixture_inputs(f: fx.Fixtures) -> Inputs:
    cfg = CampaignConfig(
        campaigns=f.fx_campaigns,
        templates=f.fx_templates,
        segment_modules=f.fx_segment_modules,
        module_defs=f.fx_modules,
        segment_defs=f.fx_segment_defs,
        module_vars=f.fx_module_vars,
    )
    return Inputs(
        config=cfg,
        profiles=f.fx_profiles,
        segments=f.fx_segments,
        lookups={"fx_nation_lookup": f.fx_nation_lookup, "fx_offer_lookup": f.fx_offer_lookup},
        account_tokens=f.fx_account_tokens,
        subscriber_tokens=f.fx_subscriber_tokens,
        seeds=f.fx_seeds,
        members=f.fx_members,
    )


_RUNS: dict = {}


def fixture_run(spark: SparkSession, sf_dir: str, **overrides) -> CampaignRun:
    """One CampaignRun per (session, directory, parameters), reused across queries."""
    key = (id(spark), sf_dir.rstrip("/"), tuple(sorted(overrides.items())))
    run = _RUNS.get(key)
    if run is None:
        f = fx.Fixtures(spark, sf_dir)
        run = CampaignRun(spark, fixture_params(**overrides), fixture_inputs(f))
        _RUNS[key] = run
    return run


# ---- the run from its sources ------------------------------------------------
ENVIRONMENT = "test"
BRAND = "Brand A"
NAMES = ControlTables(environment=ENVIRONMENT)
RUN_ID = f"{fx.LOCALE}-{fx.LAUNCH_DATE}"
_PUBLISHED: dict = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder where driver and executors both see it."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def published_inputs(spark: SparkSession, sf_dir: str) -> str:
    """The producers' outputs (profiles, segments) as files, written once per session and directory."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _PUBLISHED:
        f, root = fx.Fixtures(spark, sf_dir), shared_folder(spark, "producers")
        f.fx_profiles.write.parquet(f"{root}/profiles")
        f.fx_segments.write.parquet(f"{root}/segments")
        _PUBLISHED[key] = root
    return _PUBLISHED[key]


def config_frames(f: fx.Fixtures, environment: str | None = None) -> dict[str, DataFrame]:
    """The configuration tables under their names of an environment, with the ``id`` column a database adds."""
    own = {
        "campaign_definition": f.fx_campaigns, "template_definition": f.fx_templates, "segment_module": f.fx_segment_modules,
        "module_variable_definition": f.fx_module_vars, "segment_definition": f.fx_segment_defs, "module_definition": f.fx_modules,
    }
    return {f"{n}_{environment}" if environment else n: df.withColumn("id", F.monotonically_increasing_id()) for n, df in own.items()}


def token_config(f: fx.Fixtures) -> DataFrame:
    """Token tables of several scopes, one row a region."""
    r = F.col("r_regionkey")
    return f.table("region").select(
        F.when(r % 2 == 0, F.lit("EN_us")).otherwise(F.lit("fr_FR")).alias("locale"), F.lit(1).alias("tpid"),
        F.when(r >= 2, F.lit(1)).otherwise(F.lit(0)).alias("eapid"), F.concat(F.lit("tokens_"), r.cast("string")).alias("UserTokenTableName"),
    )


def fixture_source(spark: SparkSession, sf_dir: str) -> tables.FrameSource:
    """Every table a daily run resolves by name, control tables included."""
    f, root = fx.Fixtures(spark, sf_dir), published_inputs(spark, sf_dir)
    place = F.when(F.col("SourceName") == "ETL", F.lit(f"{root}/profiles")).otherwise(F.lit(f"{root}/segments"))
    frames = config_frames(f, ENVIRONMENT) | {
        "schedule_config": f.fx_schedules.withColumn("ID", F.col("ID") % 20),  # the log knows 20 sources
        "run_log": f.fx_run_log.withColumn("FilePath", place),
        "process_config": f.fx_process_config,
        "token_config": token_config(f),
        "tokens_0": f.fx_account_tokens,
        "subscriber_tokens": f.fx_subscriber_tokens,
        "seed_list": f.fx_seeds,
        "loyalty_members": f.fx_members,
        "fx_nation_lookup": f.fx_nation_lookup,
        "fx_offer_lookup": f.fx_offer_lookup,
    }
    return tables.FrameSource(frames)


def daily_run(spark: SparkSession, sf_dir: str, log: RunLog | None = None) -> str:
    """One whole daily run from its sources; returns the folder it delivered to."""
    params, inputs = daily_inputs(spark, fixture_source(spark, sf_dir), fx.LOCALE, fx.LAUNCH_DATE, BRAND, NAMES)
    root = shared_folder(spark, "delivered")
    run_campaign(spark, params, inputs, log=log, paths=OutputPaths(root, run_id=RUN_ID))
    return root
