"""Configuration expansion — B3–B5, B8, C1–C5, C8–C10, D-1–D-4, E1.

All inputs are configuration tables (hundreds to thousands of rows), so
these joins are broadcast joins and none of them touches recipient data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.config import RunParams, Scope
from slotwise.functions.keys import normalize_locale
from slotwise.operators.skew import busy_partitions

# Fixed values (must equal the reference's): join and grouping keys.
MODULE_JOIN_KEYS = ["locale", "module_type_id", "tpid", "eapid", "placement_type", "channel"]
SEGMENT_JOIN_KEYS = ["tpid", "eapid", "segment_type_id"]
VERSION_GROUP = ["campaign_id", "slot_position", "module_type_id", "placement_type"]
VARIABLE_JOIN_KEYS = ["module_id", "tpid", "eapid", "locale"]
# Columns removed from the expanded metadata (fixed list of the reference).
DROPPED_META_COLUMNS = (
    "campaign_type_id", "dayofweek", "program_type", "derived_module_id",
    "context", "language", "lob_intent", "status",
)
# Fixed value (must equal the reference's): status of a usable module.
LIVE_STATUS = "active published"


@dataclass
class CampaignConfig:
    """The six configuration tables of one environment."""

    campaigns: DataFrame
    templates: DataFrame
    segment_modules: DataFrame
    module_defs: DataFrame
    segment_defs: DataFrame
    module_vars: DataFrame


def in_scope(df: DataFrame, scope: Scope) -> DataFrame:
    """Keep the run's (locale, tpid, eapid); plain equalities, pushed to the scan."""
    return df.filter(
        (F.col("locale") == F.lit(scope.locale)) & (F.col("tpid") == F.lit(scope.tpid)) & (F.col("eapid") == F.lit(scope.eapid))
    )


def live(df: DataFrame, flag: str) -> DataFrame:
    """Soft-delete filter ``flag = 0``."""
    return df.filter(F.col(flag) == 0)


def launching(campaigns: DataFrame, locale: str, launch_date: str) -> DataFrame:
    """Campaigns of the locale launching on the date (locale compared lower-cased, Q1)."""
    c = normalize_locale(campaigns)
    return c.filter((F.col("locale") == F.lit(locale.lower())) & (F.col("LaunchDate") == F.lit(launch_date)))


def drop_matching(df: DataFrame, names=(), substring: str | None = None) -> DataFrame:
    """Drop listed columns and columns whose name contains ``substring``."""
    names = {n.lower() for n in names}
    keep = [c for c in df.columns if c.lower() not in names and not (substring and substring in c)]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def backfill_binding(module_vars: DataFrame, compat: bool = False) -> DataFrame:
    """Every variable of a module+connection receives its non-empty binding.

    The reference left-joins the non-empty bindings back on (module_id,
    source_connection), which repeats a variable once per binding row and
    drops a row's own binding when its connection is null. By default the
    bindings are made distinct first (identical ones no longer multiply rows)
    and a row without a match keeps its own non-empty binding.
    """
    bindings = module_vars.select("module_id", "source_connection", F.col("var_source").alias("_binding")).filter(
        F.col("_binding") != F.lit("")
    )
    if not compat:
        bindings = bindings.distinct()
    joined = module_vars.join(bindings, ["module_id", "source_connection"], "left")
    if compat:
        filled = F.col("_binding")
    else:
        filled = F.coalesce(F.col("_binding"), F.nullif(F.col("var_source"), F.lit("")))
    return joined.withColumn("var_source", filled).drop("_binding")


def scoped_module_vars(module_vars: DataFrame, scope: Scope, compat: bool = False) -> DataFrame:
    return in_scope(normalize_locale(backfill_binding(module_vars, compat)), scope)


def expand_campaigns(cfg: CampaignConfig, params: RunParams) -> DataFrame:
    """One row per live (campaign, slot row, module, segment).

    All four joins are between configuration tables. No hint is given:
    Catalyst broadcasts on size statistics, and for sources without
    statistics (JDBC) AQE turns the join into a broadcast once the measured
    shuffle output is known to be small. Campaigns and slot rows are dealt out
    first: whichever side is streamed, a small file's one task would expand it all.
    """
    campaigns = live(in_scope(launching(cfg.campaigns, params.locale, params.launch_date), params.scope), "campaign_deleted_flag")
    modules = normalize_locale(cfg.module_defs)
    n = busy_partitions(modules)
    meta = (
        campaigns.repartition(n).join(live(cfg.templates, "template_deleted_flag"), "template_id")
        .join(live(cfg.segment_modules, "seg_mod_deleted_flag").repartition(n), "segment_module_map_id")
        .join(modules, MODULE_JOIN_KEYS)
        .join(live(cfg.segment_defs, "segment_deleted_flag"), SEGMENT_JOIN_KEYS)
        .filter(F.col("status") == F.lit(LIVE_STATUS))
    )
    return drop_matching(meta, DROPPED_META_COLUMNS)


def version_counts(meta: DataFrame) -> DataFrame:
    """D-1 + C8: distinct versions per (module type, placement) over the whole
    launch, attached to every (campaign, slot, type, placement)."""
    per_type = meta.groupBy("module_type_id", "placement_type").agg(F.countDistinct("version").alias("ttl_versions"))
    return meta.select(*VERSION_GROUP).distinct().join(per_type, ["module_type_id", "placement_type"])


def expand_content(meta: DataFrame, module_vars: DataFrame) -> DataFrame:
    """Metadata × module variables, versions renumbered 1..n.

    ``version`` is replaced by its dense rank within (campaign, slot, module
    type, placement); ``ttl_versions`` is the launch-wide count (Q16).
    """
    w = Window.partitionBy(*VERSION_GROUP).orderBy("version")
    return (
        meta.join(module_vars, VARIABLE_JOIN_KEYS, "left")
        .join(version_counts(meta), VERSION_GROUP)
        .withColumn("version", F.dense_rank().over(w))
        .drop("locale")
    )


def slot_widths(content: DataFrame) -> DataFrame:
    """D-2: highest variable position per slot (launch-wide)."""
    return content.groupBy("slot_position").agg(F.max("var_position").alias("var_position"))


def module_counts(content: DataFrame) -> DataFrame:
    """D-3: distinct slots per (campaign, audience table)."""
    return content.groupBy("campaign_id", "AudienceTableName").agg(F.countDistinct("slot_position").alias("ModuleCount"))
