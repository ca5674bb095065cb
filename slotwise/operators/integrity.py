"""Integrity of the configuration — A2, C2–C5.

The expansion joins trust the configuration: a key that a definition table holds
twice multiplies recipients, one that it lacks loses them, and neither shows in
the result. Every table contributes its keys to one long list, as a definition or
as a reference, and one aggregation of that list proves all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.config import Scope
from slotwise.functions.keys import normalize_locale
from slotwise.operators.campaigns import MODULE_JOIN_KEYS, SEGMENT_JOIN_KEYS, CampaignConfig, in_scope, live

DUPLICATE, MISSING = "duplicate", "missing"


def _key(columns: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def _part(df: DataFrame, relation: str, columns: list[str], unique: bool, defines: bool) -> DataFrame:
    return df.select(F.lit(relation).alias("relation"), _key(columns).alias("key"), F.lit(unique).alias("is_unique"), F.lit(defines).alias("defines"))


def config_keys(cfg: CampaignConfig, scope: Scope) -> DataFrame:
    """``relation, key, is_unique, defines``: every key the expansion joins on, defined or referred to.

    Only rows that the expansion uses count: live ones, and those of the run's scope.
    """
    campaigns = live(in_scope(normalize_locale(cfg.campaigns), scope), "campaign_deleted_flag")
    slots = live(cfg.segment_modules, "seg_mod_deleted_flag")
    modules = in_scope(normalize_locale(cfg.module_defs), scope)
    segments = in_scope_of_segments(live(cfg.segment_defs, "segment_deleted_flag"), scope)
    variables = in_scope(normalize_locale(cfg.module_vars), scope)
    scoped = slots.withColumns({"locale": F.lit(scope.locale), "tpid": F.lit(scope.tpid), "eapid": F.lit(scope.eapid)})
    target = campaigns.withColumnRenamed("campaign_segment_type_id", "segment_type_id")
    slot_row = [c for c in slots.columns if c != "seg_mod_deleted_flag"]
    parts = [
        _part(campaigns, "campaign", ["campaign_id"], True, True),
        _part(live(cfg.templates, "template_deleted_flag"), "template", ["template_id"], True, True),
        _part(campaigns, "template", ["template_id"], True, False),
        _part(slots, "slot row", slot_row, True, True),
        _part(slots, "slot map", ["segment_module_map_id"], False, True),
        _part(campaigns, "slot map", ["segment_module_map_id"], False, False),
        _part(modules, "module", ["module_id"], True, True),
        _part(variables, "module", ["module_id"], True, False),
        _part(modules, "module kind", MODULE_JOIN_KEYS, False, True),
        _part(scoped, "module kind", MODULE_JOIN_KEYS, False, False),
        _part(segments, "segment", SEGMENT_JOIN_KEYS, True, True),
        _part(scoped, "segment", SEGMENT_JOIN_KEYS, True, False),
        _part(target, "segment", SEGMENT_JOIN_KEYS, True, False),
        _part(variables, "variable", ["module_id", "var_position", "source_connection"], True, True),
    ]
    return reduce(DataFrame.unionByName, parts)


def in_scope_of_segments(df: DataFrame, scope: Scope) -> DataFrame:
    """Segment definitions have no locale."""
    return df.filter((F.col("tpid") == F.lit(scope.tpid)) & (F.col("eapid") == F.lit(scope.eapid)))


def config_violations(cfg: CampaignConfig, scope: Scope) -> DataFrame:
    """``relation, key, violation, n``: keys defined more than once where they must be
    unique (n definitions), and keys referred to but not defined (n references)."""
    keys = config_keys(cfg, scope).groupBy("relation", "key").agg(
        F.max("is_unique").alias("is_unique"), F.count_if("defines").alias("defined"), F.count_if(~F.col("defines")).alias("referred")
    )
    twice, lacking = F.col("is_unique") & (F.col("defined") > 1), F.col("defined") == 0
    return keys.filter(twice | lacking).select(
        "relation", "key", F.when(twice, F.lit(DUPLICATE)).otherwise(F.lit(MISSING)).alias("violation"),
        F.when(twice, F.col("defined")).otherwise(F.col("referred")).alias("n"),
    )


def check_config(cfg: CampaignConfig, scope: Scope) -> int:
    """The number of violations; duplicate keys end the run, with their names."""
    found = config_violations(cfg, scope).persist()
    twice = found.filter(F.col("violation") == DUPLICATE).orderBy("relation", "key").limit(20).collect()
    n = found.count()
    found.unpersist()
    if twice:
        raise ValueError("configuration keys defined more than once: " + ", ".join(f"{r.relation} {r.key} ({r.n})" for r in twice))
    return n
