"""Module allocation — I1, I2, C13, H7.

For every cohort (campaign, bucket, segment list) and slot, the candidate
modules are the rows of that campaign and slot whose segment is in the
cohort's list and whose version is today's rotation for the bucket. A
campaign's offers are numbered and each of its segments has a bitmap of them,
so a cohort finds its candidates in its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions import templates
from slotwise.functions.bindings import binding_left_keys, binding_right_keys, key_spec, template_tokens
from slotwise.functions.keys import segment_ids
from slotwise.functions.rotation import pick_version
from slotwise.functions.text import value_key
from slotwise.operators.audience import COHORT_KEYS
from slotwise.operators.skew import busy_partitions, salted_join, salts_for
from slotwise.operators.util import broadcast_checked, exploded

# Fixed values (must equal the reference's): placements whose missing content demotes a module.
PLACEMENTS_DEMOTABLE = ("hero", "banner")


def offer_rows(content: DataFrame) -> DataFrame:
    """Rows of the expanded content that can fill a slot (modules with variables), repeated per variable."""
    return content.filter(F.col("var_position").isNotNull()).select(
        "campaign_id", "slot_position", "segment_type_id", "module_type_id",
        F.col("module_priority_in_slot").cast("int").alias("module_priority_in_slot"),
        F.col("module_id").cast("int").alias("module_id"), "version", "ttl_versions",
    )


def bound(expr: Column, fn) -> Column:
    """``fn`` of an expression that is evaluated once a row: it enters as a lambda
    variable, where a column would be copied into every use inside ``fn``."""
    return F.get(F.transform(F.array(expr), fn), 0)


def module_index(content: DataFrame) -> DataFrame:
    """One row per campaign: its offers in order, and per segment a bitmap of them.

    ``offers``: (slot, type, priority, module, version, versions and the module's
    place ``at`` in the campaign's list), sorted so that the greatest module of a
    (slot, type, priority) comes first (Q8). ``index``: segment → words of 64
    offers each. Configuration-sized, and one exchange: a campaign's rows are
    collected, then numbered and packed in their row.
    """
    row = F.struct(
        F.col("slot_position").alias("slot"), F.col("module_type_id").alias("type"), F.col("module_priority_in_slot").alias("priority"),
        (-F.col("module_id")).alias("order"), "version", "ttl_versions", F.col("segment_type_id").cast("int").alias("segment"),
    )
    campaigns = offer_rows(content).groupBy("campaign_id").agg(F.collect_set(row).alias("rows"))
    bare = lambda r: r.dropFields("segment")
    campaigns = campaigns.select(
        "campaign_id", "rows", F.array_sort(F.array_distinct(F.transform("rows", bare))).alias("bare"),
        F.array_sort(F.array_distinct(F.transform("rows", lambda r: -r["order"]))).alias("modules"),
    )

    def words(segment: Column, rows: Column, offers: Column) -> Column:
        places = F.transform(F.filter(rows, lambda r: r["segment"] == segment), lambda r: (F.array_position(offers, bare(r)) - 1).cast("int"))
        word = lambda found, w: F.aggregate(
            F.filter(found, lambda p: F.floor(p / 64) == w), F.lit(0).cast("bigint"),
            lambda bits, p: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), p % 64)),
        )
        return bound(places, lambda found: F.transform(F.sequence(F.lit(0), F.floor((F.size(offers) - 1) / 64).cast("int")), lambda w: word(found, w)))

    segments = F.array_distinct(F.transform("rows", lambda r: r["segment"]))
    index = bound(F.struct("rows", "bare"), lambda c: F.map_from_entries(F.transform(segments, lambda s: F.struct(s, words(s, c["rows"], c["bare"])))))
    offer = lambda o, no: F.struct(
        no.cast("bigint").alias("no"), o["slot"].alias("slot"), o["type"].alias("type"), o["priority"].alias("priority"), (-o["order"]).alias("module_id"),
        (F.array_position("modules", -o["order"]) - 1).cast("int").alias("at"), o["version"].alias("version"), o["ttl_versions"].alias("ttl_versions"),
    )
    return campaigns.select("campaign_id", F.transform("bare", offer).alias("offers"), index.alias("index"))


def allocated_offers(
    cohort_df: DataFrame, content: DataFrame, seed: int, max_broadcast_rows: int = 2_000_000, known: tuple[int, int] | None = None
) -> DataFrame:
    """Per cohort, the offers it receives (``chosen``, maybe none), by bitmaps.

    The bitmaps of the cohort's segments are OR-ed and the campaign's offers
    tested against the result, so a cohort's candidates are found in its own
    row: no segment list is exploded, nothing is regrouped, and the only join
    is with one row per campaign (``known`` — the content's size — bounds it).
    The version filter is today's rotation ``(bucket + seed % v) % v + 1`` with
    ``v`` the count of the row's own (type, placement) (Q16). Several modules
    under one (type, priority) keep the greatest id (Q8).
    """
    index = broadcast_checked(module_index(content), max_broadcast_rows, known)
    own = F.filter(F.transform(F.array_distinct(segment_ids("segment_type_id")), lambda s: F.try_element_at("index", s)), lambda m: m.isNotNull())
    none = F.array().cast("array<bigint>")
    either = F.aggregate(own, none, lambda x, m: F.when(F.size(x) == 0, m).otherwise(F.zip_with(x, m, lambda a, b: a.bitwiseOR(b))))

    def offered(mask: Column, o: Column) -> Column:
        no = o["no"].cast("int")
        return F.call_function("shiftright", F.get(mask, F.shiftright(no, 6)), no.bitwiseAND(63)).bitwiseAND(F.lit(1).cast("bigint")) == 1

    today = lambda o: o["version"] == pick_version(F.col("test_keys"), seed, o["ttl_versions"])
    place = lambda o: F.struct(o["slot"], o["type"], o["priority"])
    received = lambda mask: F.filter("offers", lambda o: F.coalesce(offered(mask, o) & today(o), F.lit(False)))
    first = lambda found: F.filter(found, lambda o, i: (i == 0) | (place(o) != place(F.get(found, F.greatest(i - 1, F.lit(0))))))
    chosen = bound(bound(either, received), first)
    return cohort_df.join(index, "campaign_id").select(*COHORT_KEYS, chosen.alias("chosen"))


def allocate_modules(
    cohort_df: DataFrame, content: DataFrame, seed: int, max_broadcast_rows: int = 2_000_000, known: tuple[int, int] | None = None
) -> DataFrame:
    """I1 as rows: one per (cohort, slot, module type, priority) with the chosen module."""
    rows = exploded(allocated_offers(cohort_df, content, seed, max_broadcast_rows, known), COHORT_KEYS, "chosen", "o")
    return rows.select(
        *COHORT_KEYS, F.col("o.slot").alias("slot_position"), F.col("o.type").alias("module_type_id"),
        F.col("o.priority").alias("module_priority_in_slot"), F.col("o.module_id").alias("module_id"),
    )


def module_attributes(content: DataFrame) -> DataFrame:
    """Placement, type name and ``default`` flag per module (null flag stays null, Q27)."""
    return content.groupBy(F.col("module_id").cast("int").alias("module_id")).agg(
        F.max("placement_type").alias("placement_type"),
        F.max("module_type").alias("module_type"),
        F.max(F.col("default").cast("int")).alias("default_flag"),
    )


def module_variables(content: DataFrame, mode: str = "compat") -> DataFrame:
    """Per module, its variables sorted by position, with bindings and
    templates pre-parsed once here instead of once per recipient row.

    Variables are taken from any campaign that offers the module (Q22). The
    rendering mode decides what a variable carries: its tokens with their keys
    (``keyed``), or in strict mode its compiled template (``compiled``).
    """
    v = (
        content.filter(F.col("var_position").isNotNull())
        .groupBy(F.col("module_id").cast("int").alias("module_id"), F.col("var_position").cast("int").alias("pos"), F.col("var_source").alias("binding"))
        .agg(F.max("var_structure").alias("template"))
        .withColumn("tokens", template_tokens("template"))
        .withColumn("spec", key_spec(binding_left_keys("binding"), binding_right_keys("binding")))
    )
    if mode == "compat":
        parsed, name = F.transform("tokens", lambda t: F.struct(t.alias("token"), value_key(t, F.col("spec")).alias("key"))), "keyed"
    else:
        parsed, name = templates.keyed(templates.compiled("template"), F.col("spec")), "compiled"
    v = v.withColumn(name, parsed)
    return v.groupBy("module_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "binding", "template", "tokens", "spec", name))).alias("vars")
    )


def campaign_modules(content: DataFrame, mode: str = "compat") -> DataFrame:
    """Per campaign, its offered modules with attributes and variables, in the order
    of ``module_index``'s places."""
    offered = offer_rows(content).select("campaign_id", "module_id").distinct()
    # A content row meets its whole campaign's modules: they carry what rendering reads, no more.
    read = ("pos", "template", "keyed") if mode == "compat" else ("pos", "compiled")
    slim = F.transform("vars", lambda v: F.struct(*[v[f].alias(f) for f in read]))
    modules = module_attributes(content).join(module_variables(content, mode).withColumn("vars", slim), "module_id")
    rows = offered.join(modules, "module_id", "left")
    module = F.struct("module_id", "placement_type", "default_flag", "vars")
    return rows.groupBy("campaign_id").agg(F.sort_array(F.collect_list(module)).alias("modules"))


def allocation(
    cohort_df: DataFrame, content: DataFrame, seed: int, max_broadcast_rows: int = 2_000_000, known: tuple[int, int] | None = None
) -> DataFrame:
    """Per cohort of a campaign with offers, a map slot → candidate modules
    (priority, type, id, place in the campaign's module list), empty where it gets
    none: a filter here would compute every cohort's map once more. What the modules say is attached when a content
    row is rendered (``with_modules``), so cohorts carry numbers only."""
    rows = allocated_offers(cohort_df, content, seed, max_broadcast_rows, known)
    candidate = lambda o: F.struct(
        o["priority"].alias("priority"), o["type"].cast("int").alias("type_id"), o["module_id"].alias("module_id"), o["at"].alias("at")
    )

    def per_slot(chosen: Column) -> Column:
        slots = F.array_distinct(F.transform(chosen, lambda o: o["slot"].cast("int")))
        return F.transform(slots, lambda s: F.struct(s, F.sort_array(F.transform(F.filter(chosen, lambda o: o["slot"] == s), candidate))))

    return rows.select(*COHORT_KEYS, F.map_from_entries(bound(F.col("chosen"), per_slot)).alias("slot_cands"))


def with_modules(
    rows: DataFrame, content: DataFrame, mode: str = "compat", max_broadcast_rows: int = 2_000_000, known: tuple[int, int] | None = None,
    heavy: list[str] | None = None,
) -> DataFrame:
    """The candidates of each row with their modules' attributes and variables.

    One join with a row per campaign (bounded by ``known``). Candidate fields
    start with (priority, type, module id), so the slot fold can take
    ``array_min`` for the lowest-priority pick (Q4: ties broken by type, then id).
    Where it is a shuffle join, the rows are rendered in its partitions: their number
    is given, as few bytes are much work here, and rows of the campaigns ``heavy``
    (those with a large share of them) are spread.
    """
    modules = campaign_modules(content, mode)
    side = broadcast_checked(modules, max_broadcast_rows, known)

    def full(c: Column) -> Column:
        m = F.get("modules", c["at"])
        return F.struct(
            c["priority"].alias("priority"), c["type_id"].alias("type_id"), c["module_id"].alias("module_id"),
            m["placement_type"].alias("placement_type"), m["default_flag"].alias("default_flag"), m["vars"].alias("vars"),
        )

    if side is modules:
        joined = salted_join(rows, modules, ["campaign_id"], "left", heavy or [], salts_for(rows), partitions=busy_partitions(rows))
    else:
        joined = rows.join(side, "campaign_id", "left")
    return joined.withColumn("slot_cands", F.transform_values("slot_cands", lambda _, cands: F.transform(cands, full))).drop("modules")
