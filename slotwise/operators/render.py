"""Lookup resolution and template rendering — A12, C12, D-8, D-10, H5, H6, H9, I4.

The reference pulls every lookup table into driver dicts and renders rows in
Python. Here a lookup is a left join of the content rows against the
(scope-filtered, key-deduplicated) lookup table — broadcast when its size is
checked small — and rendering is an expression over the row's arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.config import Scope
from slotwise.functions.bindings import (
    QUALIFIER, RECIPIENT_TABLE, binding_left_keys, binding_right_keys, has_lookup, key_spec, template_tokens, token_column, token_table,
)
from slotwise.functions.keys import normalize_locale
from slotwise.functions.templates import fill_compiled
from slotwise.functions.text import fill_options, resolve_parts, value_texts
from slotwise.operators import bloom
from slotwise.operators.allocate import PLACEMENTS_DEMOTABLE, bound, with_modules
from slotwise.operators.audience import COHORT_KEYS
from slotwise.operators.campaigns import in_scope, slot_widths
from slotwise.operators.util import DEFAULT_MAX_BROADCAST_BYTES, broadcast_checked, measured_size

# Fixed value (must equal the reference's): priority of demoted content / suppressed campaigns.
SUPPRESSED_PRIORITY = 9999


@dataclass(frozen=True)
class LookupSpec:
    """One lookup join: table, recipient columns, key columns, content columns."""

    table: str
    left: tuple[str, ...]
    right: tuple[str, ...]
    columns: tuple[str, ...]

    @property
    def spec(self) -> str:
        return ";".join(self.left) + "|" + ";".join(self.right)


def lookup_requirements(content: DataFrame) -> DataFrame:
    """A12 (as data): one row per (table, left keys, right keys, column) a template reads.

    The table is the token's own table (Q6); keys come from the variable's binding.
    """
    v = (
        content.filter(F.col("var_position").isNotNull() & has_lookup("var_source"))
        .select("var_source", "var_structure")
        .distinct()
        .select(
            binding_left_keys("var_source").alias("left_keys"),
            binding_right_keys("var_source").alias("right_keys"),
            F.explode(template_tokens("var_structure")).alias("token"),
        )
        .filter(token_table("token") != F.lit(RECIPIENT_TABLE))
    )
    return v.select(
        token_table("token").alias("table_name"),
        "left_keys",
        "right_keys",
        token_column("token").alias("column_name"),
        key_spec("left_keys", "right_keys").alias("spec"),
    ).distinct()


def launch_layout(content: DataFrame) -> dict:
    """All configuration metadata the plan needs: slot list and widths (D-2,
    D-4), recipient attributes (H11) and lookup joins (A12).

    Bindings and templates are parsed and aggregated in Spark; what reaches the
    driver is one row per slot, per attribute and per lookup join, whatever
    the number of modules.
    """
    widths = slot_widths(content).filter(F.col("var_position").isNotNull())
    left = F.when(F.col("var_source").isNotNull(), binding_left_keys("var_source"))
    own = F.transform(F.filter(template_tokens("var_structure"), lambda t: token_table(t) == F.lit(RECIPIENT_TABLE)), token_column)
    variables = content.select("var_source", "var_structure").distinct()  # parsed once each, not once a content row
    attributes = variables.select(F.explode(F.array_union(F.coalesce(left, F.array().cast("array<string>")), own)).alias("c")).filter("c <> ''").distinct()
    specs = lookup_requirements(content).groupBy("table_name", "left_keys", "right_keys").agg(F.array_sort(F.collect_set("column_name")).alias("columns"))
    lookups = [LookupSpec(r.table_name, tuple(r.left_keys), tuple(r.right_keys), tuple(r["columns"])) for r in specs.collect()]
    for s in lookups:
        if len(s.left) != len(s.right) or not s.left:
            raise ValueError(f"binding '{s.spec}' of table {s.table} joins {len(s.left)} recipient columns with {len(s.right)} key columns")
    return {
        "slots": sorted((int(r.slot_position), int(r.var_position)) for r in widths.collect()),
        "attributes": sorted(r.c for r in attributes.collect()),
        "lookups": sorted(lookups, key=lambda s: (s.table, s.left, s.right)),
    }


def missing_lookups(specs: list[LookupSpec], lookups: dict[str, DataFrame]) -> list[tuple[str, str]]:
    """D-10: (table, column) pairs that cannot be served: table absent, or a key
    or content column it lacks. The reference fails the run on any; so do we."""
    missing = []
    for s in specs:
        df = lookups.get(s.table)
        if df is None:
            missing.append((s.table, "*"))
            continue
        have = {c.lower() for c in df.columns}
        for c in (*s.right, *s.columns, "locale", "tpid", "eapid"):
            if c.lower() not in have:
                missing.append((s.table, c))
    return sorted(set(missing))


def scoped_lookup(table: DataFrame, spec: LookupSpec, scope: Scope, n: int) -> DataFrame:
    """Rows of the lookup in the run's scope, keys and values as text."""
    keys = [F.col(r).cast("string").alias(f"_lk{n}_k{i}") for i, r in enumerate(spec.right)]
    vals = [F.col(c).cast("string").alias(f"_lk{n}_v{j}") for j, c in enumerate(spec.columns)]
    return in_scope(normalize_locale(table), scope).select(*keys, *vals)


def prepare_lookup(scoped: DataFrame, spec: LookupSpec, n: int, rows: DataFrame | None = None, n_rows: int = 0, max_bytes: int = 0) -> DataFrame:
    """One row per key (D-8: deterministic survivor instead of the reference's
    arbitrary last row), with a mark that the key was found.

    With ``rows`` (``n_rows`` at most) the lookup is first cut down to the keys
    these rows ask for, by a Bloom filter of at most ``max_bytes``, so that other
    keys are neither deduplicated nor shuffled.
    """
    key_names = [f"_lk{n}_k{i}" for i in range(len(spec.right))]
    val_names = [f"_lk{n}_v{j}" for j in range(len(spec.columns))]
    blocks = bloom.blocks_for(n_rows, max_bytes) if rows is not None else None
    if blocks is not None:
        asked = rows.select(*[F.col(l).cast("string").alias(k) for l, k in zip(spec.left, key_names)])
        scoped = bloom.may_match(scoped, key_names, bloom.key_filter(asked, key_names, blocks), blocks)
    return (
        scoped.groupBy(*key_names)
        .agg(F.max(F.struct(*val_names)).alias("_row"))
        .select(*key_names, *[F.col("_row")[v].alias(v) for v in val_names], F.lit(True).alias(f"_lk{n}_hit"))
    )


def attach_values(
    rows: DataFrame,
    attributes: list[str],
    specs: list[LookupSpec],
    lookups: dict[str, DataFrame],
    scope: Scope,
    max_broadcast_rows: int = 2_000_000,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    cached: list | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """Add ``values: map<string,string>`` holding every recipient attribute
    (``traveler.<col>``) and every matched lookup value (``T.col@spec``).

    Keys are compared column by column as text (Q5: no separator-less
    concatenation); a null key never matches, and as the lookup has one row per
    key the number of rows never changes. ``cached`` collects the persisted
    lookups for a later release.

    ``n_rows``: how many rows ask, if known. A lookup whose table is above the
    broadcast bound is then filtered by the keys they ask for.
    """
    entries = [F.struct(F.lit(f"{RECIPIENT_TABLE}.{c}").alias("k"), F.col(c).cast("string").alias("v")) for c in attributes]
    helper_cols, asking = [], rows
    for n, spec in enumerate(specs):
        # Measured and joined from the cache: a database table is read once.
        scoped = scoped_lookup(lookups[spec.table], spec, scope, n).persist()
        if cached is not None:
            cached.append(scoped)
        size = measured_size(scoped)
        large = n_rows is not None and (size[0] > max_broadcast_rows or size[1] > max_broadcast_bytes)
        lk = prepare_lookup(scoped, spec, n, asking if large else None, n_rows or 0, max_broadcast_bytes)
        cond = [F.col(l).cast("string") == F.col(f"_lk{n}_k{i}") for i, l in enumerate(spec.left)]
        if len(spec.left) != len(spec.right) or not cond:
            raise ValueError(f"binding '{spec.spec}' of table {spec.table} has uneven key lists")
        rows = rows.join(broadcast_checked(lk, max_broadcast_rows, size, max_broadcast_bytes), cond, "left")
        hit = F.coalesce(F.col(f"_lk{n}_hit"), F.lit(False))
        for j, c in enumerate(spec.columns):
            key = f"{spec.table}.{c}@{spec.spec}"
            entries.append(F.when(hit, F.struct(F.lit(key).alias("k"), F.col(f"_lk{n}_v{j}").alias("v"))))
        helper_cols += [f"_lk{n}_k{i}" for i in range(len(spec.right))]
        helper_cols += [f"_lk{n}_v{j}" for j in range(len(spec.columns))] + [f"_lk{n}_hit"]
    values = F.map_from_entries(F.filter(F.array(*entries), lambda e: e.isNotNull())) if entries else F.create_map().cast(
        "map<string,string>"
    )
    return rows.withColumn("values", values).drop(*helper_cols)


def _rendered_candidate(cand, slot, texts, bucket, seed: int, mode: str):
    """Stage 1 for one candidate: every variable rendered, split and resolved once."""
    split = F.transform(
        cand["vars"],
        lambda v: F.struct(
            v["pos"].alias("pos"),
            ((slot == F.lit(1)) & (v["pos"] == F.lit(1))).alias("is_first"),
            (fill_options(v["template"], v["keyed"], texts) if mode == "compat" else fill_compiled(v["compiled"], texts)).alias("parts"),
        ),
    )
    return F.struct(
        cand["priority"].alias("priority"),
        cand["type_id"].alias("type_id"),
        cand["module_id"].alias("module_id"),
        cand["placement_type"].alias("placement_type"),
        cand["default_flag"].alias("default_flag"),
        resolve_parts(split, bucket, seed, mode).alias("vars"),
    )


def _scored_candidate(c, slot):
    """Stage 2 (I4): demote a hero/banner module with missing content to 9999;
    build the option trace ``#S{slot}_P{pos}.{att}``."""
    missing_any = F.exists(c["vars"], lambda x: x["missing"])
    demote = missing_any & c["placement_type"].isin(*PLACEMENTS_DEMOTABLE) & F.coalesce(c["default_flag"] == 0, F.lit(False))
    att_option = F.aggregate(
        c["vars"],
        F.lit(""),
        lambda acc, x: F.concat(acc, F.lit("#S"), slot.cast("string"), F.lit("_P"), x["pos"].cast("string"), F.lit("."), x["att"]),
    )
    return F.struct(
        F.when(demote, F.lit(SUPPRESSED_PRIORITY)).otherwise(c["priority"]).alias("priority"),
        c["type_id"].alias("type_id"),
        c["module_id"].alias("module_id"),
        c["placement_type"].alias("placement_type"),
        c["default_flag"].alias("default_flag"),
        att_option.alias("att_option"),
        c["vars"].alias("vals"),
    )


def render_slots(rows: DataFrame, seed: int, mode: str = "compat") -> DataFrame:
    """Render every candidate of every slot of a content row (``rendered`` map).

    Candidate struct fields start with (priority, type, module id), so the
    fold's ``array_min`` picks the lowest priority, ties by type then id (Q4).
    """
    bucket = F.col("test_keys")

    def all_slots(texts):
        return F.transform_values(
            F.col("slot_cands"),
            lambda slot, cands: F.transform(
                F.transform(cands, lambda c: _rendered_candidate(c, slot, texts, bucket, seed, mode)),
                lambda c: _scored_candidate(c, slot),
            ),
        )

    return rows.withColumn("rendered", bound(value_texts("values", mode), all_slots))


def content_rows(
    keys: DataFrame,
    alloc: DataFrame,
    content: DataFrame,
    mode: str = "compat",
    max_broadcast_rows: int = 2_000_000,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    known: tuple[int, int] | None = None,
    alloc_size: tuple[int, int] | None = None,
    heavy: list[str] | None = None,
) -> DataFrame:
    """C11: content keys with their cohort's candidates and what these say (left
    join: a cohort without any candidate still gets a row, all slots ``dummy``)."""
    rows = keys.join(broadcast_checked(alloc, max_broadcast_rows, alloc_size, max_broadcast_bytes), COHORT_KEYS, "left")
    return with_modules(rows, content, mode, max_broadcast_rows, known, heavy)
