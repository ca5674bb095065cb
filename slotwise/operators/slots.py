"""The ordered slot fold — I3, I5, H15–H17.

Slots are filled in ascending order; a module used in an earlier slot cannot
be used again. The fold is one ``aggregate`` over the launch-wide slot list,
carrying (used ids, picks, escalated) — a row-local expression, so it adds no
exchange and runs in the task that holds the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions.text import NONE_TEXT
from slotwise.operators.allocate import bound
from slotwise.operators.render import SUPPRESSED_PRIORITY

# Fixed values (must equal the reference's): placeholder module id, and the
# labels of a slot with no allocation and of a slot whose candidates were all used.
PLACEHOLDER_ID = 999
DUMMY = "dummy"
PIXEL = "pixel_module"

PICK_TYPE = (
    "struct<slot:int,module_id:int,module_priority:string,module_type_id:string,att_option:string,P:array<string>>"
)


def _placeholder(slot: Column, width: Column, label: str) -> Column:
    return F.struct(
        slot.alias("slot"),
        F.lit(PLACEHOLDER_ID).alias("module_id"),
        F.lit(label).alias("module_priority"),
        F.lit(label).alias("module_type_id"),
        F.lit(label).alias("att_option"),
        F.array_repeat(F.lit(NONE_TEXT), width).alias("P"),
    )


def _values_by_position(vals: Column, width: Column) -> Column:
    """``S{slot}_P1..P{width}``: value of the (last) variable at each position, else ``''``."""
    return F.transform(
        F.sequence(F.lit(1), width),
        lambda i: F.coalesce(F.try_element_at(F.filter(vals, lambda x: x["pos"] == i), F.lit(-1))["value"], F.lit("")),
    )


def _real_pick(best: Column, slot: Column, width: Column) -> Column:
    """Winner of a slot (I5): a winner still at 9999 with ``default = 0``
    escalates — ``banner`` empties the slot (id 999, variables ``None``),
    ``hero`` flags the campaign for suppression."""
    at_9999 = (best["priority"] == F.lit(SUPPRESSED_PRIORITY)) & F.coalesce(best["default_flag"] == 0, F.lit(False))
    empty_banner = at_9999 & (best["placement_type"] == F.lit("banner"))
    pick = F.struct(
        slot.alias("slot"),
        F.when(empty_banner, F.lit(PLACEHOLDER_ID)).otherwise(best["module_id"]).alias("module_id"),
        best["priority"].cast("string").alias("module_priority"),
        best["type_id"].cast("string").alias("module_type_id"),
        best["att_option"].alias("att_option"),
        F.when(empty_banner, F.array_repeat(F.lit(NONE_TEXT), width)).otherwise(_values_by_position(best["vals"], width)).alias("P"),
    )
    return F.struct(pick.alias("pick"), (at_9999 & (best["placement_type"] == F.lit("hero"))).alias("hero"))


def fill_slots(rows: DataFrame, slots: list[tuple[int, int]]) -> DataFrame:
    """I3 + I5: pick one module per slot.

    Per slot: no allocation → ``dummy``; all candidates used earlier →
    ``pixel_module``; else the lowest (priority, type, id). A winner still at
    9999 with ``default = 0`` escalates: ``hero`` suppresses the campaign
    (priority 9999), ``banner`` empties the slot (id 999, variables ``None``)
    — and then does not block its module from a later slot.
    """
    slot_meta = F.array(*[F.struct(F.lit(s).alias("slot"), F.lit(w).alias("width")) for s, w in slots])
    init = F.struct(
        F.array().cast("array<int>").alias("used"),
        F.array().cast(f"array<{PICK_TYPE}>").alias("picks"),
        F.lit(False).alias("escalated"),
    )

    def choose(acc, slot, width, cands):
        avail = F.filter(cands, lambda c: ~F.array_contains(acc["used"], c["module_id"]))
        return bound(
            F.array_min(avail),  # null where none is left
            lambda best: F.when(cands.isNull(), F.struct(_placeholder(slot, width, DUMMY).alias("pick"), F.lit(False).alias("hero")))
            .when(best.isNull(), F.struct(_placeholder(slot, width, PIXEL).alias("pick"), F.lit(False).alias("hero")))
            .otherwise(_real_pick(best, slot, width)),
        )

    def step(acc, s, rendered):
        slot, width = s["slot"], s["width"]
        return bound(
            choose(acc, slot, width, F.try_element_at(rendered, slot)),
            lambda r: F.struct(
                F.array_append(acc["used"], r["pick"]["module_id"]).alias("used"),
                F.array_append(acc["picks"], r["pick"]).alias("picks"),
                (acc["escalated"] | r["hero"]).alias("escalated"),
            ),
        )

    # ``rendered`` is bound around the fold: as a column inside the lambda it would be
    # inlined by CollapseProject and evaluated for every slot, and as part of the state
    # every step would copy all candidates of all slots.
    folded = bound(F.col("rendered"), lambda rendered: F.aggregate(slot_meta, init, lambda acc, s: step(acc, s, rendered)))
    return rows.withColumn("_fold", folded)


def omni_extension(picks: Column, number_slots: int, compat: bool = False) -> Column:
    """``1.101_2.202``. Compat reproduces the reference's separator rule
    (none after a slot whose number reaches the slot count, Q15)."""
    if compat:
        return F.aggregate(
            picks,
            F.lit(""),
            lambda acc, p: F.concat(
                acc, p["slot"].cast("string"), F.lit("."), p["module_id"].cast("string"),
                F.when(p["slot"] < F.lit(number_slots), F.lit("_")).otherwise(F.lit("")),
            ),
        )
    return F.array_join(F.transform(picks, lambda p: F.concat(p["slot"].cast("string"), F.lit("."), p["module_id"].cast("string"))), "_")


def slot_columns(slots: list[tuple[int, int]], picks: Column) -> list[Column]:
    """The wide output contract ``S{slot}_P{v}``, ``_module_id``, ``_module_priority``,
    ``_module_type_id``, ``_att_option``."""
    cols = []
    for i, (s, w) in enumerate(slots):
        p = picks[i]
        cols += [p["P"][v - 1].alias(f"S{s}_P{v}") for v in range(1, w + 1)]
        cols += [
            p["module_priority"].alias(f"S{s}_module_priority"),
            p["module_id"].alias(f"S{s}_module_id"),
            p["att_option"].alias(f"S{s}_att_option"),
            p["module_type_id"].alias(f"S{s}_module_type_id"),
        ]
    return cols


def personalise_columns(slots: list[tuple[int, int]], compat: bool = False) -> list[Column]:
    """Wide slot columns + trace + campaign priority (max over slots)."""
    picks = F.col("_fold")["picks"]
    trace = omni_extension(picks, len(slots), compat)
    prio = F.col("priority").cast("int")
    return slot_columns(slots, picks) + [
        trace.alias("OmniExtension"),
        F.replace(trace, F.lit("."), F.lit("-")).alias("OmniExtNewFormat"),
        F.when(F.col("_fold")["escalated"], F.greatest(prio, F.lit(SUPPRESSED_PRIORITY))).otherwise(prio).alias("campaign_priority"),
    ]
