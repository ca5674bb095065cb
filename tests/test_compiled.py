"""Compiled templates (H4, H5) and allocation by bitmaps (I1) against plain Python."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slotwise.functions import templates
from slotwise.operators import allocate
from slotwise.plans.fixture_run import fixture_run
from tests.conftest import SMALL


def compiled(text):
    options, pieces = [[]], (text or "").split("%%")
    for i, piece in enumerate(pieces):
        if i % 2 and i < len(pieces) - 1 and "|" not in piece:
            options[-1].append((None, piece))
            continue
        first, *more = piece.split("|")
        options[-1].append((first, None))
        options += [[(m, None)] for m in more]
    return options


CASES = [None, "", "plain", "a|b|c", "x %%t.a%% y|%%t.b%%", "%%t.a%%%%t.b%%", "odd %%t.a", "%%a|b%% z %%c.d%%", "%%%%", "|", "%%t.a%%|", "a%%|%%b\nc %%x.y%%"]


def test_templates_are_cut_like_the_plain_rule(spark):
    df = spark.createDataFrame([(c,) for c in CASES], "t string").select("t", templates.compiled("t").alias("o"))
    for r in df.collect():
        assert [[tuple(s) for s in o] for o in r.o] == compiled(r.t), r.t


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab.|%", max_size=14), min_size=1, max_size=8))
def test_any_text_is_cut_like_the_plain_rule(spark, texts):
    df = spark.createDataFrame([(c,) for c in texts], "t string").select("t", templates.compiled("t").alias("o"))
    for r in df.collect():
        assert [[tuple(s) for s in o] for o in r.o] == compiled(r.t), r.t


def test_values_are_not_read_as_templates(spark):
    """A value with marks, separators or another token's text stays as it is."""
    row = spark.createDataFrame([("d|%%traveler.a%% and %%traveler.b%%|%%T.x%%|%%traveler.none%%",)], "t string")
    values = F.create_map(*[F.lit(x) for x in ("traveler.a", "%%traveler.b%% | 5%%", "traveler.b", "B", "T.x@k|k", "X")])
    parts = templates.render_compiled(templates.keyed(templates.compiled("t"), F.lit("k|k")), values)
    assert row.select(parts.alias("p")).first().p == ["d", "%%traveler.b%% | 5%% and B", "X", "value_not_found"]


def test_strict_rendering_nests_no_replace(spark):
    run = fixture_run(spark, SMALL, missing="strict")
    plan = run._render(run.content_keys)._jdf.queryExecution().optimizedPlan().toString()
    assert "replace(" not in plan and "array_join(" in plan


def plain_allocation(cohorts, offers, seed):
    out = set()
    for campaign, bucket, segments in cohorts:
        best = {}
        ids = {int(s) for s in segments.split("#")} if segments else set()
        for c, slot, seg, kind, priority, module, version, versions in offers:
            if c == campaign and seg in ids and version == (bucket + seed % versions) % versions + 1:
                key = slot, kind, priority
                best[key] = max(best.get(key, module), module)
        out |= {(campaign, bucket, segments, *k, m) for k, m in best.items()}
    return out


def test_allocation_equals_the_plain_loop(spark):
    """More than 64 offers a campaign, so that bitmaps have several words."""
    rnd = random.Random(7)
    offers = {
        (c, rnd.randint(1, 4), rnd.randint(1, 9), rnd.randint(1, 3), rnd.randint(1, 3), rnd.randint(1, 60), rnd.randint(1, 3), 3)
        for c in ("1", "2", "3") for _ in range(300)
    }
    content = spark.createDataFrame(
        [(*o[:4], "hero", *o[4:], 1) for o in offers],
        "campaign_id string, slot_position int, segment_type_id int, module_type_id int, placement_type string, module_priority_in_slot int,"
        " module_id int, version int, ttl_versions int, var_position int",
    )
    lists = ["1", "2#3", "9#9#8", "4#77", "77", "5#6#7#8#1", None]
    cohorts = [(c, b, s) for c in ("1", "2", "3", "4") for b in (0, 5, -7) for s in lists]
    df = spark.createDataFrame(cohorts, "campaign_id string, test_keys int, segment_type_id string")
    got = allocate.allocate_modules(df, content, 11).collect()
    want = plain_allocation(cohorts, offers, 11)
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 500
    index = allocate.module_index(content).collect()
    assert all(len(r.offers) > 64 and all(len(b) == (len(r.offers) + 63) // 64 for b in r["index"].values()) for r in index)
    per_slot = allocate.allocation(df, content, 11).select("*", F.explode("slot_cands").alias("slot", "cands")).collect()
    again = {(r.campaign_id, r.test_keys, r.segment_type_id, r.slot, c.type_id, c.priority, c.module_id) for r in per_slot for c in r.cands}
    assert again == want and all(list(r.cands) == sorted(r.cands) for r in per_slot)


def test_a_cohort_is_allocated_in_its_own_row(spark):
    """No exchange between the cohorts and their candidates, and no text in them."""
    run = fixture_run(spark, SMALL)
    cohorts = spark.createDataFrame(run.cohorts.limit(3).collect(), run.cohorts.schema)
    alloc = allocate.allocation(cohorts, run.content, 11, 2_000_000, (10, 10))
    plan = alloc._jdf.queryExecution().executedPlan().toString()
    probe = plan[: plan.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in probe and "hashpartitioning" not in probe and "Generate" not in plan
    assert "vars" not in alloc.schema.simpleString() and "template" not in alloc.schema.simpleString()
