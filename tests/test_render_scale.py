"""Rendering and expansion on many tasks, without copies of all candidates in the fold."""

from collections import Counter

from pyspark.sql import functions as F

from slotwise.operators import allocate, campaigns, skew, slots
from slotwise.plans.fixture_run import fixture_params

CONTENT = (
    "campaign_id string, slot_position int, segment_type_id int, module_type_id int, module_priority_in_slot int, module_id int, version int, "
    "ttl_versions int, placement_type string, module_type string, `default` string, var_position int, var_source string, var_structure string"
)
ROWS = "campaign_id string, id int, slot_cands map<int, array<struct<priority: int, type_id: int, module_id: int, at: int>>>"


def content(spark):
    rows = [(str(c), 1, 1, 1, 1, 100 + c, 1, 1, "hero", "t", "0", v, "", f"x|option {c}") for c in range(6) for v in (1, 2)]
    return spark.createDataFrame(rows, CONTENT)


def test_rows_are_rendered_in_the_given_number_of_partitions(spark):
    """Few bytes: the run-time coalescing alone would leave them to one task. One campaign has most rows, one none."""
    campaign = lambda i: "0" if i % 3 else str(i % 7)
    rows = spark.createDataFrame([(campaign(i), i, {1: [(1, 1, 100 + int(campaign(i)), 0)]}) for i in range(600)] + [(None, 600, None)], ROWS)
    large = (10**9, 10**12)
    plain = allocate.with_modules(rows, content(spark), known=(12, 1000))
    asked = allocate.with_modules(rows, content(spark), known=large)
    spread = allocate.with_modules(rows, content(spark), known=large, heavy=["0"])
    text = lambda df: sorted(tuple(r) for r in df.select(F.col("id").cast("string"), F.coalesce(F.to_json("slot_cands"), F.lit(""))).collect())
    assert text(plain) == text(asked) == text(spread) and len(text(plain)) == 601
    least = skew.busy_partitions(rows) // 2  # the session's own number, where the other side of the join has that
    assert asked.rdd.getNumPartitions() >= least and spread.rdd.getNumPartitions() >= least
    sizes = Counter(r.p for r in spread.select(F.spark_partition_id().alias("p")).collect())
    assert max(sizes.values()) < 200  # the large campaign's 400 rows and more do not lie together


def test_fold_state_holds_no_candidates(spark):
    kind = (
        "id int, rendered map<int, array<struct<priority: int, type_id: int, module_id: int, placement_type: string, "
        "default_flag: int, att_option: string, vals: array<struct<pos: int, value: string>>>>>"
    )
    cand = lambda m: (1, 1, m, "hero", 1, "", [(1, f"text {m}")])
    rows = spark.createDataFrame([(1, {1: [cand(5), cand(6)], 2: [cand(5)], 3: [cand(6), cand(5)]}), (2, None)], kind)
    folded = slots.fill_slots(rows, [(1, 1), (2, 1), (3, 1), (4, 1)])
    assert "rendered" not in folded.schema["_fold"].dataType.names
    got = {r.id: [(p.module_id, p.module_priority, p.P[0]) for p in r["_fold"].picks] for r in folded.collect()}
    none = lambda label: (slots.PLACEHOLDER_ID, label, "None")
    assert got[1] == [(5, "1", "text 5"), none(slots.PIXEL), (6, "1", "text 6"), none(slots.DUMMY)]
    assert got[2] == [none(slots.DUMMY)] * 4


def test_metadata_is_expanded_in_many_tasks(spark):
    """The campaigns' file is small at any size: one task would expand all of them."""
    n = 200
    empty = lambda kind: spark.createDataFrame([], kind)
    launch = fixture_params().launch_date
    cfg = campaigns.CampaignConfig(
        campaigns=spark.range(0, n, 1, 1).selectExpr(
            "cast(id as string) campaign_id", "'en_us' locale", f"'{launch}' LaunchDate", "0 campaign_deleted_flag", "1 tpid", "0 eapid",
            "1 template_id", "1 segment_module_map_id", "1 campaign_segment_type_id",
        ),
        templates=spark.range(1).selectExpr("1 template_id", "0 template_deleted_flag"),
        segment_modules=spark.range(0, 3, 1, 1).selectExpr(
            "1 segment_module_map_id", "cast(id as int) slot_position", "'hero' placement_type", "1 module_type_id", "'email' channel",
            "1 segment_type_id", "0 seg_mod_deleted_flag",
        ),
        module_defs=spark.range(1).selectExpr(
            "'EN_us' locale", "1 tpid", "0 eapid", "'email' channel", "'hero' placement_type", "1 module_type_id", "7 module_id", "'active published' status",
        ),
        segment_defs=spark.range(1).selectExpr("1 tpid", "0 eapid", "1 segment_type_id", "0 segment_deleted_flag"),
        module_vars=empty("module_id int"),
    )
    meta = campaigns.expand_campaigns(cfg, fixture_params())
    assert meta.count() == 3 * n
    assert meta.select(F.spark_partition_id()).distinct().count() > 1
