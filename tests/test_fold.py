"""Hand-built rows for the slot fold, rendering and suppression."""

from pyspark.sql import functions as F

from slotwise.functions import templates
from slotwise.operators import campaigns, render, slots

VAR_T = (
    "struct<pos:int,binding:string,template:string,tokens:array<string>,spec:string,"
    "keyed:array<struct<token:string,key:string>>>"
)
CAND_T = f"struct<priority:int,type_id:int,module_id:int,placement_type:string,default_flag:int,vars:array<{VAR_T}>>"
ROW_T = f"test_keys int, priority int, values map<string,string>, slot_cands map<int,array<{CAND_T}>>"
SEED = 11


def var(pos, template, tokens=()):
    # value-map key of a token: recipient attributes by name, lookups by token@spec
    keyed = [(t, t if t.startswith("traveler.") else t + "@|") for t in tokens]
    return (pos, None, template, list(tokens), "|", keyed)


def cand(prio, type_id, mid, placement="hero", default=1, vars_=None):
    return (prio, type_id, mid, placement, default, vars_ or [var(1, "d|A"), var(2, "d|B")])


def run_fold(spark, rows, slot_list, compat=False, mode="compat"):
    df = spark.createDataFrame(rows, ROW_T)
    if mode == "strict":  # as the configuration side carries it
        compiled = lambda v: templates.keyed(templates.compiled(v["template"]), v["spec"])
        with_compiled = lambda c: c.withField("vars", F.transform(c["vars"], lambda v: v.withField("compiled", compiled(v))))
        df = df.withColumn("slot_cands", F.transform_values("slot_cands", lambda _, cands: F.transform(cands, with_compiled)))
    r = render.render_slots(df, SEED, mode)
    f = slots.fill_slots(r, slot_list)
    return f.select("test_keys", *slots.personalise_columns(slot_list, compat)).collect()


def test_exclusion_dummy_and_pixel(spark):
    both = cand(1, 1, 101)
    rows = [(0, 3, {}, {1: [both], 2: [both], 4: [both, cand(2, 1, 102)]})]
    (r,) = run_fold(spark, rows, [(1, 2), (2, 2), (3, 2), (4, 2)])
    assert r.S1_module_id == 101
    assert (r.S2_module_id, r.S2_module_priority, r.S2_P1) == (999, "pixel_module", "None")
    assert (r.S3_module_id, r.S3_module_priority, r.S3_att_option, r.S3_P2) == (999, "dummy", "dummy", "None")
    assert r.S4_module_id == 102
    assert r.OmniExtension == "1.101_2.999_3.999_4.102"
    assert r.OmniExtNewFormat == "1-101_2-999_3-999_4-102"
    assert r.campaign_priority == 3


def test_lowest_priority_then_type_then_id(spark):
    rows = [(0, 2, {}, {1: [cand(2, 1, 105), cand(1, 3, 104), cand(1, 2, 107), cand(1, 2, 106)]})]
    (r,) = run_fold(spark, rows, [(1, 2)])
    assert (r.S1_module_id, r.S1_module_priority, r.S1_module_type_id) == (106, "1", "2")


def test_banner_emptied_and_module_reusable(spark):
    missing = [var(1, "d|value %%traveler.x%%", ["traveler.x"]), var(2, "d|ok")]
    banner = cand(1, 1, 201, "banner", 0, missing)
    rows = [(0, 4, {"traveler.x": ""}, {2: [banner], 3: [cand(1, 1, 201, "hero", 1)]})]
    (r,) = run_fold(spark, rows, [(2, 2), (3, 2)])
    assert (r.S2_module_id, r.S2_module_priority, r.S2_P1, r.S2_P2) == (999, "9999", "None", "None")
    assert r.S2_att_option == "#S2_P1.default#S2_P2.0"
    assert r.S3_module_id == 201  # the emptied banner does not block its module
    assert r.campaign_priority == 4


def test_hero_escalates_campaign(spark):
    missing = [var(1, "d|%%traveler.x%%", ["traveler.x"])]
    rows = [(0, 2, {"traveler.x": None}, {2: [cand(1, 1, 301, "hero", 0, missing)]})]
    (r,) = run_fold(spark, rows, [(2, 1)])
    assert (r.S2_module_id, r.S2_module_priority, r.S2_P1) == (301, "9999", "None")
    assert r.campaign_priority == 9999


def test_default_module_is_not_demoted(spark):
    missing = [var(1, "d|%%traveler.x%%", ["traveler.x"])]
    rows = [(0, 2, {"traveler.x": ""}, {2: [cand(1, 1, 302, "hero", 1, missing)]})]
    (r,) = run_fold(spark, rows, [(2, 1)])
    assert (r.S2_module_priority, r.campaign_priority) == ("1", 2)


def test_subject_line_keeps_default_text(spark):
    vars_ = [var(1, "Plain subject"), var(2, "no options")]
    rows = [(0, 1, {}, {1: [cand(1, 1, 401, "subject", 0, vars_)]})]
    (r,) = run_fold(spark, rows, [(1, 2)])
    assert (r.S1_P1, r.S1_P2, r.S1_att_option) == ("Plain subject", "None", "#S1_P1.default#S1_P2.default")


def test_negative_bucket_and_value_with_separator(spark):
    vars_ = [var(1, "d|a|b|c"), var(2, "d|%%traveler.x%%", ["traveler.x"])]
    rows = [(-7, 1, {"traveler.x": "p|q"}, {1: [cand(1, 1, 501, "subject", 1, vars_)]})]
    (r,) = run_fold(spark, rows, [(1, 2)])
    i = (-7 + SEED % 3) % 3
    assert r.S1_P1 == ["a", "b", "c"][i]
    # compat (Q20): the value is substituted before options are split -> "d|p|q" has 3 parts
    j = (-7 + SEED % 2) % 2
    assert r.S1_P2 == ["p", "q"][j]


def test_trace_with_slot_gaps(spark):
    rows = [(0, 1, {}, {1: [cand(1, 1, 11)], 3: [cand(1, 1, 13)], 5: [cand(1, 1, 15)]})]
    slot_list = [(1, 2), (3, 2), (5, 2)]
    (ours,) = run_fold(spark, rows, slot_list)
    (compat,) = run_fold(spark, rows, slot_list, compat=True)
    assert ours.OmniExtension == "1.11_3.13_5.15"
    assert compat.OmniExtension == "1.11_3.135.15"


def test_backfill_binding_modes(spark):
    rows = [
        (1, "c", 1, "traveler.a|T.k", "t"), (1, "c", 2, "", "t"),       # one binding, shared
        (2, "c", 1, "traveler.a|T.k", "t"), (2, "c", 2, "traveler.a|T.k", "t"),  # identical bindings
        (3, "c", 1, "traveler.a|T.k", "t"), (3, "c", 2, "traveler.b|U.k", "t"),  # two different bindings
        (4, None, 1, "traveler.z|Z.k", "t"),                             # null connection
    ]
    df = spark.createDataFrame(rows, "module_id int, source_connection string, var_position int, var_source string, var_structure string")
    ours = campaigns.backfill_binding(df).groupBy("module_id").count().orderBy("module_id").collect()
    compat = campaigns.backfill_binding(df, compat=True).groupBy("module_id").count().orderBy("module_id").collect()
    assert [r["count"] for r in ours] == [2, 2, 4, 1]
    assert [r["count"] for r in compat] == [2, 4, 4, 1]
    own = campaigns.backfill_binding(df).filter("module_id = 4").first().var_source
    lost = campaigns.backfill_binding(df, compat=True).filter("module_id = 4").first().var_source
    assert (own, lost) == ("traveler.z|Z.k", None)


def test_strict_substitution_keeps_options(spark):
    """Q20 strict: a value holding ``|`` stays inside its option, and token text
    outside ``%%`` is left alone."""
    vars_ = [var(1, "d|a|b|c"), var(2, "d|%%traveler.x%% not traveler.x", ["traveler.x"])]
    rows = [(0, 1, {"traveler.x": "p|q"}, {1: [cand(1, 1, 601, "subject", 1, vars_)]})]
    (r,) = run_fold(spark, rows, [(1, 2)], mode="strict")
    assert r.S1_P2 == "p|q not traveler.x"
    # compat: "d|p|q not p|q" after substitution -> 4 parts, option (0 + 11 % 3) % 3 = 2
    (c,) = run_fold(spark, rows, [(1, 2)], mode="compat")
    assert c.S1_P2 == "q"
