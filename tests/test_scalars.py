"""Hand-computed rows for the scalar expressions."""

import datetime as dt

from pyspark.sql import functions as F

from slotwise.config import RunParams, Scope
from slotwise.functions import bindings as B
from slotwise.functions import keys as K
from slotwise.functions import rotation as R
from slotwise.functions import text as T


def one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_binding_parts(spark):
    rows = [("traveler.a;traveler.b|T.k1;T.k2",), ("traveler.x",), (None,), ("traveler.a|T.k",), ("",)]
    df = spark.createDataFrame(rows, "b string")
    got = df.select(
        B.binding_table("b").alias("t"),
        F.array_join(B.binding_left_keys("b"), ",").alias("l"),
        F.array_join(B.binding_right_keys("b"), ",").alias("r"),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("T", "a,b", "k1,k2"),
        (None, "x", ""),
        (None, "", ""),
        ("T", "a", "k"),
        (None, "", ""),
    ]


def test_template_tokens_pairing(spark):
    rows = [("a %%x.y%% b %%T.c%%",), ("no tokens",), ("odd %% only",), (None,), ("%%%x%%",), ("line\n%%t.a\nb%%",)]
    got = one(spark, F.array_join(B.template_tokens("s"), "|"), "s string", rows)
    assert got == ["x.y|T.c", "", "", "", "%x", "t.a\nb"]


def test_rotation_seed_matches_python(spark):
    days = [dt.date(2019, 12, 30) + dt.timedelta(days=i) for i in range(0, 800, 7)] + [dt.date(2021, 1, 3), dt.date(2020, 12, 31)]
    got = one(spark, R.rotation_seed(F.col("d")), "d date", [(d,) for d in days])
    assert got == [d.isocalendar()[1] + d.weekday() for d in days]
    assert RunParams(Scope("en_us", 1, 0), "2024-03-05").rotation_seed() == 11


def test_pick_version_floored_modulus(spark):
    rows = [(-7, 3, 3), (5, 11, 3), (0, 0, 1), (99, 11, 4)]
    got = one(spark, R.pick_version(F.col("b"), F.col("s"), F.col("v")), "b int, s int, v int", rows)
    assert got == [((b + s % v) % v) + 1 for b, s, v in rows]


def test_choose_option(spark):
    seed = 11
    rows = [("d|a|b|c", 4, False), ("d|only", 5, False), ("single", 1, True), ("single", 1, False), ("", 0, False), ("d||x|", -3, False)]
    df = spark.createDataFrame(rows, "t string, k int, first boolean")
    got = df.select(T.choose_option(F.col("t"), F.col("k"), seed, F.col("first")).alias("c")).collect()

    def py(t, k, first):
        parts = t.split("|")
        n = len(parts)
        if n > 2:
            i = (k + seed % (n - 1)) % (n - 1)
            return parts[1:][i], str(i)
        if n == 2:
            return parts[1], "0"
        return (parts[0] if first else "None"), "default"

    assert [tuple(r.c) for r in got] == [py(*r) for r in rows]


def test_missing_modes(spark):
    rows = [("Banana coast",), ("finance",), ("annulled",), ("NAN",), ("value_not_found here",), ("None",), ("ok",), (None,), ("NoNe",)]
    compat = one(spark, T.is_missing("v", "compat"), "v string", rows)
    strict = one(spark, T.is_missing("v", "strict"), "v string", rows)
    assert compat == [True, True, True, False, True, True, False, False, True]
    assert strict == [False, False, False, False, True, True, False, False, False]


def keyed(text, spec=""):
    return F.transform(B.template_tokens(text), lambda t: F.struct(t.alias("token"), T.value_key(t, F.lit(spec)).alias("key")))


def test_render_replaces_tokens_in_order(spark):
    df = spark.createDataFrame([("Hi %%traveler.name%%|Go %%L.city%% or %%L.zip%%", "Ann", "Oslo")], "t string, name string, city string")
    values = F.create_map(F.lit("traveler.name"), F.col("name"), F.lit("L.city@k|k"), F.col("city"))
    got = df.select(T.render_keyed("t", keyed("t", "k|k"), values, "compat").alias("r")).first().r
    assert got == "Hi Ann|Go Oslo or value_not_found"


def test_render_null_and_empty(spark):
    df = spark.createDataFrame([("a %%traveler.x%%", None), ("a %%traveler.x%%", ""), (None, "v")], "t string, x string")
    values = F.create_map(F.lit("traveler.x"), F.col("x"))
    got = [r.r for r in df.select(T.render_keyed("t", keyed("t"), values, "compat").alias("r")).collect()]
    assert got == ["a None", "a value_not_found", ""]
    got_strict = [r.r for r in df.select(T.render_keyed("t", keyed("t"), values, "strict").alias("r")).collect()]
    assert got_strict[0] == "a value_not_found"


def test_locale_and_paths(spark):
    df = spark.createDataFrame([("en_nz",), ("fr_fr",)], "l string")
    lp = df.select(K.locale_parts("l").alias("p")).collect()
    assert [tuple(r.p) for r in lp] == [("en", "NZ", "en_NZ"), ("fr", "FR", "fr_FR")]
    p = spark.range(1).select(K.dated_path("/x/", "2024-03-05").alias("p")).first().p
    assert p == "/x/2024/03/05"


def test_null_literals_strings_only(spark):
    df = spark.createDataFrame([("None", 5, "x"), ("a", None, "None")], "a string, n int, b string")
    got = K.null_literals(df).collect()
    assert [tuple(r) for r in got] == [(None, 5, "x"), ("a", None, None)]


def test_status_flag_and_click_token(spark):
    df = spark.createDataFrame([("Active",), ("Closed",), (None,)], "s string")
    assert one(spark, K.status_flag("s"), "s string", [("Active",), ("Closed",), (None,)]) == ["1", "0", "0"]
    assert [r[0] for r in df.select(K.click_token("s")).collect()] == ["emailclick/Active/", "emailclick/Closed/", None]


def test_segment_ids(spark):
    assert one(spark, K.segment_ids("s"), "s string", [("3#7#9",)]) == [[3, 7, 9]]
