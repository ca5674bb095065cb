"""Randomised checks of the scalar rules against a plain-Python model."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slotwise.functions import rotation as R
from slotwise.functions import text as T

SEED = 11
PART = st.text(alphabet="abNnaoeul|%_ ", min_size=0, max_size=8)


def model_choose(text, bucket, first):
    parts = text.split("|")
    n = len(parts)
    if n > 2:
        i = (bucket + SEED % (n - 1)) % (n - 1)
        value, att = parts[1:][i], str(i)
    elif n == 2:
        value, att = parts[1], "0"
    else:
        value, att = (parts[0] if first else "None"), "default"
    x = value
    missing = any(m in x.lower() for m in ("value_not_found", "none", "null")) or "NaN" in x or "nan" in x
    if missing:
        value, att = (parts[0] if first else "None"), "default"
    return value, att, missing


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.lists(PART, min_size=1, max_size=5).map("|".join), st.integers(-300, 300), st.booleans()), min_size=1, max_size=60))
def test_resolve_variable_matches_model(spark, cases):
    df = spark.createDataFrame(cases, "t string, k int, f boolean")
    one = F.array(F.struct(F.lit(1).alias("pos"), F.col("f").alias("is_first"), T.options("t").alias("parts")))
    got = df.select(F.get(T.resolve_parts(one, F.col("k"), SEED, "compat"), 0).dropFields("pos").alias("r")).collect()
    assert [tuple(r.r) for r in got] == [model_choose(t, k, f) for t, k, f in cases]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-10_000, 10_000), st.integers(0, 60), st.integers(1, 9)), min_size=1, max_size=60))
def test_pick_version_matches_model(spark, cases):
    df = spark.createDataFrame(cases, "b int, s int, v int")
    got = [r[0] for r in df.select(R.pick_version(F.col("b"), F.col("s"), F.col("v"))).collect()]
    assert got == [((b + s % v) % v) + 1 for b, s, v in cases]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab%.c|x\n", max_size=14), min_size=1, max_size=60))
def test_token_pairing_matches_model(spark, cases):
    def model(s):
        z = [m.start() for m in re.finditer("%%", s)]
        return [s[z[j] + 2 : z[j + 1]] for j in range(0, len(z) - 1, 2)]

    from slotwise.functions.bindings import template_tokens

    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [list(r[0]) for r in df.select(template_tokens("s")).collect()]
    assert got == [model(c) for c in cases]
