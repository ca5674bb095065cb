"""Template rendering and option choice — H5, H6, H9, H15, H16.

Everything here is an expression over one row, so it runs inside the row's
task with no shuffle; the per-candidate, per-variable loops of the reference
become ``transform``/``aggregate`` over arrays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotwise.functions.bindings import RECIPIENT_TABLE, token_column, token_table
from slotwise.functions.rotation import rotate

# Fixed texts and patterns (must equal the reference's).
MISSING_TEXT = "value_not_found"
NONE_TEXT = "None"
OPTION_SEPARATOR = "|"
DEFAULT_ATT = "default"
# Reference empty-content test: case-insensitive value_not_found / none / null,
# case-sensitive NaN / nan, all as substrings.
COMPAT_MISSING_PATTERN = "(?i:value_not_found|none|null)|NaN|nan"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def value_key(token, spec) -> Column:
    """Key of a token's value in a row's ``values`` map.

    Recipient attributes are keyed ``traveler.<col>``; lookup values
    ``<TABLE.col>@<left keys>|<right keys>`` so that one table bound through
    two different key sets keeps both.
    """
    t = _c(token)
    return F.when(
        token_table(t) == F.lit(RECIPIENT_TABLE), F.concat(F.lit(RECIPIENT_TABLE + "."), token_column(t))
    ).otherwise(F.concat(t, F.lit("@"), _c(spec)))


def value_texts(values, mode: str = "compat") -> Column:
    """The value map as texts, made once a row: tokens then look up no more than their key.

    An empty value is the missing marker. A null value prints as ``None`` in
    compat mode (the reference's ``str(None)``), as the marker in strict.
    """
    null_text = NONE_TEXT if mode == "compat" else MISSING_TEXT
    return F.transform_values(_c(values), lambda _, v: F.when(v == F.lit(""), F.lit(MISSING_TEXT)).otherwise(F.coalesce(v, F.lit(null_text))))


def text_for_key(texts, key) -> Column:
    """Text of a key in ``value_texts``; the missing marker if it is not there."""
    return F.coalesce(F.try_element_at(_c(texts), key), F.lit(MISSING_TEXT))


def fill_keyed(template, keyed_tokens, texts) -> Column:
    """H5 with each token's value-map key already computed (configuration side):
    ``keyed_tokens`` is an array of struct(token, key)."""
    filled = F.aggregate(
        _c(keyed_tokens), F.coalesce(_c(template), F.lit("")), lambda acc, t: F.replace(acc, t["token"], text_for_key(texts, t["key"]))
    )
    return F.replace(filled, F.lit("%%"), F.lit(""))


def render_keyed(template, keyed_tokens, values, mode: str = "compat") -> Column:
    """``fill_keyed`` for one template of a row."""
    return fill_keyed(template, keyed_tokens, value_texts(values, mode))


def fill_options(template, keyed_tokens, texts) -> Column:
    """Rendered template already split into options (``array<string>``).

    As the reference (Q20): substitute every token's text wherever it occurs,
    drop ``%%``, then split — a value holding ``|`` adds options. The strict
    rule is :func:`slotwise.functions.templates.fill_compiled`.
    """
    return options(fill_keyed(template, keyed_tokens, texts))


def options(text) -> Column:
    return F.split(_c(text), r"\|", -1)


def choose_from_parts(parts, bucket, seed, is_first) -> Column:
    """H6 on already split options: struct(value, att).

    One part: the text itself for slot 1 variable 1, else ``None`` (att
    ``default``); two parts: the option (att 0); more: option
    ``(bucket + seed % (n-1)) % (n-1)`` (att = that index).
    """
    parts = _c(parts)
    n = F.size(parts)
    idx = rotate(bucket, seed, n - 1)
    single = F.when(_c(is_first), F.get(parts, 0)).otherwise(F.lit(NONE_TEXT))
    value = F.when(n > 2, F.get(parts, idx + 1)).when(n == 2, F.get(parts, 1)).otherwise(single)
    att = F.when(n > 2, idx.cast("string")).when(n == 2, F.lit("0")).otherwise(F.lit(DEFAULT_ATT))
    return F.struct(value.alias("value"), att.alias("att"))


def choose_option(text, bucket, seed, is_first) -> Column:
    """H6: struct(value, att) picked from ``default|option1|option2…``."""
    return choose_from_parts(options(text), bucket, seed, is_first)


def is_missing(col, mode: str = "compat") -> Column:
    """H9: does chosen content count as missing?

    ``compat``: the reference's substring test (``Banana`` contains ``nan``).
    ``strict``: only the pipeline's own markers — an unresolved token or the
    ``None`` placeholder of a template without options.
    """
    c = _c(col)
    if mode == "compat":
        return F.coalesce(c.rlike(COMPAT_MISSING_PATTERN), F.lit(False))
    return F.coalesce(c.contains(MISSING_TEXT) | (c == F.lit(NONE_TEXT)), F.lit(False))


def resolve_parts(split, bucket, seed, mode: str = "compat") -> Column:
    """H6 + H9 over an array of struct(pos, is_first, parts).

    Each step is its own ``transform`` reading the previous step's fields
    through the lambda variable, so an option is chosen once and tested once
    (re-using one Column object in several places would copy its whole
    expression into the plan and evaluate it again). A step copies what it
    hands on, so the options stay behind in the first.

    Result elements: struct(pos, value, att, missing). Missing content becomes
    ``None`` (slot 1 variable 1 keeps its default text) with att ``default``.
    """
    def pick(v: Column) -> Column:
        chosen = choose_from_parts(v["parts"], bucket, seed, v["is_first"])
        default = F.when(v["is_first"], F.get(v["parts"], 0)).otherwise(F.lit(NONE_TEXT))
        return F.struct(v["pos"].alias("pos"), default.alias("default"), chosen["value"].alias("value"), chosen["att"].alias("att"))

    def settle(v: Column) -> Column:
        # the test stands once, over whole results: a field of each would be tested on its own
        return F.when(
            is_missing(v["value"], mode),
            F.struct(v["pos"].alias("pos"), v["default"].alias("value"), F.lit(DEFAULT_ATT).alias("att"), F.lit(True).alias("missing")),
        ).otherwise(F.struct(v["pos"].alias("pos"), v["value"].alias("value"), v["att"].alias("att"), F.lit(False).alias("missing")))

    return F.transform(F.transform(_c(split), pick), settle)
