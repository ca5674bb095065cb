"""Binding (``var_source``) and template parsing — H1–H4.

A binding reads ``traveler.a;traveler.b|TABLE.k1;TABLE.k2``: recipient
attributes on the left of ``|`` join the lookup table's key columns on the
right. A template holds ``%%table.column%%`` tokens.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed syntax of the configuration language (must equal the reference's).
BINDING_SIDES = "|"
BINDING_ITEMS = ";"
QUALIFIER = "."
TOKEN_PATTERN = r"(?s)%%(.*?)%%"
RECIPIENT_TABLE = "traveler"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def has_lookup(binding) -> Column:
    return _c(binding).contains(BINDING_SIDES)


def binding_table(binding) -> Column:
    """H1: lookup table of a binding (first right item, before the dot); null without ``|``."""
    b = _c(binding)
    first = F.split_part(F.split_part(b, F.lit(BINDING_SIDES), F.lit(2)), F.lit(BINDING_ITEMS), F.lit(1))
    return F.when(has_lookup(b), F.split_part(first, F.lit(QUALIFIER), F.lit(1)))


def _item_columns(side: Column) -> Column:
    items = F.split(side, r"\;", -1)
    return F.transform(items, lambda x: F.split_part(x, F.lit(QUALIFIER), F.lit(2)))


def binding_right_keys(binding) -> Column:
    """H2: lookup key columns (right of ``|``); empty array without ``|``."""
    b = _c(binding)
    right = F.split_part(b, F.lit(BINDING_SIDES), F.lit(2))
    return F.when(has_lookup(b), _item_columns(right)).otherwise(F.array().cast("array<string>"))


def binding_left_keys(binding) -> Column:
    """H3: recipient columns (left of ``|``)."""
    b = _c(binding)
    left = F.split_part(b, F.lit(BINDING_SIDES), F.lit(1))
    cols = _item_columns(left)
    return F.when(b.isNull(), F.array().cast("array<string>")).otherwise(F.filter(cols, lambda x: x != F.lit("")))


def template_tokens(template) -> Column:
    """H4: ``table.column`` text between successive ``%%`` pairs, in order."""
    return F.regexp_extract_all(F.coalesce(_c(template), F.lit("")), F.lit(TOKEN_PATTERN), 1)


def token_table(token) -> Column:
    return F.split_part(_c(token), F.lit(QUALIFIER), F.lit(1))


def token_column(token) -> Column:
    return F.split_part(_c(token), F.lit(QUALIFIER), F.lit(2))


def key_spec(left_keys, right_keys) -> Column:
    """Canonical text of a (left keys, right keys) pair; names one lookup join."""
    return F.concat(F.array_join(_c(left_keys), ";"), F.lit("|"), F.array_join(_c(right_keys), ";"))
