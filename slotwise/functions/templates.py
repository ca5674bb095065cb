"""Compiled templates — H4, H5 in strict mode.

A template is cut once, on the configuration side, into options, and each option
into literal and token segments. Rendering a row then looks each token up and
joins the segments: the text is passed over once, however many tokens it has,
and a value is never searched for further tokens, marks or separators.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotwise.functions.text import OPTION_SEPARATOR, text_for_key, value_key, value_texts

TOKEN_MARK = "%%"
SEGMENTS = "array<array<struct<text:string,token:string>>>"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _literal(text: Column) -> Column:
    return F.struct(text.alias("text"), F.lit(None).cast("string").alias("token"))


def _with_last(options: Column, segment: Column) -> Column:
    """``options`` with a segment more in the last one."""
    rest = F.slice(options, F.lit(1), F.size(options) - 1)
    return F.concat(rest, F.array(F.array_append(F.element_at(options, -1), segment)))


def compiled(template) -> Column:
    """Options of a template, each an array of segments: ``text`` or ``token`` is set.

    Marks pair in the order of the text; one without a partner is dropped, and
    the separator splits options everywhere: a pair of marks with a separator
    between them holds no token, but two pieces of plain text.
    """
    pieces = F.split(F.coalesce(_c(template), F.lit("")), TOKEN_MARK, -1)
    marked = F.transform(
        pieces,
        lambda x, i: F.struct(
            F.split(x, r"\|", -1).alias("parts"), ((i % 2 == 1) & (i < F.size(pieces) - 1) & ~x.contains(OPTION_SEPARATOR)).alias("is_token")
        ),
    )

    def add(options: Column, piece: Column) -> Column:
        first = F.get(piece["parts"], F.lit(0))
        token = F.struct(F.lit(None).cast("string").alias("text"), first.alias("token"))
        more = F.transform(F.slice(piece["parts"], F.lit(2), F.size(piece["parts"])), lambda p: F.array(_literal(p)))
        return F.when(piece["is_token"], _with_last(options, token)).otherwise(F.concat(_with_last(options, _literal(first)), more))

    return F.aggregate(marked, F.array(F.array()).cast(SEGMENTS), add)


def keyed(options, spec) -> Column:
    """Segments with the value-map key of each token (null for plain text)."""
    return F.transform(
        _c(options),
        lambda segments: F.transform(
            segments, lambda s: F.struct(s["text"].alias("text"), F.when(s["token"].isNotNull(), value_key(s["token"], spec)).alias("key"))
        ),
    )


def fill_compiled(options, texts) -> Column:
    """The options' texts: segments looked up in ``value_texts`` and joined."""
    return F.transform(
        _c(options), lambda segments: F.array_join(F.transform(segments, lambda s: F.coalesce(s["text"], text_for_key(texts, s["key"]))), "")
    )


def render_compiled(options, values, mode: str = "strict") -> Column:
    """``fill_compiled`` for one template of a row."""
    return fill_compiled(options, value_texts(values, mode))
