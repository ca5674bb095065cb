"""Small scalar helpers: locale, segment lists, paths, flags — B1, B12, B16, H10, H19, H20."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


# Fixed values (must equal the reference's): click-token wrapping and the
# status that marks an active loyalty member.
CLICK_PREFIX = "emailclick/"
CLICK_SUFFIX = "/"
ACTIVE_STATUS = "Active"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalize_locale(df: DataFrame, col: str = "locale") -> DataFrame:
    """B1: lower-case the locale column (null stays null)."""
    return df.withColumn(col, F.lower(F.col(col)))


def segment_ids(col) -> Column:
    """``"3#7#9"`` → ``array<int>``."""
    return F.transform(F.split(_c(col), "#", -1), lambda x: x.cast("int"))


def locale_parts(col) -> Column:
    """struct(language, country upper-cased, ``xx_YY`` form)."""
    c = _c(col)
    lang = F.split_part(c, F.lit("_"), F.lit(1))
    country = F.upper(F.split_part(c, F.lit("_"), F.lit(2)))
    return F.struct(lang.alias("language"), country.alias("country"), F.concat_ws("_", lang, country).alias("display"))


def dated_path(base: str, day) -> Column:
    """``<base>/yyyy/MM/dd``."""
    d = F.to_date(F.lit(day)) if isinstance(day, str) else _c(day)
    return F.concat(F.lit(base.rstrip("/") + "/"), F.date_format(d, "yyyy/MM/dd"))


def null_literals(df: DataFrame, literal: str = "None") -> DataFrame:
    """The literal text ``None`` becomes null, in string columns only."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(
        *[F.nullif(F.col(f"`{c}`"), F.lit(literal)).alias(c) if c in strings else F.col(f"`{c}`") for c in df.columns]
    )


def status_flag(col, active: str = ACTIVE_STATUS) -> Column:
    """``"1"`` when the status equals ``active``, else ``"0"`` (null included)."""
    return F.when(_c(col) == F.lit(active), F.lit("1")).otherwise(F.lit("0"))


def click_token(token) -> Column:
    """``emailclick/<token>/`` (null stays null, so H14 can fall through)."""
    return F.concat(F.lit(CLICK_PREFIX), _c(token), F.lit(CLICK_SUFFIX))
