"""Daily content rotation — H7, H8 and the option index of H6.

Python's ``%`` is floored; Spark's keeps the dividend's sign, so every modulus
here is ``pmod``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def rotation_seed(day) -> Column:
    """H8: ISO week number + weekday (Monday = 0) of a date column or literal."""
    d = F.to_date(F.lit(day)) if isinstance(day, str) and not day.isidentifier() else _c(day)
    return (F.weekofyear(d) + F.weekday(d)).cast("int")


def rotate(bucket, seed, n) -> Column:
    """``(bucket + seed % n) % n`` with floored moduli; null when n is not positive."""
    n = _c(n) if not isinstance(n, int) else F.lit(n)
    seed = _c(seed) if not isinstance(seed, int) else F.lit(seed)
    return F.when(n > 0, F.pmod(_c(bucket) + F.pmod(seed, n), n))


def pick_version(bucket, seed, versions) -> Column:
    """H7: version number 1..v chosen for a recipient bucket on a given day."""
    return rotate(bucket, seed, versions) + 1
