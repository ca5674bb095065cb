"""Size-checked broadcast and row-count gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class EmptyStageError(RuntimeError):
    """A stage that must produce rows produced none (reference gates, D-9)."""


# Default byte budget of one broadcast side (each executor holds a copy).
DEFAULT_MAX_BROADCAST_BYTES = 128 * 1024 * 1024


def json_width(df: DataFrame) -> Column:
    """Bytes of a row as JSON: an over-estimate that covers nested arrays and long strings."""
    return F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))


def row_width(df: DataFrame) -> Column:
    """Bytes of a row, no fewer than a task holds: 16 for the row and for each field,
    the length of strings, and the JSON text of nested fields (``json_width``).

    Only nested fields are turned into text: a configuration row of forty plain
    columns costs no more than adding up lengths.
    """
    width = F.lit(16 + 16 * len(df.columns)).cast("bigint")
    nested = []
    for f in df.schema:
        c, kind = F.col(f"`{f.name}`"), f.dataType.simpleString()
        if kind.startswith(("array", "map", "struct")):
            nested.append(f.name)
        elif kind in ("string", "binary") or kind.startswith(("varchar", "char")):
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
    return width + json_width(df.select(*[f"`{c}`" for c in nested])) if nested else width


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a frame in one parallel aggregate (partial sums per task,
    no ``limit``: a global limit would funnel the rows into one partition).

    Bytes are the ``row_width`` of each row — an over-estimate of the in-memory
    size that also covers nested arrays and long strings, which a per-type width
    guess would miss. A frame that is not persisted is computed
    for it once more.
    """
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_width(df)).alias("b")).first()
    return int(r.n), int(r.b or 0)


def exploded(df: DataFrame, columns: list, value, *names: str) -> DataFrame:
    """``columns`` and the elements of ``value``, as ``explode`` gives them, with ``value`` evaluated once a row.

    Below an ``explode`` the optimiser puts a filter on its input (not null, not
    empty), and a computed input is then computed again for each condition.
    """
    out = df.select(*columns, F.explode_outer(value).alias(*names))
    return out.filter(F.col(names[0]).isNotNull())


def fits_broadcast(size: tuple[int, int], max_rows: int, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    return size[0] <= max_rows and size[1] <= max_bytes


def broadcast_checked(
    df: DataFrame, max_rows: int, known: tuple[int, int] | None = None, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, closer: bool = False
) -> DataFrame:
    """Broadcast hint only for a side whose size is checked to be small.

    The check counts the rows and measures their bytes (``measured_size``);
    the hint is given only under both bounds. Beyond them
    the frame is returned as is: the join is planned as a shuffle join, and
    AQE still switches it to a broadcast at run time if the measured shuffle
    output turns out small.

    ``known`` is an already measured upper bound (rows, bytes), for instance
    of the configuration table the frame is a projection or aggregate of; it
    replaces the check. ``closer``: where that bound is too large, the frame
    itself is measured after all (for a small aggregate of large configuration).
    """
    size = known if known is not None and (fits_broadcast(known, max_rows, max_bytes) or not closer) else measured_size(df)
    return F.broadcast(df) if fits_broadcast(size, max_rows, max_bytes) else df


def gate(df: DataFrame, name: str, min_rows: int = 1) -> int:
    """D-9: fail the run when a stage is empty; returns the stage's row count."""
    return gate_rows(df.count(), name, min_rows)


def gate_rows(n: int, name: str, min_rows: int = 1) -> int:
    """D-9 for a row count that is already known."""
    if n < min_rows:
        raise EmptyStageError(f"stage '{name}' produced {n} rows (need >= {min_rows})")
    return n
