"""Near-duplicate vectors by collision-counting projections.

Each vector is projected on many random lines. Two vectors collide on a line if
one lies in the window around the other; a pair at the similarity limit
collides on a known share of the lines, so the least count for a wanted recall
follows from the binomial distribution (:func:`calibrate`). Pairs that reach
the count are verified by cosine in double precision.

Comparing windows of single lines for all pairs would be quadratic, as every
window holds a fixed share of the vectors. So lines are grouped: a group's
lines are cut into intervals at random offsets, and only vectors in the same
cell (the same interval on each line of the group) are compared. The lines per
group grow with the logarithm of the number of vectors, which keeps the
strangers per cell constant, and the number of groups follows from the recall.
A pair is handled in the first group in which it shares a cell.

Equal vectors (same label and components) are collapsed before and weighted
after. A cell with more than ``TILE`` vectors is dealt out in pairs of tiles,
each a task's worth of rows; no pair of it is dropped.

Defined cases: rows whose label or vector is null, whose vector is empty, zero
or holds a null or non-finite component link with nothing but keep their result
row, as do rows with a null id; rows that repeat an id are one vector if equal,
and an id with several vectors is in all their components; vectors of different
length don't link; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.blocks import dealt, in_blocks, neighbours
from slotwise.llm.common import checkpointed, components, join_null_safe, map_arrow, table

COSINE = 0.98  # fixed by the query contract
RECALL = 0.999  # of pairs at the limit, for either step
LINES = 32  # projections whose collisions are counted
CELL = 6.0  # interval width in standard deviations of a pair's difference at the limit
TILE = 1024
SEED = 20


def calibrate(n: int, dim: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int, float, float, int]:
    """(lines per group, groups, interval, window, least count) for n vectors.

    On a line through a random unit vector two unit vectors at the limit differ
    by about N(0, s^2), s = chord / sqrt(dim); strangers by N(0, 2 / dim).
    """
    s = math.sqrt(2 * (1 - cosine) / max(dim, 1))
    wide = CELL * s
    same = 1 - math.sqrt(2 / math.pi) / CELL  # chance of a pair at the limit to share an interval (little less than this)
    far = math.sqrt(2 / max(dim, 1))
    stranger = min(0.9, wide / (far * math.sqrt(2 * math.pi)) * 1.0)
    lines = max(1, math.ceil(math.log(max(n, 2)) / -math.log(stranger)))
    groups = math.ceil(math.log(1 - recall) / math.log(1 - same**lines))
    window = 2.0 * s
    p = math.erf(window / s / math.sqrt(2))
    tail, least = 0.0, LINES + 1
    while least and tail < recall:  # largest count that a pair at the limit reaches with the recall
        least -= 1
        tail += math.comb(LINES, least) * p**least * (1 - p) ** (LINES - least)
    return lines, groups, wide, window, least


def _unit(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    v = values.reshape(len(offsets) - 1, -1).astype(np.float64)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def distinct_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, v, key``: usable vectors; key is equal for equal label and components."""
    v = F.col(vector_col).cast("array<double>")
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)
    usable &= F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    d = vectors.filter(usable).select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.transform(v, lambda x: x + 0.0).alias("v")).distinct()
    return d.withColumn("key", F.struct(F.xxhash64("label", "v").alias("h1"), F.xxhash64(F.lit(3), "v", "label").alias("h2")))


def link_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
    recall: float = RECALL,
    tile: int = TILE,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per input row."""
    d = distinct_vectors(vectors, id_col, vector_col, label_col)
    reps = d.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("v").alias("v"))
    reps = checkpointed(reps)
    sizes = reps.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    dims = [r[0] for r in reps.select(F.size("v").alias("m")).distinct().collect()]
    parts = [_links(reps.filter(F.size("v") == m), m, sizes, cosine, recall, tile) for m in sorted(dims)]
    found = parts[0] if parts else None
    for p in parts[1:]:
        found = found.unionByName(p)
    member = d.select("vec_id", "key")
    rep = join_null_safe(member, reps.select("key", "rep", "copies"), ["key"])
    if found is None:
        links = rep.select(F.col("rep").alias("a"), F.lit(0).cast("bigint").alias("w")).limit(0)
        comp = links.select(F.col("a").alias("node"), F.col("a").alias("component"))
    else:
        found = checkpointed(found)
        links = found.filter("w > 0").groupBy("a").agg(F.sum("w").alias("w"))
        comp = components(found.filter("b is not null"), "a", "b")
    out = rep.join(links.withColumnsRenamed({"a": "rep", "w": "_w"}), "rep", "left").join(comp.withColumnsRenamed({"node": "rep"}), "rep", "left")
    # the copies of a vector link with each other and with all copies of its partners
    out = out.groupBy("vec_id").agg(
        F.max(F.coalesce("_w", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.min(F.coalesce("component", "rep")).alias("component_id")
    )
    rows = vectors.select(F.col(id_col).alias("vec_id"))
    out = join_null_safe(rows, out, ["vec_id"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _links(reps: DataFrame, dim: int, n: int, cosine: float, recall: float, tile: int) -> DataFrame:
    """``a, w, b``: link weight of a representative, or an edge of its component."""
    lines, groups, wide, window, least = calibrate(n, dim, cosine, recall)
    kind = reps.schema["rep"].dataType.simpleString()

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(SEED)
        axes = rng.normal(size=(dim, lines * groups))
        axes /= np.linalg.norm(axes, axis=0)
        shift = rng.uniform(0, wide, lines * groups)
        mix = rng.integers(1, 2**62, lines * groups, dtype=np.int64) | 1
        for b in batches:
            v = b.column("v")
            u = _unit(v.flatten().to_numpy(zero_copy_only=False), np.asarray(v.offsets))
            step = np.floor((u @ axes + shift) / wide).astype(np.int64)
            h = (step * mix).reshape(len(u), groups, lines)
            h = np.bitwise_xor.reduce(h ^ (h >> 29), axis=2)
            arr = pa.ListArray.from_arrays(pa.array(np.arange(len(u) + 1, dtype=np.int32) * groups), pa.array(h.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("copies"), b.column("label"), v, arr], names=["rep", "copies", "label", "v", "cells"])

    label = reps.schema["label"].dataType.simpleString()
    d = map_arrow(reps.select("rep", "copies", "label", "v"), cells, f"rep {kind}, copies bigint, label {label}, v array<double>, cells array<bigint>")
    d = checkpointed(d)  # cells are hashed once: every later step sees the same ones
    spread = d.select("rep", "copies", "label", "v", "cells", F.posexplode("cells").alias("g", "cell"))
    size = spread.groupBy("label", "g", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    spread = dealt(spread.join(size, ["label", "g", "cell"]), ["label", "g", "cell"], "n", "rep", tile)
    spread = spread.select("block", "g", "rep", "copies", "v", "cells", "left", "own", F.xxhash64("label").alias("lab"))
    rng = np.random.default_rng(SEED + 1)
    counted = rng.normal(size=(dim, LINES))
    counted /= np.linalg.norm(counted, axis=0)

    def compare(t: pa.Table) -> pa.RecordBatch:
        rep, block = t["rep"].to_numpy(), t["block"].to_numpy()
        copies, g, lab = t["copies"].to_numpy(), t["g"].to_numpy(), t["lab"].to_numpy()
        left, own = t["left"].to_numpy(), t["own"].to_numpy()
        v = t["v"].combine_chunks()
        u = _unit(v.flatten().to_numpy(zero_copy_only=False), np.asarray(v.offsets))
        c = t["cells"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(u), -1)
        p = (u @ counted).astype(np.float32)
        found = [np.zeros((2, 0), np.int64)]
        for i, j in neighbours(block):
            ok = (own[i] | (left[i] != left[j])) & (rep[i] != rep[j]) & (lab[i] == lab[j])
            i, j = i[ok], j[ok]
            for s in range(0, len(i), 65536):
                a, b = i[s : s + 65536], j[s : s + 65536]
                enough = (np.abs(p[a] - p[b]) <= window).sum(1) >= least
                a, b = a[enough], b[enough]
                first = (c[a] == c[b]).argmax(1) == g[a]  # else an earlier group has handled it
                a, b = a[first], b[first]
                near = np.einsum("ij,ij->i", u[a], u[b]) >= cosine
                found.append(np.stack([a[near], b[near]]))
        a, b = np.concatenate(found, axis=1)
        weight = np.bincount(np.concatenate([a, b]), np.concatenate([copies[b], copies[a]]), len(u)).astype(np.int64)
        root = rep.copy()
        while len(a):  # smallest id reachable by the links found here
            low = root.copy()
            np.minimum.at(low, a, root[b])
            np.minimum.at(low, b, root[a])
            if (low == root).all():
                break
            root = low
        hit = np.flatnonzero(weight)
        return pa.RecordBatch.from_arrays([pa.array(rep[hit]), pa.array(weight[hit]), pa.array(root[hit])], names=["a", "w", "b"])

    return map_arrow(spread, in_blocks(compare), f"a {kind}, w bigint, b {kind}")


def op4_collision_projections(spark, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))
