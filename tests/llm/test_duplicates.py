import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from slotwise.llm import embeddings, neardup
from slotwise.llm.common import components
from tests.llm.conftest import ODD


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


@pytest.mark.parametrize("edges", [
    [],
    [(1, 1), (None, 2), (3, None)],
    [(k, k + 1) for k in range(60)],
    [(0, k) for k in range(1, 40)] + [(100, 101), (101, 102), (102, 100)],
    [(int(a), int(b)) for a, b in np.random.default_rng(1).integers(0, 80, (60, 2))],
])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
    u = Union()
    for a, b in edges:
        if a is not None and b is not None and a != b:
            u.join(a, b)
    assert {r["node"]: r["component"] for r in components(df).collect()} == {x: u.find(x) for x in u.up}


def shingled(text):
    return neardup.labelled(s, np.zeros(len(s), np.uint64)) if len(s := neardup.shingles(neardup.word_hashes([text or ""])[0])) else s


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(old[j + 1], row[j])
    return row[-1]


def altered(rng, words, n):
    words = list(words)
    for _ in range(n):
        k = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.4:
            words[k] = f"new{rng.randrange(10**6)}"
        elif kind < 0.6:
            words.insert(k, f"ins{rng.randrange(10**6)}")
        elif kind < 0.8 and len(words) > 6:
            del words[k]
        else:
            j = rng.randrange(len(words))
            words[k], words[j] = words[j], words[k]
    return words


def test_alignment_equals_the_full_table():
    rng = random.Random(8)
    for _ in range(150):
        a = [f"w{rng.randrange(25 if rng.random() < 0.3 else 10**6)}" for _ in range(rng.randint(1, 60))]
        b = altered(rng, a, rng.randint(0, 4))
        x, y = shingled(" ".join(a)), shingled(" ".join(b))
        c = lcs(x.tolist(), y.tolist())
        assert neardup.similar(x, y) == (c >= 0.8 * (len(x) + len(y) - c) - 1e-9)


def brute(rows):
    u, sh = Union(), [(i, shingled(t)) for i, t in rows]
    by_words = {}
    for (i, _), (_, t) in zip(sh, rows):
        u.find(i)
        w = tuple((t or "").split())
        u.join(i, by_words.setdefault(w, i))
    for k, (i, x) in enumerate(sh):
        for j, y in sh[:k]:
            if len(x) and len(y) and neardup.similar(x, y):
                u.join(i, j)
    return {i: u.find(i) for i, _ in rows}


def test_near_duplicates_match_brute_force(make_docs):
    rng = random.Random(5)
    rows, i = [], 0
    for group in range(25):
        words = [f"g{group}w{rng.randrange(10**6)}" for _ in range(rng.randint(3, 120))]
        for _ in range(rng.choice([1, 2, 3, 12])):
            rows.append((i, " ".join(altered(rng, words, rng.randint(0, 3)))))
            i += 1
    rows += [(i, rows[0][1]), (i + 1, "  " + rows[0][1].replace(" ", "\n")), (i + 2, ""), (i + 3, None), (i + 4, " \t"), (i + 5, "a b"), (i + 6, "a b c")]
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(make_docs([(a, t, "s") for a, t in rows])).collect()}
    want = brute(rows)
    assert sum(got[a] != want[a] for a in want) == 0


@pytest.mark.parametrize("tile", [5, 1024])
def test_a_bucket_whose_centre_is_far_from_the_rest_is_resolved(make_docs, tile):
    # documents that share half of their text meet in buckets around unrelated centres
    rng = random.Random(6)
    line = " ".join(f"common{k}" for k in range(60))
    rows, i = [], 0
    for group in range(8):
        words = [f"g{group}w{k}" for k in range(60)]
        for _ in range(4):
            rows.append((i, line + " " + " ".join(altered(rng, words, 1))))
            i += 1
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(make_docs([(a, t, "s") for a, t in rows]), tile=tile).collect()}
    assert got == brute(rows)


def test_near_duplicate_rows_of_odd_tables(odd, make_docs):
    got = defaultdict(list)
    for r in neardup.near_duplicates(odd).collect():
        got[r["doc_id"]].append((r["component_id"], r["kept"]))
    assert sum(map(len, got.values())) == len(ODD)
    assert got[1] == [(1, True)] and got[2] == got[3] == [(1, False)]
    assert got[6] == [(6, True)] and got[7] == [(6, False)] * 2
    assert got[None] == [(None, True)] * 2
    assert neardup.near_duplicates(make_docs([])).count() == 0
    out = neardup.neardup_stage(None, odd, "")
    assert out.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(["1", "4", "5", "6", "8", "9", "None", "None"])


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(4)
    for n in (3, 5, 20, 60, 400, 512, 513, 3000):
        x = rng.integers(0, 2**63, n, dtype=np.uint64)
        y = x.copy()
        y[: n // 10] = rng.integers(0, 2**63, n // 10, dtype=np.uint64)  # similarity 0.82
        z = np.concatenate([x[: n // 2], rng.integers(0, 2**63, n - n // 2, dtype=np.uint64)])  # a third
        a, b, c = (neardup.signatures(v, np.array([n])) for v in (x, y, z))
        n = np.array([n])
        assert neardup.may_reach(a, a, n)[0] and neardup.may_reach(a, b, n)[0]
        assert n < 5 or not neardup.may_reach(a, c, n)[0]


def vectors(spark, rows):
    kinds = [("vec_id", T.LongType()), ("embedding", T.ArrayType(T.FloatType())), ("label", T.IntegerType()), ("rep", T.StringType()), ("v", T.StringType())]
    schema = T.StructType([T.StructField(n, k) for n, k in kinds])
    return spark.createDataFrame([(i, v, l, "x", "y") for i, v, l in rows], schema)


def near(rng, v, cosine):
    n = rng.normal(size=len(v))
    v = np.asarray(v, float) / np.linalg.norm(v)
    n -= n @ v * v
    return (cosine * v + np.sqrt(1 - cosine**2) * n / np.linalg.norm(n)).astype(np.float32).tolist()


@pytest.mark.parametrize("tile", [7, 1024])
def test_vector_links_match_brute_force(spark, tile):
    rng = np.random.default_rng(3)
    rows, i = [], 0
    for group in range(60):
        v = rng.normal(size=32).astype(np.float32).tolist()
        size = int(rng.choice([1, 1, 2, 3, 30]))
        for _ in range(size):
            rows.append((i, near(rng, v, rng.uniform(0.96, 0.9999)), int(group % 3)))
            i += 1
    rows += [(i + k, rows[0][1], rows[0][2]) for k in range(15)]  # exact copies
    i += 15
    rows += [(i, rows[0][1], 2 - rows[0][2] if rows[0][2] != 1 else 0)]  # another label
    odd = [(i + 1, None, 1), (i + 2, [0.0] * 32, 1), (i + 3, [float("nan")] + [1.0] * 31, 1), (i + 4, rows[0][1], None), (i + 5, [None] + [1.0] * 31, 1),
           (i + 6, [float("inf")] + [1.0] * 31, 1), (i + 7, [], 1), (i + 8, [1.0, 0.0], 1), (i + 9, [2.0, 0.0], 1)]
    d = vectors(spark, rows + odd + [(None, rows[0][1], 0), rows[3]])
    u, links = Union(), defaultdict(int)
    good = rows + odd[-2:]
    unit = [(a, np.array(v, float) / np.linalg.norm(np.array(v, float)), l) for a, v, l in good]
    for k, (a, x, l) in enumerate(unit):
        u.find(a)
        for b, y, m in unit[:k]:
            if l == m and len(x) == len(y) and x @ y >= 0.98:
                u.join(a, b)
                links[a] += 1
                links[b] += 1
    got = defaultdict(list)
    for r in embeddings.link_vectors(d, tile=tile).collect():
        got[r["vec_id"]].append((r["n_links"], r["component_id"], r["kept"]))
    assert len(got[None]) == 1 and len(got[rows[3][0]]) == 2
    for a, _, _ in good:
        assert set(got[a]) == {(links[a], u.find(a), u.find(a) == a)}
    for a, _, _ in odd[:-2]:
        assert got[a] == [(0, a, True)]


def test_no_vectors(spark):
    d = vectors(spark, [])
    assert embeddings.link_vectors(d).count() == 0
    assert [tuple(r) for r in embeddings.link_vectors(vectors(spark, [(1, None, 1)])).collect()] == [(1, 0, 1, True)]


def test_calibration_reaches_its_recall():
    lines, groups, wide, window, least = embeddings.calibrate(5000, 64)
    rng = np.random.default_rng(9)
    u = rng.normal(size=(2000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    v = np.array([near(rng, x, 0.98) for x in u])
    axes = rng.normal(size=(64, lines * groups))
    axes /= np.linalg.norm(axes, axis=0)
    shift = rng.uniform(0, wide, lines * groups)
    cell = lambda x: np.floor((x @ axes + shift) / wide).reshape(len(x), groups, lines)
    assert (cell(u) == cell(v)).all(2).any(1).mean() >= 0.995
    counted = rng.normal(size=(64, embeddings.LINES))
    counted /= np.linalg.norm(counted, axis=0)
    assert ((np.abs(u @ counted - v @ counted) <= window).sum(1) >= least).mean() >= 0.99


def test_short_texts_are_never_missed(make_docs):
    """Texts of 3 to 20 words against copies with a word more, less or changed at their ends."""
    rng, rows = random.Random(11), []
    for n in range(3, 25):
        for g in range(6):
            words = [f"n{n}g{g}w{k}" for k in range(n)]
            ends = [words, words + ["more"], ["more"] + words, words[:-1], words[1:], words[:-1] + ["other"], words + ["a", "b"], words + ["a", "b", "c"]]
            rows += [" ".join(w) for w in rng.sample(ends, 4)]
    rows = list(enumerate(rows))
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(make_docs([(a, t, "s") for a, t in rows])).collect()}
    want = brute(rows)
    assert got == want and len(set(want.values())) < 0.7 * len(rows)


def test_ids_with_several_texts_lose_no_group(make_docs):
    b, c, d = (" ".join(f"{x}{k}" for k in range(60)) for x in "bcd")
    rows = [(3, b), (7, b), (7, c), (9, c + " end"), (5, d), (5, " ".join(reversed(d.split()))), (5, d), (11, d + " tail")]
    docs = make_docs([(a, t, "s") for a, t in rows])
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs).collect())
    assert got == sorted([(3, 3, True), (7, 3, False), (7, 7, True), (9, 7, False), (5, 5, True), (5, 5, True), (5, 5, True), (11, 5, False)])
    left = sorted((r["doc_id"], r["text"]) for r in neardup.neardup_stage(None, docs, "").collect())
    assert left == sorted([(3, b), (7, c), (5, d), (5, rows[5][1])])


def test_a_large_group_gives_few_links(make_docs, monkeypatch):
    """Near copies around centres that are not among them: a link a member, not one a pair."""
    rng = random.Random(3)
    line = [f"common{k}" for k in range(70)]
    rows = [" ".join(line + [f"a{j}" for j in range(60)])]
    for name, n in (("g", 60), ("h", 80)):
        rows += [" ".join(altered(rng, line + [f"{name}{k}" for k in range(60)], 2)) for _ in range(n)]
    links = []
    plain = neardup.cross_links
    monkeypatch.setattr(neardup, "cross_links", lambda *a: links.append((a[0].count(), (out := plain(*a)).count())) or out)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(make_docs([(k, t, "s") for k, t in enumerate(rows)])).collect()}
    assert got == brute(list(enumerate(rows)))
    members, found = links[0]
    assert found <= members
