import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from slotwise.llm import variants as V
from tests.llm.conftest import ODD

LOWER = {c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def counts(rows, edited=V.EDITED, least=V.MIN_COUNT):
    out = Counter()
    for i, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(str.maketrans(LOWER))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % edited == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= least}


def brute(words):
    near = {w: [v for v in words if V.near(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(rows, key=repr)


def edits(word):
    letters = "abcde"
    yield from (word[:k] + word[k + 1 :] for k in range(len(word)))
    yield from (word[:k] + c + word[k:] for k in range(len(word) + 1) for c in letters)
    yield from (word[:k] + c + word[k + 1 :] for k in range(len(word)) for c in letters if c != word[k])


def test_near_is_one_edit():
    for w in ("abcde", "aaaaa", "edcba"):
        every = set(edits(w))
        assert all(V.near(w, v) == (v != w) for v in every)
        assert not V.near(w, w) and not V.near(w, w + "xy") and not V.near(w, "xy" + w[2:])


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abé", min_size=5, max_size=14), st.data())
def test_near_words_meet_in_a_list(word, data):
    """No pair is lost, whatever the dictionary extends."""
    other = data.draw(st.sampled_from([v for v in edits(word) if len(v) >= 5]))
    marked = [V.START + w + V.END for w in (word, other)]
    every = sorted({m[p : p + q] for m in marked for p in range(len(m)) for q in range(2, 6) if p + q <= len(m)})
    # frequency falls as grams grow, as it does in a corpus
    frequent = {g: data.draw(st.integers(1, 50)) for g in every if data.draw(st.booleans())}
    frequent = {g: n for g, n in frequent.items() if all(g[:k] in frequent for k in range(2, len(g)))}
    assert word == other or set(V.list_keys(word, frequent)) & set(V.list_keys(other, frequent))


def test_bound_counts_the_grams_of_the_worst_edit():
    for word in ("abcde", "aaaaaaaa", "abababab", "abcabcabcabc"):
        m = V.START + word + V.END
        for frequent in ({}, {m[p : p + q]: 1 for p in range(len(m)) for q in (2, 3, 4)}):
            grams = V.decompose(m, frequent)
            worst = 0
            for i in range(1, len(m) - 1):
                kept = {g for p, g in grams if not p <= i < p + len(g)}
                worst = max(worst, len({g for _, g in grams}) - len(kept))
            assert V.bound(grams, len(m)) >= worst and V.bound(grams, len(m)) < len({g for _, g in grams})


@pytest.fixture(scope="module")
def rows():
    import random

    rnd = random.Random(5)
    base = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(5, 9))) for _ in range(120)]
    words = base + [rnd.choice(list(edits(rnd.choice(base)))) for _ in range(400)] + ["prefixes" + c for c in "abcdeé"] + ["Ünïcode", "×÷×÷×"]
    return [(k, " ".join(rnd.choice([rnd.choice(words), rnd.choice(words[:40]).upper()]) for _ in range(60)), None) for k in range(120)] + ODD


@pytest.mark.parametrize("floor,tile", [(V.FLOOR, V.TILE), (3, 4)])
def test_query_equals_brute_force(make_docs, rows, floor, tile):
    got = V.spelling_variants(V.word_counts(make_docs(rows)), floor=floor, tile=tile).collect()
    words = counts(rows)
    assert any(c.startswith("×") for c in words) and len(words) > 300
    assert sorted(map(tuple, got), key=repr) == brute(words)


def test_chains_follow_to_the_last(spark):
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb", "bbbbc"]
    words = {w: 3 * 2**k for k, w in enumerate(chain)}
    got = V.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n bigint")).collect()
    assert sorted(map(tuple, got), key=repr) == brute(words)
    assert {r["root"] for r in got} == {"bbbbc"}


def test_nothing(make_docs):
    assert V.spelling_variants(V.word_counts(make_docs([]))).count() == 0
    assert V.spelling_variants(V.word_counts(make_docs([(1, None, None), (2, "abc", None)]))).count() == 0


def test_long_words_are_whole(make_docs):
    word = "ab" * 3000 + "c" * 3000
    rows = [(k, f"{word} {word}x {word[:4000]}y{word[4000:]}", None) for k in range(3)]
    got = V.spelling_variants(V.word_counts(make_docs(rows), edited=None)).collect()
    assert sorted(r["n_near"] for r in got) == [1, 1, 2]


def test_lists_of_a_common_beginning(spark):
    """A long list is dealt out; nothing is lost."""
    words = {f"prefix{a}{b}{c}": 3 for a in "abcd" for b in "abcd" for c in "abcd"}
    got = V.near_words(spark.createDataFrame(list(words.items()), "word string, n bigint"), floor=2, tile=5)
    want = defaultdict(set)
    for w in words:
        want[w] = {v for v in words if V.near(w, v)}
    found = defaultdict(set)
    for r in got.collect():
        assert r["other"] not in found[r["word"]]
        found[r["word"]].add(r["other"])
    assert found == want
