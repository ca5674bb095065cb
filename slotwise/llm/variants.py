"""Spelling variants of the words of a corpus, by variable-length grams.

Words are counted over the whole corpus; two words are near if one inserted,
deleted or replaced code point makes one of the other. Near words are found with
a variable-length gram index. A gram dictionary is pruned by frequency: a gram
that more than the dictionary's floor of words contain is extended, up to
``LONGEST``; a rarer one is not. A marked word (a character before and after it)
is decomposed into the dictionary's gram at each position, so a gram depends on
its own characters alone, and one edit affects only the grams across it. The
largest number of different grams that one edit can take away is the word's
bound: near words share all others, so they share one of the ``bound + 1``
first grams of either in a common order (rare grams first). Only those enter
the lists. Two near words agree on everything that a shared gram has on its far
side from the edit, so a gram's list is kept by the word's part up to the gram's
end and by the part from its start on. Words that meet in a list are filtered by
length and letters, then verified. A long list is dealt out in pairs of tiles.

``LONGEST`` is at most the shortest word's length: a marked word then has more
grams than an edit can affect, and every word has a positive bound.

Defined cases: a null text has no words, a null id counts as the empty text in
the hash that edits a word; repeated rows count each; words outside the counts
(too short or too rare) are neither listed nor near; ties in counts go to the
smaller word in code-point order; a word without near words has no form and is
its own root; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.blocks import dealt, in_blocks, neighbours
from slotwise.llm.common import checkpointed, map_arrow, table, written

# Fixed by the query contract.
RUN = r"[A-Za-zÀ-ÿ]+"
EDITED = 97
MIN_LENGTH = 5
MIN_COUNT = 3
TIMES = 2  # a form occurs so many times as often as its variant

SHORTEST, LONGEST = 2, 5  # characters of a gram
FLOOR = 40  # words a gram is in before it is extended, at least
GRAMS = 1_000_000  # of the dictionary: its floor rises with the corpus so that no more can pass
TILE = 1024
START, END = "\x02", "\x03"
LETTERS = 128  # classes of letters in the filter


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edited: int | None = EDITED, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT
) -> DataFrame:
    """``word, n``: lower-cased runs of letters, a hashed share of them with one character deleted.

    ``edited``: one in so many (document, run) pairs; None: no deletions. Native;
    words are summed map-side before they are shuffled.
    """
    lower = F.translate(F.coalesce(F.col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    doc = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":")).alias("doc")
    runs = docs.select(doc, F.explode(F.regexp_extract_all(lower, F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    run = F.col("run")
    if edited:
        h = F.crc32(F.concat("doc", "run"))
        cut = (h % F.length(run)).cast("int")
        runs = runs.select(F.when(h % edited == 0, F.concat(F.substring(run, F.lit(1), cut), F.substring(run, cut + 2, F.length(run)))).otherwise(run).alias("run"))
    words = runs.filter(F.length("run") >= min_length).groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return words.filter(F.col("n") >= min_count)


def frequent_grams(words: DataFrame, longest: int = LONGEST, floor: int = FLOOR, most: int = GRAMS) -> DataFrame:
    """``gram, n`` of the grams in more words than the floor: those that the dictionary extends.

    Of all grams fewer than ``most`` can be above ``positions / most`` words, so
    the result has a proven bound at any size of the corpus.
    """
    marked = F.concat(F.lit(START), "word", F.lit(END))
    total = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    floor = max(floor, total * (longest - SHORTEST + 1) // most)
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(SHORTEST), F.lit(longest)),
            lambda q: F.transform(F.sequence(F.lit(1), F.length("m") - SHORTEST + 1), lambda p: F.when(p + q - 1 <= F.length("m"), F.substring(F.col("m"), p, q))),
        )
    )
    grams = words.select(marked.alias("m")).select(F.explode(F.array_distinct(spans)).alias("gram"))
    return grams.filter("gram is not null").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > floor)


def decompose(marked: str, frequent: dict[str, int], longest: int = LONGEST) -> list[tuple[int, str]]:
    """The dictionary's gram at each position: the shortest that is not frequent, or the longest allowed."""
    out, n = [], len(marked)
    for p in range(n - SHORTEST + 1):
        e, last = p + SHORTEST, min(p + longest, n)
        while e < last and marked[p:e] in frequent:
            e += 1
        out.append((p, marked[p:e]))
    return out


def bound(grams: list[tuple[int, str]], n: int) -> int:
    """Most different grams that one edit in a word of ``n`` marked characters can take away.

    A gram goes if all its occurrences lie across the edited character (an
    insertion is inside fewer grams than a change of the character before it).
    """
    at: dict[str, list[tuple[int, int]]] = {}
    for p, g in grams:
        at.setdefault(g, []).append((p, p + len(g)))
    change = [0] * (n + 1)
    for spans in at.values():
        lo, hi = max(s for s, _ in spans), min(e for _, e in spans)  # the characters that all occurrences cross
        if lo < hi:
            change[lo] += 1
            change[hi] -= 1
    most = now = 0
    for c in change:
        now += c
        most = max(most, now)
    return most


def list_keys(word: str, frequent: dict[str, int], longest: int = LONGEST) -> list[bytes]:
    """The lists the word is in: parts up to the end and from the start of its first grams."""
    marked = START + word + END
    grams = decompose(marked, frequent, longest)
    some = sorted({g for _, g in grams}, key=lambda g: (frequent.get(g, 0), zlib.crc32(g.encode()), g))[: bound(grams, len(marked)) + 1]
    chosen, keys = set(some), []
    for p, g in grams:
        if g in chosen:
            e = p + len(g)
            if e < len(marked):  # else the edit is not behind the gram
                keys.append(f"<{len(g)}:{marked[:e]}".encode())
            if p:
                keys.append(f">{len(g)}:{marked[p:]}".encode())
    return keys


def near(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    n, i = len(a), 0
    while i < n and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if n == len(b) else a[i:] == b[i + 1 :]


def _letter_values() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random value per class of letters; all values, and all differences of two."""
    v = np.random.default_rng(13).integers(0, 2**63, LETTERS, dtype=np.uint64)
    return v, np.sort(v), np.unique((v[:, None] - v[None, :]).ravel())


_VALUE, _ONE, _TWO = _letter_values()


def _among(x: np.ndarray, values: np.ndarray) -> np.ndarray:
    return values[np.minimum(np.searchsorted(values, x), len(values) - 1)] == x


def _letter_sums(words: list[str]) -> np.ndarray:
    """Sum of the letters' values: words that are near differ by one value or by one difference."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    sums = np.append(np.uint64(0), np.cumsum(_VALUE[flat % LETTERS], dtype=np.uint64))
    return sums[ends] - sums[np.append(0, ends[:-1])]


def near_words(words: DataFrame, longest: int = LONGEST, floor: int = FLOOR, tile: int = TILE) -> DataFrame:
    """``word, other, n``: every ordered pair of near words, ``n`` being the other's count.

    ``words``: ``word, n``, of at least ``longest`` code points each.
    """
    sc = words.sparkSession.sparkContext
    # at most GRAMS short texts, by frequent_grams
    frequent = sc.broadcast({r["gram"]: r["n"] for r in frequent_grams(words, longest, floor).collect()})

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = frequent.value
        for batch in batches:
            for s in range(0, len(batch), 5000):
                part = batch.slice(s, 5000)
                keys = [list_keys(w, grams, longest) for w in part.column(0).to_pylist()]
                row = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
                flat = [k for ks in keys for k in ks]
                both = part.take(pa.array(row))
                # 64 bits of the list's name; words that meet by a clash of names fail the verification
                name = np.array([zlib.crc32(k) << 32 | zlib.adler32(k[::-1]) for k in flat], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(name), *both.columns], names=["list", "word", "n"])

    rows = written(map_arrow(words.select("word", "n"), lists, "list bigint, word string, n bigint"), "lists")
    size = rows.groupBy("list").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    spread = dealt(rows.join(size, "list"), ["list"], "size", "word", tile).select("block", "own", "left", "word", "n")

    def work(x: pa.Table) -> pa.RecordBatch:
        block, own, left, n = (x[c].to_numpy() for c in ("block", "own", "left", "n"))
        words_ = x["word"].to_pylist()
        length, sums = np.fromiter(map(len, words_), np.int64, len(words_)), _letter_sums(words_)
        found: dict[tuple[str, str], tuple[int, int]] = {}
        for i, j in neighbours(block):
            more = length[i] - length[j]
            ok = (own[i] | (left[i] != left[j])) & (np.abs(more) <= 1)
            i, j, more = i[ok], j[ok], more[ok]
            swap = more < 0
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            diff = sums[i] - sums[j]
            ok = np.where(more == 0, _among(diff, _TWO), _among(diff, _ONE))
            for p, q in zip(i[ok].tolist(), j[ok].tolist()):
                a, b = words_[p], words_[q]
                if (a, b) not in found and near(a, b):
                    found[a, b] = p, q
        at = np.array(list(found.values()), np.int64).reshape(-1, 2)
        one, two = np.concatenate([at[:, 0], at[:, 1]]), np.concatenate([at[:, 1], at[:, 0]])
        word = x["word"].combine_chunks()
        return pa.RecordBatch.from_arrays([word.take(pa.array(one)), word.take(pa.array(two)), pa.array(n[two])], names=["word", "other", "n"])

    return map_arrow(spread, in_blocks(work), "word string, other string, n bigint").groupBy("word", "other").agg(F.first("n").alias("n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the rows ``word, form``: forms followed to the last, doubling the step each round."""
    state = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        state = checkpointed(state.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        if state.filter("_moved").isEmpty():
            return state.select("word", "root")
        state = state.select("word", "root")


def spelling_variants(words: DataFrame, longest: int = LONGEST, floor: int = FLOOR, tile: int = TILE, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` per row ``word, n`` (words of ``longest`` code points at least).

    The form is the near word of largest count, if that is ``times`` the word's own.
    """
    words = written(words.select("word", "n"), "words")
    best = near_words(words, longest, floor, tile).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "other")).alias("b"))
    rows = words.join(best, "word", "left")
    is_form = F.coalesce(-F.col("b.less") >= times * F.col("n"), F.lit(False))
    rows = written(
        rows.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(is_form, F.col("b.other")).alias("form"), F.when(is_form, -F.col("b.less")).alias("form_n")
        ),
        "forms",
    )
    out = rows.join(roots(rows.filter("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(table(spark, sf_dir, "documents")))
