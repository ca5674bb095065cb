import base64
import hashlib
import json
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from slotwise.llm import alignment, byte_bpe
from slotwise.llm.common import vocabulary
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def library():
    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary(byte_bpe.VOCABULARY), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain(rows):
    return sorted(rows, key=repr)


def sha(data):
    return hashlib.sha256(data).hexdigest()


MORE = [(100, "x" * 5000 + "ab" * 700, "a"), (101, "mississippi" * 60 + " " * 40 + "\n\n\t z", "a"), (102, "don't we'll '' 've 12345678901234567890", None)]


def test_ids_and_bytes_equal_the_library(make_docs, library):
    got = byte_bpe.round_trip_digests(make_docs(ODD + MORE)).collect()
    want = []
    for i, t, _ in ODD + MORE:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode())))
    assert plain(map(tuple, got)) == plain(want)


def test_encode_and_decode_keep_rows_and_columns(make_docs, library):
    docs = make_docs(ODD)
    ids = byte_bpe.encode_bytes(docs)
    assert ids.columns == [*docs.columns, "token_ids"]
    back = byte_bpe.decode_bytes(ids, decoded_col="kept")  # replaces the column of that name
    rows = back.collect()
    assert len(rows) == len(ODD) and back.columns.count("kept") == 1
    for r in rows:
        assert r["token_ids"] == library.encode_ordinary(r["text"] or "") and bytes(r["kept"]).decode() == (r["text"] or "")
    assert byte_bpe.encode_bytes(make_docs([])).count() == 0 and byte_bpe.round_trip_digests(make_docs([])).count() == 0


def test_unknown_ids_are_refused():
    with pytest.raises(ValueError, match="not in the vocabulary"):
        byte_bpe._codec(byte_bpe.VOCABULARY).decode([np.array([5, 10**6])])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abxé '1\n中", max_size=60), max_size=6))
def test_both_contractions_agree(library, texts):
    codec = byte_bpe._codec(byte_bpe.VOCABULARY)
    words = sorted({w.encode() for t in texts for w in codec.split(t)})
    one, every = (codec.contract(words, sql) for sql in (byte_bpe.ONE_A_ROUND, byte_bpe.ALL_A_ROUND))
    assert one == every
    for w, ids in zip(words, one):
        if w not in codec.rank:
            assert library.encode_ordinary(w.decode()) == np.frombuffer(ids, np.int32).tolist() or len(codec.split(w.decode())) > 1


def test_a_recursion_cut_short_goes_on(library, monkeypatch):
    codec = byte_bpe._codec(byte_bpe.VOCABULARY)
    words = [b" " + w for w in (b"incomprehensibilities", b"xyzzyxyzzyx", b"aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaab")]
    want = codec.contract(words)
    monkeypatch.setattr(byte_bpe, "ROWS", 100)
    assert codec.contract(words) == want and codec.contract(words, byte_bpe.ALL_A_ROUND) == want


# --- alignment ---------------------------------------------------------------


def brute(rows):
    """Groups, links and scores token by token."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabulary(alignment.LEFT))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=vocabulary(alignment.RIGHT))
    level = {chr(k): v for k, v in ((ord(c), v) for c, v in alignment._byte_level().items())}
    names = {i: t for t, i in json.load(open(vocabulary(alignment.LEFT)))["model"]["vocab"].items()}
    a_bytes = lambda i: bytes(level[c] for c in names[i])
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    docs, total, docs_of = [], Counter(), defaultdict(set)
    for k, (_, t, _) in enumerate(rows):
        t = t or ""
        x, y = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        whole = (" " + t).encode()
        if b"".join(map(a_bytes, x)) != whole or b"".join(map(b_bytes, y)) != whole:
            x, y = [], []
        spans = []
        for ids, f in ((x, a_bytes), (y, b_bytes)):
            at, out = 0, []
            for i in ids:
                out.append((at, at := at + len(f(i)), i))
            spans.append(out)
        links = [(p[2], q[2]) for p in spans[0] for q in spans[1] if p[0] < q[1] and q[0] < p[1]]
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = ["|".join(",".join(str(i) for s, e, i in side if lo <= s and e <= hi) for side in spans) for lo, hi in zip([0, *cuts], cuts)]
        docs.append((len(x), len(y), len(cuts), links, ";".join(groups)))
        total.update(links)
        for p in links:
            docs_of[p].add(k)
    top = Counter()
    for (_, q), n in total.items():
        top[q] = max(top[q], n)
    out = [(i, na, nb, ng, len(li), sum(total[p] == top[p[1]] for p in li), sum(total[p] for p in li), g) for (i, _, _), (na, nb, ng, li, g) in zip(rows, docs)]
    return out, {p: (len(docs_of[p]), n, n == top[p[1]]) for p, n in total.items()}


SHORT = [r for r in ODD if len(r[1] or "") < 5000] + [(200, "the cat " * 40, "a"), (201, "▁ literal marker", "a"), (202, "日本語 naïve coöperate 🙂🙂", "b"), (203, "the cat sat", None)]


def test_alignment_equals_brute_force(make_docs, monkeypatch):
    want, pairs = brute(SHORT)
    got, index = alignment.align(make_docs(SHORT).repartition(3))
    assert plain(map(tuple, got.collect())) == plain(want)
    assert {(r["a"], r["b"]): (r["n_docs"], r["n_links"], r["best"]) for r in index.collect()} == pairs
    digests, _ = alignment.align(make_docs(SHORT).coalesce(1), digest=True)
    assert plain(tuple(r) for r in digests.collect()) == plain((*w[:-1], sha(w[-1].encode()) if w[-1] else "") for w in want)


def test_scores_without_a_broadcast(make_docs, monkeypatch):
    want, _ = brute(SHORT)
    monkeypatch.setattr(alignment.document_scores, "__defaults__", (3,))
    got, _ = alignment.align(make_docs(SHORT).repartition(3))
    assert plain(map(tuple, got.collect())) == plain(want)


def test_alignment_of_nothing(make_docs):
    rows, pairs = alignment.align(make_docs([]))
    assert rows.count() == 0 and pairs.count() == 0


def test_postings_round_trip():
    rng = np.random.default_rng(3)
    docs = 3000
    # pair 7 in most documents (a bitmap of bits), pair 9 in few, up to 40 links a document
    pairs = rng.choice([7, 9 << 30, 11], 20_000, p=[0.8, 0.19, 0.01])
    entries = np.concatenate([pairs << 16 | rng.integers(0, docs, 20_000), np.full(40, (9 << 30) << 16 | 5)])
    keys, bitmaps, planes = alignment.postings(entries, docs)
    want = Counter((e >> 16, e & 0xFFFF) for e in entries.tolist())
    got = Counter()
    row, number = alignment.numbers_of(bitmaps)
    for r, n in zip(keys[row].tolist(), number.tolist()):
        got[r, n] += 1
    for r, some in enumerate(planes):
        for k, bitmap in enumerate(some):
            for n in alignment.numbers_of(pa.array([bitmap.as_py()], pa.binary()))[1].tolist():
                got[int(keys[r]), n] += 2**k
    assert got == want and any(len(b.as_py()) % 2 for b in bitmaps)
    part = alignment.numbers_of(bitmaps.slice(1))
    assert part[1].tolist() == number[row > 0].tolist()
