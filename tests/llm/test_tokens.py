import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotwise.llm import packing, pieces, prefix_tokens
from slotwise.llm.common import vocabulary
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def counter():
    return prefix_tokens.PrefixCounter()


@pytest.fixture(scope="module")
def codec():
    return pieces.PieceCodec()


def strings(seed, n=400):
    rng = random.Random(seed)
    alphabet = [*"aab  \n\n\t''<>|12srevldt.é²Ⅷ中🙂\x1c\x85▁ñ", "<|endoftext|>", "'re", "'ll", " the", "   ", "----", "<s>", "<0x0A>", "\r\n"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_every_prefix_has_the_librarys_count(counter):
    for s in strings(1):
        got = np.cumsum(counter.changes([s])[0], dtype=np.int64).tolist()
        assert got == [len(counter.library.encode(s[: k + 1], add_special_tokens=False).ids) for k in range(len(s))], repr(s)


def test_budget_questions(counter):
    text = "the quick brown fox jumps over the lazy dog " * 20
    c = counter.changes([text])[0].tobytes()
    n = prefix_tokens.fitting_prefix(c, 50)
    assert prefix_tokens.tokens_at(c, n) <= 50 < prefix_tokens.tokens_at(c, n + 1)
    assert prefix_tokens.fitting_prefix(c, 0) == 0 and prefix_tokens.fitting_prefix(b"", 5) == 0


def test_prefix_counts_of_odd_rows(odd, counter):
    got = prefix_tokens.prefix_token_counts(odd).collect()
    want = [(i, len((t or "").encode()), len(counter.library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in ODD]
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got), key=repr) == sorted(want, key=repr)
    assert prefix_tokens.prefix_token_counts(odd.limit(0)).count() == 0


def test_memo_forgets_without_changing_results():
    c = prefix_tokens.PrefixCounter()
    c.cache.size = 3
    texts = strings(5, 60)
    want = [len(c.library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert [int(x.sum(dtype=np.int64)) for t in texts for x in c.changes([t])] == want


def test_pieces_match_the_library_and_decode(codec):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=vocabulary(pieces.MODEL))
    texts = strings(2) + [t or "" for _, t, _ in ODD]
    ids = codec.encode(texts)
    assert codec.merges
    assert [x.tolist() for x in ids] == sp.encode(texts, num_threads=1)
    assert [codec.decode(x) for x in ids] == [t.replace("▁", " ") for t in texts]


def test_viterbi_finds_the_best_score(codec):
    rng = random.Random(3)
    old = codec.scores, codec.ids
    vocab = {p: -rng.random() * 5 for p in ["a", "b", "c", "ab", "bc", "abc", "ca", "aa", "bb", "cab"]}
    codec.scores, codec.ids = vocab, {p: k for k, p in enumerate(vocab)}
    try:
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 8))) for _ in range(80)})

        def best(w):
            return max(([0.0] if not w else [vocab[w[:k]] + best(w[k:]) for k in range(1, len(w) + 1) if w[:k] in vocab]), default=-1e9)

        for w, last, _ in codec._viterbi(words):
            i, total = len(w), 0.0
            while i:
                total += vocab[w[i - last[i] : i]]
                i -= last[i]
            assert total == pytest.approx(best(w))
    finally:
        codec.scores, codec.ids = old


def test_code_pieces_keeps_rows_and_columns(odd, codec):
    out = pieces.code_pieces(odd, decoded_col="decoded")
    assert out.columns == [*odd.columns, "piece_ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r["piece_ids"] == codec.encode([r["text"] or ""])[0].tolist() and r["decoded"] == (r["text"] or "").replace("▁", " ")
    again = pieces.decode_pieces(out.select("doc_id", "piece_ids")).collect()
    assert sorted(r["decoded"] for r in again) == sorted(r["decoded"] for r in rows)
    assert pieces.code_pieces(odd.limit(0)).count() == 0


def test_best_fit_decreasing_equals_a_plain_search():
    rng = random.Random(4)
    for _ in range(30):
        lengths = [rng.randint(1, 50) for _ in range(rng.randint(0, 60))]
        room, rows = [], []
        for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
            fit = [r for r in range(len(room)) if room[r] >= lengths[k]]
            if not fit:
                room.append(50)
                rows.append([])
                fit = [len(room) - 1]
            r = min(fit, key=lambda r: room[r])
            room[r] -= lengths[k]
            rows[r].append(k)
        got = packing.pack(lengths, 50)
        assert sorted(k for r in got for k in r) == list(range(len(lengths)))
        assert sorted(sum(lengths[k] for k in r) for r in got) == sorted(50 - x for x in room)


def test_packed_rows_restore_every_document(make_docs):
    rows = [(i, t, s) for i, t, s in ODD if i is not None]
    rows = list({r[0]: r for r in rows}.values())
    d = make_docs(rows)
    p = packing.pack_documents(d, length=64)
    back = {r["doc_id"]: r["tokens"] for r in packing.unpacked(p).collect()}
    enc = packing._encoder(packing.RANKS)
    assert back == {i: enc.encode_ordinary(t) for i, t, _ in rows if t}
    for r in p.collect():
        assert len(r["input_ids"]) == len(r["position_ids"]) == 64
        cu = r["cu_seqlens"]
        assert cu[0] == 0 and cu[-1] == r["n_tokens"] <= 64 and len(cu) == len(r["doc_ids"]) + 1
        for a, b in zip(cu, cu[1:]):
            assert b > a and r["position_ids"][a:b] == list(range(b - a))
        assert r["input_ids"][cu[-1] :] == [packing.PAD] * (64 - cu[-1])
    assert packing.pack_documents(d.limit(0)).count() == 0
    assert packing.pack_documents(d.filter(F.col("text").isNull())).count() == 0
