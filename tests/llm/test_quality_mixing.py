import re
from collections import Counter, defaultdict

import pytest

from slotwise.llm import mixing, quality
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def plain(rows):
    return sorted(rows, key=repr)


def test_base_rules_match_brute_force(odd):
    got = quality.quality_rules(odd).collect()
    want = [(i, *base(t)) for i, t, _ in ODD]
    assert plain((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == plain(want)
    for r in got:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_frequent_lines_are_removed_from_all_but_the_first(make_docs):
    menu = "Home 12 about us contact help and further links of this menu here"
    rows = [(k, f"{menu}\nown {'abcdefghij'[k]} " + " ".join(f"w{k}x{j}" for j in range(4)), "h") for k in range(6)]
    rows += [(20 + k, menu.replace("12", str(k)) + "\n" + " ".join(f"u{k}v{j}" for j in range(40)), "h") for k in range(3)]
    rows += [(30, menu + "\nother host with words enough to be kept by rules", "z")]
    rows += [(40, rows[1][1], "h"), (40, rows[1][1], "h")]  # copies count as one document
    got = defaultdict(list)
    for r in quality.quality_rules(make_docs(rows), line_docs=3).collect():
        got[r["doc_id"]].append((r["removed_words"], r["kept"]))
    n = len(menu.split()) - 1  # the number is normalised away
    assert got[0] == [(0, True)]  # holds the line first
    assert all(got[k] == [(n, False)] for k in range(1, 6))
    assert all(got[20 + k] == [(n, True)] for k in range(3))  # enough left
    assert got[30] == [(0, True)] and got[40] == [(n, False)] * 2


def test_frequent_lines_leave_the_texts_of_kept_documents(make_docs):
    menu = "Home 12 about us"
    body = lambda k: "  " + " ".join(chr(97 + k) + chr(97 + j) for j in range(20)) + "\r"
    rows = [(k, f"{menu}\n{body(k)}\n\n{menu.replace('12', str(k))}\n", "h" if k < 8 else None) for k in range(16)]
    rows += [(20, f"{menu}\n{body(20)}", "z"), (21, rows[3][1], "h"), (None, f"{body(21)}\n{menu}", "h"), (22, None, "h"), (23, menu, "h")]
    out = quality.cleaned_documents(make_docs(rows), line_docs=3)
    got = {r["doc_id"]: r for r in out.collect()}
    for k in range(16):
        first = k in (0, 8)  # the first document of its host keeps the line
        assert got[k]["text"] == (rows[k][1] if first else f"{body(k)}\n\n")
    assert got[20]["text"] == rows[16][1] and got[21]["text"] == got[3]["text"] and got[None]["text"] == body(21)
    assert 22 not in got and 23 not in got  # too few words
    assert all(r["n_chars"] == len(r["text"]) for r in got.values()) and out.columns == make_docs([]).columns


def test_the_limit_does_not_grow_with_the_host(make_docs):
    """A line in 60 documents goes, whether its host has 100 documents or 12,000."""
    line = "the same licence line in sixty documents of this host"
    name = lambda k: "".join(chr(97 + k // 26**p % 26) for p in range(4))  # noqa: E731 - digits are normalised away
    body = lambda k: " ".join(name(k) + chr(97 + j) for j in range(26))
    marked = [(k, f"{line}\n{body(k)}", "h") for k in range(60)]
    for more in (40, 11_940):
        rows = marked + [(1000 + k, body(1000 + k), "h") for k in range(more)]
        got = {r["doc_id"]: r["removed_words"] for r in quality.quality_rules(make_docs(rows)).filter("doc_id < 100").collect()}
        assert got == {0: 0} | {k: len(line.split()) for k in range(1, 60)}


@pytest.mark.parametrize("most", [0, quality.BROADCAST])
def test_frequent_lines_joined_or_broadcast(make_docs, most):
    rows = [(k, f"menu one two\nown text {chr(97 + k)}\nmenu one two", "h") for k in range(8)] + [(3, "menu one two\nown text d\nmenu one two", "h")]
    got = quality.removed_words(make_docs(rows), line_docs=3, most=most).collect()
    assert sorted(r["removed_words"] for r in got) == [6] * 7


def test_copies_alone_are_no_reason_to_reject(make_docs):
    text = " ".join(f"word{j}" for j in range(30))
    got = quality.quality_rules(make_docs([(k, text, "h") for k in range(20)]), line_docs=3).collect()
    assert len(got) == 20 and all(r["kept"] for r in got)


def test_empty_tables(make_docs):
    none = make_docs([])
    assert quality.quality_rules(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert quality.quality_stage(None, none, "").count() == 0 and mixing.mixing_stage(None, none, "").count() == 0


def test_quality_stage_keeps_columns_and_repeated_rows(odd):
    out = quality.quality_stage(None, odd, "")
    assert out.columns == odd.columns
    want = Counter(r["doc_id"] for r in quality.quality_rules(odd).collect() if r["kept"])
    assert Counter(r["doc_id"] for r in out.collect()) == want


def targets(sizes, weights=(1, 2, 3), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    left, fixed = set(order), {}
    while left:
        rest = sum(sizes.values()) - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[x] for x in left) for s in left}
        over = {s for s in left if share[s] > cap * sizes[s]}
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}
        left -= over
    return fixed


@pytest.mark.parametrize("min_bucket", [2, 4096])
def test_mix_meets_its_targets(make_docs, min_bucket):
    rows = [(k, "w " * (1 + k * 7 % 50), s) for k, s in enumerate(["a"] * 90 + ["b"] * 40 + ["c"] * 3 + [None] * 20 + ["é"] * 5 + ["Z"])]
    rows += [(500, None, "empty"), (501, "", "empty"), (502, "w " * 9, "a"), (502, "w " * 9, "a")]
    d = make_docs(rows)
    got = mixing.mix(d, min_bucket=min_bucket).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = targets(sizes)
    taken = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixing.mix(d.repartition(7), min_bucket=min_bucket).collect()
    assert plain(map(tuple, got)) == plain(map(tuple, again))


def test_mixing_stage_repeats_whole_documents(make_docs):
    d = make_docs([(k, "w " * 10, s) for k, s in enumerate(["a"] * 60 + ["b"] * 6 + ["c"] * 6)])
    out = mixing.mixing_stage(None, d, "")
    n = Counter(r["source"] for r in out.collect())
    assert out.columns == d.columns and n["b"] == 18 and n["c"] == 18 and n["a"] == 36
