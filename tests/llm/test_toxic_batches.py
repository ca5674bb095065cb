"""Emissions and marginals of whole batches equal those of single tokens and documents."""

import itertools
import random

import numpy as np

from slotwise.llm import toxicity


def make_field():
    rng = np.random.default_rng(3)
    weights = rng.normal(size=1 << toxicity.BITS).astype(np.float32)
    return toxicity.Field(weights, -0.7, np.array([[0.0, -1.2], [0.3, 0.9]]), np.array([0.1, 0.5, 0.2]), 0.1)


def test_batch_emissions_equal_single_ones():
    rng = random.Random(5)
    tokens = ["", "_", "ab", "Abc", "abcd", "abcde", "abcdef", "abcdefg", "a.b,c", "É́clair", "İx", "中文字字", "x²", "(abc)"]
    tokens += ["".join(rng.choice("abzA9_.é中İ") for _ in range(rng.randrange(10))) for _ in range(500)]
    field = make_field()
    assert field.emissions(tokens).tolist() == [field.emission(t) for t in tokens]
    assert field.emissions([]).tolist() == []


def test_marginals_equal_enumeration():
    field, rng = make_field(), np.random.default_rng(4)
    docs = [rng.normal(size=n) for n in (3, 0, 6, 1, 6)]
    for e, got in zip(docs, field.marginals(docs)):
        sums = np.zeros((len(e), 2))
        for tags in itertools.product((0, 1), repeat=len(e)):
            p = np.exp(sum(e[i] for i, y in enumerate(tags) if y) + sum(field.trans[a, b] for a, b in zip(tags, tags[1:])))
            for i, y in enumerate(tags):
                sums[i, y] += p
        assert np.allclose(got, np.log(sums[:, 1] / sums[:, 0]), atol=1e-9)
    assert [len(x) for x in field.marginals([np.zeros(0)])] == [0] and field.marginals([]) == []


def test_scoring_takes_tokens_in_batches(monkeypatch):
    """One call a batch of documents, none a token (op2 was over its CPU budget)."""
    monkeypatch.setattr(toxicity.Field, "emission", None)
    field = make_field()
    rows = list(field.emissions(["one", "two", "One."]))
    assert rows[0] == rows[2]
