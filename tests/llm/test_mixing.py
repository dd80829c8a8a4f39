import random
from collections import defaultdict

import numpy as np
import pytest

from fundscope.llm import mixing as mx


@pytest.fixture(scope="module")
def mixed(make_docs):
    rng = random.Random(1)
    rows = [(i, " ".join(f"{rng.choice(['alphabet', 'butterfly', 'cathedral', 'of', 'an'])}"
                         for _ in range(rng.randrange(5, 60))),
             rng.choice(["en", "en", "en", "de"]), rng.choice(["a"] * 8 + ["b", "c"]))
            for i in range(1500)]
    return rows, make_docs(rows)


def numpy_rake(tokens, goals, rounds=200):
    f = (tokens > 0).astype(float)
    for _ in range(rounds):
        for axis, goal in enumerate(goals):
            other = tuple(i for i in range(3) if i != axis)
            own = (tokens * f).sum(other)
            scale = np.where(own > 0, goal / np.where(own > 0, own, 1), 0)
            f = f * scale.reshape([-1 if i == axis else 1 for i in range(3)])
    return f


def test_weights_match_plain_fitting(mixed):
    rows, docs = mixed
    got = mx.mixture(docs).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows}
    assert all(r.n_tokens == len(text[r.doc_id].split()) and r.topic == mx.topic_of(text[r.doc_id])
               for r in got)
    values = [sorted({getattr(r, d) for r in got}) for d in mx.DIMENSIONS]
    tokens = np.zeros([len(v) for v in values])
    cell = lambda r: tuple(v.index(getattr(r, d)) for v, d in zip(values, mx.DIMENSIONS, strict=True))
    for r in got:
        tokens[cell(r)] += r.n_tokens
    goals = []
    for axis in range(3):
        own = tokens.sum(tuple(i for i in range(3) if i != axis)) ** mx.TEMPER
        goals.append(own / own.sum() * tokens.sum())
    want = numpy_rake(tokens, goals)
    for r in got:
        assert np.isclose(r.factor, want[cell(r)], rtol=5e-3)
    expected = sum(r.prob * r.n_tokens for r in got)
    assert np.isclose(expected, mx.KEEP_SHARE * tokens.sum(), rtol=2e-3)
    share = defaultdict(float)
    for r in got:
        share[r.source] += r.n_tokens * r.factor
    for v, g in zip(values[0], goals[0], strict=True):
        assert np.isclose(share[v], g, rtol=2e-3)
    drawn = np.mean([r.sampled for r in got])
    assert abs(drawn - np.mean([r.prob for r in got])) < 0.05


def test_given_targets_and_repeatable_draws(spark, mixed):
    _, docs = mixed
    target = spark.createDataFrame([("a", 0.5), ("b", 0.5), ("missing", 0.3)], "source string, target double")
    got = mx.mixture(docs, {"source": target}).collect()
    own = defaultdict(float)
    for r in got:
        own[r.source] += r.n_tokens * r.factor
    assert np.isclose(own["a"], own["b"], rtol=1e-3) and own["c"] == 0
    assert not any(r.sampled for r in got if r.source == "c")
    first = sorted(r.doc_id for r in mx.sample(docs).collect())
    assert first == sorted(r.doc_id for r in mx.sample(docs.repartition(7)).collect())


def test_odd_rows(make_docs, odd_rows, clashing):
    docs = clashing(make_docs(odd_rows))
    got = mx.mixture(docs).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.prob <= 1 for r in got)
    assert {r.source for r in got} == {"und", "a", "b", "c"}
    assert len({r.sampled for r in got if r.doc_id == 4}) == 1
    kept = mx.sample(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r.doc_id) for r in got if r.sampled)
    assert mx.mixture(make_docs([])).count() == 0 and mx.sample(make_docs([])).count() == 0
    blank = mx.mixture(make_docs([(1, None), (2, "")])).collect()
    assert all(r.sampled for r in blank)
