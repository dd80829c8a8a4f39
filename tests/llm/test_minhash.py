import os
import random
from itertools import combinations

import numpy as np
import pytest

import fundscope.llm.components as components_module
from fundscope.llm import minhash as mh
from fundscope.llm.components import components


def jaccard(a, b, weighting="set"):
    (x, m), (y, n) = mh.shingles(a), mh.shingles(b)
    if not len(x) or not len(y):
        return float(a == b)
    x, y = dict(zip(x.tolist(), m.tolist())), dict(zip(y.tolist(), n.tolist()))
    if weighting == "set":
        x, y = dict.fromkeys(x, 1), dict.fromkeys(y, 1)
    common = sum(min(v, y.get(k, 0)) for k, v in x.items())
    return common / (sum(x.values()) + sum(y.values()) - common)


def brute_classes(rows, weighting="set"):
    texts = [t or "" for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if texts[i] == texts[j] or jaccard(texts[i], texts[j], weighting) >= mh.SIMILARITY:
            parent[find(j)] = find(i)
    classes = {}
    for i in range(len(rows)):
        classes.setdefault(find(i), []).append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in classes.items()}
    return sorted(((rows[i][0], least[find(i)]) for i in range(len(rows))), key=str)


def near_copies(rng, n, size, edits):
    base = [f"b{rng.randrange(900)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(edits):
            w[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def classes(df, **kw):
    return sorted(((r.doc_id, r.class_id) for r in mh.near_duplicates(df, **kw).collect()), key=str)


@pytest.mark.parametrize("weighting", ["set", "count"])
def test_classes_match_brute_force(make_docs, weighting):
    rng = random.Random(3)
    texts = (near_copies(rng, 12, 300, 3) + near_copies(rng, 10, 300, 9) + near_copies(rng, 8, 40, 1)
             + [" ".join(f"u{rng.randrange(10**6)}" for _ in range(80)) for _ in range(20)])
    texts += texts[:5] + [texts[0] + " " + texts[0], "a b", "a b c d", "A  b", "", None, " "]
    rows = [(i, t) for i, t in enumerate(texts)]
    # pairs within 0.001 of the threshold would be a matter of luck for any sketch
    assert all(abs(jaccard(a or "", b or "", weighting) - 0.8) > 1e-3
               for a, b in combinations(texts, 2))
    assert classes(make_docs(rows), weighting=weighting) == brute_classes(rows, weighting)


def test_odd_rows_and_keep_one(make_docs, odd_rows, clashing):
    rows = [(r[0], r[1]) for r in odd_rows]
    assert classes(make_docs(odd_rows)) == brute_classes(rows)
    docs = clashing(make_docs(odd_rows))
    kept = mh.keep_one(docs)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    # null and empty are one text here; ids 4, 4, 5 and null hold the same body
    assert len(texts) == len({t or "" for _, t in rows})
    assert [r.doc_id for r in kept.collect() if r.text == rows[4][1]] == [4]
    assert mh.near_duplicates(make_docs([])).count() == 0
    assert mh.keep_one(make_docs([])).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    e = rng.integers(0, 2**63, 200).astype(np.uint64)
    a, b = rng.uniform(.1, 9, 200), rng.uniform(.1, 9, 200)
    s = mh.dart_signatures([e, e, e[:3]], [a, b, a[:3]], 3000)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((s[0] == s[1]).mean() - true) < 0.04
    alone = mh.dart_signatures([e[:3]], [a[:3]], 3000)
    assert (alone[0] == s[2]).all()                        # the company does not matter


def test_buckets_with_several_classes_are_compared_completely(spark, make_docs):
    # one band of one row: nearly everything shares a bucket with something else
    rng = random.Random(9)
    texts = [t for _ in range(6) for t in near_copies(rng, 4, 120, 1)]
    rows = list(enumerate(texts))
    got = dict(classes(make_docs(rows), bands=60, rows=1))
    want = dict(brute_classes(rows))
    assert got == want


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (9, 8), (5, 5)] + [(100, i) for i in range(101, 140)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8, 5: 5} | {i: 100 for i in range(100, 140)}
    assert got == want


def test_tables_of_the_way_go(spark, make_docs, monkeypatch):
    """Buckets, shingles, pairs and rounds of labels leave the disk when they have been read."""
    paths = []
    real = mh.stored

    def stored(df, name):
        out = real(df, name)
        paths.append(out.stored_path)
        return out

    monkeypatch.setattr(mh, "stored", stored)
    monkeypatch.setattr(components_module, "stored", stored)
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(80)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(50 + i, t + " end") for i, t in enumerate(texts)]
    out = mh.near_duplicates(make_docs(rows))
    assert out.select("class_id").distinct().count() == 20
    left = {os.path.basename(p).rsplit("-", 1)[0] for p in paths if os.path.exists(p.removeprefix("file:"))}
    assert left == {"sketches", "nodes", "labels"}
