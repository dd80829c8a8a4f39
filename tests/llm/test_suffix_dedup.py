import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fundscope.llm import suffix_array as sa
from fundscope.llm import suffix_dedup as sd


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    found = Counter(t[i: i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if found[t[i: i + length]] > 1:
                gone[i: i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(df, **kw):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                   for r in sd.suffix_dedup(df, **kw).collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_induced_sorting(symbols):
    data = bytes(symbols) + b"\0"
    got = sa.induced_suffix_array(np.frombuffer(data, np.uint8))
    assert got.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    lcp = sa.permuted_lcp(data, got)
    for a, b in zip(got[:-1], got[1:], strict=True):
        n = 0
        while data[a + n] == data[b + n]:
            n += 1
        assert lcp[b] == n


def passages(rng, n):
    shared = ["".join(rng.choice("abcdé \n") for _ in range(rng.randrange(10, 120))) for _ in range(4)]
    return [(i, "".join("".join(rng.choice("abc xyzñ") for _ in range(rng.randrange(60)))
                        + rng.choice([*shared, "", "ab" * 30]) for _ in range(rng.randrange(5))))
            for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 500}, {"hot_pieces": 1}])
def test_matches_brute_force(make_docs, options):
    rows = passages(random.Random(1), 60)
    rows += [(i, rows[i][1]) for i in range(4)]            # repeated rows
    for length in (20, 130):
        assert run(make_docs(rows), length=length, **options) == brute(rows, length)


def test_odd_rows(make_docs, odd_rows, clashing):
    rows = [(r[0], r[1]) for r in odd_rows]
    assert run(clashing(make_docs(odd_rows))) == brute(rows, sd.LENGTH)
    assert run(make_docs([])) == []


def test_chunks_of_a_long_text(monkeypatch):
    rng = np.random.default_rng(0)
    data = np.tile(rng.integers(97, 123, 3000).astype(np.uint8), 3)
    first, place, hashes = sd.anchors(data)
    monkeypatch.setattr(sd, "CHUNK", 777)
    cut = sd.anchors(data)
    # chunks may split a run, never move an anchor
    window = np.arange(len(data) - sd.LENGTH + 1)
    at = place[np.searchsorted(first, window, "right") - 1]
    assert (at == cut[1][np.searchsorted(cut[0], window, "right") - 1]).all()
    assert set(cut[2]) == set(hashes)
