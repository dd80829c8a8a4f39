import hashlib
import random
import re
import zlib

import numpy as np

from fundscope.llm import queries, runs


def brute(words):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if words[i] == words[i + q]:
                j = i
                while j < n - q and words[j] == words[j + q]:
                    j += 1
                s, e = i, j + q
                if e - s >= max(12, 2 * q) and not any(
                        all(words[k] == words[k + p] for k in range(s, e - p)) for p in range(1, q)):
                    out.append((s, e, q))
                i = j
            i += 1
    return sorted(out)


def random_words(rng):
    letters, words = rng.choice([1, 2, 2, 3, 5, 50]), []
    while len(words) < rng.choice([5, 13, 40, 150, 300]):
        unit = [rng.randrange(letters) for _ in range(rng.randrange(1, 60))]
        words += (unit * rng.randrange(1, 6))[: rng.randrange(1, 200)] if rng.random() < 0.5 else unit[:20]
    return [b"w%d" % x for x in words]


def test_transform_is_exact():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, runs.PRIME, (2, 3, 16)).astype(np.uint64)
    product = runs.transform(runs.transform(a) * runs.transform(b) % np.uint64(runs.PRIME), True)
    for r in range(3):
        want = [sum(int(a[r, i]) * int(b[r, (k - i) % 16]) for i in range(16)) * 16 % runs.PRIME
                for k in range(16)]
        assert product[r].tolist() == want


def test_occurrences_are_the_equal_blocks():
    words = np.array([5, 6, 7, 8] * 3 + [9, 5, 6, 7, 8] + [5, 6, 7, 8] * 4, np.int64)
    starts = np.array([0, 4, 8])
    at, q = runs.occurrences(words, starts, 4, 4, 12)
    want = [(s, d) for s in starts.tolist() for d in range(4, 12)
            if (words[s: s + 4] == words[s + d: s + d + 4]).all()]
    assert sorted(zip(at.tolist(), q.tolist())) == want


def test_runs_equal_brute_force():
    rng = random.Random(7)
    for _ in range(40):
        texts = [random_words(rng) for _ in range(rng.randrange(1, 6))] + [[]]
        for words, row in zip(texts, runs.analysed(texts), strict=True):
            assert row[5] == "".join(f"{s},{e - s},{d}\n" for s, e, d in brute(words))


def test_long_periodic_texts():
    for words, want in (([b"a"] * 300_000, (1, 0, 300_000, 1, 300_000_000)),
                        ([b"%d" % (i % 50) for i in range(100_000)], (1, 0, 100_000, 50, 2_000_000))):
        assert next(runs.analysed([words]))[:5] == want


def plain(doc_id, text):
    """The query's row, in plain Python."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    drop = {i for s, e, d in found for i in range(s + d, e)}
    s, e, d = min(found, key=lambda r: (r[0] - r[1], r[0], r[2]), default=(None, None, None))
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (
        "".join(f"{s},{e - s},{d}\n" for s, e, d in found),
        " ".join(w for i, w in enumerate(words) if i not in drop))]
    if not found:
        return (doc_id, 0, None, None, None, None, *digest)
    return (doc_id, len(found), s, e - s, d, 1000 * (e - s) // d, *digest)


def test_query_equals_plain_python(spark, make_docs, odd_rows, tmp_path):
    rng = random.Random(3)
    short = [r for r in odd_rows if len(r[1] or "") < 5000]
    rows = short + [(i, b" ".join(random_words(rng)).decode()) for i in range(60)]
    rows += [(500, "x\x1cy " * 20), (501, "a b " * 9 + "\x0b\x0c"), (502, "é " * 40)]
    make_docs(rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_periodic_runs(spark, str(tmp_path)).collect()
    want = [plain(i, t) for i, t, *_ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sum(w[1] > 0 for w in want) > 20


def test_interface(make_docs, odd_rows, clashing):
    docs = clashing(make_docs(odd_rows)).selectExpr("*", "'own' start", "'own' checksum", "'own' c0")
    out = runs.detect(docs)
    assert out.columns == [c for c in docs.columns if c != "text"] + [
        "n_runs", "start_", "length", "period", "exponent_milli", "runs_text", "collapsed"]
    rows = out.collect()
    assert len(rows) == len(odd_rows) and all(r.start == r.checksum == r.c0 == "own" for r in rows)
    assert runs.detect(make_docs([])).count() == 0
    row = runs.detect(make_docs([(1, "z " + "a b " * 10 + "y")])).first()
    assert (row.runs_text, row.collapsed) == ("1,20,2\n", "z a b y")
