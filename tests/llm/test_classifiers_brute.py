"""Both classifiers against plain Python: features, leader updates and scores, number by number."""
import math
import re
import zlib
from collections import Counter

import numpy as np

from fundscope.llm import ftrl, langid
from fundscope.llm import quality_classifier as qc

M = 2**64


class PlainFtrl:
    """Follow the regularised leader, coordinate by coordinate in dicts."""

    def __init__(self, classes, alpha=0.5, beta=1.0, l1=0.05, l2=0.01):
        self.c, self.a, self.b, self.l1, self.l2 = classes, alpha, beta, l1, l2
        self.z, self.n = Counter(), Counter()

    def w(self, f, k):
        z, n = self.z[f, k], self.n[f, k]
        if abs(z) <= self.l1:
            return 0.0
        return -(z - math.copysign(self.l1, z)) / ((self.b + math.sqrt(n)) / self.a + self.l2)

    def p(self, x):
        m = [sum(self.w(f, k) * v for f, v in x.items()) for k in range(self.c)]
        if self.c == 1:
            return [1 / (1 + math.exp(-max(-30, min(30, m[0]))))]
        e = [math.exp(v - max(m)) for v in m]
        return [v / sum(e) for v in e]

    def step(self, x, target):
        p = self.p(x)
        grad = {(f, k): v * (p[k] - target[k]) for f, v in x.items() for k in range(self.c)}
        old = {key: self.w(*key) for key in grad}
        for key, g in grad.items():
            grown = self.n[key] + g * g
            self.z[key] += g - (math.sqrt(grown) - math.sqrt(self.n[key])) / self.a * old[key]
            self.n[key] = grown


def plain_fit(examples, targets, epochs, classes, seed=1):
    model, order = PlainFtrl(classes), np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            model.step({**examples[i], "intercept": 1.0}, targets[i])
    return model


def test_leader_updates():
    rng = np.random.default_rng(0)
    for classes in (1, 3):
        at = [np.sort(rng.choice(30, 6, replace=False)) for _ in range(120)]
        x = [rng.random(6).astype(np.float32) * 3 for _ in at]
        label = [int(a[0] + a[1]) % max(classes, 2) for a in at]
        targets = np.array([[y] if classes == 1 else np.eye(classes)[y] for y in label], np.float32)
        got = ftrl.Ftrl(30, classes).fit(list(zip(at, x)), targets, 4).weights()
        want = plain_fit([dict(zip(a.tolist(), v.tolist())) for a, v in zip(at, x)], targets.tolist(), 4, classes)
        for k in range(classes):
            assert np.allclose(got[:-1, k], [want.w(f, k) for f in range(30)], atol=2e-3)
            assert np.isclose(got[-1, k], want.w("intercept", k), atol=2e-3)
        sparse = ftrl.Ftrl(30, classes, l1=5.0).fit(list(zip(at, x)), targets, 4).weights()
        assert (sparse == 0).sum() > (got == 0).sum()      # the L1 part


def quality_grams(text):
    one = []
    for t in re.findall(r"\w+|[^\w\s]", text or ""):
        if not t[0].isalnum():
            kind = 8 + ord(t[0]) % 248
        elif not t.isalpha():
            kind = 4
        else:
            kind = 0 if t.islower() else 1 if t.istitle() else 2 if t.isupper() else 3
        one.append(zlib.crc32(t.encode()) * 256 + kind)
    pair = int(qc.PAIR)
    keys = [x * pair for x in one]
    keys += [(x * pair + y + 1) * pair for x, y in zip(one, one[1:])]
    keys += [((x % 256 * 256 + y % 256) + 2**60) * pair for x, y in zip(one, one[1:])]
    for i, x in enumerate(one):
        same = sum(1 << lag for lag in (1, 2, 3) if i >= lag and one[i - lag] == x)
        keys.append((same * 256 + x % 256 + 2**61) * pair)
    return [k % M >> 46 for k in keys]


def test_quality_scores(spark, make_docs):
    rng = np.random.default_rng(5)
    good, bad = "the cat sat on a mat and Slept".split(), "XX ## zz9 zz9 | qq".split()
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad, 12)) + (" the cat" if i % 5 == 0 else "")) for i in range(60)]
    rows += [(60, ""), (61, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in qc.score(make_docs(rows).select("doc_id", "text"),
                                               qc.train(make_docs(rows), labels)).collect()}
    examples = []
    for _, text in rows[:50]:
        n = Counter(quality_grams(text))
        examples.append({f: qc.SCALE * c / sum(n.values()) for f, c in n.items()})
    model = plain_fit(examples, [[i % 2] for i in range(50)], qc.EPOCHS, 1)
    for i, text in rows:
        grams = quality_grams(text)
        margin = sum(qc.SCALE * model.w(f, 0) for f in grams) / max(1, len(grams)) + model.w("intercept", 0)
        assert np.isclose(got[i], 1 / (1 + math.exp(-margin)), atol=5e-3), (i, got[i])
    assert qc.gram_numbers("A a a. é12 ÉÉ 日本\n_x").tolist() == quality_grams("A a a. é12 ÉÉ 日本\n_x")


def language_grams(text):
    c = [ord(x) for x in text.lower()]
    out = []
    for size in (1, 2, 3):
        for i in range(len(c) - size + 1):
            key = c[i]
            for x in c[i + 1: i + size]:
                key = key * int(langid.MIX[1]) + x
            out.append((key + size) * int(langid.MIX[0]) % M >> 48)
    return out


def test_language_predictions(make_docs):
    """Frequencies, inverse frequencies, updates, temperature and scores of a small table."""
    words = {"de": "der die das und ist", "en": "the and of is a", "fr": "le la les et est"}
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(words[k].split(), 3 + i % 7)) + f" {i}", k, "s")
            for i, k in enumerate(sorted(words) * 12)]
    langs, w = langid.train(make_docs(rows))
    assert langs == sorted(words)
    df = Counter(f for _, t, *_ in rows for f in set(language_grams(t)))
    idf = {f: math.log((1 + len(rows)) / (1 + n)) + 1 for f, n in df.items()}
    table = []
    for _, text, lang, _ in rows:
        n = Counter(language_grams(text))
        shares = {f: np.float32(c / sum(n.values())) for f, c in sorted(n.items())}
        order = (len(n), float(np.array(list(shares.values()), np.float32).sum()), sum(n))
        table.append((lang, order, {f: langid.SCALE * float(v) * idf[f] for f, v in shares.items()}))
    table.sort(key=lambda r: r[:2])
    held = [i % langid.CALIBRATE_EVERY == 0 for i in range(len(table))]
    learn = [r for r, h in zip(table, held) if not h]
    one_hot = [[float(r[0] == k) for k in langs] for r in learn]
    model = plain_fit([r[2] for r in learn], one_hot, langid.EPOCHS, 3)
    margins = np.array([[sum(v * model.w(f, k) for f, v in r[2].items()) + model.w("intercept", k)
                         for k in range(3)] for r, h in zip(table, held) if h])
    heat = ftrl.best_temperature(margins, np.array([langs.index(r[0]) for r, h in zip(table, held) if h]))
    got = {r.doc_id: r for r in langid.predict(make_docs(rows), (langs, w)).collect()}
    for i, text, *_ in rows:
        grams = language_grams(text)
        m = [(sum(langid.SCALE * idf[f] * model.w(f, k) for f in grams) / len(grams)
              + model.w("intercept", k)) / heat for k in range(3)]
        p = [math.exp(x - max(m)) for x in m]
        best = max(range(3), key=p.__getitem__)
        assert got[i].lang_pred == langs[best]
        assert np.isclose(got[i].score, p[best] / sum(p), atol=0.02)
    assert langid.gram_numbers("Äb 日").tolist() == language_grams("Äb 日")
