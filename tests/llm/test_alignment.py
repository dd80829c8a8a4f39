import hashlib
import json
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fundscope.llm import alignment as al
from fundscope.llm.bpe import byte_alphabet

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


def spans(tokens):
    out, at = [], 0
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def brute(texts):
    """NEW of each text by the libraries and byte ranges."""
    a_model = Tokenizer.from_file(A)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=B)
    byte_of = {c: b for b, c in enumerate(byte_alphabet())}
    rows, held = [], Counter()
    for text in texts:
        rows.append(None)
        if not text:
            continue
        whole = a_model.encode(" " + text, add_special_tokens=False)
        a, b = whole.ids, b_model.encode(text)
        a_bytes = [bytes(byte_of[c] for c in t) for t in whole.tokens]
        pieces = [b_model.id_to_piece(i) for i in b]
        b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p)
                   else p.replace("▁", " ").encode() for p in pieces]
        if {b"".join(a_bytes), b"".join(b_bytes)} != {(" " + text).encode()}:
            continue
        sa, sb = spans(a_bytes), spans(b_bytes)
        links, low = [], 0
        for i, (s, e) in enumerate(sa):
            while sb[low][1] <= s:
                low += 1
            j = low
            while j < len(sb) and sb[j][0] < e:
                links.append((a[i], b[j]))
                j += 1
        ends_b, groups, i, j = {e: k for k, (_, e) in enumerate(sb)}, [], 0, 0
        for k, (_, e) in enumerate(sa):
            if e in ends_b:
                groups.append(",".join(map(str, a[i: k + 1])) + "|" + ",".join(map(str, b[j: ends_b[e] + 1])))
                i, j = k + 1, ends_b[e] + 1
        rows[-1] = (len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())
        held.update(set(links))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return [(0, 0, 0, 0, 0, 0, "") if r is None else
            (*r[:3], len(r[3]), sum(held[x] == top[x[0]] for x in r[3]), sum(held[x] for x in r[3]), r[4])
            for r in rows]


TEXTS = ["a  b", " leading", "trailing \n\n", "\t tabs\r\n", "Ａｂ ﬁ é 日本語 😀", "<|endoftext|> <s></s> <unk> <0x41>",
         "a" * 3000, " " * 900 + "x", "nul \x00 here", "", None, "don't we'll I'M", "x", "​ zero ‍ width"]


def test_equals_brute_force(spark, make_docs, odd_rows, clashing):
    real = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80).collect()]
    rows = list(odd_rows) + [(100 + i, t) for i, t in enumerate([*TEXTS, *real, *real[:5]])]
    docs = clashing(make_docs(rows)).selectExpr("*", "'own' n_a", "'own' block", "'own' pairs").repartition(5)
    out = al.aligned(docs, A, B)
    assert out.columns == [c for c in docs.columns if c != "text"] + [
        "n_a_", *[c + "_" if c in docs.columns else c for c in al.NEW[1:]]]
    got = sorted((str(r.doc_id), *r[-7:]) for r in out.collect())
    assert got == sorted((str(r[0]), *w) for r, w in zip(rows, brute([r[1] for r in rows])))
    assert al.aligned(make_docs([]), A, B).count() == 0
    assert al.aligned(make_docs([(1, None), (2, "")]), A, B).count() == 2


@pytest.fixture(scope="module")
def aligner():
    with open(B, "rb") as f:
        return al.Aligner(al.read_spec(A), f.read())


def test_parts_of_long_texts(aligner, monkeypatch):
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcde,é'7 \n") for _ in range(rng.randrange(1, 9))) for _ in range(4000))
    whole = next(aligner.rows([text]))
    monkeypatch.setattr(al, "PART_CHARS", 100)
    monkeypatch.setattr(al, "SLICE_CHARS", 700)
    parts = al.parts_of(text)
    assert "".join(parts) == text and len(parts) > 100
    cut = next(aligner.rows([text]))
    assert cut["n"] == whole["n"] and cut["sha"] == whole["sha"]
    assert cut["pairs"].tolist() == whole["pairs"].tolist() and cut["times"].tolist() == whole["times"].tolist()


def test_fast_encoder_equals_the_library(aligner):
    rng = random.Random(1)
    kinds = ["abcXYZ", "0123", " \t\n\r", ".,'!?-", "éñßÄ\xa0", "s t d ll ve re m '", "‘’–"]
    texts = ["".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randrange(1, 200))) for _ in range(500)]
    assert sum(bool(al.PLAIN.fullmatch(t)) for t in texts) == len(texts) and aligner.a.fast
    for text, ids in zip(texts, aligner.a.encode(texts)):
        assert ids.tolist() == aligner.a.library.encode(text, add_special_tokens=False).ids, text


def test_pair_counts_count_documents(spark):
    rows = [(1, [5, 6]), (1, [5]), (2, [5]), (2, None)]
    got = al.pair_counts(spark.createDataFrame(rows, "block long, pairs array<long>")).collect()
    assert sorted(map(tuple, got)) == [(1, 5, 2), (1, 6, 1), (2, 5, 1)]


def test_a_vocabulary_that_cannot_be_cut_is_refused(monkeypatch):
    class Model:
        def __init__(self, model_proto):
            self.pieces = ["▁a", "a▁b"]
        get_piece_size = lambda self: 2
        id_to_piece = lambda self, i: self.pieces[i]
    monkeypatch.setattr(al.sentencepiece, "SentencePieceProcessor", Model)
    with pytest.raises(ValueError):
        al.SentencePieces(b"")
    assert json.loads(al.read_spec(A))["model"]["type"] == "BPE"
