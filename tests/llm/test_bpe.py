import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fundscope.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = ["a<|endoftext|>b <|startoftext|>", "<|endoftext|", "İstanbul ΣΑΣ σς Σ", "日本語 한국어 😀😀👩‍👩‍👧",
        "don't we'll I'm 'S 'RE x's", "é café \x1c\x1d\x85\xa0　x", "½ ² ٣ १२ 123abc ǅ ß ŉ",
        "A" * 5000, "'" * 30, "ab" * 400 + "!" * 700, "\x00\x01\x7f�", "ﬁ Ⅷ ª º µ", "é ñ"]


@pytest.fixture(scope="module")
def both():
    return bpe.ForcedBoundaryBPE(bpe.read_spec(PATH)), Tokenizer.from_file(PATH)


def test_same_as_the_library(spark, sf, both):
    own, library = both
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + HARD
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        got = own.encode(text)
        assert got.tolist() == want.ids, text[:60]
        assert own.decode(got) == library.decode(want.ids, skip_special_tokens=False)


def test_random_strings(both):
    own, library = both
    rng = random.Random(2)
    alphabet = "abcdeéßñ'’.,!#$ \n\t12日я😀" + "́İ"
    for _ in range(500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_cuts_hold_and_caches_change_nothing(both, monkeypatch):
    own, _ = both
    word = "".join(own.alphabet[b] for b in "qxzjжabc".encode())
    pieces = own.fragments(word)
    assert len(pieces) > 1 and "".join(pieces) == word
    assert all(a[-1] + b[0] not in own.inside for a, b in zip(pieces, pieces[1:]))
    text = " ".join(f"word{i} other" for i in range(300))
    want = own.encode(text).tolist()
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    own.cache.clear()
    assert own.encode(text).tolist() == want


def test_long_fragments_merge_in_the_same_order(both, monkeypatch):
    own, _ = both
    rng = random.Random(4)
    for _ in range(50):
        word = "".join(rng.choice("aeinrst") for _ in range(60))
        short = own.merged(word, True)
        monkeypatch.setattr(bpe, "LONG_FRAGMENT", 1)
        assert own.merged(word, True) == short
        monkeypatch.undo()


def test_odd_rows(make_docs, odd_rows, clashing, both):
    docs = clashing(make_docs(odd_rows))
    rows = bpe.encode_decode(docs, PATH).collect()
    assert len(rows) == len(odd_rows) and {r.ids for r in rows} == {"own ids"}
    for r in rows:
        ids = both[1].encode(r.text or "", add_special_tokens=False).ids
        assert r.ids_ == ids and r.decoded_ == both[1].decode(ids, skip_special_tokens=False)
    assert bpe.encode_decode(make_docs([]), PATH).count() == 0
