import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as cp
from fundscope.llm import line_dedup, minhash, mixing, quality_rules
from fundscope.llm.common import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, make_docs):
    rng = random.Random(0)
    rows = []
    for i in range(60):
        body = "\n".join(" ".join(rng.choice(["lorem", "ipsum", "dolor", "amet", "elit", f"w{rng.randrange(500)}"])
                                  for _ in range(12)) for _ in range(8))
        rows.append((i, "Shared line\n" + body))
    rows += [(100, rows[3][1] + " tail"), (101, rows[3][1]), (102, "too short"), (103, None)]
    docs = make_docs(rows)
    stages = dict(cp.STAGES)
    assert list(stages) == ["quality rules", "line dedup", "near duplicates", "mixing", "encoding"]

    good = stored(stages["quality rules"](spark, docs, ""), "t")
    assert good.columns == COLUMNS
    kept = {r.doc_id for r in quality_rules.judged(docs).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept and not {102, 103} & kept

    cleaned = stored(stages["line dedup"](spark, good, ""), "t")
    assert cleaned.columns == COLUMNS
    for r in cleaned.collect():
        assert "Shared line" not in r.text and r.n_chars == len(r.text)

    single = stored(stages["near duplicates"](spark, cleaned, ""), "t")
    classes = minhash.near_duplicates(cleaned).collect()
    assert sorted(r.doc_id for r in single.collect()) == sorted({r.class_id for r in classes})
    assert not {100, 101} & {r.doc_id for r in single.collect()}

    mixed = stored(stages["mixing"](spark, single, ""), "t")
    drawn = {r.doc_id for r in mixing.mixture(single).where("sampled").collect()}
    assert {r.doc_id for r in mixed.collect()} == drawn and mixed.columns == COLUMNS

    library = Tokenizer.from_file(public_tokenizers.path(cp.VOCABULARY))
    texts = {r.doc_id: r.text for r in mixed.collect()}
    for r in stages["encoding"](spark, mixed, "").collect():
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids)


def test_odd_rows_and_empty_table(spark, make_docs, odd_rows, clashing):
    for docs in (clashing(make_docs(odd_rows)), make_docs([])):
        for name, stage in cp.STAGES:
            out = stored(stage(spark, docs, ""), "t")
            assert name == "encoding" or out.columns == docs.columns
            docs = out if name != "encoding" else docs


def test_run_on_a_given_table(spark, sf):
    out = cp.run(spark, sf)
    assert out.count() > 0 and "ids_sha256" in out.columns
    assert line_dedup.MIN_DOCS == 10
