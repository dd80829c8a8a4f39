import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows."""
    def make(rows):
        full = [(*r, *("en", "s0")[len(r) - 2:]) if len(r) < 4 else r for r in rows]
        return spark.createDataFrame(
            [(*r, None if r[1] is None else len(r[1])) for r in full], SCHEMA)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows, ties, a long text, other scripts."""
    rng = random.Random(5)
    long = words(rng, 60_000, 5000)
    body = words(rng, 120)
    return [(None, None, None, None), (1, None, "en", "a"), (2, "", "en", "a"),
            (3, "  \t\n \n", None, "a"), (4, body, "en", None), (4, body, "en", None),
            (5, body, "de", "b"), (None, body, "de", "b"), (6, long, "en", "b"),
            (7, "a", "en", "b"), (8, "日本語 текст ñ 😀\r\n\x0b x", "fr", "c"),
            (None, "nothing has an id", "en", "c"), (9, "1 2 3 ### $$$", "en", "c")]


@pytest.fixture(scope="session")
def clashing(spark):
    """Adds columns whose names the operators use inside."""
    def add(df):
        from pyspark.sql import functions as F
        extra = ("k1", "k2", "id", "node", "bands", "ids", "decoded", "n_lines", "n_dropped",
                 "keep_runs", "score", "lang_pred", "n_tokens", "topic", "prob", "key", "starts",
                 "quality_k1", "near_id", "mix_k1", "line_k1", "join_salt", "n")
        return df.select("*", *[F.lit(f"own {c}").alias(c) for c in extra])
    return add
