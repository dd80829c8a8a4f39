"""Quality classifier: hashed word n-gram logistic regression.

Words and single punctuation marks are hashed alone and in pairs to ``FEATURES``
numbers. So that words never seen in training count too, two abstractions of the n-grams
are hashed with them: pairs of word shapes (case, digits, sign) and, for windows of four
words, which of them equal the last one. Weights are fitted with follow-the-regularised-leader updates on a bounded
sample: ``SAMPLE`` labelled rows expected, chosen by a hash, and joined to their texts
by broadcast (the sample's size is the bound). A text's score is a sparse dot product of
its n-gram shares with the weights, taken as a mean over its n-grams.

Cases: null and empty texts have no n-grams and get the score of the intercept. Labels
that are null or of unknown documents are not used; of several labels of an id one is
used. Without any label all scores are 0.5. Repeated rows get equal scores. Other
columns pass through untouched.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.llm.common import HASH_SEED, fresh
from fundscope.llm.ftrl import Ftrl, probabilities

FEATURES = 1 << 18
SAMPLE = 8000
EPOCHS = 3
SCALE = 20.0
CACHE_ENTRIES = 200_000
PAIR = np.uint64(0x9E3779B97F4A7C15)                       # odd multiplier
TOKENS = re.compile(r"\w+|[^\w\s]")

_HASHES: dict[str, int] = {}                               # of this Python worker; see _hash


def shape(token: str) -> int:
    """0 lower, 1 title, 2 upper, 3 mixed case, 4 with digits; signs by their code point."""
    if not token[0].isalnum():
        return 8 + ord(token[0]) % 248
    if not token.isalpha():
        return 4
    return 0 if token.islower() else 1 if token.istitle() else 2 if token.isupper() else 3


def _hash(token: str) -> int:
    """CRC-32 and shape of a token, remembered for the tokens met last (time only)."""
    if len(_HASHES) >= CACHE_ENTRIES:
        _HASHES.clear()
    code = zlib.crc32(token.encode("utf-8", "surrogatepass")) << 8 | shape(token)
    return _HASHES.setdefault(token, code)


def gram_numbers(text: str | None) -> np.ndarray:
    """Numbers of all words, word pairs and their abstractions in a whole text."""
    tokens = TOKENS.findall(text or "")
    get = _HASHES.get
    one = np.fromiter((get(t) or _hash(t) for t in tokens), np.uint64, len(tokens))
    two = (one[:-1] * PAIR + one[1:] + np.uint64(1)) * PAIR
    kind = one & np.uint64(255)
    shapes = (kind[:-1] << np.uint64(8) | kind[1:]) + np.uint64(1 << 60)
    same = np.zeros(len(one), np.uint64)
    for lag in (1, 2, 3):
        same[lag:] |= (one[lag:] == one[:-lag]).astype(np.uint64) << np.uint64(lag)
    same = (same << np.uint64(8) | kind) + np.uint64(1 << 61)
    return (np.concatenate([one * PAIR, two, shapes * PAIR, same * PAIR])
            >> np.uint64(46)).astype(np.int32)


def _example_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        features, shares = [], []
        for text in batch.column("text").to_pylist():
            at, n = np.unique(gram_numbers(text), return_counts=True)
            features.append(at.astype(np.int32))
            shares.append((n / max(1, n.sum())).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"),
             pa.array(features, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))],
            ["doc_id", "label", "features", "shares"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE) -> np.ndarray:
    """Weights: one per feature, the last the intercept."""
    known = labels.select(F.col(id_col).alias("doc_id"),
                          F.col(label_col).cast("int").alias("label")).where(
        "label in (0, 1) and doc_id is not null")
    total = known.count()
    draw = F.pmod(F.xxhash64(F.lit(HASH_SEED), "doc_id"), F.lit(1 << 30))
    drawn = known.where(draw < sample / max(1, total) * (1 << 30))
    id_type = known.schema["doc_id"].dataType.simpleString()
    # expected size: ``sample`` rows of an id and a label
    table = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
             .join(F.broadcast(drawn.dropDuplicates(["doc_id"])), "doc_id")
             .select("doc_id", "label", "text")
             .mapInArrow(_example_rows, f"doc_id {id_type}, label int, features array<int>, "
                                        "shares array<float>")
             .dropDuplicates(["doc_id"]).toArrow().to_pandas().sort_values("doc_id"))
    model = Ftrl(FEATURES)
    examples = [(f, SCALE * s) for f, s in zip(table.features, table.shares, strict=True)]
    model.fit(examples, table.label.to_numpy(np.float32)[:, None], EPOCHS)
    w = model.weights()[:, 0]
    w[:-1] *= SCALE
    return w


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """All columns but the text, plus ``score`` (0 to 1); a taken name gets an underscore."""
    name = fresh(docs, "score")
    shared = docs.sparkSession.sparkContext.broadcast(weights)    # FEATURES floats
    kept = [f for f in docs.schema.fields if f.name != text_col]
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            margins = []
            for text in batch.column(at).to_pylist():
                grams = gram_numbers(text)
                margins.append((w[grams].mean(dtype=np.float64) if len(grams) else 0.0) + w[-1])
            scores = probabilities(np.array(margins, np.float64)[:, None])[:, 0]
            columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())],
                                             [*[f.name for f in kept], name])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return docs.mapInArrow(run, f"{schema}{name} double")
