"""Language identification from character n-grams.

Sparse multinomial logistic regression on TF-IDF character n-grams (1 to 3, hashed to
``FEATURES`` numbers), trained with follow-the-regularised-leader and elastic-net
penalties, then calibrated by one temperature on examples kept out of the training.

Document frequencies cover every text that may be learned from. The model is fitted on
a bounded sample: ``PER_LANGUAGE`` rows expected of each language, chosen by a hash.
A text's score is the mean over its n-grams of IDF x weight, so scoring is one gather
per n-gram over the whole text and no shuffle.

Cases: texts that are null or have no letter get ``und`` and score 0; so does every text
if there is nothing to learn from. Rows whose language is null are not learned from. A
null id counts as not held out. Repeated rows get equal predictions. Other columns pass
through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundscope.llm.common import HASH_SEED, fresh
from fundscope.llm.ftrl import Ftrl, best_temperature, probabilities

FEATURES = 1 << 16
PER_LANGUAGE = 1000
CALIBRATE_EVERY = 5                     # every fifth example fits the temperature only
EPOCHS = 3
SCALE = 20.0                            # of term frequencies, for well-sized steps
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))   # odd multipliers
UNKNOWN = "und"


def gram_numbers(text: str) -> np.ndarray:
    """Hashed numbers of all character 1-, 2- and 3-grams of the lower-cased text."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    key, out = c, []
    for size in range(1, 4):
        if size > 1:
            if len(c) < size:
                break
            key = key[:-1] * MIX[1] + c[size - 1:]
        mixed = (key + np.uint64(size)) * MIX[0]
        out.append((mixed >> np.uint64(48)).astype(np.int32))
    return np.concatenate(out)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(ch.isalpha() for ch in text)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(FEATURES, np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if has_letter(text):
                seen = np.zeros(FEATURES, bool)
                seen[gram_numbers(text)] = True
                df += seen
    found = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(df[found])],
                                     ["feature", "n"])


def _example_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, features, counts = [], [], []
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if has_letter(text):
                at, n = np.unique(gram_numbers(text), return_counts=True)
                langs.append(lang)
                features.append(at.astype(np.int32))
                counts.append((n / n.sum()).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(features, pa.list_(pa.int32())),
             pa.array(counts, pa.list_(pa.float32()))], ["lang", "features", "shares"])


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages and weights (features + intercept row, divided by the temperature)."""
    rows = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang")).where(
        "lang is not null")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return [], np.zeros((FEATURES + 1, 0), np.float32)
    frequencies = (rows.select("text").mapInArrow(_document_frequencies, "feature int, n long")
                   .groupBy("feature").agg(F.sum("n").alias("n")).toArrow().to_pandas())  # FEATURES rows at most
    df = np.zeros(FEATURES)
    df[frequencies.feature.to_numpy(int)] = frequencies.n.to_numpy()
    idf = np.log((1 + sum(counts.values())) / (1 + df)) + 1
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, per_language / counts[k])])
    draw = F.pmod(F.xxhash64(F.lit(HASH_SEED), "id", "text"), F.lit(1 << 30))
    # the id only draws the sample; it is no feature
    sample = rows.where(draw < share[F.col("lang")] * (1 << 30)).select("text", "lang")
    table = sample.mapInArrow(
        _example_rows, "lang string, features array<int>, shares array<float>").toArrow().to_pandas()
    table["order"] = [(len(f), float(s.sum()), int(f.sum()) if len(f) else 0)
                      for f, s in zip(table.features, table.shares, strict=True)]
    table = table.sort_values(["lang", "order"], kind="stable")
    examples = [(f, SCALE * s * idf[f].astype(np.float32))
                for f, s in zip(table.features, table.shares, strict=True)]
    classes = table.lang.map({k: i for i, k in enumerate(langs)}).to_numpy(int)
    kept_out = np.arange(len(examples)) % CALIBRATE_EVERY == 0
    model = Ftrl(FEATURES, len(langs))
    targets = np.eye(len(langs), dtype=np.float32)
    model.fit([e for e, k in zip(examples, kept_out, strict=True) if not k],
              targets[classes[~kept_out]], EPOCHS)
    w = model.weights()
    margins = np.array([x @ w[f] + w[-1] for (f, x), k in zip(examples, kept_out, strict=True) if k])
    w = w / best_temperature(margins.reshape(-1, len(langs)), classes[kept_out])
    w[:-1] *= (SCALE * idf)[:, None]
    return langs, w.astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text") -> DataFrame:
    """All columns but the text, plus ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # FEATURES x languages floats
    names = [fresh(docs, n) for n in ("lang_pred", "score")]
    kept = [f for f in docs.schema.fields if f.name != text_col]
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, w = shared.value
        for batch in batches:
            pred, score = [], []
            for text in batch.column(at).to_pylist():
                if not langs or not has_letter(text):
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    continue
                p = _probabilities(gram_numbers(text), w)
                best = int(p.argmax())
                pred.append(langs[best])
                score.append(float(p[best]))
            columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                [*[f.name for f in kept], *names])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return docs.mapInArrow(run, f"{schema}{names[0]} string, {names[1]} double")


def _probabilities(grams: np.ndarray, w: np.ndarray) -> np.ndarray:
    if w.shape[1] == 1:
        return np.ones(1)
    return probabilities(w[grams].mean(0, dtype=np.float64) + w[-1])


def held_out(id_col: Column, modulus: int, remainder: int) -> Column:
    """Whether the CRC-32 of the id as text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % modulus == remainder,
                      F.lit(False))
