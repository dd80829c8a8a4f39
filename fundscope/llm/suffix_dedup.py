"""Suffix-array dedup: remove every byte under a long string that also starts elsewhere.

Texts are UTF-8 bytes; matches never cross documents. Each ``LENGTH``-byte window is dealt
to a shard by the least hash among its short substrings (its anchor), which follows from
the window's bytes alone, so equal windows always meet. Anchors are counted over all
documents first: a window whose anchor occurs once is unique and goes no further. Windows
of one anchor in a row form a piece, known by a 128-bit hash; equal pieces are summed first, so
a group of copies costs one row a piece and no text. Only where an anchor has several
different contents, one of them occurring once, are the contents fetched (one place of
each) and, if they share the bytes on a side of the anchor with another one, sent to suffix-array shards of about ``SHARD_BYTES``: each shard's array is built by induced sorting
(suffixes classified, leftmost-smaller substrings sorted recursively, the rest induced
linearly) and read through permuted common prefixes.

An anchor with more than ``HOT_PIECES`` different contents would overfill a shard. Its
windows are compared by 128-bit hashes in a distributed aggregate instead: the same
result, whatever the size of the group.

Cases: null is the empty text. Texts shorter than ``LENGTH`` lose nothing. Rows that agree
in id and text are two places, so they match each other. Ids may be null. Very long texts
are read whole, in chunks of windows. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.llm.common import key_pair, salted_join, stored
from fundscope.llm.minhash import GOLD, U, mix
from fundscope.llm.suffix_array import repeated_starts

LENGTH = 400
GRAM = 96                       # bytes of an anchor
CHUNK = 4 << 20                 # windows handled at once; positions in a chunk fit 24 bits
SHARD_BYTES = 256 << 10        # an array this small stays in a processor's cache
HOT_PIECES = 1500
SECOND = U(0xD6E8FEB86659FD93)  # an odd multiplier
BYTE_CODE = mix((np.arange(256, dtype=np.uint64) + U(1)) * GOLD)


def rolling(data: np.ndarray, length: int, base: np.uint64 = GOLD) -> np.ndarray:
    """Polynomial hash of every substring of ``length`` bytes, by joining halves."""
    power, have, out, done, tail = base, BYTE_CODE[data], None, 0, length
    size = 1
    while tail:
        if tail & 1:
            if out is None:
                out = have
            else:                                          # out covers `done` bytes: put `have` before
                out = have[: len(have) - done] * _power(base, done) + out[size:][: len(have) - done]
            done += size
        tail >>= 1
        if tail:
            have = have[: len(have) - size] * power + have[size:]
            power = _power(power, 2)
            size *= 2
    return out[: max(0, len(data) - length + 1)]


def _power(base: np.uint64, exponent: int) -> np.uint64:
    return U(pow(int(base), exponent, 1 << 64))


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that share an anchor: first window start, anchor position, its hash."""
    starts, places, hashes = [], [], []
    count = len(data) - length + 1
    grams = min(GRAM, length)
    for low in range(0, max(count, 0), CHUNK):
        part = data[low: low + CHUNK + length - 1]
        h = mix(rolling(part, grams))
        # leftmost least: hash above, place below; ties in the hash bits go to the left one
        low_bits = U((1 << 24) - 1)
        packed = (h & ~low_bits) | np.arange(len(h), dtype=np.uint64)
        width, have = length - grams + 1, 1
        while have < width:                                # least over a doubling stretch
            step = min(have, width - have)
            packed = np.minimum(packed[: len(packed) - step], packed[step:])
            have += step
        place = (packed & low_bits).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        starts.append(first + low)
        places.append(place[first] + low)
        hashes.append(h[place[first]])
    if not starts:
        empty = np.empty(0, np.int64)
        return empty, empty, np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(places), np.concatenate(hashes)


PIECE = [("anchor", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("start", pa.int64()),
         ("end", pa.int64()), ("at", pa.int64())]          # at: of the anchor, from the start


def _describer(length: int):
    """Size, digest and pieces of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, counts, columns = [], [], [0], [[] for _ in PIECE]
            for text in batch.column("text").to_pylist():
                raw = text.encode()
                sizes.append(len(raw))
                digests.append(hashlib.sha256(raw).hexdigest())
                first, place, h = anchors(np.frombuffer(raw, np.uint8), length)
                ends = np.append(first[1:] - 1, len(raw) - length)[: len(first)] + length
                view = memoryview(raw)
                digest = b"".join([xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(
                    first.tolist(), ends.tolist(), strict=True)])
                c1, c2 = np.frombuffer(digest, np.int64).reshape(-1, 2).T
                for column, values in zip(columns, (h.view(np.int64), c1, c2, first, ends, place - first),
                                          strict=True):
                    column.append(np.array(values, np.int64))
                counts.append(counts[-1] + len(first))
            pieces = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(c)) if c else pa.array([], pa.int64()) for c in columns],
                [n for n, _ in PIECE])
            keys = [batch.column(c) for c in ("doc_id", "k1", "k2")]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                 pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pieces)],
                ["doc_id", "k1", "k2", "n_bytes", "sha256", "pieces"])
    return run


def _fetch(length: int):
    """Contents of wanted pieces of each text, with hashes of the sides of their anchors.

    A window holds its anchor, so two equal windows agree on at least ``half`` bytes to the
    anchor's left or on as many to its right.
    """
    gram = min(GRAM, length)
    half = (length - gram + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                raw = batch.column("text")[row].as_py().encode()
                wanted = batch.column("wanted")[row].as_py()
                contents = [raw[w["start"]: w["end"]] for w in wanted]
                left = [xxhash.xxh3_64_intdigest(c[w["at"] - half: w["at"]]) - (1 << 63)
                        if w["at"] >= half else None
                        for w, c in zip(wanted, contents, strict=True)]
                right = [xxhash.xxh3_64_intdigest(c[w["at"] + gram: w["at"] + gram + half]) - (1 << 63)
                         if len(c) >= w["at"] + gram + half else None
                         for w, c in zip(wanted, contents, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w[c] for w in wanted], pa.int64()) for c in ("anchor", "c1", "c2", "n")]
                    + [pa.array(left, pa.int64()), pa.array(right, pa.int64()),
                       pa.array(contents, pa.binary())],
                    ["anchor", "c1", "c2", "n", "left", "right", "content"])
    return run


def _shard_runs(length: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = repeated_starts(list(pdf.content), length)
        pdf = pdf[["c1", "c2"]].copy()
        pdf["starts"], pdf["ends"] = zip(*(merged(f, f + length) for f in found), strict=True)
        return pdf[pdf.starts.map(len) > 0]
    return run


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as maximal runs (touching ones join)."""
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > reach[:-1])
    return starts[new].astype(np.int64), reach[np.append(new[1:], True)].astype(np.int64)


def _window_hashes(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(batch.column("content")[i].as_buffer(), np.uint8)
                w1, w2 = (mix(rolling(data, length, b)).view(np.int64) for b in (GOLD, SECOND))
                keys = [pa.array(np.full(len(w1), batch.column(c)[i].as_py()), pa.int64())
                        for c in ("c1", "c2")]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array(np.arange(len(w1)), pa.int64()), pa.array(w1), pa.array(w2)],
                    ["c1", "c2", "at", "w1", "w2"])
    return run


def _array_runs(cool: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """Repeated runs of contents by suffix-array shards; anchors are dealt to shards by hash."""
    total = cool.agg(F.sum(F.length("content"))).first()[0] or 0
    shards = int(total // shard_bytes) + 1
    return (cool.select(F.pmod(F.hash("anchor"), F.lit(shards)).alias("shard"), "anchor", "c1",
                        "c2", "content")
            .repartition(shards, "shard").groupBy("shard").applyInPandas(
                _shard_runs(length),
                "c1 long, c2 long, starts array<long>, ends array<long>"))


def _hash_runs(hot: DataFrame, length: int) -> DataFrame:
    """Repeated runs of contents of hot anchors by hashes of all their windows."""
    windows = stored(hot.select("c1", "c2", "content").mapInArrow(
        _window_hashes(length), "c1 long, c2 long, at long, w1 long, w2 long"), "windows")
    again = (windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("w1", "w2"))
    at = (salted_join(windows, again, ["w1", "w2"], F.col("c1"))
          .groupBy("c1", "c2").agg(F.sort_array(F.collect_list("at")).alias("starts")))
    return at.withColumn("ends", F.transform("starts", lambda x: x + length))


def repeated_runs(texts: DataFrame, pieces: DataFrame, length: int = LENGTH,
                  shard_bytes: int = SHARD_BYTES, hot_pieces: int = HOT_PIECES) -> DataFrame:
    """``c1, c2, starts, ends``: repeated bytes of each piece content.

    ``texts`` has ``k1, k2, text``; ``pieces`` one row per piece of each.
    """
    contents = stored(pieces.groupBy("c1", "c2").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.first(c).alias(c) for c in ("anchor", "k1", "k2", "start", "end", "at")]), "contents")
    # a content that occurs twice is repeated from end to end
    whole = contents.where("n > 1").select(
        "c1", "c2", F.array(F.lit(0).cast("long")).alias("starts"),
        F.array(F.col("end") - F.col("start")).alias("ends"))
    several = (contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"),
                                              F.min("n").alias("least"))
               .where("kinds > 1 and least = 1").select("anchor"))
    wanted = (salted_join(contents, several, ["anchor"], F.col("c1"))
              .groupBy("k1", "k2").agg(F.collect_list(F.struct(
                  "anchor", "c1", "c2", "start", "end", "at", "n")).alias("wanted")))
    found = stored(texts.join(wanted.hint("shuffle_hash"), ["k1", "k2"])
                   .select("text", "wanted").mapInArrow(
                       _fetch(length), "anchor long, c1 long, c2 long, n long, left long, "
                                       "right long, content binary"), "fetched")
    # a content that shares neither side of its anchor with another one has no equal window
    sides = [found.where(F.col(c).isNotNull()).groupBy("anchor", c)
             .agg(F.count_distinct("c1", "c2").alias("m")).where("m > 1")
             .select("anchor", c, F.lit(True).alias(f"{c}_met")) for c in ("left", "right")]
    mixed = found.dropDuplicates(["c1", "c2"])
    for c, side in zip(("left", "right"), sides, strict=True):
        mixed = salted_join(mixed, side, ["anchor", c], F.col("c1"), "left")
    mixed = mixed.where("left_met or right_met").select("anchor", "c1", "c2", "n", "content")
    mixed = stored(mixed, "met")
    kinds = mixed.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
    mixed = salted_join(mixed, kinds, ["anchor"], F.col("c1"))
    runs = _array_runs(mixed.where(F.col("kinds") <= hot_pieces), length, shard_bytes)
    hot = mixed.where(F.col("kinds") > hot_pieces)
    if hot.limit(1).count():
        runs = runs.unionByName(_hash_runs(hot, length))
    once = mixed.where("n = 1").select("c1", "c2")
    return whole.unionByName(runs.join(once, ["c1", "c2"], "left_semi"))


def _remover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, spans, digests, begins, finishes = [], [], [], [], []
        for text, starts, ends in zip(*(batch.column(c).to_pylist() for c in (
                "text", "starts", "ends")), strict=True):
            a, b = merged(np.array(starts, np.int64), np.array(ends, np.int64))
            raw = text.encode()
            kept = b"".join(raw[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(raw)],
                                                     strict=True))
            removed.append(len(raw) - len(kept))
            spans.append(len(a))
            digests.append(hashlib.sha256(kept).hexdigest())
            begins.append(a)
            finishes.append(b)
        yield pa.RecordBatch.from_arrays(
            [batch.column("k1"), batch.column("k2"), pa.array(removed, pa.int64()),
             pa.array(spans, pa.int64()), pa.array(digests), pa.array(begins, pa.list_(pa.int64())),
             pa.array(finishes, pa.list_(pa.int64()))],
            ["k1", "k2", "n_removed", "n_spans", "kept", "span_starts", "span_ends"])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 length: int = LENGTH, shard_bytes: int = SHARD_BYTES,
                 hot_pieces: int = HOT_PIECES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, span_starts, span_ends, kept_sha256`` of every row.

    Spans are byte offsets of the maximal removed runs.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), *key_pair(F.col(id_col), text),
                       text.alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    piece = ", ".join(f"{n}: long" for n, _ in PIECE)
    described = stored(rows.mapInArrow(
        _describer(length), f"doc_id {id_type}, k1 long, k2 long, n_bytes long, sha256 string, "
                            f"pieces array<struct<{piece}>>"), "pieces")
    texts = rows.select("k1", "k2", "text")
    pieces = described.select("k1", "k2", F.inline("pieces"))
    runs = repeated_runs(texts, pieces, length, shard_bytes, hot_pieces)
    spans = (salted_join(pieces.select("k1", "k2", "start", "c1", "c2"), runs, ["c1", "c2"],
                         F.col("k1"))
             .groupBy("k1", "k2").agg(
                 F.flatten(F.collect_list(F.transform(
                     "starts", lambda x: x + F.col("start")))).alias("starts"),
                 F.flatten(F.collect_list(F.transform(
                     "ends", lambda x: x + F.col("start")))).alias("ends")))
    cut = (texts.join(spans.hint("shuffle_hash"), ["k1", "k2"])
           .mapInArrow(_remover, "k1 long, k2 long, n_removed long, n_spans long, kept string, "
                                 "span_starts array<long>, span_ends array<long>")
           .dropDuplicates(["k1", "k2"]))
    none = F.array().cast("array<long>")
    zero = F.lit(0).cast("long")
    return (described.drop("pieces").join(cut, ["k1", "k2"], "left")
            .select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
                    F.coalesce("n_spans", zero).alias("n_spans"),
                    F.coalesce("span_starts", none).alias("span_starts"),
                    F.coalesce("span_ends", none).alias("span_ends"),
                    F.coalesce("kept", "sha256").alias("kept_sha256")))
