"""Alignment of two tokenizers' tokens over the same texts.

Each text is encoded by a byte-level BPE (A, space + text) and a sentence-piece model (B,
which adds the space). In a task everything is Arrow: lists of ids are flattened with their
parent indices, token byte lengths become segmented cumulative sums (byte ends within the
document), and an Acero full outer join on document-end keys brings the ends of both sides
together. Sorted by key, an end that only one side has takes the other side's next token:
every row of the join is one pair of tokens whose byte ranges overlap (a link), and the
ends that both sides have cut the document into groups.

How many documents hold a pair: texts lie in blocks of about ``BLOCK_BYTES``; a block's
``Table.group_by`` counts are merged by Spark, and sums of pairs that several blocks hold go
back to those blocks through a salted join. Nothing per document is broadcast; the highest
count of each A id is (at most one row per id of A's vocabulary).

Cases: a null or empty text, or one whose joined A or B bytes differ from space + text, has
no tokens: zeros and an empty digest. Rows count as documents, repeated rows and repeated
or null ids too. Strings of special tokens are plain text. Long texts are encoded and
aligned in parts of about ``PART_CHARS``, cut where a letter is followed by a space and a
letter: neither side has a token across such a place (``SentencePieces`` refuses a
vocabulary with one). An empty table gives an empty result. Columns other than the text
are kept; a new column whose name is taken gets a trailing underscore.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fundscope.llm.bpe import byte_alphabet, read_spec
from fundscope.llm.common import fresh, salted_join, stored

BLOCK_BYTES = 4 << 20
SLICE_CHARS = 1 << 19                       # text aligned at once
PART_CHARS = 1 << 17
B_BITS = 20                                 # a pair is one long: A id << B_BITS | B id
SALTS = 4
LONG_PIECE = 400
CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
# Characters whose classes (letter, number, blank, other) every Unicode version agrees on.
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa0-ɏ‐-‟]*")
# The word pattern of byte-level BPE files.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def has_long_piece(text: str) -> bool:
    return " " * LONG_PIECE in text or max(map(len, text.split(" "))) >= LONG_PIECE


class ByteLevelBPE:
    """Ids of texts by a byte-level BPE file, and the bytes of each id.

    The file's own library is the reference. Its vocabulary is also given to an encoder
    that is three times as fast, used for texts of PLAIN characters without very long
    pieces; both follow the same merges (ids are in merge order, checked here).
    """

    def __init__(self, spec: str):
        self.library = Tokenizer.from_str(spec)
        self.library.encode_special_tokens = True
        spec = json.loads(spec)
        vocab = spec["model"]["vocab"]
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        special = {t["id"] for t in spec["added_tokens"]}
        entries = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items() if i not in special}
        size = max([*vocab.values(), *special]) + 1
        self.bytes_of = pa.array([entries.get(i, b"") for i in range(size)], pa.binary())
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        order = [vocab[a + b] for a, b in merges]
        self.fast = None
        if order == sorted(order) and len(entries) == len(set(entries.values())) == 256 + len(order):
            self.fast = tiktoken.Encoding(
                "byte-level", pat_str=WORDS, special_tokens={},
                mergeable_ranks={v: k for k, v in entries.items()})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            if self.fast and PLAIN.fullmatch(text) and not has_long_piece(text):
                out.append(np.array(self.fast.encode_ordinary(text), np.int64))
            else:
                out.append(np.array(self.library.encode(text, add_special_tokens=False).ids, np.int64))
        return out


class SentencePieces:
    """Ids of texts by a sentence-piece model, and the bytes of each id."""

    def __init__(self, proto: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece goes on after a space: texts cannot be cut")
        self.bytes_of = pa.array(
            [bytes([int(p[3:5], 16)]) if self.model.is_byte(i)
             else p.replace("▁", " ").encode() for i, p in enumerate(pieces)], pa.binary())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.model.encode(texts, num_threads=1)]


def parts_of(text: str) -> list[str]:
    """A text cut into parts; each but the first starts with the space of its cut."""
    parts, start = [], 0
    while len(text) - start > PART_CHARS:
        cut = CUT.search(text, start + PART_CHARS)
        if cut is None:
            break
        parts.append(text[start: cut.start()])
        start = cut.start()
    return [*parts, text[start:]]


def _ends(ids: pa.Array, parent: pa.Array, lengths: pa.Array) -> pa.Array:
    """Document-end keys: parent << 40 | byte end within the parent (segmented sums)."""
    size = pc.take(lengths, ids)
    total = pc.cumulative_sum(size)
    doc = parent.to_numpy()
    first = np.flatnonzero(np.diff(doc, prepend=-1))        # first token of each document
    before = np.zeros(int(doc[-1]) + 1 if len(doc) else 0, np.int64)
    before[doc[first]] = total.to_numpy()[first] - size.to_numpy()[first]
    return pc.add(pc.subtract(total, pc.take(pa.array(before), parent)),
                  pc.shift_left(parent, pa.scalar(40, pa.int64())))


def _joined(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Ids in decimal, those of one group joined by commas."""
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, pa.array(ids).cast(pa.string())), ",")


def align(a: pa.ListArray, b: pa.ListArray, a_bytes: pa.Array, b_bytes: pa.Array):
    """Links and groups of documents whose ids spell the same bytes on both sides.

    Gives (parent, pair) of every link, in order, and (parent, text) of every group.
    """
    ids = {"a": a.flatten(), "b": b.flatten()}
    parent = {"a": pc.list_parent_indices(a).cast(pa.int64()),
              "b": pc.list_parent_indices(b).cast(pa.int64())}
    sides = {}
    for s, entries in (("a", a_bytes), ("b", b_bytes)):
        key = _ends(ids[s], parent[s], pc.binary_length(entries).cast(pa.int64()))
        sides[s] = pa.table({"key": key, s: ids[s], f"{s}_at": pa.array(np.arange(len(key)))})
    both = sides["a"].join(sides["b"], "key", join_type="full outer", use_threads=False)
    both = both.sort_by("key")
    shared = pc.and_(pc.is_valid(both["a"]), pc.is_valid(both["b"])).combine_chunks()
    of = pc.shift_right(both["key"], pa.scalar(40, pa.int64())).to_numpy()
    pair = pc.bit_wise_or(
        pc.shift_left(pc.fill_null_backward(both["a"]), pa.scalar(B_BITS, pa.int64())),
        pc.fill_null_backward(both["b"])).to_numpy()
    cut = both.filter(shared)
    text = pc.binary_join_element_wise(
        _joined(ids["a"].to_numpy(), cut["a_at"].to_numpy() + 1),
        _joined(ids["b"].to_numpy(), cut["b_at"].to_numpy() + 1), "|")
    return (of, pair), (of[shared.to_numpy(zero_copy_only=False)], text)


def _lists(arrays: list[np.ndarray], entries: pa.Array | None = None) -> pa.ListArray:
    """One list for each array; of the numbers, or of the entries that they number."""
    ends = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    flat = pa.array(np.concatenate([np.zeros(0, np.int64), *arrays]))
    return pa.ListArray.from_arrays(pa.array(ends), entries.take(flat) if entries else flat)


def _spelled(ids: list[np.ndarray], entries: pa.Array, texts: list[bytes]) -> list[bool]:
    """Whether the ids of each text spell exactly its bytes."""
    taken = pc.binary_join(_lists(ids, entries), b"")
    return np.asarray(pc.equal(taken, pa.array(texts, pa.binary()))).tolist()


class Aligner:
    """Both encoders, and what one document gives."""

    def __init__(self, a_spec: str, b_proto: bytes):
        self.a, self.b = ByteLevelBPE(a_spec), SentencePieces(b_proto)

    def rows(self, texts: list[str | None]) -> Iterator[dict]:
        """For each text ``n_a, n_b, n_groups``, the digest, its links' distinct pairs and times."""
        run: list[tuple[int, str]] = []                    # parts of some texts, in order
        held, first = 0, 0
        state: dict[int, dict] = {}
        for i, text in enumerate(texts):
            for k, part in enumerate(parts_of(text) if text else []):
                run.append((i, part if k else " " + part))
                held += len(part)
                if held >= SLICE_CHARS:
                    self._run(run, state)
                    run, held = [], 0
            if held >= SLICE_CHARS // 2 or i == len(texts) - 1:
                self._run(run, state)
                run, held = [], 0
                for j in range(first, i + 1):
                    yield self._closed(state.pop(j, None))
                first = i + 1

    def _run(self, run: list[tuple[int, str]], state: dict[int, dict]) -> None:
        if not run:
            return
        a = self.a.encode([t for _, t in run])
        b = self.b.encode([t[1:] for _, t in run])
        data = [text.encode() for _, text in run]
        spelled = zip(_spelled(a, self.a.bytes_of, data), _spelled(b, self.b.bytes_of, data), strict=True)
        good = []
        for at, same in enumerate(spelled):
            own = state.setdefault(
                run[at][0], {"good": True, "n": [0, 0, 0], "links": [], "sha": None})
            own["good"] = own["good"] and all(same)
            if own["good"]:
                good.append(at)
        if not good:
            return
        (of, pair), (group_of, text) = align(_lists([a[x] for x in good]), _lists([b[x] for x in good]),
                                             self.a.bytes_of, self.b.bytes_of)
        link_cut = np.searchsorted(of, np.arange(len(good) + 1))
        group_cut = np.searchsorted(group_of, np.arange(len(good) + 1))
        joined = pc.binary_join(pa.ListArray.from_arrays(
            pa.array(group_cut.astype(np.int32)), text.combine_chunks()
            if isinstance(text, pa.ChunkedArray) else text), ";")
        for at, x in enumerate(good):
            own = state[run[x][0]]
            own["n"][0] += len(a[x])
            own["n"][1] += len(b[x])
            own["n"][2] += int(group_cut[at + 1] - group_cut[at])
            own["links"].append(np.unique(pair[link_cut[at]: link_cut[at + 1]], return_counts=True))
            if own["sha"] is None:
                own["sha"] = hashlib.sha256()
            else:
                own["sha"].update(b";")
            own["sha"].update(joined[at].as_py().encode())

    @staticmethod
    def _closed(own: dict | None) -> dict:
        if own is None or not own["good"]:
            return {"n": (0, 0, 0), "sha": "", "pairs": np.zeros(0, np.int64), "times": np.zeros(0, np.int64)}
        if len(own["links"]) == 1:
            pairs, times = own["links"][0]
        else:
            pairs, at = np.unique(np.concatenate([p for p, _ in own["links"]]), return_inverse=True)
            times = np.bincount(at, np.concatenate([t for _, t in own["links"]])).astype(np.int64)
        return {"n": tuple(own["n"]), "sha": own["sha"].hexdigest(), "pairs": pairs, "times": times}


_ALIGNERS: dict[int, Aligner] = {}                         # of this Python worker


def _aligner(shared) -> Aligner:
    key = hash(shared.value)
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(*shared.value)
    return _ALIGNERS[key]


def _encode(shared, text_col: str):
    """Adds each text's own figures, its pairs and its block; takes the text away."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shared)
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            texts = batch.column(text_col)
            at = batch.schema.get_field_index(text_col)
            rest = batch.remove_column(at)
            size = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
            start = 0
            while start < len(texts):
                end = start + max(1, int(np.searchsorted(np.cumsum(size[start:]), BLOCK_BYTES)))
                if held and held + int(size[start:end].sum()) > BLOCK_BYTES:
                    block, held = block + 1, 0
                rows = list(aligner.rows(texts.slice(start, end - start).to_pylist()))
                held += int(size[start:end].sum()) + 8 * (end - start)
                own = rest.slice(start, end - start)
                n = [pa.array([r["n"][k] for r in rows], pa.int64()) for k in range(3)]
                lists = [_lists([r[c] for r in rows]) for c in ("pairs", "times")]
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, *n, pa.array([r["sha"] for r in rows], pa.string()),
                     lists[0], lists[1].cast(pa.list_(pa.int32())),
                     pa.array(np.full(len(rows), block, np.int64))],
                    [*own.schema.names, *NEW[:3], "groups_sha256", *INNER])
                start = end
    return run


NEW = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
INNER = ("link_pairs", "link_times", "link_block")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, pair, n``: documents of the block that hold the pair (a batch may split a block)."""
    for batch in batches:
        lists = batch.column("pairs")
        flat = pa.table({"block": pc.take(batch.column("block"), pc.list_parent_indices(lists)),
                         "pair": lists.flatten()})
        found = flat.group_by(["block", "pair"], use_threads=False).aggregate([([], "count_all")])
        yield from found.rename_columns(["block", "pair", "n"]).to_batches()


def pair_counts(encoded: DataFrame) -> DataFrame:
    """``block, pair, n`` of ``encoded`` (columns ``block``, ``pairs``), one row per block and pair."""
    rows = encoded.select("block", "pairs").mapInArrow(_counts, "block long, pair long, n long")
    return rows.groupBy("block", "pair").agg(F.sum("n").alias("n"))


def _scored(names: list[str], shared):
    """Sums over each document's links, from the counts of its block's pairs."""
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        highest_id, highest = shared.value
        lists = rows["pairs"].combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = pa.concat_arrays(lists.chunks)
        links = pa.table({
            "row": pc.list_parent_indices(lists).cast(pa.int64()), "pair": lists.flatten(),
            "times": pc.list_flatten(rows["times"].combine_chunks()).cast(pa.int64())})
        own = links.group_by("pair", use_threads=False).aggregate([([], "count_all")])
        counts = own.join(answers.select(["pair", "total"]), "pair", use_threads=False)
        pair, total = (counts.column(c).combine_chunks() for c in (
            "pair", "total")) if counts.num_rows else (pa.array([], pa.int64()),) * 2
        order = np.argsort(pair.to_numpy(), kind="stable")
        pair = pair.to_numpy()[order]
        total = pc.coalesce(total, counts["count_all"].combine_chunks() if counts.num_rows
                            else total).to_numpy()[order]
        at = np.searchsorted(pair, links["pair"].to_numpy())
        n, times = total[at], links["times"].to_numpy()
        top = highest[np.searchsorted(highest_id, links["pair"].to_numpy() >> B_BITS)] if len(n) else n
        row, size = links["row"].to_numpy(), rows.num_rows
        sums = {"n_links": np.bincount(row, times, size), "n_best": np.bincount(row, times * (n == top), size),
                "count_sum": np.zeros(size, np.int64)}
        np.add.at(sums["count_sum"], row, times * n)
        out = rows.select(names)
        for c in ("n_links", "n_best", "count_sum"):
            out = out.append_column(c, pa.array(sums[c].astype(np.int64)))
        return out
    return run


def aligned(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with the columns ``NEW``.

    The two vocabulary files are read once on the driver (fixed sizes) and broadcast.
    """
    spark = docs.sparkSession
    with open(b_path, "rb") as f:
        shared = spark.sparkContext.broadcast((read_spec(a_path), f.read()))
    others = [c for c in docs.columns if c != text_col]
    kept = [f"c{i}" for i in range(len(others))]           # own names cannot clash
    rows = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(others, kept)],
                       F.col(f"`{text_col}`").alias("text"))
    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields
                     if f.name != "text")
    encoded = stored(rows.mapInArrow(
        _encode(shared, "text"),
        f"{fields}n_a long, n_b long, n_groups long, groups_sha256 string, "
        "link_pairs array<long>, link_times array<int>, link_block long"), "aligned").withColumnsRenamed(
            {"link_pairs": "pairs", "link_times": "times", "link_block": "block"})
    counted = stored(pair_counts(encoded), "pair-counts")
    totals = stored(counted.groupBy("pair").agg(F.sum("n").alias("total"), F.count("*").alias("blocks")),
                    "pair-totals")
    best = (totals.groupBy(F.shiftright("pair", B_BITS).alias("a")).agg(F.max("total").alias("n"))
            .orderBy("a").toArrow())                       # at most one row per id of A
    highest = spark.sparkContext.broadcast((best["a"].to_numpy(), best["n"].to_numpy()))
    answers = salted_join(counted.select("block", "pair"),
                          totals.where("blocks > 1").select("pair", "total"), ["pair"],
                          F.col("block"), salts=SALTS).select("block", "pair", "total")
    names = [*kept, "n_a", "n_b", "n_groups", "groups_sha256"]
    scored = (encoded.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _scored(names, highest), f"{fields}n_a long, n_b long, n_groups long, groups_sha256 string, "
        "n_links long, n_best long, count_sum long"))
    return scored.select(*[F.col(k).alias(c) for c, k in zip(others, kept)],
                         *[F.col(c).alias(fresh(docs.drop(text_col), c)) for c in NEW])
