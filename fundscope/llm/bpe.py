"""BPE encoding and decoding with forced-boundary splitting.

A vocabulary file of the public tokenizers format (BPE with word ends, byte-level
alphabet) is read; nothing is trained. Every merge result is a vocabulary token, so a
byte pair that stands inside no token can never be merged over: it is a certain cut.
Words are cut at such pairs, the fragments are merged independently, and their ids are
concatenated. Fragments repeat, so each worker keeps the ids of the last ones it met in
a table of at most ``CACHE_ENTRIES`` words; that changes time only, never ids.

Texts are independent, so the work is one ``mapInArrow`` without a shuffle, and a lost
executor repeats its own input split.

Cases: null and empty texts have no ids and decode to the empty string. Texts of any
length are encoded whole. Strings of special tokens become their ids, as in the
library. Repeated rows give equal results. Extra columns pass through untouched; a new
column whose name is taken gets a trailing underscore.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fundscope.llm.common import fresh

CACHE_ENTRIES = 200_000
SLICE_BYTES = 4 << 20                       # text encoded before a batch is handed on
END = "</w>"
NO_RANK = 1 << 60
LONG_FRAGMENT = 64
# Characters on which the file's normalizer is plain lower-casing and its word pattern
# means the same in the regex module: printable Latin, no combining marks, no U+0130.
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-įı-ɏ]*")


def byte_alphabet() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, others follow U+0100."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


def plain_pattern(pattern: str) -> str:
    """The file's word pattern with letters and numbers spelled out for PLAIN texts."""
    plain = [chr(c) for c in range(0x250) if PLAIN.fullmatch(chr(c))]
    kinds = {k: "".join(re.escape(c) for c in plain if unicodedata.category(c)[0] == k) for k in "LN"}
    return re.sub(r"\\p\{([LN])\}", lambda m: kinds[m[1]], pattern)


class ForcedBoundaryBPE:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, spec: str):
        self.library = Tokenizer.from_str(spec)            # normalizer and word rules for rare texts
        spec = json.loads(spec)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END or spec["decoder"]:
            raise ValueError("expected a BPE file with word ends and no decoder")
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.words = re.compile(plain_pattern(split["pattern"]["Regex"]))
        self.vocab: dict[str, int] = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {k: np.int32(v).tobytes() for k, v in special.items()}
        self.special_at = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self.token_of = {v: k for k, v in [*self.vocab.items(), *special.items()]}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {self.vocab[a] << 20 | self.vocab[b]: i for i, (a, b) in enumerate(merges)}
        self.result = [self.vocab[a + b] for a, b in merges]
        self.alphabet = byte_alphabet()
        self.inside = self.pairs_inside_tokens()
        self.cache: dict[str, bytes] = {}

    def pairs_inside_tokens(self) -> set[str]:
        """Neighbouring characters found inside some token; all other pairs are cuts."""
        found = set()
        for token in self.vocab:
            token = token.removesuffix(END)
            found.update(token[i: i + 2] for i in range(len(token) - 1))
        return found

    def fragments(self, word: str) -> list[str]:
        """A byte-level word cut at every pair that no token holds."""
        cuts = [i for i in range(1, len(word)) if word[i - 1: i + 1] not in self.inside]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]

    def merged(self, fragment: str, last: bool) -> list[int]:
        """Ids after the merges of lowest rank, leftmost first, until none applies."""
        ids = [self.vocab[c] for c in fragment]
        if last:
            ids[-1] = self.vocab[fragment[-1] + END]
        if len(ids) > LONG_FRAGMENT:
            return self._merged_long(ids)
        get, none = self.rank.get, NO_RANK
        ranks = [get(a << 20 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            ids[i] = self.result[best]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 20 | ids[i], none)
            if i < len(ranks):
                ranks[i] = get(ids[i] << 20 | ids[i + 1], none)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same by a heap of pairs and links between symbols: n log n."""
        n, get = len(ids), self.rank.get
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(r, i) for i in range(n - 1)
                if (r := get(ids[i] << 20 | ids[i + 1], NO_RANK)) < NO_RANK]
        heapq.heapify(heap)
        while heap:
            best, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or get(ids[i] << 20 | ids[j]) != best:
                continue                                   # one side has been merged since
            ids[i], ids[j] = self.result[best], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] < n:
                    r = get(ids[x] << 20 | ids[after[x]], NO_RANK)
                    if r < NO_RANK:
                        heapq.heappush(heap, (r, x))
        return [x for x in ids if x >= 0]

    def word_ids(self, word: str) -> bytes:
        """Ids of one word as int32 bytes."""
        found = self.cache.get(word)
        if found is None:
            mapped = "".join([self.alphabet[b] for b in word.encode()])
            pieces = self.fragments(mapped)
            ids = [t for i, p in enumerate(pieces) for t in self.merged(p, i == len(pieces) - 1)]
            found = array("i", ids).tobytes()
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            self.cache[word] = found
        return found

    def split_words(self, text: str) -> list[str]:
        if PLAIN.fullmatch(text):
            return self.words.findall(text.lower())
        normal = self.library.normalizer.normalize_str(text)
        if self.library.pre_tokenizer is None:
            return [normal]
        decode = {c: b for b, c in enumerate(self.alphabet)}
        return [bytes(decode[c] for c in word).decode()
                for word, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def encode(self, text: str) -> np.ndarray:
        parts: list[bytes] = []
        for piece in self.special_at.split(text) if "<|" in text else [text]:
            if piece in self.special:
                parts.append(self.special[piece])
            elif piece:
                get, make = self.cache.get, self.word_ids
                parts += [get(w) or make(w) for w in self.split_words(piece)]
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by one space: what the library does for files without a decoder."""
        return " ".join(map(self.token_of.__getitem__, ids.tolist()))


_CODERS: dict[int, ForcedBoundaryBPE] = {}                 # of this Python worker


def _coder(shared) -> ForcedBoundaryBPE:
    spec = shared.value
    key = hash(spec)
    if key not in _CODERS:
        _CODERS[key] = ForcedBoundaryBPE(spec)
    return _CODERS[key]


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_decode(docs: DataFrame, vocab_path: str, text_col: str = "text",
                  ids_name: str = "ids", decoded_name: str = "decoded") -> DataFrame:
    """All columns of ``docs`` plus ``ids`` (array<int>) and ``decoded`` (text of the ids).

    The vocabulary file is read once on the driver (a few MB, a fixed size) and broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_spec(vocab_path))
    ids_name = fresh(docs, ids_name)
    decoded_name = fresh(docs, decoded_name)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for batch in batches:
            start, size, ids, texts = 0, 0, [], []
            for row in range(batch.num_rows):
                text = batch.column(at)[row].as_py() or ""
                own = coder.encode(text)
                ids.append(own)
                texts.append(coder.decode(own))
                size += len(text)
                if size >= SLICE_BYTES or row == batch.num_rows - 1:
                    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                    part = batch.slice(start, len(ids))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, lists, pa.array(texts, pa.string())],
                        [*part.schema.names, ids_name, decoded_name])
                    start, size, ids, texts = row + 1, 0, [], []

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, {ids_name} array<int>, {decoded_name} string")


def ids_text(ids: str = "ids"):
    """Decimal ids joined by one space."""
    return F.concat_ws(" ", F.col(ids).cast("array<string>"))
