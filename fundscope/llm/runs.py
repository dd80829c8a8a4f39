"""Periodic runs of words in a text, by block convolution.

A run is a stretch of consecutive words with smallest period q (words q apart are equal)
and a length of at least max(MIN_LENGTH, 2q) that no neighbouring word extends.

Words become integers, no integer is shared by two texts, and the texts of a slice lie
behind each other in one array. At each dyadic scale L the array is cut into blocks of L
words. A run with a period in the scale's range holds a whole block whose copy, one
period later, lies in the window that follows the block. An integer number theoretic
transform (mod ``PRIME``) of all blocks and windows gives the sum of squared differences
at every distance; a sum of zero is an occurrence, confirmed by comparing the words (the
modulus can make a large sum zero, never a zero another). Consecutive blocks that occur at
one distance are joined and extended by comparing words, at most L to each side: the block
beyond does not occur there. What is long enough and has no smaller period is a run.

Scale 2 serves the periods 1 to 7, scale L >= 4 the periods 2L to 4L - 1. Blocks that
provably give nothing are not transformed: the block's rarest word does not recur at the
scale's distances, or block and window lie inside a run already found of period p <= L
(what matches there is that run again).

A text is a row of its own and stays in its task: one ``mapInArrow`` without a shuffle.

Cases: null and empty texts have no words, no runs and an empty digest text. Rows with equal
or null ids are texts of their own. Ties for the longest run go to the smaller start, then
period. Texts of any length are handled whole; a worker needs some 200 bytes for a word of
its longest text. Other columns are kept; a new column whose name is taken gets a trailing
underscore. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.llm.common import fresh

MIN_LENGTH = 12
SLICE_WORDS = 1 << 17                       # words of short texts handled at once
PRIME = 2013265921                          # 15 * 2**27 + 1, and a generator of its units
GENERATOR = 31
ROWS_WORDS = 1 << 20                        # words transformed at once (one row at least)

_ROOTS: dict[tuple[int, bool], list[np.ndarray]] = {}


def _roots(size: int, inverse: bool) -> list[np.ndarray]:
    """Powers of the roots of unity for each round of a transform."""
    if (size, inverse) not in _ROOTS:
        rounds, n = [], size
        while n > 1:
            root = pow(GENERATOR, (PRIME - 1) // n, PRIME)
            if inverse:
                root = pow(root, PRIME - 2, PRIME)
            powers = np.ones(1, np.uint64)
            while len(powers) < n // 2:                    # doubling
                step = np.uint64(pow(root, len(powers), PRIME))
                powers = np.concatenate([powers, powers * step % PRIME])
            rounds.append(powers)
            n //= 2
        _ROOTS[size, inverse] = rounds
    return _ROOTS[size, inverse]


def transform(x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number theoretic transform of each row; sizes are powers of two.

    Forward leaves the result in bit-reversed order, inverse takes that order, so products
    of transforms need no reordering. The inverse is not divided by the size.
    """
    rows, size = x.shape
    rounds = _roots(size, inverse)
    p = np.uint64(PRIME)
    if not inverse:
        half = size // 2
        for powers in rounds:
            x = x.reshape(rows, -1, 2, half)
            a, b = x[:, :, 0], x[:, :, 1]
            x = np.stack([(a + b) % p, (a + (p - b)) % p * powers % p], 2)
            half //= 2
    else:
        half = 1
        for powers in reversed(rounds):
            x = x.reshape(rows, -1, 2, half)
            a, b = x[:, :, 0], x[:, :, 1] * powers % p
            x = np.stack([(a + b) % p, (a + (p - b)) % p], 2)
            half *= 2
    return x.reshape(rows, size)


def occurrences(words: np.ndarray, starts: np.ndarray, length: int, near: int, far: int):
    """(start, distance) of each zero of the squared differences of a block and its window.

    The block of ``length`` words at each start is compared at the distances near to far - 1.
    """
    p = np.uint64(PRIME)
    span = far - near - 1 + length
    size = 1 << (span - 1).bit_length()
    scale = np.uint64(pow(size, PRIME - 2, PRIME))
    found = []
    step = max(1, ROWS_WORDS // size)
    for i in range(0, len(starts), step):
        at = starts[i: i + step, None]
        block, window = np.zeros((2, len(at), size), np.uint64)
        block[:, :length] = words[at + np.arange(length)]
        window[:, :span] = words[at + near + np.arange(span)]
        block %= p
        window %= p
        square = np.cumsum(np.concatenate([np.zeros((len(at), 1), np.uint64),
                                           window[:, :span] * window[:, :span] % p], 1), 1)
        own = (block * block % p).sum(1, keepdims=True)
        moved = (own + square[:, length:] - square[:, :span - length + 1]) % p
        mirror = np.concatenate([block[:, :1], block[:, :0:-1]], 1)      # correlation
        cross = transform(transform(mirror) * transform(window) % p, True)[:, : far - near]
        row, distance = np.nonzero(moved == cross * scale % p * np.uint64(2) % p)
        found.append((starts[i: i + step][row], distance + near))
    if not found:
        return np.zeros((2, 0), np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([d for _, d in found])


def _recurs(words: np.ndarray, starts: np.ndarray, length: int, near: int, far: int,
            key: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Whether the rarest word of each block stands again at one of the distances."""
    keep = np.zeros(len(starts), bool)
    step = max(1, ROWS_WORDS // length)
    n = len(words)
    for i in range(0, len(starts), step):
        at = starts[i: i + step]
        rarest = at + often[at[:, None] + np.arange(length)].argmin(1)
        low = np.searchsorted(key, words[rarest] * n + rarest + near)
        high = np.searchsorted(key, words[rarest] * n + np.minimum(rarest + far, n))
        keep[i: i + step] = low < high
    return keep


def _extended(words: np.ndarray, at: np.ndarray, distance: np.ndarray, limit: int, step: int):
    """How many words from ``at`` on (step 1 or -1) equal those a distance later, up to limit."""
    n = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    width = 32
    while len(live):
        width = min(2 * width, limit)
        rows = max(1, ROWS_WORDS // width)
        going = []
        for i in range(0, len(live), rows):
            own = live[i: i + rows]
            place = (at[own] + step * n[own])[:, None] + step * np.arange(width)
            same = words[place] == words[place + distance[own, None]]
            full = same.all(1)
            n[own] += np.where(full, width, same.argmin(1))
            going.append(own[full & (n[own] < limit)])
        live = np.concatenate(going)
    return np.minimum(n, limit)


def _prime_divisors(q: int) -> list[int]:
    found, r = [], 2
    while r * r <= q:
        if q % r == 0:
            found.append(r)
            while q % r == 0:
                q //= r
        r += 1
    return found + ([q] if q > 1 else [])


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """(block length, smallest period, largest period + 1) up to half the longest text."""
    if longest >= MIN_LENGTH:
        yield 2, 1, 8
        length = 4
        while 2 * length <= longest // 2:
            yield length, 2 * length, 4 * length
            length *= 2


def runs_of(words: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs of an integer array, by start, then period.

    ``longest`` bounds the length of any stretch (that of the longest text in the array).
    """
    n = len(words)
    if longest < MIN_LENGTH:
        return []
    pad = 6 * max(length for length, _, _ in scales(longest)) + 64
    top = int(words.max()) + 1
    words = np.concatenate([top + np.arange(pad), words, top + pad + np.arange(pad)])
    order = np.argsort(words, kind="stable")
    key = words[order] * len(words) + order
    often = np.bincount(words)[words]
    found: list[tuple[int, int, int]] = []
    for length, near, far in scales(longest):
        starts = np.arange(pad - pad % length, pad + n, length)
        reach, period = _covers(found, len(words))
        inside = (reach[starts] >= starts + far + length) & (period[starts] <= length)
        starts = starts[~inside]
        starts = starts[_recurs(words, starts, length, near, far, key, often)]
        at, q = occurrences(words, starts, length, near, far)
        inside = (reach[at] >= at + q + length) & (period[at] <= length)
        at, q = at[~inside], q[~inside]
        same = _extended(words, at, q, length, 1) == length
        at, q = at[same], q[same]
        if not len(at):
            continue
        order_of = np.lexsort((at, q))
        at, q = at[order_of], q[order_of]
        new = np.ones(len(at), bool)
        new[1:] = (q[1:] != q[:-1]) | (at[1:] != at[:-1] + length)
        first = np.flatnonzero(new)
        start, q = at[first], q[first]
        end = at[np.append(first[1:], len(at)) - 1] + length
        least = np.maximum(MIN_LENGTH - q, q)              # matching words that a run needs
        keep = end - start + 2 * (length - 1) >= least
        keep &= ~((reach[start] >= end + q) & (period[start] <= end - start))
        start, end, q, least = start[keep], end[keep], q[keep], least[keep]
        right = _extended(words, end, q, length, 1)
        left = _extended(words, start - 1, q, length, -1)
        keep = (left < length) & (right < length)          # else a run found before goes on there
        start, end = start - left, end + right
        keep &= end - start >= least
        for s, e, d in zip(start[keep].tolist(), (end + q)[keep].tolist(), q[keep].tolist(), strict=True):
            if (words[s: e - d] == words[s + d: e]).all() and not any(
                    (words[s: s + d] == words[s + d // r: s + d // r + d]).all()
                    for r in _prime_divisors(d)):
                found.append((s, e, d))
    return sorted((s - pad, e - pad, d) for s, e, d in found)


def _covers(found: list[tuple[int, int, int]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place the furthest end of the runs that start there or before, and its period."""
    best = np.zeros(n, np.int64)                           # end, then the smallest period
    for s, e, d in found:
        best[s] = max(best[s], e * n + n - d)
    best = np.maximum.accumulate(best)
    return best // n, n - best % n


def planted(words: list[bytes], checksum: int | None) -> list[bytes]:
    """The words with a periodic tail where the checksum's last decimal digit is 0."""
    n = len(words)
    if checksum is None or checksum % 10 or not n:
        return words
    g = checksum // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a: a + p]
    return words[:a] + (tail * ((n - a) // p + 1))[: n - a]


def _row(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """n_runs, the longest run's figures, the runs' text, kept words joined by one space."""
    text = "".join(f"{s},{e - s},{d}\n" for s, e, d in runs)
    if not runs:
        return 0, None, None, None, None, text, b" ".join(words)
    keep = bytearray(b"\x01") * len(words)
    for s, e, d in runs:
        keep[s + d: e] = bytes(e - s - d)
    s, e, d = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]))
    kept = b" ".join([w for w, k in zip(words, keep, strict=True) if k])
    return len(runs), s, e - s, d, 1000 * (e - s) // d, text, kept


def analysed(texts: list[list[bytes]]) -> Iterator[tuple]:
    """``_row`` of each text's words."""
    first, codes, ends, longest = 0, [], [], 0
    for i, words in enumerate(texts):
        base, own = (codes[-1][1] if codes else 0), {}
        ids = [own.setdefault(w, base + len(own)) for w in words]
        codes.append((np.array(ids, np.int64), base + len(own)))
        ends.append((ends[-1] if ends else 0) + len(words))
        longest = max(longest, len(words))
        if ends[-1] >= SLICE_WORDS or i == len(texts) - 1:
            found: list[list] = [[] for _ in ends]
            if ends[-1]:
                runs = runs_of(np.concatenate([c for c, _ in codes]), longest)
                of = np.searchsorted(ends, [s for s, _, _ in runs], "right") if runs else []
                for k, (s, e, d) in zip(of, runs):
                    before = ends[k - 1] if k else 0
                    found[k].append((s - before, e - before, d))
            for k, runs in enumerate(found):
                yield _row(texts[first + k], runs)
            first, codes, ends, longest = i + 1, [], [], 0


SLICE_BYTES = 1 << 20
COLUMNS = ("n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_text string, collapsed string")
NAMES = ("n_runs", "start", "length", "period", "exponent_milli", "runs_text", "collapsed")


def _detect(plant: Callable, text_name: str, digests: bool):
    """Rows of a batch with the columns NAMES in place of the text, in slices of bounded text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_name)
            rest = batch.remove_column(at).remove_column(batch.schema.get_field_index("checksum") - 1)
            start, held, texts = 0, 0, []
            for row in range(batch.num_rows):
                text = batch.column(at)[row].as_py()
                words = (text or "").encode().split()      # bytes.split: ASCII blanks only
                texts.append(plant(words, batch.column("checksum")[row].as_py()))
                held += len(text or "")
                if held >= SLICE_BYTES or row == batch.num_rows - 1:
                    found = list(zip(*analysed(texts), strict=True))
                    if digests:
                        found[5] = [hashlib.sha256(x.encode()).hexdigest() for x in found[5]]
                        found[6] = [hashlib.sha256(x).hexdigest() for x in found[6]]
                    else:
                        found[6] = [x.decode() for x in found[6]]
                    own = rest.slice(start, len(texts))
                    columns = [pa.array(found[k], pa.int64()) for k in range(5)]
                    columns += [pa.array(found[k], pa.string()) for k in (5, 6)]
                    yield pa.RecordBatch.from_arrays([*own.columns, *columns],
                                                     [*own.schema.names, *NAMES])
                    start, held, texts = row + 1, 0, []
    return run


def detect(docs: DataFrame, text_col: str = "text", checksum=None, digests: bool = False) -> DataFrame:
    """``docs`` without the text, with NAMES: the longest run, all runs and the text without repeats.

    ``runs_text`` has a line ``start,length,period`` for each run; ``collapsed`` are the words that
    no run repeats, joined by one space. With ``digests`` these two are SHA-256 sums.
    ``checksum`` (a column) plants a periodic tail first (see ``planted``).
    """
    others = [c for c in docs.columns if c != text_col]
    kept = [f"c{i}" for i in range(len(others))]           # own names cannot clash
    rows = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(others, kept)],
                       F.col(f"`{text_col}`").alias("text"),
                       (F.lit(None) if checksum is None else checksum).cast("long").alias("checksum"))
    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields
                     if f.name not in ("text", "checksum"))
    out = rows.mapInArrow(_detect(planted, "text", digests), fields + COLUMNS)
    free = docs.drop(text_col)
    return out.select(*[F.col(k).alias(c) for c, k in zip(others, kept)],
                      *[F.col(c).alias(fresh(free, c)) for c in NAMES])
