"""Suffix array of one bounded shard by induced sorting, and its permuted common prefixes."""

from __future__ import annotations

from array import array

import numpy as np


def suffix_types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is larger than its successor (L). The last symbol is the sentinel."""
    n = len(s)
    falls = s[:-1] > s[1:]
    differs = np.flatnonzero(s[:-1] != s[1:])
    # runs of one symbol take the type of the next place where symbols differ
    nearest = differs[np.searchsorted(differs, np.arange(n - 1))] if n > 1 else differs
    return np.append(falls[nearest], False)


def _induce(before, l_before: bytes, s_before: bytes, heads: list[int], tails: list[int],
            seeds: list[int], symbols) -> np.ndarray:
    """Order of all suffixes induced from leftmost-smaller ones in the order given.

    ``before[x]`` is the symbol before position x; ``l_before`` and ``s_before`` tell whether
    the suffix that starts there is the larger or the smaller kind (0 for x = 0, which also
    stands for "not yet").
    """
    sa = array("i", bytes(4 * len(l_before)))
    tail = tails.copy()
    for x in reversed(seeds):
        c = symbols[x]
        t = tail[c] = tail[c] - 1
        sa[t] = x
    head = heads.copy()
    for x in sa:                                           # larger suffixes, left to right
        if l_before[x]:
            c = before[x]
            h = head[c]
            sa[h] = x - 1
            head[c] = h + 1
    tail = tails.copy()
    for x in reversed(sa):                                 # smaller suffixes, right to left
        if s_before[x]:
            c = before[x]
            t = tail[c] = tail[c] - 1
            sa[t] = x - 1
    sa[0] = len(sa) - 1                                    # the sentinel
    return np.frombuffer(sa, np.int32).astype(np.int64)


def induced_suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of non-negative numbers whose last is the only and least one, 0."""
    n = len(s)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    types = suffix_types(s)
    counts = np.bincount(s)
    ends = np.cumsum(counts)
    heads, tails = (ends - counts).tolist(), ends.tolist()
    kind = types.astype(np.uint8)
    l_before = b"\0" + kind[:-1].tobytes()
    s_before = b"\0" + (1 - kind[:-1]).tobytes()
    symbols = s.astype(np.uint8).tobytes() if len(counts) <= 256 else s.tolist()
    before = symbols[:1] + symbols[:-1]
    lms = np.flatnonzero(~types[1:] & types[:-1]) + 1
    order = _induce(before, l_before, s_before, heads, tails, lms.tolist(), symbols)
    # name the leftmost-smaller substrings in their induced order; equal ones share a name
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = order[is_lms[order]]
    raw = s.astype(np.int32).tobytes()
    upto = np.zeros(n, np.int64)
    upto[lms] = np.append(lms[1:] + 1, n)
    first, last = (4 * order).tolist(), (4 * upto[order]).tolist()
    new = np.ones(len(order), bool)
    new[1:] = [raw[first[i]: last[i]] != raw[first[i - 1]: last[i - 1]]
               for i in range(1, len(order))]
    names = np.zeros(n, np.int64)
    names[order] = np.cumsum(new) - 1
    reduced = names[lms]
    if new.all():
        ranks = order
    else:
        ranks = lms[induced_suffix_array(reduced)]
    return _induce(before, l_before, s_before, heads, tails, ranks.tolist(), symbols)


def permuted_lcp(data: bytes, sa: np.ndarray) -> np.ndarray:
    """For each position, the length it shares with its predecessor in the suffix array.

    In text order a prefix shrinks by one at most per step, so the total work is linear.
    ``data`` ends in a symbol that occurs once.
    """
    n = len(sa)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    out, length = array("q", bytes(8 * n)), 0
    for i, j in enumerate(before.tolist()):
        if j < 0:
            length = 0
            continue
        while data[i + length] == data[j + length]:
            length += 1
        out[i] = length
        if length:
            length -= 1
    return np.frombuffer(out, np.int64)


# UTF-8 never holds the bytes 0xF8 to 0xFF: moved up by one, the codes 0 and 255 are free.
_UP = bytes([*range(1, 256), 0])
_SEPARATOR, _SENTINEL = b"\xff", b"\x00"


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece, the starts whose next ``length`` bytes also start elsewhere in the pieces."""
    data = _SEPARATOR.join(p.translate(_UP) for p in pieces) + _SEPARATOR + _SENTINEL
    sa = induced_suffix_array(np.frombuffer(data, np.uint8))
    lcp = permuted_lcp(data, sa)[sa]
    long = lcp >= length
    long[:-1] |= lcp[1:] >= length
    found = np.zeros(len(data), bool)
    found[sa[long]] = True
    out, at = [], 0
    for p in pieces:
        out.append(np.flatnonzero(found[at: at + max(0, len(p) - length + 1)]))
        at += len(p) + 1
    return out
