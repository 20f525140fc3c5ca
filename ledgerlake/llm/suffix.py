"""Suffix arrays by induced sorting, in numpy.

Positions are smaller-type (S) or larger-type (L), as their suffix compares with the next one.  The
leftmost S positions cut the text into substrings; these are sorted and named, and the string of
their names is sorted recursively (by pairs, pairs of pairs, ..., as deep as the wanted depth needs),
which orders the leftmost S suffixes.  All L suffixes follow from them in one pass over the buckets
from the left, all S suffixes in one from the right.  A bucket (all suffixes with one first
character) is handled as an array; suffixes that lead to their own bucket are taken in waves.
"""

from __future__ import annotations

import numpy as np


def types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the last position (a unique least
    character) counts as smaller."""
    n = len(t)
    smaller = np.ones(n, bool)
    if n > 1:
        differs = np.flatnonzero(t[:-1] != t[1:])
        # each position is decided at the next place where the text changes
        at = differs[np.minimum(np.searchsorted(differs, np.arange(n - 1)), len(differs) - 1)]
        smaller[:-1] = t[at] < t[at + 1]
    return smaller


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """Dense ranks of rows by the given keys, the first one most significant."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _names(t: np.ndarray, smaller: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Dense names of the substrings from each leftmost S position to the next one, both included, in
    lexicographic order of (character, type)."""
    length = np.append(np.diff(at) + 1, 1)
    code = np.concatenate([t.astype(np.int64) * 2 + smaller + 1, np.zeros(6, np.int64)])
    names = np.zeros(len(at), np.int64)
    todo = np.arange(len(at))
    done = 0
    while len(todo):
        word = np.zeros(len(todo), np.int64)
        for k in range(6):  # six characters of ten bits
            inside = done + k < length[todo]
            word = (word << 10) | np.where(inside, code[np.minimum(at[todo] + done + k, len(code) - 1)], 0)
        done += 6
        if len(todo) == len(at):
            names = _ranks(names, word)
        else:  # finer names within those that were equal so far
            fine = np.zeros(len(at), np.int64)
            fine[todo] = word
            names = _ranks(names, fine)
        equal = np.bincount(names)[names] > 1
        todo = np.flatnonzero(equal & (length > done))
    return names


def _reduced(names: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes of the string of names, told apart at least to ``depth`` names."""
    rank, step = names, 1
    while step < depth and len(rank) and rank.max() + 1 < len(rank):
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-step] = rank[step:] + 1
        rank = _ranks(rank * (len(rank) + 2) + ahead)
        step *= 2
    return rank


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``t`` in order, told apart at least in their first ``depth`` characters.

    ``t`` holds small integers below 510 and ends with a 0 that occurs nowhere else."""
    n, size = len(t), int(t.max()) + 1
    if n == 1:
        return np.zeros(1, np.int64)
    smaller = types(t)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    rank = _reduced(_names(t, smaller, lms), depth)
    lms = lms[np.argsort(rank, kind="stable")]
    edges = np.searchsorted(t[lms], np.arange(size + 1))  # sorted by first character already

    def hand_out(suffixes: np.ndarray, good: np.ndarray, queues: list[list[np.ndarray]]) -> None:
        """Queue the preceding suffixes by their first character, in the order given."""
        before = suffixes[good] - 1
        first = t[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
        for part in np.split(before, cuts) if len(before) else ():
            queues[t[part[0]]].append(part)

    def waves(start: list[np.ndarray], c: int) -> np.ndarray:
        out = list(start)
        now = np.concatenate(start) if start else np.zeros(0, np.int64)
        while len(now):
            now = now[now > 0] - 1
            now = now[t[now] == c]
            out.append(now)
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    none = np.zeros(0, np.int64)
    larger: list[np.ndarray] = [none] * size
    queues: list[list[np.ndarray]] = [[] for _ in range(size)]
    for c in range(size):
        larger[c] = waves(queues[c], c)
        for suffixes in (larger[c], lms[edges[c]:edges[c + 1]]):
            # a preceding suffix is L in a later bucket exactly if its first character is larger
            hand_out(suffixes, (suffixes > 0) & (t[suffixes - 1] > c), queues)
    smaller_desc: list[np.ndarray] = [none] * size
    queues = [[] for _ in range(size)]
    queues[0].append(np.array([n - 1]))
    for c in range(size - 1, -1, -1):
        smaller_desc[c] = waves(queues[c], c) if c else queues[0][0]
        for suffixes in (smaller_desc[c], larger[c][::-1]):
            hand_out(suffixes, (suffixes > 0) & (t[suffixes - 1] < c), queues)
    return np.concatenate([x for c in range(size) for x in (larger[c], smaller_desc[c][::-1])])


def common_prefixes(data: np.ndarray, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: length of the common prefix of the suffixes i and j of the bytes
    ``data``, ``most`` (at least 8) at the most; both have so many bytes left."""
    words = np.ndarray((max(0, len(data) - 7),), "<u8", data.tobytes(), strides=(1,))
    out = np.full(len(i), most, np.int64)
    live = np.arange(len(i))
    for at in [*range(0, most - 7, 8), *([most - 8] if most % 8 else [])]:
        x = words[i[live] + at] ^ words[j[live] + at]
        bad = np.flatnonzero(x)
        low = x[bad] & (~x[bad] + np.uint64(1))
        out[live[bad]] = at + np.log2(low.astype(np.float64)).astype(np.int64) // 8
        live = live[x == 0]
    return out
