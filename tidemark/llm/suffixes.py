"""Two-stage sorting of suffixes, in numpy, for one bounded buffer."""

from __future__ import annotations

import numpy as np


def eights(held: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as a big-endian number, so that numbers order as bytes do."""
    return np.ndarray((len(held) - 7,), ">u8", held, strides=(1,))


def smaller_than_next(held: np.ndarray) -> np.ndarray:
    """Whether the suffix at a position is smaller than the suffix after it. The last one is taken as smaller."""
    n = len(held)
    rises = held[:-1] < held[1:]
    # Equal bytes take over from the next place where the bytes differ.
    place = np.where(held[:-1] != held[1:], np.arange(n - 1), n - 1)
    following = np.minimum.accumulate(place[::-1])[::-1]
    return np.concatenate([np.concatenate([rises, [True]])[following], [True]])


def sorted_directly(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their first ``depth`` bytes, eight at a time; only what is still tied is read on."""
    key = words[at].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(at) else np.zeros(0, bool)
    group = np.cumsum(new)
    where = np.arange(len(at))
    for offset in range(8, depth, 8):
        tied = np.zeros(len(where), bool)
        if len(where):
            same = group[1:] == group[:-1]
            tied[1:] |= same
            tied[:-1] |= same
        where, group = where[tied], group[tied]
        if not len(where):
            break
        key = words[at[where] + offset].astype(np.uint64)
        differs = (group[1:] == group[:-1]) & (key[1:] != key[:-1])
        if not differs.any():
            continue
        mixed = np.isin(group, group[1:][differs])
        some = np.flatnonzero(mixed)
        order = some[np.lexsort((key[some], group[some]))]
        at[where[some]] = at[where[order]]
        key[some] = key[order]
        group = np.cumsum(np.concatenate([[True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])]))
    return at


def sorted_suffixes(held: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted positions in the order of their suffixes, compared to ``depth`` bytes at least.

    ``held`` ends with ``depth + 8`` spare bytes. Suffixes smaller than their successors are sorted directly. A scan
    of the buckets of first bytes, in order, then places all others: the suffix before a placed one goes to the next
    free place of its own bucket, before the directly sorted ones there.
    """
    small = smaller_than_next(held)
    # A larger suffix is placed through its successors up to the next smaller one.
    included = np.zeros(len(held), bool)
    included[wanted] = True
    need = np.zeros(len(held) + 1, np.int64)
    stops = np.flatnonzero(small)
    large = wanted[~small[wanted]]
    np.add.at(need, large, 1)
    np.add.at(need, stops[np.searchsorted(stops, large)] + 1, -1)
    included |= np.cumsum(need[:-1]) > 0
    direct = sorted_directly(eights(held), np.flatnonzero(included & small & (np.arange(len(held)) < len(held) - depth - 8)), depth)
    induced = included & ~small
    bucket = np.searchsorted(held[direct], np.arange(257)) if len(direct) else np.zeros(257, np.int64)
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []

    def place_before(placed: np.ndarray, byte: int) -> np.ndarray:
        """Queue the suffixes before the placed ones; return those that belong to the bucket being scanned."""
        before = placed[placed > 0] - 1
        before = before[induced[before]]
        first = held[before]
        later = before[first > byte]
        if len(later):
            of = held[later]
            later = later[np.argsort(of, kind="stable")]
            ends = np.searchsorted(held[later], np.arange(257))
            for b in np.unique(of).tolist():
                waiting[b].append(later[ends[b] : ends[b + 1]])
        return before[first == byte]

    for byte in range(256):
        now = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        waiting[byte] = []
        while len(now):
            out.append(now)
            now = place_before(now, byte)
        own = direct[bucket[byte] : bucket[byte + 1]]
        if len(own):
            out.append(own)
            place_before(own, byte)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    keep = np.zeros(len(held), bool)
    keep[wanted] = True
    return order[keep[order]]


def common_prefixes(held: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each position in ``order`` shares its first ``length`` bytes with the one before it."""
    words = eights(held)
    same = np.zeros(len(order), bool)
    at = np.arange(1, len(order))
    for offset in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        at = at[words[order[at] + offset] == words[order[at - 1] + offset]]
    same[at] = True
    return same
