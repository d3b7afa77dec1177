"""Word shingles of texts as 64-bit numbers, and their circulant MinHash signatures."""

from __future__ import annotations

import hashlib

import numpy as np

LOWERED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = 0x9E3779B97F4A7C15 | 1


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(32))


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Stretches:
    """Hashes of stretches of a byte string: a polynomial over all bytes, taken apart by positions."""

    _up = np.zeros(0, np.uint64)
    _down = np.zeros(0, np.uint64)

    def __init__(self, held: bytes) -> None:
        n = len(held)
        if len(Stretches._up) <= n:
            Stretches._up, Stretches._down = powers(_BASE, n + 1), powers(pow(_BASE, -1, 1 << 64), n + 1)
        values = (np.frombuffer(held, np.uint8).astype(np.uint64) + np.uint64(1)) * Stretches._up[:n]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * Stretches._down[starts])


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its stretches of ``words`` words (the whole text if it has fewer)."""
    split = [(t or "").encode("utf-8", "surrogatepass").translate(LOWERED).split() for t in texts]
    held = b"\n".join(b" ".join(w) for w in split)
    counts = np.array([len(w) for w in split], np.int64)
    lengths = np.fromiter((len(w) for own in split for w in own), np.int64, int(counts.sum()))
    # A word is followed by one byte, and a text without words by one more.
    row = np.repeat(np.arange(len(split)), counts)
    empty_before = np.concatenate([[0], np.cumsum(counts == 0)])[row] if len(row) else row
    starts = np.cumsum(lengths + 1) - lengths - 1 + empty_before
    ends = starts + lengths
    hashes = Stretches(held)
    first = np.concatenate([[0], np.cumsum(counts)])
    out = []
    whole = np.zeros(0, np.uint64)
    if len(starts) >= words:
        every = hashes.hashes(starts[: len(starts) - words + 1], ends[words - 1 :])
    else:
        every = whole
    for at, n in zip(first.tolist(), counts.tolist()):
        if n >= words:
            out.append(np.unique(every[at : at + n - words + 1]))
        elif n:
            out.append(hashes.hashes(starts[at : at + 1], ends[at + n - 1 : at + n]))
        else:
            out.append(whole)
    return out


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


class Circulant:
    """Signatures from two permutations of the 32-bit numbers.

    The first scrambles the elements once. Coordinate k is the smallest value of the second permutation, circularly
    shifted by k places, over the scrambled elements.
    """

    COLUMNS = 1024

    def __init__(self, coordinates: int) -> None:
        self.shift = np.arange(coordinates, dtype=np.uint32)[:, None]

    @staticmethod
    def first(shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0x5BD1E995)
        x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
        return x ^ (x >> np.uint32(16))

    @staticmethod
    def second(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
        """In place."""
        for bits, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            np.right_shift(x, np.uint32(bits), out=spare)
            np.bitwise_xor(x, spare, out=x)
            np.multiply(x, np.uint32(factor), out=x)
        np.right_shift(x, np.uint32(16), out=spare)
        return np.bitwise_xor(x, spare, out=x)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        out = np.full(len(self.shift), 0xFFFFFFFF, np.uint32)
        elements = self.first(shingles)
        for at in range(0, len(elements), self.COLUMNS):
            x = elements[None, at : at + self.COLUMNS] - self.shift
            np.minimum(out, self.second(x, np.empty_like(x)).min(axis=1), out=out)
        return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates; the band's number is part of it."""
    bands = signature.reshape(-1, rows).astype(np.uint64)
    key = np.arange(len(bands), dtype=np.uint64) + np.uint64(1)
    for i in range(rows):
        key = mixed(key * np.uint64(_BASE) + bands[:, i])
    return key.view(np.int64)
