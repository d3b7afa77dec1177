"""Periodic runs of words, found by joining suffix classes in descending order of their common prefixes.

A run is a stretch of a text that repeats its first q words, q its smallest period, and that no neighbouring word
continues. For a run of length n the places i (its start) and i + q share exactly n - q words, and no place between
them shares as many: otherwise the period would be smaller. So the runs are read off a Kruskal walk: all neighbours of
the suffix array are taken by decreasing common prefix, the classes of the two suffixes are united, and every pair of
places that becomes adjacent in the ordered set of a class, at a distance within the common prefix, seeds a run. A
pair whose left neighbours also agree lies inside a run that starts further left and is left to that one.

Only places whose shortest admissible common prefix occurs twice in their text can take part, so only those are sorted.
Texts are worked on in stretches of some megabytes; a longer text is worked on alone, in memory in proportion to it.

Behaviour: a missing or empty text has no words, no runs and an empty collapsed text. Rows are independent of each
other: repeated rows, repeated ids and missing ids each get their own result. Further columns of the table are not
read and not returned; the result has ``doc_id``, ``n_words``, ``runs`` and ``collapsed`` whatever they are called.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stretches

_RESULT = "doc_id {id}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def least_prefix(least_length: int, exponent: int) -> int:
    """The fewest words that the start of a run shares with the place one period later."""
    around = max(1, least_length // exponent)
    return min(max(least_length, exponent * q) - q for q in (around, around + 1))


def coded(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All words as numbers from 1, a zero before the first text and after each one; the places of the first words."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    words = pa.array([w for text in texts for w in text], pa.binary()).dictionary_encode()
    starts = 1 + np.cumsum(sizes + 1) - (sizes + 1)
    codes = np.zeros(1 + int(sizes.sum()) + len(texts), np.int64)
    codes[np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))] = words.indices.to_numpy(zero_copy_only=False) + 1
    return codes, starts


def repeated_windows(codes: np.ndarray, text_of: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Places whose window of ``width`` words may occur twice in their text: all that do, hardly any that do not."""
    count = len(codes) - width + 1
    if count < 2:
        return np.zeros(0, np.int64)
    mixed = text_of[:count].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for t in range(width):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + codes[t : t + count].astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    inside = np.flatnonzero((np.arange(count) + width <= ends[text_of[:count]]) & (codes[:count] > 0))
    mixed = mixed[inside]
    order = np.argsort(mixed)
    same = mixed[order[1:]] == mixed[order[:-1]]
    twice = np.zeros(len(inside), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return inside[twice]


def common_prefixes(codes: np.ndarray, text_of: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order that share ``width`` words or more: ordered places, two of their indexes, the number.

    Places are ranked by windows of ``width`` words, then by windows of twice the length, until all ranks differ. The
    rank arrays are kept: a common prefix is put together from them, longest windows first.
    """
    found = repeated_windows(codes, text_of, ends, width)
    if not len(found):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    taken = np.zeros(len(codes), bool)
    taken[found] = True
    taken[found + width] = True
    places = np.flatnonzero(taken)
    at = np.zeros(len(codes), np.int32)
    at[places] = np.arange(len(places))
    end = ends[text_of[places]]
    window = [codes[np.minimum(places + t, end)] for t in range(width)]
    order = np.lexsort([*window[::-1], text_of[places]])
    fresh = np.ones(len(places), bool)
    fresh[1:] = text_of[places[order[1:]]] != text_of[places[order[:-1]]]
    for column in window:
        fresh[1:] |= column[order[1:]] != column[order[:-1]]
    del window
    rank = np.empty(len(places), np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
    levels, length = [], width
    while True:
        sizes = np.bincount(rank, minlength=len(places))
        open_ = np.flatnonzero(sizes[rank] > 1)
        if not len(open_):
            break
        levels.append(rank.astype(np.int32))
        key = rank[open_] * len(places) + rank[at[places[open_] + length]]
        order = np.argsort(key, kind="stable")
        key, open_ = key[order], open_[order]
        group = rank[open_]
        number = np.arange(len(open_))
        first = np.maximum.accumulate(np.where(np.r_[True, group[1:] != group[:-1]], number, 0))
        part = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], number, 0))
        rank[open_] = group + part - first
        length *= 2
    if not levels:
        empty = np.zeros(0, np.int64)
        return places, empty, empty, empty
    sorted_ = np.empty(len(places), np.int64)
    sorted_[rank] = np.arange(len(places))
    one, two = sorted_[:-1], sorted_[1:]
    near = levels[0][one] == levels[0][two]
    one, two = one[near], two[near]
    x, y = places[one], places[two]
    for k in range(len(levels) - 1, -1, -1):
        step = np.where(levels[k][at[x]] == levels[k][at[y]], width << k, 0)
        x, y = x + step, y + step
    alive = np.ones(len(x), bool)
    for _ in range(width - 1):
        alive &= (codes[x] == codes[y]) & (codes[x] > 0)
        x, y = x + alive, y + alive
    return places, one, two, x - places[one]


def seeds(places: np.ndarray, one: np.ndarray, two: np.ndarray, prefix: np.ndarray, left: np.ndarray, least_length: int, exponent: int) -> list[tuple[int, int, int]]:
    """Runs as (place, length, period), from the neighbours of the suffix array by decreasing common prefix.

    ``left`` holds the word before each place. A class is an ordered list of indexes of places; the smaller list
    goes into the larger one. Pairs that become adjacent wait until all classes of their level are united, since a
    third class of the same level may still come between them.
    """
    by_prefix = np.argsort(-prefix, kind="stable")
    place, word = places.tolist(), left.tolist()
    parent = list(range(len(place)))
    classes: list[list[int] | None] = [None] * len(place)
    runs: list[tuple[int, int, int]] = []
    waiting: list[tuple[int, int]] = []
    level = -1

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def settle() -> None:
        for x, y in waiting:
            members = classes[top(x)]
            after = bisect_left(members, x) + 1
            if after < len(members) and members[after] == y:
                runs.append((place[x], level + place[y] - place[x], place[y] - place[x]))
        waiting.clear()

    for x, y, shared in zip(one[by_prefix].tolist(), two[by_prefix].tolist(), prefix[by_prefix].tolist(), strict=True):
        if shared != level:
            settle()
            level = shared
        x, y = top(x), top(y)
        large, small = classes[x] or [x], classes[y] or [y]
        if len(large) < len(small):
            x, y, large, small = y, x, small, large
        parent[y], classes[y] = x, None
        if len(small) == 1:
            (new,) = small
            k = bisect_left(large, new)
            pairs = ((large[k - 1], new),) if k else ()
            if k < len(large):
                pairs = (*pairs, (new, large[k]))
            large.insert(k, new)
        else:
            theirs = set(small)
            if 16 * len(small) > len(large):
                large = sorted(large + small)
                pairs = [(a, b) for a, b in zip(large, large[1:], strict=False) if (a in theirs) != (b in theirs)]
            else:
                pairs = []
                for new in small:
                    large.insert(bisect_left(large, new), new)
                for new in small:
                    k = bisect_left(large, new)
                    if k and large[k - 1] not in theirs:
                        pairs.append((large[k - 1], new))
                    if k + 1 < len(large) and large[k + 1] not in theirs:
                        pairs.append((new, large[k + 1]))
        classes[x] = large
        for a, b in pairs:
            apart = place[b] - place[a]
            if apart * (exponent - 1) <= shared and apart + shared >= least_length and word[a] != word[b]:
                waiting.append((a, b))
    settle()
    return runs


def runs_of(texts: list[list[bytes]], least_length: int = 6, exponent: int = 4) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """Per text, given as its words: the runs as (start, length, period) in order, and the words left, joined by spaces."""
    if not texts:
        return [], []
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    codes, starts = coded(texts)
    width = least_prefix(least_length, exponent)
    ends = starts + np.fromiter(map(len, texts), np.int64, len(texts))
    text_of = np.zeros(len(codes), np.int64)
    text_of[1:] = np.repeat(np.arange(len(texts)), ends - starts + 1)
    padded = np.r_[codes, np.zeros(width, np.int64)]
    places, one, two, prefix = common_prefixes(padded, np.r_[text_of, np.full(width, len(texts) - 1)], ends, width)
    dropped = np.zeros(len(codes) + 1, np.int64)
    for place, length, period in seeds(places, one, two, prefix, padded[places - 1], least_length, exponent):
        text = int(text_of[place])
        found[text].append((place - int(starts[text]), length, period))
        dropped[place + period] += 1
        dropped[place + length] -= 1
    kept = np.cumsum(dropped) == 0
    left = []
    for words, runs, start in zip(texts, found, starts.tolist(), strict=True):
        runs.sort(key=lambda run: (run[0], run[2]))
        left.append(b" ".join(compress(words, kept[start : start + len(words)].tolist()) if runs else words))
    return found, left


def find(docs: DataFrame, least_length: int = 6, exponent: int = 4) -> DataFrame:
    """Per row of ``docs`` its ``doc_id``, ``n_words``, all ``runs`` and the ``collapsed`` text.

    A run has at least ``least_length`` words and ``exponent`` (two or more) periods. Collapsing drops the words of
    every run after its first period; the words left are joined by one space.
    """
    if exponent < 2 or least_length < 2:
        raise ValueError("a run has two words and two periods at least")
    span = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in stretches(batch, 1):
                texts = [(raw or b"").split() for raw in cut.column(1).cast(pa.binary()).to_pylist()]
                found, left = runs_of(texts, least_length, exponent)
                flat = [dict(zip(("start", "length", "period"), one, strict=True)) for runs in found for one in runs]
                offsets = pa.array(np.r_[0, np.cumsum([len(runs) for runs in found])].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        cut.column(0),
                        pa.array([len(words) for words in texts], pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(flat, span)),
                        pa.array(left, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col("doc_id"), F.col("text"))
    return rows.mapInArrow(run, _RESULT.format(id=rows.schema["doc_id"].dataType.simpleString()))


def longest(runs: str = "runs"):
    """The run with the most words; of equal ones the first, then the one with the smallest period. None: null."""
    ordered = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(ordered.isNotNull(), F.struct((-ordered["start"]).alias("start"), ordered["length"].alias("length"), (-ordered["period"]).alias("period")))
