"""Benchmark passages in documents, found by Wu-Manber search for many strings at once.

A text's words (runs of letters beyond ASCII punctuation, A-Z lowered) are joined by single blanks. Every window of
``n`` consecutive words of a benchmark item, with a blank on either side, is a search string; an item with fewer words
is one string. Strings are searched in classes of similar length. The search looks at the last bytes (a block) of a
stretch as long as the shortest string of the class: a table says how far it may move on from that block; where the
move is zero, the bucket of the block's hash names the strings that can end there, and they are compared byte by byte.
A task moves thousands of such positions forward together, each through its own part of the joined texts.

Benchmark texts reach the tasks in blocks of at most ``block_bytes``; each block is searched in all documents, and
what the blocks before it found is carried along.

Defined cases: missing or wordless texts have no words, no hits and no items; a missing item id makes no item; repeated
rows are worked on each by itself; equal windows of several items count for all of them; further columns are kept by
``scan`` (but for names beginning with two underscores) and ``clean`` and ignored by ``report``; empty tables give no hits or no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import append, computed, field, fresh
from tidemark.session import materialise

# Bytes as the search sees them: A-Z lowered, every other ASCII character that is not a letter or digit a blank.
FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
SPANS, ITEMS, WORDS = "__hit_spans", "__hit_items", "__hit_words"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLDED).split()


def windows(words: list[bytes], n: int) -> Iterator[bytes]:
    for at in range(max(1, len(words) - n + 1) if words else 0):
        yield b" " + b" ".join(words[at : at + n]) + b" "


def eights(held: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as one number; ``held`` ends with at least eight spare bytes."""
    return np.ndarray((len(held) - 7,), "<u8", held, strides=(1,))


class Strings:
    """Tables of the search strings of one length class."""

    BITS = 18

    def __init__(self, strings: list[bytes]) -> None:
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.held = np.frombuffer(b"".join(strings) + bytes(16), np.uint8)
        self.shortest = int(self.lengths.min())
        self.block = min(8, self.shortest)
        self.mask = np.uint64((1 << (8 * self.block)) - 1)
        self.moves = np.full(1 << self.BITS, self.shortest - self.block + 1, np.int64)
        words = eights(self.held)
        for end in range(self.block, self.shortest + 1):  # later blocks allow shorter moves only
            last = self.hashed(words[self.starts + end - self.block])
            self.moves[last] = self.shortest - end
        self.order = np.argsort(last, kind="stable")
        self.bucket = np.concatenate([[0], np.cumsum(np.bincount(last, minlength=1 << self.BITS))])

    def hashed(self, blocks: np.ndarray) -> np.ndarray:
        return (((blocks & self.mask) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def occurrences(self, held: np.ndarray, part: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``held`` (16 spare bytes at its end) and numbers of the strings that occur there."""
        words = eights(held)
        last = len(held) - 16 - self.shortest
        at = np.arange(0, last + 1, part)
        ends = np.minimum(at + part, last + 1)
        tail = self.shortest - self.block
        found, keys = [], []
        while len(at):
            hashes = self.hashed(words[at + tail])
            moves = self.moves[hashes]
            stop = moves == 0
            if stop.any():
                found.append(at[stop])
                keys.append(hashes[stop])
            at = at + np.maximum(moves, 1)
            going = at < ends
            if not going.all():
                at, ends = at[going], ends[going]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, key = np.concatenate(found), np.concatenate(keys)
        count = self.bucket[key + 1] - self.bucket[key]
        first = np.repeat(self.bucket[key] - np.cumsum(count) + count, count)
        string = self.order[first + np.arange(len(first))]
        at = np.repeat(at, count)
        fits = at + self.lengths[string] <= len(held) - 16
        return self.compared(words, at[fits], string[fits])

    def compared(self, words: np.ndarray, at: np.ndarray, string: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = eights(self.held)
        done = 0
        longest = int(self.lengths.max())
        while done < longest and len(at):
            left = self.lengths[string] - done
            # The last eight bytes overlap those before; strings under eight bytes are masked.
            offset = np.where(left >= 8, done, np.maximum(self.lengths[string] - 8, 0))
            bits = np.where(self.lengths[string] >= 8, 64, 8 * self.lengths[string]).astype(np.uint64)
            mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - bits)
            same = ((words[at + offset] ^ own[self.starts[string] + offset]) & mask) == 0
            at, string = at[same], string[same]
            done += 8
        return at, string


class Search:
    """Search for the windows of one block of benchmark items."""

    def __init__(self, items: list[tuple[str, str]], n: int) -> None:
        owners: dict[bytes, set[int]] = {}
        names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(names)}
        for name, text in items:
            for window in windows(words_of(text), n):
                owners.setdefault(window, set()).add(number[name])
        self.names = names
        self.classes: list[tuple[Strings, list[list[int]]]] = []
        for low, high in ((1, 8), (8, 16), (16, 32), (32, 1 << 60)):
            strings = sorted(w for w in owners if low <= len(w) < high)
            if strings:
                self.classes.append((Strings(strings), [sorted(owners[w]) for w in strings]))

    def __call__(self, texts: pa.Array, spans: list | None = None, items: list | None = None) -> list[pa.Array]:
        split = [words_of(t) for t in texts.to_pylist()]
        rows = [b" " + b" ".join(w) + b" " for w in split]
        held = np.frombuffer(b"\0".join(rows) + bytes(17), np.uint8)
        begins = np.concatenate([[0], np.cumsum([len(r) + 1 for r in rows])])[:-1].astype(np.int64)
        blanks = np.flatnonzero(held == 32)
        first_blank = np.searchsorted(blanks, begins)
        change = np.zeros(len(blanks) + 1, np.int64)
        names: list[set[str]] = [set(x or ()) for x in items] if items else [set() for _ in rows]
        for row, old in enumerate(spans or ()):
            if old:
                np.add.at(change, first_blank[row] + np.array(old[::2]), 1)
                np.add.at(change, first_blank[row] + np.array(old[1::2]), -1)
        for strings, owners in self.classes:
            at, string = strings.occurrences(held)
            if not len(at):
                continue
            np.add.at(change, np.searchsorted(blanks, at), 1)
            np.add.at(change, np.searchsorted(blanks, at + strings.lengths[string] - 1), -1)
            pairs = np.unique((np.searchsorted(begins, at, "right") - 1) * len(owners) + string)
            for pair in pairs.tolist():
                names[pair // len(owners)].update(self.names[i] for i in owners[pair % len(owners)])
        hit = np.concatenate([[0], np.cumsum(change[:-1]) > 0, [0]]).astype(np.int8)
        edges = np.flatnonzero(np.diff(hit))  # begins and ends of runs of hit words, as numbers of blanks
        row_of = np.searchsorted(first_blank, edges[::2], "right") - 1
        runs: list[list[int]] = [[] for _ in rows]
        for row, a, b in zip(row_of.tolist(), edges[::2].tolist(), edges[1::2].tolist()):
            runs[row] += [a - int(first_blank[row]), b - int(first_blank[row])]
        return [
            pa.array([len(w) for w in split], pa.int64()),
            pa.array(runs, pa.list_(pa.int32())),
            pa.array([sorted(x) for x in names], pa.list_(pa.string())),
        ]


def blocks(benchmark: DataFrame, block_bytes: int, item: str, text: str) -> Iterator[list[tuple[str, str]]]:
    """The items with id and text in lists of bounded size; partitions come to the driver one at a time."""
    held, size = [], 0
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).dropna()
    for row in rows.toLocalIterator():
        if held and size + len(row.text) > block_bytes:
            yield held
            held, size = [], 0
        held.append((row.item, row.text))
        size += len(row.text)
    yield held


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, block_bytes: int = 4 << 20, item: str = "item_id", text: str = "text") -> DataFrame:
    """All rows and columns of the documents with the number of words, the hit runs of words, and the items found."""
    fields = [field(WORDS, "long"), field(SPANS, "array<int>"), field(ITEMS, "array<string>")]
    context = docs.sparkSession.sparkContext
    out, columns, carried = docs, docs.columns, False
    for block in blocks(benchmark, block_bytes, item, text):
        tables = context.broadcast(Search(block, n))
        if not carried:
            out = append(out, _first(tables), fields, [text])
        else:
            renamed = materialise(out, "hits").withColumnsRenamed({SPANS: "__spans_before", ITEMS: "__items_before"}).drop(WORDS)
            out = append(renamed, _next(tables), fields, [text, "__spans_before", "__items_before"])
            out = out.select(*(F.col(f"`{c}`") for c in columns), WORDS, SPANS, ITEMS)
        carried = True
    return out


def _first(tables) -> Callable:
    return lambda: tables.value


def _next(tables) -> Callable:
    return lambda: lambda texts, spans, items: tables.value(texts, spans.to_pylist(), items.to_pylist())


def report(docs: DataFrame, benchmark: DataFrame, n: int = 10, key: str = "doc_id", **options) -> DataFrame:
    """Per document: words, words inside occurrences, items with occurrences, and whether there is any."""
    text = options.get("text", "text")
    found = scan(docs.select(F.col(key).alias("doc_id"), F.col(text).alias(text)), benchmark, n, **options)
    pairs = F.col(SPANS)
    hit = F.aggregate(F.sequence(F.lit(0), F.size(pairs) - 1, F.lit(2)), F.lit(0).cast("long"), lambda sum_, i: sum_ + pairs[i + 1] - pairs[i])
    n_hit = F.when(F.size(pairs) > 0, hit).otherwise(F.lit(0).cast("long"))
    listed = F.concat_ws(",", F.sort_array(ITEMS))
    return found.select(
        F.col("doc_id").alias(key), F.col(WORDS).alias("n_words"), n_hit.alias("n_hit"), F.size(ITEMS).cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"), (F.size(pairs) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, n: int = 10, block_bytes: int = 4 << 20, item: str = "item_id", text: str = "text") -> DataFrame:
    """The documents without any occurrence, with their own columns only; they may have any names.

    Every block of the benchmark removes its documents; the next one reads only what is left.
    """
    context = docs.sparkSession.sparkContext
    out = docs
    (name,) = fresh(docs, "hit")
    for number, block in enumerate(blocks(benchmark, block_bytes, item, text)):
        tables = context.broadcast(Search(block, n))
        held = materialise(out, "clean") if number else out
        out = held.withColumn(name, computed(_hit(tables), "boolean", [F.col(text)])).filter(~F.col(name)).drop(name)
    return out


def _hit(tables) -> Callable:
    return lambda: lambda texts: pa.array([len(spans) > 0 for spans in tables.value(texts)[1].to_pylist()], pa.bool_())
