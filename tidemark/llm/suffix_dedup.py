"""Removal of byte strings that occurred before, over all documents.

Every byte covered by a ``length``-byte string that also starts earlier (in a document with a smaller id, or earlier in
the same one) is removed. Strings are judged on the input.

1. Equal texts are reduced to the one with the smallest id (in each task before the shuffle, then overall); all later
   copies of at least ``length`` bytes are removed whole.
2. Each string has a value: the smallest hash of its GRAM-byte stretches. Equal strings have equal values, and strings
   that start next to each other mostly share theirs, so a text is a list of runs of starts. Only the values travel, once
   per part of the texts, to find those that occur in more than one run (or twice within one).
3. The stretches of text under such runs go to tasks by value. A task sorts the suffixes that begin its strings in two
   stages, compares neighbours for common prefixes of ``length`` bytes, and keeps the earliest of each set of equals.
   Values of more than ``hot`` runs are dealt by the hash of each single string instead, after equals within a
   part have been reduced to their earliest, so that a frequent passage does not meet in one task.
4. The removed stretches meet their texts again, which are stored in buckets by part and do not move.

Defined cases: missing texts are empty; rows without an id come after all others; rows with equal ids are ordered by a
digest of their texts, and rows with equal id and text do not remove each other; further columns are ignored; an empty
table gives an empty result. Ids are integers.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import append, field
from tidemark.llm.shingles import Stretches
from tidemark.llm.suffixes import common_prefixes, sorted_suffixes
from tidemark.session import materialise, scratch_path, shuffle_width

GRAM = 24
PART_BYTES = 16 << 20
# Groups of values per part, so that the suffixes sorted at a time are a few megabytes.
GROUPS = 8
NO_ID = (1 << 63) - 1
_META = np.dtype([("tid", "<i8"), ("node", "<i8"), ("start", "<i4"), ("windows", "<i4"), ("bytes", "<i4"), ("part", "<i4")])
_SPAN = np.dtype([("tid", "<i8"), ("start", "<i4"), ("end", "<i4")])


def packed(held: bytes) -> bytes:
    return len(held).to_bytes(8, "little") + pa.compress(held, codec="zstd", asbytes=True)


def unpacked(held: bytes) -> bytes:
    return pa.decompress(held[8:], decompressed_size=int.from_bytes(held[:8], "little"), codec="zstd", asbytes=True)


def smallest_ahead(values: np.ndarray, count: int) -> np.ndarray:
    """The smallest of each ``count`` neighbouring values."""
    width, out = 1, values
    while 2 * width <= count:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    rest = count - width
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


class Runs:
    """Runs of string starts with equal values in texts joined to one buffer."""

    def __init__(self, texts: list[bytes], length: int) -> None:
        self.held = b"".join(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        begins = np.cumsum(sizes) - sizes
        n = len(self.held) - length + 1
        empty = np.zeros(0, np.int64)
        self.text, self.start, self.end, self.value, self.twice = empty, empty, empty, np.zeros(0, np.uint64), np.zeros(0, bool)
        if n <= 0:
            return
        gram = min(GRAM, length)
        at = np.arange(len(self.held) - gram + 1)
        self.hashes = Stretches(self.held)
        grams = self.hashes.hashes(at, at + gram)
        per_string = length - gram + 1
        value = smallest_ahead(grams, per_string)
        inside = np.zeros(n + 1, np.int64)
        full = sizes >= length
        np.add.at(inside, begins[full], 1)
        np.add.at(inside, begins[full] + sizes[full] - length + 1, -1)
        good = np.cumsum(inside[:n]) > 0
        change = np.ones(n, bool)
        change[1:] = (value[1:] != value[:-1]) | (good[1:] != good[:-1])
        change[begins[full & (begins < n)]] = True
        first = np.flatnonzero(change)
        last = np.concatenate([first[1:], [n]]) - 1
        kept = good[first]
        first, last = first[kept], last[kept]
        self.value = value[first]
        self.text = np.searchsorted(begins, first, "right") - 1
        self.offset = begins
        self.start, self.end = first, last
        # Where the value is found first in the run's first string and last in its last one.
        low, high = np.full(len(first), -1, np.int64), np.full(len(first), -1, np.int64)
        for step in range(per_string):
            new = (low < 0) & (grams[first + step] == self.value)
            low[new] = first[new] + step
            new = grams[last + step] == self.value
            high[new] = last[new] + step
        self.twice = low != high

    @property
    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct values with their number of occurrences, two at least where strings may repeat inside a run."""
        values, back, counts = np.unique(self.value, return_inverse=True, return_counts=True)
        np.add.at(counts, back[self.twice], 1)
        return values, counts


def cuts(table: pa.Table, limit: int = 1 << 20) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """tid, node and text of a part's rows, about a megabyte of text at a time."""
    tids, nodes, texts, size = [], [], [], 0
    for tid, node, text in zip(table["tid"].to_pylist(), table["node"].to_pylist(), table["packed"]):
        held = unpacked(text.as_py())
        if texts and size + len(held) > limit:
            yield tids, nodes, texts
            tids, nodes, texts, size = [], [], [], 0
        tids.append(tid)
        nodes.append(node)
        texts.append(held)
        size += len(held)
    if texts:
        yield tids, nodes, texts


def first_texts(docs: DataFrame, length: int) -> tuple[DataFrame, str, int]:
    """Rows (doc_id, node, digest, n_bytes), the name of a table of the distinct texts in buckets by part, the number of parts."""
    spark = docs.sparkSession
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(shuffle_width(spark), -(-total // PART_BYTES))
    # Spark has a limit on buckets; beyond it a bucket holds several parts.
    buckets = min(parts, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))

    def digest(text: pa.StringScalar) -> tuple[bytes, bytes]:
        held = (text.as_py() or "").encode("utf-8", "surrogatepass")
        return hashlib.blake2b(held, digest_size=16).digest(), held

    def make_rows():
        def described(texts: pa.Array) -> list[pa.Array]:
            made = [(own, len(held)) for own, held in map(digest, texts)]
            return [pa.array([own for own, _ in made], pa.binary()), pa.array([n for _, n in made], pa.int64())]

        return described

    def make_bodies():
        least: dict[bytes, int] = {}

        def described(texts: pa.Array, nodes: pa.Array) -> list[pa.Array]:
            digests, sizes, bodies, told = [], [], [], []
            for text, node in zip(texts, nodes.to_pylist()):
                own, held = digest(text)
                digests.append(own)
                sizes.append(len(held))
                bodies.append(None if own in least else packed(held))
                told.append(own not in least or node < least[own])
                least[own] = min(node, least.get(own, node))
            return [pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bodies, pa.binary()), pa.array(told, pa.bool_())]

        return described

    fields = [field("digest", "binary"), field("n_bytes", "long")]
    ids = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"))
    ids = ids.withColumn("node", F.coalesce("doc_id", F.lit(NO_ID)))
    rows = append(ids, make_rows, fields, ["text"]).drop("text")
    full = append(ids, make_bodies, [*fields, field("packed", "binary"), field("told", "boolean")], ["text", "node"])
    # Only the first text of a task is sent along; of its copies there only those with a smaller id than all before, so
    # that the copies of a frequent text do not meet in one task.
    full = full.filter("told").select("digest", "n_bytes", "packed", "node", F.pmod(F.xxhash64("digest"), F.lit(parts)).cast("int").alias("part"))
    firsts = full.repartition(buckets, "part").groupBy("part", "digest").agg(F.min("node").alias("node"), F.first("packed", ignorenulls=True).alias("packed"), F.max("n_bytes").alias("n_bytes"))
    firsts = firsts.withColumn("tid", F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long"))
    name = "texts_" + uuid.uuid4().hex
    firsts.write.bucketBy(buckets, "part").option("path", scratch_path(spark, "texts")).option("compression", "none").format("parquet").saveAsTable(name)
    return rows, name, parts


def value_counts(texts: DataFrame, parts: int, length: int, hot: int) -> DataFrame:
    """Per part the values of its runs that occur more than once, and which of them are hot: part, values, hot_values."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for part in table["part"].unique().to_pylist():
                for _, _, held in cuts(table.filter(pc.equal(table["part"], part))):
                    values, counts = Runs(held, length).repeated
                    place = (values % np.uint64(parts)).astype(np.int64)
                    order = np.argsort(place, kind="stable")
                    bounds = np.searchsorted(place[order], np.arange(parts + 1))
                    filled = np.flatnonzero(np.diff(bounds)).tolist()
                    chosen = [order[bounds[p] : bounds[p + 1]] for p in filled]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * len(filled), pa.int32()), pa.array(filled, pa.int32()), pa.array([values[c].tobytes() for c in chosen], pa.binary()), pa.array([counts[c].astype("<u4").tobytes() for c in chosen], pa.binary())],
                        names=["part", "place", "vals", "counts"],
                    )

    def found(table: pa.Table) -> pa.Table:
        held = [np.frombuffer(v, np.uint64) for v in table["vals"].to_pylist()]
        counts = [np.frombuffer(c, "<u4") for c in table["counts"].to_pylist()]
        values, back = np.unique(np.concatenate(held), return_inverse=True)
        total = np.bincount(back, np.concatenate(counts))
        stops = np.cumsum([0, *map(len, held)])
        out: dict[int, list[np.ndarray]] = {}
        for part, own, a, b in zip(table["part"].to_pylist(), held, stops, stops[1:]):
            out.setdefault(part, []).append(np.stack([own, total[back[a:b]].astype(np.uint64)])[:, total[back[a:b]] > 1])
        kept = {part: np.unique(np.concatenate(x, axis=1), axis=1) for part, x in out.items()}
        kept = {part: x for part, x in kept.items() if x.shape[1]}
        return pa.table({
            "part": pa.array(list(kept), pa.int32()), "vals": pa.array([x[0].tobytes() for x in kept.values()], pa.binary()),
            "hot_vals": pa.array([x[0][x[1] > hot].tobytes() for x in kept.values()], pa.binary()),
        })

    sent = texts.select("part", "tid", "node", "packed").mapInArrow(listed, "part int, place int, vals binary, counts binary")
    return sent.groupBy("place").applyInArrow(found, "part int, vals binary, hot_vals binary")


def spans_of(meta: np.ndarray, segment: np.ndarray, offset: np.ndarray, length: int) -> dict[int, bytes]:
    """Per part the byte stretches covered by the removed strings (segment number, start within it)."""
    start = meta["start"][segment] + offset
    order = np.lexsort((start, segment))
    segment, start = segment[order], start[order]
    new = np.ones(len(start), bool)
    new[1:] = (segment[1:] != segment[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(start)]])[: len(first)] - 1
    spans = np.zeros(len(first), _SPAN)
    spans["tid"], spans["start"], spans["end"] = meta["tid"][segment[first]], start[first], start[last] + length
    parts = meta["part"][segment[first]]
    return {int(p): spans[parts == p].tobytes() for p in np.unique(parts)}


def segments(texts: DataFrame, values: DataFrame, places: int, length: int) -> DataFrame:
    """The stretches of text under repeated values: place, meta, body. Removals already certain: place -1, part, body."""

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            part = left["part"][0].as_py()
            wanted = np.unique(np.concatenate([np.frombuffer(v, np.uint64) for v in right["vals"].to_pylist()]))
            hot = np.unique(np.concatenate([np.frombuffer(v, np.uint64) for v in right["hot_vals"].to_pylist()]))
            earliest: dict[int, tuple] = {}
            metas, bodies, groups = [], [], []
            certain: list[np.ndarray] = []
            for tids, nodes, held in cuts(left):
                runs = Runs(held, length)
                chosen = np.flatnonzero(np.isin(runs.value, wanted))
                burning = np.isin(runs.value[chosen], hot)
                meta = np.zeros(len(chosen), _META)
                if not len(chosen):
                    continue
                meta["tid"], meta["node"] = np.array(tids)[runs.text[chosen]], np.array(nodes)[runs.text[chosen]]
                meta["start"] = runs.start[chosen] - runs.offset[runs.text[chosen]]
                meta["windows"] = runs.end[chosen] - runs.start[chosen] + 1
                meta["bytes"], meta["part"] = meta["windows"] + length - 1, part
                cool = ~burning
                metas.append(meta[cool])
                groups.append((runs.value[chosen][cool] % np.uint64(places)).astype(np.int64))
                bodies += [runs.held[a : a + n] for a, n in zip(runs.start[chosen][cool].tolist(), meta["bytes"][cool].tolist())]
                # Single strings of hot values: the earliest of equals in this part goes on, the others are removed.
                single = np.repeat(np.flatnonzero(burning), meta["windows"][burning])
                within = np.arange(len(single)) - np.repeat(np.cumsum(meta["windows"][burning]) - meta["windows"][burning], meta["windows"][burning])
                where = runs.start[chosen][single] + within
                for code, row, offset, at in zip(runs.hashes.hashes(where, where + length).tolist() if len(where) else [], single.tolist(), within.tolist(), where.tolist()):
                    own = (int(meta["node"][row]), int(meta["tid"][row]), int(meta["start"][row]) + offset)
                    body = runs.held[at : at + length]
                    old = earliest.get((code, body))
                    if old is not None:
                        lost, own = max(old, own), min(old, own)
                        certain.append(np.array([(lost[1], lost[2], lost[2] + length)], _SPAN))
                    earliest[(code, body)] = own
            if earliest:
                meta = np.zeros(len(earliest), _META)
                meta["node"], meta["tid"], meta["start"] = (np.array(x) for x in zip(*earliest.values()))
                meta["windows"], meta["bytes"], meta["part"] = 1, length, part
                metas.append(meta)
                groups.append(np.array([code % places for code, _ in earliest], np.int64))
                bodies += [body for _, body in earliest]
            if certain:
                out.append((-1, part, b"", np.concatenate(certain).tobytes()))
            if metas:
                meta, place = np.concatenate(metas), np.concatenate(groups)
                for p in np.unique(place).tolist():
                    own = np.flatnonzero(place == p)
                    out.append((p, part, meta[own].tobytes(), packed(b"".join(bodies[i] for i in own.tolist()))))
        columns = list(zip(*out)) if out else [()] * 4
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["place", "part", "meta", "body"])

    grouped = texts.select("part", "tid", "node", "packed").groupBy("part")
    return grouped.cogroup(values.groupBy("part")).applyInArrow(cut, "place int, part int, meta binary, body binary")


def repeats(meta: np.ndarray, held: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment number and offset of every string that has an earlier equal among the segments."""
    body = np.frombuffer(held + bytes(length + 16), np.uint8)
    begins = np.cumsum(meta["bytes"], dtype=np.int64) - meta["bytes"]
    windows = meta["windows"].astype(np.int64)
    segment = np.repeat(np.arange(len(meta)), windows)
    offset = np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows)
    wanted = begins[segment] + offset
    order = sorted_suffixes(body, wanted, length)
    same = common_prefixes(body, order, length)
    # Place of each string in the order of documents.
    number = np.zeros(len(body), np.int64)
    number[wanted] = np.arange(len(wanted))
    rank = np.empty(len(wanted), np.int64)
    rank[np.lexsort((meta["start"][segment] + offset, meta["tid"][segment], meta["node"][segment]))] = np.arange(len(wanted))
    which = number[order]
    group = np.flatnonzero(~same)
    first = np.minimum.reduceat(rank[which], group) if len(group) else np.zeros(0, np.int64)
    lost = which[rank[which] != np.repeat(first, np.diff(np.concatenate([group, [len(which)]])))]
    return segment[lost], offset[lost]


def removals(found: DataFrame, length: int) -> DataFrame:
    """Per part the stretches to remove: part, spans."""

    def judged(table: pa.Table) -> pa.Table:
        metas = [np.frombuffer(m, _META) for m in table["meta"].to_pylist()]
        meta = np.concatenate(metas)
        spans = spans_of(meta, *repeats(meta, b"".join(unpacked(b) for b in table["body"].to_pylist()), length), length)
        return pa.table([pa.array(list(spans), pa.int32()), pa.array(list(spans.values()), pa.binary())], names=["part", "spans"])

    sorted_ = found.filter("place >= 0").groupBy("place").applyInArrow(judged, "part int, spans binary")
    return sorted_.unionByName(found.filter("place < 0").select("part", F.col("body").alias("spans")))


def apply_removals(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """Per distinct text: digest, node, n_bytes, n_removed, n_spans, kept (the remaining bytes, packed) and kept_sha256."""

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        lost = np.sort(np.concatenate([np.zeros(0, _SPAN), *(np.frombuffer(s, _SPAN) for s in right["spans"].to_pylist())]), order=["tid", "start"])
        for row in left.select(["digest", "node", "tid", "packed"]).to_pylist():
            held = unpacked(row["packed"])
            own = lost[np.searchsorted(lost["tid"], row["tid"]) : np.searchsorted(lost["tid"], row["tid"], "right")]
            kept, at, removed, count, end = [], 0, 0, 0, -1
            for start, stop in zip(own["start"].tolist(), own["end"].tolist()):
                if start > end:
                    kept.append(held[at:start])
                    count, removed, end, at = count + 1, removed + stop - start, stop, stop
                elif stop > end:
                    removed, end, at = removed + stop - end, stop, stop
            kept.append(held[at:])
            rest = b"".join(kept)
            out.append((row["digest"], row["node"], len(held), removed, count, rest, hashlib.sha256(rest).hexdigest()))
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
        columns = list(zip(*out)) if out else [()] * 7
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["digest", "first", "size", "n_removed", "n_spans", "kept", "kept_sha256"])

    left = texts.select("part", "digest", "node", "tid", "packed").groupBy("part")
    return left.cogroup(spans.groupBy("part")).applyInArrow(cut, "digest binary, first long, size long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def deduplicate(docs: DataFrame, length: int = 100, hot: int = 5_000, with_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (runs of removed bytes), kept_sha256, and kept (bytes) if asked for."""
    rows, name, parts = first_texts(docs, length)
    texts = docs.sparkSession.table(name)
    values = value_counts(texts, parts, length, hot)
    found = materialise(segments(texts, values, parts * GROUPS, length), "segments")
    spans = materialise(removals(found, length), "removals")
    done = apply_removals(texts, spans)
    done = materialise(done if with_text else done.drop("kept"), "kept")
    docs.sparkSession.sql(f"DROP TABLE {name}")
    joined = rows.join(done, "digest")
    copy = (F.col("node") != F.col("first")) & (F.col("n_bytes") >= length)
    columns = [
        "doc_id", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    ]
    if with_text:
        columns.append(F.when(copy, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"))
    return joined.select(*columns)
