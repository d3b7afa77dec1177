"""Near-duplicate documents by circulant MinHash.

A document is the set of its distinct word shingles (64-bit hashes). Two permutations, the second shifted circularly,
give all coordinates of its signature; bands of coordinates are bucket keys, and documents that share a bucket may be
linked. Every link is confirmed on the full sets. Documents with equal sets are one class from the start: only the
class's smallest document takes part in the search.

Inside a bucket not all pairs are compared. In a few rounds every class is compared with hubs of its buckets and the
linked classes are joined into components; the hubs change from round to round. Then only pairs of different
components of a bucket are left. Their signatures are compared in cells, two blocks of bounded size each, and the pairs
that agree enough are confirmed: one by one, or, in cells with many of them, through an index of the members' shingles.

With 32 bands of 5 coordinates a pair of similarity 0.8 is missed with a probability of 3 in a million, and of 7 in a
million by the comparison of signatures, whatever the size of its buckets.

Defined cases: a missing, empty or wordless text has no shingles and is linked with nothing. Links are links of sets of
shingles alone: rows with equal ids but different sets, and rows without an id, are linked only if their sets are. A
row without an id never names a component; in a component without any id the rows of one set are kept. Rows that are
equal in id and set are kept or dropped together. Further columns are kept by ``drop_copies`` and ignored by
``groups``; an empty table gives an empty result. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import append, field, fresh
from tidemark.llm.shingles import Circulant, band_keys, digest, shingle_sets
from tidemark.session import materialise

BANDS, ROWS = 32, 5
# A pair of similarity 0.8 agrees in 128 of 160 coordinates, standard deviation 5.
LEAST_AGREEMENT = 106
# Hashing a stretch of text takes some forty times its size in memory.
STRETCH = 1 << 20
# Members of a bucket whose signatures are compared with each other at a time.
BLOCK = 500
# Shingles that the members of a block hold together, about; a cell has two blocks.
BLOCK_SHINGLES = 200_000
# A cell with so many pairs per member is confirmed as a whole.
DENSE = 4


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_key, n (shingles), digest (of the set), bands and one byte of every coordinate; stored."""

    def make():
        circulant = Circulant(BANDS * ROWS)

        def signed(texts: pa.Array) -> list[pa.Array]:
            sizes, digests, bands, bytes_ = [], [], [], []
            for shingles in shingle_sets(texts.to_pylist(), words):
                sizes.append(len(shingles))
                digests.append(digest(shingles))
                signature = circulant.signature(shingles) if len(shingles) else None
                bands.append(None if signature is None else band_keys(signature, ROWS))
                bytes_.append(None if signature is None else (signature & 255).astype(np.uint8).tobytes())
            return [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(bytes_, pa.binary())]

        return signed

    fields = [field("n", "long"), field("digest", "binary"), field("bands", "array<long>"), field("signature", "binary")]
    rows = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"))
    return materialise(append(rows, make, fields, ["text"], STRETCH).drop("text"), "signatures")


def components(edges: DataFrame) -> DataFrame:
    """node and the smallest node of its component, for every node but the smallest. Edges have columns hi and lo.

    Large and small stars by turns: every node is hung on the smallest node around it, until nothing changes.
    """

    def state(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo") % 1_000_003)).first())

    current = materialise(edges.filter("hi > lo").distinct(), "edges")
    before = state(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("least"))
        large = both.join(least, "hi").filter("lo > hi").select(F.col("lo").alias("hi"), F.least("hi", "least").alias("lo"))
        smallest = large.groupBy("hi").agg(F.min("lo").alias("least"))
        small = large.join(smallest, "hi").select(F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("least").alias("lo")), F.struct("hi", F.col("least").alias("lo")))).alias("e")).select("e.*")
        current = materialise(small.filter("hi > lo").distinct(), "edges")
        after = state(current)
        if after == before:
            break
        before = after
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("component"))


def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in at least LEAST_AGREEMENT coordinates."""
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, BANDS * ROWS) for i in (2, 3))
        near = (left == right).sum(axis=1) >= LEAST_AGREEMENT
        yield batch.select([0, 1]).filter(pa.array(near))


def confirm(percent: int):
    """Pairs whose full sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for left, right in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(x.as_py(), np.uint64) for x in (left, right))
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return run


def labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("component", F.col("rep"))
    named = labels.withColumnRenamed("node", "rep")
    return members.join(named, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def hub_pairs(members: DataFrame, turn: int, most: int) -> DataFrame:
    """For each class up to ``most`` pairs with hubs of its buckets that are in other components: hi, lo."""
    place = F.xxhash64(F.lit(turn), "rep")
    hub = F.min(F.struct(place.alias("place"), F.col("rep").alias("hub"), F.col("n").alias("hub_n"), F.col("component").alias("hub_component"))).alias("h")
    hubs = members.groupBy("key").agg(hub, F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key", "h.*")
    met = members.join(hubs, "key").filter("component <> hub_component").filter(fitting("n", "hub_n"))
    # A class has one hub per band at most.
    some = met.groupBy("rep").agg(F.slice(F.sort_array(F.collect_set(F.struct("place", "hub"))), 1, most).alias("h"))
    some = some.select("rep", F.explode("h.hub").alias("hub"))
    return some.select(F.greatest("rep", "hub").alias("hi"), F.least("rep", "hub").alias("lo")).distinct()


def fitting(a: str, b: str):
    """Sizes that allow a similarity of 0.8."""
    return 100 * F.least(a, b) >= 80 * F.greatest(a, b)


def left_pairs(members: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs of different components that share a bucket and whose sizes and signatures allow a link: hi, lo, and no
    cell. Of cells with many such pairs the members instead: cell, hi (the class), lo (its component)."""
    counts = members.groupBy("key").agg(F.count_distinct("component").alias("held"), F.count("*").alias("size"), F.sum("n").alias("weight")).filter("held > 1")
    counts = materialise(counts, "open-buckets")
    open_ = members.join(counts, "key").join(reps.select("rep", "signature", "bands"), "rep")
    # Large buckets are cut into blocks, and every two blocks meet in a cell.
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.least(F.ceil(F.col("weight") / BLOCK_SHINGLES), F.col("size"))).cast("int")
    open_ = open_.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "rep"), blocks).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    cell = F.xxhash64("key", F.least("block", "with"), F.greatest("block", "with")).alias("cell")
    cells = open_.select(cell, "band", "rep", "n", "component", "signature", "bands", "block", (F.col("block") == F.col("with")).alias("alone"))
    return cells.groupBy("cell").applyInArrow(met_in_cell, "cell long, hi long, lo long").distinct()


def met_in_cell(table: pa.Table) -> pa.Table:
    """Pairs of one cell. A pair that shares several buckets is taken from that of the first shared band only; bands are
    shared if their whole keys are equal, as in buckets (the signature has one byte of every coordinate)."""
    band, rep, n, component, block, alone = (table[c].to_numpy() for c in ("band", "rep", "n", "component", "block", "alone"))
    signature = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
    bands = pc.list_flatten(table["bands"]).to_numpy().reshape(-1, BANDS)
    out = [np.zeros((0, 2), np.int64)]
    for a in range(len(rep) - 1):
        others = np.arange(a + 1, len(rep))
        sizes = n[others]
        good = (component[others] != component[a]) & (100 * np.minimum(sizes, n[a]) >= 80 * np.maximum(sizes, n[a]))
        good &= alone[a] | (block[others] != block[a])
        others = others[good]
        if not len(others):
            continue
        others = others[(signature[others] == signature[a]).sum(axis=1) >= LEAST_AGREEMENT]
        if band[a] >= 0:
            others = others[(bands[others] == bands[a]).argmax(axis=1) == band[a]]
        out.append(np.stack([np.maximum(rep[others], rep[a]), np.minimum(rep[others], rep[a])], axis=1))
    pairs = np.concatenate(out)
    if len(rep) > 50 and len(pairs) > DENSE * len(rep):
        return pa.table({"cell": table["cell"], "hi": pa.array(rep), "lo": pa.array(component)})
    return pa.table({"cell": pa.nulls(len(pairs), pa.int64()), "hi": pa.array(pairs[:, 0]), "lo": pa.array(pairs[:, 1])})


def links_in_cell(percent: int):
    """Links between different components among a cell's members, counted through an index of their shingles."""

    def run(table: pa.Table) -> pa.Table:
        rep, component = table["rep"].to_numpy(), table["component"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        sizes = np.array([len(x) for x in sets])
        every, number = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(number, kind="stable")
        holders = owner[order]
        begin = np.searchsorted(number[order], np.arange(len(every) + 1))
        first = np.cumsum(sizes) - sizes
        out = [np.zeros((0, 2), np.int64)]
        for a in range(len(rep)):
            if not (component != component[a]).any():
                break
            own = number[first[a] : first[a] + sizes[a]]
            both = np.zeros(len(rep), np.int64)
            for shingle in own.tolist():
                both[holders[begin[shingle] : begin[shingle + 1]]] += 1
            good = (component != component[a]) & (100 * both >= percent * (sizes + sizes[a] - both))
            # One link to each other component is enough; they are one component from here on.
            for b in np.flatnonzero(good).tolist():
                if component[b] != component[a]:
                    out.append(np.array([[max(rep[a], rep[b]), min(rep[a], rep[b])]], np.int64))
                    component = np.where(component == component[b], component[a], component)
        pairs = np.concatenate(out)
        return pa.table({"hi": pa.array(pairs[:, 0]), "lo": pa.array(pairs[:, 1])})

    return run


def classes_of(signed: DataFrame) -> DataFrame:
    """digest, least (the smallest doc_id with that set) and rep, the class's number: least, unless there is none or
    several classes share it; then a hash of the digest."""
    classes = signed.filter("n > 0").groupBy("digest").agg(F.min("doc_id").alias("least"))
    repeated = classes.groupBy("least").agg(F.count("*").alias("classes")).filter("classes > 1 AND least IS NOT NULL").select(F.col("least").alias("again"))
    marked = classes.join(repeated, F.col("least") == F.col("again"), "left")
    own = F.when(F.col("least").isNotNull() & F.col("again").isNull(), F.col("least")).otherwise(F.xxhash64("digest"))
    return marked.select("digest", "least", own.alias("rep"))


def placed(docs: DataFrame, words: int, percent: int, hubs: tuple[int, ...]) -> DataFrame:
    """Per row: doc_id, text_key, n_shingles, component_id and kept."""
    if percent < 80:
        raise ValueError(f"percent is {percent}; the search finds links of 80 percent and more only")
    signed = signatures(docs, words)
    classes = materialise(classes_of(signed), "classes")
    reps = signed.filter("n > 0").join(classes, "digest").filter("doc_id <=> least").dropDuplicates(["digest"])
    reps = materialise(reps.select("rep", F.coalesce("doc_id", F.lit(0)).alias("id"), "text_key", "n", "bands", "signature"), "reps")

    members = reps.select(F.posexplode("bands").alias("band", "key"), "rep", "n")
    shared = members.groupBy("key").agg(F.count("*").alias("held")).filter("held > 1").select("key")
    members = materialise(members.join(shared, "key"), "members")
    wanted = reps.join(members.select("rep").distinct(), "rep").select("rep", "id", "text_key")

    def make():
        return lambda texts: [pa.array([s.tobytes() for s in shingle_sets(texts.to_pylist(), words)], pa.binary())]

    rows = docs.select("text", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.xxhash64("text").alias("text_key"))
    nodes = rows.join(wanted, ["id", "text_key"]).dropDuplicates(["id", "text_key"]).select("text", F.col("rep").alias("node"))
    sets = materialise(append(nodes, make, [field("shingles", "binary")], ["text"], STRETCH).select("node", "shingles"), "sets")

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs whose sets are similar enough."""
        left, right = (reps.select(F.col("rep").alias(c), F.col("signature").alias(f"s_{c}")) for c in ("hi", "lo"))
        near = pairs.join(left, "hi").join(right, "lo").select("hi", "lo", "s_hi", "s_lo").mapInArrow(similar, "hi long, lo long").distinct()
        left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"x_{c}")) for c in ("hi", "lo"))
        return near.join(left, "hi").join(right, "lo").select("hi", "lo", "x_hi", "x_lo").mapInArrow(confirm(percent), "hi long, lo long")

    labels = edges = None
    for turn, most in enumerate(hubs):
        found = linked(hub_pairs(labelled(members, labels), turn, most))
        edges = materialise(found if edges is None else edges.unionByName(found), "links")
        labels = components(edges)
        edges = labels.select(F.col("node").alias("hi"), F.col("component").alias("lo"))
    left = materialise(left_pairs(labelled(members, labels), reps), "left")
    dense = left.filter("cell IS NOT NULL").select("cell", F.col("hi").alias("rep"), F.col("lo").alias("component"))
    held = dense.join(sets.withColumnRenamed("node", "rep"), "rep").groupBy("cell").applyInArrow(links_in_cell(percent), "hi long, lo long")
    rest = linked(left.filter("cell IS NULL").select("hi", "lo")).unionByName(held.filter("hi > lo").distinct())
    rest = materialise(rest, "links")
    if not rest.isEmpty():
        labels = components(edges.unionByName(rest))

    named = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    if classes.filter("NOT rep <=> least").isEmpty():
        named = named.select("digest", "rep", "component", F.col("component").alias("first"))
    else:
        # Some classes have numbers that are no ids: look for the smallest id of every component.
        named = materialise(named, "named")
        first = named.groupBy("component").agg(F.min("least").alias("first"))
        named = named.join(first, "component").select("digest", "rep", "component", "first")
    found = signed.select("doc_id", "text_key", "n", "digest").join(materialise(named, "placed"), "digest", "left")
    wordless = F.col("n") == 0
    kept = F.when(wordless, True).when(F.col("first").isNull(), F.col("rep") == F.col("component")).otherwise(F.col("doc_id").eqNullSafe(F.col("first")))
    return found.select("doc_id", "text_key", F.col("n").alias("n_shingles"), F.when(wordless, F.col("doc_id")).otherwise(F.col("first")).alias("component_id"), kept.alias("kept"))


def groups(docs: DataFrame, words: int = 5, percent: int = 80, hubs: tuple[int, ...] = (1, 8, 8)) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id linked through any chain), kept.

    Bands, sizes and the least agreement of signatures are set for a similarity of 0.8; links below that would be lost.
    """
    return placed(docs, words, percent, hubs).select("doc_id", "n_shingles", "component_id", "kept")


def drop_copies(docs: DataFrame, words: int = 5, percent: int = 80, hubs: tuple[int, ...] = (1, 8, 8)) -> DataFrame:
    """The documents with their own columns, one of each group: that with the smallest id. Documents without an id stay
    if they are linked to none that has one."""
    key, text = fresh(docs, "kept_id", "kept_text")
    kept = placed(docs, words, percent, hubs).filter("kept").select(F.coalesce("doc_id", F.lit(0)).alias(key), F.col("text_key").alias(text)).distinct()
    same = (F.coalesce(F.col("doc_id").cast("long"), F.lit(0)) == F.col(key)) & (F.xxhash64("text") == F.col(text))
    return docs.join(kept, same, "left_semi")
