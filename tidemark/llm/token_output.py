"""Token ids in ORC files.

``write_tokens`` sorts the documents by id into ranges, encodes each text and writes one ORC file per range with the
columns doc_id, local_start (ids before the document in its file), n_tokens and ids. ORC stores the integers in
run-length encoding, cuts files into stripes that tasks read side by side, and keeps for every row group of a stripe
minima, maxima and Bloom filters of doc_id, so that a reader of few documents skips the rest. A small table of parts
holds the first document, the number of ids and the ids before it of every file; ``read_tokens`` joins it to give each
document's place in the whole sequence.

Defined cases: a missing text is empty and has the end id only; documents without an id come first; rows with equal
ids are ordered by text; further columns are ignored; an empty table gives an empty output.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import release, stretches

# A blank between two white-space characters, or between one and the end, is not a safe place to cut a text.
# The pattern begins with the blank, which is found faster than any white space.
UNSAFE = re.compile(r" (?<=\s )(?:\s|\Z)")


# Memory of a known word besides its characters and ids, about: offsets, uses, its place in the table of a lookup.
WORD_BYTES = 64
# Words given to the library in one text: in very long texts it takes longer for each.
TOGETHER = 1000
# White space of the tokenizers and of Python.
SPACES = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# The usual pre-tokenizer: runs of letters, of digits and of other signs, each with a blank before it if there is one.
RUNS = "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)"
# There a run of letters ends before anything else, and a single line break between other characters is a piece.
LETTER_END = "([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0391-\u03a1\u03a3-\u03a9\u03b1-\u03c9\u0410-\u044f])([!-@\\[-`{-~])"
LINE_END = f"([^{SPACES}])\n([^{SPACES}])"


def joined(words: pa.Array, together: int, between: str = " ") -> pa.Array:
    """Texts of ``together`` words each with ``between`` between them, the last one of what is left."""
    offsets = [*range(0, len(words), together), len(words)]
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words), between)


def listed(words: pa.Array) -> list[str]:
    """The words, which hold no blanks, as texts. One long text is faster cut than each word is fetched."""
    return joined(words, len(words))[0].as_py().split(" ") if len(words) else []


class Held:
    """Words with their ids, as far as these are learned: a word's number is its place. ``uses`` counts batches that had it."""

    def __init__(self) -> None:
        self.words = pa.array([], pa.string())
        self.ids = pa.array([], pa.list_(pa.int32()))
        self.uses = np.empty(0, np.int64)

    def size(self) -> int:
        return self.words.nbytes + self.ids.nbytes + WORD_BYTES * len(self.words)

    def number(self, words: list[str]) -> np.ndarray:
        """The numbers of different words; unknown ones get the next numbers in their order."""
        return self.places(pa.array(words, pa.string()))

    def places(self, asked: pa.Array) -> np.ndarray:
        """As ``number``, of an Arrow array."""
        # The known words are looked for among the asked ones, which are fewer: a smaller table to make.
        places = pc.index_in(self.words, value_set=asked)
        held = places.is_valid().to_numpy(zero_copy_only=False)
        numbers = np.full(len(asked), -1, np.int64)
        numbers[places.drop_null().to_numpy()] = np.flatnonzero(held)
        new = asked.filter(pa.array(numbers < 0))
        numbers[numbers < 0] = np.arange(len(self.words), len(self.words) + len(new))
        self.words = pa.concat_arrays([self.words, new])
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
        self.uses[numbers] += 1
        return numbers

    def unlearned(self) -> pa.Array:
        return self.words.slice(len(self.ids))

    def add(self, ids: pa.Array) -> None:
        self.ids = pa.concat_arrays([self.ids, ids])

    def thin(self, limit: int) -> None:
        """Keep the words of most use, of equal ones the newest, within ``limit`` bytes; their uses count half from now on."""
        order = np.lexsort((-np.arange(len(self.uses)), -self.uses))
        sizes = pc.binary_length(self.words).to_numpy() + 4 * pc.list_value_length(self.ids).to_numpy() + WORD_BYTES
        keep = np.sort(order[np.cumsum(sizes[order]) <= limit])
        self.words, self.ids, self.uses = self.words.take(pa.array(keep)), self.ids.take(pa.array(keep)), self.uses[keep] // 2


class Encoder:
    """Encodes texts with a byte-level BPE tokenizer, remembering the ids of words.

    The tokenizer splits a text into pieces before it merges bytes, and a blank next to a character that is not
    white space always begins a piece. So a text can be cut there into words, each encoded once with the blank before
    it. A batch of texts is cut and its different words are found in Arrow, so that each is looked up once a batch; the
    ids of all words of the batch are then copied at once. Unknown words are cut once more, where the usual
    pre-tokenizer always ends a piece (behind letters, at line breaks), as many are new only with their signs. Unknown
    parts are encoded together in long texts and told apart by the byte lengths of their ids. When words or parts hold
    half of ``limit`` bytes, those that the fewest batches had are dropped until a half of that is free.

    Raises ValueError for a tokenizer that has a normalizer or is not byte-level, where words can't be cut out so.
    """

    def __init__(self, path: str, limit: int = 96 << 20) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.normalizer is not None or "ByteLevel" not in repr(self.tokenizer.pre_tokenizer):
            raise ValueError(f"{path} is no byte-level tokenizer without normalizer")
        # The library's own cache only costs time here: it is asked for every word once.
        self.tokenizer.model._resize_cache(0)
        count = self.tokenizer.get_vocab_size()
        self.width = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(count)], np.int64)
        self.known, self.parts = Held(), Held()
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        # What stands between parts in a long text: a line break where it is always a piece, or nothing and no word is cut.
        self.between = "\n" if repr(self.tokenizer.pre_tokenizer) == RUNS and "\n" not in "".join(self.added) else ""
        self.limit = limit

    def plain(self, text: str) -> np.ndarray:
        # The batch call without offsets is the cheaper one.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def library(self, parts: pa.Array) -> pa.Array:
        """The ids of parts, which end with no white space and begin with none but one blank."""
        texts = joined(parts, TOGETHER, self.between).to_pylist()
        ids = np.concatenate([self.plain(text + self.between) for text in texts])
        # The bytes at which a part ends and at which the next one begins.
        begins = np.cumsum(pc.binary_length(parts).to_numpy().astype(np.int64) + len(self.between))
        ends = np.cumsum(self.width[ids])
        cuts = np.searchsorted(ends, begins, side="right")
        if self.between:
            # One id stands for the line break behind each part.
            kept = np.ones(len(ids), bool)
            kept[cuts - 1] = False
            ids, cuts = ids[kept], cuts - np.arange(1, len(cuts) + 1)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], cuts]), pa.int32()), pa.array(ids))

    def alone_or_together(self, texts: pa.Array, safe: pa.Array, together: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """The ids of texts, each alone by the library unless it is safe."""
        held, rest = texts.filter(safe), texts.filter(pc.invert(safe))
        found = [together(held)] if len(held) else []
        found.append(pa.array([self.plain(text) for text in rest.to_pylist()], pa.list_(pa.int32())))
        safe = safe.to_numpy(zero_copy_only=False)
        return pa.concat_arrays(found).take(pa.array(np.where(safe, np.cumsum(safe) - 1, len(held) + np.cumsum(~safe) - 1)))

    def by_parts(self, words: pa.Array) -> pa.Array:
        """The ids of words with the blank before them, put together from those of their parts."""
        if self.between:
            words = pc.replace_substring_regex(words, LINE_END, "\\1\x00\n\x00\\2")
            words = pc.replace_substring_regex(words, LETTER_END, "\\1\x00\\2")
        cut = pc.split_pattern(words, "\x00")
        parts = cut.values.dictionary_encode()
        numbers = self.parts.places(parts.dictionary)[parts.indices.to_numpy()]
        new = self.parts.unlearned()
        if len(new):
            safe = pc.equal(pc.binary_length(new), pc.binary_length(pc.utf8_rtrim(new, SPACES)))
            self.parts.add(self.alone_or_together(new, safe, self.library))
        ids = self.parts.ids.take(pa.array(numbers))
        return pa.ListArray.from_arrays(ids.offsets.take(cut.offsets), ids.values)

    def learn(self) -> None:
        """Find the ids of the words that were numbered but not learned yet."""
        words = self.known.unlearned()
        if not len(words):
            return
        sizes = pc.binary_length(words)
        safe = pc.and_(pc.greater(sizes, 0), pc.equal(sizes, pc.binary_length(pc.utf8_ltrim(words, SPACES))))
        safe = pc.and_(safe, pc.less(sizes, 1000))
        # Marks of the cuts and added tokens must not be met inside a word.
        for token in ["\x00", *self.added]:
            safe = pc.and_not(safe, pc.match_substring(words, token))
        self.known.add(self.alone_or_together(pc.binary_join_element_wise("", words, " "), safe, self.by_parts))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """For each text its ids as 32-bit integers."""
        for held in (self.known, self.parts):
            if held.size() > self.limit // 2:
                held.thin(self.limit // 4)
        whole = {i: text for i, text in enumerate(texts) if UNSAFE.search(text)}
        cut = pc.split_pattern(pa.array(["" if i in whole else text for i, text in enumerate(texts)], pa.string()), " ")
        stops = cut.offsets.to_numpy().astype(np.int64)
        firsts = cut.values.take(pa.array(stops[:-1])).to_pylist()
        follows = np.ones(len(cut.values), bool)
        follows[stops[:-1]] = False
        words = cut.values.filter(pa.array(follows)).dictionary_encode()
        numbers = self.known.number(listed(words.dictionary))[words.indices.to_numpy()]
        self.learn()
        lists = self.known.ids.take(pa.array(numbers))
        before, ids = lists.offsets.to_numpy(), lists.values.to_numpy()
        # Each text has one first word, which is not among the others.
        ends = before[stops[1:] - np.arange(1, len(stops))].tolist()
        out = []
        for i, (first, begin, end) in enumerate(zip(firsts, [0, *ends], ends)):
            first = whole.get(i, first)
            out.append(np.concatenate([self.plain(first), ids[begin:end]]) if first else ids[begin:end])
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Drop the worker's encoders, once all is encoded."""
    _ENCODERS.clear()
    release()


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, stripe_bytes: int = 16 << 20, group_rows: int = 1000, key: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all documents below ``path``. ``vocabulary`` is a tokenizer file that every worker has."""
    kind = docs.schema[key].dataType.simpleString()
    end = np.array([end_id], np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, before = encoder(vocabulary), 0
        for batch in batches:
            for cut in stretches(batch, 1, 4 << 20):
                rows = work.encode([t or "" for t in cut.column(1).to_pylist()])
                counts = np.array([len(row) + 1 for row in rows], np.int64)
                stops = np.cumsum(counts)
                ids = np.concatenate([part for row in rows for part in (row, end)])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [cut.column(0), pa.array(before + stops - counts), pa.array(counts), lists], names=["doc_id", "local_start", "n_tokens", "ids"]
                )
                before += int(stops[-1])
        release()

    ranged = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    writer = ranged.mapInArrow(run, f"doc_id {kind}, local_start long, n_tokens long, ids array<int>").write
    writer = writer.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").option("orc.create.index", "true")
    writer = writer.option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", group_rows).option("orc.compress", "ZSTD")
    writer.orc(f"{path}/tokens")

    spark = docs.sparkSession
    files = spark.read.orc(f"{path}/tokens").select(F.col("_metadata.file_name").alias("file"), "doc_id", "n_tokens")
    parts = files.groupBy("file").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_ids"))
    in_order = Window.orderBy(F.col("first_id").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file: the window's single task stays small.
    parts.withColumn("base", F.coalesce(F.sum("n_ids").over(in_order), F.lit(0))).write.parquet(f"{path}/parts")


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The rows as they are in the files, with the file's name."""
    return spark.read.orc(f"{path}/tokens").select("*", F.col("_metadata.file_name").alias("file"))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of its ids as read)."""
    rows = stored(spark, path)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            lists = batch.column(3)
            stops = lists.offsets.to_numpy().tolist()
            # The buffer as Spark filled it; negative ids do not occur, so signed and unsigned bytes are the same.
            held = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)).cast("B")
            sums = [zlib.crc32(held[4 * a : 4 * b]) for a, b in zip(stops, stops[1:])]
            counts = [b - a for a, b in zip(stops, stops[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(counts, pa.int64()), pa.array(sums, pa.int64())], names=["file", "doc_id", "local_start", "n_tokens", "ids_crc32"])

    read = rows.select("file", "doc_id", "local_start", "ids").mapInArrow(run, f"file string, doc_id {kind}, local_start long, n_tokens long, ids_crc32 long")
    parts = spark.read.parquet(f"{path}/parts").select("file", "base")
    return read.join(parts, "file").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def read_tokens(spark: SparkSession, path: str, ids: list | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids. With a short list of ids only their row groups are read."""
    rows = stored(spark, path)
    if ids is not None:
        rows = rows.filter(F.col("doc_id").isin(list(ids)))
    parts = spark.read.parquet(f"{path}/parts").select("file", "base")
    return rows.join(parts, "file").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids")
