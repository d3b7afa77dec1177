"""Quality rules on how far a document's characters and common words are from those of its language.

For every language two references are gathered from all its documents: the mean histogram of character classes and the
mean histogram of common function words (each word of the list below, and all others together). A document's distance
is the Jensen-Shannon distance (base 2, 0 to 1) to the references of its own language, from which its own share is
taken out first, so that no document speaks for itself. A document without a language is held against the nearest
reference. Documents below a minimum length are not judged by that histogram, and neither are documents of a language
with fewer than ``support`` documents of that length: such a language has no reference, and excuses or condemns
nothing. Base rules on length and on repeated stretches of five words come first.

References are sums of whole numbers, so they do not depend on the order of rows, and those of a language depend on its
own documents only; the driver holds one row of sums for each value of lang that has support.

Defined cases: a missing or empty text has no words and fails the base rules; documents without a language add to no
reference; without any reference only the base rules decide; repeated rows get equal results; further columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import append, field
from tidemark.llm.decontaminate import FOLDED
from tidemark.llm.linear import CLASS_OF, N_CLASSES

# Common function words.
COMMON = (
    "the of and to in is that for it was on are as with by he she at from or this have not be but had they you an we "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "le la les de des et un une du en que qui dans pour pas au sur est par plus avec il elle se ce sont ne "
    "el los las y en un una que por con para del se no es al lo como más o pero sus su le ha"
).split()
WORDS = {w.encode(): i for i, w in enumerate(dict.fromkeys(COMMON))}
SYMBOLS = list(b"#*$%&|<>")
BLANKS = list(b" \t\n\r\x0b\x0c")
SCALE = 10**9


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated five-word stretches."""
    held = (text or "").encode("utf-8", "surrogatepass")
    words = held.split()
    counts = np.bincount(np.frombuffer(held, np.uint8), minlength=256)
    lines = [line for line in held.split(b"\n") if line.strip()]
    repeated = 0
    grams = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(grams)) < len(grams):
        seen = Counter(grams)
        covered = 0  # words before this place are counted
        for at, gram in enumerate(grams):
            if seen[gram] > 1:
                repeated += at + 5 - max(covered, at)
                covered = at + 5
    chars = len(text or "") - int(counts[BLANKS].sum())
    return len(words), chars, int(counts[SYMBOLS].sum()), len(lines) - len(set(lines)), repeated


def histograms(text: str | None) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Counts by character class (in bytes), counts of common words (others last), bytes and words."""
    held = (text or "").encode("utf-8", "surrogatepass")
    classes = np.bincount(CLASS_OF[np.frombuffer(held, np.uint8)], minlength=N_CLASSES)
    words = held.translate(FOLDED).split()
    common = np.zeros(len(WORDS) + 1)
    for word, n in Counter(filter(WORDS.__contains__, words)).items():
        common[WORDS[word]] = n
    common[-1] = len(words) - common.sum()
    return classes, common, len(held), len(words)


def distances(counts: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of one histogram from each row of ``references`` (shares)."""
    p = counts / counts.sum()
    middle = (p + references) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0).sum(axis=1)
        right = np.where(references > 0, references * np.log2(references / middle), 0).sum(axis=1)
    return np.sqrt(np.maximum(0, (left + right) / 2))


@dataclass
class References:
    """Sums of the documents' shares by language, their numbers, and which histograms have support."""

    names: list[str]
    sums: np.ndarray  # languages x (character classes, common words)
    counts: np.ndarray  # languages x (documents judged by characters, by words)
    support: int

    def __post_init__(self) -> None:
        self.place = {name: i for i, name in enumerate(self.names)}

    def distance(self, own: np.ndarray, shares: np.ndarray, lang: str | None, part: int) -> float | None:
        """Of one histogram (``part`` 0: characters, 1: words) that counted with ``shares`` if its language is known."""
        columns = slice(0, N_CLASSES) if part == 0 else slice(N_CLASSES, None)
        if lang is None:
            held = self.sums[self.counts[:, part] >= self.support, columns]
            return float(distances(own, held / held.sum(axis=1, keepdims=True)).min()) if len(held) else None
        at = self.place.get(lang)
        if at is None or self.counts[at, part] < self.support:
            return None
        rest = self.sums[at, columns] - shares[columns]
        return float(distances(own, (rest / rest.sum())[None])[0])


def shares_of(text: str | None, min_bytes: int, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool, bool]:
    """Both histograms, the shares they add to a reference, and whether the text is long enough for each."""
    classes, common, n_bytes, n_words = histograms(text)
    shares = np.zeros(N_CLASSES + len(WORDS) + 1, np.int64)
    by_chars, by_words = n_bytes >= min_bytes, n_words >= min_words
    if by_chars:
        shares[:N_CLASSES] = classes / n_bytes * SCALE
    if by_words:
        shares[N_CLASSES:] = common / n_words * SCALE
    return classes, common, shares, by_chars, by_words


def references(docs: DataFrame, min_bytes: int, min_words: int, support: int) -> References:
    size = N_CLASSES + len(WORDS) + 1

    def make():
        def summed(texts: pa.Array) -> list[pa.Array]:
            out = []
            for text in texts.to_pylist():
                _, _, shares, by_chars, by_words = shares_of(text, min_bytes, min_words)
                out.append(np.concatenate([shares, [by_chars, by_words]]))
            return [pa.array(out, pa.list_(pa.int64()))]

        return summed

    known = docs.select("text", "lang").filter(F.col("lang").isNotNull())
    shares = append(known, make, [field("shares", "array<long>")], ["text"]).drop("text")
    rows = shares.groupBy("lang").agg(*(F.sum(F.col("shares")[i]).alias(f"s{i}") for i in range(size + 2)))
    enough = F.greatest(f"s{size}", f"s{size + 1}") >= support
    found = rows.filter(enough).select("lang", F.array(*(f"s{i}" for i in range(size + 2))).alias("sums")).orderBy("lang").collect()
    sums = np.array([row.sums for row in found], np.int64).reshape(-1, size + 2)
    return References([row.lang for row in found], sums[:, :size], sums[:, size:], support)


def judge(docs: DataFrame, max_chars: float = 0.22, max_words: float = 0.38, min_bytes: int = 300, min_words: int = 60, support: int = 20) -> DataFrame:
    """Per document the base counts, both distances (null where not judged), base_failed and kept."""
    known = references(docs, min_bytes, min_words, support)

    def make():
        def judged(texts: pa.Array, langs: pa.Array) -> list[pa.Array]:
            rows = []
            for text, lang in zip(texts.to_pylist(), langs.to_pylist(), strict=True):
                classes, common, shares, by_chars, by_words = shares_of(text, min_bytes, min_words)
                chars = known.distance(classes, shares, lang, 0) if by_chars else None
                words = known.distance(common, shares, lang, 1) if by_words else None
                base = base_counts(text)
                failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
                kept = not failed and (chars is None or chars <= max_chars) and (words is None or words <= max_words)
                rows.append((*base, failed, kept, chars, words))
            columns = list(zip(*rows)) if rows else [()] * 9
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            return [pa.array(values, kind) for values, kind in zip(columns, kinds)]

        return judged

    kinds = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "base_failed": "boolean", "kept": "boolean", "char_distance": "double", "word_distance": "double"}
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    return append(rows, make, [field(k, v) for k, v in kinds.items()], ["text", "lang"]).drop("text", "lang")
