"""Language identification by cross-parsing.

For each language a suffix automaton is built over a bounded excerpt of labelled text (letters lowered, everything else
a blank). A text is parsed greedily: a phrase is the longest stretch from the current place that occurs in the excerpt.
The fewer phrases, the closer the text is to the language. Counts are normalised by the excerpt's size and the text's
length: phrases * log2(excerpt letters) / letters of the text, an estimate of the cross entropy. The language with the
smallest value wins, ties go to the first name. The score is 1 - best / second best.

Texts are parsed whole, in parts of ``PART`` symbols, each of which begins a new phrase; a task parses thousands of
parts side by side, one symbol of each per step.

Defined cases: a missing text or one without letters is ``und`` with score 0; rows without a language are not learned
from; without any learned language everything is ``und``; with one language the score is 1; repeated rows get equal
results; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import append, field, uniform

PART = 2048
POINTS = 0x110000


def suffix_automaton(symbols: list[int], letters: int) -> np.ndarray:
    """states x letters: the state reached by a letter, or -1. State 0 is the start; every path spells a stretch of the text."""
    following: list[dict[int, int]] = [{}]
    longest, link = [0], [-1]
    last = 0
    for symbol in symbols:
        new = len(following)
        following.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in following[at]:
            following[at][symbol] = new
            at = link[at]
        if at >= 0:
            then = following[at][symbol]
            if longest[then] == longest[at] + 1:
                link[new] = then
            else:
                copy = len(following)
                following.append(dict(following[then]))
                longest.append(longest[at] + 1)
                link.append(link[then])
                while at >= 0 and following[at].get(symbol) == then:
                    following[at][symbol] = copy
                    at = link[at]
                link[then] = link[new] = copy
        last = new
    table = np.full((len(following), letters), -1, np.int32)
    for state, out in enumerate(following):
        if out:
            table[state, list(out)] = list(out.values())
    return table


def letters_of(text: str) -> str:
    """Letters lowered, runs of anything else as one blank."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


@dataclass
class Languages:
    """The excerpts as letters; automata and tables are built by each worker process on first use."""

    excerpts: dict[str, str]

    def build(self) -> None:
        alphabet = sorted({c for text in self.excerpts.values() for c in text if c != " "})
        # 0: anything but a letter, 1: a letter of no excerpt
        self.symbol = np.zeros(POINTS, np.int16)
        self.symbol[[c for c in range(POINTS) if chr(c).isalpha()]] = 1
        for number, letter in enumerate(alphabet):
            for form in {letter, letter.upper(), letter.title()}:
                if len(form) == 1:
                    self.symbol[ord(form)] = number + 2
        width = len(alphabet) + 2
        self.names = sorted(self.excerpts)
        tables, self.roots, states = [], [], 0
        for name in self.names:
            own = self.symbol[np.array([ord(c) for c in self.excerpts[name]], np.int64)].tolist()
            table = suffix_automaton(own, width)
            # States are numbered on across languages and already multiplied by the width.
            tables.append(np.where(table < 0, -1, (table + states) * width).astype(np.int64).ravel())
            self.roots.append(states * width)
            states += len(table)
        self.table = np.concatenate(tables)
        self.weight = np.array([np.log2(max(2, len(self.excerpts[name]))) for name in self.names])

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """texts x languages phrase counts, and symbols per text (0 without letters)."""
        parts, owner, sizes = [], [], np.zeros(len(texts), np.int64)
        for row, text in enumerate(texts):
            points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
            symbols = self.symbol[points]
            blank = symbols == 0
            symbols = symbols[~(blank & np.concatenate([[True], blank[:-1]]))] if len(symbols) else symbols
            if not symbols.any():
                continue
            sizes[row] = len(symbols)
            for at in range(0, len(symbols), PART):
                parts.append(symbols[at : at + PART])
                owner.append(row)
        counts = np.zeros((len(texts), len(self.names)))
        if not parts:
            return counts, sizes
        lengths = np.array([len(p) for p in parts])
        order = np.argsort(-lengths, kind="stable")
        grid = np.zeros((PART, len(parts)), np.int16)
        for lane, part in enumerate(order.tolist()):
            grid[: lengths[part], lane] = parts[part]
        going = np.searchsorted(-lengths[order], -np.arange(PART), "left")  # lanes longer than the step's number
        roots = np.array(self.roots, np.int64)[:, None]
        state = np.repeat(roots, len(parts), axis=1)
        found = np.zeros((len(self.names), len(parts)), np.int64)
        for step in range(PART):
            n = going[step]
            if not n:
                break
            symbol = grid[step, :n]
            then = self.table[state[:, :n] + symbol]
            stuck = then < 0
            # A phrase begins at the start state, or where the one before it cannot go on.
            found[:, :n] += stuck | (state[:, :n] == roots)
            if stuck.any():
                # A symbol that occurs nowhere in the excerpt is a phrase by itself.
                fresh = self.table[roots + symbol]
                fresh = np.where(fresh < 0, roots, fresh)
                then = np.where(stuck, fresh, then)
            state[:, :n] = then
        np.add.at(counts, np.array(owner)[order], found.T)
        return counts, sizes

    def __call__(self, texts: pa.Array) -> list[pa.Array]:
        if not self.excerpts:
            return [pa.array(["und"] * len(texts), pa.string()), pa.array(np.zeros(len(texts)))]
        if not hasattr(self, "table"):
            self.build()
        counts, sizes = self.phrases(texts.to_pylist())
        entropy = counts * self.weight / np.maximum(1, sizes)[:, None]
        best = entropy.argmin(axis=1)
        ranked = np.sort(entropy, axis=1)
        score = 1 - ranked[:, 0] / np.maximum(ranked[:, 1], 1e-300) if len(self.names) > 1 else np.ones(len(texts))
        known = sizes > 0
        names = [self.names[i] if k else "und" for i, k in zip(best.tolist(), known.tolist())]
        return [pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0))]


def fit(docs: DataFrame, where: Column, letters: int = 40_000, all_letters: int = 1_600_000, texts: int = 300) -> Languages:
    """Excerpts of ``letters`` symbols per language, fewer if there are more than forty languages.

    Learns from rows for which ``where`` holds. About ``texts`` documents per language, chosen by a digest of doc_id,
    come to the driver.
    """
    known = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).filter(where)
    counts = {row.lang: row.n for row in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Languages({})
    share = F.create_map(*(F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, texts / n))))
    chance = uniform(F.concat(F.lit("language "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    chosen = known.withColumn("chance", chance).filter(F.col("chance") < share[F.col("lang")]).orderBy("chance", "doc_id", "text")
    limit = min(letters, all_letters // len(counts))
    excerpts: dict[str, str] = {}
    for row in chosen.toLocalIterator():
        held = excerpts.get(row.lang, "")
        if len(held) < limit:
            excerpts[row.lang] = (held + " " + letters_of(row.text[: 4 * limit]))[:limit]
    return Languages({lang: text for lang, text in excerpts.items() if text.strip()})


def predict(docs: DataFrame, languages: Languages) -> DataFrame:
    """doc_id, lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(languages)
    fields = [field("lang_pred", "string"), field("score", "double")]
    return append(docs.select("doc_id", "text"), lambda: shared.value, fields, ["text"]).drop("text")
