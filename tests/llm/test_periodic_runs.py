"""Periodic runs of words against all stretches of small texts."""

from __future__ import annotations

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from tidemark.llm import periodic_runs
from tidemark.llm.common import table
from tidemark.llm.queries import made_periodic, op13_periodic_runs

SMALL = "/root/testdata/sf0.001"


def brute_runs(words, least_length=6, exponent=4):
    found = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i if j > i else 0
            part = words[i : i + length]
            if length >= max(least_length, exponent * q) and not any(part[p:] == part[: length - p] for p in range(1, q)):
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def brute_left(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def odd_text(rng):
    words = [rng.choice("abcde"[: rng.randint(1, 5)]) for _ in range(rng.choice([0, 1, 5, 6, 7, 24, 90]))]
    while words and rng.random() < 0.6:
        at, period = rng.randrange(len(words)), rng.randint(1, 8)
        words = words[:at] + words[at : at + period] * rng.randint(2, 9) + words[at + rng.randint(0, period) :]
    return words


def test_all_runs_of_odd_texts():
    rng = random.Random(3)
    for _ in range(150):
        texts = [odd_text(rng) for _ in range(rng.choice([1, 3]))]
        for least, exponent in ((6, 4), (2, 2), (9, 3)):
            runs, left = periodic_runs.runs_of([[w.encode() for w in t] for t in texts], least, exponent)
            for text, got, rest in zip(texts, runs, left, strict=True):
                assert got == brute_runs(text, least, exponent)
                assert rest.decode() == " ".join(brute_left(text, got))


def test_least_prefix_is_the_smallest_of_all_periods():
    for least in range(2, 20):
        for exponent in range(2, 8):
            assert periodic_runs.least_prefix(least, exponent) == min(max(least, exponent * q) - q for q in range(1, 60))


def test_find_on_odd_tables(spark):
    rows = [
        (1, None, "x", 5), (2, "", "x", 5), (3, " \n\t", "x", 5), (None, "a " * 7, "x", 5), (None, "a " * 7, "x", 5), (4, "one two", "x", 5),
        (5, "é 日本 " * 40000, "x", 5), (5, "x y z x y z x y z x y z q", None, None),
    ]
    found = periodic_runs.find(spark.createDataFrame(rows, "doc_id long, text string, collapsed string, runs long"))
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()), key=repr)
    a = (0, 7, [(0, 7, 1)], "a")
    assert got == sorted(
        [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), a, a, (4, 2, [], "one two"), (5, 80000, [(0, 80000, 2)], "é 日本"), (5, 13, [(0, 12, 3)], "x y z q")], key=repr
    )
    none = periodic_runs.find(spark.createDataFrame([], "doc_id string, text string"))
    assert none.collect() == [] and none.schema["doc_id"].dataType.simpleString() == "string"


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in table(spark, SMALL, "documents").collect()}
    got = {r.doc_id: r for r in op13_periodic_runs(spark, SMALL).collect()}
    made = {r.doc_id: r.text for r in made_periodic(table(spark, SMALL, "documents")).collect()}
    assert got.keys() == docs.keys()
    periodic = 0
    for key, text in docs.items():
        words = [w.decode() for w in text.encode().split()]
        h = zlib.crc32(str(key).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            assert made[key] == " ".join(words)
        runs = brute_runs(words) if len(words) < 3000 else [tuple(r) for r in periodic_runs.runs_of([[w.encode() for w in words]])[0][0]]
        periodic += bool(runs)
        row = got[key]
        assert row.n_runs == len(runs)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(" ".join(brute_left(words, runs)).encode()).hexdigest()
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert (row.start, row.length, row.period) == best
        assert row.exponent_milli == (best[1] * 1000 // best[2] if runs else None)
    assert periodic > 5


def test_longest_breaks_ties_by_start_then_period(spark):
    frame = spark.sql("SELECT array(named_struct('start', 9L, 'length', 8L, 'period', 2L), named_struct('start', 1L, 'length', 8L, 'period', 2L), named_struct('start', 1L, 'length', 8L, 'period', 1L)) AS runs")
    assert tuple(frame.select(periodic_runs.longest().alias("m")).select("m.*").first()) == (1, 8, 1)
    assert frame.select(F.expr("slice(runs, 1, 0)").alias("runs")).select(periodic_runs.longest().alias("m")).first().m is None
