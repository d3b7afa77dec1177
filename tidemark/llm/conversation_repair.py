"""Repair of broken conversations by cheapest edits, streamed over conversations sorted by turn.

Rows are dealt by conversation and sorted by turn. A first stream reads every conversation from its last row to its
first and carries, for four grammar states, the cost of the cheapest edits of the rows seen so far; only these four
numbers pass from one Arrow batch to the next. It writes one byte per row, the best edit in each state, in chunks of
``CHUNK`` rows: a giant conversation spills its pointers in many chunks and never stands in memory. A second stream,
over rows and chunks together in ascending order, follows the pointers and yields the edits.

The repaired roles read ``(s?(ua)+)?`` in initials: a system row at most, then user and assistant in turn. Keeping a
row is free, giving it the role user or assistant costs 3, deleting it 4, inserting an empty row 3. Blank rows and
repeated rows must go; a truncated row that stays adds 3. Among equally cheap edits the one whose letters (D, I, K, R)
come first in ASCII order is taken. Since the costs are settled from the end, a local choice of the least letter does.

Behaviour: a missing role or text counts as one space. Rows without a turn come first; rows of one turn are ordered by
role and text. A missing conversation id is a conversation of its own. Row order within a conversation is by these
values alone, so equal rows are interchangeable: the first of them counts as the original. An empty table gives an
empty result. Columns other than ``conv_id``, ``turn``, ``role`` and ``text`` are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialise

BLANKS = " \t\n\x0b\x0c\r"
CHUNK = 65_536
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
LETTERS = "DIKR"

# Grammar states: nothing yet, after a system row, after a user row, after an assistant row.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_ROLES = "sua"
_OK, _TRUNCATED, _BLANK, _DUPLICATE = range(4)
_END = (0, 2 * INSERT, INSERT, 0)


def kept_state(state: int, role: int) -> int | None:
    """The state after keeping a row of role ``_ROLES[role]``, if the grammar allows it."""
    if role == 0:
        return _SYSTEM if state == _START else None
    if role == 1:
        return _USER if state != _USER else None
    return _ASSISTANT if role == 2 and state == _USER else None


def step(after: tuple[int, ...], role: int, fault: int) -> tuple[tuple[int, ...], int]:
    """Costs before a row from the costs after it, and the best edits: two bits for each state, the first state lowest."""
    extra = TRUNCATED if fault == _TRUNCATED else 0
    options: list[dict[int, int]] = []
    for state in range(4):
        mine = {0: DELETE + after[state]}
        if fault in (_OK, _TRUNCATED):
            if (to := kept_state(state, role)) is not None:
                mine[2] = KEEP + extra + after[to]
            mine[3] = REROLE + extra + after[_NEXT[state]]
        options.append(mine)
    costs = [min(mine.values()) for mine in options]
    for _ in range(3):
        costs = [min(costs[state], INSERT + costs[_NEXT[state]]) for state in range(4)]
    edits = 0
    for state in range(4):
        options[state][1] = INSERT + costs[_NEXT[state]]
        edits |= min(letter for letter, cost in options[state].items() if cost == costs[state]) << 2 * state
    return tuple(costs), edits


def id_text(column: Column) -> Column:
    """The id as a text that is never null, to be read back by ``id_value``."""
    return F.when(column.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), column.cast("string")))


def id_value(key: Column, kind) -> Column:
    return F.when(F.substring(key, 1, 1) == "v", key.substr(F.lit(2), F.length(key))).cast(kind)


def marked(rows: DataFrame) -> DataFrame:
    """Rows with their place in the conversation (from 1), role code and first fault."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = rows.select(id_text(F.col("conv_id")).alias("key"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    rows = rows.withColumns({"last": last, "digest": F.sha2("text", 256)}).repartition("key")
    seen = Window.partitionBy("key", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.withColumn("copy", F.row_number().over(seen))
    fault = (
        F.when(F.col("last") == "", _BLANK)
        .when(F.col("copy") > 1, _DUPLICATE)
        .when(~F.col("last").isin(".", "!", "?"), _TRUNCATED)
        .otherwise(_OK)
    )
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    order = Window.partitionBy("key").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "copy")
    return rows.select(
        "key", F.row_number().over(order).cast("long").alias("place"), F.col("turn").isNotNull().alias("timed"), F.coalesce("turn", F.lit(0)).alias("turn"),
        "role", "text", code.alias("code"), fault.alias("fault"),
    )


def pointers(rows: DataFrame, chunk: int) -> DataFrame:
    """The best edits of every row in every state, as chunks of bytes from the place ``place`` on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple[tuple[int, ...], int, int], tuple[tuple[int, ...], int]] = {}
        key, costs, place, edits = None, _END, 0, bytearray()
        for batch in batches:
            out: list[tuple[str, int, bytes]] = []
            for this, at, code, fault in zip(batch["key"].tolist(), batch["place"].tolist(), batch["code"].tolist(), batch["fault"].tolist(), strict=True):
                if this != key or len(edits) >= chunk:
                    if edits:
                        out.append((key, place, bytes(reversed(edits))))
                        edits.clear()
                    if this != key:
                        key, costs = this, _END
                if (costs, code, fault) not in known:
                    before, best = step(costs, code, fault)
                    known[costs, code, fault] = tuple(c - min(before) for c in before), best
                costs, best = known[costs, code, fault]
                edits.append(best)
                place = at
            yield pd.DataFrame(out, columns=["key", "place", "edits"])
        if edits:
            yield pd.DataFrame([(key, place, bytes(reversed(edits)))], columns=["key", "place", "edits"])

    ordered = rows.select("key", "place", "code", "fault").repartition("key").sortWithinPartitions("key", F.desc("place"))
    return ordered.mapInPandas(run, "key string, place long, edits binary")


class _Conversation:
    """What is known of a conversation while its rows pass by."""

    def __init__(self, key: str) -> None:
        self.key, self.state = key, _START
        self.edits, self.offset = b"", 0
        self.cost, self.counts, self.illegal, self.before = 0, [0, 0, 0, 0], 0, None
        self.turns, self.least, self.most = 0, None, None
        self.audit, self.hash, self.output = bytearray(), hashlib.sha256(), 0

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        self.state = _NEXT[self.state]
        yield from self.done("I", INSERT, _ROLE[self.state], "")

    def done(self, letter: str, cost: int, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        self.audit += letter.encode()
        self.cost += cost
        if letter != "D":
            self.hash.update(f"{chr(10) if self.output else ''}{role}:{text}".encode())
            self.output += 1
        yield letter, role, text

    def row(self, timed: bool, turn: int, role: str, text: str, code: int, fault: int) -> Iterator[tuple[str, str, str]]:
        """The edits up to and including this row's own."""
        self.counts[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        if timed and turn != self.most:
            self.turns, self.most = self.turns + 1, turn
            self.least = turn if self.least is None else self.least
        best = self.edits[self.offset]
        self.offset += 1
        extra = TRUNCATED if fault == _TRUNCATED else 0
        while (letter := best >> 2 * self.state & 3) == 1:
            yield from self.inserted()
        if letter == 0:
            yield from self.done("D", DELETE, role, text)
        elif letter == 2:
            self.state = kept_state(self.state, code)
            yield from self.done("K", KEEP + extra, role, text)
        else:
            self.state = _NEXT[self.state]
            yield from self.done("R", REROLE + extra, _ROLE[self.state], text)

    def end(self) -> Iterator[tuple[str, str, str]]:
        while self.state in (_SYSTEM, _USER):
            yield from self.inserted()

    def report(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        _, truncated, blank, duplicate = self.counts
        return self.key, gaps, blank, duplicate, truncated, self.illegal, self.cost, self.audit.decode(), self.hash.hexdigest()


_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _followed(rows: DataFrame, ids: DataFrame | None, chunk: int) -> DataFrame:
    """Rows and pointer chunks of whole conversations in ascending order; ``kind`` 0: the id alone, 1: a chunk, 2: a row."""
    empty = {"timed": F.lit(False), "turn": F.lit(0).cast("long"), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string"), "code": F.lit(0), "fault": F.lit(0)}
    both = rows.withColumns({"edits": F.lit(None).cast("binary"), "kind": F.lit(2)}).unionByName(pointers(rows, chunk).withColumns({**empty, "kind": F.lit(1)}))
    if ids is not None:
        named = ids.select(id_text(F.col("conv_id")).alias("key")).distinct()
        both = both.unionByName(named.withColumns({"place": F.lit(0).cast("long"), **empty, "edits": F.lit(None).cast("binary"), "kind": F.lit(0)}))
    return both.repartition("key").sortWithinPartitions("key", "place", "kind")


def _stream(batches: Iterator[pd.DataFrame], edits_wanted: bool) -> Iterator[list[tuple]]:
    """Per batch the edits, or the reports of conversations that have ended."""
    names = ["key", "kind", "timed", "turn", "role", "text", "code", "fault", "edits"]
    now: _Conversation | None = None

    def listed(edits: Iterator[tuple[str, str, str]]) -> list[tuple]:
        return [(now.key, len(now.audit), *edit) for edit in edits]

    for batch in batches:
        out: list[tuple] = []
        for key, kind, timed, turn, role, text, code, fault, edits in zip(*(batch[name].tolist() for name in names), strict=True):
            if now is None or key != now.key:
                if now is not None:
                    last = listed(now.end())
                    out += last if edits_wanted else [now.report()]
                now = _Conversation(key)
            if kind == 1:
                now.edits, now.offset = edits, 0
            elif kind == 2:
                done = listed(now.row(timed, turn, role, text, code, fault))
                if edits_wanted:
                    out += done
        yield out
    if now is not None:
        last = listed(now.end())
        yield last if edits_wanted else [now.report()]


def repair(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The edits of every conversation: ``conv_id``, ``number`` (from 1), ``edit`` (K, R, D or I), ``role`` and ``text``.

    Without the rows of edit D this is the repaired conversation, in order of ``number``.
    """
    kind = conversations.schema["conv_id"].dataType
    followed = _followed(materialise(marked(conversations), "conversation-rows"), None, chunk)
    names = ["key", "number", "edit", "role", "text"]
    edits = followed.mapInPandas(lambda batches: (pd.DataFrame(out, columns=names) for out in _stream(batches, True)), "key string, number long, edit string, role string, text string")
    return edits.select(id_value(F.col("key"), kind).alias("conv_id"), *names[1:])


def report(conversations: DataFrame, ids: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """Per conversation the faults found, the cost and letters of its edits, and a digest of the repaired rows.

    ``ids`` names conversations in ``conv_id`` that are reported even if they have no row left: with zeros, an empty
    audit and the digest of the empty text.
    """
    kind = conversations.schema["conv_id"].dataType
    followed = _followed(materialise(marked(conversations), "conversation-rows"), ids, chunk)
    schema = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    found = followed.mapInPandas(lambda batches: (pd.DataFrame(out, columns=["key", *_REPORT]) for out in _stream(batches, False)), schema)
    return found.select(id_value(F.col("key"), kind).alias("conv_id"), *_REPORT)
