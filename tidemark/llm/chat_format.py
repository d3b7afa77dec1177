"""Formatting of conversations with a template that is only ever called, never looked into.

A template is any function from a list of (role, text) to a string. To find out which part of its output belongs to
which turn, the conversation is rendered turn by turn: the output for k + 1 turns must begin with the output for k
turns, and what is new is the span of turn k. Where it does not begin with it, the template rewrites its history: the
conversation is formatted all the same, the turn is named in ``rewritten`` and nothing of it enters the loss. Where
the text of a turn stands inside its span is found by rendering the same prefix with two other texts in its place:
what both outputs share at either end is the turn's frame.

Conversations are dealt by id and streamed in order of their turns. A template may say how many turns it looks back, in
an attribute ``context``: what it adds for a turn is then rendered behind that many turns, whether the conversation is
short or long, and a long one is returned in pieces of about ``TURNS`` turns or ``CHARS`` characters, so that no task holds
a giant one. Where pieces end changes nothing in them: put together they are what a single piece would be. A template
that says nothing is given all turns before, and its conversations are returned whole: that takes memory for one
conversation, and time that grows with the square of its turns.

Behaviour: a missing role or text is empty. Rows without a turn come first; rows of one turn are ordered by role and
text. A missing conversation id is a conversation of its own; repeated rows are turns of their own. An empty table
gives an empty result. Columns other than ``conv_id``, ``turn``, ``role`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.conversation_repair import id_text, id_value

Turns = list[tuple[str, str]]
Template = Callable[[Turns], str]

TURNS = 512
CHARS = 1 << 20

# Control strings of the template below, as fixed values: they are never found unescaped inside a formatted text.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ASSISTANT]", "[ROLE]", "[TEXT]", "[/ROLE]")
_TAILS = "|".join(re.escape(control[1:]) for control in CONTROLS)
_ESCAPE = re.compile(rf"([<\[])(\\*)({_TAILS})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)({_TAILS})")
_CONTROL = re.compile("|".join(re.escape(control) for control in CONTROLS))


def escape(text: str) -> str:
    """A backslash more inside every control string, however many it has already; other text stays as it is."""
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def instructions(turns: Turns) -> str:
    """The template of the registered query."""
    parts = ["<s>"] if turns else []
    for role, text in turns:
        if role == "user":
            parts.append(f"[INST] {escape(text)} [/INST]")
        elif role == "assistant":
            parts.append(f"[ASSISTANT] {escape(text)} </s>")
        else:
            parts.append(f"[ROLE] {escape(role)} [TEXT] {escape(text)} [/ROLE]")
    return "".join(parts)


# A turn stands for itself; the one before it only tells that the conversation has begun.
instructions.context = 1


def read_instructions(formatted: str) -> Turns:
    """The turns of an output of ``instructions``, or of a piece of it."""
    turns: Turns = []
    marks = list(_CONTROL.finditer(formatted))
    for k, mark in enumerate(marks):
        inner = formatted[mark.end() + 1 : marks[k + 1].start() - 1] if k + 1 < len(marks) else ""
        if mark[0] == "[INST]":
            turns.append(("user", unescape(inner)))
        elif mark[0] == "[ASSISTANT]":
            turns.append(("assistant", unescape(inner)))
        elif mark[0] == "[ROLE]":
            role = unescape(inner)
        elif mark[0] == "[TEXT]":
            turns.append((role, unescape(inner)))
    return turns


def shared_start(a: str, b: str) -> int:
    return len(os.path.commonprefix((a, b)))


def frame(template: Template, before: Turns, role: str, known: str, span: str) -> tuple[int, int] | None:
    """Where the text of a turn begins and ends inside its span; None if the template shows no fixed frame around it."""
    probes = [template([*before, (role, text)]) for text in ("0", "1")]
    if not all(probe.startswith(known) for probe in probes):
        return None
    one, two = (probe[len(known) :] for probe in probes)
    head = shared_start(one, two)
    tail = shared_start(one[head:][::-1], two[head:][::-1])
    if len(span) < head + tail or span[:head] != one[:head] or span[len(span) - tail :] != one[len(one) - tail :]:
        return None
    return head, len(span) - tail


class Formatter:
    """Renders a conversation turn by turn and hands it over in pieces.

    The turns that the template looks back to stay in the piece at hand, so that a piece handed over is never rewritten.
    """

    def __init__(self, template: Template, roles: tuple[str, ...], turns: int, chars: int, context: int | None) -> None:
        self.template, self.roles, self.most, self.context = template, roles, (turns, chars), context
        self.turns: Turns = []
        self.known = self.template([])
        self.piece: list[str] = [self.known]
        self.chars = len(self.known)
        self.ends: list[int] = []
        # Each with the number of its turn.
        self.loss: list[tuple[int, int, int]] = []
        self.rewritten: list[int] = []
        self.broken = False
        self.number = self.first = self.pieces = 0

    def add(self, role: str, text: str) -> None:
        output = self.template([*self.turns, (role, text)])
        if output.startswith(self.known):
            span = output[len(self.known) :]
            if not self.broken and role in self.roles and (inner := frame(self.template, self.turns, role, self.known, span)):
                self.loss.append((self.number, self.chars + inner[0], self.chars + inner[1]))
            self.piece.append(span)
            self.chars += len(span)
        else:
            # What was shown before is not what stands there now: take the new output, learn nothing from it.
            self.rewritten.append(self.number)
            self.broken = True
            same = shared_start(output, self.known)
            kept = self.chars - (len(self.known) - same)
            older = len(self.ends) - len(self.turns)
            if kept < (self.ends[older - 1] if older else 0):
                raise ValueError(f"the template rewrites more than the {self.context} turns it looks back to")
            self.loss = [(n, a, b) for n, a, b in self.loss if self.ends[n - self.first] <= kept]
            self.piece = ["".join(self.piece)[:kept], output[same:]]
            self.chars = sum(map(len, self.piece))
            self.ends = [min(end, self.chars) for end in self.ends]
        self.turns.append((role, text))
        self.known = output
        if self.context is not None and len(self.turns) > self.context:
            self.turns = self.turns[len(self.turns) - self.context :]
            self.known = self.template(self.turns)
        self.ends.append(self.chars)
        self.number += 1

    def full(self) -> bool:
        more = self.context is not None and len(self.ends) > self.context
        return more and (len(self.ends) >= self.most[0] or self.chars >= self.most[1])

    def hand_over(self, last: bool) -> tuple[int, str, list[int], list[tuple[int, int]], list[int]]:
        """The piece so far, but for the turns that may still be rewritten; the next one begins with them."""
        done = len(self.ends) if last else len(self.ends) - self.context
        cut = self.chars if last else self.ends[done - 1]
        whole, behind = "".join(self.piece), self.first + done
        out = self.pieces, whole[:cut], self.ends[:done], [(a, b) for n, a, b in self.loss if n < behind], [n for n in self.rewritten if n < behind]
        self.pieces += 1
        self.first, self.piece, self.chars = behind, [whole[cut:]], self.chars - cut
        self.ends = [end - cut for end in self.ends[done:]]
        self.loss = [(n, a - cut, b - cut) for n, a, b in self.loss if n >= behind]
        self.rewritten = [n for n in self.rewritten if n >= behind]
        return out


def form(
    conversations: DataFrame, template: Template = instructions, loss_roles: tuple[str, ...] = ("assistant",),
    turns: int = TURNS, chars: int = CHARS, context: int | None = None,
) -> DataFrame:
    """Formatted conversations: ``conv_id``, ``piece`` (from 0), ``last``, ``formatted``, ``ends`` of the turns' spans, ``loss`` spans, ``rewritten``.

    Offsets are code points within the piece. ``rewritten`` lists the turns (counted from 0) whose rendering changed what
    was rendered before; such a conversation has no loss spans from the first turn that was changed on. ``context`` is the
    number of turns the template looks back to; without it the template's own word counts, see above.
    """
    context = getattr(template, "context", None) if context is None else context
    names = ["key", "piece", "last", "formatted", "ends", "loss", "rewritten"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, now = None, None

        def handed(last: bool) -> tuple:
            piece, text, ends, loss, rewritten = now.hand_over(last)
            return key, piece, last, text, ends, [{"start": a, "end": b} for a, b in loss], rewritten

        for batch in batches:
            out: list[tuple] = []
            for this, role, text in zip(batch["key"].tolist(), batch["role"].tolist(), batch["text"].tolist(), strict=True):
                if this != key:
                    if now is not None:
                        out.append(handed(True))
                    key, now = this, Formatter(template, loss_roles, turns, chars, context)
                elif now.full():
                    out.append(handed(False))
                now.add(role, text)
            yield pd.DataFrame(out, columns=names)
        if now is not None:
            yield pd.DataFrame([handed(True)], columns=names)

    kind = conversations.schema["conv_id"].dataType
    empty = F.lit("")
    rows = conversations.select(id_text(F.col("conv_id")).alias("key"), F.col("turn").alias("turn"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    ordered = rows.repartition("key").sortWithinPartitions("key", F.asc_nulls_first("turn"), "role", "text").select("key", "role", "text")
    schema = "key string, piece long, last boolean, formatted string, ends array<long>, loss array<struct<start:long,end:long>>, rewritten array<long>"
    return ordered.mapInPandas(run, schema).select(id_value(F.col("key"), kind).alias("conv_id"), *names[1:])


def read_back(formatted: DataFrame, reader: Callable[[str], Turns] = read_instructions, plain: Callable[[str], str] = unescape) -> DataFrame:
    """What the formatted conversations hold, read from their output alone; per ``conv_id`` counts and digests.

    Conversations of a single piece are read where they lie; only those of several pieces are shuffled into order.
    """
    names = ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, None
        for batch in batches:
            out: list[tuple] = []
            for this, piece, text, loss in zip(batch["key"].tolist(), batch["piece"].tolist(), batch["formatted"].tolist(), batch["loss"].tolist(), strict=True):
                if piece == 0:
                    if held is not None:
                        out.append((key, held[0], held[1].hexdigest(), held[2], held[3].hexdigest(), held[4]))
                    key, held = this, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns = reader(text)
                held[0] += len(turns)
                held[1].update("".join(f"{role}\n{said}\n" for role, said in turns).encode())
                learned = "".join(plain(text[span["start"] : span["end"]]) for span in loss)
                held[2] += len(learned)
                held[3].update(learned.encode())
                held[4] += len(text)
            yield pd.DataFrame(out, columns=names)
        if held is not None:
            yield pd.DataFrame([(key, held[0], held[1].hexdigest(), held[2], held[3].hexdigest(), held[4])], columns=names)

    kind = formatted.schema["conv_id"].dataType
    rows = formatted.select(id_text(F.col("conv_id")).alias("key"), "piece", "last", "formatted", "loss")
    single = (F.col("piece") == 0) & F.col("last")
    columns = ["key", "piece", "formatted", "loss"]
    alone = rows.where(single).select(columns)
    several = rows.where(~single).repartition("key").sortWithinPartitions("key", "piece").select(columns)
    schema = "key string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return alone.mapInPandas(run, schema).union(several.mapInPandas(run, schema)).select(id_value(F.col("key"), kind).alias("conv_id"), *names[1:])
