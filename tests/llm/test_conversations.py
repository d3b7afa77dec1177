"""Formatting and repair of conversations against plain versions."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re

import check as twins
import pytest

from tidemark.llm import chat_format, conversation_repair
from tidemark.llm.queries import QUERIES, SQL, damaged

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, key string, place long, kind long, fault long, number long"
LEGAL = re.compile("(s?(ua)+)?")


@pytest.mark.parametrize("name", ["op11_chat_format", "op12_conversation_repair"])
def test_queries_equal_sql(spark, name):
    df, result = QUERIES[name](spark, SMALL), twins.database(SMALL).execute(SQL[name])
    want = twins.normal([c[0] for c in result.description], result.fetchall())
    assert twins.normal(df.columns, [tuple(r) for r in df.collect()]) == want and want


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 1, 1, 1) for r in rows], SCHEMA)


# Formatting


def test_escaping_is_reversible_and_hides_every_control_string():
    rng = random.Random(1)
    parts = [*chat_format.CONTROLS, "\\", "\\\\", "[", "<", "]", " ", "a", "[\\INST]", "é\n"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 7)))
        hidden = chat_format.escape(text)
        assert chat_format.unescape(hidden) == text
        assert not any(control in hidden for control in chat_format.CONTROLS)
    assert chat_format.escape("a[0] <b> \\n") == "a[0] <b> \\n"


def test_template_reads_back():
    rng = random.Random(2)
    texts = ["", " ", "[INST] x [/INST]", "</s>", "a\nb", "[", "\\"]
    for _ in range(500):
        turns = [(rng.choice(["user", "assistant", "system", "", "[TEXT]"]), rng.choice(texts)) for _ in range(rng.randint(0, 6))]
        assert chat_format.read_instructions(chat_format.instructions(turns)) == turns


def odd_rows():
    return [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 2, "user", None), (1, 3, "assistant", None), (1, None, "system", "s"),
        (None, 0, None, "x"), (None, 0, None, "x"), (2, 0, "assistant", "[/INST]</s>" * 3), (3, 0, "user", "long " * 200_000), (3, 1, "assistant", "ü" * 500_000),
    ]


def test_spans_and_loss_of_odd_conversations(spark):
    found = {r.conv_id: r for r in chat_format.form(frame(spark, odd_rows())).collect() if r.piece == 0 and r.conv_id != 3}
    one = found[1]
    pieces = [one.formatted[a:b] for a, b in itertools.pairwise([0, *one.ends])]
    assert pieces == ["<s>[ROLE] system [TEXT] s [/ROLE]", "[INST] a [/INST]", "[ASSISTANT] b </s>", "[INST]  [/INST]", "[ASSISTANT]  </s>"]
    assert [one.formatted[s.start : s.end] for s in one.loss] == ["b", ""] and one.rewritten == []
    assert len(found[None].ends) == 2
    assert chat_format.unescape(found[2].formatted[found[2].loss[0].start : found[2].loss[0].end]) == "[/INST]</s>" * 3
    assert chat_format.form(frame(spark, [])).collect() == []


def test_read_back_of_odd_conversations(spark):
    rows = odd_rows()
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.form(frame(spark, rows))).collect()}
    for conv in (None, 1, 2, 3):
        mine = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        said = [x for *_, r, x in mine if r == "assistant"]
        assert got[conv].n_turns == len(mine)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in mine).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len("".join(said)), hashlib.sha256("".join(said).encode()).hexdigest())


def test_long_conversations_in_pieces_equal_the_whole(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {c} {t} </s>") for c in (1, 2) for t in range(90)]
    whole = {r.conv_id: r for r in chat_format.form(frame(spark, rows)).collect()}
    assert len(whole) == 2
    for turns, chars, context in ((7, 1 << 20, 3), (50, 100, 2), (2, 10, 1)):
        pieces = chat_format.form(frame(spark, rows), turns=turns, chars=chars, context=context)
        for conv in (1, 2):
            mine = sorted((r for r in pieces.collect() if r.conv_id == conv), key=lambda r: r.piece)
            assert len(mine) > 5 and [r.last for r in mine] == [False] * (len(mine) - 1) + [True]
            assert "".join(r.formatted for r in mine) == whole[conv].formatted
            assert [r.formatted[s.start : s.end] for r in mine for s in r.loss] == [whole[conv].formatted[s.start : s.end] for s in whole[conv].loss]
        left, right = (sorted(map(tuple, chat_format.read_back(f).collect())) for f in (pieces, chat_format.form(frame(spark, rows))))
        assert left == right


def test_templates_that_rewrite_history_are_found(spark):
    def forgetful(turns):
        last = max((k for k, (role, _) in enumerate(turns) if role == "assistant"), default=-1)
        return "".join(f"<{role}>{text if role != 'assistant' or k == last else '...'}</>" for k, (role, text) in enumerate(turns))

    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (2, 0, "user", "a"), (2, 1, "assistant", "b")]
    found = {r.conv_id: r for r in chat_format.form(frame(spark, rows), template=forgetful).collect()}
    assert found[1].rewritten == [3] and found[1].loss == [] and found[1].formatted == "<user>a</><assistant>...</><user>c</><assistant>d</>"
    assert found[2].rewritten == [] and [found[2].formatted[s.start : s.end] for s in found[2].loss] == ["b"]


def test_long_conversations_are_rendered_like_short_ones(spark):
    def numbered(turns):
        return "".join(f"<{k} {role}>{text}</>" for k, (role, text) in enumerate(turns))

    def unsure(turns):
        # The assistant's last word is open until the next turn is there.
        last = len(turns) - 1
        return "".join(f"<{role}>{text}{'?' if k == last and role == 'assistant' else ''}</>" for k, (role, text) in enumerate(turns))

    rows = [(1, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(chat_format.TURNS + 40)]
    # A template that says nothing of its context sees all turns, however many there are.
    (whole,) = chat_format.form(frame(spark, rows), template=numbered).collect()
    assert whole.formatted == numbered([r[2:] for r in rows])
    assert [whole.formatted[s.start : s.end] for s in whole.loss] == [r[3] for r in rows if r[2] == "assistant"]

    # Rewritten turns: pieces of any size are one result.
    rows = [(1, t, "assistant" if t > 20 and t % 3 == 0 or t == 4 else "user", f"t{t}") for t in range(60)]
    for start in (0, 5):
        (whole,) = chat_format.form(frame(spark, rows[start:]), template=unsure).collect()
        first = next(k for k, r in enumerate(rows[start:]) if r[2] == "assistant")
        assert whole.formatted == unsure([r[2:] for r in rows[start:]]) and whole.rewritten[0] == first + 1 and whole.loss == []
        for turns, chars, context in ((3, 1 << 20, 1), (9, 1 << 20, 4), (50, 30, 2)):
            mine = sorted(chat_format.form(frame(spark, rows[start:]), template=unsure, turns=turns, chars=chars, context=context).collect(), key=lambda r: r.piece)
            assert len(mine) > 5 and "".join(r.formatted for r in mine) == whole.formatted
            assert [n for r in mine for n in r.rewritten] == whole.rewritten and not any(r.loss for r in mine)


def test_spans_before_a_rewritten_turn_stay_in_the_loss_in_pieces_of_any_size(spark):
    def closing(turns):
        # The fifteenth turn, and it alone, changes the one before it.
        return "".join(f"<{role}>{'...' if k + 2 == len(turns) == 15 else text}</>" for k, (role, text) in enumerate(turns))

    rows = [(1, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(15)]
    found = []
    for turns, context in ((512, None), (15, 14), (512, 14)):
        mine = sorted(chat_format.form(frame(spark, rows), template=closing, turns=turns, context=context).collect(), key=lambda r: r.piece)
        found.append(("".join(r.formatted for r in mine), [r.formatted[s.start : s.end] for r in mine for s in r.loss], [n for r in mine for n in r.rewritten]))
    assert found[0] == found[1] == found[2]
    assert found[0][1:] == ([f"t{t}" for t in range(1, 13, 2)], [14])

    def recounted(turns):
        return f"{len(turns)}:" + "".join(f"<{role}>{text}</>" for role, text in turns)

    with pytest.raises(Exception, match="rewrites more than the 2 turns"):
        chat_format.form(frame(spark, rows), template=recounted, context=2).collect()


def test_template_without_a_fixed_frame_gives_no_loss(spark):
    def counting(turns):
        return "".join(f"{len(text)}:{role}:{text};" for role, text in turns)

    (found,) = chat_format.form(frame(spark, [(1, 0, "assistant", "ten")]), template=counting).collect()
    assert found.formatted == "3:assistant:ten;" and found.loss == []


# Repair


def brute_edits(rows):
    """Cheapest and then ASCII-least letters by a search over all edit strings; rows are (role, text, fault)."""
    heap = [(0, "", 0, "", ())]
    seen = set()
    while True:
        cost, audit, at, roles, out = heapq.heappop(heap)
        if at == len(rows) and LEGAL.fullmatch(roles):
            return cost, audit, "\n".join(f"{r}:{t}" for r, t in out)
        state = (at, roles[-1:], len(roles) > 1)
        if (state, cost, audit) in seen or cost > 60:
            continue
        seen.add((state, cost, audit))
        options = [("I", 3, at, role, "") for role in ("user", "assistant")]
        if at < len(rows):
            role, text, fault = rows[at]
            options.append(("D", 4, at + 1, None, None))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                options.append(("K", extra, at + 1, role, text))
                options += [("R", 3 + extra, at + 1, to, text) for to in ("user", "assistant")]
        for letter, more, to, role, text in options:
            longer = roles if role is None else roles + (role[:1] or "?")
            if role is None or re.fullmatch("s?(ua)*u?", longer):
                heapq.heappush(heap, (cost + more, audit + letter, to, longer, out if role is None else (*out, (role, text))))


def judged(rows):
    """Rows of a conversation in order, with their first faults."""
    out, seen = [], set()
    for _, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        solid = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def random_rows(rng, conv):
    rows = []
    for turn in range(rng.randint(0, 6)):
        role, text = rng.choice(["user", "assistant", "system", "tool", " "]), rng.choice(["a.", "b", "", " \n", "c!  ", "é?", "d"])
        rows += [(conv, rng.choice([turn, turn, None, 9]), role, text)] * rng.choice([1, 1, 1, 2])
    return rows


def test_reports_equal_an_exhaustive_search(spark):
    rng = random.Random(7)
    by_conv = {conv: random_rows(rng, conv) for conv in range(160)}
    table = frame(spark, [r for rows in by_conv.values() for r in rows])
    ids = spark.createDataFrame([(c,) for c in by_conv] * 2, "conv_id long")
    for chunk in (1, 3, 65_536):
        got = {r.conv_id: r for r in conversation_repair.report(table, ids=ids, chunk=chunk).collect()}
        assert got.keys() == by_conv.keys()
        for conv, rows in by_conv.items():
            found = judged([r[1:] for r in rows])
            turns = [r[1] for r in rows if r[1] is not None]
            cost, audit, text = brute_edits(found)
            row, initials = got[conv], [r[0][:1] for r in found]
            assert (row.cost, row.audit, row.repaired_sha256) == (cost, audit, hashlib.sha256(text.encode()).hexdigest()), (conv, found)
            assert row.gaps == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
            assert [row.blank, row.duplicate, row.truncated] == [sum(f[2] == kind for f in found) for kind in ("blank", "duplicate", "truncated")]
            assert row.illegal == sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))


def test_edits_are_the_repaired_conversation(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 1, "user", "b."), (None, 0, "assistant", "x."), (2, 0, None, None), (1, None, "system", "s.")]
    edits = conversation_repair.repair(frame(spark, rows)).collect()
    by_conv = {conv: sorted((r.number, r.edit, r.role, r.text) for r in edits if r.conv_id == conv) for conv in (1, 2, None)}
    assert by_conv[1] == [(1, "K", "system", "s."), (2, "K", "user", "a."), (3, "R", "assistant", "b."), (4, "D", "user", "b.")]
    assert by_conv[2] == [(1, "D", " ", " ")]
    assert by_conv[None] == [(1, "D", "assistant", "x.")] or by_conv[None] == [(1, "I", "user", ""), (2, "K", "assistant", "x.")]
    assert conversation_repair.repair(frame(spark, [])).collect() == []
    assert conversation_repair.report(frame(spark, [])).collect() == []


def test_long_conversation_passes_many_batches_and_chunks(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        rows = [(1, t, ["user", "assistant"][t % 2] if t % 7 else "user", f"text {t % 90}." if t % 5 else f"open {t}") for t in range(700)]
        found = judged([r[1:] for r in rows])
        costs, best = conversation_repair._END, []
        for role, _, fault in reversed(found):
            costs, edits = conversation_repair.step(costs, "sua".index(role[0]), ["", "truncated", "blank", "duplicate"].index(fault))
            best.append(edits)
        a, b = (conversation_repair.report(frame(spark, rows), chunk=chunk).collect()[0] for chunk in (64, 65_536))
        assert a == b and a.cost == costs[0] and LEGAL.fullmatch("".join(r.role[0] for r in sorted(conversation_repair.repair(frame(spark, rows), chunk=64).collect(), key=lambda r: r.number) if r.edit != "D"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_damage_is_by_hash_of_id_and_turn(spark):
    import zlib

    rows = [(c, t, "system", "a. b! c") for c in (None, 1, 2) for t in (None, *range(30))]
    want = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        made = (conv, turn, "user" if kind == 4 else role, {1: "", 2: "a b c"}.get(kind, text))
        want += [made] * {0: 0, 3: 2}.get(kind, 1)
    assert sorted(map(tuple, damaged(frame(spark, rows)).collect()), key=repr) == sorted(want, key=repr)
