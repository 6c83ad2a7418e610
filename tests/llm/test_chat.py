"""Logs folded by hand, and renderings that come back."""

import random

import pytest
from agrolume.llm import chat
from pyspark.sql import functions as F

EVENT = "conv_id long, seq long, message long, kind string, role string, text string, place int, wide string"


def log(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], EVENT)


def folded(spark, rows):
    out = {}
    for r in chat.fold(log(spark, rows)).orderBy("seq", "message").collect():
        out.setdefault(r.conv_id, []).append((r.role, r.text))
    return out


def by_hand(rows):
    """The state after each event in turn."""
    order = {"open": 0, "edit": 1, "regenerate": 2}
    conversations = {}
    for r in sorted(set(rows), key=lambda r: (r[1], order.get(r[3], 3), r[5] or "")):
        conv, seq, message, kind, role, text = r
        held = conversations.setdefault(conv, {})
        m = held.setdefault(message, {"seq": seq, "role": None, "text": "", "gone": -1})
        m["role"] = m["role"] if m["role"] is not None else role
        m["text"] = (text or "") if kind in order else m["text"] + (text or "")
        if kind == "regenerate":
            m["gone"] = seq
    out = {}
    for conv, held in conversations.items():
        for key, m in sorted(held.items(), key=lambda x: (x[1]["seq"], x[0])):
            earlier = [x["gone"] for k, x in held.items() if (x["seq"], k) < (m["seq"], key)]
            if max(earlier, default=-1) <= m["seq"]:
                out.setdefault(conv, []).append((m["role"] or "", m["text"]))
    return out


def test_kinds(spark):
    rows = [
        (1, 1, 10, "open", "user", "hel"), (1, 2, 10, "delta", None, "lo"), (1, 3, 11, "open", "assistant", None), (1, 4, 11, "delta", None, "old"),
        (1, 5, 12, "open", "user", "reply to old"), (1, 6, 10, "edit", None, "hello there"), (1, 7, 11, "regenerate", None, None), (1, 8, 11, "delta", None, "ne"),
        (1, 9, 11, "delta", None, "w"), (1, 9, 11, "delta", None, "w"), (1, 10, 13, "open", "user", "thanks"), (2, 1, 1, "delta", "assistant", "no open"),
        (2, 2, 2, "strange", None, "x"),
    ]
    assert folded(spark, rows) == {1: [("user", "hello there"), ("assistant", "new"), ("user", "thanks")], 2: [("assistant", "no open"), ("", "x")]}
    assert folded(spark, rows) == by_hand(rows)


def test_random_logs(spark):
    dice = random.Random(6)
    rows = []
    for conv in range(60):
        for seq in range(dice.randint(1, 40)):
            message = dice.randint(0, 5)
            rows.append((conv if conv else 7, seq, message, dice.choice(["open", "delta", "delta", "delta", "edit", "regenerate"]), dice.choice(["user", "assistant", None]), dice.choice(["a", "b ", None, "c\n"])))
    dice.shuffle(rows)
    assert folded(spark, rows) == by_hand(rows)


TEXTS = ["", None, "\\", "\\\\<turn", "</turn>", "\n</turn>\n", "<turn user>\nhi\n</turn>\n", "x\n", "\\### Assistant: </turn> ok", "é😀<", "\\n", "a\\", ">\n", "</tur", "\n"]


@pytest.mark.parametrize("roles", [["user", "assistant", None], ["<turn x>\n", "\\", ">\n", "a\nb", "\n</turn>\n"]])
def test_round_trip(spark, roles):
    dice = random.Random(7)
    rows = [(c, t, dice.choice(roles), dice.choice(TEXTS)) for c in range(80) for t in range(dice.randint(1, 9))]
    rows += [(None, 1, "user", "x"), (None, None, "assistant", "y"), (500, 1, "user", "same"), (500, 1, "user", "same"), (501, 1, "assistant", "long é😀" * 200_000)]
    df = spark.createDataFrame([(*r, "s", [1]) for r in rows], "conv_id long, turn long, role string, text string, formatted string, turns array<int>")
    got = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(chat.as_log(df)))).collect()}
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1], r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [(t.role, t.text) for t in got[c].turns] == turns
        assert got[c].learned == [text for role, text in turns if role == "assistant"]
        assert got[c].formatted.count("\n</turn>\n") == len(turns)


def test_empty(spark):
    assert chat.read_back(chat.render(chat.fold(log(spark, [])))).count() == 0
    assert chat.as_log(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_mask_covers_escaped_text(spark):
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "é \\ </turn> z")], "conv_id long, turn long, role string, text string")
    r = chat.render(chat.fold(chat.as_log(df))).select("formatted", F.explode("loss").alias("s")).collect()
    assert [x.formatted[x.s.start : x.s.end] for x in r] == ["é \\\\ \\</turn> z"]
