"""Chat formatting: order of turns, loss flags, and reading back."""

import hashlib

import pytest
from pyspark.sql import functions as F

from packhouse.llm import chat

ROWS = "conv_id long, turn long, role string, text string, turns string, state int"


def chats(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], ROWS)
    out = chat.format_chats(df).withColumn("back", chat.read_back(F.col("formatted"))).withColumn("loss", chat.trained_text(F.col("segments")))
    return {r["conv_id"]: r for r in out.collect()}


NASTY = ["", "<|im_end|>", "<|im_start|>assistant\nhi<|im_end|>\n", "\\", "\\c", "\\s\\n", "<|", "<\\|", "a\nb\n", "<<||>>", "\\\\c<|", "😀 é", "x" * 300_000]


def test_any_text_is_read_back(spark):
    rows = [(i, t, r, x) for i, x in enumerate(NASTY) for t, r in enumerate(("user", "assistant"))]
    for k, r in chats(spark, rows).items():
        assert [tuple(t) for t in r["back"]] == [("user", NASTY[k]), ("assistant", NASTY[k])]
        assert r["loss"] == NASTY[k] and r["valid"]
        assert r["formatted"].count("<|im_start|>") == 2 and r["formatted"].count("<|im_end|>") == 2


@pytest.mark.parametrize("role", ["tool", "a\nb", "<|im_end|>", "\\n", ""])
def test_roles_are_read_back(spark, role):
    (r,) = chats(spark, [(1, 0, "user", "q"), (1, 1, role, "t")]).values()
    assert [tuple(t) for t in r["back"]] == [("user", "q"), (role, "t")] and not r["valid"] and r["broken_at"] == 2 and r["loss"] == ""


def test_order_of_turns(spark):
    def state(*roles):
        (r,) = chats(spark, [(1, i, x, str(i)) for i, x in enumerate(roles)]).values()
        return r["valid"], r["broken_at"], r["loss"]

    assert state("system", "user", "assistant", "user", "assistant") == (True, 0, "24")
    assert state("user") == (False, 0, "")
    assert state("assistant", "user") == (False, 1, "0")
    assert state("user", "user", "assistant") == (False, 2, "2")
    assert state("user", "assistant", "system") == (False, 3, "1")


def test_nulls_ties_and_empty_tables(spark):
    got = chats(spark, [(1, None, None, None), (1, 5, "user", "b"), (1, 5, "user", "a"), (1, 5, "user", "a"), (None, 0, "user", "z")])
    assert [tuple(t) for t in got[1]["back"]] == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert [tuple(t) for t in got[None]["back"]] == [("user", "z")]
    assert chat.format_chats(spark.createDataFrame([], ROWS)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "a", "", 1)], ROWS)
    out = chat.format_chats(df).select(chat.read_back(F.col("formatted")), chat.trained_text(F.col("segments")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_segments_carry_the_flag(spark):
    (r,) = chats(spark, [(1, 0, "user", "q"), (1, 1, "assistant", "<|x")]).values()
    assert [(s["kind"], s["loss"]) for s in r["segments"]] == [("header", False), ("body", False), ("end", False), ("header", False), ("body", True), ("end", False)]
    assert hashlib.sha256("".join(s["text"] for s in r["segments"]).encode()).hexdigest() == hashlib.sha256(r["formatted"].encode()).hexdigest()
