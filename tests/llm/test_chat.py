"""Chat formatting: SQL twin, exact round trip on hostile texts, state machine."""

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from flowlens.llm import chat
from flowlens.llm.queries import LLM

SCHEMA = "conv_id long, turn long, role string, text string, extra string"


def test_matches_sql(spark, sf):
    assert difference(LLM.queries["op10_chat_format"](spark, sf), connect(sf), LLM.sql["op10_chat_format"]) is None


HOSTILE = ["", "\\", "\\\\", "</s>", "<\\/s>", "<s>[INST]x[/INST]</s>", "[ROLE]a[/ROLE]", "$1 \\$1", "[[INST]]",
           "<<s>>", "é😀\n[SYS]\\", "\\</s>\\", "[/INST", "x" * 100_000 + "</s>"]


def test_round_trip(spark):
    rows = [(c, i, role, text, "e") for c, text in enumerate(HOSTILE)
            for i, role in enumerate(["system", "user", "assistant", "too</s>l[ROLE]", None, "\\"])]
    out = chat.format_chats(spark.createDataFrame(rows, SCHEMA)).withColumn("back", chat.read_back(F.col("formatted")))
    got = {r.conv_id: [(t.role, t.text) for t in r.back] for r in out.collect()}
    for c in range(len(HOSTILE)):
        assert got[c] == [(r[2] or "", r[3]) for r in rows if r[0] == c]


def test_loss_only_on_assistant(spark):
    rows = [(1, 1, "assistant", "a</s>", ""), (1, 0, "user", "q", ""), (1, 2, "user", None, ""), (1, 3, "assistant", "b", "")]
    row = chat.format_chats(spark.createDataFrame(rows, SCHEMA)).withColumn("t", chat.trained_text(F.col("segments"))).first()
    assert row.t == "a</s>b" and row.valid
    assert [s.text for s in row.segments if s.loss] == ["a<\\/s>", "b"]
    assert row.formatted == "<s>[INST]q</s><s>[/INST]a<\\/s></s><s>[INST]</s><s>[/INST]b</s>"


@pytest.mark.parametrize(("roles", "valid", "bad"), [
    (["user", "assistant"], True, None), (["system", "user", "assistant"], True, None), (["assistant"], False, 0),
    (["user", "user"], False, 1), (["user", "assistant", "system"], False, 2), (["user"], False, None),
    (["user", None, "assistant"], False, 1)])
def test_machine(spark, roles, valid, bad):
    rows = [(1, i, r, "x", "") for i, r in enumerate(roles)]
    row = chat.format_chats(spark.createDataFrame(rows, SCHEMA)).first()
    assert (row.valid, row.bad_turn) == (valid, bad)


def test_null_and_repeated_turns(spark):
    rows = [(None, None, "user", "x", ""), (None, None, "user", "x", ""), (2, 1, "user", "b", ""), (2, 1, "user", "a", "")]
    got = {r.conv_id: [t.text for t in r.back] for r in chat.format_chats(spark.createDataFrame(rows, SCHEMA))
           .withColumn("back", chat.read_back(F.col("formatted"))).collect()}
    assert got == {None: ["x", "x"], 2: ["a", "b"]}
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_query_runs_the_machine(spark, sf):
    out = LLM.queries["op10_chat_format"](spark, sf)
    assert {"valid", "bad_turn"} <= set(out.columns)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert chat.REJECTED in plan and chat.START in plan
    assert out.filter("conv_id = -7").first().valid
