"""Chat formatting of conversations with many turns."""

import time

from pyspark.sql import functions as F

from coldshelf.llm import chat


def long_conversation(spark, turns):
    role = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
    text = F.concat(F.lit("turn # "), "id", F.lit(" says <this> \\ "), F.repeat(F.lit("é"), (F.col("id") % 40).cast("int")))
    return spark.range(turns).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), text.alias("text"))


def test_many_turns(spark):
    turns = long_conversation(spark, 3000)
    found = chat.read_back(chat.formatted(turns)).first()
    rows = turns.orderBy("turn").collect()
    assert [tuple(t) for t in found.turns] == [(r.role, r.text) for r in rows]
    assert found.replies == [r.text for r in rows if r.role == "assistant"]


def test_the_work_grows_with_the_turns(spark):
    chat.read_back(chat.formatted(long_conversation(spark, 100))).collect()
    started = time.perf_counter()
    chat.read_back(chat.formatted(long_conversation(spark, 1600))).collect()
    assert time.perf_counter() - started < 5


def test_examples_hold_their_context(spark):
    formatted = chat.formatted(long_conversation(spark, 7))
    whole = formatted.first().text
    found = chat.expanded(formatted).orderBy("example").collect()
    assert [r.target_turn for r in found] == [1, 3, 5] and [r.example for r in found] == [0, 1, 2]
    for r in found:
        assert whole.startswith(r.text) and r.text.endswith(chat.TAIL)
        assert r.text[r.loss_end :] == chat.TAIL and r.text[: r.loss_start].endswith(chat.HEAD + "assistant" + chat.MIDDLE)


def test_arrays_are_made_once(spark):
    plan = chat.read_back(chat.formatted(long_conversation(spark, 5)))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
