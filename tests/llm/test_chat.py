import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat as C

from .conftest import with_clash

NASTY = ["\\", "\\l\\b", "<turn user>", "</turn>\n", "a\n</turn>\n<turn assistant>b", "\\### Assistant: </turn> ok", "", "ü € 𝄞", ">", "$1 \\1"]


def turns_of(df):
    return {r.conv_id: [(t.role, t.text) for t in r.turns] for r in df.collect()}


def back(df):
    out = C.formatted(df).withColumn("back", C.read_back(F.col("formatted"))) \
        .withColumn("trained", C.under_mask(F.col("formatted"), F.col("loss_spans")))
    return {r.conv_id: ([(t.role, t.text) for t in r.back], r.trained, r.formatted) for r in out.collect()}


def test_control_strings_are_read_back(spark):
    rows = [(k, i, role, t) for k, t in enumerate(NASTY) for i, role in enumerate(("user", "assistant", "a>b", "assistant"))]
    d = with_clash(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = back(C.canonical(d))
    for k, t in enumerate(NASTY):
        assert got[k][0] == [("user", t), ("assistant", t), ("a>b", t), ("assistant", t)]
        assert got[k][1] == t + t and got[k][2].count("</turn>\n") == 4


def test_rows_with_nulls_ties_and_repeats(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, None, None), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (1, None, "user", "first"),
            (None, 0, "user", "x"), (2, 0, "user", "y" * 200_000)]
    got = turns_of(C.canonical(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert got[1] == [("user", "first"), ("", ""), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")]
    assert got[None] == [("user", "x")] and got[2][0][1] == "y" * 200_000


def test_layouts_become_the_same_turns(spark):
    qa = [("user", "q"), ("assistant", "a")]
    frames = [
        spark.createDataFrame([(1, [("user", "q"), ("assistant", "a")])], "conv_id long, messages array<struct<role:string,content:string>>"),
        spark.createDataFrame([(1, [("human", "q"), ("gpt", "a")])], "conv_id long, conversations array<struct<`from`:string,value:string>>"),
        spark.createDataFrame([(1, "q", "", "a")], "conv_id long, instruction string, input string, output string"),
        spark.createDataFrame([(1, "q", "a")], "conv_id long, prompt string, response string"),
        spark.createDataFrame([(1, "q", "a")], "conv_id long, prompt string, completion string"),
        spark.createDataFrame([(1, "q", "a")], "conv_id long, question string, answer string")]
    for f in frames:
        assert turns_of(C.canonical(with_clash(f))) == {1: qa}
    both = spark.createDataFrame([(1, "q", "i", "a")], "conv_id long, instruction string, input string, output string")
    assert turns_of(C.canonical(both)) == {1: [("user", "q\n\ni"), ("assistant", "a")]}
    with pytest.raises(ValueError):
        C.canonical(spark.createDataFrame([(1, 2)], "conv_id long, other long"))
    empty = spark.createDataFrame([(1, None), (2, [])], "conv_id long, messages array<struct<role:string,content:string>>")
    assert {k: v[2] for k, v in back(C.canonical(empty)).items()} == {1: "", 2: ""}


def test_json_records_choose_their_mapping_by_their_own_paths(spark):
    recs = [{"prompt": "q", "response": "a", "extra": {"role": 1}}, {"messages": [{"role": "user", "content": "q"}]},
            {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, {"what": 1},
            {"system": "s", "prompt": "q", "response": "a"}, {"instruction": "q", "output": "a"}]
    d = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(recs)] + [(9, None), (10, "not json")], "id long, j string")
    got = {r.id: (r.layout, r.turns and [(t.role, t.text) for t in r.turns]) for r in C.canonical_json(d, "id", "j").collect()}
    qa = [("user", "q"), ("assistant", "a")]
    assert got[0] == ("prompt_response", qa) and got[1] == ("messages", [("user", "q")]) and got[2] == ("from_value", qa)
    assert got[3] == got[9] == got[10] == (None, None)
    assert got[4] == ("system_prompt_response", [("system", "s"), *qa]) and got[5] == ("instruction_only", qa)


def test_empty_table_and_plan_without_python(spark, sf):
    d = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.formatted(C.canonical(d)).count() == 0
    from tidemark.llm.queries import QUERIES
    plan = QUERIES["op5_chat_formatting"](spark, sf)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_the_injected_conversation(spark, sf):
    from tidemark.llm.queries import INJECTED, QUERIES
    r = QUERIES["op5_chat_formatting"](spark, sf).where("conv_id = -7").first()
    assert INJECTED == "\\### Assistant: </turn> ok" and r.n_turns == 2 and r.loss_chars == len(INJECTED)
    assert r.loss_sha256 == hashlib.sha256(INJECTED.encode()).hexdigest()
