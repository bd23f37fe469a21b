"""Chat formatting: exact round trips and layouts."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from batchgate.llm import chat_format as C

PIECES = ["[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>", "[ROLE]", "[TEXT]", "[/ROLE]", "[", "<", "\\", "]", ">", "/", "a", "\n", "é", "", "\\\\", "INST]"]


def back(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = C.format_conversations(df.withColumns({"messages_extra": F.lit(1), "piece": F.lit("x"), "formatted": F.lit("y")}))
    return {r["conv_id"]: r for r in out.select("conv_id", "formatted", C.read_turns(F.col("formatted")).alias("turns"),
                                                C.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}


def test_round_trip_of_control_strings(spark):
    import random
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "[TEXT]", "", "<s>"]),
             "".join(rng.choice(PIECES) for _ in range(rng.randrange(12)))) for c in range(300) for t in range(rng.randrange(1, 5))]
    got = back(spark, rows)
    for c in range(300):
        want = [(r, t) for i, _, r, t in rows if i == c]
        assert [(x["role"], x["text"]) for x in got[c]["turns"]] == want
        assert got[c]["loss"] == "".join(t for r, t in want if r == "assistant")


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "first"), (2, 1, "assistant", "")]
    got = back(spark, rows)
    assert [(x["role"], x["text"]) for x in got[1]["turns"]] == [("", "first"), ("user", ""), ("user", "")]
    assert got[2]["loss"] == "" and got[2]["formatted"] == "<s></s>"


def test_empty_table_and_long_text(spark):
    assert back(spark, [(1, 0, "user", "x" * 2_000_000)])[1]["turns"][0]["text"] == "x" * 2_000_000
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.format_conversations(empty).count() == 0


LAYOUTS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, [("user", "q"), ("assistant", "a")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [("user", "q"), ("assistant", "a")]),
    ({"prompt": "q", "response": "a"}, [("user", "q"), ("assistant", "a")]),
    ({"instruction": "q", "input": "i", "output": "a"}, [("user", "q\n\ni"), ("assistant", "a")]),
    ({"instruction": "q", "output": "a", "other": 3}, [("user", "q"), ("assistant", "a")]),
]


def test_json_layouts_row_by_row(spark):
    rows = [(i, json.dumps(x)) for i, (x, _) in enumerate(LAYOUTS)] + [(90, "{\"strange\": 1}"), (91, "not json"), (92, None)]
    got = {r["conv_id"]: r["turns"] for r in C.turns_from_json(spark.createDataFrame(rows, "conv_id long, json string")).collect()}
    for i, (_, want) in enumerate(LAYOUTS):
        assert [(t["role"], t["text"]) for t in got[i]] == want
    assert got[90] is None and got[91] is None and got[92] is None


def test_json_rows_with_fields_of_other_layouts(spark):
    qa = [("user", "q"), ("assistant", "a")]
    cases = [
        ({"instruction": "q", "input": "", "output": "a", "text": "whole"}, qa),                          # Alpaca
        ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "prompt": "p"}, qa),
        ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "prompt": "p", "response": "r"}, qa),
        ({"prompt": "q", "response": "a", "role": "x", "turn": 1, "messages": "none", "completion": "c"}, qa),
        ({"messages": [{"role": "system"}, {"role": "user", "content": "q"}]}, [("system", ""), ("user", "q")]),
        ({"conversations": [{"from": "human"}, {"from": "gpt", "value": "a", "weight": 1}]}, [("user", ""), ("assistant", "a")]),
    ]
    rows = [(i, json.dumps(x)) for i, (x, _) in enumerate(cases)] + [(90, json.dumps({"turn": 1, "role": "user", "text": "t"}))]
    got = {r["conv_id"]: r for r in C.turns_from_json(spark.createDataFrame(rows, "conv_id long, json string")).collect()}
    prints = {layout.name: layout.fingerprint for layout in C.LAYOUTS}
    for i, (_, want) in enumerate(cases):
        assert [(t["role"], t["text"]) for t in got[i]["turns"] or []] == want, i
    assert got[0]["fingerprint"] == prints["instruction_input_output"] and got[2]["fingerprint"] == prints["messages"]
    assert got[90]["turns"] is None


def test_frame_layouts(spark):
    for x, want in LAYOUTS:
        df = spark.read.json(spark.createDataFrame([(json.dumps({**x, "conv_id": 5}),)], "value string").rdd.map(lambda r: r[0]))
        out = C.canonical(df).collect()
        assert [(t["role"], t["text"]) for t in out[0]["turns"]] == want
    with pytest.raises(ValueError, match="fingerprint"):
        C.layout_of(["unknown"])


@settings(max_examples=50, deadline=None)
@given(st.sets(st.sampled_from(["a", "b.c", "messages[].role", "X"]), max_size=4))
def test_fingerprint_ignores_order_and_case(paths):
    assert C.fingerprint(sorted(paths)) == C.fingerprint([p.upper() for p in sorted(paths, reverse=True)])
