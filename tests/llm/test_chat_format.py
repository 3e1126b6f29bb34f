"""Event folding, rendering and reading back, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from chamberlens.llm.chat_format import Template, escaped, fold_events, read_back, render, unescaped
from chamberlens.llm.queries import event_log

EVENTS = "conv_id long, turn long, seq long, event string, role string, text string"


def fold(spark, rows, **clash):
    df = spark.createDataFrame(rows, EVENTS)
    for name, value in clash.items():
        df = df.withColumn(name, F.lit(value))
    return sorted(tuple(r) for r in fold_events(df, ["turn"]).collect())


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 0, 1, "message", "user", "Hel"),
        (1, 0, 2, "delta", None, "lo"),
        (1, 1, 1, "message", "assistant", "bad"),
        (1, 1, 2, "delta", None, " answer"),
        (1, 1, 3, "regenerate", None, None),
        (1, 1, 5, "delta", None, " one"),
        (1, 1, 4, "delta", None, "good"),
        (1, 2, 1, "message", "user", "typo"),
        (1, 2, 9, "edit", None, "fixed"),
    ]
    random.Random(1).shuffle(rows)
    assert fold(spark, rows) == [(1, 0, "user", "Hello"), (1, 1, "assistant", "good one"), (1, 2, "user", "fixed")]


def test_repeats_nulls_ties_and_clashing_names(spark):
    rows = [
        (1, 0, 1, "message", "user", "a"),
        (1, 0, 1, "message", "user", "a"),
        (1, 0, 2, "delta", None, "c"),
        (1, 0, 2, "delta", None, "b"),
        (1, 0, 2, "delta", None, "b"),
        (2, 0, None, "delta", None, "lost"),
        (2, 0, 1, "edit", None, "kept"),
        (3, 0, None, None, None, None),
    ]
    want = [(1, 0, "user", "abc"), (2, 0, None, "kept"), (3, 0, None, "")]
    assert fold(spark, rows, _place=1, _last=2, _parts=3, role_=4) == want
    assert fold(spark, [(None, None, 1, "message", "user", "x")]) == [(None, None, "user", "x")]
    assert fold(spark, []) == []


@pytest.mark.parametrize("seed", range(4))
def test_escaping_is_reversible_and_hides_control_strings(spark, seed):
    draw = random.Random(seed)
    pieces = ["<", "[", "\\", "]", "n", "<|im_end|>", "<|im_sep|>", "</s>", "[INST]", "<\\", "$1", "é", "\n"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 12))) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escaped(F.col("t")).alias("e"))
    for text, hidden, back in df.select("t", "e", unescaped(F.col("e"))).collect():
        assert back == text
        assert not any(c in hidden for c in ("<|im_end|>", "<|im_sep|>", "<|im_start|>", "</s>", "[INST]"))


def test_round_trip_of_any_turns(spark):
    rows = [
        (1, 0, "user", "</s>[INST] ok [/INST]"),
        (1, 1, "assistant", "</s>[INST] ok [/INST]"),
        (1, 2, "a<|im_sep|>b", "line\nline"),
        (1, 3, "assistant", ""),
        (1, 4, None, None),
        (1, 4, "assistant", "tie"),
        (2, 0, "assistant", "\\<|im_end|>\\"),
        (3, 0, "user", "x" * 300_000),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in read_back(render(df, ["turn"])).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [(r or "", t or "") for _, _, r, t in [*rows[:4], rows[4], rows[5]]]
    assert got[1]["loss_text"] == rows[1][3] + "tie"
    assert got[2]["loss_text"] == "\\<|im_end|>\\" and got[3]["loss_text"] == ""
    mark = Template()
    assert got[1]["formatted"].count(mark.end) == 6 and "</s>" not in got[1]["formatted"]
    assert render(df.where("false"), ["turn"]).count() == 0


def test_event_log_leads_back_to_the_conversations(spark, medium):
    table = spark.read.parquet(f"{medium}/conversations.parquet")
    rows = fold_events(event_log(table), ["turn", "copy"]).select("conv_id", "turn", "role", "text")
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, table.select("conv_id", "turn", "role", "text").collect()))


def test_a_crowded_conversation(spark):
    df = spark.range(6000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('text <', id) AS text")
    got = read_back(render(df, ["turn"])).first()
    assert len(got["turns"]) == 6000 and got["turns"][4321]["text"] == "text <4321"
    assert got["loss_text"] == "".join(f"text <{i}" for i in range(1, 6000, 2))
