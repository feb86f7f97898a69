import hashlib
import random

import pytest
from pyspark.sql import functions as F

from textloom.llm import chat, queries

from .common import clashing, same_as_sql

SCHEMA = "conv_id long, turn int, role string, text string"
PIECES = ["</s>", "<s>", "[INST]", "[/INST]", "[\\INST]", "<\\|", "<|im_end|>", "<|im_start|>user", "<|im_next|>", "<|", "<\\\\|im_sep|>", "<<SYS>>", "<</SYS>>", "ok", " ", "\n", "é", "😀", "\\", "<", "[", "$1"]


def read_back(df):
    f = chat.format_chats(df)
    return {r.conv_id: r for r in f.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}


def test_hostile_texts_come_back(spark):
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "sys<|x"]), "".join(rng.choices(PIECES, k=rng.randint(0, 9)))) for c in range(60) for t in range(rng.randint(1, 7))]
    got = read_back(spark.createDataFrame(rows, SCHEMA).repartition(5))
    for c, r in got.items():
        mine = sorted(x[1:] for x in rows if x[0] == c)
        assert [(t.role, t.text) for t in r.turns] == [(x[1], x[2]) for x in mine]
        assert r.loss == "".join(x[2] for x in mine if x[1] == "assistant")


def test_marks_are_only_the_templates(spark):
    rows = [(1, 0, "user", "<|im_end|>"), (1, 1, "user", "b"), (1, 2, "assistant", "</s>")]
    r = read_back(spark.createDataFrame(rows, SCHEMA))[1]
    assert r.formatted == "<|im_start|>user<|im_sep|><\\|im_end|><|im_next|>b<|im_end|><|im_start|>assistant<|im_sep|><\\/s><|im_end|>"


def test_nulls_ties_and_repeats(spark):
    rows = [(1, 0, "user", None), (1, None, None, "first"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (None, 0, "user", "x"), (None, 0, "user", "x"), (2, 0, "assistant", "")]
    df = clashing(spark.createDataFrame(rows, SCHEMA), "id", "t", "turns", "blocks", "formatted")
    out = chat.chat_table(df).collect()
    assert sorted((r.conv_id is None, r.n_turns) for r in out) == [(False, 1), (False, 5), (True, 1), (True, 1)]
    one = next(r for r in out if r.conv_id == 1)
    assert one.loss_chars == 3 and one.loss_sha256 == hashlib.sha256(b"aab").hexdigest()
    assert one.turns_sha256 == hashlib.sha256(b"\nfirst\nuser\n\nassistant\na\nassistant\na\nassistant\nb\n").hexdigest()


def test_empty_and_long(spark):
    assert chat.chat_table(spark.createDataFrame([], SCHEMA)).collect() == []
    long = "wort ü " * 200_000
    r = chat.chat_table(spark.createDataFrame([(1, 0, "assistant", long)], SCHEMA)).first()
    assert r.loss_chars == len(long)


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_matches_sql(spark, sf):
    d = f"/root/testdata/{sf}"
    got = queries.op1_chat(spark, d)
    same_as_sql(queries.ORACLE["op1_chat"], got, conversations=f"{d}/conversations.parquet")
    assert got.where("conv_id = -7").first().loss_sha256 == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest()


def test_no_python_in_the_plan(spark):
    plan = queries.op1_chat(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
