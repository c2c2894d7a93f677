import hashlib
import random

from pyspark.sql import functions as F

from feedlark.llm import chat, queries

PIECES = ["[INST]", "[/INST]", "</s>", "[SYS]", "[OUT]", "[\\INST]", "<\\\\/s>", "[TURN:41]", "[/TURN]", "[", "\\", "<", "/s>", "INST]", " ", "\n", "é𝄞", "ok"]


def turns_of(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_conversations(df).withColumn("turns", chat.read_back(F.col("formatted")))
    return {r["conv_id"]: r for r in out.withColumn("loss", chat.under_mask(F.col("formatted"), F.col("loss_spans"))).collect()}


def test_random_texts_come_back(spark):
    rnd = random.Random(3)
    rows = []
    for c in range(300):
        for t in range(rnd.randint(1, 5)):
            text = "".join(rnd.choices(PIECES, k=rnd.randint(0, 6)))
            rows.append((c, t, rnd.choice(["user", "assistant", "system", "tool", "a]b", "", "é"]), text, "x"))
    got = turns_of(spark, rows)
    for c in range(300):
        own = [(r[2], r[3]) for r in rows if r[0] == c]
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == own
        assert got[c]["loss"] == "".join(x for role, x in own if role == "assistant")
        spans = [got[c]["formatted"][s["start"] : s["end"]] for s in got[c]["loss_spans"]]
        assert len(spans) == sum(role == "assistant" for role, _ in own)


def test_plain_texts_are_not_escaped(spark):
    got = turns_of(spark, [(1, 0, "user", "a \\ b [x]", None), (1, 1, "assistant", "c", None), (2, 0, "user", "[/INST]", None)])
    assert got[1]["formatted"] == "[INST]a \\ b [x][/INST][OUT]c</s>" and not got[1]["escaped"]
    assert got[2]["formatted"] == "[INST][\\/INST][/INST]" and got[2]["escaped"]


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, None, None, None, None), (1, 0, "user", "b", None), (1, 0, "user", "a", None), (1, 0, "user", "a", None)]
    got = turns_of(spark, rows)
    assert [(t["role"], t["text"]) for t in got[None]["turns"]] == [("", "")]
    assert [t["text"] for t in got[1]["turns"]] == ["a", "a", "b"]


def test_empty_table_and_long_text(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0
    long = "x [INST] </s> " * 100_000
    df = spark.createDataFrame([(1, 0, "assistant", long)], schema)
    row = chat.format_conversations(df).withColumn("turns", chat.read_back(F.col("formatted"))).first()
    assert row["turns"][0]["text"] == long


def test_query_against_plain_python(spark):
    got = {r["conv_id"]: r for r in queries.op2_chat_format(spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    told = [(r["conv_id"], r["turn"], r["role"], r["text"] or "") for r in rows]
    told += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    ids = {t[0] for t in told}
    assert set(got) == ids
    for c in ids:
        own = sorted(t for t in told if t[0] == c)
        r = got[c]
        assert r["n_turns"] == len(own)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{t[2]}\n{t[3]}\n" for t in own).encode()).hexdigest()
        loss = "".join(t[3] for t in own if t[2] == "assistant")
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[-1]["escaped"] and got[-1]["formatted_chars"] > 40
