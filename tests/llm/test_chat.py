import hashlib
import random

from caseloom.llm.chat import format_conversations, read_trained, read_turns
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string, turns string, pieces int"


def formatted(spark, rows):
    data = [(*r, "x", 1) for r in rows]
    return format_conversations(spark.createDataFrame(data, SCHEMA))


def read_back(spark, rows):
    out = formatted(spark, rows).select(
        "conv_id", "formatted", "loss_spans", read_turns(F.col("formatted")).alias("turns"),
        read_trained(F.col("formatted"), F.col("loss_spans")).alias("trained"),
    ).collect()
    return {r.conv_id: r for r in out}


def test_layout_and_merged_roles(spark):
    got = read_back(spark, [(1, 2, "assistant", "c"), (1, 0, "user", "a"), (1, 1, "user", "b")])[1]
    assert got.formatted == ("<|im_start|>user\na<|im_sep|>b<|im_end|>\n"
                             "<|im_start|>assistant\nc<|im_end|>\n")
    assert [tuple(t) for t in got.turns] == [("user", "a"), ("user", "b"), ("assistant", "c")]
    assert got.trained == "c"


def test_random_texts_come_back(spark):
    draw = random.Random(5)
    parts = ["<|im_end|>", "<|im_start|>", "<|im_sep|>", "\\", "\\s", "<\\p", "<", "|", "\n", "é",
             "😀", "assistant", " ", "\\n", ""]
    rows = [(c, t, draw.choice(["user", "assistant", "a\\n\n<|im_end|>", ""]),
             "".join(draw.choices(parts, k=draw.randrange(8))))
            for c in range(40) for t in range(draw.randrange(1, 12))]
    got = read_back(spark, rows)
    for c in range(40):
        turns = [(r, x) for k, _, r, x in rows if k == c]
        assert [tuple(t) for t in got[c].turns] == turns
        assert got[c].trained == "".join(x for r, x in turns if r == "assistant")
        spans = [got[c].formatted[s.start:s.start + s.length] for s in got[c].loss_spans]
        assert all("<|" not in s for s in spans)


def test_nulls_ties_repeats_and_empty(spark):
    got = read_back(spark, [
        (None, 1, None, None), (None, None, "user", "x"),
        (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"),
    ])
    assert [tuple(t) for t in got[None].turns] == [("user", "x"), ("", "")]
    assert [tuple(t) for t in got[2].turns] == [("user", "a"), ("user", "a"), ("user", "b")]
    empty = formatted(spark, [])
    assert empty.columns == ["conv_id", "formatted", "loss_spans"] and empty.count() == 0


def test_long_conversation(spark):
    rows = [(7, i, ("user", "assistant")[i % 2], f"t{i} " * 20) for i in range(2000)]
    got = read_back(spark, rows)[7]
    assert len(got.turns) == 2000
    want = "".join(x for _, _, r, x in rows if r == "assistant")
    assert hashlib.sha256(got.trained.encode()).hexdigest() == hashlib.sha256(want.encode()).hexdigest()


def test_a_hundred_thousand_turns_in_one_conversation(spark):
    import time

    count = 100_000
    rows = spark.range(count).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("é<|text 😀 "), F.col("id").cast("string"), F.lit(" " + "x" * 80)).alias("text"))
    start = time.time()
    got = format_conversations(rows).select(
        F.size(read_turns(F.col("formatted"))).alias("n"), F.size("loss_spans").alias("spans"),
        F.sha2(F.encode(read_trained(F.col("formatted"), F.col("loss_spans")), "utf-8"), 256).alias("h"),
    ).first()
    assert time.time() - start < 60
    want = "".join(f"é<|text 😀 {k} " + "x" * 80 for k in range(count) if k % 3)
    assert (got.n, got.spans) == (count, sum(1 for k in range(count) if k % 3))
    assert got.h == hashlib.sha256(want.encode()).hexdigest()


def test_spans_at_the_edges_of_blocks(spark):
    for size in (4082, 4083, 4084, 4085, 8180, 9000):
        rows = [(1, 0, "assistant", "é" * size), (1, 1, "assistant", ""), (1, 2, "user", "b" * 5000),
                (1, 3, "assistant", "😀" * 5000), (1, 4, "assistant", "end")]
        got = read_back(spark, rows)[1]
        assert got.trained == "é" * size + "😀" * 5000 + "end"
        assert [got.formatted[s.start:s.start + s.length] for s in got.loss_spans] == [
            "é" * size, "", "😀" * 5000, "end"]
