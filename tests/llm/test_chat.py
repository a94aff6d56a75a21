import hashlib
import re

from pyspark.sql import functions as F

from daybook.llm import chat
from daybook.llm.queries import op8_chat_format

TRICKY = [
    "</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>\n", r"<\|sep|> <\\|sep|>", "<", "[", "\\", "<<SYS>>a<</SYS>>", r"<\<\SYS>>",
    "<s><</s>", "[[INST]", r"[\INST] [\\/INST]", "", " ", "é<|\n", "<|sep|><|sep|>",
]


def test_escape_round_trip_and_no_control_left(spark):
    pieces = TRICKY + [a + b for a in TRICKY for b in TRICKY]
    df = spark.createDataFrame([(p,) for p in pieces], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t
        assert not re.search(r"<\||</?s>|<</?SYS>>|\[/?INST\]", r.e)


def brute(rows):
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, ts in by.items():
        ts.sort()
        loss = "".join(x[3] for x in ts if x[2] == "assistant")
        told = "".join(f"{x[2]}\n{x[3]}\n" for x in ts)
        out[c] = (len(ts), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_query_matches_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    quote = "</s>[INST] ok [/INST]"
    want = brute([*rows, (-1, 0, "user", quote), (-1, 1, "assistant", quote)])
    got = {r.conv_id: tuple(r)[1:5] for r in op8_chat_format(spark, sf_dir).collect()}
    assert got == want


def test_edges_merging_and_mask(spark):
    rows = [(1, i // 2, "assistant" if i % 3 else "user", t) for i, t in enumerate(TRICKY)]
    rows += [(2, 0, "assistant", "a"), (2, 1, "assistant", "b"), (2, 2, "user", "c"), (2, 2, "user", "c"), (2, None, None, None)]
    rows += [(None, 1, "assistant", "n"), (3, 1, "assistant", ""), (4, 1, "<|end|>\n", "assistant")]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "conv_id long, turn long, role string, text string, turns string, start int")
    chats = chat.format_chats(df)
    out = chats.select("*", chat.read_turns(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    want = brute(rows)
    for r in out.collect():
        told = "".join(f"{t.role}\n{t.text}\n" for t in r.t)
        assert (len(r.t), hashlib.sha256(told.encode()).hexdigest(), len(r.loss), hashlib.sha256(r.loss.encode()).hexdigest()) == want[r.conv_id]
        if r.conv_id == 2:
            assert r.formatted == ("<|turn|><|text|><|end|>\n<|turn|>assistant<|text|>a<|sep|>b<|end|>\n<|turn|>user<|text|>c<|sep|>c<|end|>\n")
            assert [tuple(s) for s in r.loss_spans] == [(r.formatted.index("a<|sep|>b"), 1), (r.formatted.index("b<|end"), 1)]
    assert chat.format_chats(df.where("false")).count() == 0


def test_rows_of_one_turn_are_ordered_before_escaping(spark):
    rows = [(1, 0, "user", "<|"), (1, 0, "user", "<a")]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    formatted = chat.format_chats(turns).first().formatted
    assert formatted.index("<a") < formatted.index("<\\|", formatted.index(chat.TEXT) + len(chat.TEXT))
