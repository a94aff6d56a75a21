"""Chat formatting with Spark expressions only.

A conversation's rows, in order of (turn, role, text), become

    <|turn|>ROLE<|text|>TEXT<|sep|>TEXT<|end|>\\n<|turn|>...

where neighbouring turns of one role share a message, their texts parted by ``<|sep|>``.
Inside roles and texts an opening ``<`` or ``[`` of anything that reads as a control string
(``<|``, ``<s>``, ``</s>``, ``<<SYS>>``, ``<</SYS>>``, ``[INST]``, ``[/INST]``, also with backslashes
already after its opening character) gets one more backslash there, so no text holds a control
string and taking one backslash away restores it.  The loss mask is ``loss_spans``: start and
length, in UTF-8 bytes of ``formatted``, of each assistant text (without separators).

One shuffle by conversation: offsets are running sums over the sorted rows, the structs are
collected, sorted and merged with array functions in time linear in the turns.  A conversation
becomes one row, so the longest one must fit in a task; nothing else is gathered.

Defined cases: null role or text is empty; a null turn comes first; equal turns are ordered by role,
then text; repeated rows are turns; a null conversation id is a conversation of its own; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import let, text_of

TURN, TEXT, SEP, END = "<|turn|>", "<|text|>", "<|sep|>", "<|end|>\n"
LEARNED = "assistant"
_CONTROL = r"(?=\\*(?:\||/?s>|<\\*/?SYS>>|/?SYS>>|/?INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])" + _CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\" + _CONTROL, r"$1")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans array<struct<start, length>>."""
    col = lambda c: F.col(f"`{c}`")
    rows = turns.select(
        col(conv_col).alias("conv_id"),
        col(turn_col).alias("turn"),
        text_of(col(role_col)).alias("plain_role"),
        text_of(col(text_col)).alias("plain_text"),
    ).withColumn("role", escape(F.col("plain_role"))).withColumn("text", escape(F.col("plain_text")))
    # rows of one turn in the order of what they say, not of its escaped form
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "plain_role", "plain_text")
    before, after = F.lag("role").over(order), F.lead("role").over(order)
    opening = F.when(before.eqNullSafe(F.col("role")), F.lit(SEP)).otherwise(F.concat(F.lit(TURN), "role", F.lit(TEXT)))
    closing = F.when(after.eqNullSafe(F.col("role")), F.lit("")).otherwise(F.lit(END))
    rows = rows.select(
        "conv_id",
        "role",
        "text",
        F.row_number().over(order).alias("at"),
        F.octet_length(opening).cast("long").alias("lead"),
        F.octet_length("text").cast("long").alias("length"),
        F.octet_length(closing).cast("long").alias("trail"),
    )
    line = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("start", F.sum(F.col("lead") + F.col("length") + F.col("trail")).over(line) - F.col("trail") - F.col("length"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "role", "text", "start", "length"))).alias("turns"))

    def merged(t: Column) -> Column:
        """Runs of one role as messages; run bounds first, then disjoint slices."""
        changes = F.filter(t, lambda x, i: (i == 0) | (F.get(t, i - 1)["role"] != x["role"]))
        firsts = F.transform(changes, lambda x: x["at"])
        return let(firsts, lambda f: F.transform(f, lambda a, i: F.struct(
            F.get(t, a - 1)["role"].alias("role"),
            F.slice(t, a, F.coalesce(F.get(f, i + 1), F.size(t) + 1) - a)["text"].alias("texts"),
        )))

    def written(m: Column) -> Column:
        return F.concat(F.lit(TURN), m["role"], F.lit(TEXT), F.array_join(m["texts"], SEP), F.lit(END))

    learned = F.filter("turns", lambda x: x["role"] == LEARNED)
    return chats.select(
        "conv_id",
        let(F.col("turns"), lambda t: F.array_join(F.transform(merged(t), written), "")).alias("formatted"),
        F.transform(learned, lambda x: F.struct(x["start"], x["length"])).alias("loss_spans"),
    )


def _between(text: Column, mark: str) -> Column:
    return F.split(text, "".join("\\" + ch if ch == "|" else ch for ch in mark), -1)


def read_turns(formatted: Column) -> Column:
    """The turns array<struct<role, text>> of a formatted conversation, unescaped."""
    messages = _between(formatted, END)

    def turns(m: Column) -> Column:
        head_body = _between(F.substr(m, F.lit(len(TURN) + 1)), TEXT)
        return let(head_body, lambda hb: F.transform(
            _between(F.get(hb, F.lit(1)), SEP),
            lambda x: F.struct(unescape(F.get(hb, F.lit(0))).alias("role"), unescape(x).alias("text"))))

    return F.flatten(F.transform(F.filter(messages, lambda m: m != ""), turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return let(F.encode(formatted, "UTF-8"), lambda raw: F.array_join(
        F.transform(spans, lambda s: unescape(F.decode(F.substr(raw, (s["start"] + 1).cast("int"), s["length"].cast("int")), "UTF-8"))), ""))
