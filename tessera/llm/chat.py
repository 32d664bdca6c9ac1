"""Chat formatting with prefix-target expansion, in DataFrame functions only.

A conversation's transcript is its turns in the template
``<|role|>\\n text <|end|>\\n``.  Every assistant turn becomes an example: the
transcript up to and including that turn, of which only the reply is trained.
As every example of a conversation is a prefix of one transcript, it is held
as a row with offsets into it; ``example_texts`` writes the text out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Control strings of this and other common templates; a text may hold any.
_OPEN = r"(?=\||/?s>|/?INST\])"
_CLOSE = r"(?=>)"
# Turns that are put together before a conversation's parts are.
CHUNK = 256


def escape(text: Column) -> Column:
    """Put one more backslash between the first character of a control string
    and its rest, so that none is left; ``unescape`` takes it out again."""
    once = F.regexp_replace(text, rf"([<\[])(\\*){_OPEN}", r"$1\\$2")
    return F.regexp_replace(once, rf"(\|)(\\*){_CLOSE}", r"$1\\$2")


def unescape(text: Column) -> Column:
    once = F.regexp_replace(text, rf"(\|)\\(\\*){_CLOSE}", "$1$2")
    return F.regexp_replace(once, rf"([<\[])\\(\\*){_OPEN}", "$1$2")


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, chunk, seq, segment): the formatted turns.

    Turns are ordered by turn (null first), equal turns by role and text; seq
    counts from 0 within the chunk of turns.  A null text or role is empty.
    Rows with a null conv_id are one conversation.
    """
    c = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(2**62))).alias("chunk"),
    )
    order = Window.partitionBy("conv_id", "chunk").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    head = F.concat(F.lit("<|"), escape(F.col("role")), F.lit("|>\n"))
    return c.select(
        "conv_id",
        "chunk",
        (F.row_number().over(order) - 1).cast("long").alias("seq"),
        head.alias("head"),
        F.concat(head, escape(F.col("text")), F.lit("<|end|>\n")).alias("segment"),
        (F.col("role") == "assistant").alias("train"),
    )


def transcripts(turns: DataFrame) -> DataFrame:
    """(conv_id, transcript, segments): a row per conversation.

    ``segments`` has, for every turn, its length, the length of its head, and
    whether it is trained.  Turns are joined by chunks first, then chunks.
    """
    seg = F.struct("seq", "segment", F.length("segment").alias("len"), F.length("head").alias("head"), "train")
    parts = turns.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list(seg)).alias("s"))
    parts = parts.select(
        "conv_id",
        "chunk",
        F.array_join(F.col("s.segment"), "").alias("text"),
        F.transform("s", lambda x: F.struct(x.len.alias("len"), x.head.alias("head"), x.train.alias("train"))).alias("segments"),
    )
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "text", "segments"))).alias("p"))
    return whole.select(
        "conv_id",
        F.array_join(F.col("p.text"), "").alias("transcript"),
        F.flatten(F.col("p.segments")).alias("segments"),
    )


def prefix_target_examples(trans: DataFrame) -> DataFrame:
    """One example per assistant turn: (conv_id, target_turn, target_start,
    target_end, example_end), code-point offsets into the transcript.

    The context is the transcript before ``target_start`` (all earlier turns
    and the head of the reply); loss falls on ``target_start`` to
    ``target_end`` alone; the example ends at ``example_end``.
    """
    e = trans.select("conv_id", F.posexplode("segments").alias("target_turn", "g"))
    w = Window.partitionBy("conv_id").orderBy("target_turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e = e.withColumn("example_end", F.sum("g.len").over(w))
    end = F.col("example_end") - F.lit(len("<|end|>\n"))
    start = F.col("example_end") - F.col("g.len") + F.col("g.head")
    return e.filter("g.train").select(
        "conv_id",
        F.col("target_turn").cast("long").alias("target_turn"),
        start.cast("long").alias("target_start"),
        end.cast("long").alias("target_end"),
        F.col("example_end").cast("long").alias("example_end"),
    )


def example_texts(trans: DataFrame, examples: DataFrame) -> DataFrame:
    """The examples written out: (conv_id, target_turn, context, target), both
    as formatted.  The output is as long as all prefixes together."""
    t = trans.select(F.col("conv_id").alias("c2"), "transcript")
    j = examples.join(t, F.col("conv_id").eqNullSafe(F.col("c2")))
    return j.select(
        "conv_id",
        "target_turn",
        F.expr("substring(transcript, 1, cast(target_start as int))").alias("context"),
        F.expr("substring(transcript, cast(target_start as int) + 1, cast(target_end - target_start as int))").alias("target"),
    )


def chat_digest(conversations: DataFrame) -> DataFrame:
    """Digests read back from the formatted output, one row per conversation.

    Turns are found again by splitting the transcript at its turn ends; the
    trained texts are cut out at the examples' offsets; both are unescaped.
    """
    t = transcripts(format_turns(conversations))
    ex = prefix_target_examples(t)
    spans = ex.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("target_start", "target_end"))).alias("spans"),
        F.count(F.lit(1)).alias("n_examples"),
    )
    spans = spans.withColumnRenamed("conv_id", "c2")
    j = t.join(spans, F.col("conv_id").eqNullSafe(F.col("c2")), "left")
    back = F.filter(F.split("transcript", r"<\|end\|>\n"), lambda x: x != "")
    turn = F.transform(
        back,
        lambda x: F.concat(
            unescape(F.regexp_extract(x, r"(?s)^<\|(.*?)\|>\n", 1)),
            F.lit("\n"),
            unescape(F.regexp_replace(x, r"(?s)^<\|.*?\|>\n", "")),
            F.lit("\n"),
        ),
    )
    loss = F.array_join(
        F.transform(
            F.coalesce("spans", F.array().cast("array<struct<target_start:bigint,target_end:bigint>>")),
            lambda s: unescape(F.substring(F.col("transcript"), (s.target_start + 1).cast("int"), (s.target_end - s.target_start).cast("int"))),
        ),
        "",
    )
    return j.select("conv_id", "transcript", back.alias("back"), turn.alias("turns"), loss.alias("loss"), "n_examples").select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("transcript").cast("long").alias("formatted_chars"),
        F.coalesce("n_examples", F.lit(0)).cast("long").alias("n_examples"),
    )
