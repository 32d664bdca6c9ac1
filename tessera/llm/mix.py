"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents are put in a shuffled order and cut into blocks of
equally many words.  Slot k of the schedule takes the golden-ratio point
frac((k + 1) / phi), mapped through the cumulative target shares to a source;
the r-th slot of a source takes the r-th block of its stream, which starts
anew when it is used up.  Slots beyond a source's target are left out and
those that its points have not reached are added at the end, so that each
source gives its target to the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import BLANK_WORD, cut

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 4096
SEED = "mix-1"
GOLDEN = 0.6180339887498949
# Hash ranges per source; each range is ordered on its own.
RANGES = 4096
# Slots ranked together before the ranks are joined up.
SLOT_CHUNK = 8192


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(BLANK_WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target): one row per source.

    Sources in code-point order, null last, take the weights in turn.  A
    target is the source's share of all words by weight, at most
    ``max_repeats`` times its words; what is cut off is shared by weight among
    the others.  With the sources in order of cap over weight, the level
    ``rest / weight left`` is the same as repeating that sharing to its end.
    """
    size = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = size.withColumn("weight", w.cast("long")).withColumn("cap", F.col("source_size") * max_repeats)
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    s = s.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("rest"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
        (F.col("cap") / F.col("weight")).alias("cap_level"),
    )
    # The level is that of the first source whose cap it does not exceed.
    level = F.min(F.when(F.col("cap_level") >= F.col("rest") / F.col("weight_left"), F.struct("cap_level", F.col("rest") / F.col("weight_left")))).over(everything)
    s = s.withColumn("level", level.getField("col2"))
    return s.select(
        "source",
        "source_size",
        F.when(F.col("level").isNull() | (F.col("cap_level") <= F.col("level")), F.col("cap").cast("double"))
        .otherwise(F.col("weight") * F.col("level"))
        .alias("target"),
    )


def _stream(sized: DataFrame, seed: str) -> DataFrame:
    """Documents with ``start``: the words of their source's stream before them.

    The order is that of md5(seed, doc_id).  It is found by ranges of the
    hash: within a range by a window, between ranges from their sums, so no
    source is ordered in one task.
    """
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    d = sized.withColumn("key", key).withColumn("range", F.conv(F.substring("key", 1, 3), 16, 10).cast("int"))
    inner = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    sums = d.groupBy("source", "range").agg(F.sum("size").alias("words"))
    outer = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "range", F.coalesce(F.sum("words").over(outer), F.lit(0)).alias("base"))
    d = d.withColumn("within", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    s = sums.select(F.col("source").alias("s2"), F.col("range").alias("r2"), "base")
    joined = d.join(s, F.col("source").eqNullSafe(F.col("s2")) & (F.col("range") == F.col("r2")))
    return joined.withColumn("start", (F.col("base") + F.col("within")).cast("long")).drop("s2", "r2", "base", "within", "key", "range")


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(source, slot, rank, epoch, block, words): which block each slot takes.

    ``targets`` has one row per source.  ``rank`` counts a source's slots from
    0; ``words`` is the block's length, the last slot's cut to the target.
    """
    spark = targets.sparkSession
    t = targets.filter("target > 0 and source_size > 0").select(
        "*", F.round("target").cast("long").alias("quota"), F.ceil(F.col("source_size") / block_words).cast("long").alias("blocks")
    )
    # Slots a source needs: whole epochs, then the blocks of the last one.
    whole = F.floor(F.col("quota") / F.col("source_size"))
    need = whole * F.col("blocks") + F.ceil((F.col("quota") - whole * F.col("source_size")) / block_words)
    t = t.withColumn("need", need.cast("long"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    total = F.sum("need").over(Window.partitionBy())
    upto = F.sum("need").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # One row per source; written once since both the points and the quotas read it.
    t = cut(t.select("*", (upto / total).alias("hi"), ((upto - F.col("need")) / total).alias("lo"), total.alias("slots")))
    n = t.agg(F.max("slots")).first()[0] or 0
    point = F.pmod((F.col("id") + 1) * F.lit(GOLDEN), F.lit(1.0))
    slots = spark.range(n).select(F.col("id").alias("slot"), point.alias("point"))
    # Points meet the few share intervals on the interval's cell of the unit line.
    cells = 1024
    spans = t.filter("need > 0").select(
        "source", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * cells), F.floor(F.col("hi") * cells))).alias("cell")
    )
    hit = slots.withColumn("cell", F.floor(F.col("point") * cells)).join(spans, "cell").filter("point >= lo and point < hi")
    hit = hit.select("source", "slot", F.floor(F.col("slot") / SLOT_CHUNK).alias("chunk"))
    # Rank per source: within chunks of the schedule, chunks joined up by their counts.
    counts = hit.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("c"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(F.col("source").alias("s2"), F.col("chunk").alias("c2"), F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("base"))
    inner = Window.partitionBy("source", "chunk").orderBy("slot")
    ranked = (
        hit.withColumn("r", F.row_number().over(inner) - 1)
        .join(base, F.col("source").eqNullSafe(F.col("s2")) & (F.col("chunk") == F.col("c2")))
        .select("source", "slot", (F.col("r") + F.col("base")).alias("rank"))
    )
    got = ranked.groupBy(F.col("source").alias("s2")).agg(F.count(F.lit(1)).alias("got"))
    late = t.join(got, F.col("source").eqNullSafe(F.col("s2")), "left").select("source", "need", F.coalesce("got", F.lit(0)).alias("got"), "slots")
    late = late.filter("got < need").select("source", "slots", F.explode(F.sequence("got", F.col("need") - 1)).alias("rank"))
    late = late.select("source", (F.col("slots") + F.col("rank")).alias("slot"), "rank")
    q = t.select(F.col("source").alias("s2"), "need", "quota", "blocks", "source_size")
    full = ranked.unionAll(late).join(q, F.col("source").eqNullSafe(F.col("s2"))).filter("rank < need")
    epoch, block = F.floor(F.col("rank") / F.col("blocks")), F.pmod(F.col("rank"), F.col("blocks"))
    length = F.least(F.lit(block_words), F.col("source_size") - block * block_words)
    left = F.col("quota") - epoch * F.col("source_size") - block * block_words
    return full.select("source", "slot", "rank", epoch.alias("epoch"), block.alias("block"), F.least(length, left).cast("long").alias("words"))


def mix_takes(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    seed: str = SEED,
) -> tuple[DataFrame, DataFrame]:
    """The mix as (placed, takes).

    placed: the rows of ``docs`` (doc_id, source, size), with source_size,
    target and start, the position in the source's stream.  takes: source,
    block, words, n, how many slots take the first ``words`` words of that
    block, and first, the earliest of them.  Joining them on (source, block) gives the pieces that are read.
    """
    targets = cut(source_targets(docs, weights, max_repeats))
    t = targets.select(F.col("source").alias("s2"), "source_size", "target")
    placed = _stream(docs, seed).join(t, F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    takes = schedule(targets, block_words).groupBy("source", "block", "words").agg(F.count(F.lit(1)).alias("n"), F.min("slot").alias("first"))
    return placed, takes


def mix_sources(docs: DataFrame, block_words: int = BLOCK_WORDS, **kw) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_slot for every row of ``docs``.

    ``taken`` counts the words that the mix takes of a document, repeats
    included: its source's share cut into blocks, each taken as often as slots
    name it.  ``first_slot`` is the schedule's earliest slot that takes words of the
    document, null if none does; in its order the sources stand near their
    shares in every beginning of the mix.  Null texts and texts of blanks have size 0 and are never taken;
    a null source is one more source; rows that repeat a doc_id are documents
    of their own, equal rows being interchangeable.  An empty table gives an
    empty frame.  Only the counted columns are shuffled, never the texts.
    """
    sized = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    return _taken(sized, block_words, **kw).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def _taken(sized: DataFrame, block_words: int, **kw) -> DataFrame:
    """The rows of ``sized`` with source_size, target, taken and first_slot."""
    placed, takes = mix_takes(sized, block_words=block_words, **kw)
    placed = cut(placed.withColumn("row", F.monotonically_increasing_id()))
    first = F.floor(F.col("start") / block_words)
    last = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    pieces = placed.filter("size > 0").select("row", "source", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    t = takes.select(F.col("source").alias("s2"), F.col("block").alias("b2"), "words", "n", "first")
    lo = F.greatest(F.col("start"), F.col("block") * block_words)
    hi = F.least(F.col("start") + F.col("size"), F.col("block") * block_words + F.col("words"))
    taken = (
        pieces.join(t, F.col("source").eqNullSafe(F.col("s2")) & (F.col("block") == F.col("b2")))
        .groupBy("row")
        .agg(F.sum(F.greatest(hi - lo, F.lit(0)) * F.col("n")).alias("taken"), F.min(F.when(hi > lo, F.col("first"))).alias("first_slot"))
    )
    out = placed.join(taken, "row", "left")
    return out.withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, **kw) -> DataFrame:
    """The documents that the mix takes, with ``mix_taken`` words of each (in
    place of an input column of that name).

    Rows are told apart by a 128-bit hash of all their columns, not by doc_id.
    Rows equal in all columns, which the mix cannot tell apart, each report an
    even share of what they take together, rounded up.
    """
    docs = docs.drop("mix_taken")
    row = ["_row_hi", "_row_lo"]
    while set(row) & set(docs.columns):
        row = [f"_{r}" for r in row]
    whole = [F.col(f"`{c}`") for c in docs.columns] + [F.col(f"`{c}`").isNull() for c in docs.columns]
    keyed = docs.select("*", *[F.xxhash64(F.lit(i), *whole).alias(r) for i, r in enumerate(row)])
    size = word_count(F.col("text")).alias("size")
    sized = cut(keyed.select("doc_id", "source", size, F.col(row[0]).alias("hi"), F.col(row[1]).alias("lo")))
    m = _taken(sized, block_words, **kw).groupBy("hi", "lo").agg(F.sum("taken").alias("all"), F.count(F.lit(1)).alias("n"))
    m = m.filter("all > 0").select(
        F.col("hi").alias(row[0]), F.col("lo").alias(row[1]), F.ceil(F.col("all") / F.col("n")).cast("long").alias("mix_taken")
    )
    return keyed.join(m, row).select(*[F.col(f"`{c}`") for c in docs.columns], "mix_taken")
