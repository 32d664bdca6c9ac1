"""MinHash near-dedup with bottom-k sketches from one hash function.

A document's set is its distinct 5-word shingles; documents are linked at an
exact Jaccard similarity of at least 0.75, and the groups are the connected
components of the links.

1. Rows of one set are one class; the rest works on classes.
2. A class's sketch is the ``k`` smallest hashes of its set.  Two sketches of
   linked classes share at least ``k_min`` retained values, so they share one
   of the ``k - k_min + 1`` rarest of either: only those are put in inverted
   lists, which keeps common passages out of them.
3. Each list names its class of smallest hash as hub.  Hub and members are
   candidates; the union-sketch estimate drops most, the others are compared
   on full sets, and components are formed.
4. A pair that shares a list shares that list's hub, so what is left to look
   at are pairs around one hub in different components.  They are compared
   in blocks of members, without a row per pair, again estimate first and
   full sets for what passes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Batches, WordHashes, as_bytes, blank_words, cut, shingle_set
from tessera.llm.components import connected_components

SHINGLE = 5
# Linked at 100 * intersection >= 75 * union.
PERCENT = 75
K = 64
# Sketches of a linked pair share K * 0.75 = 48 values on average, with a
# deviation of 3.5; fewer than 30 are shared about once in a million pairs.
K_MIN = 30
BLOCK = 384

_SETS = "doc_id long, n_shingles long, hi long, lo long, sketch binary"


def _class(s: np.ndarray) -> tuple[int, int]:
    hi, lo = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
    return int(hi), int(lo)


def document_sets(docs: DataFrame, shingle: int = SHINGLE, k: int = K, also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_shingles, hi, lo, sketch): set size, class and bottom-k sketch;
    then the long columns ``also`` as they are."""

    def sets(batches: Batches) -> Batches:
        hashes = WordHashes()
        for batch in batches:
            rows = [shingle_set(hashes.of(blank_words(t)), shingle) for t in as_bytes(batch, "text")]
            keys = [_class(s) for s in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(s) for s in rows], pa.int64()),
                    pa.array([h for h, _ in keys], pa.int64()),
                    pa.array([x for _, x in keys], pa.int64()),
                    pa.array([s[:k].tobytes() for s in rows], pa.binary()),
                    *[batch.column(x) for x in also],
                ],
                names=["doc_id", "n_shingles", "hi", "lo", "sketch", *also],
            )

    return docs.select("doc_id", "text", *also).mapInArrow(sets, _SETS + "".join(f", {x} long" for x in also))


def shared_needed(n: int, k: int = K, k_min: int = K_MIN, percent: int = PERCENT) -> int:
    """Retained values that a class of ``n`` shingles shares with a linked one.
    While both sketches hold the whole sets this is exact."""
    return -(-percent * n // 100) if n * 100 <= k * percent else min(k_min, n)


def _postings(classes: DataFrame, k: int, k_min: int) -> DataFrame:
    """(v, c): inverted lists of the rarest retained values of each class."""

    def explode(batches: Batches) -> Batches:
        for batch in batches:
            sk = [np.frombuffer(b, np.int64) for b in batch.column("sketch").to_pylist()]
            n = [len(s) for s in sk]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(sk) if sk else np.empty(0, np.int64)),
                    pa.array(np.repeat(np.array(batch.column("c").to_pylist(), np.int64), n)),
                    pa.array(np.repeat(np.array([shared_needed(x, k, k_min) for x in batch.column("n").to_pylist()], np.int64), n)),
                    pa.array(np.repeat(np.array(n, np.int64), n)),
                ],
                names=["v", "c", "need", "held"],
            )

    values = classes.select("c", "n", "sketch").mapInArrow(explode, "v long, c long, need long, held long")
    common = values.groupBy("v").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    seen = values.join(common, "v")
    # The values only this class retains are its rarest; they use up places.
    per = seen.groupBy("c", "need", "held").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs"))
    room = F.col("held") - F.col("need") + 1 - (F.col("held") - F.size("vs"))
    return per.select(F.explode(F.slice("vs", F.lit(1), F.greatest(room, F.lit(0)).cast("int"))).alias("x"), "c").select("x.v", "c")


def _estimate(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Jaccard similarity estimated on the k smallest values of the union."""
    union = np.union1d(a, b)[:k]
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(both, union[-1], "right")) / len(union)


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _star_links(pairs: DataFrame, sets: DataFrame, k: int, k_min: int, percent: int) -> DataFrame:
    """(a, b): the hub pairs that pass the estimate and are linked on full sets."""
    left = sets.select(F.col("c").alias("hub"), F.col("full").alias("fa"))
    right = sets.select("c", F.col("full").alias("fb"))
    j = pairs.join(right, "c").join(left, "hub")

    def verify(batches: Batches) -> Batches:
        for batch in batches:
            a, b = batch.column("hub").to_pylist(), batch.column("c").to_pylist()
            keep = []
            for x, y in zip(batch.column("fa").to_pylist(), batch.column("fb").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                fits = 100 * min(len(x), len(y)) >= percent * max(len(x), len(y))
                small = shared_needed(min(len(x), len(y)), k, k_min, percent) / min(k, len(x), len(y))
                keep.append(bool(fits and _estimate(x[:k], y[:k], k) >= min(small, k_min / k) and _linked(x, y, percent)))
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}).filter(pa.array(keep, pa.bool_()))

    return j.select("hub", "c", "fa", "fb").mapInArrow(verify, "a long, b long")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by a product over the shared values."""
    lv, rv = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(lv, rv)
    out = np.zeros((len(left), len(right)), np.float32)
    li, ri = np.repeat(np.arange(len(left)), [len(x) for x in left]), np.repeat(np.arange(len(right)), [len(x) for x in right])
    lp, rp = np.searchsorted(shared, lv), np.searchsorted(shared, rv)
    lok, rok = (lp < len(shared)), (rp < len(shared))
    lok[lok] = shared[lp[lok]] == lv[lok]
    rok[rok] = shared[rp[rok]] == rv[rok]
    li, lp, ri, rp = li[lok], lp[lok], ri[rok], rp[rok]
    for at in range(0, len(shared), 4096):
        a, b = np.zeros((len(left), 4096), np.float32), np.zeros((len(right), 4096), np.float32)
        m, n = (lp >= at) & (lp < at + 4096), (rp >= at) & (rp < at + 4096)
        a[li[m], lp[m] - at] = 1
        b[ri[n], rp[n] - at] = 1
        out += a @ b.T
    return out


def _block_links(rows: pd.DataFrame, k: int, k_min: int, percent: int) -> pd.DataFrame:
    """Links between two blocks of a hub's members (or within one block)."""
    sides = [rows[rows["side"] == s] for s in (0, 1)]
    if not len(sides[1]):
        sides[1] = sides[0]
    full = [[np.frombuffer(x, np.uint64) for x in s["full"]] for s in sides]
    if not full[0] or not full[1]:
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    comp = [s["comp"].to_numpy() for s in sides]
    ids = [s["c"].to_numpy() for s in sides]
    n = [np.array([len(x) for x in f], np.float64) for f in full]
    small, large = np.minimum.outer(n[0], n[1]), np.maximum.outer(n[0], n[1])
    open_ = (comp[0][:, None] != comp[1][None, :]) & (100 * small >= percent * large)
    if open_.any():
        sketch = _overlaps([x[:k] for x in full[0]], [x[:k] for x in full[1]])
        least = {m: shared_needed(int(m), k, k_min, percent) for m in np.unique(small)}
        need = np.vectorize(lambda m: min(least[m], k_min), otypes=[float])(small)
        open_ &= sketch >= need
    i, j = np.nonzero(open_)
    if len(i):
        li, rj = np.unique(i), np.unique(j)
        both = np.zeros(open_.shape, np.float32)
        both[np.ix_(li, rj)] = _overlaps([full[0][x] for x in li], [full[1][x] for x in rj])
        inter = both[i, j].astype(np.float64)
        ok = 100 * inter >= percent * (n[0][i] + n[1][j] - inter)
        i, j = i[ok], j[ok]
    # One link for each pair of components is enough.
    out = pd.DataFrame({"a": ids[0][i], "b": ids[1][j], "x": comp[0][i], "y": comp[1][j]})
    return out.drop_duplicates(["x", "y"])[["a", "b"]]


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, k: int = K, k_min: int = K_MIN
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Words are runs of non-blanks, A-Z in lower case.  A text of fewer than
    ``shingle`` words is one shingle; null, empty and blank texts have the
    empty set and are linked with nothing.  component_id is the smallest
    doc_id reachable over links; rows that repeat a doc_id or a text come out
    once each.  Only one row of a group has kept true, equal doc_ids aside.  A
    null doc_id is last: its row is kept only if its group has no other id.
    """
    out = _grouped(docs, shingle, percent, k, k_min)
    comp = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", comp.alias("component_id"), F.col("doc_id").eqNullSafe(comp).alias("kept"))


def _grouped(docs: DataFrame, shingle: int, percent: int, k: int, k_min: int, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, g, component_id, ``also`` for every row of ``docs``:
    its group, and that by the smallest doc_id; both null for the empty set."""
    # A text is found again by its id and its hash, as ids may be null or repeated.
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("_text_hash"), *also)
    s = cut(document_sets(hashed, shingle, k, ("_text_hash", *also)))
    # A class is its 128-bit hash; it is numbered once, and the numbers are written.
    real = s.filter("n_shingles > 0")
    classes = cut(
        real.groupBy("hi", "lo")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text_hash")).alias("first"),
            F.first("n_shingles").alias("n"),
            F.first("sketch").alias("sketch"),
        )
        .select(F.monotonically_increasing_id().alias("c"), "hi", "lo", "first.doc_id", "first._text_hash", "n", "sketch")
    )
    lists = cut(_postings(classes, k, k_min))
    order = F.xxhash64(F.lit(1), "c")
    hubs = lists.groupBy("v").agg(F.min(order).alias("o"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    named = lists.join(hubs, "v").withColumn("mine", order)
    hub = named.filter("mine = o").select("v", F.col("c").alias("hub"))
    stars = cut(named.filter("mine <> o").select("v", "c").join(hub, "v").select("hub", "c").distinct())
    # Full sets of the classes that are in any star, from their first document.
    wanted = stars.select("c").unionAll(stars.select(F.col("hub").alias("c"))).distinct().join(classes.drop("n", "sketch"), "c")
    wanted = wanted.select(F.struct("c", "hi", "lo").alias("want"), F.col("doc_id").alias("want_doc"), F.col("_text_hash").alias("want_hash"))

    def full_sets(batches: Batches) -> Batches:
        hashes = WordHashes()
        for batch in batches:
            rows = [shingle_set(hashes.of(blank_words(t)), shingle) for t in as_bytes(batch, "text")]
            # Of the texts under one id and hash, those of the class.
            want = batch.column("want")
            asked = zip(want.field("hi").to_pylist(), want.field("lo").to_pylist())
            mine = pa.array([_class(x) == k for x, k in zip(rows, asked)], pa.bool_())
            sets = [want.field("c"), pa.array([x.tobytes() for x in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(sets, names=["c", "full"]).filter(mine)

    same = F.col("doc_id").eqNullSafe(F.col("want_doc")) & (F.col("_text_hash") == F.col("want_hash"))
    text = hashed.select("doc_id", "text", "_text_hash").join(wanted, same)
    sets = text.select("want", "text").mapInArrow(full_sets, "c long, full binary")
    sets = cut(sets.dropDuplicates(["c"]))
    links = cut(_star_links(stars, sets, k, k_min, percent))
    first = cut(connected_components(links, "a", "b"))

    # Members of each hub with their components; stars all of one component,
    # and those of two classes (compared already), are done.
    members = stars.unionAll(stars.select("hub", F.col("hub").alias("c")).distinct())
    members = members.join(first.select(F.col("node").alias("c"), "component"), "c", "left").select(
        "hub", "c", F.coalesce("component", "c").alias("comp")
    )
    todo = members.groupBy("hub").agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("x"), F.max("comp").alias("y"))
    todo = todo.filter("m > 2 and x <> y").select("hub", F.ceil(F.col("m") / BLOCK).cast("int").alias("nb"))
    # Member blocks i <= j meet under the key (hub, i, j).
    b = members.join(todo, "hub").withColumn("b", F.pmod(F.xxhash64(F.lit(2), "c"), F.col("nb")).cast("int"))
    b = b.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    b = b.select(
        "hub", "c", "comp", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), (F.col("b") > F.col("o")).cast("int").alias("side")
    )
    blocks = b.join(sets, "c").groupBy("hub", "i", "j")
    more = blocks.applyInPandas(lambda rows: _block_links(rows, k, k_min, percent), "a long, b long")
    final = connected_components(links.unionAll(more), "a", "b")

    # Back to the rows: a class's group is named by the smallest doc_id in it.
    group = classes.select("c", "hi", "lo", "doc_id").join(final.select(F.col("node").alias("c"), "component"), "c", "left")
    group = cut(group.select("hi", "lo", "doc_id", F.coalesce("component", "c").alias("g")))
    named = group.groupBy("g").agg(F.min("doc_id").alias("component_id"))
    label = group.join(named, "g").select("hi", "lo", "g", "component_id")
    # The empty set is no class: its rows find none.
    out = s.join(label, ["hi", "lo"], "left")
    return out.select("doc_id", "n_shingles", "g", "component_id", *also)


def drop_near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, k: int = K, k_min: int = K_MIN
) -> DataFrame:
    """The documents kept, one row for each group, all columns as they are.

    Rows are told apart by a 128-bit hash of all their columns, not by doc_id:
    rows of one id with unlike texts are judged each by its text, and of equal
    rows one is kept.  A group keeps a row of its smallest doc_id, null last.
    Rows of the empty set are linked with nothing and all stay.
    """
    row = ("_row_hi", "_row_lo")
    while set(row) & set(docs.columns):
        row = (f"_{row[0]}", f"_{row[1]}")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    whole = columns + [c.isNull() for c in columns]
    keyed = docs.select("*", *[F.xxhash64(F.lit(i), *whole).alias(r) for i, r in enumerate(row)])
    rows = _grouped(keyed, shingle, percent, k, k_min, row).filter(F.col("g").isNotNull())
    rows = cut(rows.groupBy("g", *row).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("m")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), *row))
    marks = rows.join(rows.groupBy("g").agg(first.alias("first")), "g")
    kept = (F.col(row[0]) == F.col(f"first.{row[0]}")) & (F.col(row[1]) == F.col(f"first.{row[1]}"))
    marks = cut(marks.select(*row, "m", kept.alias("kept")).filter("not kept or m > 1"))
    once = keyed.join(marks.select(*row), list(row), "left_anti")
    repeated = keyed.join(marks.filter("kept").select(*row), list(row)).dropDuplicates(list(row))
    return once.select(*columns).unionAll(repeated.select(*columns))
