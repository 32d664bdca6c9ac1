"""Benchmark decontamination by Wu-Manber search over words.

Patterns are the windows of consecutive words of the test items.  For every
pattern length a shift table over blocks of two words says how far the search
may jump; where the shift is 0 the suffix block's bucket, then the prefix
block, select the windows that are compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Batches, alnum_words, as_bytes, cut, share, shared

WINDOW = 10
# Windows whose tables one broadcast holds (about 100 MB in a Python worker).
MAX_WINDOWS = 200_000


class WuManber:
    """Search tables over word windows: shift, suffix bucket, prefix bucket."""

    def __init__(self, windows: dict[tuple[bytes, ...], list[str]], block: int = 2):
        self.groups = []
        lengths = sorted({len(w) for w in windows})
        for m in lengths:
            b = min(block, m)
            shift: dict[tuple, int] = {}
            bucket: dict[tuple, dict[tuple, dict]] = {}
            for w, ids in windows.items():
                if len(w) != m:
                    continue
                for end in range(b, m + 1):
                    k = w[end - b : end]
                    shift[k] = min(shift.get(k, m), m - end)
                bucket.setdefault(w[m - b :], {}).setdefault(w[:b], {})[w] = ids
            self.groups.append((m, b, shift, bucket))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """(start, end, item ids) of every occurrence of a window."""
        n = len(words)
        for m, b, shift, bucket in self.groups:
            jump = m - b + 1
            end = m
            while end <= n:
                suffix = tuple(words[end - b : end])
                step = shift.get(suffix, jump)
                if step:
                    end += step
                    continue
                start = end - m
                same = bucket[suffix].get(tuple(words[start : start + b]))
                if same:
                    ids = same.get(tuple(words[start:end]))
                    if ids is not None:
                        yield start, end, ids
                end += 1


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (words, item_id): the windows of every test item.

    Words are joined with one blank.  An item of fewer words is one window,
    one without words (or null) has none; a null id reads ``null``; items that
    repeat an id are one item.
    """

    def cut_windows(batches: Batches) -> Batches:
        for batch in batches:
            ids, texts = batch.column("item_id").to_pylist(), as_bytes(batch, "text")
            for k, t in zip(ids, texts):
                w = alnum_words(t)
                n = min(window, len(w))
                rows = list({b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)}) if n else []
                for i in range(0, len(rows), 10_000):
                    part = rows[i : i + 10_000]
                    yield pa.RecordBatch.from_pydict(
                        {"words": pa.array(part, pa.binary()), "item_id": pa.array([k] * len(part), pa.string())}
                    )

    src = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
    return src.mapInArrow(cut_windows, "words binary, item_id string").distinct()


def _search_tables(items: DataFrame, window: int, max_windows: int) -> Iterator[WuManber]:
    """Search tables for blocks of at most about ``max_windows`` windows."""
    windows = cut(item_windows(items, window))
    n = windows.count()
    blocks = -(-n // max_windows)
    for i in range(blocks):
        by: dict[tuple[bytes, ...], list[str]] = {}
        part = windows.filter(F.pmod(F.xxhash64("words", "item_id"), F.lit(blocks)) == i)
        for words, item in part.toLocalIterator():
            by.setdefault(tuple(bytes(words).split(b" ")), []).append(item)
        yield WuManber(by)


def mark_test_windows(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """Where test items occur in each document.

    Returns a row per input row: doc_id, n_words, hit_words (indices of the
    words inside any occurrence, ascending), item_ids (distinct, sorted as
    strings).  Null and empty texts have no words and no hits; without items
    nothing is hit.  Documents are scanned where they lie, without a shuffle.
    The item side is searched in blocks of ``max_windows`` windows, each
    broadcast alone; one block serves any usual benchmark, further ones pass
    over the documents again, with the hits so far written in between.
    """
    spark = docs.sparkSession
    schema = "doc_id long, text string, n_words long, hit_words array<int>, item_ids array<string>"
    df = docs.select(
        "doc_id",
        "text",
        F.lit(None).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("hit_words"),
        F.array().cast("array<string>").alias("item_ids"),
    )

    def scan_with(sent):
        def scan(batches: Batches) -> Batches:
            tables = shared(sent)
            for batch in batches:
                texts = as_bytes(batch, "text")
                hits_in, items_in = batch.column("hit_words").to_pylist(), batch.column("item_ids").to_pylist()
                n_words, hit_words, item_ids = [], [], []
                for t, hits, ids in zip(texts, hits_in, items_in):
                    words = alnum_words(t)
                    flags, found = None, set(ids)
                    for start, end, which in tables.search(words):
                        if flags is None:
                            flags = np.zeros(len(words), bool)
                            flags[hits] = True
                        flags[start:end] = True
                        found.update(which)
                    n_words.append(len(words))
                    hit_words.append(hits if flags is None else np.flatnonzero(flags).tolist())
                    item_ids.append(sorted(found))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("text"),
                        pa.array(n_words, pa.int64()),
                        pa.array(hit_words, pa.list_(pa.int32())),
                        pa.array(item_ids, pa.list_(pa.string())),
                    ],
                    names=["doc_id", "text", "n_words", "hit_words", "item_ids"],
                )

        return scan

    empty = True
    for tables in _search_tables(items, window, max_windows):
        df = (df if empty else cut(df)).mapInArrow(scan_with(share(spark, tables)), schema)
        empty = False
    if empty:
        df = df.mapInArrow(scan_with(share(spark, WuManber({}))), schema)
    return df.drop("text")


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """The documents in which no window of a test item occurs, all columns kept."""
    schema = docs.schema

    def keep_with(sent):
        def keep(batches: Batches) -> Batches:
            tables = shared(sent)
            for batch in batches:
                mask = [next(tables.search(alnum_words(t)), None) is None for t in as_bytes(batch, "text")]
                yield batch.filter(pa.array(mask, pa.bool_()))

        return keep

    df, first = docs, True
    for tables in _search_tables(items, window, max_windows):
        df = (df if first else cut(df)).mapInArrow(keep_with(share(docs.sparkSession, tables)), schema)
        first = False
    return df


def contamination_report(docs: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """One row per document: counts and the digest of the items found."""
    m = mark_test_windows(docs, items, **kw)
    return m.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )
