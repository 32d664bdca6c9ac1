"""Substring dedup over sliding spans of sentences.

Every run of ``run`` consecutive sentences (more, if those are short) is hashed,
and so is every sentence that alone has more than ``LONG`` words.  A run is kept in the
first document (smallest doc_id) that has it, at its first place there; the
sentences that any other occurrence covers are removed.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER_BYTES, Batches, as_bytes

RUN = 2
MIN_WORDS = 20
# A sentence of more words is a run by itself too.
LONG = 50

# A sentence ends after . ! or ? before a blank, or at a line end.
_END = re.compile(rb"(?:(?<=[.!?])[ \t-\r]|\n)[ \t-\r]*")


def sentences(text: bytes | None) -> list[bytes]:
    """The text in pieces, each a sentence and the blanks after it; joined
    they are the text."""
    if not text:
        return []
    cuts = [m.end() for m in _END.finditer(text)]
    return [p for p in (text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])) if p]


def runs_of(pieces: list[bytes], run: int, min_words: int) -> list[tuple[int, int, bytes]]:
    """(start, end, 128-bit hash) of the sliding runs: ``run`` sentences, and
    further ones until there are ``min_words`` words.  They grow forward from
    every first sentence and backward from every last one, so a repeated
    passage is covered from end to end.  Case of A-Z and blanks do not count,
    pieces without words are passed over.  A sentence of more than ``LONG``
    words is a run, and a text of fewer sentences is one; runs that stay short
    of the words are none."""
    words = [(i, p.translate(LOWER_BYTES).split()) for i, p in enumerate(pieces)]
    words = [(i, w) for i, w in words if w]
    total = np.concatenate([[0], np.cumsum([len(w) for _, w in words])]).astype(np.int64)
    n, m = min(run, len(words)), len(words)
    if not n:
        return []
    starts, ends = np.arange(m - n + 1), np.arange(n, m + 1)
    forward = np.maximum(starts + n, np.searchsorted(total, total[starts] + min_words))
    backward = np.minimum(ends - n, np.searchsorted(total, total[ends] - min_words, "right") - 1)
    spans = {(int(a), int(b)) for a, b in zip(starts, forward) if b <= m}
    spans |= {(int(a), int(b)) for a, b in zip(backward, ends) if a >= 0}
    spans |= {(i, i + 1) for i, (_, w) in enumerate(words) if len(w) > max(LONG, min_words)}
    joined = [b" ".join(w) for _, w in words]
    return [
        (words[a][0], words[b - 1][0] + 1, xxhash.xxh3_128_digest(b"\n".join(joined[a:b]))) for a, b in sorted(spans)
    ]


def _halves(digests: list[bytes]) -> list[pa.Array]:
    raw = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return [pa.array(raw[:, 0]), pa.array(raw[:, 1])]


def span_runs(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_key, unnamed, a, b): the distinct runs of each row, their hash as two longs."""

    def emit(batches: Batches) -> Batches:
        for batch in batches:
            at, keys = [], []
            for i, t in enumerate(as_bytes(batch, "text")):
                own = list(dict.fromkeys(h for _, _, h in runs_of(sentences(t), run, min_words)))
                at += [i] * len(own)
                keys += own
            at = pa.array(at, pa.int64())
            of = [batch.column(x).take(at) for x in ("doc_key", "unnamed")]
            yield pa.RecordBatch.from_arrays([*of, *_halves(keys)], names=["doc_key", "unnamed", "a", "b"])

    return docs.select(*_key(), "text").mapInArrow(emit, "doc_key long, unnamed boolean, a long, b long")


def _key() -> list[F.Column]:
    """A document is its doc_id, or without one its text (by a 64-bit hash)."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    return [key.alias("doc_key"), F.col("doc_id").isNull().alias("unnamed")]


def repeated_runs(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_key, unnamed, a, b, first_doc): runs of a document that an earlier
    one has.  Documents are ordered by doc_id; those without one come last, by
    their text's hash, and as first_doc they are null.

    A run is counted before it is shuffled whole, and joined back to its runs,
    so one that a third of all documents hold is split over tasks.
    """
    runs = span_runs(docs, run, min_words)
    named, text = F.when(~F.col("unnamed"), F.col("doc_key")), F.when(F.col("unnamed"), F.col("doc_key"))
    first = runs.groupBy("a", "b").agg(
        F.min(named).alias("first_doc"), F.max(named).alias("last_doc"), F.min(text).alias("first_text"), F.max(text).alias("last_text")
    )
    first = first.filter("first_doc < last_doc or first_text < last_text or (first_doc is not null and first_text is not null)")
    later = F.when(F.col("unnamed"), F.col("first_doc").isNotNull() | (F.col("doc_key") > F.col("first_text")))
    later = later.otherwise(F.col("doc_key") > F.col("first_doc"))
    return runs.join(first, ["a", "b"]).filter(later).select("doc_key", "unnamed", "a", "b", "first_doc")


def dedup_spans(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """Each row with its repeated spans removed.

    Returns a row per input row: doc_id, text (null stays null), n_sentences,
    n_removed (sentences removed), first_docs (distinct ids of the documents
    that keep the removed spans, ascending; the row's own id where it repeats
    itself).  Rows that share a doc_id are treated as one document: they do
    not remove each other's spans, but a span within one row is kept once.
    Rows without a doc_id are one document where their texts are equal; a span
    first kept by such a row names no document.
    Empty texts and empty tables give no spans.
    """
    later = repeated_runs(docs, run, min_words)
    later = later.groupBy("doc_key", "unnamed").agg(F.collect_set(F.struct("a", "b", "first_doc")).alias("later"))
    d = docs.select("doc_id", "text", *_key()).join(later, ["doc_key", "unnamed"], "left").drop("doc_key", "unnamed")

    def strip(batches: Batches) -> Batches:
        for batch in batches:
            texts, n_sent, n_removed, firsts = [], [], [], []
            ids = batch.column("doc_id").to_pylist()
            for k, t, found in zip(ids, as_bytes(batch, "text"), batch.column("later").to_pylist()):
                keys = {np.array([r["a"], r["b"]], np.int64).tobytes(): r["first_doc"] for r in found or []}
                pieces = sentences(t)
                gone, where, seen = np.zeros(len(pieces), bool), set(), set()
                for start, end, h in runs_of(pieces, run, min_words):
                    if h in keys or h in seen:
                        gone[start:end] = True
                        where.add(keys.get(h, k))
                    seen.add(h)
                texts.append(t if not gone.any() else b"".join(p for p, g in zip(pieces, gone) if not g))
                n_sent.append(len(pieces))
                n_removed.append(int(gone.sum()))
                firsts.append(sorted(x for x in where if x is not None))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                    pa.array(n_sent, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(firsts, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text", "n_sentences", "n_removed", "first_docs"],
            )

    return d.mapInArrow(
        strip, "doc_id long, text string, n_sentences long, n_removed long, first_docs array<long>"
    )
