"""Fingerprints of documents as sums of their paragraphs' vectors.

A paragraph (what stands between line ends) is hashed to a wide vector: 8 lanes
of 64 bits from its whole content, and 256 lanes of 16 bits that count, with
signs, the pieces that begin at its words.  A document's fingerprint is the sum of its
paragraphs' vectors, each lane modulo its power of two.  So the order of
paragraphs does not matter, equal multisets of paragraphs have equal
fingerprints (unlike ones the same with odds of about 2**-64), and a paragraph
is put in or taken out by one addition or subtraction.

The 16-bit lanes are a linear sketch: the squared length of the difference of
two sums estimates how many pieces the two texts do not share.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Batches, mix

WIDE, LANES, PIECE = 8, 256, 24
BUCKET_BYTES = 64 << 20
_AT_ONCE = 2 << 20


def paragraphs(text: str | None) -> list[str]:
    """The text's lines, blank ones too; a null or empty text has none."""
    return text.split("\n") if text else []


def _exact(parts: list[list[bytes]]) -> np.ndarray:
    out = np.zeros((len(parts), WIDE), np.uint64)
    for row, lines in zip(out, parts):
        if lines:
            raw = b"".join([hashlib.blake2b(x).digest() for x in lines])
            row[:] = np.frombuffer(raw, np.uint64).reshape(-1, WIDE).sum(axis=0, dtype=np.uint64)
    return out


def _sketch(parts: list[list[bytes]]) -> np.ndarray:
    """Signed counts, modulo 2**16, of the pieces: the ``PIECE`` bytes from each
    word's start on, cut off where the paragraph ends."""
    texts = [b"\n".join(x) for x in parts]
    raw = np.frombuffer(b"\n".join(texts) + b"\n" + bytes(PIECE), np.uint8)
    inside = raw > 32
    begins = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    if not len(begins):
        return np.zeros((len(parts), LANES), np.uint16)
    ends = np.flatnonzero(raw == 10)
    left = ends[np.searchsorted(ends, begins)] - begins
    piece = np.lib.stride_tricks.sliding_window_view(raw, PIECE)[begins]
    piece[np.arange(PIECE) >= left[:, None]] = 0
    h = np.full(len(begins), PIECE, np.uint64)
    for word in piece.view(np.uint64).T:
        h = mix(h, word)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    doc = np.searchsorted(starts, begins, side="right") - 1
    h = h >> np.uint64(20)
    sign = 1 - 2 * ((h >> np.uint64(8)) & np.uint64(1)).astype(np.int64)
    lane = doc * LANES + (h & np.uint64(LANES - 1)).astype(np.int64)
    sums = np.bincount(lane, weights=sign, minlength=len(parts) * LANES)
    return sums.astype(np.int64).astype(np.uint16).reshape(len(parts), LANES)


class Fingerprints:
    """Fingerprints of several texts; ``+`` puts paragraphs in, ``-`` takes them out."""

    def __init__(self, exact: np.ndarray, sketch: np.ndarray):
        self.exact, self.sketch = exact, sketch

    @classmethod
    def of(cls, parts: list[list[str]]) -> Fingerprints:
        """Of lists of paragraphs."""
        raw = [[x.encode() for x in lines] for lines in parts]
        exact, sketch = [np.zeros((0, WIDE), np.uint64)], [np.zeros((0, LANES), np.uint16)]
        at = 0
        while at < len(raw):
            end, held = at, 0
            while end < len(raw) and (end == at or held < _AT_ONCE):
                held += sum(map(len, raw[end]))
                end += 1
            exact.append(_exact(raw[at:end]))
            sketch.append(_sketch(raw[at:end]))
            at = end
        return cls(np.concatenate(exact), np.concatenate(sketch))

    def __add__(self, other: Fingerprints) -> Fingerprints:
        return Fingerprints(self.exact + other.exact, self.sketch + other.sketch)

    def __sub__(self, other: Fingerprints) -> Fingerprints:
        return Fingerprints(self.exact - other.exact, self.sketch - other.sketch)

    def __getitem__(self, rows) -> Fingerprints:
        return Fingerprints(self.exact[rows], self.sketch[rows])

    def texts(self) -> list[str]:
        return [base64.b64encode(a.tobytes() + b.tobytes()).decode() for a, b in zip(self.exact, self.sketch)]

    @classmethod
    def parse(cls, texts: list[str]) -> Fingerprints:
        raw = [base64.b64decode(t) for t in texts]
        exact = np.array([np.frombuffer(r[: 8 * WIDE], np.uint64) for r in raw], np.uint64).reshape(-1, WIDE)
        sketch = np.array([np.frombuffer(r[8 * WIDE :], np.uint16) for r in raw], np.uint16).reshape(-1, LANES)
        return cls(exact, sketch)

    def likeness(self, other: Fingerprints) -> np.ndarray:
        """Estimated share of common pieces (twice the common ones over all of
        both), 0 to 1, row by row: 1 for equal fingerprints, and 0 for unlike
        ones without any words.  Exact lengths need sums below 2**15 a lane."""
        a, b = (x.view(np.int16).astype(np.float64) for x in (self.sketch, other.sketch))
        apart = ((self.sketch - other.sketch).view(np.int16).astype(np.float64) ** 2).sum(axis=1)
        both = (a**2).sum(axis=1) + (b**2).sum(axis=1)
        like = np.where(both > 0, np.clip(1 - apart / np.maximum(both, 1), 0, 1), 0.0)
        same = (self.exact == other.exact).all(axis=1) & (self.sketch == other.sketch).all(axis=1)
        return np.where(same, 1.0, like)


def fingerprint(text: str | None) -> str:
    """Fingerprint of one text."""
    return Fingerprints.of([paragraphs(text)]).texts()[0]


def edit(text: str, following: str) -> tuple[str, list[str], list[str]]:
    """The text with its last quarter replaced by as many code points from the
    start of the following one, the paragraphs this takes out and those it puts in."""
    k = len(text) // 4
    if not k:
        return text, [], []
    keep = len(text) - k
    edited = text[:keep] + following[:k]
    at = text.rfind("\n", 0, keep) + 1
    put = edited[at:].split("\n") if at or edited else []
    return edited, text[at:].split("\n"), put


def _bounds(docs: DataFrame, bucket_bytes: int) -> list[tuple]:
    """First key of each of many ranges of (doc_id, hash of text), in order."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    conf = docs.sparkSession.conf
    n = max(2 * int(conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_bytes))
    dealt = docs.select("doc_id", "h").repartitionByRange(n, "doc_id", "h")
    first = dealt.groupBy(F.spark_partition_id()).agg(F.min(F.struct("doc_id", "h")).alias("k"))
    return sorted(_key(r["k"]["doc_id"], r["k"]["h"]) for r in first.select("k").collect())


def _key(doc_id, h: int) -> tuple:
    return (doc_id is not None, doc_id if doc_id is not None else 0, h)


def edited_fingerprints(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next for every row.

    A null text counts as empty.  Rows follow one another by doc_id (null
    first), then by a hash of the text and the text; the first follows the
    last, a single row itself.  The edited text's fingerprint is the text's own less
    the paragraphs that the edit takes out, plus those it puts in.

    Texts move once: to the bucket of their range of keys.  A bucket's first
    row also goes, as a guard, to the bucket before.  A doc_id (null too)
    held by many rows is split by the texts' hashes; rows equal in both stay
    together, one after the other.
    """
    text = F.coalesce("text", F.lit(""))
    src = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"))
    bounds = _bounds(src, bucket_bytes)
    at = {k: i for i, k in enumerate(bounds)}
    n = len(bounds)

    @F.arrow_udf("array<int>")
    def buckets(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        # A row's bucket; for a bucket's first row also the one before, as -1 - bucket.
        out = []
        for k in map(_key, ids.to_pylist(), hashes.to_pylist()):
            own = [bisect_right(bounds, k) - 1]
            if k in at:
                own.append(-1 - (at[k] - 1) % n)
            out.append(own)
        return pa.array(out, pa.list_(pa.int32()))

    dealt = (
        src.withColumn("b", F.explode(buckets("doc_id", "h")))
        .select(
            "doc_id",
            "text",
            "h",
            (F.col("b") < 0).alias("guard"),
            F.when(F.col("b") < 0, -1 - F.col("b")).otherwise(F.col("b")).alias("bucket"),
        )
        .repartition("bucket")
        .sortWithinPartitions("bucket", "guard", "doc_id", "h", "text")
    )

    def judge(batches: Batches) -> Batches:
        held: list[tuple] = []
        for batch in batches:
            cols = [batch.column(c) for c in ("bucket", "guard", "text")]
            ids = batch.column("doc_id")
            step = 200
            for a in range(0, batch.num_rows, step):
                part = [c.slice(a, step).to_pylist() for c in cols]
                rows = held + list(zip(*part, ids.slice(a, step).to_pylist()))
                yield _judged(rows, ids.type)
                held = rows[-1:]

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return dealt.select("bucket", "guard", "text", "doc_id").mapInArrow(judge, schema)


def _judged(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    """Results of all rows whose follower is among ``rows`` (bucket, guard, text, doc_id)."""
    own = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
    need = sorted({*own, *(i + 1 for i in own)})
    place = {i: j for j, i in enumerate(need)}
    every = Fingerprints.of([paragraphs(rows[i][2]) for i in need])
    edits = [edit(rows[i][2], rows[i + 1][2]) for i in own]
    mine, following = every[[place[i] for i in own]], every[[place[i + 1] for i in own]]
    edited = mine - Fingerprints.of([e[1] for e in edits]) + Fingerprints.of([e[2] for e in edits])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[i][3] for i in own], id_type),
            pa.array([len(rows[i][2]) for i in own], pa.int64()),
            pa.array([hashlib.sha256(e[0].encode()).hexdigest() for e in edits], pa.string()),
            pa.array(mine.texts(), pa.string()),
            pa.array(edited.texts(), pa.string()),
            pa.array(mine.likeness(edited), pa.float64()),
            pa.array(mine.likeness(following), pa.float64()),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every row, without any shuffle."""

    def each(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                found = Fingerprints.of([paragraphs(t) for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found.texts(), pa.string())], names=["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(each, f"doc_id {kind}, fingerprint string")
