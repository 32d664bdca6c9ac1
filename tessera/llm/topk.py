"""Exact top-k by inner product with multi-resolution segment statistics.

For a segment of ``n`` components with means a, b and deviations s, t (roots
of the summed squares around the mean), x.y is at most n*a*b + s*t; summed
over segments this bounds the inner product from above, that is the distance
from below.  Coarse segments are tried first, finer ones on what is left, and
the exact product is taken for the survivors only.

Queries and vectors are dealt into blocks by a shuffle; every block of queries
meets every block of vectors in one group of bounded size, and the driver sees
only how many rows there are and how long they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut

SCALE = 64
TOP = 20
LEVELS = (2, 8, 32)
# Rows of a block; fewer where they are long, by the components of a block.
QUERY_BLOCK = 4096
VECTOR_BLOCK = 16_384
BLOCK_COMPONENTS = 1 << 22
# Candidates that are bounded and scored together.
STEP = 1024


def _usable() -> F.Column:
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return e.isNotNull() & ~bad


def scaled_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): components as floor(scale * x).  Rows with a null id, a
    null vector or a null or non-finite component take no part; a component
    beyond a long is an error."""
    e = F.col("embedding").cast("array<double>")
    beyond = F.raise_error(F.lit("a scaled component does not fit a long")).cast("long")
    y = lambda x: x * F.lit(float(scale))
    v = F.transform(e, lambda x: F.when(F.abs(y(x)) < F.lit(2.0**63), F.floor(y(x))).otherwise(beyond))
    return vectors.filter(F.col("vec_id").isNotNull() & _usable()).select("vec_id", v.alias("v"))


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows of sqrt(n)*mean and deviation per segment: the product of two rows
    bounds the inner product of the vectors from above."""
    parts = np.array_split(x, min(segments, max(1, x.shape[1])), axis=1)
    out = []
    for p in parts:
        n = p.shape[1]
        mean = p.mean(axis=1) if n else np.zeros(len(x))
        out += [np.sqrt(n) * mean, np.sqrt(np.square(p - mean[:, None]).sum(axis=1))]
    return np.stack(out, axis=1)


class Block:
    """Vectors of a block: whole numbers, their doubles and segment features."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, levels: tuple[int, ...]):
        self.ids, self.v, self.x = ids, v, v.astype(np.float64)
        self.features = [segment_features(self.x, s) for s in levels]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Lists of whole numbers as rows, cut or padded with zeros to ``dim``."""
    a = column.combine_chunks()
    out = np.zeros((len(a), dim), np.int64)
    n = a.value_lengths().to_numpy(zero_copy_only=False)
    flat = a.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(a)), n)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    fits = at < dim
    out[row[fits], at[fits]] = flat[fits]
    return out


def _exact_in_doubles(q: Block, c: Block) -> bool:
    """Whether products and sums of these whole numbers are exact in doubles."""
    dim = max(1, q.x.shape[1])
    return np.abs(q.x).max(initial=0) * np.abs(c.x).max(initial=0) * dim < 2.0**53


class Best:
    """The ``k`` best (score, id) of each of ``n`` queries so far, by query."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.query, self.ids, self.scores = (np.empty(0, np.int64) for _ in range(3))

    def floor(self) -> np.ndarray:
        """Each query's lowest kept score, while it has ``k``; else -inf."""
        out = np.full(self.n, -np.inf)
        last = np.cumsum(np.bincount(self.query, minlength=self.n)) - 1
        full = np.bincount(self.query, minlength=self.n) == self.k
        out[full] = self.scores[last[full]].astype(np.float64)
        return out

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        query, ids = np.concatenate([self.query, query]), np.concatenate([self.ids, ids])
        scores = np.concatenate([self.scores, scores])
        if scores.dtype == object:
            order = np.array(sorted(range(len(query)), key=lambda j: (query[j], -scores[j], ids[j])), np.int64)
        else:
            order = np.lexsort((ids, -scores, query))
        query = query[order]
        keep = np.arange(len(query)) - np.searchsorted(query, query) < self.k
        self.query, self.ids, self.scores = query[keep], ids[order][keep], scores[order][keep]


def _search(q: Block, c: Block, copies: np.ndarray, best: Best) -> None:
    """Fold the candidates into the queries' best."""
    k, bar = best.k, best.floor()
    # What rounding can take from a bound or a bar.
    slack = 1e-9 * (1 + np.abs(q.features[0]).sum(axis=1) * np.abs(c.features[0]).sum(axis=1).max(initial=0))
    alive = q.ids[:, None] != c.ids[None, :]
    new = np.flatnonzero(np.isinf(bar))
    if len(new) and len(c.ids) > k:
        # No bar yet: the candidates with the highest bounds set one.
        bound = np.where(alive[new], q.features[-1][new] @ c.features[-1].T, -np.inf)
        head = np.argpartition(-bound, k - 1, axis=1)[:, :k]
        low = np.min([np.einsum("ij,ij->i", c.x[h], q.x[new]) for h in head.T], axis=0)
        bar[new] = np.where(alive[new[:, None], head].all(axis=1), low, -np.inf)
    rows, cols = np.arange(len(q.ids)), np.arange(len(c.ids))
    for f, g in zip(q.features, c.features):
        # Coarse to fine: whole queries and candidates leave as soon as no pair is left.
        alive &= f[rows] @ g[cols].T >= (bar - slack)[rows, None]
        r, t = alive.any(axis=1), alive.any(axis=0)
        rows, cols, alive = rows[r], cols[t], alive[np.ix_(r, t)]
    if not alive.size:
        return
    if _exact_in_doubles(q, c):
        products = q.x[rows] @ c.x[cols].T
        i, j = np.nonzero(alive & (products >= bar[rows, None]))
        scores = products[i, j].astype(np.int64)
    else:
        # Large components: the survivors' products as Python's whole numbers.
        i, j = np.nonzero(alive)
        scores = np.array([sum(a * b for a, b in zip(q.v[rows[x]].tolist(), c.v[cols[y]].tolist())) for x, y in zip(i, j)], object)
    n = copies[cols[j]]
    best.add(np.repeat(rows[i], n), np.repeat(c.ids[cols[j]], n), np.repeat(scores, n))


def _blocks(rows: DataFrame, most: int) -> int:
    """In how many blocks the rows go: by their number and by their length."""
    n, dim = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    return max(1, -(-n // max(1, min(most, BLOCK_COMPONENTS // max(1, dim)))))


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = TOP,
    levels: tuple[int, ...] = LEVELS,
    query_block: int = QUERY_BLOCK,
    vector_block: int = VECTOR_BLOCK,
) -> DataFrame:
    """The ``k`` highest inner products of each query among the other rows.

    ``vectors`` and ``queries`` hold (vec_id, v array<long>); a row is not a
    candidate of a query with its own id.  Returns query_id, rank (from 1),
    vec_id, score; ties go to the smaller vec_id.  Shorter vectors count as
    padded with zeros.  Rows of one query id are one query, the smallest of
    its vectors; repeated candidate rows each take a place, up to ``k``.  A
    score of the result that does not fit a long is an error.  Empty tables
    give no rows.

    Equal rows are counted before anything else, so no id fills a block; rows
    without a vector take no part.  Blocks hold about ``query_block`` and
    ``vector_block`` rows, fewer if they are long; every pair of blocks yields
    its queries' best ``k`` only.
    """
    has = F.col("vec_id").isNotNull() & F.col("v").isNotNull()
    c = cut(vectors.filter(has).groupBy("vec_id", "v").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("copies")))
    q = cut(queries.filter(has).groupBy("vec_id").agg(F.min("v").alias("v")))
    nq, nc = _blocks(q, query_block), _blocks(c, vector_block)

    def dealt(rows: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")
        # Columns of each side's own, as both come from the same table.
        mine = [F.col(x).alias(x, metadata={"side": own}) for x in rows.columns]
        return rows.select(*mine, block.alias(own), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))

    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.string())])

    def meet(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not queries.num_rows or not vectors.num_rows:
            return out.empty_table()
        lengths = queries["v"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        # Components beyond the queries' length meet zeros only.
        dim = int(lengths.max(initial=0))
        qs = Block(queries["vec_id"].to_numpy(), _matrix(queries["v"], dim), levels)
        best = Best(len(qs.ids), k)
        for at in range(0, vectors.num_rows, STEP):
            part = vectors.slice(at, STEP)
            some = Block(part["vec_id"].to_numpy(), _matrix(part["v"], dim), levels)
            _search(qs, some, part["copies"].to_numpy(), best)
        # The score as text: whether it fits a long is asked of the final ranks
        # only, and beyond 38 digits it cannot.
        limit = 10**38 - 1
        return pa.table(
            {
                "query_id": qs.ids[best.query],
                "vec_id": best.ids,
                "score": [str(max(-limit, min(limit, v))) for v in best.scores.tolist()],
            },
            schema=out,
        )

    left = dealt(q, "qb", nq, "cb", nc).groupBy("qb", "cb")
    right = dealt(c, "cb", nc, "qb", nq).groupBy("qb", "cb")
    found = left.cogroup(right).applyInArrow(meet, "query_id long, vec_id long, score string")
    score = F.col("score").cast("decimal(38,0)")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.withColumn("score", score)
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))
    )
