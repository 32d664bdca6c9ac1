"""Toxic spans by a linear-chain conditional random field.

Documents carry a label, tokens do not: a token of a toxic document counts as
labelled toxic if its word or stem is found almost only in toxic documents of
the training rows.  A two-state chain over each sentence is fitted to those
token labels; its inputs are the log-odds of the token's word and of its first
four and five characters, so that unseen endings of a stem are still seen.
Forward-backward marginals give the spans, and a logistic function of their
sums and largest values the document's score.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Batches, alnum_words, as_bytes, share, shared
from tessera.llm.spans import sentences

# Bounds of what the model is fitted on, all of them rows in the order of their
# ids' hash: labelled rows of each class for the features' statistics (None: all),
# and of these for the chain and the score, rows of each class and bytes of text.
TRAIN_ROWS = 10_000
FIT_ROWS = 300
FIT_BYTES = 8 << 20
MIN_DOCS = 5
MIN_Z = 3.0
PRECISION = 0.9
THRESHOLD = 0.3
# Longer chains go through the products of their steps instead of step by step.
LONG_CHAIN = 512

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def features_of(word: bytes) -> tuple[bytes, bytes, bytes]:
    """The word, its first four and its first five characters (marked)."""
    s = word.decode("utf-8", "replace")
    return b"w" + word, b"4" + s[:4].encode(), b"5" + s[:5].encode()


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the labelled ids that may be learned from.

    Ids whose crc32(doc_id as text) mod 4 is 2 are held out, null ids are never
    learned from.  Labels other than 0 and 1 are dropped, several of one
    document count as the highest.
    """
    y = labels.filter("toxic in (0, 1) and doc_id is not null").filter(~held_out())
    return y.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def training_rows(docs: DataFrame, y: DataFrame, train_rows: int | None) -> DataFrame:
    """(doc_id, text, toxic) of at most ``train_rows`` labelled ids of each class.

    The ids are chosen from the labels alone and sent to the documents, so no
    text is moved; without a bound both sides are joined as Spark sees fit.
    """
    if train_rows is not None:
        order = [F.xxhash64("doc_id"), F.col("doc_id")]
        chosen = [r for k in (0, 1) for r in y.filter(F.col("toxic") == k).orderBy(*order).limit(train_rows).collect()]
        y = F.broadcast(docs.sparkSession.createDataFrame(chosen, y.schema))
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    y = y.withColumnRenamed("doc_id", "y_id")
    return d.join(y, F.col("doc_id") == F.col("y_id")).select("doc_id", "text", "toxic")


def held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


def feature_counts(train: DataFrame) -> DataFrame:
    """(feature, toxic, docs): documents with the feature, over all training rows."""

    def count(batches: Batches) -> Batches:
        known: dict[bytes, tuple] = {}
        for batch in batches:
            toxic, docs = Counter(), Counter()
            for t, y in zip(as_bytes(batch, "text"), batch.column("toxic").to_pylist()):
                own = set()
                for w in set(alnum_words(t)):
                    f = known.get(w)
                    if f is None:
                        if len(known) >= 100_000:
                            known.clear()
                        f = known[w] = features_of(w)
                    own.update(f)
                docs.update(own)
                if y:
                    toxic.update(own)
            names = list(docs)
            for at in range(0, len(names), 100_000):
                part = names[at : at + 100_000]
                yield pa.RecordBatch.from_pydict(
                    {
                        "feature": pa.array(part, pa.binary()),
                        "toxic": pa.array([toxic[f] for f in part], pa.int64()),
                        "docs": pa.array([docs[f] for f in part], pa.int64()),
                    }
                )

    rows = train.select("text", "toxic").mapInArrow(count, "feature binary, toxic long, docs long")
    return rows.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs"))


class ToxicModel:
    """Feature log-odds, chain weights and the weights of the document score."""

    def __init__(self, odds: dict[bytes, float], labelled: set[bytes]):
        self.odds, self.labelled = odds, labelled
        self.w = np.array([1.0, 0.5, 0.5, -6.0])
        self.t = np.zeros((2, 2))
        self.score_w = np.array([1.0, 2.0, 2.0, -4.0])

    def inputs(self, words: list[bytes], cache: dict[bytes, tuple]) -> np.ndarray:
        out = np.empty((len(words), 4))
        for i, w in enumerate(words):
            x = cache.get(w)
            if x is None:
                if len(cache) > 300_000:
                    cache.clear()
                x = cache[w] = (*(self.odds.get(f, 0.0) for f in features_of(w)), 1.0)
            out[i] = x
        return out

    def is_labelled(self, word: bytes) -> bool:
        return any(f in self.labelled for f in features_of(word))


class Emissions(dict):
    """The second state's score of each word, kept while the vocabulary is small."""

    LIMIT = 300_000

    def __init__(self, model: ToxicModel):
        super().__init__()
        self.odds = model.odds
        self.w = [float(x) for x in model.w]

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.LIMIT:
            self.clear()
        score = self.w[3]
        for f, w in zip(features_of(word), self.w):
            odds = self.odds.get(f)
            if odds is not None:
                score += odds * w
        self[word] = score
        return score

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.float64, len(words))


def _products(steps: np.ndarray) -> np.ndarray:
    """Products of each matrix with all before it (doubling), scaled."""
    out, k = steps.copy(), 1
    while k < len(out):
        out[k:] = out[:-k] @ out[k:]
        out /= out.max(axis=(1, 2), keepdims=True)
        k *= 2
    return out


def _long_chain(e: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward vectors of one long chain, from products of its
    2x2 steps: logarithmically many passes instead of one for every token."""
    step = m[None] * e[1:, None, :]
    alpha = np.concatenate([e[:1], e[0] @ _products(step)])
    back = _products(step[::-1].transpose(0, 2, 1))[::-1].transpose(0, 2, 1)
    beta = np.concatenate([back.sum(axis=2), np.ones((1, 2))])
    return (x / x.sum(axis=1, keepdims=True) for x in (alpha, beta))


def chain_marginals(
    emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray, count_pairs: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Marginal of the second state for every token, and the expected counts
    of the four transitions (zeros without ``count_pairs``).

    ``emit`` has the second state's score of all tokens, chain after chain (the
    first state's is 0).  Chains of similar length go through the forward and
    backward steps together.
    """
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(lengths) else np.empty(0, np.int64)
    p = np.empty(len(emit))
    pairs = np.zeros((2, 2))
    m = np.exp(trans)
    bucket = np.ceil(np.log2(np.maximum(lengths, 1))).astype(int) if len(lengths) else np.empty(0, int)
    for b in np.unique(bucket):
        which = np.flatnonzero((bucket == b) & (lengths > 0))
        if 1 << b > LONG_CHAIN:
            for i in which:
                at = slice(starts[i], starts[i] + lengths[i])
                e1 = 1 / (1 + np.exp(-np.clip(emit[at], -50, 50)))
                e = np.stack([1 - e1, e1], axis=1)
                alpha, beta = _long_chain(e, m)
                g = alpha * beta
                p[at] = g[:, 1] / g.sum(axis=1)
                if count_pairs:
                    x = alpha[:-1, :, None] * m[None] * (e[1:] * beta[1:])[:, None, :]
                    pairs += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            continue
        size = max(1, 2_000_000 >> int(b))
        for at in range(0, len(which), size):
            own = which[at : at + size]
            n = lengths[own]
            steps = int(n.max())
            pos = starts[own][:, None] + np.minimum(np.arange(steps), n[:, None] - 1)
            inside = np.arange(steps) < n[:, None]
            e1 = 1 / (1 + np.exp(-np.clip(emit[pos], -50, 50)))
            e = np.stack([1 - e1, e1], axis=2)
            alpha, beta = np.empty_like(e), np.empty_like(e)
            a = e[:, 0].copy()
            alpha[:, 0] = a / a.sum(axis=1, keepdims=True)
            for k in range(1, steps):
                a = (alpha[:, k - 1] @ m) * e[:, k]
                alpha[:, k] = a / a.sum(axis=1, keepdims=True)
            last = np.ones((len(own), 2)) / 2
            beta[:, steps - 1] = last
            for k in range(steps - 2, -1, -1):
                v = (e[:, k + 1] * beta[:, k + 1]) @ m.T
                v /= v.sum(axis=1, keepdims=True)
                beta[:, k] = np.where((k + 1 < n)[:, None], v, last)
            g = alpha * beta
            g /= g.sum(axis=2, keepdims=True)
            p[pos[inside]] = g[:, :, 1][inside]
            if count_pairs and steps > 1:
                x = alpha[:, :-1, :, None] * m[None, None] * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
                x /= x.sum(axis=(2, 3), keepdims=True)
                pairs += x[inside[:, 1:]].sum(axis=0)
    return p, pairs


def _tokens(text: bytes | None) -> tuple[list[bytes], list[int]]:
    """Words of the text and the lengths of its chains, the sentences."""
    words, lengths = [], []
    for s in sentences(text):
        own = alnum_words(s)
        words += own
        if own:
            lengths.append(len(own))
    return words, lengths


def _summary(p: np.ndarray) -> np.ndarray:
    top = np.sort(p)[-2:]
    return np.array([np.log1p(p.sum()), top[-1] if len(top) else 0.0, top[0] if len(top) > 1 else 0.0, 1.0])


def _fit_chain(model: ToxicModel, rows: list[tuple[bytes, int]], rounds: int = 30) -> None:
    cache: dict = {}
    words, lengths, y = [], [], []
    for text, toxic in rows:
        w, n = _tokens(text)
        words += w
        lengths += n
        y += [float(toxic and model.is_labelled(x)) for x in w]
    if not words:
        return
    x, y, lengths = model.inputs(words, cache), np.array(y), np.array(lengths)
    follows = np.ones(len(y), bool)
    follows[np.cumsum(np.concatenate([[0], lengths]))[:-1]] = False
    prev, here = y[:-1][follows[1:]].astype(int), y[1:][follows[1:]].astype(int)
    seen = np.zeros((2, 2))
    np.add.at(seen, (prev, here), 1)
    moment, square = np.zeros(8), np.zeros(8)
    for k in range(1, rounds + 1):
        p, pairs = chain_marginals(x @ model.w, lengths, model.t)
        grad = np.concatenate([(y - p) @ x, (seen - pairs).ravel()]) / max(1.0, y.sum())
        grad -= 0.001 * np.concatenate([model.w, model.t.ravel()])
        moment, square = 0.9 * moment + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        step = 0.3 * (moment / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
        model.w, model.t = model.w + step[:4], model.t + step[4:].reshape(2, 2)


def _fit_score(model: ToxicModel, rows: list[tuple[bytes, int]], prior: float) -> None:
    """Logistic regression on the documents' marginals, classes weighted to ``prior``."""
    emissions = Emissions(model)
    f, y = [], []
    for text, toxic in rows:
        w, n = _tokens(text)
        f.append(_summary(chain_marginals(emissions.of(w), np.array(n, int), model.t, count_pairs=False)[0]))
        y.append(float(toxic))
    f, y = np.array(f), np.array(y)
    share_ = max(1e-9, y.mean()), max(1e-9, 1 - y.mean())
    weight = np.where(y > 0, prior / share_[0], (1 - prior) / share_[1])
    w = np.array([0.0, 0.0, 0.0, np.log(prior / (1 - prior))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
        grad = f.T @ (weight * (y - p)) - 0.05 * np.append(w[:3], 0)
        hess = (f * (weight * p * (1 - p))[:, None]).T @ f + np.diag([0.05, 0.05, 0.05, 1e-6])
        w = w + np.clip(np.linalg.solve(hess, grad), -2, 2)
    model.score_w = w


def _fit_texts(train: DataFrame, fit_rows: int, fit_bytes: int) -> list[tuple[bytes, int]]:
    """(text, toxic) of the first rows of each class by hash, as far as both bounds
    allow; of several texts under one id the smallest."""
    each = train.groupBy("doc_id", "toxic").agg(F.max(F.octet_length("text")).alias("size"))
    ids = []
    for y in (0, 1):
        own = each.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).collect()
        left = fit_bytes // 2
        for r in own:
            if r["size"] <= left:
                ids.append(r["doc_id"])
                left -= r["size"]
    if not ids:
        return []
    texts = train.filter(F.col("doc_id").isin(ids)).groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return [(r["text"].encode(), r["toxic"]) for r in sorted(texts.collect(), key=lambda r: (r["toxic"], r["doc_id"]))]


def fit_toxic_model(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: int | None = TRAIN_ROWS,
    fit_rows: int = FIT_ROWS,
    fit_bytes: int = FIT_BYTES,
) -> ToxicModel:
    """Learn the features' odds from at most ``train_rows`` labelled rows of each
    class (None: all), the chain and the score from a part of these, at most
    ``fit_rows`` of each class with ``fit_bytes`` of text together.

    Every feature that passes the test is kept.  Classes count by their shares
    of all labels.  Without training rows, or with one class only, scores stay at
    the base rate.
    """
    y = training_labels(labels)
    n, n1 = y.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    odds: dict[bytes, float] = {}
    labelled: set[bytes] = set()
    rows: list[tuple[bytes, int]] = []
    if 0 < n1 < n:
        train = training_rows(docs, y, train_rows)
        s, s1 = train.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
        if 0 < s1 < s:
            # A row of the sample stands for so many labelled ones of its class.
            w1, w0 = n1 / s1, (n - n1) / (s - s1)
            share1 = s1 / s
            c = feature_counts(train).filter(F.col("docs") >= MIN_DOCS)
            # Score test of the feature's share of toxic documents.
            z = (F.col("toxic") - F.col("docs") * share1) / F.sqrt(F.col("docs") * share1 * (1 - share1))
            for r in c.filter(F.abs(z) >= MIN_Z).orderBy("feature").collect():
                a, b = r["toxic"], r["docs"] - r["toxic"]
                odds[bytes(r["feature"])] = float(np.log(((a + 0.5) / (s1 + 1)) / ((b + 0.5) / (s - s1 + 1))))
                if a * w1 >= PRECISION * (a * w1 + b * w0):
                    labelled.add(bytes(r["feature"]))
            rows = _fit_texts(train, fit_rows, fit_bytes)
    model = ToxicModel(odds, labelled)
    prior = min(0.999, max(0.001, n1 / n)) if n else 0.5
    if odds and len({k for _, k in rows}) == 2:
        _fit_chain(model, rows)
        _fit_score(model, rows, prior)
    else:
        model.score_w = np.array([0.0, 0.0, 0.0, np.log(prior / (1 - prior))])
    return model


def _score_texts(texts: list[bytes | None], model: ToxicModel, emissions: Emissions) -> list[tuple[float, np.ndarray]]:
    """(score, marginal of each word) of every text."""
    parts = [_tokens(t) for t in texts]
    words = [w for ws, _ in parts for w in ws]
    lengths = np.array([n for _, ns in parts for n in ns], int)
    p, _ = chain_marginals(emissions.of(words), lengths, model.t, count_pairs=False)
    each = np.split(p, np.cumsum([len(ws) for ws, _ in parts])[:-1])
    return [(float(1 / (1 + np.exp(-np.clip(_summary(own) @ model.score_w, -30, 30)))), own) for own in each]


def tag_toxic(docs: DataFrame, model: ToxicModel, span_at: float = 0.5) -> DataFrame:
    """doc_id, score, spans for every row.

    ``spans`` has the words whose marginal is at least ``span_at``, as code
    points (start, end exclusive) with the marginal.  Null, empty and wordless
    texts have no spans and the score of no evidence.
    """
    sent = share(docs.sparkSession, model)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())])

    def tag(batches: Batches) -> Batches:
        model = shared(sent)
        emissions = Emissions(model)
        for batch in batches:
            scores, spans = [], []
            for at in range(0, batch.num_rows, 256):
                texts = as_bytes(batch.slice(at, 256), "text")
                for t, (s, own) in zip(texts, _score_texts(texts, model, emissions)):
                    scores.append(s)
                    hot = np.flatnonzero(own >= span_at)
                    found = []
                    if len(hot):
                        at_word = [m.span() for m in _WORD.finditer(t)]
                        for i in hot:
                            a, b = at_word[i]
                            a0 = len(t[:a].decode())
                            found.append({"start": a0, "end": a0 + len(t[a:b].decode()), "marginal": float(own[i])})
                    spans.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))],
                names=["doc_id", "score", "spans"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, spans array<struct<start:int,end:int,marginal:double>>"
    return docs.select("doc_id", "text").mapInArrow(tag, schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_spans for every row of ``docs``."""
    t = tag_toxic(docs, fit_toxic_model(docs, labels))
    return t.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below ``threshold``, all columns as they are."""
    model = fit_toxic_model(docs, labels)
    sent = share(docs.sparkSession, model)

    def keep(batches: Batches) -> Batches:
        model = shared(sent)
        emissions = Emissions(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                scores = [s for s, _ in _score_texts(as_bytes(part, "text"), model, emissions)]
                yield part.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
