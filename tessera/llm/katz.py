"""Scoring with a Katz backoff bigram model.

p(w | h) is the Good-Turing discounted share d(c(h,w)) * c(h,w) / c(h) where the
pair was seen in training, else a(h) * p(w), with a(h) such that the
probabilities after h add up to one; p(w) is discounted likewise, what is left
going to all unknown words together.

The counts are tables partitioned by the word's hash.  Documents send each
partition their distinct pairs, packed by chunks of documents, with the
documents that have them; words that fill a large share of the corpus are
spread by their pairs.  A partition thus counts its pairs and words and scores
its part of every document.  Backoff weights need sums over all words after a
history: a second exchange, by history, adds up the partitions' sums and
gives the unseen pairs their weight.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Batches, cut, mix, share, shared

END, START = np.uint64(1), np.uint64(2)
# Counts above this are taken as reliable by Good and Turing's formula.
RELIABLE = 5
CHUNK_TOKENS = 1_000_000
# Counting keeps no documents apart, so its chunks can be larger.
COUNT_TOKENS = 1_500_000
# Bytes sent in one batch.
SEND_BYTES = 2_000_000
CHUNK_DOCS = 50_000
# Bytes of text that one partition of the tables stands for.
PARTITION_BYTES = 32_000_000


def held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1


def discounts(counts_of_counts: np.ndarray, reliable: int = RELIABLE) -> np.ndarray:
    """d(r) for r = 0 .. reliable, from n(1) .. n(reliable + 1).

    Katz's form of Good-Turing; where the formula has no value between 0 and 1
    (too few counts) half a count is taken off instead.  Counts above
    ``reliable`` lose half a count too, so every history keeps some mass for
    unseen words.
    """
    n = np.concatenate([[0.0], counts_of_counts.astype(float)])
    d = np.ones(reliable + 1)
    far = (reliable + 1) * n[reliable + 1] / n[1] if n[1] else 1.0
    for r in range(1, reliable + 1):
        x = ((r + 1) * n[r + 1] / (r * n[r]) - far) / (1 - far) if n[r] and far < 1 else 0.0
        d[r] = x if 0 < x < 1 else 1 - 0.5 / r
    return d


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """d(c) * c"""
    return np.where(c < len(d), d[np.minimum(c, len(d) - 1)] * c, c - 0.5)


class KatzModel:
    """Totals, discounts and the counts of the words that are spread."""

    def __init__(self, parts: int, docs: int, tokens: int, types: int, n1: np.ndarray, n2: np.ndarray, spread: dict[int, int]):
        self.parts, self.docs, self.tokens, self.types = parts, docs, tokens, types
        self.d1, self.d2 = discounts(n1), discounts(n2)
        r = np.arange(1, RELIABLE + 1)
        left = float((n1[:RELIABLE] * r * (1 - self.d1[1:])).sum() + 0.5 * (types - n1[:RELIABLE].sum()))
        self.unknown = left / tokens if tokens else 1.0
        self.spread_words = np.array(sorted(spread), np.uint64)
        self.spread_counts = np.array([spread[int(w)] for w in self.spread_words], np.int64)

    def unigram(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, discounted(c, self.d1) / max(1, self.tokens), self.unknown)

    def spread_at(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the words are spread, and their place in the list."""
        if not len(self.spread_words):
            return np.zeros(len(w), bool), np.zeros(len(w), np.int64)
        at = np.minimum(np.searchsorted(self.spread_words, w), len(self.spread_words) - 1)
        return self.spread_words[at] == w, at


def _group(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts by the keys (first key first), and where groups start."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    return order, np.flatnonzero(new)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where groups start in keys that are sorted already."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else values[:0]


def _hashes(texts: pa.Array) -> list[np.ndarray]:
    """Hashes of the words of each text: a word is hashed once for all its places."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, row = words.flatten(), pc.list_parent_indices(words).to_numpy()
    full = pc.greater(pc.binary_length(flat), 0)  # blanks at either end leave an empty piece
    flat, row = flat.filter(full).dictionary_encode(), row[full.to_numpy(zero_copy_only=False)]
    known = flat.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    met = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
    met += np.uint64(3) * (met < 3)  # keep clear of the two marks
    ends = np.cumsum(np.bincount(row, minlength=len(texts)))
    return np.split(met[flat.indices.to_numpy()], ends[:-1])


def _chunks(batches: Batches, only_training: bool, tokens: int = CHUNK_TOKENS):
    """(first row, doc ids, held out, word arrays) of at most ``tokens``
    tokens or CHUNK_DOCS documents; a longer document is a chunk of its own."""
    row = TaskContext.get().partitionId() << 40
    ids, held, words, size = [], [], [], 0
    # Few texts at a time are held in words.
    for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
        if only_training:
            batch = batch.filter(pc.invert(batch.column("held")))
        if not batch.num_rows:
            continue
        for k, out, w in zip(batch.column("doc_id").to_pylist(), batch.column("held").to_pylist(), _hashes(batch.column("text"))):
            if ids and (size + len(w) + 1 > tokens or len(ids) >= CHUNK_DOCS):
                yield row, ids, held, words
                row += len(ids)
                ids, held, words, size = [], [], [], 0
            ids.append(k)
            held.append(out)
            words.append(w)
            size += len(w) + 1
    if ids:
        yield row, ids, held, words


def _pairs(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(vocabulary, word, history, document) of every token of the chunk: the
    chunk's hashes in order, and places in them."""
    n = np.array([len(w) + 1 for w in words])
    ends = np.cumsum(n)
    total = int(ends[-1])
    codes, met = pd.factorize(np.concatenate(words))
    order = np.argsort(met)
    rank = np.empty(len(met), np.uint32)
    rank[order] = np.arange(2, len(met) + 2, dtype=np.uint32)  # the marks come first
    flat = rank[codes]
    w, h = np.empty(total, np.uint32), np.empty(total, np.uint32)
    last = np.zeros(total, bool)
    last[ends - 1] = True
    w[last], w[~last] = 0, flat
    first = np.zeros(total, bool)
    first[ends - n] = True
    h[first], h[~first] = 1, flat
    return np.append(np.array([END, START]), met[order]), w, h, np.repeat(np.arange(len(words), dtype=np.uint16), n)


def _parts_of(vocab: np.ndarray, w: np.ndarray, h: np.ndarray, hot: np.ndarray, parts: int) -> np.ndarray:
    """Partition of each pair: its word's, or for hot words its own."""
    part = (vocab % np.uint64(parts)).astype(np.uint32)[w]
    often = np.isin(vocab, hot)
    if often.any():
        often = often[w]
        part[often] = mix(vocab[w[often]], vocab[h[often]]) % np.uint64(parts)
    return part


def _distinct(*keys: tuple[np.ndarray, int]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of (column, number of its values), in order, and how
    often each occurs.  Columns that fit into 64 bits together are sorted as one."""
    bits = [max(1, (size - 1).bit_length()) for _, size in keys]
    if sum(bits) > 64:
        order, starts = _group(*[k for k, _ in keys])
        return [k[order[starts]] for k, _ in keys], np.diff(np.append(starts, len(order)))
    whole = keys[0][0].astype(np.uint64)
    for (k, _), b in zip(keys[1:], bits[1:]):
        whole <<= np.uint64(b)
        whole |= k
    whole.sort()
    starts = _starts(whole)
    n = np.diff(np.append(starts, len(whole)))
    whole, out = whole[starts], []
    for (k, _), b in zip(keys[::-1], bits[::-1]):
        out.append((whole & np.uint64((1 << b) - 1)).astype(k.dtype))
        whole >>= np.uint64(b) if b < 64 else np.uint64(63)
    return out[::-1], n


def _send(rows: Iterator[tuple[int, bytes]]) -> Batches:
    """Batches of about SEND_BYTES, so that a chunk's rows are not all held at once."""
    part, data, size = [], [], 0
    for p, b in rows:
        part.append(p)
        data.append(b)
        size += len(b)
        if size >= SEND_BYTES:
            yield pa.record_batch([pa.array(part, pa.int32()), pa.array(data, pa.binary())], names=["part", "data"])
            part, data, size = [], [], 0
    if part:
        yield pa.record_batch([pa.array(part, pa.int32()), pa.array(data, pa.binary())], names=["part", "data"])


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    """One task for each partition of the tables: a task that holds several would
    sort them all before the first is done."""
    return rows.repartitionById(parts, F.col("part"))


def _release() -> None:
    """Give freed memory back to the system; the worker goes on to other steps."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def _small(x: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as they need."""
    top = int(x.max(initial=0))
    return x.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32 if top < 2**32 else np.uint64)


_ARRAY = "ndarray"


def _encode(x: object) -> object:
    """Arrays byte by byte, like bytes of all members together: sorted hashes
    and small counts then compress well."""
    if isinstance(x, np.ndarray):
        raw = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize)
        return (_ARRAY, x.dtype.str, raw.T.tobytes())
    if isinstance(x, dict):
        return {k: _encode(v) for k, v in x.items()}
    return [_encode(v) for v in x] if isinstance(x, list) else x


def _decode(x: object) -> object:
    if isinstance(x, tuple) and x and x[0] == _ARRAY:
        kind = np.dtype(x[1])
        return np.ascontiguousarray(np.frombuffer(x[2], np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()
    if isinstance(x, dict):
        return {k: _decode(v) for k, v in x.items()}
    return [_decode(v) for v in x] if isinstance(x, list) else x


def _dump(x: dict) -> bytes:
    return zstandard.compress(pickle.dumps(_encode(x), 5), 6)


def _load(b: bytes) -> dict:
    return _decode(pickle.loads(zstandard.decompress(b)))


def _pack(vocab: np.ndarray, w: np.ndarray, h: np.ndarray) -> dict:
    """Pairs sorted by word: each word with its number of pairs, histories by place."""
    starts = _starts(w)
    hu, at = np.unique(h, return_inverse=True)
    return {"w": vocab[w[starts]], "wn": _small(np.diff(np.append(starts, len(w)))), "hu": vocab[hu], "h": _small(at)}


def _unpack(x: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(x["w"], x["wn"].astype(np.int64)), x["hu"][x["h"]]


def _joined(chunks: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Words, histories and counts of all chunks' pairs, and each chunk's number
    of pairs.  The packed forms are given up on the way."""
    sizes = [len(x["h"]) for x in chunks]
    total = sum(sizes)
    w, h, c, at = np.empty(total, np.uint64), np.empty(total, np.uint64), np.empty(total, np.int64), 0
    for x, k in zip(chunks, sizes):
        w[at : at + k], h[at : at + k] = _unpack(x)
        c[at : at + k] = x.pop("c")
        del x["w"], x["wn"], x["hu"], x["h"]
        at += k
    return w, h, c, sizes


def _hot_words(docs: DataFrame, parts: int) -> np.ndarray:
    """All words that can fill a quarter of a partition, and few others: a chunk
    names those of an eighth, which leaves out less than an eighth of any word's
    share, so the others come to an eighth of a partition over all chunks."""

    def count(batches: Batches) -> Batches:
        for _, _, _, words in _chunks(batches, True, COUNT_TOKENS):
            codes, w = pd.factorize(np.concatenate([*words, np.full(len(words), END)]))
            n = np.bincount(codes)
            often = n * 8 * parts >= n.sum()
            w, n = np.append(w[often], np.uint64(0)), np.append(n[often], n.sum())  # 0: all tokens
            yield pa.record_batch([pa.array(w.view(np.int64)), pa.array(n.astype(np.int64))], names=["w", "n"])

    sums = docs.mapInArrow(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    sums = sums.persist()
    total = sums.filter("w = 0").first()
    often = sums.filter((F.col("w") != 0) & (F.col("n") * 8 * parts >= F.lit(total["n"]))).collect() if total else []
    sums.unpersist()
    return np.sort(np.array([r["w"] for r in often], np.int64).view(np.uint64))


def _count_parts(docs: DataFrame, parts: int, hot: np.ndarray) -> DataFrame:
    """Training pairs with their counts, packed by chunk, for each partition;
    those of hot words are dealt by the pair."""

    def count(batches: Batches) -> Batches:
        for _, _, _, words in _chunks(batches, True, COUNT_TOKENS):
            vocab, w, h, _ = _pairs(words)
            part = _parts_of(vocab, w, h, hot, parts)
            (p, w, h), c = _distinct((part, parts), (w, len(vocab)), (h, len(vocab)))
            cuts = np.searchsorted(p, np.arange(parts + 1))
            del part, p
            yield from _send((i, _dump({**_pack(vocab, w[a:b], h[a:b]), "c": _small(c[a:b])})) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a)
            del w, h, c, words
            _release()

    return docs.mapInArrow(count, "part int, data binary")


def fit(docs: DataFrame, parts: int) -> KatzModel:
    """Counts of counts over all training documents (``held`` false)."""
    hot = _hot_words(docs, parts)

    def summarise(rows: pd.DataFrame) -> pd.DataFrame:
        w, h, c, _ = _joined([_load(b) for b in rows["data"]])
        order, starts = _group(w, h)
        pair, w = _sums(c[order], starts), w[order[starts]]
        del h, c, order, starts
        _, ws = _group(w)
        word, w = _sums(pair, ws), w[ws]
        part = np.isin(w, hot)  # only a part of these words' counts
        n = [[int((v == r).sum()) for r in range(1, RELIABLE + 2)] for v in (word[~part], pair)]
        return pd.DataFrame(
            {
                "tokens": [int(word.sum())], "types": [int((~part).sum())], "n1": [n[0]], "n2": [n[1]],
                "docs": [int(word[w == END].sum())], "hot": [w[part].view(np.int64).tolist()], "count": [word[part].tolist()],
            }
        )

    schema = "tokens long, types long, n1 array<long>, n2 array<long>, docs long, hot array<long>, count array<long>"
    found = cut(_dealt(_count_parts(docs, parts, hot), parts).groupBy("part").applyInPandas(summarise, schema))
    rows = found.drop("hot", "count").collect()
    tokens = sum(r["tokens"] for r in rows)
    total = lambda k: np.array([r[k] for r in rows]).sum(axis=0) if rows else np.zeros(RELIABLE + 1, int)
    own = found.select(F.explode(F.arrays_zip("hot", "count")).alias("x")).groupBy("x.hot").agg(F.sum("x.count").alias("n"))
    own = {r["hot"] & (2**64 - 1): r["n"] for r in own.collect()}
    n1 = total("n1") + np.array([sum(c == r for c in own.values()) for r in range(1, RELIABLE + 2)])
    types = sum(r["types"] for r in rows) + len(own)
    spread = {w: c for w, c in own.items() if c * 4 * parts > tokens}
    return KatzModel(parts, sum(r["docs"] for r in rows), tokens, types, n1, total("n2"), spread)


def _request_parts(docs: DataFrame, model: KatzModel) -> DataFrame:
    """All documents' distinct pairs, packed by chunk, for each partition."""
    sent = share(docs.sparkSession, model)

    def request(batches: Batches) -> Batches:
        model = shared(sent)
        for row, ids, held, words in _chunks(batches, False):
            vocab, w, h, doc = _pairs(words)
            part = _parts_of(vocab, w, h, model.spread_words, model.parts)
            (p, w, h, doc), n = _distinct((part, model.parts), (w, len(vocab)), (h, len(vocab)), (doc, len(ids)))
            train = ~np.array(held, bool)[doc]
            del part
            meta = {"ids": ids, "held": held, "n": _small(np.array([len(x) + 1 for x in words]))}
            cuts = np.searchsorted(p, np.arange(model.parts + 1))

            def packed(vocab=vocab, w=w, h=h, doc=doc, n=n, train=train, cuts=cuts, meta=meta, row=row, docs=len(ids)):
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if b == a:
                        continue
                    ps = _starts(w[a:b], h[a:b])
                    data = {
                        "row": row, "docs": docs, "doc": doc[a:b], "n": _small(n[a:b]),
                        "occ": _small(np.diff(np.append(ps, b - a))), "c": _small(_sums(n[a:b] * train[a:b], ps)),
                        "meta": meta, **_pack(vocab, w[a:b][ps], h[a:b][ps]),
                    }
                    meta = None  # the chunk's first row carries it
                    yield i, _dump(data)

            yield from _send(packed())
            del packed, w, h, doc, n, train, words
            _release()

    return docs.mapInArrow(request, "part int, data binary")


def _score_part(rows: pd.DataFrame, model: KatzModel) -> pd.DataFrame:
    """One partition of the tables: count, score, and what the histories need."""
    _release()
    x = [_load(b) for b in rows["data"]]
    w, h, c, sizes = _joined(x)
    order, starts = _group(w, h)
    pair = _sums(c[order], starts)
    pw, ph = w[order[starts]], h[order[starts]]
    del w, h, c
    _, ws = _group(pw)
    uw, uc = pw[ws], _sums(pair, ws)
    hot, at = model.spread_at(uw)
    own = ~hot
    uc = np.where(hot, model.spread_counts[at] if len(model.spread_counts) else 0, uc)
    pc = np.repeat(uc, np.diff(np.append(ws, len(pw))))  # count of each pair's word
    uni = model.unigram(pc)
    seen = pair > 0
    gain = discounted(pair, model.d2)
    value = np.log10(np.where(seen, np.where(seen, gain, 1.0), uni))
    # The word is the next token's history: its count divides there.
    value -= np.where((pc > 0) & (pw != END), np.log10(np.maximum(pc, 1)), 0.0)
    base = np.log10(pc + 0.5)
    # Back from the sorted pairs to each chunk's pairs and documents.
    place = np.empty(len(order), np.int32)
    place[order] = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.append(starts, len(order))))
    del order, starts
    out, late, upto = [], {}, 0
    for b, k in zip(x, sizes):
        pos = np.repeat(place[upto : upto + k], b["occ"].astype(np.int64))
        upto += k
        n, doc = b["n"].astype(np.float64), b["doc"].astype(np.int64)
        add = lambda v: np.bincount(doc, v, b["docs"])  # noqa: B023, E731
        have = np.unique(doc)
        known = add(n * (pc[pos] > 0))[have].astype(np.int64)
        data = {"docs": have.astype(np.uint16), "score": add(n * value[pos])[have], "base": add(n * base[pos])[have],
                "known": _small(known), "meta": b["meta"], "row": b["row"], "size": b["docs"]}
        out.append((int(xhash(b["row"]) % model.parts), _dump(data)))
        new = ~seen[pos]
        lh, ld, ln = ph[pos[new]], b["doc"][new], b["n"][new]
        to = (lh % np.uint64(model.parts)).astype(np.int64)
        by = np.argsort(to, kind="stable")
        lh, ld, ln, to = lh[by], ld[by], ln[by], to[by]
        cuts = _starts(to)
        for i, j in zip(cuts, np.append(cuts[1:], len(to))):
            late.setdefault(int(to[i]), []).append([b["row"], lh[i:j], ld[i:j], ln[i:j]])
        b.clear()
    # Sums over the words seen after each history, and words' own counts.
    o, hs = _group(ph[seen])
    hist = ph[seen][o][hs]
    pu, dm = _sums(uni[seen][o], hs), _sums(gain[seen][o], hs)
    alone = own & (uc > 0) & (uw != END)
    cw, cc = uw[alone], uc[alone]
    parts = np.uint64(model.parts)
    hp, cp = hist % parts, cw % parts
    ho, co = np.argsort(hp, kind="stable"), np.argsort(cp, kind="stable")
    every = np.arange(model.parts + 1, dtype=np.uint64)
    h_cuts, c_cuts = np.searchsorted(hp[ho], every), np.searchsorted(cp[co], every)
    for i in range(model.parts):
        a, b = ho[h_cuts[i] : h_cuts[i + 1]], co[c_cuts[i] : c_cuts[i + 1]]
        if len(a) or len(b) or i in late:
            data = {"h": hist[a], "pu": pu[a], "dm": dm[a], "w": cw[b], "c": _small(cc[b]), "unseen": late.get(i, [])}
            out.append((i, _dump(data)))
    return pd.DataFrame(out, columns=["part", "data"]).astype({"part": "int32"})


def xhash(row: int) -> int:
    """Partition that gathers a chunk's documents."""
    return int(mix(np.array([row], np.uint64), np.array([0x5BD1E995], np.uint64))[0])


_DOC = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def _gather(rows: pd.DataFrame, model: KatzModel) -> pd.DataFrame:
    """Partial scores summed for each chunk, and backoff weights for unseen
    pairs: again packed by chunk, one row for each chunk and partition."""
    _release()
    x = [_load(b) for b in rows["data"]]
    out = []
    sums: dict[int, dict] = {}
    for b in x:
        if "docs" in b:
            own = sums.setdefault(b["row"], {"meta": None})
            if b["meta"]:
                own["meta"] = b["meta"]
            for k in ("score", "base", "known"):
                own[k] = own.get(k, 0) + np.bincount(b["docs"], b[k], b["size"])
    for row, own in sums.items():
        own["known"] = _small(own["known"].astype(np.int64))
        out.append((row, _dump(own)))
    hist = [b for b in x if "h" in b]
    if hist:
        joined = lambda k: np.concatenate([b[k] for b in hist])
        h, w = joined("h"), joined("w")
        order, starts = _group(h)
        hu, pu, dm = h[order][starts], _sums(joined("pu")[order], starts), _sums(joined("dm")[order], starts)
        # A word that is not spread is counted by one partition only.
        order = np.argsort(w)
        w, counts = w[order], joined("c").astype(np.int64)[order]
        c = np.zeros(len(hu))
        if len(w):
            at = np.minimum(np.searchsorted(w, hu), len(w) - 1)
            c = np.where(w[at] == hu, counts[at], 0)
        hot, at = model.spread_at(hu)
        if len(model.spread_counts):
            c = np.where(hot, model.spread_counts[at], c)
        c = np.where(hu == START, model.docs, c)
        ok = c > 0
        weight = np.where(ok, np.log10(np.where(ok, c - dm, 1.0)) - np.log10(np.maximum(1 - pu, 1e-300)), 0.0)
        late: dict[int, list] = {}
        for b in hist:
            for row, lh, ld, ln in b["unseen"]:
                if len(hu):
                    at = np.minimum(np.searchsorted(hu, lh), len(hu) - 1)
                    late.setdefault(row, []).append((ld, np.where(hu[at] == lh, weight[at], 0.0) * ln))
        for row, parts in late.items():
            docs, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            value = np.bincount(at, np.concatenate([p[1] for p in parts]))
            out.append((row, _dump({"docs": docs, "late": value})))
    return pd.DataFrame(out, columns=["chunk", "data"]).astype({"chunk": "int64"})


def _finish(rows: pd.DataFrame) -> pd.DataFrame:
    """The documents of one chunk."""
    x = [_load(b) for b in rows["data"]]
    own = next(b for b in x if "meta" in b)
    score, m = own["score"], own["meta"]
    for b in x:
        if "late" in b:
            score = score + np.bincount(b["docs"], b["late"], len(score))
    return pd.DataFrame(
        {"doc_id": pd.array(m["ids"], "Int64"), "held_out": m["held"], "n_tokens": m["n"].astype(np.int64),
         "n_known": own["known"].astype(np.int64), "base": own["base"], "score": score}
    )


def score_documents(docs: DataFrame, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are runs of non-blanks, A-Z in lower case, then one end; a null or
    empty text is its end alone.  Documents whose crc32(doc_id as text) mod 5
    is 1 are held out of the counts (a null id counts as the empty text).
    ``score`` is the model's log10 probability of the tokens, ``base_score``
    that of the smoothed unigram counts.  Each row is a document, repeated ones
    too; an empty table gives no rows.  Words are told apart by 64-bit hashes.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out().alias("held"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(max(4, -(-size // partition_bytes)))
    model = fit(d, parts)
    scored = _dealt(_request_parts(d, model), parts).groupBy("part").applyInPandas(lambda r: _score_part(r, model), "part int, data binary")
    sums = _dealt(scored, parts).groupBy("part").applyInPandas(lambda r: _gather(r, model), "chunk long, data binary")
    out = sums.groupBy("chunk").applyInPandas(_finish, _DOC)
    n, v = model.tokens, model.types
    first = float(-np.log10(model.docs)) if model.docs else 0.0
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(float(np.log10(n + 0.5 * (v + 1))))).alias("base_score"),
        (F.col("score") + F.lit(first)).alias("score"),
    )
