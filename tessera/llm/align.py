"""Alignment of two tokenizers' tokens, and how often the corpus links each pair.

Both tokenizers cut a text before a blank or line end that follows a character
other than white space, so texts are taken apart there and the same pieces are
tokenised once for many occurrences.  Where tokens of both end at one byte, a group ends; the
two tokens that end there are linked.

Counting: the first pass gives each task's distinct pairs with their counts.
The distinct pairs of the corpus get a minimal perfect hash, so counts are
dense vectors without keys, added up along a tree.  A slot's key is kept beside
it, and a pair that does not equal it counts 0.  The second pass aligns the
documents again and looks the counts up.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Batches, cut, share, shared

# The vocabulary files, the byte-level tokenizer's pattern of
# pretokens, and the white space it knows.
BYTE_BPE = "byte_bpe_50k.tiktoken"
PIECE_BPE = "piece_bpe_32k.model"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Pairs are dealt to shards by their hash.  Ids have fewer than 2**31 values, and
# a shard holds at most a 64th of all pairs of the two vocabularies.
SHARDS = 64
FAN_IN = 16
MAX_TABLE_BYTES = 256 << 20

# What is taken at once: characters of the documents, and what a worker keeps.
AT_ONCE = 2_000_000
KEPT, KEPT_CHARS = 500_000, 30_000_000

_CUT = re.compile(f"(?<=[^{SPACE}])(?=[ \\n])")
_ODD = re.compile(f"[{SPACE}][ \\n]|^[ \\n]|\0")


def default_folder() -> str:
    import public_tokenizers

    return os.path.dirname(public_tokenizers.path(PIECE_BPE))


def pieces_of(text: str) -> list[str]:
    """Blank + text in pieces that begin with a blank or line end after another
    character than white space."""
    if _ODD.search(text):
        return _CUT.split(" " + text)
    return f" {text}".replace("\n", "\0\n").replace(" ", "\0 ").split("\0")[1:]


class Tokenizers:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, folder: str, byte_file: str = BYTE_BPE, piece_file: str = PIECE_BPE):
        import sentencepiece
        import tiktoken

        with open(f"{folder}/{byte_file}", "rb") as f:
            ranks = {base64.b64decode(token): int(k) for token, k in map(bytes.split, f)}
        self.a = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{piece_file}")
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, k in ranks.items():
            self.a_bytes[k] = token
        self.b_bytes = []
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace("\u2581", " ").encode())
        # Pieces may be tokenised by themselves if no token goes across a cut.
        across = re.compile(f"[^{SPACE}][ \\n]")
        for token in (*self.a_bytes, *self.b_bytes):
            if across.search(token.decode("utf-8", "ignore")):
                raise ValueError(f"{token!r} goes across the white space before a word")
        self.a_size, self.b_size = (np.array([len(x) for x in y]) for y in (self.a_bytes, self.b_bytes))
        top = range(max(len(self.a_bytes), len(self.b_bytes)))
        self.texts = [f"{k}{end}" for end in ",|;" for k in top]
        self.lead = len(self.a.encode_ordinary("a")), len(self.b.encode("a"))


_loaded: dict[str, Tokenizers] = {}


def tokenizers(folder: str) -> Tokenizers:
    """The tokenizers of this worker, loaded once."""
    if folder not in _loaded:
        _loaded[folder] = Tokenizers(folder)
    return _loaded[folder]


class Aligned:
    """Pieces' numbers of tokens and links, their links as id pairs (piece after
    piece, the first id in the high 32 bits) and their groups as text."""

    def __init__(self, n_a: np.ndarray, n_b: np.ndarray, n_links: np.ndarray, pairs: np.ndarray, texts: list[str]):
        self.n_a, self.n_b, self.n_links, self.pairs, self.texts = n_a, n_b, n_links, pairs, texts


def align(pieces: list[str], toks: Tokenizers, with_texts: bool = True) -> Aligned | None:
    """Groups and links of pieces that may follow one another; None if the
    tokens' bytes are not those of the pieces."""
    # Tokenised as one text after a letter, which stands for what goes before a cut.
    text = "".join(pieces)
    a = np.array(toks.a.encode_ordinary("a" + text)[toks.lead[0] :], np.int64)
    b = np.array(toks.b.encode("a" + text)[toks.lead[1] :], np.int64)
    raw = text.encode()
    if any(b"".join(map(own.__getitem__, ids.tolist())) != raw for own, ids in ((toks.a_bytes, a), (toks.b_bytes, b))):
        return None
    end_a, end_b = np.cumsum(toks.a_size[a]), np.cumsum(toks.b_size[b])
    ends = np.cumsum([len(p.encode()) for p in pieces])
    at = np.searchsorted(end_a, end_b)
    last_b = np.flatnonzero(end_a[at] == end_b)
    last_a = at[last_b]
    if not np.isin(ends, end_b[last_b]).all():
        return None
    n = len(pieces)
    of_a, of_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
    n_a, n_b, n_links = (np.bincount(x, minlength=n) for x in (of_a, of_b, of_b[last_b]))
    pairs = a[last_a] << 32 | b[last_b]
    if not with_texts:
        return Aligned(n_a, n_b, n_links, pairs, [""] * n)
    # Each token's place where groups are written one after the other.
    group_a = np.searchsorted(last_a, np.arange(len(a)))
    group_b = np.searchsorted(last_b, np.arange(len(b)))
    codes, size = np.empty(len(a) + len(b), np.int64), len(toks.texts) // 3
    closes_a, closes_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    closes_a[last_a], closes_b[last_b] = True, True
    codes[np.arange(len(a)) + np.concatenate([[0], last_b + 1])[group_a]] = a + size * closes_a
    codes[np.arange(len(b)) + last_a[group_b] + 1] = b + 2 * size * closes_b
    parts = list(map(toks.texts.__getitem__, codes.tolist()))
    stops = np.cumsum(n_a + n_b).tolist()
    texts = ["".join(parts[i:j])[:-1] for i, j in zip([0, *stops], stops)]
    return Aligned(n_a, n_b, n_links, pairs, texts)


class _Numbers(dict):
    """The pieces' numbers; a piece asked for first gets the next one."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.new.append(piece)
        return n


class Pieces:
    """Alignments by piece, kept while they are few; ``look_up`` gives the links'
    (highest, count) from their pairs."""

    def __init__(self, toks: Tokenizers, look_up=None, with_texts: bool = True):
        self.toks, self.look_up, self.with_texts = toks, look_up, with_texts
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers()
        self.texts: list[str] = []
        self.pairs: list[np.ndarray] = []
        self.chars = self.n = 0
        # n_a, n_b, links, links of the highest count, sum of counts, bad.
        self.stat = np.zeros((1024, 6), np.int64)

    def full(self) -> bool:
        return self.n > KEPT or self.chars > KEPT_CHARS

    def _put(self, pieces: list[str], found: Aligned | None) -> None:
        n = len(pieces)
        own = self.stat[self.n : self.n + n]
        if found is None:
            own[:, 5] = 1
            self.texts += [""] * n
        else:
            own[:, 0], own[:, 1], own[:, 2] = found.n_a, found.n_b, found.n_links
            if self.look_up:
                of = np.repeat(np.arange(n), found.n_links)
                for k, x in zip((3, 4), self.look_up(found.pairs)):
                    own[:, k] = np.bincount(of, weights=x, minlength=n)
            self.texts += found.texts
            self.pairs.append(found.pairs)
        self.n += n
        self.chars += sum(map(len, pieces)) + sum(map(len, self.texts[-n:]))

    def _add(self, pieces: list[str]) -> None:
        """Align new pieces, in the order of their numbers."""
        while self.n + len(pieces) > len(self.stat):
            self.stat = np.concatenate([self.stat, np.zeros_like(self.stat)])
        # One that ends in white space must not be followed by another; one with
        # this character comes back as a blank.
        for odd, run in groupby(pieces, lambda p: p[-1] in _WHITE or "\u2581" in p):
            run = list(run)
            found = None if odd else align(run, self.toks, self.with_texts)
            if found is not None:
                self._put(run, found)
            else:
                for p in run:
                    self._put([p], align([p], self.toks, self.with_texts))

    def of(self, texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
        """The pieces' numbers of each text, none if it is null, empty or not
        given back exactly, and the sums of the pieces' figures."""
        ids = []
        for t in texts:
            own = pieces_of(t) if t else []
            ids.append(np.fromiter(map(self.numbers.__getitem__, own), np.int64, len(own)))
        if self.numbers.new:
            new, self.numbers.new = self.numbers.new, []
            self._add(new)
        ids = [x[:0] if self.stat[x, 5].any() else x for x in ids]
        return ids, np.array([self.stat[x].sum(axis=0) for x in ids]).reshape(-1, 6)

    def text(self, ids: np.ndarray) -> str:
        return ";".join(map(self.texts.__getitem__, ids.tolist()))


_WHITE = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{SPACE}]", c))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of few characters, but of one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
    at = held = 0
    for i, n in enumerate(sizes):
        held += n
        if held >= AT_ONCE:
            yield batch.slice(at, i + 1 - at)
            at, held = i + 1, 0
    if at < batch.num_rows:
        yield batch.slice(at)


# --- minimal perfect hash ------------------------------------------------------

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def shard_of(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, 0) % np.uint64(SHARDS)).astype(np.int32)


class PerfectHash:
    """Minimal perfect hash of a set of 64-bit keys.

    Level by level, keys that are alone in their place of a bit table of twice
    their number keep it, the others go on to the next level.  A key's slot is
    the number of set bits before its own.
    """

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
        self.first = np.concatenate([[0], np.cumsum([m // 64 for m in sizes])]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, tables = [], []
        while len(keys):
            m = -(-2 * len(keys) // 64) * 64
            place = (_hash(keys, len(sizes) + 1) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(place, minlength=m) == 1
            sizes.append(m)
            tables.append(np.packbits(alone, bitorder="little").view(np.uint64))
            keys = keys[~alone[place]]
        return cls(sizes, np.concatenate(tables) if tables else np.empty(0, np.uint64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; of a key outside the set, any slot or -1."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, m in enumerate(self.sizes):
            if not len(left):
                break
            place = (_hash(keys[left], level + 1) % np.uint64(m)).astype(np.int64)
            at, bit = self.first[level] + (place >> 6), (place & 63).astype(np.uint64)
            word = self.words[at]
            hit = (word >> bit) & np.uint64(1) == 1
            low = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.before[at[hit]] + np.bitwise_count(low)
            left = left[~hit]
        return out


# --- counting ------------------------------------------------------------------

_CHUNK_SCHEMA = "shard int, node long, pairs binary, counts binary"
_HASH_SCHEMA = "shard int, sizes array<long>, words binary, pairs binary"


def link_counts(docs: DataFrame, folder: str) -> DataFrame:
    """First pass: (shard, node, pairs, counts), the distinct pairs of a part of
    the documents and how many links hold each."""

    def count(batches: Batches) -> Batches:
        pieces = Pieces(tokenizers(folder), with_texts=False)
        uses: list[np.ndarray] = []
        chunk = TaskContext.get().partitionId() << 24

        def flush() -> pa.RecordBatch:
            nonlocal chunk
            times = uses[0]
            every = np.concatenate(pieces.pairs) if pieces.pairs else np.empty(0, np.int64)
            keys, of = np.unique(every.astype(np.uint64), return_inverse=True)
            n = np.bincount(of, weights=np.repeat(times, pieces.stat[: pieces.n, 2]), minlength=len(keys))
            n = n.astype(np.int64)
            keys, n = keys[n > 0], n[n > 0]
            own = shard_of(keys)
            used = np.unique(own)
            pieces.clear()
            uses.clear()
            chunk += 1
            return pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array(used, pa.int32()),
                    "node": pa.array([chunk] * len(used), pa.int64()),
                    "pairs": pa.array([keys[own == s].tobytes() for s in used], pa.binary()),
                    "counts": pa.array([n[own == s].tobytes() for s in used], pa.binary()),
                }
            )

        for batch in batches:
            for part in _slices(batch):
                own = np.bincount(np.concatenate(pieces.of(part.column("text").to_pylist())[0]), minlength=pieces.n)
                if uses:
                    own[: len(uses[0])] += uses[0]
                uses[:] = [own]
                if pieces.full():
                    yield flush()
        if pieces.n:
            yield flush()

    return docs.select("text").mapInArrow(count, _CHUNK_SCHEMA)


def _u64(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint64)


def perfect_hashes(chunks: DataFrame) -> DataFrame:
    """(shard, sizes, words, pairs): the shard's hash and its keys by slot."""

    def each(batches: Batches) -> Batches:
        for batch in batches:
            for s, raw in zip(batch.column("shard").to_pylist(), batch.column("pairs").to_pylist()):
                keys = _u64(raw)
                for at in range(0, len(keys), 100_000):
                    part = keys[at : at + 100_000]
                    yield pa.RecordBatch.from_pydict(
                        {"shard": pa.array([s] * len(part), pa.int32()), "pair": pa.array(part.astype(np.int64))}
                    )

    def build(t: pa.Table) -> pa.Table:
        keys = np.unique(t.column("pair").to_numpy().astype(np.uint64))
        h = PerfectHash.build(keys)
        by_slot = np.empty(len(keys), np.uint64)
        by_slot[h.slots(keys)] = keys
        return pa.table(
            {
                "shard": t.column("shard").slice(0, 1),
                "sizes": pa.array([h.sizes], pa.list_(pa.int64())),
                "words": pa.array([h.words.tobytes()], pa.binary()),
                "pairs": pa.array([by_slot.tobytes()], pa.binary()),
            }
        )

    distinct = chunks.select("shard", "pairs").mapInArrow(each, "shard int, pair long").distinct()
    return distinct.groupBy("shard").applyInArrow(build, _HASH_SCHEMA)


def _table_row(r: dict) -> tuple[PerfectHash, np.ndarray]:
    return PerfectHash(r["sizes"], _u64(r["words"])), _u64(r["pairs"])


def count_table(docs: DataFrame, folder: str) -> DataFrame:
    """(shard, sizes, words, pairs, counts) of all distinct pairs, a row per shard."""
    chunks = cut(link_counts(docs, folder))
    hashes = cut(perfect_hashes(chunks))
    nodes = max(1, -(-chunks.select("node").distinct().count() // FAN_IN))

    def dense(t: pa.Table, h: pa.Table) -> pa.Table:
        found, keys = _table_row(h.to_pylist()[0])
        total = np.zeros(len(keys), np.int64)
        for pairs, n in zip(t.column("pairs").to_pylist(), t.column("counts").to_pylist()):
            total[found.slots(_u64(pairs))] += np.frombuffer(n, np.int64)
        return pa.table({"shard": t.column("shard").slice(0, 1), "node": t.column("_node").slice(0, 1), "counts": [total.tobytes()]})

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in t.column("counts").to_pylist())
        return pa.table({"shard": t.column("shard").slice(0, 1), "node": t.column("_node").slice(0, 1), "counts": [total.tobytes()]})

    schema = "shard int, node long, counts binary"
    leaves = chunks.withColumn("_node", F.pmod(F.xxhash64("node"), F.lit(nodes)))
    needed = leaves.select(F.col("shard").alias("_shard"), F.col("_node").alias("_at")).distinct()
    needed = needed.join(hashes, F.col("_shard") == F.col("shard")).drop("shard")
    sums = leaves.groupBy("shard", "_node").cogroup(needed.groupBy("_shard", "_at")).applyInArrow(dense, schema)
    while nodes > 1:
        nodes = -(-nodes // FAN_IN)
        sums = sums.withColumn("_node", F.expr(f"node div {FAN_IN}")).groupBy("shard", "_node").applyInArrow(add, schema)
    return cut(hashes.join(sums.drop("node"), "shard"))


def _pair_rows(table: DataFrame) -> DataFrame:
    """(pair, count) of every distinct pair."""

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            for pairs, n in zip(batch.column("pairs").to_pylist(), batch.column("counts").to_pylist()):
                keys, n = _u64(pairs).astype(np.int64), np.frombuffer(n, np.int64)
                for at in range(0, len(keys), 100_000):
                    yield pa.RecordBatch.from_pydict({"pair": keys[at : at + 100_000], "count": n[at : at + 100_000]})

    return table.select("pairs", "counts").mapInArrow(rows, "pair long, count long")


def best_counts(table: DataFrame) -> dict[int, int]:
    """The highest count of each second id: no more rows than its vocabulary has."""
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    return dict(_pair_rows(table).groupBy(b.alias("b")).agg(F.max("count").alias("best")).collect())


class CountTable:
    """The shards' hashes, keys and counts in one worker."""

    def __init__(self, rows: list[dict], best: dict[int, int]):
        self.best = np.zeros(max(best, default=0) + 1, np.int64)
        self.best[list(best)] = list(best.values())
        self.shards = {r["shard"]: (*_table_row(r), np.frombuffer(r["counts"], np.int64)) for r in rows}

    def of(self, keys: np.ndarray) -> np.ndarray:
        out, own = np.zeros(len(keys), np.int64), shard_of(keys)
        for s in np.unique(own):
            if s in self.shards:
                h, pairs, n = self.shards[s]
                at = np.flatnonzero(own == s)
                slot = h.slots(keys[at])
                same = (slot >= 0) & (pairs[slot] == keys[at])
                out[at[same]] = n[slot[same]]
        return out

    def look_up(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each link's count is its second id's highest, and the count."""
        keys, of = np.unique(pairs.astype(np.uint64), return_inverse=True)
        n = self.of(keys)
        best = n == self.best[(keys & np.uint64(0xFFFFFFFF)).astype(np.int64)]
        return best[of].astype(np.int64), n[of]


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


_DOC = "n_a long, n_b long, n_groups long, n_links long"


def align_documents(docs: DataFrame, folder: str | None = None, max_table_bytes: int = MAX_TABLE_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256
    of every row.

    ``folder`` has the vocabulary files on every executor.  A text that is
    null, empty or not given back byte by byte by both tokenizers has no
    tokens: zeros and ''.  Rows that share a doc_id, null too, are judged
    each by itself.  The count table is broadcast if it has at most
    ``max_table_bytes``; a larger one is joined to the documents' pairs.
    """
    folder = folder or default_folder()
    table = count_table(docs, folder)
    best = best_counts(table)
    width = F.octet_length("words") + F.octet_length("pairs") + F.octet_length("counts")
    kind = docs.schema["doc_id"].dataType.simpleString()
    if (table.agg(F.sum(width.cast("long"))).first()[0] or 0) > max_table_bytes:
        return _align_joined(docs, folder, table, best, kind)
    rows = [r.asDict() for r in table.collect()]
    sent = share(docs.sparkSession, [{k: bytes(v) if isinstance(v, bytearray) else v for k, v in r.items()} for r in rows])

    def second(batches: Batches) -> Batches:
        pieces = Pieces(tokenizers(folder), CountTable(shared(sent), best).look_up)
        for batch in batches:
            for part in _slices(batch):
                ids, sums = pieces.of(part.column("text").to_pylist())
                figures = [pa.array(sums[:, k]) for k in (0, 1, 2, 2, 3, 4)]
                digests = pa.array([_digest(pieces.text(x)) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *figures, digests],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )
                if pieces.full():
                    pieces.clear()

    return docs.select("doc_id", "text").mapInArrow(
        second, f"doc_id {kind}, {_DOC}, n_best long, count_sum long, groups_sha256 string"
    )


def _align_joined(docs: DataFrame, folder: str, table: DataFrame, best: dict[int, int], kind: str) -> DataFrame:
    """The second pass where the counts are too many to broadcast."""

    def second(batches: Batches) -> Batches:
        pieces = Pieces(tokenizers(folder))
        kind = pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))
        for batch in batches:
            for part in _slices(batch):
                ids, sums = pieces.of(part.column("text").to_pylist())
                every = np.concatenate(pieces.pairs) if pieces.pairs else np.empty(0, np.int64)
                stops = np.cumsum(pieces.stat[: pieces.n, 2])
                own = []
                for x in ids:
                    links = [every[stops[i] - pieces.stat[i, 2] : stops[i]] for i in x.tolist()]
                    keys, n = np.unique(np.concatenate(links) if links else every[:0], return_counts=True)
                    own.append([{"pair": k, "n": v} for k, v in zip(keys.tolist(), n.tolist())])
                figures = [pa.array(sums[:, k]) for k in (0, 1, 2, 2)]
                digests = pa.array([_digest(pieces.text(x)) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *figures, digests, pa.array(own, kind)],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"],
                )
                if pieces.full():
                    pieces.clear()

    schema = f"doc_id {kind}, {_DOC}, groups_sha256 string, pairs array<struct<pair:long,n:long>>"
    base = cut(docs.select("doc_id", "text").mapInArrow(second, schema)).withColumn("_row", F.monotonically_increasing_id())
    pairs = _pair_rows(table).withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    highest = docs.sparkSession.createDataFrame(list(best.items()), "b long, best long")
    counts = pairs.join(F.broadcast(highest), "b")
    each = base.select("_row", F.explode("pairs").alias("p")).select("_row", "p.pair", "p.n")
    sums = (
        each.join(counts, "pair")
        .groupBy("_row")
        .agg(
            F.sum(F.when(F.col("count") == F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.col("count")).alias("count_sum"),
        )
    )
    out = base.drop("pairs").join(sums, "_row", "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")
