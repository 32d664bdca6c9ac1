"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Byte tables: A-Z to a-z; bytes of multi-byte characters stay as they are.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# The same, with every ASCII byte other than a letter or digit made a blank.
ALNUM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

# Java pattern of a word between blanks (space, tab to carriage return).
BLANK_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and go on from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def packed(df: DataFrame, rows: int, each: int = 100_000) -> DataFrame:
    """``df`` in no more partitions than its ``rows`` fill, about ``each`` to one,
    but two for every core: a file of few rows costs what a full one does."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def share(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast a Python object, classes of this package included."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(value: Broadcast) -> object:
    return pickle.loads(value.value)


def as_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """The column's texts as UTF-8 bytes."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def blank_words(text: bytes | None) -> list[bytes]:
    """Words between blanks, A-Z in lower case; null has none.  ``bytes.split``
    parts at exactly the blanks of ``BLANK_WORD``."""
    return text.translate(LOWER_BYTES).split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII."""
    return text.translate(ALNUM_BYTES).split() if text else []


class WordHashes(dict):
    """64-bit hash of each word, kept while the vocabulary is small."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def mix(state: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Fold one more 64-bit value into a running 64-bit hash."""
    h = (state ^ value) * _MIX
    return h ^ (h >> _SHIFT)


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``n`` words; a shorter text is one
    run of all its words, no words give the empty set."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    n = min(n, len(hashes))
    runs = np.full(len(hashes) - n + 1, n, np.uint64)
    for j in range(n):
        runs = mix(runs, hashes[j : j + len(runs)])
    return np.unique(runs)


Batches = Iterator[pa.RecordBatch]
