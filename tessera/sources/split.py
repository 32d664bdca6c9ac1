"""Elements of large JSON documents, read by byte ranges.

A multi-line JSON file is one task for a JSON reader, as nothing in the middle
of it tells where an element begins: a brace may stand in a string.  Here the
file is read as text records that end at ``}``, which Spark splits by byte
ranges on any file system, in two passes:

1. Every split works out, for each state it might begin in (outside a string,
   inside one, just after a backslash), the state and the change of depth at its
   end.  These few numbers a split, put in order, give every split's true start.
2. Every split cuts out the elements that begin in it.  An element across
   splits leaves pieces, which are joined by file and place.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Python workers get this module with the task; executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_OUT, _IN, _ESCAPED = 0, 1, 2
_BLOCK = 1 << 20
_ESCAPE = re.compile(rb"\\.", re.S)
_QUOTE, _OPEN, _CLOSE = ord('"'), (ord("{"), ord("[")), (ord("}"), ord("]"))
_WRONG_ROOT = re.compile(rb'"type"\s*:\s*"Feature"')


def brackets(data: bytes, state: int) -> tuple[np.ndarray, int]:
    """+1 and -1 at the brackets outside strings, and the state at the end."""
    if state == _ESCAPED:
        data = b" " + data[1:]
    data = _ESCAPE.sub(b"  ", data)
    a = np.frombuffer(data, np.uint8)
    inside = (np.cumsum(a == _QUOTE) + (state != _OUT)) & 1
    value = np.isin(a, _OPEN).astype(np.int8) - np.isin(a, _CLOSE).astype(np.int8)
    value[inside == 1] = 0
    end = int(inside[-1]) if len(a) else int(state != _OUT)
    return value, _ESCAPED if end and data.endswith(b"\\") else end


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """(file, start of split, text) in blocks of some size, in order."""
    key, held, size = None, [], 0
    for batch in batches:
        files, starts = batch.column("file").to_pylist(), batch.column("start").to_pylist()
        for f, s, v in zip(files, starts, batch.column("value").cast(pa.binary()).to_pylist()):
            if held and ((f, s) != key or size >= _BLOCK):
                yield *key, b"".join(held)
                held, size = [], 0
            key = (f, s)
            held.append(v + b"}")
            size += len(v) + 1
    if held:
        yield *key, b"".join(held)


def _scan(batches):
    """Per split: end state and depth change for each start state."""
    key, now = None, []

    def row():
        (f, s) = key
        return pa.RecordBatch.from_pydict(
            {
                "file": [f],
                "start": pa.array([s], pa.int64()),
                "ends": pa.array([[x for x, _ in now]], pa.list_(pa.int32())),
                "depths": pa.array([[d for _, d in now]], pa.list_(pa.int64())),
            }
        )

    for f, s, data in _blocks(batches):
        if (f, s) != key:
            if key is not None:
                yield row()
            key, now = (f, s), [(_OUT, 0), (_IN, 0), (_ESCAPED, 0)]
        known = {}
        for state in {x for x, _ in now}:
            value, end = brackets(data, state)
            known[state] = (end, int(value.sum(dtype=np.int64)))
        now = [(known[x][0], d + known[x][1]) for x, d in now]
    if key is not None:
        yield row()


def _cut(batches, begin: dict, level: int):
    """(file, start, kind, json): 0 the end or middle of an element that began
    in an earlier split, 1 an element left open, 2 a whole one."""
    key, state, depth, held, whole = None, _OUT, 0, None, True
    out: list[tuple] = []

    def flush():
        cols = list(zip(*out))
        out.clear()
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["file", "start", "kind", "json"])

    def close():
        if held is not None:
            out.append((*key, 1 if whole else 0, b"".join(held).decode("utf-8", "replace")))

    for f, s, data in _blocks(batches):
        if (f, s) != key:
            close()
            key = (f, s)
            state, depth = begin[key]
            held, whole = ([], False) if depth > level else (None, True)
        value, state = brackets(data, state)
        at = depth + np.cumsum(value, dtype=np.int64)
        before = at - value
        for m in _WRONG_ROOT.finditer(data):
            if at[m.start()] == 1 and level == 2:
                raise ValueError("not a FeatureCollection: read it with layout='lines'?")
        opens = np.flatnonzero((value == 1) & (before == level))
        closes = np.flatnonzero((value == -1) & (at == level))
        depth = int(at[-1])
        a = 0
        for i in closes.tolist():
            if held is None:
                a = int(opens[np.searchsorted(opens, a)])
                held, whole = [], True
            held.append(data[a : i + 1])
            out.append((*key, 2 if whole else 0, b"".join(held).decode("utf-8", "replace")))
            held, a = None, i + 1
        if held is None and len(opens) and opens[-1] >= a:
            held, whole, a = [], True, int(opens[-1])
        if held is not None:
            held.append(data[a:])
        if len(out) >= 1000:
            yield flush()
    close()
    if out:
        yield flush()


def json_elements(spark: SparkSession, paths: str | Sequence[str], level: int = 2) -> DataFrame:
    """(file, json) of every element that opens at depth ``level``: with 2, the
    elements of the arrays (and objects) in each file's root object.

    Splits are Spark's own (``spark.sql.files.maxPartitionBytes``).  The driver
    holds a state and a depth for each split, a task one block and the element
    in hand.  Text after the last element is left out; no files of any kind
    but well-formed JSON are expected.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = spark.read.option("lineSep", "}").text(paths)
    # The split is named by hidden metadata: the same in both passes.
    raw = raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    ends = raw.mapInArrow(_scan, "file string, start long, ends array<int>, depths array<long>").collect()
    begin, now, last = {}, (_OUT, 0), None
    for r in sorted(ends, key=lambda r: (r["file"], r["start"])):
        if r["file"] != last:
            last, now = r["file"], (_OUT, 0)
        begin[(r["file"], r["start"])] = now
        state, depth = now
        now = (r["ends"][state], depth + r["depths"][state])
    parts = raw.mapInArrow(lambda b: _cut(b, begin, level), "file string, start long, kind int, json string")
    order = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    pieces = parts.filter("kind < 2").withColumn("_n", F.sum("kind").over(order))
    joined = pieces.groupBy("file", "_n").agg(F.sort_array(F.collect_list(F.struct("start", "json"))).alias("p"))
    joined = joined.select("file", F.concat_ws("", F.col("p.json")).alias("json"))
    return parts.filter("kind = 2").select("file", "json").unionByName(joined)


def root_type(spark: SparkSession, path: str) -> str | None:
    """The ``type`` of a JSON file's first root object, as far as its first
    record (up to a ``}``) shows it."""
    first = spark.read.option("lineSep", "}").text(path).select("value").take(1)
    if not first:
        return None
    data = first[0]["value"].encode()
    at = np.cumsum(brackets(data, _OUT)[0], dtype=np.int64)
    for m in re.finditer(rb'"type"\s*:\s*"(\w+)"', data):
        if at[m.start()] == 1:
            return m[1].decode()
    return None
