"""Merkle manifest of a dataset as a postorder append log.

Every row is a leaf, every language a tree of fan-out 8, and the trees' roots
are the leaves of one more tree.  A tree is cut into aligned segments of
``8**BAND`` leaves.  A segment's builder gets its leaves in order and appends
each node the moment it is complete, so the segment's log is in postorder; the
last run of each level is closed at the end.  Segment roots are the leaves of
the next band of segments, until one is left.

A node's place in the log follows from its level, its index and the number of
leaves alone (:func:`position`), so proofs address siblings in the log without
an index.  They are read from the top band down: a segment gets the siblings
above it once and hands them on with its own, so nothing is sent per leaf but
the leaf itself.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Batches, cut, lower_ascii, packed
from tessera.session import bounded_broadcast

FAN = 8
BAND = 3
SEGMENT = FAN**BAND
TAMPER_EVERY = 3

_PATH = "array<struct<left:string,right:string>>"
_SEGMENT_SCHEMA = "tree string, block long, n long, nodes binary"


def digest(parts: list[bytes]) -> bytes:
    """SHA-256 of the inputs, digests as lowercase hex text, as hex text."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def height(n: int) -> int:
    """Levels above the leaves until one node remains."""
    h = 0
    while n > 1:
        n, h = -(-n // FAN), h + 1
    return h


def position(level: int, index: int, n: int, top: int) -> int:
    """Place (from 0) of a node in the postorder log of a tree of ``n`` leaves
    and height ``top``.

    A complete subtree of height t ends with every ``FAN**t``-th leaf, so the
    complete nodes before a given one are sums of quotients; the incomplete
    node of each level follows after all complete ones, lowest level first.
    """
    end = (index + 1) * FAN**level
    if end <= n:
        own = sum(end // FAN**t for t in range(level + 1))
        return own + sum((end - 1) // FAN**t for t in range(level + 1, top + 1)) - 1
    complete = sum(n // FAN**t for t in range(top + 1))
    return complete + sum(n % FAN**t > 0 for t in range(1, level))


def postorder_log(leaves: list[bytes], top: int) -> list[bytes]:
    """Nodes of the tree over ``leaves`` in order of completion; the root is last."""
    log: list[bytes] = []
    open_runs: list[list[bytes]] = [[] for _ in range(top + 1)]
    for node in leaves:
        for level in range(top + 1):
            log.append(node)
            run = open_runs[level]
            run.append(node)
            if level == top or len(run) < FAN:
                break
            node = digest(run)
            run.clear()
    for level in range(top):
        if open_runs[level]:
            node = digest(open_runs[level])
            log.append(node)
            open_runs[level + 1].append(node)
    return log


def siblings(log: list[bytes], n: int, top: int) -> list[list[tuple[bytes, bytes]]]:
    """For every leaf, level by level, the run's nodes to the left and to the
    right of its ancestor, read from the log by position."""
    levels = []
    for level in range(top):
        count = -(-n // FAN**level)
        nodes = [log[position(level, i, n, top)] for i in range(count)]
        own = []
        for i in range(count):
            a = i // FAN * FAN
            own.append((b"".join(nodes[a:i]), b"".join(nodes[i + 1 : a + FAN])))
        levels.append(own)
    return [[own[j // FAN**level] for level, own in enumerate(levels)] for j in range(n)]


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for left, right in path:
        leaf = digest([left, leaf, right])
    return leaf


def encoded(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value as text."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digests(docs: DataFrame) -> DataFrame:
    """doc_id, tree, leaf, tampered (binary digests) of every row.

    ``tampered`` is the leaf of the row with A-Z in its text in lower case where
    3 divides crc32 of the decimal doc_id; null for all other rows, and where
    doc_id or text is null.  ``tree`` sorts as lang does, null first.
    """

    def leaf(text: Column) -> Column:
        parts = [encoded(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
        return F.unhex(F.sha2(F.concat(*parts, encoded(text)), 256))

    tamper = F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0
    return docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("v"), "lang"), F.lit("-")).alias("tree"),
        leaf(F.col("text")).alias("leaf"),
        F.when(tamper & F.col("text").isNotNull(), leaf(lower_ascii(F.col("text")))).alias("tampered"),
    )


def ranked(rows: DataFrame, order: list[str], n_rows: int) -> DataFrame:
    """Add ``idx`` (from 0) of every row in its ``tree`` by ``order`` and ``n``,
    the tree's rows.

    ``rows`` must be a checkpointed frame, of ``n_rows`` rows.  The rows are
    dealt by range, each range counts its own, and what stands before a range
    comes from the counts alone.  Rows equal in ``order`` are split as any others.
    """
    keyed = rows.withColumn("_row", F.monotonically_increasing_id())
    keys = ["tree", *order, "_row"]
    dealt = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row")
    # Ranges packed into one partition stay whole and in order, under their ids.
    dealt = cut(packed(dealt.withColumn("_part", F.spark_partition_id()), n_rows))

    def number(batches: Batches) -> Batches:
        run, at = None, 0
        for batch in batches:
            idx = []
            for key in zip(batch.column("_part").to_pylist(), batch.column("tree").to_pylist()):
                if key != run:
                    run, at = key, 0
                idx.append(at)
                at += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(idx, pa.int64())], names=[*batch.schema.names, "_at"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    numbered = dealt.mapInArrow(number, f"{fields}, _at long")
    counts = dealt.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_n"))
    own = Window.partitionBy("tree")
    before = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("tree", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(own).alias("n"))
    starts, _ = bounded_broadcast(cut(packed(starts, n_rows)), 500_000, 32 << 20)
    out = numbered.join(starts, ["tree", "_part"])
    return packed(out.withColumn("idx", F.col("_start") + F.col("_at")).drop("_part", "_at", "_start"), n_rows)


def _hex(raw: bytes) -> bytes:
    return raw.hex().encode()


def _top(n: int) -> int:
    """Height of a segment of a tree of ``n`` leaves in this band."""
    return BAND if n > SEGMENT else height(n)


def _split(nodes: bytes) -> list[bytes]:
    return [_hex(nodes[i : i + 32]) for i in range(0, len(nodes), 32)]


def _leaves(n: int, block: int) -> int:
    """Leaves of a tree's segment."""
    return min(SEGMENT, n - block * SEGMENT)


def segment_logs(rows: DataFrame, n_rows: int) -> list[DataFrame]:
    """The log of every tree in the ``n_rows`` ``rows`` (tree, idx, n, leaf): per band a frame
    of segments (tree, block, n, nodes), ``nodes`` being the 32-byte digests in
    order of completion and ``n`` the tree's leaves in that band."""

    def build(t: pa.Table) -> pa.Table:
        t = t.sort_by("idx")
        n = t.column("n")[0].as_py()
        log = postorder_log([_hex(x) for x in t.column("leaf").to_pylist()], _top(n))
        raw = b"".join(bytes.fromhex(x.decode()) for x in log)
        return pa.table(
            {
                "tree": t.column("tree").slice(0, 1).cast(pa.string()),
                "block": pa.array([t.column("idx")[0].as_py() // SEGMENT], pa.int64()),
                "n": pa.array([n], pa.int64()),
                "nodes": pa.array([raw], pa.binary()),
            }
        )

    bands = []
    rows = rows.select("tree", "idx", "n", "leaf")
    while True:
        seg = rows.groupBy("tree", F.expr(f"idx div {SEGMENT}").alias("_block")).applyInArrow(build, _SEGMENT_SCHEMA)
        seg = cut(packed(seg, n_rows))
        bands.append(seg)
        if not seg.filter(F.col("n") > SEGMENT).limit(1).count():
            return bands
        rows = seg.select(
            "tree",
            F.col("block").alias("idx"),
            F.expr(f"(n + {SEGMENT - 1}) div {SEGMENT}").alias("n"),
            F.substring("nodes", -32, 32).alias("leaf"),
        )


def roots(bands: list[DataFrame]) -> DataFrame:
    """tree, leaf: the root (binary digest) of every tree."""
    return bands[-1].select("tree", F.substring("nodes", -32, 32).alias("leaf"))


def _paths_of(segments: DataFrame) -> DataFrame:
    """(tree, idx, path) of each leaf of the segments, which carry the path of
    their own root as ``above``."""

    def extract(batches: Batches) -> Batches:
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        for batch in batches:
            for r in batch.to_pylist():
                top = _top(r["n"])
                n = _leaves(r["n"], r["block"])
                log = _split(r["nodes"])
                own = [[{"left": a.decode(), "right": b.decode()} for a, b in p] for p in siblings(log, n, top)]
                first = r["block"] * SEGMENT
                yield pa.RecordBatch.from_pydict(
                    {
                        "tree": pa.array([r["tree"]] * n, pa.string()),
                        "idx": pa.array(range(first, first + n), pa.int64()),
                        "path": pa.array([p + (r["above"] or []) for p in own], kind),
                    }
                )

    return segments.select("tree", "block", "n", "nodes", "above").mapInArrow(extract, f"tree string, idx long, path {_PATH}")


def root_paths(bands: list[DataFrame], n_rows: int, above: DataFrame | None = None) -> DataFrame:
    """(tree, block, n, nodes, above) of the lowest segments: ``above`` has the
    siblings from the segment's root upward, and goes on with those that the
    frame ``above`` (tree, above) gives for the tree's root."""
    top = bands[-1]
    empty = F.array().cast(_PATH)
    have = top.withColumn("above", empty) if above is None else top.join(above, "tree")
    for seg in reversed(bands[:-1]):
        paths = _paths_of(have).select("tree", F.col("idx").alias("block"), F.col("path").alias("above"))
        have = cut(packed(seg.join(paths, ["tree", "block"]), n_rows))
    return have


def manifest_log(docs: DataFrame) -> DataFrame:
    """tree, position, level, index, digest: the whole log of every language's
    tree, a row per node, positions counting from 0 in order of completion."""
    n_rows = docs.count()
    leaves = cut(packed(leaf_digests(docs), n_rows))
    bands = segment_logs(ranked(leaves, ["doc_id", "leaf"], n_rows), n_rows)
    totals = bands[0].select("tree", F.col("n").alias("total")).distinct()
    parts = [seg.withColumn("band", F.lit(k)) for k, seg in enumerate(bands)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)

    def nodes(batches: Batches) -> Batches:
        for batch in batches:
            for r in batch.to_pylist():
                top, log = _top(r["n"]), _split(r["nodes"])
                n, whole = _leaves(r["n"], r["block"]), height(r["total"])
                out = []
                # A band's leaves are the roots of the band below: listed there.
                for level in range(1 if r["band"] else 0, top + 1):
                    at, first = r["band"] * BAND + level, r["block"] * FAN ** (BAND - level)
                    for i in range(-(-n // FAN**level)):
                        where = position(at, first + i, r["total"], whole)
                        out.append((r["tree"], where, at, first + i, log[position(level, i, n, top)].decode()))
                cols = list(zip(*out)) or [[]] * 5
                kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds)], names=["tree", "position", "level", "index", "digest"]
                )

    joined = every.join(totals, "tree").select("tree", "block", "n", "nodes", "band", "total")
    return joined.mapInArrow(nodes, "tree string, position long, level int, index long, digest string")


def manifest_proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified,
    log_position for every row.

    The last is the leaf's place in its tree's log.  A null lang is a language
    of its own, null doc_ids come first, and rows of one doc_id stand in the
    order of their leaves; equal rows are leaves of their own.  A row whose
    text (or doc_id) is null is never tampered with.  No rows give no rows.
    """
    n_rows = docs.count()
    rows = cut(ranked(cut(packed(leaf_digests(docs), n_rows)), ["doc_id", "leaf"], n_rows))
    bands = segment_logs(rows, n_rows)
    subroots = cut(packed(roots(bands).select(F.lit("").alias("tree"), F.col("tree").alias("lang_tree"), "leaf"), n_rows))
    n_langs = subroots.count()
    langs = cut(ranked(subroots, ["lang_tree"], n_langs))
    top_bands = segment_logs(langs, n_langs)
    lang_paths = _paths_of(root_paths(top_bands, n_langs)).join(langs.select("idx", "lang_tree"), "idx")
    above = cut(packed(lang_paths.select(F.col("lang_tree").alias("tree"), F.col("path").alias("above")), n_langs))
    segments = root_paths(bands, n_rows, above)

    def prove(leaves: pa.Table, segment: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("idx")
        s = segment.to_pylist()[0]
        top, log = _top(s["n"]), _split(s["nodes"])
        n, total = leaves.num_rows, s["n"]
        whole = height(total)
        up = [(a["left"].encode(), a["right"].encode()) for a in s["above"]]
        # The tree's own root stands below the siblings of the top tree.
        own_up = up[: whole - top]
        subroot = fold(log[-1], own_up)
        root = fold(subroot, up[whole - top :])
        out: dict[str, list] = {k: [] for k in ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "log_position")}
        near = siblings(log, n, top)
        for leaf, bad, idx, own in zip(
            leaves.column("leaf").to_pylist(), leaves.column("tampered").to_pylist(), leaves.column("idx").to_pylist(), near
        ):
            path = own + up
            folded = fold(_hex(leaf if bad is None else bad), path)
            out["leaf"].append(leaf.hex())
            out["subroot"].append(subroot.decode())
            out["root"].append(root.decode())
            out["proof_sha256"].append(digest([x for pair in path for x in pair]).decode())
            out["folded_root"].append(folded.decode())
            out["verified"].append(folded == root)
            out["log_position"].append(position(0, idx, total, whole))
        return pa.table({"doc_id": leaves.column("doc_id"), **out})

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean, log_position long"
    )
    left = rows.withColumn("block", F.expr(f"idx div {SEGMENT}"))
    proofs = left.groupBy("tree", "block").cogroup(segments.groupBy("tree", "block")).applyInArrow(prove, schema)
    return packed(proofs, n_rows)
