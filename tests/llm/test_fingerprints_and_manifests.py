"""Multiset fingerprints, Merkle manifest and tokenizer alignment against brute force."""

import hashlib
import os
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_docs import docs  # noqa: F401
from pyspark.sql import functions as F
from tessera.llm import align, fingerprint, merkle
from tokenizers import Tokenizer

ODD = [(None, None, None), (None, "x\ny", "a"), (None, "x\ny", "a"), (900, "", "a"), (901, " \t\n", "a"), (903, "one", "b"), (903, "one", "b"), (903, "two", "b")]


def prose(rng, n, lines=4):
    w = [rng.choice(["Alpha", "beta", "of", "the", "naïve", "straße", "x,y", "Zeta."]) + str(rng.randrange(300)) for _ in range(n)]
    for _ in range(lines):
        w[rng.randrange(n)] += "\n"
    return " ".join(w)


# --- fingerprints --------------------------------------------------------------


def test_fingerprint_ignores_order_and_adds_up():
    a = fingerprint.fingerprint("one two\nthree\n\nfour")
    assert a == fingerprint.fingerprint("four\nthree\none two\n")
    assert a != fingerprint.fingerprint("four\nthree\none two")
    assert fingerprint.fingerprint(None) == fingerprint.fingerprint("") != fingerprint.fingerprint("\n")
    of = fingerprint.Fingerprints.of
    rng = random.Random(3)
    paras = [prose(rng, 30, 0) for _ in range(40)]
    whole, part, rest = of([paras]), of([paras[:13]]), of([paras[13:]])
    assert (whole - part).texts() == rest.texts() and (rest + part).texts() == whole.texts()
    assert of([paras]).texts() == fingerprint.Fingerprints.parse(whole.texts()).texts()
    assert (whole - whole).texts() == [fingerprint.fingerprint("")]


def test_likeness_estimates_the_common_share():
    rng = random.Random(5)
    paras = [prose(rng, 40, 0) for _ in range(100)]
    of = fingerprint.Fingerprints.of
    for share in (0.0, 0.25, 0.5, 0.75, 1.0):
        k = int(50 * share)
        got = of([paras[:50]]).likeness(of([paras[50 - k : 100 - k]]))[0]
        assert abs(got - share) < 0.15
    assert of([[" "]]).likeness(of([[""]]))[0] == 0.0


def brute_edits(rows):
    """(doc_id, n_chars, edited) with rows by doc_id, text hash and text."""
    out = []
    for i, (k, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(t) // 4
        out.append((k, len(t), t[: len(t) - n] + nxt[:n], t, nxt))
    return out


@pytest.mark.parametrize("bucket_bytes", [64 << 20, 50])
def test_edited_fingerprints_equal_brute_force(spark, docs, bucket_bytes):
    rng = random.Random(7)
    rows = [(i, prose(rng, rng.randrange(3, 120)), "s") for i in range(60)] + ODD
    rows += [(70, "é" * 90_000 + "\n" + prose(rng, 2000), "s"), (71, "\n" * 30, "s"), (72, "ab\n\n\n", "s"), (-5, "z" * 7, "s")]
    rng.shuffle(rows)
    df = docs(rows)
    keys = {(r["doc_id"], r["text"]): r["h"] for r in df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(((k, t) for k, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, keys[r], r[1] or ""))
    got = fingerprint.edited_fingerprints(df, bucket_bytes).collect()
    one = fingerprint.fingerprint
    parse = lambda t: fingerprint.Fingerprints.parse([t])
    want = []
    for k, n, edited, t, nxt in brute_edits(order):
        f, e, x = one(t), one(edited), one(nxt)
        near = [float(parse(f).likeness(parse(y))[0]) for y in (e, x)]
        want.append((k, n, hashlib.sha256(edited.encode()).hexdigest(), f, e, *near))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    plain = {(r["doc_id"], r["fingerprint"]) for r in fingerprint.fingerprints(df).collect()}
    assert plain == {(r["doc_id"], r["fingerprint"]) for r in got}


def test_fingerprints_of_no_rows_and_of_one(spark, docs):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fingerprint.edited_fingerprints(empty).collect() == []
    (r,) = fingerprint.edited_fingerprints(docs([(4, "abcdefgh", "s")])).collect()
    assert r["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and r["near_next"] == 1.0


# --- Merkle manifest -----------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def brute_tree(leaves):
    """Root and, for each leaf, its siblings (left, right) level by level."""
    paths, nodes, own = [[] for _ in leaves], leaves, list(range(len(leaves)))
    while len(nodes) > 1:
        for j, i in enumerate(own):
            a = i // 8 * 8
            paths[j].append(("".join(nodes[a:i]), "".join(nodes[i + 1 : a + 8])))
        nodes = [H(*nodes[a : a + 8]) for a in range(0, len(nodes), 8)]
        own = [i // 8 for i in own]
    return nodes[0], paths


def brute_proofs(rows):
    trees = {}
    for k, t, lang, source, n in rows:
        leaf = lambda x: H(enc(k), enc(source), enc(lang), enc(n), enc(x))  # noqa: B023, E731
        bad = leaf(lower(t)) if k is not None and t is not None and zlib.crc32(str(k).encode()) % 3 == 0 else leaf(t)
        trees.setdefault((lang is not None, (lang or "").encode()), []).append((k is not None, k or 0, leaf(t), k, bad))
    order = sorted(trees)
    built = [brute_tree([x[2] for x in sorted(trees[t], key=lambda x: x[:3])]) for t in order]
    root, up = brute_tree([b[0] for b in built])
    out = []
    for t, (sub, paths), above in zip(order, built, up):
        for (_, _, leaf, k, bad), path in zip(sorted(trees[t], key=lambda x: x[:3]), paths):
            path = path + above
            f = bad
            for a, b in path:
                f = H(a, f, b)
            out.append((k, leaf, sub, root, H(*[x for p in path for x in p]), f, f == root))
    return out


def make(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, leaf int, tree string"
    return spark.createDataFrame([(*r, 1, "t") for r in rows], schema)


@pytest.mark.parametrize("sizes", [(1,), (8, 1), (9, 64, 65), (513, 30, 2, 1, 1, 1, 1, 1, 1, 7)])
def test_manifest_equals_brute_force(spark, sizes):
    rng = random.Random(sum(sizes))
    rows, k = [], 0
    for lang, n in zip([None, "", "é", "en", "a:b", *"fghij"], sizes):
        for _ in range(n):
            text = rng.choice([None, "", "Alpha Beta", "ÉCOLE A", "x" * rng.randrange(50)])
            rows.append((k, text, lang, rng.choice([None, "s"]), rng.choice([None, 5])))
            k += rng.choice([0, 1, 1, 7])
    rows += [(None, "Null Id", "en", "s", 1)] * (2 if len(sizes) > 5 else 0)
    got = merkle.manifest_proofs(make(spark, rows)).drop("log_position").collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, brute_proofs(rows)))


def test_manifest_of_long_texts_and_no_rows(spark):
    assert merkle.manifest_proofs(make(spark, [])).collect() == []
    rows = [(i, "Ab é" * 200_000, "en", "s", 1) for i in range(3)]
    got = merkle.manifest_proofs(make(spark, rows)).drop("log_position").collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, brute_proofs(rows)))


def test_manifest_of_few_rows_in_many_partitions_writes_few_files(spark, monkeypatch):
    files, cut = [], merkle.cut

    def counted(df):
        out = cut(df)
        files.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(merkle, "cut", counted)
    rows = [(i, f"Text {i}", lang, "s", 1) for i, lang in enumerate(["en", "fr", None] * 400)]
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        proofs = merkle.manifest_proofs(make(spark, rows).repartition(60))
        got = proofs.drop("log_position").collect()
        files.append(proofs.rdd.getNumPartitions())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, brute_proofs(rows)))
    assert max(files) <= 2 * spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 100, 512, 513, 700])
def test_positions_follow_from_sizes(n):
    top = merkle.height(n)
    leaves = [f"{i:064x}".encode() for i in range(n)]
    log = merkle.postorder_log(leaves, top)
    nodes, level = leaves, 0
    while True:
        for i, x in enumerate(nodes):
            assert log[merkle.position(level, i, n, top)] == x
        if len(nodes) == 1:
            break
        nodes, level = [merkle.digest(nodes[a : a + 8]) for a in range(0, len(nodes), 8)], level + 1
    assert len(log) == merkle.position(top, 0, n, top) + 1


def test_manifest_log_is_a_whole_postorder(spark):
    rows = [(i, f"t{i}", "en" if i < 600 else "fr", "s", i) for i in range(620)]
    got = merkle.manifest_log(make(spark, rows)).collect()
    leaf = {r["doc_id"]: (r["leaf"], r["log_position"]) for r in merkle.manifest_proofs(make(spark, rows)).collect()}
    for tree, ids in (("ven", range(600)), ("vfr", range(600, 620))):
        own = sorted((r["position"], r["digest"]) for r in got if r["tree"] == tree)
        leaves = [leaf[i][0].encode() for i in ids]
        assert [d for _, d in own] == [x.decode() for x in merkle.postorder_log(leaves, merkle.height(len(leaves)))]
        assert [p for p, _ in own] == list(range(len(own)))
        assert all(own[leaf[i][1]][1] == leaf[i][0] for i in ids)


# --- alignment -----------------------------------------------------------------


def brute_alignment(texts):
    ta = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ta.encode_special_tokens = True
    tb = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    chars = align_bytes()
    name = {v: k for k, v in ta.get_vocab().items()}
    found = []
    for t in texts:
        a = ta.encode(" " + t, add_special_tokens=False).ids if t else []
        b = tb.encode(t) if t else []
        ba = [bytes(chars[c] for c in name[x]) for x in a]
        bb = [bytes([int(tb.id_to_piece(x)[3:5], 16)]) if tb.is_byte(x) else tb.id_to_piece(x).replace("▁", " ").encode() for x in b]
        raw = (" " + (t or "")).encode()
        if not t or b"".join(ba) != raw or b"".join(bb) != raw:
            found.append(([], [], [], []))
            continue
        ends_a, ends_b = ([sum(map(len, x[: i + 1])) for i in range(len(x))] for x in (ba, bb))
        both = [e for e in ends_a if e in set(ends_b)]
        groups, i, j, links = [], 0, 0, []
        for e in both:
            m, n = ends_a.index(e) + 1, ends_b.index(e) + 1
            groups.append(",".join(map(str, a[i:m])) + "|" + ",".join(map(str, b[j:n])))
            links.append((a[m - 1], b[n - 1]))
            i, j = m, n
        found.append((a, b, groups, links))
    counts = Counter(x for f in found for x in f[3])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for a, b, groups, links in found:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        top = sum(counts[x] == best[x[1]] for x in links)
        out.append((len(a), len(b), len(groups), len(links), top, sum(counts[x] for x in links), digest))
    return out


def align_bytes():
    """The byte-level alphabet: printable bytes as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


HARD = [
    None, "", " ", "\n", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\na\n\n", "tab\tand nbsp 　wide",
    "<s>[INST] <|endoftext|> </s> <0x0A>", "piece ▁ mark", "▁", "é ﬁ Å", "日本語のテキスト 🤖🤖 ​ end",
    "nul \x00 byte\x1c\x1d here", "a\r\n b\x85c  d", "don't we'll I'VE 12345 $$$ ...!!! x=1;y", "word " * 40, "      x", "ends with ",
]


@pytest.mark.parametrize("max_table_bytes", [256 << 20, 0])
def test_alignment_equals_brute_force(spark, docs, max_table_bytes):
    rng = random.Random(11)
    texts = HARD + [prose(rng, rng.randrange(1, 60)) for _ in range(30)]
    texts += ["".join(rng.choice("ab \n\té▁.,1日") for _ in range(rng.randrange(40))) for _ in range(60)]
    texts += [texts[40]] * 5 + ["x" * 3000 + " tail", "y z\n" * 3000]
    ids = [None if i % 9 == 0 else i // 2 for i in range(len(texts))]
    df = docs([(k, t, "s") for k, t in zip(ids, texts)]).repartition(5)
    got = align.align_documents(df, max_table_bytes=max_table_bytes).collect()
    want = [(k, *x) for k, x in zip(ids, brute_alignment(texts))]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_alignment_of_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert align.align_documents(empty).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 100, 20_000])
def test_perfect_hash_is_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**62, n, dtype=np.uint64))
    h = align.PerfectHash.build(keys)
    assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))
    assert h.slots(np.arange(50, dtype=np.uint64)).shape == (50,)


def test_counts_are_summed_along_a_tree(spark, docs, monkeypatch):
    monkeypatch.setattr(align, "FAN_IN", 2)
    rng = random.Random(2)
    rows = [(i, prose(rng, 20), "s") for i in range(40)]
    table = align.count_table(docs(rows).repartition(9), align.default_folder())
    got = {r["pair"]: r["count"] for r in align._pair_rows(table).collect()}
    toks = align.Tokenizers(align.default_folder())
    want = Counter()
    for _, t, _ in rows:
        want.update(align.align(align.pieces_of(t), toks).pairs.tolist())
    assert got == want
    assert os.path.basename(align.default_folder()) == "public_tokenizers"
