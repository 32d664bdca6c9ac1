"""Chat formatting, mixing, toxicity, Katz backoff, urls, top-k, pipeline."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

from llm_docs import docs  # noqa: F401  (puts the repository on the path)
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from tessera.llm import chat, components, katz, mix, topk, toxicity, urls
from tessera.llm.components import connected_components

# --- chat --------------------------------------------------------------------


def test_escape_round_trip_and_no_control_strings(spark):
    rng = random.Random(0)
    bits = ["<", "|", ">", "\\", "[", "INST]", "/INST]", "s>", "/s>", "end", "\n", "é", "[/INST]", "</s>", "<|end|>"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(600)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    df = df.select("t", "e", chat.unescape(F.col("e")).alias("b"))
    for r in df.collect():
        assert r["b"] == r["t"]
        assert not any(c in r["e"] for c in ("<|", "|>", "</s>", "<s>", "[INST]", "[/INST]"))


CONV = [
    (1, 0, "system", "be <|end|> good"), (1, 1, "user", "hi"), (1, 2, "assistant", "yes\n"), (1, 3, "user", None),
    (1, 4, "assistant", ""), (1, 5, "user", "bye"), (2, 1, "user", "only"), (None, None, None, None),
    (3, 300, "assistant", "late é"), (3, 2, "user", "early"), (4, 0, "assistant|>", "</s>"), (4, 0, "assistant|>", "</s>"),
]


def test_digest_equals_brute_force(spark):
    df = spark.createDataFrame(CONV, "conv_id long, turn long, role string, text string").withColumn("n_turns", F.lit("x"))
    got = {r["conv_id"]: r for r in chat.chat_digest(df).collect()}
    by = defaultdict(list)
    for c, t, role, text in CONV:
        by[c].append((t is not None, t, role or "", text or ""))
    for c, turns in by.items():
        turns = sorted(turns)
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        r = got[c]
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_each_reply_is_an_example_with_all_turns_before_it(spark):
    df = spark.createDataFrame(CONV[:6], "conv_id long, turn long, role string, text string")
    t = chat.transcripts(chat.format_turns(df))
    ex = sorted(chat.example_texts(t, chat.prefix_target_examples(t)).collect(), key=lambda r: r["target_turn"])
    assert [(r["target_turn"], r["target"]) for r in ex] == [(2, "yes\n"), (4, "")]
    assert ex[1]["context"].startswith(ex[0]["context"] + "yes\n<|end|>\n") and ex[0]["context"].endswith("<|assistant|>\n")
    empty = df.limit(0)
    assert chat.chat_digest(empty).count() == 0


# --- mixing ------------------------------------------------------------------


def brute_targets(size):
    names = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: mix.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(size.values()))
    while free:
        level = left / sum(w[s] for s in free)
        over = [s for s in free if w[s] * level > 3 * size[s]]
        if not over:
            return {**target, **{s: w[s] * level for s in free}}
        for s in over:
            target[s] = 3.0 * size[s]
            left -= target[s]
            free.remove(s)
    return target


def test_mix_reaches_its_targets(docs):
    rng = random.Random(7)
    rows = [(i, "w " * rng.randrange(400), rng.choice(["a", "a", "a", "b", "c", "d", None, "É"])) for i in range(400)]
    rows += [(1000, None, "empty"), (1001, "", "a"), (1002, "x " * 9000, "b"), (1002, "x " * 9000, "b"), (1003, "one", "tiny")]
    got = mix.mix_sources(docs(rows), block_words=64).collect()
    again = mix.mix_sources(docs(rows), block_words=64).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    size, taken, target = Counter(), Counter(), {}
    source = {k: s for k, _, s in rows}
    for r in got:
        s = source[r["doc_id"]]
        size[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = brute_targets({s: size[s] for s in {s for _, _, s in rows}})
    for s, t in want.items():
        assert math.isclose(target[s], t, rel_tol=1e-9, abs_tol=1e-9)
        assert abs(taken[s] - t) <= 1, s
    assert mix.mix_sources(docs([])).count() == 0


def test_schedule_has_low_discrepancy(docs):
    rows = [(i, "w " * 500, f"s{i % 5}") for i in range(200)]
    sized = docs(rows).select("doc_id", "source", mix.word_count(F.col("text")).alias("size"))
    t = mix.source_targets(sized)
    share = {r["source"]: r["target"] for r in t.collect()}
    total = sum(share.values())
    slots = sorted(mix.schedule(t, 100).collect(), key=lambda r: r["slot"])
    seen = Counter()
    for n, r in enumerate(slots[: len(slots) * 9 // 10], 1):
        seen[r["source"]] += 1
        assert all(abs(seen[s] - n * share[s] / total) < 8 for s in share)


def test_first_slots_follow_the_golden_ratio(docs):
    rows = [(i, "w " * (40 + i % 50), f"s{i % 3}") for i in range(300)] + [(900, None, "s0"), (901, "", None)]
    df = docs(rows)
    got = mix.mix_sources(df, block_words=64).collect()
    source = {k: s for k, _, s in rows}
    assert all((r["first_slot"] is None) == (r["taken"] == 0) for r in got)
    # The sources of the slots, from the points themselves.
    size, target = Counter(), {}
    for r in got:
        size[source[r["doc_id"]]] += r["size"]
        target[source[r["doc_id"]]] = r["target"]
    need, names = [], [s for s in ("s0", "s1", "s2") if target[s] > 0]
    for s in names:
        quota = round(target[s])
        need.append(quota // size[s] * -(-size[s] // 64) + -(-(quota % size[s]) // 64))
    n, at = sum(need), np.cumsum([0, *need])
    owner = [names[int(np.searchsorted(at[1:] / n, (k + 1) * mix.GOLDEN % 1.0, "right"))] for k in range(n)]
    for r in got:
        if r["first_slot"] is not None and r["first_slot"] < n:
            assert owner[r["first_slot"]] == source[r["doc_id"]]
    # In every beginning of the first slots, sources stand near their shares.
    whole = {s: target[s] / sum(target[t] for t in names) for s in names}
    seen = Counter()
    for k, s in enumerate(owner, 1):
        seen[s] += 1
        assert all(abs(seen[t] - k * whole[t]) < 4 for t in names)


def test_mixed_documents_report_their_own_words(spark, docs):
    rng = random.Random(12)
    text = lambda n: " ".join(f"w{rng.randrange(50)}" for _ in range(n))
    rows = [(1, text(100), "a"), (1, text(100), "b"), (1, text(100), "b"), (None, text(30), None), (None, text(40), "a")]
    rows += [(5, "x y z", "b")] * 2 + [(9, "", "a"), (9, None, "a")] + [(20 + i, text(50), rng.choice("abc")) for i in range(20)]
    d = docs(rows).withColumn("mix_taken", F.lit("old")).withColumn("_row_hi", F.lit(3))
    got = mix.mixed_documents(d, block_words=16).collect()
    assert all(isinstance(r["mix_taken"], int) and r["mix_taken"] > 0 and r["_row_hi"] == 3 for r in got)
    assert all(r["mix_taken"] <= 3 * len(r["text"].split()) for r in got)
    # Each source's rows together report the source's target.
    target = {r["source"]: r["target"] for r in mix.source_targets(
        d.select("source", mix.word_count(F.col("text")).alias("size")), mix.WEIGHTS, mix.MAX_REPEATS).collect()}
    per = Counter()
    for r in got:
        per[r["source"]] += r["mix_taken"]
    assert all(abs(per[s] - t) <= 2 for s, t in target.items())
    plain = sum(r["taken"] for r in mix.mix_sources(d, block_words=16).collect())
    assert abs(sum(per.values()) - plain) <= 1


# --- toxicity ----------------------------------------------------------------


def labelled(spark, docs, n=600):
    rng = random.Random(8)
    clean, bad = [f"v{i}" for i in range(300)], ["zork", "blarg"] + [f"snarf{c}" for c in "abcdefghijkl"]
    rows, labels = [], []
    for i in range(n):
        y = int(rng.random() < 0.2)
        w = [rng.choice(clean) for _ in range(rng.randrange(5, 80))]
        for _ in range(3 * y):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w) + ".", "s"))
        labels.append((i, 1, y))
    return docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows, labels


def test_chain_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    emit, trans, lengths = rng.normal(size=9), rng.normal(size=(2, 2)), np.array([4, 1, 3, 1])
    p, pairs = toxicity.chain_marginals(emit, lengths, trans)
    at, want_pairs = 0, np.zeros((2, 2))
    for n in lengths:
        e = emit[at : at + n]
        weights = {}
        for m in range(2**n):
            y = [(m >> i) & 1 for i in range(n)]
            weights[tuple(y)] = math.exp(sum(e[i] * y[i] for i in range(n)) + sum(trans[y[i], y[i + 1]] for i in range(n - 1)))
        z = sum(weights.values())
        for i in range(n):
            assert math.isclose(p[at + i], sum(v for y, v in weights.items() if y[i]) / z, rel_tol=1e-9)
        for y, v in weights.items():
            for i in range(n - 1):
                want_pairs[y[i], y[i + 1]] += v / z
        at += n
    assert np.allclose(pairs, want_pairs)


def test_long_chains_equal_the_steps(monkeypatch):
    rng = np.random.default_rng(3)
    lengths = np.array([1, 700, 2, 3000, 513, 40])
    emit, trans = rng.normal(0, 8, lengths.sum()), rng.normal(0, 3, (2, 2))
    p, pairs = toxicity.chain_marginals(emit, lengths, trans)
    monkeypatch.setattr(toxicity, "LONG_CHAIN", 10**9)
    q, own = toxicity.chain_marginals(emit, lengths, trans)
    assert np.allclose(p, q, atol=1e-9) and np.allclose(pairs, own, atol=1e-6)


def test_bounded_training_rows_move_no_text(spark, docs):
    d, labels, rows, _ = labelled(spark, docs)
    y = toxicity.training_labels(labels)
    whole = toxicity.training_rows(d, y, None)
    some = toxicity.training_rows(d, y, 20)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    per = {r["toxic"]: r["count"] for r in some.groupBy("toxic").count().collect()}
    assert per == {0: 20, 1: 20} and whole.count() > 40
    # The bound holds no rows back when it is above their number.
    every = toxicity.fit_toxic_model(d, labels, train_rows=None)
    bounded = toxicity.fit_toxic_model(d, labels, train_rows=10**6)
    assert every.odds == bounded.odds and np.allclose(every.score_w, bounded.score_w)
    none = toxicity.fit_toxic_model(d, labels, fit_bytes=0)
    assert none.score_w[:3].tolist() == [0, 0, 0]


def test_toxic_documents_and_spans_are_found(spark, docs):
    d, labels, rows, marks = labelled(spark, docs)
    got = {r["doc_id"]: r for r in toxicity.score_documents(d, labels).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sorted(k for k, r in got.items() if r["held_out"]) == held
    truth = {i: y for i, _, y in marks}
    right = sum(got[i]["predicted"] == truth[i] for i in held)
    assert right >= 0.97 * len(held)
    model = toxicity.fit_toxic_model(d, labels)
    odd = docs([(1, "É v1 snarfz v2 zork", "s"), (2, None, "s"), (3, "", "s"), (4, "... !", "s"), (None, "v1 " * 30_000, "s")])
    out = {r["doc_id"]: r for r in toxicity.tag_toxic(odd, model).collect()}
    assert [(s["start"], s["end"]) for s in out[1]["spans"]] == [(5, 11), (15, 19)]
    assert out[2]["score"] == out[3]["score"] == out[4]["score"] < 0.3 and out[None]["score"] < 0.3
    kept = toxicity.drop_toxic(d, labels)
    assert kept.columns == d.columns and abs(kept.count() - (len(rows) - sum(truth.values()))) < 20


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(docs([(1, "a", "s"), (2, None, "s")]), none).collect()
    assert len(got) == 2 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score_documents(docs([]), none).count() == 0


# --- Katz --------------------------------------------------------------------


def brute_katz(rows):
    held = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 5 == 1
    seqs = [(k, ["<s>"] + (t or "").lower().split(), held(k)) for k, t, _ in rows]
    uni, bi, hist, succ = Counter(), Counter(), Counter(), defaultdict(set)
    for _, s, out in seqs:
        if not out:
            s = s + ["</s>"]
            uni.update(s[1:])
            for a, b in zip(s, s[1:]):
                bi[a, b] += 1
                hist[a] += 1
                succ[a].add(b)
    n, v = sum(uni.values()), len(uni)
    d1, d2 = (katz.discounts(np.array([sum(c == r for c in x.values()) for r in range(1, 7)])) for x in (uni, bi))
    cut = lambda c, d: d[c] * c if c < len(d) else c - 0.5
    unknown = 1 - sum(cut(c, d1) for c in uni.values()) / n if n else 1.0
    pu = lambda w: cut(uni[w], d1) / n if uni[w] else unknown

    def p(w, h):
        if not hist[h]:
            return pu(w)
        if bi[h, w]:
            return cut(bi[h, w], d2) / hist[h]
        left = 1 - sum(cut(bi[h, x], d2) for x in succ[h]) / hist[h]
        return left / (1 - sum(pu(x) for x in succ[h])) * pu(w)

    out = {}
    for k, s, o in seqs:
        s = s + ["</s>"]
        base = sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in s[1:])
        score = sum(math.log10(p(w, h)) for h, w in zip(s, s[1:]))
        out[k] = (o, len(s) - 1, sum(uni[w] > 0 for w in s[1:]), n, base, score)
    total = lambda h: sum(p(w, h) for w in uni) + p("never seen", h)
    return out, [total(h) for h in list(hist)[:20]]


@pytest.mark.parametrize("chunk", [1_500_000, 300])
def test_katz_scores_equal_brute_force(docs, monkeypatch, chunk):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", chunk)
    rng = random.Random(9)
    vocab = [f"t{int(rng.paretovariate(0.7))}" for _ in range(3000)]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(60))), "s") for i in range(120)]
    rows += [(500, None, "s"), (501, " \n", "s"), (502, "Same same SAME", "s"), (503, "hot " * 4000, "s")]
    want, totals = brute_katz(rows)
    assert np.allclose(totals, 1, atol=1e-9)
    got = {r["doc_id"]: r for r in katz.score_documents(docs(rows), partition_bytes=2000).collect()}
    assert set(got) == set(want)
    for k, (out, n, known, tokens, base, score) in want.items():
        r = got[k]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out, n, known, tokens)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r["score"], score, rel_tol=1e-7, abs_tol=1e-7)


def test_counting_deals_a_hot_word_by_its_pairs(docs, monkeypatch):
    rows = [(i, " ".join(f"v{i}x{j} hot" for j in range(60)), "s") for i in range(40)]
    sent, dealt = [], katz._dealt
    monkeypatch.setattr(katz, "_dealt", lambda df, parts: sent.append(df) or dealt(df, parts))
    katz.fit(docs(rows).withColumn("held", katz.held_out()), 8)
    load = {}
    for r in sent[0].collect():
        load[r["part"]] = load.get(r["part"], 0) + len(katz._load(r["data"])["h"])
    assert max(load.values()) < 0.25 * sum(load.values())


def test_katz_of_odd_rows(docs):
    assert katz.score_documents(docs([])).count() == 0
    got = katz.score_documents(docs([(None, "a b", "s"), (1, "a b", "s"), (1, "a b", "s")])).collect()
    assert len(got) == 3 and all(r["n_tokens"] == 3 and r["score"] < 0 for r in got)


# --- urls and components -----------------------------------------------------


def test_components_of_a_chain_a_star_and_noise(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 600 + i) for i in range(50)] + [(7, 7), (None, 3), (9, 8), (8, 9)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df, "a", "b").collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 500: 500, **{600 + i: 500 for i in range(50)}, 8: 8, 9: 8}


def test_rounds_over_few_edges_write_few_files(spark, monkeypatch):
    files, cut = [], components.cut

    def counted(df):
        out = cut(df)
        files.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(components, "cut", counted)
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(60).selectExpr("id as a", "id + 2 as b").repartition(30)
        got = {r["node"]: r["component"] for r in connected_components(df, "a", "b").collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {k: k % 2 for k in range(62)}
    assert len(files) > 2 and max(files[1:]) <= 2 * spark.sparkContext.defaultParallelism


def test_rules_and_aliases(spark):
    html = '<html><head><link rel="canonical" href="{}"></head></html>'
    pages = [
        (1, "http://a.example.com/en/x", None),
        (2, "https://WWW.example.com/en/x?y#z", ""),
        (3, "http://other.org/p", html.format("http://b.net/es/q")),
        (4, "http://third.org/p", '<meta http-equiv="refresh" content="0; url=http://other.org/p">'),
        (5, "http://fourth.org/p/?utm_source=q", html.format("http://shop.com/")),
        (6, "http://fifth.org/x", html.format("http://fourth.org/p")),
        (7, "http://fifth.org/x?ref=1", html.format("http://b.net/fr/1")),
        (8, None, None), (9, "no scheme", "x"), (10, "://", None), (11, "http://net/es", None), (12, "x://b.net?q", None),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in urls.judge_urls(df.withColumn("host", F.lit(1)), urls.rule_table(spark)).collect()}
    assert (got[1]["rule"], got[1]["verdict"]) == ("example.com/en/", "block")
    assert (got[2]["host"], got[2]["path"], got[2]["rule"]) == ("www.example.com", "/en/x", "www.example.com/en/")
    assert got[3]["verdict"] == got[4]["verdict"] == "block" and got[3]["rule"] is None
    # An alias that is expressly allowed outweighs one that is blocked.
    assert got[5]["verdict"] == got[6]["verdict"] == got[7]["verdict"] == "allow"
    assert (got[8]["host"], got[8]["path"], got[9]["host"]) == ("", "", "")
    assert all(got[i]["verdict"] == "allow" for i in (8, 9, 10, 11, 12))
    assert urls.judge_urls(df.limit(0), urls.rule_table(spark)).count() == 0


def test_many_rules_of_one_domain(spark):
    rng = random.Random(14)
    piece = lambda: rng.choice(["a", "b", "é", "long-name", ""])
    path = lambda: "/" + "/".join(piece() for _ in range(rng.randrange(5)))
    hosts = ["org", "x.org", "a.x.org", "b.a.x.org", "ax.org", "", "y.net"]
    rules = [(rng.choice(["allow", "block"]), rng.choice(hosts), path()) for _ in range(400)]
    rules += [("block", "x.org", "/twice"), ("allow", "x.org", "/twice"), ("block", None, "/"), ("allow", "x.org", None), ("allow", "y.net", "")]
    asked = [(rng.choice(hosts), path() + rng.choice(["", "x", "/twice"])) for _ in range(300)] + [("x.org", "/twice/1"), ("", "")]
    table = spark.createDataFrame(rules, "verdict string, rule_host string, rule_path string")
    got = urls.match_rules(spark.createDataFrame(asked, "host string, path string"), table).collect()
    want = set()
    for h, p in set(asked):
        fits = [(len(rh + rp), len(rh), rh + rp, v) for v, rh, rp in rules if rh is not None and rp is not None and (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
        if fits:
            want.add((h, p, *max(fits)[2:]))
    assert {tuple(r) for r in got} == want and len(got) == len(want)


# --- top-k -------------------------------------------------------------------


def brute_top(rows, k=20):
    v = [(i, [math.floor(64 * x) for x in e]) for i, e in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, a in v:
        if q % 20 == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in v if i != q)[:k]
            out += [(q, n, i, -c) for n, (c, i) in enumerate(s, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 3])
def test_top_k_equals_brute_force(spark, block):
    rng = random.Random(10)
    rows = [(i, [rng.choice([0.5, -0.25, rng.gauss(0, 1)]) for _ in range(24)]) for i in range(300)]
    rows += [(301, [1e12] * 24), (302, [0.1] * 5), (303, []), (304, None), (305, [None] * 24), (306, [float("nan")] * 24), (320, [2.0] * 30)]
    rows += [(340, rows[20][1]), (360, [float("inf")] * 24), (None, rows[1][1])]
    v = topk.scaled_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = topk.exact_top_k(v, v.filter("vec_id % 20 = 0"), query_block=block, vector_block=20 * block)
    assert sorted(map(tuple, got.collect())) == brute_top(rows)
    assert topk.exact_top_k(v.limit(0), v.limit(0)).count() == 0


def test_top_k_of_large_components_is_exact(spark):
    rng = random.Random(12)
    rows = [(i, [rng.choice([1e7, 3.0, -1e7]) + rng.random() for _ in range(6)]) for i in range(60)]
    # Products next to each other that doubles cannot tell apart.
    rows += [(100 + i, [1e7 + i / 64, 1e7, 0.0, 0.0, 0.0, 1.0]) for i in range(30)]
    v = topk.scaled_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = topk.exact_top_k(v, v.filter("vec_id % 20 = 0"))
    want = brute_top(rows)
    assert max(s for *_, s in want) > 2**53
    assert sorted(map(tuple, got.collect())) == want


def test_top_k_scores_beyond_a_long_raise(spark):
    vectors = lambda x: topk.scaled_vectors(spark.createDataFrame([(0, x), (1, x)], "vec_id long, embedding array<double>"))
    for x in ([1e12] * 3, [1e17], [1e18]):
        v = vectors(x)
        with pytest.raises(Exception, match="CAST_OVERFLOW|does not fit a long"):
            topk.exact_top_k(v, v.filter("vec_id = 0")).collect()


@pytest.mark.parametrize("block", [4096, 5])
def test_top_k_of_repeated_rows(spark, block):
    rng = random.Random(13)
    rows = [(i, [rng.randrange(-9, 9) / 4 for _ in range(3)]) for i in range(50)]
    rows += [(7, [2.0, 2.0, 2.0])] * 200 + [(40, [0.0, -1.0, 1.0])] * 50 + [(41, None)] * 50 + [(None, [1.0])] * 50
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, v int, copies int")
    v = topk.scaled_vectors(df)
    got = topk.exact_top_k(v, v.filter("vec_id % 20 = 0"), query_block=block, vector_block=3 * block)
    # A query of several rows is asked by the smallest of them.
    asked = {}
    for i, e in rows:
        if i is not None and e is not None and i % 20 == 0:
            w = [math.floor(64 * x) for x in e]
            asked[i] = min(w, asked.get(i, w))
    want = []
    for i, a in asked.items():
        s = sorted((-sum(math.floor(64 * x) * y for x, y in zip(e, a)), j) for j, e in rows if j is not None and e is not None and j != i)
        want += [(i, n, j, -c) for n, (c, j) in enumerate(s[:20], 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_segment_bound_holds():
    rng = np.random.default_rng(1)
    x, y = rng.integers(-60, 60, (40, 64)).astype(float), rng.integers(-60, 60, (40, 64)).astype(float)
    for s in (1, 2, 8, 32, 64):
        bound = topk.segment_features(x, s) @ topk.segment_features(y, s).T
        assert (bound >= x @ y.T - 1e-6).all()


# --- pipeline ----------------------------------------------------------------


def test_pipeline_stages(spark, docs, tmp_path):
    d, labels, rows, marks = labelled(spark, docs)
    rng = random.Random(11)
    leak = " ".join(f"q{i}" for i in range(30))
    more = [(2000, rows[1][1] + " more", "s"), (2001, rows[3][1] + " " + leak, "s"), (2002, rows[5][1] + " me@home.example", "t"), (2003, None, None)]
    d = d.unionByName(docs(more)).drop("component_id")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "mixing"]
    kept = d
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == d.columns, name
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert 2001 not in out and all(r["mix_taken"] > 0 for r in out.values())
    assert all("me@home.example" not in r["text"] for r in out.values())
    assert sum(1 for i, _, y in marks if y and i in out) <= 3
