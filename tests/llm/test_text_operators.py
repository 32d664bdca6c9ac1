"""Decontamination, near-dedup, span dedup and PII against brute force."""

import hashlib
import random
import re

import pytest
from llm_docs import docs  # noqa: F401
from tessera.llm import decontaminate, neardup, pii, spans

WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edit(rng, text, k):
    w = text.split()
    for _ in range(k):
        w[rng.randrange(len(w))] = rng.choice(WORDS)
    return " ".join(w)


ODD = [(None, None, None), (900, "", "a"), (901, " \t\n", "a"), (902, "one", "b"), (903, "one", "b"), (903, "one", "b")]


# --- decontamination ---------------------------------------------------------


def alnum(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute_contamination(docs, items, window):
    out = []
    for k, t, _ in docs:
        w, hit, found = alnum(t), set(), set()
        for item, text in items:
            iw = alnum(text)
            n = min(window, len(iw))
            wins = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
            for i in range(len(w) - n + 1 if n else 0):
                if tuple(w[i : i + n]) in wins:
                    hit.update(range(i, i + n))
                    found.add("null" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((k, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("max_windows", [200_000, 5])
def test_contamination_equals_brute_force(spark, docs, max_windows):
    rng = random.Random(1)
    items = [(i, prose(rng, 15)) for i in range(6)] + [(10, "Odd-One, OUT"), (11, ""), (12, None), (2, "É x"), (None, "zz")]
    items.append((7, "a a a a a a a a a a a a"))
    rows = [(i, prose(rng, 60), "s") for i in range(6)] + ODD
    rows.append((20, prose(rng, 5) + " " + items[1][1].upper().replace(" ", "--") + " tail", "s"))
    rows.append((21, " ".join(items[2][1].split()[2:13]) + " odd one out é X zz", "s"))
    rows.append((22, "a " * 30, "s"))
    rows.append((23, prose(rng, 20_000) + " " + items[3][1], "s"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination_report(docs(rows), bench, max_windows=max_windows)
    assert sorted(map(tuple, got.collect()), key=str) == brute_contamination(rows, items, 10)
    kept = decontaminate.decontaminate(docs(rows), bench, max_windows=max_windows)
    assert kept.columns == docs(rows).columns
    clean = [r for r in brute_contamination(rows, items, 10) if not r[5]]
    assert kept.count() == len(clean)


def test_contamination_of_empty_tables(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination_report(docs([(1, "a b", "s")]), bench).first()
    assert (got["n_words"], got["n_hit"], got["contaminated"]) == (2, 0, False)
    assert decontaminate.contamination_report(docs([]), bench).count() == 0
    assert decontaminate.decontaminate(docs([(1, "a b", "s")]), bench).count() == 1


# --- near-dedup --------------------------------------------------------------


def brute_components(rows, percent=75):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        n = min(5, len(w))
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()

    sets = [shingles(t) for _, t, _ in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                comp[find(i)] = find(j)
    label = {}
    for i, (k, _, _) in enumerate(rows):
        label.setdefault(find(i), []).append(k)
    out = []
    for i, (k, _, _) in enumerate(rows):
        ids = [x for x in label[find(i)] if x is not None]
        c = min(ids) if ids else None
        out.append((k, len(sets[i]), c, k == c))
    return sorted(out, key=str)


def test_components_equal_brute_force(docs):
    rng = random.Random(2)
    base, passage = [prose(rng, 120) for _ in range(4)], prose(rng, 60)
    rows = [(i, prose(rng, rng.choice([3, 8, 40, 200])), "s") for i in range(20)]
    rows += [(100 + i, edit(rng, base[i % 4], rng.choice([0, 1, 2, 3, 5, 9])), "s") for i in range(120)]
    rows += [(300 + i, passage + " " + prose(rng, rng.choice([20, 60])), "s") for i in range(40)]
    rows += [(400, base[0].upper(), "s"), (None, base[1], "s")] + ODD
    got = neardup.near_duplicates(docs(rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows)


def test_small_blocks_give_the_same_components(docs, monkeypatch):
    rng = random.Random(3)
    base = prose(rng, 80)
    rows = [(i, edit(rng, base, rng.choice([0, 2, 3, 4, 6])), "s") for i in range(60)]
    monkeypatch.setattr(neardup, "BLOCK", 7)
    got = neardup.near_duplicates(docs(rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows)


def test_drop_keeps_one_row_of_each_group(docs):
    rows = [(5, "a b c d e f", "s"), (3, "A b c d e f", "s"), (9, "x", "s"), (8, None, "s")]
    kept = neardup.drop_near_duplicates(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 8, 9]
    assert neardup.near_duplicates(docs([])).count() == 0


def test_near_dedup_of_clashing_columns(docs):
    text = "one two three four five six seven eight nine ten"
    df = docs([(1, text, "a"), (2, text, "b"), (3, "other words only", "a")])
    for c in ("_row_hi", "_row_lo", "__row_hi", "_text_hash", "hi", "lo", "c", "g", "a.b"):
        df = df.withColumn(c, df.doc_id * 10)
    got = neardup.drop_near_duplicates(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"], r["_row_hi"], r["a.b"]) for r in got.collect()) == [(1, 10, 10), (3, 30, 30)]
    assert sorted(r["component_id"] for r in neardup.near_duplicates(df).collect()) == [1, 1, 3]


def test_drop_decides_by_row_where_ids_repeat_or_are_null(docs):
    same = [(i, "one text of seven words in all", "s") for i in (None, None, 2, 2)]
    rows = [(1, "a b c d e f", "s"), (4, "A b c d e f", "s"), (4, "quite other words under the same id", "s")]
    rows += [(None, "a  b c d e f", "s"), (None, "clean text of no id at all", "s"), (None, "null ids only have this text", "s")]
    rows += [(None, "Null ids only have this text", "s"), (7, "", "s"), (7, "", "s"), *same]
    kept = [(r["doc_id"], r["text"]) for r in neardup.drop_near_duplicates(docs(rows)).collect()]
    low = sorted(((k, t.lower()) for k, t in kept), key=str)
    want = [(1, "a b c d e f"), (4, rows[2][1]), (None, rows[4][1]), (None, rows[5][1]), (7, ""), (7, ""), (2, same[0][1])]
    assert low == sorted(want, key=str)


# --- span dedup --------------------------------------------------------------


def test_texts_without_an_id_are_found_one_by_one(spark, docs, monkeypatch):
    rng = random.Random(11)
    base = [prose(rng, 60) for _ in range(20)]
    rows = [(None, t, "s") for t in base] + [(None, edit(rng, t, 1), "s") for t in base[:10]] + [(5, base[0], "s"), (5, base[11], "s")]
    sets, links = [], neardup._star_links
    monkeypatch.setattr(neardup, "_star_links", lambda pairs, s, *a: sets.append(s) or links(pairs, s, *a))
    got = neardup.near_duplicates(docs(rows)).collect()
    assert len(got) == len(rows) and sets[0].count() == 20
    # Groups are named by id 5 where it is in them, else they have no name.
    assert sorted(r["component_id"] or 0 for r in got) == [0] * 27 + [5] * 5
    kept = neardup.drop_near_duplicates(docs(rows)).collect()
    assert len(kept) == 20 and sum(r["doc_id"] == 5 for r in kept) == 2


def test_many_rows_of_one_id_read_each_text_once(spark, docs, monkeypatch):
    rng = random.Random(12)
    base = [prose(rng, 40) for _ in range(50)]
    rows = [(None, t, "s") for t in base] + [(None, edit(rng, t, 1), "s") for t in base]
    table = docs(rows)
    read, frame, real = [], type(table), type(table).mapInArrow

    def seen(df, *args, **kwargs):
        if df.columns == ["want", "text"]:
            read.append(df)
        return real(df, *args, **kwargs)

    monkeypatch.setattr(frame, "mapInArrow", seen)
    neardup.near_duplicates(table).collect()
    assert [df.count() for df in read] == [len(rows)]


def brute_spans(rows, run, min_words):
    """Rows in doc_id order; a run seen in a smaller id, or before in the row, goes."""
    split = [[p for p in re.split(r"(?:(?<=[.!?])[ \t-\r]|\n)[ \t-\r]*", t or "")] for _, t, _ in rows]
    norm = [[" ".join(p.lower().split()) for p in ps if p.split()] for ps in split]
    owners = {}
    windows = []
    for (k, _, _), ps in zip(rows, norm):
        n = min(run, len(ps))
        ws = []
        for i in range(len(ps) - n + 1 if n else 0):
            ends = [e for e in range(i + n, len(ps) + 1) if sum(len(x.split()) for x in ps[i:e]) >= min_words]
            ws += [(i, tuple(ps[i : ends[0]]))] if ends else []
        for e in range(n, len(ps) + 1) if n else []:
            starts = [i for i in range(e - n + 1) if sum(len(x.split()) for x in ps[i:e]) >= min_words]
            ws += [(starts[-1], tuple(ps[starts[-1] : e]))] if starts else []
        ws = sorted(set(ws), key=lambda x: (x[0], len(x[1])))
        windows.append(ws)
        for _, w in ws:
            owners[w] = min(owners.get(w, k), k)
    out = []
    for (k, _, _), ps, ws in zip(rows, norm, windows):
        gone, seen = set(), set()
        for i, w in ws:
            if owners[w] < k or w in seen:
                gone.update(range(i, i + len(w)))
            seen.add(w)
        out.append((k, [p for i, p in enumerate(ps) if i not in gone]))
    return sorted(out, key=str)


def test_spans_equal_brute_force(docs):
    rng = random.Random(4)

    def sentence():
        return prose(rng, rng.choice([3, 9, 15])).capitalize() + rng.choice([".", "!", "?"])

    passage = " ".join(sentence() for _ in range(6))
    rows = [(i, " ".join(sentence() for _ in range(8)), "s") for i in range(10)]
    rows += [(20 + i, sentence() + "\n" + passage + "  " + sentence(), "s") for i in range(8)]
    rows += [(40, passage + "\n" + passage, "s"), (41, rows[0][1], "s"), (42, "short. same.", "s"), (43, "short. same.", "s")]
    rows += [(44, prose(rng, 30), "s"), (45, None, "s"), (46, "", "s"), (47, "\n \n", "s")]
    got = spans.dedup_spans(docs(rows)).collect()
    back = [(r["doc_id"], [" ".join(p.lower().split()) for p in re.split(r"(?:(?<=[.!?])[ \t-\r]|\n)[ \t-\r]*", r["text"] or "") if p.split()]) for r in got]
    assert sorted(back, key=str) == brute_spans(rows, spans.RUN, spans.MIN_WORDS)
    by = {r["doc_id"]: r for r in got}
    assert by[20]["n_removed"] == 0 and by[21]["n_removed"] >= 5 and by[21]["first_docs"] == [20]
    assert by[41]["text"] == "" and by[45]["text"] is None and by[42]["text"] == "short. same."
    assert all(by[i]["text"] == t and by[i]["n_removed"] == 0 for i, t, _ in rows[:10])


def test_one_long_sentence_is_a_passage(docs):
    rng = random.Random(7)
    long, short = prose(rng, 51) + ". ", prose(rng, 50) + ". "
    around = [prose(rng, 12) + ". " for _ in range(8)]
    rows = [(1, around[0] + long + around[1] + short + around[2], "s"), (2, around[3] + long.upper() + around[4] + short + around[5], "s")]
    rows += [(3, around[6] + long + around[7] + long, "s"), (4, long, "s")]
    got = {r["doc_id"]: (r["text"], r["n_removed"], r["first_docs"]) for r in spans.dedup_spans(docs(rows)).collect()}
    assert got[1] == (rows[0][1], 0, [])
    assert got[2] == (around[3] + around[4] + short + around[5], 1, [1])
    assert got[3] == (around[6] + around[7], 2, [1]) and got[4] == ("", 1, [1])


def test_rows_that_share_an_id_keep_their_spans(docs):
    t = "One two three four five six seven eight nine ten. " * 1 + "Eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty."
    got = spans.dedup_spans(docs([(1, t, "s"), (1, t, "s"), (None, t, "s")])).collect()
    assert [r["n_removed"] for r in sorted(got, key=lambda r: r["doc_id"] or 9)] == [0, 0, 2]
    assert spans.dedup_spans(docs([])).count() == 0


# --- PII ---------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def test_rows_without_an_id_are_told_apart_by_their_text(docs):
    rng = random.Random(13)
    passage = " ".join(prose(rng, 15).capitalize() + "." for _ in range(4))
    rows = [(None, f"Start {i}.\n{passage}\nEnd {i}.", "s") for i in range(6)] + [(None, None, "s"), (None, "", "s")]
    got = [r for r in spans.dedup_spans(docs(rows)).collect() if r["text"]]
    assert len(got) == 6 and sum(passage in r["text"] for r in got) == 1
    assert sum(r["n_removed"] >= 4 and r["first_docs"] == [] for r in got) == 5
    got = spans.dedup_spans(docs([*rows, (3, passage, "s")])).collect()
    assert [r["doc_id"] for r in got if passage in (r["text"] or "")] == [3]
    assert sum(r["first_docs"] == [3] for r in got) == 6


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def brute_base(t):
    out = []
    for kind, p in PLAIN.items():
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 16 <= len(d) <= 19 and luhn(d),
                "phone": 8 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_equal_brute_force(docs):
    rng = random.Random(5)
    chars = "aZ09.@%+- ()é😀1234567890"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(200))) for _ in range(150)]
    texts += ["a@b.co_x@y.zz 1.2.3.4.5 001.2.3.255 256.1.1.1 4111 1111-1111 1111 +1 (938) 555-0822"]
    texts += ["é" * 50 + " x@y.z", "9" * 20_000, "a" * 20_000 + "@", "1." * 5_000, None, "", "+12345678" * 3]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in pii.report(docs(rows)).collect()}
    for i, t, _ in rows:
        want = brute_base(t)
        r = got[i]
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert r["spans"].startswith(",".join(want))
        assert r["n_email"] == sum(x.startswith("email") for x in want)


def test_disclosing_terms_are_generalised(docs):
    rng = random.Random(6)
    rows = [(i, f"Contact Zorblatt today at boss@corp.example for {prose(rng, 30)}", "s") for i in range(5)]
    rows += [(10 + i, prose(rng, 40) + " today contact for", "s") for i in range(30)]
    rows.append((50, "mail once@corp.example Quibble", "s"))
    got = {r["doc_id"]: r["spans"].split(",") for r in pii.report(docs(rows)).collect()}
    # The name stands near that address only; the other words stand everywhere.
    assert "term:8:16" in got[0] and not any(s.startswith("term:0:") for s in got[0])
    assert [s for s in got[50] if s.startswith("term")] == []  # one document is no evidence
    out = {r["doc_id"]: r for r in pii.sanitise(docs(rows)).collect()}
    assert out[0]["text"].startswith("Contact [TERM] today at [EMAIL] for") and out[0]["n_chars"] == len(out[0]["text"])
    assert out[10]["text"] == rows[5][1]
    assert pii.sanitise(docs(rows)).columns == docs(rows).columns


def test_values_seen_once_are_judged(docs):
    rows = [(i, f"weather talk number {i}", "s") for i in range(1500)]
    rows.append((2000, "weather talk by Quibble at once@corp.example today", "s"))
    rows.append((2001, "talk of today", "s"))
    got = {r["doc_id"]: r["spans"].split(",") for r in pii.report(docs(rows)).collect()}
    # Quibble stands with that address only; the other words stand elsewhere too.
    assert [s for s in got[2000] if s.startswith("term")] == ["term:16:23"]


def test_disclosing_terms_far_from_the_value_are_generalised(docs):
    filler = "so it was said of them all " * 40
    rows = [(i, f"Zorblatt writes. {filler}Mail boss@corp.example. {filler}Again zorblatt.", "s") for i in range(5)]
    rows += [(10 + i, f"writes mail again {filler}", "s") for i in range(30)]
    got = {r["doc_id"]: r["spans"].split(",") for r in pii.report(docs(rows)).collect()}
    t, n = rows[0][1], len(rows[0][1])
    assert [s for s in got[0] if s.startswith("term")] == ["term:0:8", f"term:{n - 9}:{n - 1}"]
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(docs(rows)).collect()}
    assert out[0] == re.sub("(?i)zorblatt", "[TERM]", t).replace("boss@corp.example.", "[EMAIL].")
    assert out[10] == rows[5][1]


def test_pii_of_odd_rows(docs):
    assert pii.report(docs([])).count() == 0
    got = pii.report(docs(ODD)).collect()
    assert len(got) == len(ODD) and all(r["spans"] == "" for r in got)
    assert pii.sanitise(docs(ODD)).count() == len(ODD)


def test_pii_of_long_texts_with_many_matches(docs):
    mails = " ".join(f"n{i}@x{i}.org" for i in range(5_000))
    rows = [(1, "12, " * 100_000, "s"), (2, mails, "s"), (3, mails + " +1 234 567 89", "s")]
    got = {r["doc_id"]: r for r in pii.personal_data(docs(rows)).collect()}
    assert not got[1]["email"] + got[1]["card"] + got[1]["ip"] + got[1]["phone"]
    want = [(m.start(), m.end(), m[0]) for m in re.finditer(r"n\d+@x\d+\.org", mails)]
    assert [tuple(s) for s in got[2]["email"]] == want == [tuple(s) for s in got[3]["email"]]
    assert [tuple(s)[:2] for s in got[3]["phone"]] == [(len(mails) + 1, len(mails) + 14)]


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 512, 513])
def test_spans_at_the_ends_of_blocks(docs, n):
    text = "é " + "a@b.cd, " * n
    got = pii.personal_data(docs([(1, text, "s")])).first()["email"]
    assert [(s["start"], s["end"]) for s in got] == [(2 + 8 * i, 8 + 8 * i) for i in range(n)]
