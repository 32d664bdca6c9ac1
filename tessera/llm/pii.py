"""Information-theoretic sanitisation, in DataFrame functions only.

Personal data are found by patterns.  With them stand terms that give the
protected value away: from how often a term stands in a text with a value, and
how often anywhere, the corpus tells how much of the value's information the
term reveals.  With counts of documents n(t, e) of both, n(t), n(e) and n in
all, the term discloses the share

    pmi(t, e) / ic(e) = log(n(t, e) * n / (n(t) * n(e))) / log(n / n(e))

which is 1 where the term occurs with that value only.  The share of t's
documents that have e is not taken as counted but with one document more, in
which e stands by chance alone: (n(t, e) + n(e) / n) / (n(t) + 1).  So a value
seen once is judged too, by as much as one document can show in so many.
Terms above the threshold are generalised wherever they stand in a text that
holds the value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, lower_ascii

# The patterns in forms that never go back over a match, for long texts; they
# match what the plain forms match.  A local part or number is tried where its
# characters begin (or the last match ended), as any later place ends alike.
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this cannot hold the kind.
_HINT = {"email": "@", "ip": ".", "card": None, "phone": "+"}

# A term is a run of letters (all beyond ASCII count) of at least three characters.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]{3,}+"
DISCLOSURE = 0.9

# Matches whose spans are gathered together.
BLOCK = 256

_SPAN = "array<struct<start:int,end:int,value:string>>"


def find_spans(text: Column, pattern: str, wanted: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost, non-overlapping matches as (start, end, value) in code points;
    only those whose value is ``wanted``, if that is given.

    Matches and what lies between them alternate, so positions are running
    sums of their lengths.  Spans are gathered by blocks, as adding to one long
    array copies it each time.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    steps = F.zip_with(between, found, lambda b, m: F.struct(F.length(b).alias("gap"), m.alias("m")))
    steps = F.filter(steps, lambda s: s.m.isNotNull())

    def step(acc: Column, s: Column) -> Column:
        a = acc["at"] + s["gap"]
        b = a + F.length(s["m"])
        one = F.struct(a.alias("start"), b.alias("end"), s["m"].alias("value"))
        out = F.concat(acc["out"], F.array(one))
        if wanted is not None:
            out = F.when(wanted(s["m"]), out).otherwise(acc["out"])
        return F.struct(b.alias("at"), out.alias("out"))

    def block(acc: Column, s: Column, i: Column) -> Column:
        start = F.struct(acc["at"].alias("at"), F.array().cast(_SPAN).alias("out"))
        own = F.slice(s, i * BLOCK + 1, F.lit(BLOCK))
        add = lambda r: F.struct(r["at"].alias("at"), F.concat(acc["out"], F.array(r["out"])).alias("out"))
        return F.aggregate(own, start, step, add)

    def all_blocks(s: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out"))
        blocks = F.sequence(F.lit(0), F.floor(F.size(s) / BLOCK).cast("int"))
        return F.aggregate(blocks, start, lambda acc, i: block(acc, s, i), lambda acc: F.flatten(acc["out"]))

    # The steps are bound to a name, so that they are found once.
    return F.transform(F.array(steps), all_blocks)[0]


def _luhn(value: Column) -> Column:
    digits = F.split(F.reverse(F.regexp_replace(value, "[^0-9]", "")), "")
    digits = F.transform(F.filter(digits, lambda x: x != ""), lambda x: x.cast("int"))
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    n = F.size(digits)
    return (n >= 16) & (n <= 19) & (F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        byte = r"0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
        return value.rlike(rf"^{byte}(\.{byte}){{3}}$")
    if kind == "card":
        # Long digit runs are refused by length before they are summed.
        return F.when(F.length(value) <= 40, _luhn(value)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(8, 15)
    return F.lit(True)


def kind_spans(text: Column, kind: str) -> Column:
    """The kind's valid spans; failing matches are dropped without a retry."""
    hint = _HINT[kind]
    none = F.array().cast(_SPAN)
    found = find_spans(text, KINDS[kind], lambda m: _valid(kind, m))
    has = text.contains(hint) if hint else text.rlike("[0-9][\\x20-]?[0-9]")
    return F.when(has, found).otherwise(none)


def _terms(text: Column) -> Column:
    """The distinct terms of the whole text, in lower case."""
    return F.array_distinct(F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))), F.lower))


def _base() -> Column:
    return F.concat(*[F.col(k) for k in KINDS])


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), one array of spans per kind, and the text
    where there is any of them (else null)."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = d.select("doc_id", "text", *[kind_spans(F.col("text"), k).alias(k) for k in KINDS])
    return d.select("doc_id", F.md5("text").alias("key"), *KINDS, F.when(F.size(_base()) > 0, F.col("text")).alias("text"))


def document_counts(docs: DataFrame) -> DataFrame:
    """(term, n_t): documents of the whole table that have the term."""
    return docs.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))


def disclosing_terms(docs: DataFrame, found: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """(key, terms): the terms of each text that reveal at least ``disclosure``
    of a value in it, wherever in the text either of them stands.

    Texts are counted by the number of their rows.  The values of one text that
    no other has are alike in all counts: one of them stands for all.
    """
    total = float(found.count())
    values = F.array_distinct(F.transform(_base(), lambda s: lower_ascii(s["value"])))
    texts = found.filter(F.col("text").isNotNull()).select("key", "text", values.alias("values"))
    texts = texts.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.first("text").alias("text"), F.first("values").alias("values"))
    held = texts.select("key", "m", F.explode("values").alias("entity"))
    ents = held.groupBy("entity").agg(F.sum("m").alias("n_e"), (F.count(F.lit(1)) == 1).alias("single"))
    held = held.join(ents, "entity")
    one = F.when(F.col("single"), F.concat(F.lit("\x00"), F.col("key"))).otherwise(F.col("entity"))
    held = held.select("key", one.alias("entity"), "n_e").distinct()
    # A value in every document holds no information to disclose.
    held = held.filter(F.col("n_e") < total)
    # As n(t, e) is at most n(e), a term in more documents than this is below the threshold.
    most = (F.col("n_e") + F.col("n_e") / F.lit(total)) * F.pow(F.lit(total) / F.col("n_e"), F.lit(1 - disclosure)) * (1 + 1e-9) - 1
    per = held.groupBy("key").agg(F.collect_list(F.struct("entity", "n_e", most.alias("most"))).alias("entities"), F.max(most).alias("most"))
    terms = texts.select("key", "m", F.explode(_terms(F.col("text"))).alias("term")).join(document_counts(docs), "term")
    pairs = terms.join(per, "key").filter(F.col("n_t") <= F.col("most"))
    pairs = pairs.select("key", "m", "term", "n_t", F.explode("entities").alias("e")).filter(F.col("n_t") <= F.col("e.most"))
    pairs = cut(pairs.select("key", "m", "term", "n_t", "e.entity", "e.n_e"))
    counts = pairs.groupBy("entity", "term", "n_t", "n_e").agg(F.sum("m").alias("n_te"))
    ic = F.log(F.lit(total) / F.col("n_e"))
    p = (F.col("n_te") + F.col("n_e") / F.lit(total)) / (F.col("n_t") + 1)
    reveal = counts.filter(1 + F.log(p) / ic >= disclosure).select("entity", "term")
    return pairs.join(reveal, ["entity", "term"]).groupBy("key").agg(F.collect_set("term").alias("terms"))


def _with_terms(docs: DataFrame, disclosure: float) -> DataFrame:
    """``personal_data`` with ``term``: the spans of disclosing terms, clear of
    all base spans."""
    found = cut(personal_data(docs))
    reveal = disclosing_terms(docs, found, disclosure)
    spans = find_spans(F.col("text"), TERM, lambda m: F.array_contains("terms", F.lower(m)))
    clear = F.filter(spans, lambda t: ~F.exists(_base(), lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    clear = F.transform(clear, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.lower(t["value"]).alias("value")))
    j = found.join(reveal, "key", "left")
    return j.withColumn("term", F.when(F.col("terms").isNotNull(), clear).otherwise(F.array().cast(_SPAN))).drop("text", "terms")


def _listed(kinds: list[str]) -> Column:
    """``kind:start:end`` by kind, then start."""

    def part(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    return F.concat_ws(",", F.concat(*[part(k) for k in kinds]))


def _marks(kind: str) -> Column:
    mark = F.lit(f"[{kind.upper()}]").alias("mark")
    return F.transform(F.col(kind), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), mark))


def report(docs: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """Counts, digest and spans of every row of ``docs``.

    Null and empty texts hold nothing.  Rows are judged by their text, so
    repeated rows and rows that share a doc_id come out each on its own.  An
    empty table gives no rows.
    """
    d = _with_terms(docs, disclosure)
    kinds = list(KINDS)
    return d.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(_listed(kinds), 256).alias("base_sha256"),
        _listed([*kinds, "term"]).alias("spans"),
    )


def sanitise(docs: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """``docs`` with every span replaced by its kind, ``[EMAIL]`` or ``[TERM]``
    for example; spans that overlap become one, named by the first of them.
    Other columns stay, but n_chars, where there is one, follows the text."""
    spans = _with_terms(docs, disclosure)
    marked = F.concat(*[_marks(k) for k in [*KINDS, "term"]])
    spans = spans.select("key", F.sort_array(marked).alias("marks")).filter(F.size("marks") > 0).dropDuplicates(["key"])
    spans = spans.select(F.col("key").alias("_key"), F.col("marks").alias("_marks"))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        add = F.when(
            s["start"] >= acc["at"],
            F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), s["mark"]),
        ).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), add.alias("out"))

    def close(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text")))

    j = docs.join(spans, F.md5("text") == F.col("_key"), "left")
    j = j.withColumn("text", F.when(F.col("_marks").isNotNull(), F.aggregate("_marks", start, step, close)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        n = F.when(F.col("_marks").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        j = j.withColumn("n_chars", n)
    return j.select(*docs.columns)
