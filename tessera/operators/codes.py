"""Code dictionaries parsed from text lines and code frequencies from
whitespace-separated code lists."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.parse import NON_WS_CLASS, WS_CLASS
from tessera.session import bounded_broadcast, spread

# "code<blanks>description": the first word is the code, the rest the text.
_STRICT = rf"(?s)^({NON_WS_CLASS}+){WS_CLASS}+(.*)$"
_TRIM = rf"^{WS_CLASS}+|{WS_CLASS}+$"
_LENIENT_REST = rf"(?s)^{NON_WS_CLASS}+{WS_CLASS}+(.*)$"

JOIN_HINTS = ("broadcast", "merge", "shuffle_hash", "shuffle_replicate_nl")


def parse_code_dictionary(
    lines: DataFrame,
    line_col: str = "value",
    lenient: bool = False,
    code_col: str = "code",
    desc_col: str = "description",
) -> DataFrame:
    """One (code, description) row per distinct code.

    strict: a line must start with a code followed by blanks and a
    description; other lines (leading blanks, code only) are dropped.
    lenient: the line is trimmed first and a code alone gets an empty
    description; blank lines are dropped.
    A code repeated on several lines keeps its smallest description, so a
    later left join cannot multiply rows.
    """
    line = F.col(line_col)
    if lenient:
        t = F.regexp_replace(line, _TRIM, "")
        parsed = lines.select(
            F.regexp_extract(t, rf"^({NON_WS_CLASS}+)", 1).alias(code_col),
            F.regexp_extract(t, _LENIENT_REST, 1).alias(desc_col),
        )
    else:
        parsed = lines.select(
            F.regexp_extract(line, _STRICT, 1).alias(code_col),
            F.regexp_extract(line, _STRICT, 2).alias(desc_col),
        )
    return (
        parsed.filter(F.col(code_col) != "")
        .groupBy(code_col)
        .agg(F.min(desc_col).alias(desc_col))
    )


def explode_codes(df: DataFrame, list_col: str, code_col: str = "code") -> DataFrame:
    """One row per code in a whitespace-separated list column (empty tokens dropped)."""
    # Explode first, then drop empty tokens: the filter stays in generated code.
    texts = spread(df.select(list_col).filter(F.col(list_col).isNotNull() & (F.col(list_col) != "")))
    tokens = texts.select(F.explode(F.split(F.col(list_col), WS_CLASS + "+")).alias(code_col))
    return tokens.filter(F.col(code_col) != "")


def code_frequency(
    codes: DataFrame,
    dictionary: DataFrame,
    how: str = "left",
    join_hint: str | None = None,
    code_col: str = "code",
    desc_col: str = "description",
    freq_col: str = "frequency",
    max_broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """Frequency of each code with its description, most frequent first.

    Counts are aggregated before the join (partial aggregation absorbs hot
    codes map-side), so only one row per distinct code meets the dictionary.
    ``how="left"`` keeps codes without a description and shows the code
    itself; ``how="inner"`` drops them.  ``join_hint`` (broadcast, merge,
    shuffle_hash, shuffle_replicate_nl) is passed to the planner on the
    dictionary side; Spark ignores shuffle_replicate_nl for an outer join.
    """
    freq = codes.groupBy(code_col).agg(F.count(F.lit(1)).alias(freq_col))
    d = dictionary
    if join_hint is not None:
        if join_hint not in JOIN_HINTS:
            raise ValueError(f"join_hint must be one of {JOIN_HINTS}")
        # A broadcast is honoured only for a dictionary proven small enough.
        if join_hint != "broadcast":
            d = d.hint(join_hint)
        else:
            d, small = bounded_broadcast(d, max_broadcast_rows)
            if not small:
                warnings.warn("dictionary above the broadcast bound: the planner chooses the join", stacklevel=2)
    joined = freq.join(d, on=code_col, how=how)
    return joined.select(
        F.col(code_col),
        F.coalesce(F.col(desc_col), F.col(code_col)).alias(desc_col),
        F.col(freq_col),
    ).orderBy(F.col(freq_col).desc(), F.col(code_col))
