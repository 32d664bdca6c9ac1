"""Headered CSV files read as one table, typed without an inference pass.

``inferSchema`` costs a full extra pass over the files.  Instead the header
names are taken as they are (every column a string) and only the columns an
analysis needs are selected and converted with ``try_cast``, so a bad value
becomes NULL rather than failing the job under ANSI mode.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the reference's inputs and the types its
# analyses read them as.
RECORD_COLUMNS: dict[str, str] = {
    "DATE OCC": "string",
    "Vict Age": "int",
    "Vict Descent": "string",
    "Crm Cd Desc": "string",
    "Mocodes": "string",
    "LAT": "double",
    "LON": "double",
}
CATEGORY_CODE_COLUMNS: dict[str, str] = {"Vict Descent": "string", "Vict Descent Full": "string"}
SITE_COLUMNS: dict[str, str] = {"X": "double", "Y": "double", "DIVISION": "string"}
INCOME_COLUMNS: dict[str, str] = {"Zip Code": "string", "Estimated Median Income": "string"}


# What a malformed record's text is kept as.
_BAD = "_bad_record"


def _first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """Each file's first line; a file is read no further than that."""
    files = spark.read.text(list(paths)).inputFiles()
    heads = {f: spark.read.text(f).take(1) for f in files}
    return {f: h[0]["value"] for f, h in heads.items() if h}


def _read_groups(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], sep: str) -> DataFrame:
    """``columns`` as text, the file and the text of malformed records, of all
    files: those of one header are one scan with its names, scans are united by
    name."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    groups: dict[tuple[str, ...], list[str]] = {}
    for f, line in _first_lines(spark, paths).items():
        names = tuple(next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep)))
        groups.setdefault(names, []).append(f)
    if not groups:
        raise ValueError(f"no CSV header in {paths}")
    parts = []
    for names, files in groups.items():
        missing = [c for c in columns if c not in names]
        if missing:
            raise ValueError(f"CSV header lacks columns {missing}; found {list(names)} in {files[0]}")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, _BAD)])
        options = {"header": True, "sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
        raw = spark.read.schema(schema).options(**options).csv(files)
        parts.append(raw.select(*[F.col(f"`{c}`") for c in columns], F.col("_metadata.file_path").alias("_file"), _BAD))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_csv_columns(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Mapping[str, str],
    sep: str = ",",
) -> DataFrame:
    """Read headered CSV file(s) as one table and keep ``columns`` (name -> SQL type).

    Headers may differ in order and in further columns: every file is read by
    its own header, and files with the same one in a single scan.  A file
    without one of ``columns`` fails the read.  Column pruning reaches the CSV
    reader, so unused columns are not converted.  A record with too few or too
    many fields is kept as far as it goes (:func:`read_csv_rejects` shows them).
    """
    raw = _read_groups(spark, paths, list(columns), sep)
    return raw.select(
        *[
            (F.col(f"`{name}`") if typ == "string" else F.col(f"`{name}`").try_cast(typ)).alias(name)
            for name, typ in columns.items()
        ]
    )


def read_csv_rejects(
    spark: SparkSession, paths: str | Sequence[str], columns: Mapping[str, str], sep: str = ","
) -> DataFrame:
    """(file, record, reason) of the records that do not fit: ``fields`` (too
    few or too many) or ``type`` (a value that is none of its column's type)."""
    raw = _read_groups(spark, paths, list(columns), sep)
    bad = [F.col(f"`{n}`").isNotNull() & F.col(f"`{n}`").try_cast(t).isNull() for n, t in columns.items() if t != "string"]
    wrong = F.lit(False)
    for b in bad:
        wrong = wrong | b
    reason = F.when(F.col(_BAD).isNotNull(), "fields").when(wrong, "type")
    text = F.coalesce(_BAD, F.concat_ws(sep, *[F.coalesce(f"`{c}`", F.lit("")) for c in columns]))
    out = raw.select(F.col("_file").alias("file"), text.alias("record"), reason.alias("reason"))
    return out.filter(F.col("reason").isNotNull())


def read_csv_schema(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """Read CSV with a full positional schema (every column of the file, in order)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).option("header", header).option("sep", sep).csv(paths)
