"""Message tables in delimited text files."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MESSAGE_COLUMNS, NA_VALUES, PROBLEM_COLUMNS, PROBLEM_RU_COLUMNS
from .records import read_records

_OVERFLOW, _CORRUPT = "_overflow", "_corrupt"


def _unique_headers(headers: Sequence[str]) -> list[str]:
    """Column names Spark can tell apart.

    Of names that differ in case only, the one that comes first among the role names keeps its form; the others
    get a number.
    """
    preferred = [*PROBLEM_COLUMNS, *PROBLEM_RU_COLUMNS, *MESSAGE_COLUMNS]

    def choice(i: int) -> tuple[int, int]:
        name = headers[i]
        return (preferred.index(name) if name in preferred else len(preferred), i)

    names: list[str] = list(headers)
    taken: set[str] = set()
    for i in sorted(range(len(headers)), key=choice):
        name, n = headers[i], 0
        while name.lower() in taken:
            n += 1
            name = f"{headers[i]}_{n}"
        taken.add(name.lower())
        names[i] = name
    return names


def _too_long(n: int, sep: str) -> Column:
    """More fields than the header.

    With one spare column a row of exactly one field too many parses cleanly, every other row with a wrong
    number of fields is kept raw; there the separators outside quoted fields tell long rows from short ones.  A quote
    opens a field only at its start, and without doubled quotes a quoted field has no quotes inside.
    """
    single = F.replace(_CORRUPT, F.lit('""'), F.lit(""))
    bare = F.regexp_replace(F.regexp_replace(single, f'(^|{sep})"[^"]*+"', "$1"), f"[^{sep}]", "")
    return F.col(_CORRUPT).isNull() | (F.char_length(bare) >= n)


def read_messages(
    spark: SparkSession,
    path: str,
    sep: str | None = None,
    na_values: Sequence[str] = NA_VALUES,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Read a header file, or a folder of files with one header, into string columns and ``row_id``.

    Quoted fields may hold separators, doubled quotes and line breaks.  Rows with too many fields are left out,
    short rows are filled with null, and texts that mean "no value" become null.  Without ``sep`` the header
    decides between ``;`` and ``,``.

    ``row_id`` follows the order of the files, by path, and of the rows in them.  Large files are read in pieces by
    many tasks, also where fields hold line breaks; see ``read_records``.
    """
    if encoding.upper().startswith(("UTF-16", "UTF-32")):
        raise ValueError(f"line ends cannot be found in {encoding}; write the file as UTF-8 first")
    header = spark.read.text(path).select(F.col("value").cast("binary").alias("value")).head()
    if header is None:
        raise ValueError(f"no header in {path}")
    line = bytes(header.value).decode(encoding).removeprefix("\ufeff")
    sep = sep or (";" if ";" in line else ",")
    names = _unique_headers(next(csv.reader([line], delimiter=sep)))
    # Columns are read by place, so that odd header names cannot confuse the reader.
    fields = [f"c{i}" for i in range(len(names))]
    schema = ", ".join(f"`{f}` string" for f in [*fields, _OVERFLOW, _CORRUPT])
    options = {
        "sep": sep,
        "multiLine": "true",
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnPruning": "false",  # a row has to be parsed whole to tell its length
        "columnNameOfCorruptRecord": _CORRUPT,
    }
    # Lines that end in a carriage return and nothing else come as one "line" here.
    whole = spark.read.option("lineSep", "\n").text(path).select(F.left("value", F.lit(1 << 16)).alias("start")).head()
    line_sep = "\r" if "\r" in whole.start.removesuffix("\r") else "\n"
    records = read_records(spark, path, sep, line_sep)
    text = F.col("record").cast("string") if encoding.upper() == "UTF-8" else F.decode("record", encoding)
    raw = records.select("row_id", F.from_csv(text, schema, options).alias("f")).select("row_id", "f.*")
    kept = raw.filter(F.col(_OVERFLOW).isNull() & ~_too_long(len(names), sep))

    def value(field: str) -> Column:
        c = F.col(field)
        return F.when(~c.isin(*na_values), c) if na_values else c

    return kept.select("row_id", *[value(f).alias(n) for f, n in zip(fields, names, strict=True)])
