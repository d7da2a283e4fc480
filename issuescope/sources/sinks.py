"""Writing results."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lookup import quoted


def classified_path(input_path: str) -> str:
    """The default output name: ``<stem>_classified.csv`` next to the input."""
    stem, _ = os.path.splitext(input_path)
    return f"{stem}_classified.csv"


def write_classified(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", byte_order_mark: bool = True
) -> None:
    """Write a message table as parquet, or as ``;`` files with a header.

    In text files lists become ``|``-joined text, and empty and missing values look alike.  They start with a byte order
    mark, by which spreadsheets know the encoding.
    """
    if fmt == "parquet":
        df.write.mode(mode).parquet(path)
        return
    if fmt != "csv":
        raise ValueError(f"unknown format {fmt!r}")
    flat = df.select(
        *[
            F.array_join(quoted(f.name), "|").alias(f.name)
            if isinstance(f.dataType, T.ArrayType)
            else quoted(f.name)
            for f in df.schema.fields
        ]
    )
    if byte_order_mark and flat.columns:
        flat = flat.withColumnsRenamed({flat.columns[0]: f"\ufeff{flat.columns[0]}"})
    (
        flat.write.mode(mode)
        .option("sep", ";")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_distribution(ranked: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Write a frequency table, most frequent label first."""
    write_classified(ranked.orderBy("rank"), path, fmt, mode)


def write_report(report: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write the report table in reading order."""
    from ..operators.report import ORDER_COLUMNS

    if fmt not in ("parquet", "json"):
        raise ValueError(f"unknown format {fmt!r}")
    report.orderBy(*ORDER_COLUMNS).write.mode(mode).format(fmt).save(path)
