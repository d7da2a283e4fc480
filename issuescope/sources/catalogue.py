"""Label lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import LINE_BREAK
from ..functions.text import strip
from ..operators.lookup import literal_table


def catalogue_table(spark: SparkSession, labels) -> DataFrame:
    """(label_id, label) of a list held by the caller."""
    return literal_table(spark, list(enumerate(labels, 1)), "label_id int, label string")


def read_catalogue(spark: SparkSession, path: str, allow_empty: bool = False) -> DataFrame:
    """(label_id, label) of a text file with one label per line.

    Blank lines do not count; equal labels keep their own ids.  The ids are lines of one file, so a folder of several
    is refused.
    """
    whole = spark.read.text(path, wholetext=True)
    if len(whole.inputFiles()) > 1:
        raise ValueError(f"more than one file in {path}")
    lines = F.filter(F.transform(F.split("value", LINE_BREAK), strip), lambda x: x != "")
    table = whole.select(F.posexplode(lines).alias("_pos", "label")).select(
        (F.col("_pos") + 1).alias("label_id"), "label"
    )
    if not allow_empty and table.isEmpty():
        raise ValueError(f"no labels in {path}")
    return table
