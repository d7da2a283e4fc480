"""The memo: answers kept between runs, in buckets of their keys.

A memo is a folder.  ``layout`` in it holds a row per append and per compaction; the newest compaction names the folder
of the current data.  The data are parquet files that Spark knows as a table bucketed by key, so that a join by key
reads them where they lie, without shuffling them.  They are also partitioned by model, label limit and the first
digits of the key, so that a run with few new texts reads few folders.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

SCHEMA = "key string, model string, max_labels int, label_ids array<int>"
#: Buckets of a new memo, and digits of the key that name its folders.
BUCKETS = 8
PART_DIGITS = 1
#: Appends after which the files of a memo are merged.
COMPACT_AFTER = 16

_LAYOUT = "folder string, buckets int, digits int, generation int, number int"


def memo_table(spark: SparkSession) -> DataFrame:
    """An empty memo."""
    return spark.createDataFrame([], SCHEMA)


def _layout(spark: SparkSession, path: str) -> Row | None:
    """The current generation with ``appends``, how many there were to it; None where there is no memo."""
    try:
        rows = spark.read.schema(_LAYOUT).parquet(f"{path}/layout")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return (
        rows.groupBy("generation")
        .agg(
            F.min("folder").alias("folder"),
            F.min("buckets").alias("buckets"),
            F.min("digits").alias("digits"),
            F.count(F.when(F.col("number") > 0, F.lit(1))).alias("appends"),
        )
        .orderBy(F.desc("generation"))
        .head()
    )


def _note(spark: SparkSession, path: str, layout: Row | None, generation: int, number: int, **new) -> Row:
    values = {**(layout.asDict() if layout else {}), **new, "generation": generation, "number": number}
    row = Row(**{c.split()[0]: values[c.split()[0]] for c in _LAYOUT.split(", ")})
    spark.createDataFrame([row], _LAYOUT).coalesce(1).write.mode("append").parquet(f"{path}/layout")
    return row


def _open(spark: SparkSession, path: str, layout: Row) -> str:
    """The name under which this session's catalog knows the data."""
    location = f"{path.rstrip('/')}/{layout.folder}"
    # A folder without rows yet has to be there for its partitions to be looked up.
    folder = spark._jvm.org.apache.hadoop.fs.Path(location)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    name = f"issuescope_memo_{hashlib.md5(location.encode()).hexdigest()}"
    quoted = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (key STRING, label_ids ARRAY<INT>, model STRING, max_labels INT, part STRING) "
        f"USING parquet PARTITIONED BY (model, max_labels, part) "
        f"CLUSTERED BY (key) SORTED BY (key) INTO {layout.buckets} BUCKETS LOCATION '{quoted}'"
    )
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return name


def _part(layout: Row) -> Column:
    return F.substring("key", 1, layout.digits)


def read_memo(
    spark: SparkSession, path: str, model: str | None = None, max_labels: int | None = None, keys: DataFrame | None = None
) -> DataFrame:
    """(key, model, max_labels, label_ids) of the memo at ``path``; empty when nothing is there.

    ``model`` and ``max_labels`` read only what was answered so.  ``keys``, best a written table, has a column ``key``;
    then only the folders that may hold one of these keys are read.  Their names, of which there are at most 16 to the
    power of the digits, are looked up at once.
    """
    layout = _layout(spark, path)
    if layout is None:
        return memo_table(spark)
    memo = spark.table(_open(spark, path, layout))
    if model is not None:
        memo = memo.filter(F.col("model") == model)
    if max_labels is not None:
        memo = memo.filter(F.col("max_labels") == max_labels)
    if keys is not None:
        parts = [r.part for r in keys.select(_part(layout).alias("part")).distinct().collect()]
        memo = memo.filter(F.col("part").isin(parts))
    return memo.select("key", "model", "max_labels", "label_ids")


def _write(rows: DataFrame, path: str, layout: Row) -> None:
    """Append rows, each bucket of a part by one task, so that a folder gets one file per bucket at most."""
    spark = rows.sparkSession
    bucket = F.pmod(F.hash("key"), F.lit(layout.buckets))
    dealt = rows.withColumn("part", _part(layout)).repartition("part", bucket)
    dealt.select("key", "label_ids", "model", "max_labels", "part").write.insertInto(_open(spark, path, layout))


def append_memo(
    new: DataFrame,
    path: str,
    known: DataFrame | None = None,
    buckets: int = BUCKETS,
    digits: int = PART_DIGITS,
    compact_after: int = COMPACT_AFTER,
) -> None:
    """Add answers to the memo.  Pass ``known`` when ``new`` may repeat keys that are there already.

    ``buckets`` and ``digits`` shape a memo that does not exist yet.  After ``compact_after`` appends the files are merged;
    see ``compact_memo``.  One job at a time may write to a memo.
    """
    spark = new.sparkSession
    if known is not None:
        new = new.join(known, ["key", "model", "max_labels"], "left_anti")
    layout = _layout(spark, path)
    if layout is None:
        _note(spark, path, None, 0, 0, folder=f"data-{uuid.uuid4().hex}", buckets=buckets, digits=digits)
        layout = _layout(spark, path)
    _write(new.select("key", "label_ids", "model", "max_labels"), path, layout)
    _note(spark, path, layout, layout.generation, layout.appends + 1)
    if layout.appends + 1 >= compact_after:
        compact_memo(spark, path)


def compact_memo(spark: SparkSession, path: str) -> str | None:
    """Merge the memo's files into one per folder and bucket, one row per key, model and limit; of several the least.

    The merged data become current when they are complete.  The former folder stays for jobs that still read it, and its
    path is returned; delete it when they have ended.
    """
    layout = _layout(spark, path)
    if layout is None:
        return None
    merged = read_memo(spark, path).groupBy("key", "model", "max_labels").agg(F.min("label_ids").alias("label_ids"))
    fresh = Row(**{**layout.asDict(), "folder": f"data-{uuid.uuid4().hex}"})
    _write(merged, path, fresh)
    _note(spark, path, fresh, layout.generation + 1, 0)
    return f"{path.rstrip('/')}/{layout.folder}"
