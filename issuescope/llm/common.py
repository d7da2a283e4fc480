"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_table

BATCH_ROWS = 512
BATCH_BYTES = 8 << 20

# A word: a run of bytes other than blank, tab, line feed, vertical tab, form feed, carriage return.
# ``bytes.split()`` cuts at exactly these, and ``bytes.lower()`` lowers exactly A-Z.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, so that a task's Python memory does not grow with its texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def lanes(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix64(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], limit: int = 4096) -> Iterator[pa.Table]:
    """Tables of about ``limit`` rows or more, made of whole groups of a stream sorted by ``keys``.

    Only what belongs to one group is ever waited for, so memory follows the largest group.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < limit:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        starts = group_starts(table, keys)
        cut = int(starts[-1])
        if cut:
            yield table.slice(0, cut)
            rest = table.slice(cut).combine_chunks()
            held, rows = rest.to_batches(), rest.num_rows
        limit = max(4096, 2 * rows)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """The first row of every group of a sorted table; key columns are integers without nulls."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        column = column_numpy(table, key)
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def column_numpy(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    column = table.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0)
    return column.to_numpy(zero_copy_only=False)


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index reachable from every one of ``n`` nodes over the links (left, right)."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        label = np.minimum(label, label[label])
        while (label != label[label]).any():
            label = label[label]
        if (label == before).all():
            break
        open_ = label[left] != label[right]
        left, right = left[open_], right[open_]
    return label


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the smallest node that can be reached.

    Large-star and small-star steps in turn.  Each round is written to the shared folder, so lineage stays short
    and a lost executor repeats one round's tasks only.  Joins are by shuffle on node ids, which adaptive
    execution may split; no neighbourhood is ever collected.
    """
    current = stage_table(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = None
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))
        )
        current = stage_table(small.filter("a <> b").distinct(), "edges")
        digest = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")
        ).head()
        # Every node but the roots points to one smaller node; nothing moved in this round.
        if tuple(digest) == seen:
            break
        seen = tuple(digest)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    children = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    parents = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return children.unionByName(parents)
