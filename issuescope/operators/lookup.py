"""Lookups whose sides may be small or large, even or skewed."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_KEYS = 10_000
HOT_ROWS = 100_000
LANES = 64
#: Lanes of ``dealt_lookup``, which repeats its answers in all of them.
DEALT = 32

_ARROW_TYPES = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}


def quoted(name: str) -> Column:
    """A column by its exact name, which may hold dots and blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns_of(df: DataFrame) -> list[Column]:
    return [quoted(c) for c in df.columns]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until the table has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def literal_table(spark: SparkSession, rows, columns: str) -> DataFrame:
    """A few driver-side rows as a table whose size the optimizer knows, so it can choose a broadcast itself."""
    rows = list(rows)
    names = [c.split()[0] for c in columns.split(",")]
    types = [_ARROW_TYPES[c.split()[1]] for c in columns.split(",")]
    values = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    table = pa.table({n: pa.array(v, t) for n, v, t in zip(names, values, types, strict=True)})
    return spark.createDataFrame(table, schema=columns)


def hot_keys(counts: DataFrame, key: str, count: str, min_rows: int) -> DataFrame:
    """The keys that hold the most rows; at most ``HOT_KEYS`` of them, so their hashes may be broadcast.

    Which keys are in the list changes only how a join is spread, never what it returns.  A key behind them holds
    less than one row in ``HOT_KEYS``.
    """
    return counts.filter(F.col(count) >= min_rows).orderBy(F.desc(count), F.xxhash64(key)).limit(HOT_KEYS)


def spread_lookup(
    df: DataFrame, answers: DataFrame, key: str, row_id: str, count: str, min_rows: int
) -> DataFrame:
    """Left join of ``df`` with one answer row per key, with the rows of hot keys dealt to lanes.

    A key with a third of all rows would otherwise fill a single task.  The hashes of the hottest keys, 8 bytes each
    however long the keys are, are broadcast; their rows are dealt to ``LANES`` lanes by ``row_id`` and their
    answers repeated in each.  Rows without a key are dealt out too and match nothing.  Keys are shuffled as hashes and
    compared in full.
    """
    values = [c for c in answers.columns if c not in (key, count)]
    hot = hot_keys(answers, key, count, min_rows).select(F.xxhash64(key).alias("_hash"), F.lit(True).alias("_hot"))
    hot = F.broadcast(hot.distinct())
    known = F.col(key).isNotNull()
    keyed = df.withColumn("_hash", F.when(known, F.xxhash64(key)).otherwise(F.xxhash64(F.lit("no key"), row_id)))
    lane = F.when(F.col("_hot"), F.pmod(F.xxhash64(F.lit("lane"), row_id), F.lit(LANES))).otherwise(F.lit(0))
    keyed = keyed.join(hot, "_hash", "left").withColumn("_lane", F.when(known, lane).otherwise(F.lit(-1)))
    side = answers.select(F.xxhash64(key).alias("_hash"), F.col(key).alias("_found"), F.struct(*values).alias("_answer"))
    lanes = F.when(F.col("_hot"), F.expr(f"sequence(0L, {LANES - 1}L)")).otherwise(F.expr("array(0L)"))
    side = side.join(hot, "_hash", "left").withColumn("_lane", F.explode(lanes))
    side = side.select(F.col("_hash").alias("_side_hash"), F.col("_lane").alias("_side_lane"), "_found", "_answer")
    same = (F.col("_hash") == F.col("_side_hash")) & (F.col("_lane") == F.col("_side_lane"))
    joined = keyed.join(side, same & (F.col(key) == F.col("_found")), "left")
    return joined.select(*columns_of(df), *[F.col("_answer").getField(v).alias(v) for v in values])


def dealt_lookup(df: DataFrame, answers: DataFrame, key: Column, output: str) -> DataFrame:
    """``df`` with the answer to ``key`` as its last column; null for keys without one and for null keys.

    ``answers`` has two columns, key and answer, and one row per key.  It is repeated in ``DEALT`` lanes and rows are dealt
    to these as they come, so that a key with a third of all rows is not joined in one task and nothing has to be
    counted first.  A table that is small even so is broadcast by the optimizer, and no row is shuffled; of a larger
    one ``DEALT`` copies are shuffled, which is little beside the rows that look it up.
    """
    name, answer = answers.columns
    lane, found = free_name(df, "dealt_lane"), free_name(df, "dealt_answer")
    lanes = F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1)))
    side = answers.filter(quoted(name).isNotNull()).select(quoted(name).alias("key"), quoted(answer).alias("answer"), lanes.alias("lane"))
    side = side.select(F.struct("key", "answer", "lane").alias(found))
    dealt = df.withColumn(lane, F.pmod(F.monotonically_increasing_id(), F.lit(DEALT)).cast("int"))
    joined = dealt.join(side, (key == F.col(found)["key"]) & (F.col(lane) == F.col(found)["lane"]), "left")
    return joined.select(*[quoted(c) for c in df.columns if c != output], F.col(found)["answer"].alias(output))


def lookup_or_self(df: DataFrame, pairs: DataFrame, column: str, output: str) -> DataFrame:
    """Replace a value by its display form; values without one stay as they are.

    ``pairs`` has two columns: value and display form, one row per value.
    """
    value, display = pairs.columns
    side = pairs.select(F.col(value).alias("_value"), F.col(display).alias("_display"))
    joined = df.join(side, F.col(column) == F.col("_value"), "left")
    return joined.withColumn(output, F.coalesce("_display", column)).drop("_value", "_display")
