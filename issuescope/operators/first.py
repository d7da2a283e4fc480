"""First rows, first values and ranks in row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lookup import free_name, quoted

_BUCKET_BITS = 20
_CUT_IN_TASK = 1000


def dedup_first(df: DataFrame, key: str, row_id: str = "row_id", nulls: str = "collapse") -> DataFrame:
    """One row per ``key``: the first in row order.  ``row_id`` tells rows apart.

    Null keys count as equal and collapse to one row; ``nulls="keep"`` keeps all of them.  The first row numbers come
    from a hash aggregate of keys and numbers, which merges copies inside each task; the rows behind them are
    fetched by number, so that no whole row is ever sorted and a key with very many copies costs no more than others.
    """
    if nulls not in ("collapse", "keep"):
        raise ValueError("nulls must be 'collapse' or 'keep'")
    keyed = df if nulls == "collapse" else df.filter(quoted(key).isNotNull())
    name = free_name(df, "first_row_id")
    first = keyed.groupBy(quoted(key)).agg(F.min(quoted(row_id)).alias(name)).select(name)
    rows = keyed.join(first.hint("shuffle_hash"), quoted(row_id) == F.col(name), "left_semi")
    if nulls == "keep":
        rows = rows.unionAll(df.filter(quoted(key).isNull()))
    return rows


def first_n_per_key(
    df: DataFrame, key: str, order: str, n: int, position: str = "position", two_rounds: bool = True
) -> DataFrame:
    """The ``n`` rows with the smallest ``order`` value of every key, numbered in ``position``.

    A round over (key, lane) comes first, where the lane is a hash of the order value, so that no task of the second
    round sees more than ``n`` rows per lane of a key, whatever ``n`` is.  Up to Spark's limit for it (1,000) the
    filter on ``row_number`` also lets each task cut its own rows before the shuffle; where that is enough, as behind an
    aggregation, the first round can be left out.
    """
    near = df
    if two_rounds or n > _CUT_IN_TASK:
        lanes = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        by_lane = Window.partitionBy(key, "_lane").orderBy(order)
        near = (
            df.withColumn("_lane", F.pmod(F.xxhash64(order), F.lit(lanes)))
            .withColumn(position, F.row_number().over(by_lane))
            .filter(F.col(position) <= n)
            .drop(position, "_lane")
        )
    by_key = Window.partitionBy(key).orderBy(order)
    return near.withColumn(position, F.row_number().over(by_key)).filter(F.col(position) <= n)


def value_profile(
    df: DataFrame, label: str, columns: Sequence[str] = (), row_id: str = "row_id", usable: Column | None = None
) -> DataFrame:
    """One row per label and combination of ``columns``: row counts, first row, first usable row.

    Everything asked per label later (counts, first values) is an aggregate of this small table, so the data is
    aggregated once, by hash and before the shuffle, and a hot label costs no more than a rare one.
    """
    usable = F.lit(True) if usable is None else usable
    return df.groupBy(label, *columns).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(usable, F.lit(1))).alias("usable_rows"),
        F.min(row_id).alias("first_row_id"),
        F.min(F.when(usable, F.col(row_id))).alias("first_usable_row_id"),
    )


def first_non_null_of(column: str, order: str = "first_usable_row_id") -> Column:
    """Aggregate over a profile: the first value that is not null, in row order."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.col(order)))


def first_row_value_of(column: str, order: str = "first_usable_row_id") -> Column:
    """Aggregate over a profile: the value of the first row, null if that row has none."""
    return F.min_by(F.struct(F.col(column).alias("value")), F.col(order)).getField("value")


def first_non_null(
    df: DataFrame, label: str, column: str, row_id: str = "row_id", usable: Column | None = None
) -> DataFrame:
    """Per label with a usable row: the first value of ``column`` that is not null."""
    profile = value_profile(df, label, [column], row_id, usable).filter("first_usable_row_id IS NOT NULL")
    return profile.groupBy(label).agg(first_non_null_of(column).alias(column))


def first_row_value(
    df: DataFrame, label: str, column: str, row_id: str = "row_id", usable: Column | None = None
) -> DataFrame:
    """Per label with a usable row: the value of ``column`` in the first such row, which may be null."""
    profile = value_profile(df, label, [column], row_id, usable).filter("first_usable_row_id IS NOT NULL")
    return profile.groupBy(label).agg(first_row_value_of(column).alias(column))


def with_rank(
    df: DataFrame, count: str = "count", first: str = "first_row_id", label: str = "label", rank: str = "rank"
) -> DataFrame:
    """Number the rows of a count table: count descending, then first row, then label.

    A global ``row_number`` would pass the whole table through one task, which is too much if labels are free
    text.  Rows are numbered within (count, block of first rows) instead.  A bucket starts after all smaller blocks of
    its count, summed per count, and after all higher counts.  Only one row per distinct count, of which n rows
    have fewer than the square root of 2 n, meets in one task.
    """
    bucketed = df.withColumn("_bucket", F.shiftright(F.col(first), _BUCKET_BITS))
    sizes = bucketed.groupBy(count, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    unbounded = Window.unboundedPreceding
    higher = Window.orderBy(F.desc(count)).rowsBetween(unbounded, -1)
    above = sizes.groupBy(count).agg(F.sum("_size").alias("_size"))
    above = above.select(count, F.coalesce(F.sum("_size").over(higher), F.lit(0)).alias("_above"))
    smaller = Window.partitionBy(count).orderBy("_bucket").rowsBetween(unbounded, -1)
    starts = (
        sizes.withColumn("_before", F.coalesce(F.sum("_size").over(smaller), F.lit(0)))
        .join(above, count)
        .select(count, "_bucket", (F.col("_before") + F.col("_above")).alias("_start"))
    )
    within = Window.partitionBy(count, "_bucket").orderBy(first, label)
    return (
        bucketed.join(starts, [count, "_bucket"])
        .withColumn(rank, F.col("_start") + F.row_number().over(within))
        .drop("_bucket", "_start")
    )
