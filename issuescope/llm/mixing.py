"""Mixing sources to target weights along a curriculum whose weights change over time.

All of it is DataFrame code: sums, windows over buckets, joins and one range sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookup import columns_of, free_name
from ..session import stage_table
from .common import WORD_PATTERN, lanes

WEIGHTS = (5.0, 2.0, 1.0)
#: Weight at the end of training by weight at its start, per entry of WEIGHTS; it changes evenly over time.
TRENDS = (0.5, 1.0, 2.0)
BUDGET = 1.5
MOST_REPEATS = 2
#: Hex digits of a document's order key that name its bucket: 4,096 buckets per source carry the running sums, so that
#: a source with a third of all rows is summed in as many tasks as there are.
_BUCKET_DIGITS = 3


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], budget: float, most: int) -> DataFrame:
    """source_key, source_size, target, trend for a table of (source, size).

    Sources are ranked by code point, null last, and weigh ``weights`` in turn.  Ordered by how soon they
    reach ``most`` times their size, the sources that stop there come first; the rest share what is left by weight.
    One row per source enters the two unpartitioned windows, nothing else.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1

    def turn(values: Sequence[float]) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (rank % len(values) + 1).cast("int"))

    weighed = totals.select(
        "source", "source_size", turn(weights).alias("weight"), turn(TRENDS).alias("trend"), rank.alias("rank")
    ).withColumn("most", F.col("source_size") * most)
    by_stop = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(budget) * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levelled = weighed.withColumn("level", left / weight_left)
    stops = F.col("most") <= F.col("weight") * F.col("level")
    # The level of the first source that does not stop holds for all after it.
    level = F.min(F.when(~stops, F.struct("rank_by_stop", "level"))).over(everything).getField("level")
    placed = levelled.withColumn("rank_by_stop", F.row_number().over(by_stop))
    target = F.when(stops, F.col("most").cast("double")).otherwise(F.col("weight") * level)
    return placed.select(_source_key().alias("source_key"), "source_size", target.alias("target"), "trend")


def _source_key() -> Column:
    """A name that joins like any other, for null too."""
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))


def demand_position(share: Column, trend: Column) -> Column:
    """The time in [0, 1] at which a source has met ``share`` of its demand.

    Its weight goes evenly from 1 to ``trend``; by time t it has met (t + (trend - 1) t^2 / 2) / ((1 + trend) / 2) of
    its demand, and this is the inverse.
    """
    area = (trend + 1) / 2 * share
    slope = (trend - 1) / 2
    return F.when(slope == 0, share).otherwise((F.sqrt(4 * slope * area + 1) - 1) / (2 * slope))


def plan_mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: int = MOST_REPEATS
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, size, source_size, target, taken, position, and what
    ``curriculum`` needs beside.

    A source's documents stand in the order of md5(doc_id).  It is gone through as often as its target asks, and the
    last pass stops at the word that meets the target, so that ``taken`` sums to the rounded target exactly.
    ``position`` is where in training, from 0 to 1, the document first stands; null if nothing of it is
    taken.  Null texts have no words, a null source is a source of its own, a null id is ordered like an empty one,
    rows that repeat an id count each.  Without any words all targets are 0.
    """
    sizes = stage_table(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count("text").alias("size"),
            F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("key"),
            F.xxhash64("text").alias("text_hash"),
        ),
        "sizes",
    )
    targets = source_targets(sizes, weights, budget, most)
    rows = sizes.select(
        "doc_id",
        "size",
        "key",
        "text_hash",
        _source_key().alias("source_key"),
        F.substring("key", 1, _BUCKET_DIGITS).alias("bucket"),
    )
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.groupBy("source_key", "bucket").agg(F.sum("size").alias("words"))
    over_buckets = before(Window.partitionBy("source_key").orderBy("bucket"))
    buckets = buckets.select(
        "source_key", "bucket", F.coalesce(F.sum("words").over(over_buckets), F.lit(0)).alias("bucket_start")
    ).join(targets, "source_key")
    buckets = stage_table(buckets, "buckets")
    within = before(Window.partitionBy("source_key", "bucket").orderBy("key", "doc_id", "size", "text_hash"))
    placed = rows.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0))).join(
        buckets, ["source_key", "bucket"]
    )
    want = F.round("target").cast("long")
    start = F.col("bucket_start") + F.col("within")
    passes = F.when(F.col("source_size") > 0, F.floor(want / F.col("source_size"))).otherwise(0).cast("long")
    rest = want - passes * F.col("source_size") - start
    taken = F.col("size") * passes + F.greatest(F.lit(0), F.least("size", rest))
    some = F.when(want > 0, want)  # null where nothing is wanted
    share = (start + F.col("size") / 2) / some
    return placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
        F.when(taken > 0, demand_position(F.least(F.lit(1.0), share), F.col("trend"))).alias("position"),
        # For the passes behind the first: where they stand follows from the same demand.
        (F.col("source_size") / some).alias("pass_share"),
        share.alias("share"),
        "trend",
        "text_hash",
        "source_key",
    )


def by_position(plan: DataFrame) -> DataFrame:
    """The plan in the order of training, range-sorted; what is not taken comes last."""
    order = [F.asc_nulls_last("position"), F.asc("doc_id")]
    return plan.repartitionByRange(lanes(plan.sparkSession), *order).sortWithinPartitions(*order)


def curriculum(docs: DataFrame, **settings) -> DataFrame:
    """The mixed documents with all their columns, once per time they are taken, sorted by training position.

    A document of which the last pass takes at least half is taken whole, else not at all, so the words of a source differ
    from its target by at most half a document.  Rows are matched with their plans by id, source and text, so that rows
    that repeat an id, and rows without one, each get their own plan; only rows that agree in all three share theirs,
    one by one.  Columns of any name are kept.  An empty table gives an empty one.
    """
    plan = stage_table(plan_mix(docs, **settings), "plan")
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    key, text, source, n, places, at = (free_name(docs, f"mix_{c}") for c in ("key", "text", "source", "n", "places", "at"))
    alike = Window.partitionBy(key, text, source)
    known = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    # Equal rows are numbered on both sides; of their plans the fullest goes to the first.
    turns = plan.select(
        known.alias(key), F.col("text_hash").alias(text), F.col("source_key").alias(source), times.alias(n), "share", "pass_share", "trend"
    ).withColumn(
        places,
        F.transform(
            F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)),
            lambda i: demand_position(F.least(F.lit(1.0), F.col("share") + i * F.col("pass_share")), F.col("trend")),
        ),
    )
    turns = turns.withColumn(n, F.row_number().over(alike.orderBy(F.desc(n), "share"))).filter(F.col(places).isNotNull())
    turns = turns.select(key, text, source, n, places)
    rows = docs.withColumns({key: known, text: F.xxhash64("text"), source: _source_key()})
    rows = rows.withColumn(n, F.row_number().over(alike.orderBy(key)))
    mixed = rows.join(turns, [key, text, source, n]).withColumn(at, F.explode(places))
    ordered = mixed.repartitionByRange(lanes(docs.sparkSession), at, key).sortWithinPartitions(at, key)
    return ordered.select(*columns_of(docs))
