"""Near-duplicate vectors: int8 tile products with error bounds, full precision only where these leave a doubt."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .common import column_numpy, connected_components, map_batches, roots

#: Vectors of a chunk; a task holds two chunks.
CHUNK = 16_384
#: Smaller tables still get this many chunks, so that there are tiles enough for many cores.
LEAST_CHUNKS = 8
_STRIP = 512
_PAIRS = 16_384


def vector_rows(column: pa.Array) -> list[np.ndarray | None]:
    """List vectors as doubles; null for those that are null, empty or hold null or non-finite components."""
    rows: list[np.ndarray | None] = []
    for value in column:
        row = np.asarray(value.values.to_numpy(zero_copy_only=False), np.float64) if value.is_valid else None
        rows.append(row if row is not None and len(row) and np.isfinite(row).all() else None)
    return rows


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: tuple[list, ...] = ([], [], [])
        for row in vector_rows(batch.column("embedding")):
            usable = row is not None and np.any(row)
            if usable:
                row = row + 0.0  # one zero only
                key = xxhash.xxh3_128_digest(row.tobytes())
                row = row / np.abs(row).max()  # no overflow or underflow in the norm
                row = row / math.sqrt(float(row @ row))
            out[0].append(int.from_bytes(key[:8], "little", signed=True) if usable else None)
            out[1].append(int.from_bytes(key[8:], "little", signed=True) if usable else None)
            out[2].append(row.tobytes() if usable else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
            names=["vec_id", "h1", "h2", "unit"],
        )


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale and length of the rounding error of every row."""
    scale = np.abs(units).max(axis=1) / 127.0
    codes = np.rint(units / scale[:, None]).astype(np.int8)
    error = np.sqrt(((units - codes * scale[:, None]) ** 2).sum(axis=1)) + 1e-12
    return codes, scale, error


def linked_pairs(units: np.ndarray, others: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with cosine >= threshold, strip by strip.

    With x = s q + e, the product of two rows differs from that of their codes by at most
    |e| |s' q'| + |e'| |s q| + |e| |e'| <= (1 + |e|)|e'| + (1 + |e'|)|e| + |e||e'|.  Sums of int8 products are
    exact in single precision up to 1,040 dimensions; wider rows are summed in double precision.  Pairs that the bound
    proves to be below are dropped; the rest are computed in double precision.
    """
    codes, scale, error = quantise(units)
    other_codes, other_scale, other_error = quantise(others)
    kind = np.float32 if units.shape[1] * 127 * 127 < 1 << 24 else np.float64
    right = np.ascontiguousarray(other_codes.T, kind)
    most, widest = float(other_error.max()), float(other_scale.max())
    for start in range(0, len(units), _STRIP):
        strip = slice(start, start + _STRIP)
        product = codes[strip].astype(kind) @ right
        e = float(error[strip].max())
        slack = e + most + 3 * e * most
        # First a bound for the whole strip, then one for each pair.
        least = (threshold - slack) / (float(scale[strip].max()) * widest) if threshold > slack else -np.inf
        i, j = np.divmod(np.flatnonzero(product >= least), product.shape[1])
        e, f = error[start + i], other_error[j]
        near = product[i, j].astype(np.float64) * scale[start + i] * other_scale[j]
        i, j = (v[near + (e + f + 3 * e * f) >= threshold] for v in (i, j))
        for part in range(0, len(i), _PAIRS):
            a, b = start + i[part : part + _PAIRS], j[part : part + _PAIRS]
            hit = np.einsum("ij,ij->i", units[a], others[b]) >= threshold
            if hit.any():
                yield a[hit], b[hit]


def _tile(threshold: float):
    def tile(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, copies = column_numpy(table, "vec_id"), column_numpy(table, "copies")
        chunk = column_numpy(table, "chunk")
        ti, tj = int(table.column("ti")[0].as_py()), int(table.column("tj")[0].as_py())
        raw = table.column("unit").to_pylist()
        widths = np.array([len(r) for r in raw])
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for width in np.unique(widths):  # vectors of another length are no neighbours
            first = np.flatnonzero((chunk == ti) & (widths == width))
            second = np.flatnonzero((chunk == tj) & (widths == width))
            if not len(first) or not len(second):
                continue
            x = np.frombuffer(b"".join([raw[k] for k in first])).reshape(len(first), -1)
            y = x if ti == tj else np.frombuffer(b"".join([raw[k] for k in second])).reshape(len(second), -1)
            for i, j in linked_pairs(x, y, threshold):
                if ti == tj:
                    i, j = i[i < j], j[i < j]
                a, b = first[i], second[j]
                links += np.bincount(a, copies[b], len(ids)).astype(np.int64)
                links += np.bincount(b, copies[a], len(ids)).astype(np.int64)
                joined = roots(len(ids), root[a], root[b])
                root = joined[root]
        low = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(low, root, ids)
        some = links > 0
        return pa.table({"vec_id": ids[some], "links": links[some], "root": low[root[some]]})

    return tile


def vector_components(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Vectors are linked if their cosine, in double precision, reaches ``threshold``.  Vectors that are null, empty,
    all zero or hold null or non-finite components, and vectors of different lengths, link with nothing.  Equal vectors
    are compared once and counted as often as they occur.  A repeated id counts as a vector of its own in n_links.
    Rows without an id take no part and have a null component.  Every two chunks of distinct vectors meet in one
    task, which holds no more than these; a task returns counts and a spanning forest, never its pairs.
    """
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    prepared = stage_table(map_batches(source, _prepare, "vec_id long, h1 long, h2 long, unit binary"), "vectors")
    usable = prepared.filter("h1 IS NOT NULL AND vec_id IS NOT NULL")
    classes = stage_table(
        usable.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes"
    )
    distinct = usable.join(
        classes.select("h1", "h2", F.col("rep").alias("vec_id"), "copies"), ["h1", "h2", "vec_id"]
    ).dropDuplicates(["h1", "h2"])
    chunks = max(LEAST_CHUNKS, -(-classes.count() // CHUNK))
    tiled = (
        distinct.select("vec_id", "copies", "unit", F.pmod(F.xxhash64("h1"), F.lit(chunks)).cast("int").alias("chunk"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        .select("*", F.least("chunk", "_other").alias("ti"), F.greatest("chunk", "_other").alias("tj"))
        .drop("_other")
    )
    tiles = stage_table(
        tiled.groupBy("ti", "tj").applyInArrow(_tile(threshold), "vec_id long, links long, root long"), "tiles"
    )
    found = stage_table(connected_components(tiles.select(F.col("vec_id").alias("a"), F.col("root").alias("b"))), "roots")
    links = tiles.groupBy("vec_id").agg(F.sum("links").alias("links"))
    known = classes.join(links.withColumnRenamed("vec_id", "rep"), "rep", "left").join(
        found.select(F.col("node").alias("rep"), "root"), "rep", "left"
    )
    known = stage_table(
        known.select(
            "h1",
            "h2",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("component_id"),
        ),
        "classes",
    )
    joined = prepared.select("vec_id", "h1", "h2").join(known, ["h1", "h2"], "left")
    own = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return joined.select(
        "vec_id",
        F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"),
    )
