"""Packing documents into sequences of fixed length by a grouping genetic algorithm on islands."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .common import map_batches
from .tokens import encoded_texts

#: Pieces of a shard.  Every shard is packed by itself, which costs at most a part of one sequence each.
SHARD_PIECES = 8_192
ISLANDS = 2
POPULATION = 4
#: Generations, of as many children as the population has, after which an island without a better best rests.
PATIENCE = 10


def _cut(name: str, end_id: int, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        lane = 0
        for rows, encoded in encoded_texts(batches, name):
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for doc, of_text in zip(rows.column("doc_id").to_pylist(), encoded, strict=True):
                ids = of_text + end
                n = len(ids) // 4
                first = (n - 1) % capacity + 1  # the first piece takes what does not fill a sequence
                starts = [0, *range(first, n, capacity)]
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                    for column, value in zip(out, (doc, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), lane), strict=True):
                        column.append(value)
                lane += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), *[pa.int64()] * 4), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "lane"],
            )

    return cut


def best_fit(lengths: np.ndarray, order: np.ndarray, bins: np.ndarray, fills: list[int], capacity: int) -> None:
    """Place the items in ``order``, each in the fullest bin that can take it, or in a new one."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin with room r is listed
    for b, fill in enumerate(fills):
        if fill < capacity:
            by_room[capacity - fill].append(b)
            rooms |= 1 << (capacity - fill)
    for item in order.tolist():
        length = int(lengths[item])
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[item] = b
        fills[b] += length
        if room > length:
            by_room[room - length].append(b)
            rooms |= 1 << (room - length)


def cost(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins are better, then fuller ones."""
    fills = np.bincount(bins, lengths)
    return len(fills), -float(((fills / capacity) ** 2).mean())


def crossover(
    lengths: np.ndarray, one: np.ndarray, two: np.ndarray, capacity: int, rng: np.random.Generator
) -> np.ndarray:
    """Whole well-filled bins of ``two`` go into ``one``.

    Bins of ``one`` that share a document with them are dissolved, the worst filled third of the others too, and the
    documents that have no place then are best-fitted, roughly longest first; how roughly is drawn for every child.
    """
    fills_one, fills_two = np.bincount(one, lengths), np.bincount(two, lengths)
    full = np.flatnonzero(fills_two >= np.quantile(fills_two, 0.5))
    injected = np.zeros(len(fills_two), bool)
    injected[rng.choice(full, max(1, len(full) // 3), replace=False)] = True
    placed = injected[two]
    kept = np.ones(len(fills_one), bool)
    kept[one[placed]] = False
    rest = np.flatnonzero(kept)
    if len(rest):
        kept[rest[fills_one[rest] < np.quantile(fills_one[rest], 0.33)]] = False
    stays = kept[one] & ~placed
    bins = np.full(len(lengths), -1)
    new_two = np.cumsum(injected) - 1
    new_one = np.cumsum(kept) - 1 + int(injected.sum())
    bins[placed] = new_two[two[placed]]
    bins[stays] = new_one[one[stays]]
    fills = np.bincount(bins[bins >= 0], lengths[bins >= 0], int(injected.sum() + kept.sum())).astype(int).tolist()
    lost = np.flatnonzero(bins < 0)
    blur = lengths[lost] * rng.uniform(rng.uniform(0.5, 1.0), 1.0, len(lost))
    best_fit(lengths, lost[np.argsort(-blur, kind="stable")], bins, fills, capacity)
    return bins


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: for every a, items above capacity - a are alone, those above half are apart, and what
    of the items from a to half does not fit beside these needs bins of its own."""
    counts = np.bincount(lengths, minlength=capacity + 1)
    number = np.r_[np.cumsum(counts[::-1])[::-1], 0]  # items of at least so many tokens
    tokens = np.r_[np.cumsum((counts * np.arange(capacity + 1))[::-1])[::-1], 0]
    half = capacity // 2 + 1
    a = np.arange(half)
    middle, middle_tokens = number[half] - number[capacity - a + 1], tokens[half] - tokens[capacity - a + 1]
    beside = tokens[a] - tokens[half] - (middle * capacity - middle_tokens)
    return int((number[half] + np.maximum(0, -(-beside // capacity))).max())


def evolve(
    lengths: np.ndarray, population: list[np.ndarray], capacity: int, rng: np.random.Generator
) -> list[np.ndarray]:
    """The population once ``PATIENCE`` generations brought no fewer bins, best first.

    Every generation has ``POPULATION`` children; the best of all stay.  It stops as soon as no packing can be better.
    """
    least = least_bins(lengths, capacity)
    scored = sorted(((cost(lengths, p, capacity), i, p) for i, p in enumerate(population)), key=lambda x: x[:2])
    serial, waited = len(scored), 0
    while waited < PATIENCE and scored[0][0][0] > least and len(scored) > 1:
        best, children = scored[0][0][0], []
        for _ in range(POPULATION):
            one, two = rng.permutation(len(scored))[:2]
            child = crossover(lengths, scored[min(one, two)][2], scored[max(one, two)][2], capacity, rng)
            serial += 1
            children.append((cost(lengths, child, capacity), serial, child))
        scored = sorted([*scored, *children], key=lambda x: x[:2])[:POPULATION]
        waited = 0 if scored[0][0][0] < best else waited + 1
    return [p for _, _, p in scored]


def first_population(lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Best fit of the longest first, and of orders near to that."""
    least = least_bins(lengths, capacity)
    people = []
    for k in range(POPULATION):
        blur = lengths * rng.uniform(0.85, 1.0, len(lengths)) if k else lengths
        bins, fills = np.full(len(lengths), -1), []
        best_fit(lengths, np.argsort(-blur, kind="stable"), bins, fills, capacity)
        people.append(bins)
        if len(fills) <= least:
            break
    return people


def _lengths(histogram: bytes, capacity: int) -> np.ndarray:
    """The shard's lengths, longest first."""
    counts = np.frombuffer(histogram, "<i8")
    return np.repeat(np.arange(capacity - 1, -1, -1), counts[::-1])


_PLAN = "shard long, island int, place int, histogram binary, bins binary, n_bins long, fullness double, least long"


def _island_rows(shard, island, histogram, lengths, people, capacity) -> pa.Table:
    costs = [cost(lengths, p, capacity) for p in people]
    return pa.table(
        {
            "shard": pa.array([shard] * len(people), pa.int64()),
            "island": pa.array([island] * len(people), pa.int32()),
            "place": pa.array(range(len(people)), pa.int32()),
            "histogram": pa.array([histogram] * len(people), pa.binary()),
            "bins": pa.array([p.astype("<i4").tobytes() for p in people], pa.binary()),
            "n_bins": pa.array([c[0] for c in costs], pa.int64()),
            "fullness": pa.array([c[1] for c in costs], pa.float64()),
            "least": pa.array([least_bins(lengths, capacity)] * len(people), pa.int64()),
        }
    )


def _found(capacity: int):
    def found(table: pa.Table) -> pa.Table:
        shard, island = table.column("shard")[0].as_py(), table.column("island")[0].as_py()
        counts = np.zeros(capacity, "<i8")
        counts[table.column("length").to_numpy()] = table.column("pieces").to_numpy()
        lengths = _lengths(counts.tobytes(), capacity)
        rng = np.random.default_rng([shard, island])
        people = evolve(lengths, first_population(lengths, capacity, rng), capacity, rng)
        return _island_rows(shard, island, counts.tobytes(), lengths, people[:2], capacity)

    return found


def _again(capacity: int, epoch: int):
    """Another epoch, starting from what stayed on an island and the elite that arrived."""

    def again(table: pa.Table) -> pa.Table:
        shard, island = table.column("shard")[0].as_py(), table.column("island")[0].as_py()
        histogram = table.column("histogram")[0].as_py()
        lengths = _lengths(histogram, capacity)
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("n_bins", "fullness", "bins")), strict=True))
        people = [np.frombuffer(r[2], "<i4").astype(int) for r in rows]
        rng = np.random.default_rng([shard, island, epoch])
        return _island_rows(shard, island, histogram, lengths, evolve(lengths, people, capacity, rng)[:2], capacity)

    return again


def _place(capacity: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("piece", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids_crc32", pa.int64()),
            ("sequence_id", pa.int64()),
            ("offset", pa.int64()),
        ]
    )

    def place(items: pa.Table, plans: pa.Table) -> pa.Table:
        if not items.num_rows:
            return schema.empty_table()
        items = items.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        shard = items.column("shard")[0].as_py()
        bins = np.frombuffer(plans.column("bins")[0].as_py(), "<i4")
        lengths = items.column("length").to_numpy()
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.flatnonzero(np.r_[True, bins[order][1:] != bins[order][:-1]])
        offsets = np.empty(len(bins), np.int64)
        offsets[order] = before - np.repeat(before[first], np.diff(np.r_[first, len(bins)]))
        out = items.append_column("sequence_id", pa.array(2 * ((shard << 31) + bins.astype(np.int64)) + 1))
        return out.append_column("offset", pa.array(offsets)).select(schema.names).cast(schema)

    return place


def evolve_shards(counts: DataFrame, capacity: int) -> DataFrame:
    """(shard, bins, n_bins, least): the best packing found of every shard's lengths.

    ``counts`` has (shard, length, pieces).  ``bins`` holds the bin of every piece, longest first, as 32-bit integers.
    After every epoch each island's best moves to the next one; epochs go on until one brings no shard fewer bins or all
    shards have as few as can be.  One row, the sum over all shards, comes to the driver per epoch.
    """
    islands = counts.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])))
    plans = stage_table(islands.groupBy("shard", "island").applyInArrow(_found(capacity), _PLAN), "islands")
    total, epoch = None, 0
    while True:
        shards = plans.groupBy("shard").agg(F.min("n_bins").alias("n"), F.min("least").alias("least"))
        state = shards.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > F.col("least")).alias("open")).head()
        if not state.open or (total is not None and state.n >= total):
            break
        total, epoch = state.n, epoch + 1
        elite = plans.filter("place = 0").withColumn("island", ((F.col("island") + 1) % ISLANDS).cast("int"))
        moved = plans.unionByName(elite).groupBy("shard", "island")
        plans = stage_table(moved.applyInArrow(_again(capacity, epoch), _PLAN), "islands")
    best = F.min_by(F.struct("bins", "n_bins", "least"), F.struct("n_bins", "fullness", "island", "place"))
    return plans.groupBy("shard").agg(best.alias("best")).select("shard", "best.*")


def pack_documents(
    docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0, capacity: int = 2048
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its whole text (null: none) and ``end_id``.  Longer ones are cut into pieces of
    ``capacity`` ids, the first of which may be shorter.  Full pieces are sequences of their own.  The others are
    dealt evenly to shards of about ``SHARD_PIECES``; islands evolve packings of a shard's lengths, their elite
    moves to the next island between epochs (``evolve_shards``), and the best packing is filled with the shard's documents.  Only lengths
    and counts are shuffled, never ids.  Rows that repeat a document are packed as often as they occur; rows without
    an id are packed too.  An empty table gives no rows.  The same files always give the same sequences.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = map_batches(
        source,
        _cut(tokenizer, end_id, capacity),
        "doc_id long, piece int, start long, length long, ids_crc32 long, lane long",
    )
    pieces = stage_table(cut, "pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = pieces.filter(F.col("length") == capacity).select(
        *columns, (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    short = pieces.filter(F.col("length") < capacity)
    shards = max(1, -(-short.count() // SHARD_PIECES))
    dealt = short.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "lane"), F.lit(shards)))
    counts = dealt.groupBy("shard", "length").agg(F.count(F.lit(1)).alias("pieces"))
    best = evolve_shards(counts, capacity).select("shard", "bins")
    placed = dealt.groupBy("shard").cogroup(best.groupBy("shard")).applyInArrow(
        _place(capacity),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
    return full.unionByName(placed)
