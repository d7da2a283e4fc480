"""Near-duplicate documents: MinHash signatures, an inverted join of their coordinates, exact confirmation.

How a link is found, without ever listing all pairs of a group:

1. Every text becomes its set of 5-word shingles (64-bit hashes), a 128-bit key of the whole set and a signature of
   ``COORDINATES`` minima.  Equal sets form one class; only its smallest id goes on.
2. A class posts itself under (coordinate, value) pairs.  Two sets with enough equal coordinates (``least_matches`` of
   the threshold) must share one of the first ``COORDINATES - matches + 1`` pairs of any order that all documents keep,
   so only this prefix is posted; the rest are skipped and looked up in the signature when a posting list is merged.
   The order puts frequent values last, so that a passage in very many documents posts nothing.
3. Posting lists of equal membership are merged once.  Lists are cut into tiles of at most two chunks, in which
   collisions are counted; a tile returns a spanning forest of the pairs with enough collisions.
4. The components of that forest are the only places where links can be.  Their documents' sets are computed again
   from the whole text and compared exactly, in tiles bounded by documents and by shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .common import (
    column_numpy,
    connected_components,
    group_starts,
    lanes,
    map_batches,
    mix64,
    roots,
    whole_groups,
)

SHINGLE_WORDS = 5
COORDINATES = 64
#: Of the pairs whose similarity is just the threshold, at most this share may have too few equal coordinates.
MISSED = 1e-6
#: The order of postings knows this many of the most frequent values by their counts.  It decides how long posting
#: lists get, never what is found.
FREQUENT_VALUES = 65_536
LIST_CHUNK = 1024
SET_CHUNK = 256
SET_CHUNK_SHINGLES = 500_000
BLOOM_BITS = 1 << 27
WORD_CACHE = 200_000

_MULTIPLIERS = mix64(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class _WordHashes(dict):
    """Word -> 64-bit hash, kept for the words seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes | None, hashes: dict) -> np.ndarray:
    """The distinct 5-word shingles of a text as sorted 64-bit hashes; a shorter text is one shingle."""
    words = text.lower().split() if text else ()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    size = min(n, SHINGLE_WORDS)
    h = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + w[i : n - size + 1 + i])
    return np.unique(h)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minimum of every coordinate's hash over a set, 32 bits each."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 1024):
        part = shingles[start : start + 1024, None] * _MULTIPLIERS
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def least_matches(percent: int) -> int:
    """Coordinates that must agree: as many as pairs of this similarity have but for a share of ``MISSED``.

    Equal coordinates of a pair are binomial.  At 0.8 this asks for 34 (3.2e-7 of such pairs have fewer), at 0.85
    for 39 (6.3e-7); pairs of more than the threshold have too few less often.
    """
    p, fewer = percent / 100, 0.0
    for matches in range(COORDINATES):
        fewer += comb(COORDINATES, matches) * p**matches * (1 - p) ** (COORDINATES - matches)
        if fewer > MISSED:
            return matches
    return COORDINATES


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    with np.errstate(over="ignore"):
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [])
            for text in batch.column("text").cast(pa.binary()):
                s = shingle_set(text.as_py(), hashes)
                rows[0].append(len(s))
                rows[1].append(int(np.add.reduce(mix64(s + np.uint64(1))).astype(np.int64)))
                rows[2].append(int(np.add.reduce(mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))).astype(np.int64)))
                rows[3].append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(rows[0], pa.int64()),
                    pa.array(rows[1], pa.int64()),
                    pa.array(rows[2], pa.int64()),
                    pa.array(rows[3], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "h1", "h2", "sig"],
            )


def _signatures(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _items(sigs: np.ndarray) -> np.ndarray:
    """(coordinate, value) pairs as one number each."""
    return (np.arange(COORDINATES, dtype=np.int64) << 32) | sigs.astype(np.int64)


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        often = counts >= 8
        return pa.RecordBatch.from_arrays([pa.array(values[often]), pa.array(counts[often])], names=["item", "n"])

    held: list[np.ndarray] = []
    for batch in batches:
        if batch.num_rows:
            held.append(_items(_signatures(batch)).ravel())
        if sum(map(len, held)) >= 2_000_000:
            yield counted(held)
            held = []
    if held:
        yield counted(held)


def _postings(frequent: np.ndarray, counts: np.ndarray, matches: int):
    """A function that posts every document under the prefix of its (coordinate, value) pairs."""
    prefix = COORDINATES - matches + 1

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            items = _items(_signatures(batch))
            with np.errstate(over="ignore"):
                key = mix64(items.view(np.uint64)) >> np.uint64(24)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, items), len(frequent) - 1)
                rank = np.where(frequent[at] == items, np.minimum(counts[at], (1 << 23) - 1), 0)
                key |= rank.astype(np.uint64) << np.uint64(40)
            chosen = np.argpartition(key, prefix - 1, axis=1)[:, :prefix]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.take_along_axis(items, chosen, 1).ravel()),
                    pa.array(np.repeat(column_numpy(batch, "doc_id"), prefix)),
                ],
                names=["item", "doc"],
            )

    return post


def _merge_lists(matches: int):
    """Spanning forests of the pairs of a tile whose signatures agree often enough."""
    keys = ["item", "ti", "tj"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            sigs, docs = _signatures(table), column_numpy(table, "doc")
            starts = group_starts(table, keys)
            ends = np.append(starts[1:], len(docs))
            left = np.repeat(ends, ends - starts) - np.arange(len(docs)) - 1  # rows of the same tile that follow
            found = []
            at = np.flatnonzero(left >= 1)
            lag = 1
            while len(at):
                for part in range(0, len(at), 65_536):
                    i = at[part : part + 65_536]
                    i = i[(sigs[i] == sigs[i + lag]).sum(axis=1, dtype=np.uint8) >= matches]
                    if len(i):
                        found.append(np.stack([i, i + lag]).astype(np.int32))
                lag += 1
                at = at[left[at] >= lag]
            if found:
                pairs = np.concatenate(found, axis=1)
                root = roots(len(docs), pairs[0], pairs[1])
                child = np.flatnonzero(root != np.arange(len(docs)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs[child]), pa.array(docs[root[child]])], names=["a", "b"]
                )

    return merge


def _tiled(df: DataFrame, group: str, chunks, doc: str) -> DataFrame:
    """Rows of a group, once for each tile they take part in."""
    split = df.withColumn("_chunks", F.greatest(F.lit(1), F.ceil(chunks)).cast("int"))
    split = split.withColumn("_chunk", F.pmod(F.xxhash64(doc), F.col("_chunks")).cast("int"))
    split = split.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    split = split.withColumns({"ti": F.least("_chunk", "_other"), "tj": F.greatest("_chunk", "_other")})
    split = split.drop("_chunks", "_chunk", "_other")
    return split.repartition(lanes(df.sparkSession), group, "ti", "tj").sortWithinPartitions(group, "ti", "tj")


def _bloom(ids: DataFrame, column: str) -> tuple[np.ndarray, int]:
    """A Bloom filter of ids with two probes, of at most ``BLOOM_BITS`` bits whatever their number."""
    n = ids.count()
    bits = min(BLOOM_BITS, max(1 << 16, 1 << (16 * n).bit_length()))
    probes = ids.select(
        F.explode(F.array(*[F.pmod(F.xxhash64(F.lit(seed), column), F.lit(bits)) for seed in (1, 2)])).alias("bit")
    )
    words = probes.groupBy(F.shiftright("bit", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")
    )
    filled = words.toPandas()
    table = np.zeros(bits // 64, np.int64)
    table[filled["word"].to_numpy()] = filled["mask"].to_numpy()
    return table, bits


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    with np.errstate(over="ignore"):
        for batch in batches:
            sets = [shingle_set(t.as_py(), hashes).tobytes() for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sets, pa.binary())], names=["doc_id", "shingles"]
            )


def exact_links(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets with 100 * intersection >= percent * union, by one pass over the tile per set."""
    sizes = np.array([len(s) for s in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    mark = np.zeros(ids.max(initial=0) + 1, np.int32)
    left, right = [], []
    for i in range(len(sets) - 1):
        own = ids[starts[i] : starts[i] + sizes[i]]
        mark[own] = 1
        after = starts[i + 1]
        shared = np.add.reduceat(mark[ids[after:]], starts[i + 1 :] - after)
        mark[own] = 0
        j = np.flatnonzero(100 * shared >= percent * (sizes[i] + sizes[i + 1 :] - shared))
        left.append(np.full(len(j), i))
        right.append(j + i + 1)
    if not left:
        return np.empty(0, int), np.empty(0, int)
    return np.concatenate(left), np.concatenate(right)


def _confirm(percent: int):
    keys = ["cluster", "ti", "tj"]

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys, limit=64):
            docs = column_numpy(table, "doc_id")
            raw = table.column("shingles").to_pylist()
            starts = group_starts(table, keys)
            a, b = [], []
            for start, end in zip(starts, np.append(starts[1:], len(docs)), strict=True):
                if end - start < 2:
                    continue
                left, right = exact_links([np.frombuffer(r, np.uint64) for r in raw[start:end]], percent)
                root = roots(end - start, left, right)
                child = np.flatnonzero(root != np.arange(end - start))
                a.append(docs[start + child])
                b.append(docs[start + root[child]])
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"]
                )

    return confirm


def minhash_components(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * shared shingles >= ``percent`` * all shingles of both; ``component_id`` is the
    smallest id that links lead to.  A link just at the threshold is missed at a rate of at most ``MISSED``.  Texts that are null or hold no word have no shingle and link with nothing.
    Rows that repeat an id count as one document; if their texts differ, it has the links of all of them.  A row
    without an id is returned with a null component and is not kept.  Other columns are not read.
    """
    matches = least_matches(percent)
    if percent < 80:
        raise ValueError(f"the filter is sized for similarities of 0.8 and more, where it misses at most {MISSED:g} of the pairs")
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = stage_table(
        map_batches(source, _sketch, "doc_id long, n_shingles long, h1 long, h2 long, sig binary"), "sketches"
    )
    usable = sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stage_table(usable.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep")), "classes")
    # A class is represented by the row of its smallest id.
    reps = usable.join(
        classes.select("h1", "h2", F.col("rep").alias("doc_id")), ["h1", "h2", "doc_id"], "left_semi"
    )
    reps = stage_table(reps.select("doc_id", "n_shingles", "sig").dropDuplicates(["doc_id", "sig"]), "classes")

    often = map_batches(reps.select("sig"), _frequent, "item long, n long").groupBy("item").agg(F.sum("n").alias("n"))
    often = often.orderBy(F.desc("n"), "item").limit(FREQUENT_VALUES).toPandas().sort_values("item")
    post = _postings(often["item"].to_numpy(np.int64), often["n"].to_numpy(np.int64), matches)
    postings = stage_table(map_batches(reps.select("doc_id", "sig"), post, "item long, doc long"), "postings")
    lists = postings.groupBy("item").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("doc").alias("lo"),
        F.max("doc").alias("hi"),
        F.expr("bit_xor(xxhash64(doc))").alias("members"),
    )
    # Lists with the same members would find the same pairs.
    lists = lists.filter("n > 1").groupBy("n", "lo", "hi", "members").agg(F.min("item").alias("item"))
    lists = stage_table(lists.select("item", "n"), "lists")
    active = postings.join(lists, "item").join(reps.select(F.col("doc_id").alias("doc"), "sig"), "doc")
    merged = map_batches(
        _tiled(active, "item", F.col("n") / LIST_CHUNK, "doc").select("item", "ti", "tj", "doc", "sig"),
        _merge_lists(matches),
        "a long, b long",
    )
    clusters = stage_table(connected_components(merged), "clusters")
    member = clusters.select(F.col("node").alias("doc_id"), F.col("root").alias("cluster"))
    sized = member.join(reps.select("doc_id", "n_shingles"), "doc_id")
    sizes = stage_table(
        sized.groupBy("cluster").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_shingles").alias("total")), "clusters"
    )
    table, bits = _bloom(member.select("doc_id"), "doc_id")
    maybe = source.filter("doc_id IS NOT NULL").withColumns(
        {f"_p{seed}": F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(bits)) for seed in (1, 2)}
    )

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def kept():
            for batch in batches:
                hit = np.ones(batch.num_rows, bool)
                for seed in (1, 2):
                    p = column_numpy(batch, f"_p{seed}")
                    hit &= (table[p >> 6] >> (p & 63)) & 1 == 1
                yield batch.filter(pa.array(hit))

        return _sets(kept())

    sets = map_batches(maybe, candidates, "doc_id long, shingles binary")
    placed = sets.join(member.join(sizes, "cluster"), "doc_id").filter("length(shingles) > 0")
    chunks = F.greatest(F.col("docs") / SET_CHUNK, F.col("total") / SET_CHUNK_SHINGLES)
    tiles = _tiled(placed, "cluster", chunks, "doc_id").select("cluster", "ti", "tj", "doc_id", "shingles")
    links = map_batches(tiles, _confirm(percent), "a long, b long")
    # An id with several texts joins the classes of all of them.
    several = usable.groupBy("doc_id").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("h1", "h2") for f in (F.min, F.max)])
    several = several.filter("min_h1 <> max_h1 OR min_h2 <> max_h2").select("doc_id")
    same = usable.join(several, "doc_id", "left_semi").join(classes, ["h1", "h2"])
    links = links.unionByName(same.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    found = stage_table(connected_components(links), "components")

    rows = sketched.join(classes, ["h1", "h2"], "left")
    joined = rows.join(found.select(F.col("node").alias("rep"), "root"), "rep", "left")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    component = F.when(linked, F.coalesce("root", "rep", "doc_id")).otherwise(F.col("doc_id"))
    result = joined.select("doc_id", "n_shingles", component.alias("component_id"))
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
