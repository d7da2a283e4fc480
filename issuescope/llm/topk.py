"""Exact top-k inner products from an impact-ordered index, score at a time, for many queries at once."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import nsmallest
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .common import column_numpy, map_batches

#: Rows and components of one index block, and rows of the least block that a table is cut into for the sake of more
#: tasks.
BLOCK_ROWS, BLOCK_VALUES, LEAST_ROWS = 131_072, 1 << 23, 8_192
#: Blocks for every core where the rows are enough, and lanes in which what blocks found is merged first.
TASKS, LANES = 4, 16
#: Tables of more full blocks than this find scores to pass in a share of their rows before the others are searched.
ROUNDS_FROM, FIRST_SHARE = 8, 16
#: Rows of a block are scored by so many, falling by their length; the first strips of a block are shorter.
STRIP = 1024
#: Queries that go through a block together.
QUERIES = 2048
#: The proof may be tried when this share of the dimensions has been added, those of most impact first.
_TRIES = (0.5, 0.625, 0.75, 0.875, 1.0)
#: Rows on which the choice among the tries is made, and dimensions added to many rows at once in the time that
#: one row takes to be finished by itself.
_PROBED, _FINISH = 128, 5_000
#: Pairs finished together, and the share of open pairs from which on all of a strip are finished together.
_PAIRS, _MANY = 8_192, 1 / 64
#: Rows and queries go through the index while their components stay below the first and all that their products
#: add up below the second; others are scored by integers of any size.
_NARROW, _SUM = 2.0**26, 2.0**62
#: Whole numbers and sums of them are exact in double precision below this.
_EXACT = 2.0**53
_NONE = -(1 << 63)


def _whole(scale: int):
    """Vectors as floor(scale * x), whole numbers in double precision; what is not finite then takes no part."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore", invalid="ignore"):
            for batch in batches:
                column = batch.column("embedding")
                values = column.flatten().to_numpy(zero_copy_only=False)
                whole = np.floor(scale * np.asarray(values, np.float64))
                sizes = np.asarray(column.value_lengths().fill_null(0), np.int64)
                ends = np.cumsum(sizes)
                bad = np.append(0, np.cumsum(~np.isfinite(whole)))
                good = (sizes > 0) & (bad[ends] == bad[ends - sizes])
                raw = whole.tobytes()
                bounds = zip((8 * (ends - sizes)).tolist(), (8 * ends).tolist(), good.tolist(), strict=True)
                out = [raw[a:b] if g else None for a, b, g in bounds]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(out, pa.binary())], names=["vec_id", "whole"]
                )

    return convert


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of whole numbers, in as few bytes a component as hold them; ``size`` is the number of components."""
    for batch in batches:
        raws = batch.column("whole").to_pylist()
        sizes = np.array([len(raw) // 8 for raw in raws], np.int32)
        for size in np.unique(sizes).tolist():
            mine = np.flatnonzero(sizes == size)
            rows = _unpack([raws[i] for i in mine.tolist()], size)
            most = np.abs(rows).max(axis=1)
            for kind, low, high in ((np.int16, 0, 2.0**15), (np.int32, 2.0**15, _NARROW)):
                good = np.flatnonzero((low <= most) & (most < high))
                for i, row in zip(mine[good].tolist(), rows[good].astype(kind), strict=True):
                    raws[i] = row.tobytes()
        arrays = [batch.column("vec_id"), pa.array(sizes), pa.array(raws, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "size", "whole"])


def _unpack(raws: list[bytes], size: int) -> np.ndarray:
    """Vectors of one number of components; those of more than two or four bytes a component have eight."""
    widths = {len(raw) for raw in raws}
    if len(widths) > 1:
        return np.concatenate([_unpack([raw], size) for raw in raws], dtype=np.float64)
    kind = {2: np.int16, 4: np.int32, 8: np.float64}[widths.pop() // size]
    return np.frombuffer(b"".join(raws), kind).reshape(len(raws), size)


def sort_key(score: int) -> bytes:
    """Bytes in whose order higher scores come first, whatever their size."""
    n = abs(score).to_bytes((abs(score).bit_length() + 7) // 8, "big")
    key = len(n).to_bytes(4, "big") + n
    return b"\1" + key if score < 0 else b"\0" + bytes(255 - b for b in key)


def exact_scores(rows: np.ndarray, query: np.ndarray) -> list[int]:
    """Inner products in integers of any size."""
    asked = [int(x) for x in query]
    return [sum(int(x) * y for x, y in zip(row, asked, strict=True) if x) for row in rows.tolist()]


def _marked(marks: np.ndarray) -> np.ndarray:
    """Where ``marks``, a multiple of eight in number, are set; fast where few are."""
    eights = np.flatnonzero(marks.view(np.uint64) != 0)
    at, place = np.nonzero(marks.reshape(-1, 8)[eights])
    return eights[at] * 8 + place


def _rest(rows: np.ndarray, cuts: list[int]) -> np.ndarray:
    """For every row and cut, the length of what lies behind the cut, not rounded down, in single precision."""
    out = np.empty((len(rows), len(cuts)), np.float32)
    for i, cut in enumerate(cuts):
        tail = rows[:, cut:].astype(np.float64)
        out[:, i] = np.sqrt(np.einsum("ij,ij->i", tail, tail)) * (1 + 1e-6)
    return out


class ImpactIndex:
    """Whole-number rows of a block by falling impact: the longest rows first, the dimensions of most impact first.

    The impact of a row is its length, that of a dimension its sum of squares over the rows.
    """

    def __init__(self, rows: np.ndarray, ids: np.ndarray | None = None):
        self.ids = np.arange(len(rows)) if ids is None else ids
        squares = np.zeros(len(rows))
        impact = np.zeros(rows.shape[1])
        for at in range(0, len(rows), STRIP):
            part = rows[at : at + STRIP].astype(np.float64) ** 2
            squares[at : at + STRIP] = part.sum(axis=1)
            impact += part.sum(axis=0)
        self.dims = np.argsort(-impact, kind="stable")
        self.order = np.lexsort((self.ids, -squares))
        self.ids = self.ids[self.order]
        self.rows = rows[self.order][:, self.dims]
        self.length = np.sqrt(squares[self.order])
        n, size = rows.shape
        self.cuts = sorted({int(np.ceil(share * size)) for share in _TRIES})
        self.rest = np.concatenate([_rest(self.rows[at : at + STRIP], self.cuts) for at in range(0, n, STRIP)])
        #: The first column is set to the rest behind the cut that is in use, so that one product gives the bounds.
        self.single = np.empty((n, size + 1), np.float32)
        self.single[:, 1:] = self.rows
        self.probed = np.unique(np.linspace(0, n - 1, _PROBED).astype(np.int64))
        self._by_id = np.argsort(self.ids, kind="stable")
        self.processed = 1.0

    def top(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best rows of the block (k <= its rows), of equal ones those of smaller ids, with their scores."""
        _, place, score = self.tops(np.asarray(query, np.float64)[None], k)
        return self.order[place], score

    def places(self, names: np.ndarray) -> np.ndarray:
        """Where the rows of these ids are; -1 for others.  Ids do not repeat."""
        at = np.minimum(np.searchsorted(self.ids, names, sorter=self._by_id), len(self.ids) - 1)
        place = self._by_id[at]
        return np.where(self.ids[place] == names, place, -1)

    def tops(
        self, queries: np.ndarray, k: int, names: np.ndarray | None = None, bars: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, place, score) of the ``k`` best rows of every query, without the row of its own name.

        ``bars`` holds scores that are too low to matter if they are missed, ``_NONE`` where there is no such score.

        A strip's rows get what the dimensions of most impact add to their scores, by one product for all queries; the
        length of the rest of row and query bounds what the others can still add.  Rows whose bound is below the
        ``k``-th best score so far are proven out, the others are finished exactly.  The number of dimensions added
        before the proof is the one of least cost on a few rows; the proof holds whatever it is.  A query whose
        ``k``-th best score is above the product of its length and a strip's greatest one is done.  ``processed``
        holds the share of components that were added for all rows.
        """
        n, size = self.rows.shape
        asked = np.ascontiguousarray(queries[:, self.dims])
        own = np.full(len(asked), -1) if names is None else self.places(names)
        need = np.full(len(asked), _NONE) if bars is None else bars.copy()
        length = np.sqrt(np.einsum("ij,ij->i", asked, asked))
        # Single precision adds up to this relative error to a bound, in any order of summation.
        slack = (size + 8) * 2.0**-22 * length * self.length[0] + 1
        doubles = self.length[0] * length.max() * (1 + 1e-6) < _EXACT
        rest = _rest(asked, self.cuts)
        single = np.empty((len(asked), size + 1), np.float32)
        single[:, 1:] = asked
        limit = np.empty(len(asked), np.float32)
        bounds, passed = np.empty(STRIP * len(asked), np.float32), np.empty(STRIP * len(asked) + 8, bool)
        held = (np.empty(0, np.int64),) * 3
        fresh: list[tuple[np.ndarray, ...]] = []
        live = np.arange(len(asked))
        worst = np.full(len(asked), np.iinfo(np.int64).max)  # the id of the k-th best so far
        cut = len(self.cuts) - 1

        def settle():
            """Merge what was found and raise the scores to pass."""
            nonlocal held, fresh
            query, place, score = held = self._best([held, *fresh], k)
            fresh = []
            last = np.flatnonzero(query[k - 1 :] == query[: max(0, len(query) - k + 1)]) + k - 1
            higher = last[score[last] >= need[query[last]]]
            need[query[higher]] = score[higher]
            worst[query[higher]] = self.ids[place[higher]]
            lowest = (np.where(need == _NONE, -np.inf, need) - slack).astype(np.float32)
            limit[:] = np.nextafter(lowest, np.float32(-np.inf))

        settle()
        at, width, strips, added, found = 0, min(STRIP, max(128, 4 * k)), 0, 0, 0
        while at < n:
            # All rows from here on are no longer than the first one.
            still = need[live] <= length[live] * self.length[at] * (1 + 1e-6) + 1
            if not still.all():
                live = live[still]
                if not len(live):
                    break
            every = len(live) == len(asked)
            if strips and strips & (strips - 1) == 0 and strips.bit_length() % 2 and limit.max() > -np.inf:
                cut = self._cheapest(single[live], rest[live], limit[live])
            head, end = self.cuts[cut], min(n, at + width)
            self.single[at:end, 0] = self.rest[at:end, cut]
            single[:, 0] = rest[:, cut]
            chosen, bar = (single, limit) if every else (single[live], limit[live])
            shape = end - at, len(live)
            bound = bounds[: shape[0] * shape[1]].reshape(shape)
            np.matmul(self.single[at:end, : head + 1], chosen[:, : head + 1].T, out=bound)
            np.greater_equal(bound, bar, out=passed[: bound.size].reshape(shape))
            passed[bound.size : bound.size + 8] = False
            open_ = _marked(passed[: -(-bound.size // 8) * 8])
            added += head * bound.size
            if doubles and len(open_) > _MANY * bound.size:
                pairs = self._strip(at, end, asked[live], own[live], need[live], k)
            else:
                row, query = np.divmod(open_, len(live))
                pairs = query, row + at, self._finish(row + at, asked, live[query], doubles)
            query, place, score = live[pairs[0]], pairs[1], pairs[2]
            good = (score >= need[query]) & (place != own[query])
            # Of rows as good as the k-th best those of larger ids are out.
            good &= (score > need[query]) | (self.ids[place] <= worst[query])
            if good.any():
                fresh.append((query[good], place[good], score[good]))
                found += int(good.sum())
            at, strips = end, strips + 1
            early = width < STRIP
            width = min(STRIP, 2 * width if strips > 1 else width)
            if fresh and (early or strips & (strips - 1) == 0 or found > 8 * len(asked)):
                settle()
                found = 0
        if fresh:
            settle()
        self.processed = added / (n * size * len(asked))
        return held

    def _best(self, parts: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
        """Of (query, place, score) the ``k`` best of every query in order, of equal ones those of smaller ids."""
        query, place, score = (np.concatenate(c) for c in zip(*parts, strict=True))
        if not len(query):
            return query, place, score
        high = int(score.max())
        wide = high - int(score.min()) + 1
        if wide * (int(query.max()) + 1) < 2**62:
            key = query * wide + (high - score)
            order = np.argsort(key)  # faster than lexsort; what is equal is put in order afterwards
            key = key[order]
            same = key[1:] == key[:-1]
            ties = np.flatnonzero(np.append(same, False) | np.append(False, same))
            order[ties] = order[ties][np.lexsort((self.ids[place[order[ties]]], key[ties]))]
        else:
            order = np.lexsort((self.ids[place], -score, query))
        query, place, score = query[order], place[order], score[order]
        starts = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
        rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
        good = rank < k
        return query[good], place[good], score[good]

    def _cheapest(self, single: np.ndarray, rest: np.ndarray, limit: np.ndarray) -> int:
        """The cut after which adding dimensions to all rows and finishing open ones cost least."""
        rows = self.single[self.probed]
        cost = []
        for i, head in enumerate(self.cuts):
            bound = rows[:, 1 : head + 1] @ single[:, 1 : head + 1].T + self.rest[self.probed, i][:, None] * rest[:, i]
            cost.append(head + _FINISH * float((bound >= limit).mean()))
        return int(np.argmin(cost))

    def _finish(self, place: np.ndarray, asked: np.ndarray, query: np.ndarray, doubles: bool) -> np.ndarray:
        """The scores of these rows and queries."""
        kind = np.float64 if doubles else np.int64
        score = np.empty(len(place), np.int64)
        for a in range(0, len(place), _PAIRS):
            rows, other = self.rows[place[a : a + _PAIRS]], asked[query[a : a + _PAIRS]]
            score[a : a + _PAIRS] = np.einsum("ij,ij->i", rows.astype(kind), other.astype(kind, copy=False))
        return score

    def _strip(
        self, at: int, end: int, asked: np.ndarray, own: np.ndarray, need: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, place, score) of what passes in a strip by all its scores; ``k`` of a query where many do."""
        score = self.rows[at:end].astype(np.float64) @ asked.T
        inside = np.flatnonzero((own >= at) & (own < end))
        score[own[inside] - at, inside] = -np.inf
        passed = score >= np.where(need == _NONE, -(2.0**60), need)  # no score is as low, but that of the query itself
        if passed.sum() > 4 * k * len(asked) and len(score) > k:
            kth = np.partition(score, len(score) - k, axis=0)[len(score) - k]
            above = score > kth
            by_id = np.argsort(self.ids[at:end], kind="stable")
            room = k - above.sum(axis=0)
            equal = (score == kth)[by_id]
            equal &= np.cumsum(equal, axis=0) <= room
            above[by_id] |= equal
            passed &= above
        row, query = np.nonzero(passed)
        return query, row + at, score[row, query].astype(np.int64)


class _Block:
    """The rows of one block and one length of vectors: an index of the narrow ones, and the others as they are."""

    def __init__(self, ids: np.ndarray, raws: list[bytes], size: int):
        widths = np.array([len(r) // size for r in raws])
        parts = {}
        for width in np.unique(widths).tolist():
            mine = np.flatnonzero(widths == width)
            parts[width] = ids[mine], _unpack([raws[i] for i in mine.tolist()], size)
        self.wide_ids, self.wide = parts.pop(8, (ids[:0], np.empty((0, size))))
        self.index = None
        if parts:
            self.index = ImpactIndex(*(np.concatenate(c) for c in list(zip(*parts.values(), strict=True))[::-1]))
            self.most = np.maximum(self.index.rows.max(axis=0), -self.index.rows.min(axis=0).astype(np.int64))

    def best(
        self, names: np.ndarray, queries: np.ndarray, bars: np.ndarray, k: int
    ) -> tuple[list[np.ndarray], list[tuple[int, int, int]]]:
        """The ``k`` best rows of every query: (query, id, score) in columns, and what is no long as rows."""
        columns = [np.empty(0, np.int64)] * 3
        fits = np.zeros(len(names), bool)
        if self.index is not None:
            fits = np.abs(queries[:, self.index.dims]) @ (self.most + 1.0) < _SUM
            if fits.any():
                query, place, score = self.index.tops(queries[fits], k, names[fits], bars[fits])
                columns = [np.flatnonzero(fits)[query], self.index.ids[place], score]
        out: list[tuple[int, int, int]] = []
        for i in range(len(names)) if len(self.wide) else np.flatnonzero(~fits).tolist():
            name = int(names[i])
            scores = exact_scores(self.wide, queries[i])
            found = [(-s, row) for s, row in zip(scores, self.wide_ids.tolist(), strict=True)]
            if self.index is not None and not fits[i]:
                scores = exact_scores(self.index.rows, queries[i][self.index.dims])
                found += [(-s, row) for s, row in zip(scores, self.index.ids.tolist(), strict=True)]
            out += [(i, row, -lost) for lost, row in nsmallest(k, (hit for hit in found if hit[1] != name))]
        return columns, out


#: The scores of ``hits`` are inverted, so that better ones come first; ``far`` orders those a long may not hold.
_HITS = "query_id long, lane int, hits array<struct<lost: long, far: binary, vec_id: long>>"
_LONG = (1 << 63) - 1


def _answers(blocks: dict[int, _Block], asked: pa.Table, k: int) -> Iterator[pa.RecordBatch]:
    """The block's best rows of these queries, as ``hits`` of each."""
    ids, sizes = column_numpy(asked, "vec_id"), column_numpy(asked, "size")
    bars, raws = column_numpy(asked, "bar"), asked.column("whole").to_pylist()
    lane = int(asked.column("block")[0].as_py()) % LANES
    for size in np.unique(sizes).tolist():
        if size not in blocks:  # rows of another length have no product
            continue
        mine = np.flatnonzero(sizes == size)
        queries = _unpack([raws[i] for i in mine.tolist()], size).astype(np.float64)
        (query, other, score), rows = blocks[size].best(ids[mine], queries, bars[mine], k)
        far = pa.nulls(len(query), pa.binary())
        if rows:
            more = list(zip(*rows, strict=True))
            keys = [sort_key(s) if abs(s) >= _LONG else None for s in more[2]]
            far = pa.concat_arrays([far, pa.array(keys, pa.binary())])
            more[2] = [max(-_LONG - 1, min(_LONG, s)) for s in more[2]]
            both = zip((query, other, score), more, strict=True)
            query, other, score = (np.append(c, np.array(x, np.int64)) for c, x in both)
            order = np.argsort(query, kind="stable")
            query, other, score, far = query[order], other[order], score[order], far.take(pa.array(order))
        counts = np.bincount(query, minlength=len(mine))
        hit = counts > 0
        ends = np.append(0, np.cumsum(counts[hit])).astype(np.int32)
        hits = pa.StructArray.from_arrays([pa.array(~score), far, pa.array(other)], ["lost", "far", "vec_id"])
        found = ids[mine][hit]
        arrays = [pa.array(found), pa.array(np.full(len(found), lane, np.int32)), pa.ListArray.from_arrays(ends, hits)]
        whole = pa.RecordBatch.from_arrays(arrays, ["query_id", "lane", "hits"])
        step = max(1, 65_536 // k)
        for at in range(0, len(found), step):
            yield whole.slice(at, step)


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by block, a block's rows before the queries -> the block's best rows of every query.

        A block's rows are held, the queries pass as a stream.
        """
        number = None
        held: list[pa.RecordBatch] = []
        asked: list[pa.RecordBatch] = []
        blocks: dict[int, _Block] | None = None
        for batch in batches:
            block, is_query = column_numpy(batch, "block"), column_numpy(batch, "is_query")
            new = np.flatnonzero((block[1:] != block[:-1]) | (is_query[1:] != is_query[:-1])) + 1
            for start, end in zip([0, *new.tolist()], [*new.tolist(), len(block)], strict=True):
                if start == end:
                    continue
                if block[start] != number:
                    if asked:
                        yield from _answers(blocks, pa.Table.from_batches(asked), k)
                    number, held, asked, blocks = block[start], [], [], None
                part = batch.slice(start, end - start)
                if not is_query[start]:
                    held.append(part)
                    continue
                if blocks is None:
                    blocks, held = _blocks(held), []
                asked.append(part)
                if sum(b.num_rows for b in asked) >= QUERIES:
                    yield from _answers(blocks, pa.Table.from_batches(asked), k)
                    asked = []
        if asked:
            yield from _answers(blocks, pa.Table.from_batches(asked), k)

    return search


def _blocks(held: list[pa.RecordBatch]) -> dict[int, _Block]:
    """The rows of a block by their number of components."""
    if not held:
        return {}
    rows = pa.Table.from_batches(held)
    ids, sizes, raws = column_numpy(rows, "vec_id"), column_numpy(rows, "size"), rows.column("whole").to_pylist()
    groups = {size: np.flatnonzero(sizes == size) for size in np.unique(sizes).tolist()}
    return {size: _Block(ids[mine], [raws[i] for i in mine.tolist()], size) for size, mine in groups.items()}


def _near(rows: DataFrame, asked: DataFrame, blocks: int, block: Column, k: int) -> DataFrame:
    """The ``k`` best rows of every block for every query; ``asked`` has a column ``bar``."""
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    bar = F.coalesce("bar", F.lit(_NONE)).alias("bar")
    sides = rows.select(
        block.alias("block"), F.lit(False).alias("is_query"), "vec_id", "size", "whole", F.lit(_NONE).alias("bar")
    ).unionByName(asked.select(every.alias("block"), F.lit(True).alias("is_query"), "vec_id", "size", "whole", bar))
    sides = sides.repartitionById(blocks, "block").sortWithinPartitions("block", "is_query")
    return map_batches(sides, _search(k), _HITS)


def _merged(near: DataFrame, k: int) -> DataFrame:
    """(query_id, hits): the ``k`` best of every query, without a sort of a whole group."""
    best = F.expr(f"slice(array_sort(flatten(collect_list(hits))), 1, {int(k)})")
    for keys in (["query_id", "lane"], ["query_id"]):
        near = near.groupBy(*keys).agg(best.alias("hits"))
    return near


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows with the largest integer inner product for every query.

    Components become floor(scale * x).  Rows with a null id and vectors that are null, empty or hold null or
    non-finite components take no part, as query or as candidate; a query is not its own candidate, and vectors of
    another length have no product with it.  Ties go to the smaller id; all rows are returned if there are fewer
    than ``k``.  Of rows that repeat an id, one counts (the smallest by its components).

    Rows are dealt to index blocks, and the queries are copied to all of them.  In a large table a share of the rows is
    searched first; the k-th best score found there is what rows of the other blocks have to reach.  Scores are exact
    for all finite components whose scaled value is finite; vectors with others take no part.  Order and ties are those
    of the exact scores; ``score`` shows one that a long cannot hold as the nearest long.
    """
    def whole(df: DataFrame, name: str) -> DataFrame:
        source = df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        rows = map_batches(source, _whole(scale), "vec_id long, whole binary")
        rows = rows.filter("vec_id IS NOT NULL AND whole IS NOT NULL").groupBy("vec_id")
        packed = map_batches(rows.agg(F.min("whole").alias("whole")), _pack, "vec_id long, size int, whole binary")
        return stage_table(packed, name)

    rows, asked = whole(vectors, "index"), whole(queries, "queries")
    count, values = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).head()
    tasks = TASKS * vectors.sparkSession.sparkContext.defaultParallelism

    def full(share: float = 1) -> int:
        return max(1, ceil(share * count / BLOCK_ROWS), ceil(share * values / BLOCK_VALUES))

    def blocks(share: float = 1) -> int:
        return max(full(share), min(tasks, int(share * count) // LEAST_ROWS))

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    unknown = asked.withColumn("bar", F.lit(None).cast("long"))
    if full() <= ROUNDS_FROM:
        near = _near(rows, unknown, blocks(), dealt(blocks()), k)
    else:
        # Rows are dealt to blocks by another hash than to rounds.
        other = F.xxhash64("vec_id", F.lit("block"))
        first, n, m = dealt(FIRST_SHARE) == 0, blocks(1 / FIRST_SHARE), blocks(1 - 1 / FIRST_SHARE)
        head = _merged(_near(rows.filter(first), unknown, n, F.pmod(other, F.lit(n)).cast("int"), k), k)
        head = stage_table(head, "first-round")
        # A score shown as the least long may be lower still.
        last = F.expr(f"~element_at(hits, {int(k)}).lost")
        bars = head.filter(F.size("hits") == k).select(F.col("query_id").alias("vec_id"), last.alias("bar"))
        bars = bars.filter(F.col("bar") > _NONE)
        rest = _near(rows.filter(~first), asked.join(bars, "vec_id", "left"), m, F.pmod(other, F.lit(m)).cast("int"), k)
        near = head.select("query_id", F.lit(0).alias("lane"), "hits").unionByName(rest)
    hits = _merged(near, k).select("query_id", F.posexplode("hits").alias("place", "hit"))
    rank = (F.col("place") + 1).cast("int").alias("rank")
    return hits.select("query_id", rank, F.col("hit.vec_id").alias("vec_id"), F.expr("~hit.lost").alias("score"))
