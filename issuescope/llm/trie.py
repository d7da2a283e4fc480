"""The trie of conversation prefixes, as a table of its nodes.

1. Families of conversations (those that share the turns they are rebuilt from) are range-sorted by id and cut into
   shards of about ``SHARD_TURNS`` turns.  A shard is a run of whole families, so a first turn that a third of all
   conversations share is spread over as many shards as these conversations fill.
2. Every prefix of a rebuilt conversation has a 128-bit digest, chained from turn to turn.  A shard enumerates its
   distinct digests and gives each a slot of a minimal perfect hash, checked against the stored digest
   (``NodeTable``); counts are scattered into flat arrays and summed through parent slots, deepest first.
3. The shards' counts meet per digest, one row per shard and node.  The sums go back to the shards: every node
   belongs to the shard of its smallest member, which scatters the node's own share of leaves, children and saved
   tokens and sums these up to the root in the same way.  Adding the shards' sums gives the whole subtrees.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table
from .common import column_numpy, lanes, map_batches, mix64

FAMILY = 5
KEPT_MOD = 9
SHARD_TURNS = 65_536
ROOT = bytes(16)
NO_ENDS = sha256(b"").hexdigest()

_STEP = 0x9E3779B97F4A7C15
_LOCAL = (
    "shard bigint, hi bigint, lo bigint, up_hi bigint, up_lo bigint, depth bigint, bytes bigint, "
    "count bigint, ended bigint, low bigint, ends string"
)
_PARTIAL = (
    "hi bigint, lo bigint, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint"
)


class NodeTable:
    """A minimal perfect hash from distinct 128-bit digests to the slots 0 to n - 1.

    Digests that are alone at their place of a level are placed there; the others go on to the next, smaller level.  A
    level is a bit per place and the running number of set bits.  The digests themselves are kept by slot, so that
    a digest the table was not built from is told apart and gets -1.
    """

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        self.levels: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        slots = np.empty(len(hi), np.int64)
        left, start = np.arange(len(hi)), 0
        while len(left):
            seed = np.uint64((len(self.levels) + 1) * _STEP & 0xFFFFFFFFFFFFFFFF)
            place = self._place(hi[left], lo[left], seed, 2 * len(left))
            alone = np.bincount(place, minlength=2 * len(left)) == 1
            number = start + np.cumsum(alone) - 1
            self.levels.append((seed, alone, number))
            placed = alone[place]
            slots[left[placed]] = number[place[placed]]
            start += int(placed.sum())
            left = left[~placed]
        self.hi, self.lo = np.empty_like(hi), np.empty_like(lo)
        self.hi[slots], self.lo[slots] = hi, lo

    @staticmethod
    def _place(hi: np.ndarray, lo: np.ndarray, seed: np.uint64, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = mix64(lo.view(np.uint64) ^ mix64(hi.view(np.uint64) + seed))
        return (mixed % np.uint64(size)).astype(np.int64)

    def __len__(self) -> int:
        return len(self.hi)

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        found = np.full(len(hi), -1, np.int64)
        open_ = np.arange(len(hi))
        for seed, alone, number in self.levels:
            place = self._place(hi[open_], lo[open_], seed, len(alone))
            hit = alone[place]
            found[open_[hit]] = number[place[hit]]
            open_ = open_[~hit]
        if len(self):
            known = found >= 0
            known &= (self.hi[found] == hi) & (self.lo[found] == lo)
            found[~known] = -1
        return found


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def _distinct(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((lo, hi))
    hi, lo = hi[order], lo[order]
    new = np.ones(len(hi), bool)
    new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
    return hi[new], lo[new]


def upward(depth: np.ndarray, parent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots, slots of their parents) level by level, deepest first, without the root."""
    order = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, cuts):
        if len(level) and depth[level[0]] > 0:
            yield level, parent[level]


class _Shard:
    """The rebuilt conversations of a run of families, until they are turned into nodes."""

    def __init__(self, number: int):
        self.number = number
        self.digests, self.ups, self.depths, self.bytes = [ROOT], [ROOT], [0], [0]
        self.ended: list[bytes] = []
        self.convs: list[int] = []

    def add(self, conv_id: int, turns: list[tuple[bytes, int]]) -> None:
        at = ROOT
        for depth, (digest, size) in enumerate(turns, 1):
            self.ups.append(at)
            at = blake2b(at + digest, digest_size=16).digest()
            self.digests.append(at)
            self.depths.append(depth)
            self.bytes.append(size)
        self.ended.append(at)
        self.convs.append(conv_id)

    def nodes(self) -> pa.RecordBatch:
        hi, lo = _halves(self.digests)
        up_hi, up_lo = _halves(self.ups)
        table = NodeTable(*_distinct(hi, lo))
        at = table.slots(hi, lo)
        depth, size, first = (np.zeros(len(table), np.int64) for _ in range(3))
        depth[at], size[at], first[at] = self.depths, self.bytes, np.arange(len(at))
        parent = table.slots(up_hi[first], up_lo[first])
        convs, end = np.array(self.convs, np.int64), table.slots(*_halves(self.ended))
        ended = np.zeros(len(table), np.int64)
        low = np.full(len(table), np.iinfo(np.int64).max)
        np.add.at(ended, end, 1)
        np.minimum.at(low, end, convs)
        count = ended.copy()
        for level, above in upward(depth, parent):
            np.add.at(count, above, count[level])
            np.minimum.at(low, above, low[level])
        # The conversations of a shard come in ascending order.
        ids: dict[int, list[str]] = {}
        for slot, conv_id in zip(end.tolist(), self.convs, strict=True):
            ids.setdefault(slot, []).append(str(conv_id))
        ends = [",".join(ids[s]) if s in ids else None for s in range(len(table))]
        shard = np.full(len(table), self.number, np.int64)
        columns = [shard, table.hi, table.lo, up_hi[first], up_lo[first], depth, size, count, ended, low]
        names = [c.split()[0] for c in _LOCAL.split(", ")]
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(ends, pa.string())], names=names)


def rebuilt(base: int, family: dict[int, tuple[int, list]]) -> Iterator[tuple[int, list]]:
    """Every conversation of a family: the first kept turns of its base, then its own after as many."""
    first = family[base][1] if base in family else []
    for conv_id, (kept, own) in family.items():
        yield conv_id, first[:kept] + own[kept:]


def _local_nodes(batches: Iterator[pa.RecordBatch], shard_turns: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by family, conversation and turn -> the nodes of every shard."""
    shard: _Shard | None = None
    base, family = None, {}
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("base", "conv_id", "kept", "digest", "bytes")]
        for at, conv_id, kept, digest, size in zip(*columns, strict=True):
            if at != base:
                if family:
                    shard = shard or _Shard(base)
                    for conversation in rebuilt(base, family):
                        shard.add(*conversation)
                    if len(shard.digests) >= shard_turns:
                        yield shard.nodes()
                        shard = None
                base, family = at, {}
            family.setdefault(conv_id, (kept, []))[1].append((digest, size))
    if family:
        shard = shard or _Shard(base)
        for conversation in rebuilt(base, family):
            shard.add(*conversation)
    if shard:
        yield shard.nodes()


def _shard_sums(nodes: pa.Table) -> pa.Table:
    """The share of one shard in the sums of all subtrees that its conversations lie in."""
    value = {c: column_numpy(nodes, c) for c in nodes.column_names}
    table = NodeTable(value["hi"], value["lo"])
    at = table.slots(value["hi"], value["lo"])

    def by_slot(column: str) -> np.ndarray:
        out = np.empty(len(table), np.int64)
        out[at] = value[column]
        return out

    depth, conv_id, n_convs = by_slot("depth"), by_slot("conv_id"), by_slot("n_convs")
    parent = table.slots(by_slot("up_hi"), by_slot("up_lo"))
    owned = by_slot("low") == conv_id
    # A node that all members end at has no child.
    leaves = (owned & (n_convs == by_slot("n_ended"))).astype(np.int64)
    saved = np.where(owned, (n_convs - 1) * by_slot("bytes"), 0)
    children = np.zeros(len(table), np.int64)
    for level, above in upward(depth, parent):
        np.add.at(children, above, owned[level].astype(np.int64))
        np.add.at(leaves, above, leaves[level])
        np.add.at(saved, above, saved[level])
    up = pa.array(conv_id[parent], mask=~(owned & (depth > 0)))
    arrays = [table.hi, table.lo, depth, conv_id, up, n_convs, children, leaves, saved]
    return pa.table(dict(zip([c.split()[0] for c in _PARTIAL.split(", ")], map(pa.array, arrays), strict=True)))


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and shard -> the hash of each node's ids, which pass as a stream."""
    key, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"hi": [key[0]], "lo": [key[1]], "ends_sha256": [state.hexdigest()]})

    for batch in batches:
        done: list[tuple[int, int, str]] = []
        for hi, lo, ends in zip(*[batch.column(c).to_pylist() for c in ("hi", "lo", "ends")], strict=True):
            if key != (hi, lo):
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (hi, lo), sha256(ends.encode())
            else:
                state.update(b"," + ends.encode())
        if done:
            columns = zip(*done, strict=True)
            yield pa.RecordBatch.from_pydict(dict(zip(("hi", "lo", "ends_sha256"), map(list, columns), strict=True)))
    if key is not None:
        yield row()


def prefix_trie(
    conversations: DataFrame, family: int = FAMILY, kept_mod: int = KEPT_MOD, shard_turns: int = SHARD_TURNS
) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per trie node.

    ``conversations`` has conv_id, turn, role and text; other columns are not read.  Conversation c becomes the first
    h turns of conversation c - c % ``family`` and its own turns after its first h, where h is the CRC-32 of
    its number modulo ``kept_mod``.  A node is a distinct sequence of first turns; see the module for how it is counted.

    Turns are ordered by ``turn``, nulls first; turns of equal number by the digest of role and text, and repeated
    rows are turns of their own.  A null role or text is empty.  Rows without a conversation id belong to none and are
    left out.  Texts of any length are hashed in the JVM before anything is shuffled.  An empty table has no
    node, not even a root.  A task holds the digests, not the texts, of ``shard_turns`` turns and of the family it is at.
    """
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    conv = F.col("conv_id").cast("bigint")
    turns = stage_table(
        conversations.filter("conv_id IS NOT NULL").select(
            (conv - conv % family).alias("base"),
            conv.alias("conv_id"),
            (F.crc32(conv.cast("string")) % kept_mod).cast("int").alias("kept"),
            F.col("turn").alias("turn"),
            F.substring(F.unhex(F.sha2(said, 256)), 1, 16).alias("digest"),
            F.octet_length(text).cast("bigint").alias("bytes"),
        ),
        "turns",
    )
    parts = max(lanes(spark), -(-turns.count() // shard_turns))
    rows = turns.repartitionByRange(parts, "base").sortWithinPartitions(
        "base", "conv_id", F.col("turn").asc_nulls_first(), "digest"
    )
    local = stage_table(map_batches(rows, lambda b: _local_nodes(b, shard_turns), _LOCAL), "trie-nodes")

    node = Window.partitionBy("hi", "lo")
    known = local.drop("ends").withColumns(
        {
            "n_convs": F.sum("count").over(node),
            "n_ended": F.sum("ended").over(node),
            "conv_id": F.min("low").over(node),
        }
    )
    known = known.drop("count", "ended")
    sums = known.groupBy("shard").applyInArrow(_shard_sums, _PARTIAL)
    ends = local.filter("ended > 0").select("hi", "lo", "shard", "ends")
    ends = ends.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "shard")
    hashes = map_batches(ends, _hash_ends, "hi bigint, lo bigint, ends_sha256 string")
    both = sums.unionByName(hashes, allowMissingColumns=True)
    return (
        both.groupBy("hi", "lo")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.min("depth").alias("depth"),
            F.max("parent_conv_id").alias("parent_conv_id"),
            F.max("n_convs").alias("n_convs"),
            F.sum("n_children").alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("saved_tokens"),
            F.coalesce(F.max("ends_sha256"), F.lit(NO_ENDS)).alias("ends_sha256"),
        )
        .drop("hi", "lo")
    )
