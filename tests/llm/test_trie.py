"""The trie of conversation prefixes against a brute-force version, and its node table."""

import zlib
from hashlib import sha256

import numpy as np
from conftest import rows

from issuescope.llm import queries as Q
from issuescope.llm.trie import NodeTable, prefix_trie

COLUMNS = (
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
)
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def truncated_base(c, family=5):
    return c - int(np.fmod(c, family))


def brute(conversations, kept_mod=9):
    """Nodes by listing every prefix of every rebuilt conversation."""
    own = {}
    for conv_id, turn, role, text in conversations:
        if conv_id is not None:
            role, text = role or "", text or ""
            said = f"{len(role.encode())}:{role}{text}".encode()
            key = (turn is not None, turn or 0, sha256(said).digest()[:16])
            own.setdefault(conv_id, []).append((key, (role, text)))
    own = {c: [t for _, t in sorted(turns, key=lambda x: x[0])] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % kept_mod
        rebuilt[c] = tuple(own.get(truncated_base(c), [])[:h] + turns[h:])
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = []
    for prefix, members in nodes.items():
        below = [(p, m) for p, m in nodes.items() if p[: len(prefix)] == prefix]
        children = [p for p, _ in below if len(p) == len(prefix) + 1]
        leaves = [p for p, _ in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes)]
        saved = sum((len(m) - 1) * len(p[-1][1].encode()) for p, m in below if p)
        ends = ",".join(str(c) for c in sorted(members) if rebuilt[c] == prefix)
        out.append(
            (
                min(members),
                len(prefix),
                min(nodes[prefix[:-1]]) if prefix else None,
                len(members),
                len(children),
                len(leaves),
                saved,
                sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def check(spark, conversations, **settings):
    df = spark.createDataFrame(conversations, SCHEMA)
    got = rows(prefix_trie(df, **settings), *COLUMNS)
    assert got == brute(conversations)
    return got


def test_against_brute_force_with_hot_turns_and_small_shards(spark):
    rng = np.random.default_rng(3)
    conversations = []
    for c in range(-12, 160):
        for t in range(int(rng.integers(1, 7))):
            # Two thirds of the conversations begin alike, and many are copies.
            word = "hello" if t == 0 and c % 3 else f"w{rng.integers(0, 2)}é"
            conversations.append((c, t, "user" if t % 2 else "assistant", word))
    got = check(spark, conversations, shard_turns=16)
    assert got == check(spark, conversations)


def test_nulls_ties_repeated_rows_and_turnless_conversations(spark):
    conversations = [
        (None, 0, "user", "nobody's"),
        (0, None, "user", "first, as its turn is null"),
        (0, 0, None, "x"),
        (0, 0, "user", None),
        (0, 0, "user", None),
        (5, 1, "user", ""),
        (5, 1, "assistant", "tie"),
        (7, 3, "user", "only turn"),
        (11, 0, "user", "its base 10 is absent"),
        (-4, 0, "user", "x" * 100_000),
        (2**40, 0, "user", "far away"),
    ]
    got = check(spark, conversations)
    root = [r for r in got if r[1] == 0]
    assert len(root) == 1 and root[0][3] == 6 and root[0][2] is None


def test_long_and_copied_conversations(spark):
    conversations = [(1000, t, "user", f"t{t}") for t in range(300)]
    conversations += [(c, t, "user", f"s{t}") for c in range(0, 400, 5) for t in range(2)]
    check(spark, conversations, shard_turns=64)


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(empty).collect() == []
    some = [(1, 0, "user", "a"), (2, 0, "user", "a")]
    wide = spark.createDataFrame(
        [(*r, 9, 9, "z", 1, 2) for r in some], SCHEMA + ", base int, kept int, digest string, hi int, shard int"
    )
    assert rows(prefix_trie(wide), *COLUMNS) == brute(some)


def test_node_table_is_minimal_perfect_and_verified():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        hi, lo = rng.integers(-(2**63), 2**63, n), rng.integers(-(2**63), 2**63, n)
        table = NodeTable(hi, lo)
        assert sorted(table.slots(hi, lo).tolist()) == list(range(n))
        if n:
            assert (table.slots(hi, lo + 1) == -1).all()  # the same place may be hit, the digest is not there


def test_query_over_the_table(spark):
    got = Q.op11_prefix_trie(spark, "/root/testdata/sf0.001")
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    conversations = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert rows(got, *COLUMNS) == brute(conversations)
