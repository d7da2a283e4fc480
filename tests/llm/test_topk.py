"""Top-k of many queries at once, over many blocks, against brute force."""

import time

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from issuescope.llm import topk
from issuescope.llm.topk import ImpactIndex, exact_top_k


def brute(rows, ids, query, name, k):
    """(score, id) of the ``k`` best in integers of any size."""
    scores = rows.astype(object) @ query.astype(object)
    return [(-s, i) for s, i in sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist(), strict=True) if i != name)[:k]]


def test_many_queries_take_little_time(spark, tmp_path):
    rng = np.random.default_rng(10)
    rows, n_queries = rng.normal(size=(40_000, 64)).astype("f4") / 8, 400
    lists = pa.ListArray.from_arrays(np.arange(0, rows.size + 1, 64, dtype=np.int32), rows.ravel())
    pq.write_table(pa.table({"vec_id": np.arange(len(rows)), "embedding": lists}), tmp_path / "rows.parquet")
    df = spark.read.parquet(str(tmp_path / "rows.parquet"))
    began = time.perf_counter()
    got = exact_top_k(df, df.filter("vec_id % 100 = 0")).collect()
    assert time.perf_counter() - began < 25
    whole = np.floor(1024 * rows.astype("f8"))
    scores = whole[::100] @ whole.T  # whole numbers below 2^53
    scores[np.arange(n_queries), np.arange(n_queries) * 100] = -np.inf
    best = np.lexsort((np.broadcast_to(np.arange(len(rows)), scores.shape), -scores), axis=1)[:, :10]
    want = [(100 * q, n + 1, i, int(scores[q, i])) for q in range(n_queries) for n, i in enumerate(best[q].tolist())]
    assert sorted(tuple(r) for r in got) == want


@pytest.mark.parametrize("kind", ["dense", "copies", "lengths", "dimensions", "large", "few"])
def test_all_queries_of_an_index_match_brute_force(kind):
    rng = np.random.default_rng(11)
    rows = rng.integers(-300, 300, size=(3_000, 12))
    if kind == "copies":
        rows = np.concatenate([rows[:300], np.repeat(rows[:3], 900, axis=0)])
    elif kind == "lengths":
        rows = (rows * rng.exponential(2, size=(3_000, 1))).astype(np.int64)
    elif kind == "dimensions":
        rows = (rows * np.geomspace(20, 0.01, 12)).astype(np.int64)
    elif kind == "large":
        rows = rows * (1 << 16) + rng.integers(0, 1 << 16, size=rows.shape)
    elif kind == "few":
        rows = rng.integers(-1, 2, size=(13, 2))
    ids = rng.permutation(len(rows)) - 1_000
    picked = np.arange(0, len(rows), max(1, len(rows) // 40))
    names = ids[picked].copy()
    names[::3] = 10**9  # no row of the block
    index = ImpactIndex(rows, ids)
    queries = rows[picked].astype(float)
    want = [brute(rows, ids, rows[p], n, 10) for p, n in zip(picked, names.tolist(), strict=True)]
    # Scores to reach: none, one of the block, or one above all of its scores.
    bars = np.array([topk._NONE if i % 3 == 0 else w[4 % len(w)][0] + (i % 3 - 1) * 10**12 for i, w in enumerate(want)])
    for bar in (None, bars):
        query, place, score = index.tops(queries, 10, names, bar)
        for i, best in enumerate(want):
            least = topk._NONE if bar is None else bar[i]
            mine = query == i
            found = list(zip(score[mine].tolist(), index.ids[place[mine]].tolist(), strict=True))
            assert [h for h in found if h[0] >= least] == [h for h in best if h[0] >= least]


def test_proof_comes_before_the_last_dimension():
    rng = np.random.default_rng(12)
    rows = (rng.normal(size=(20_000, 32)) * np.geomspace(300, 3, 32)).astype(np.int64)
    index = ImpactIndex(rows)
    index.tops(rows[:200].astype(float), 10)
    assert index.processed < 0.7


def test_blocks_in_two_rounds_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 20)
    rng = np.random.default_rng(13)
    rows = [(i, rng.normal(size=5).round(1).tolist()) for i in range(400)]
    rows += [(400 + i, rows[20][1]) for i in range(40)]  # ties
    rows += [(500 + i, (rng.normal(size=5) * 10.0 ** rng.integers(3, 14)).tolist()) for i in range(10)]
    rows += [(520 + i, rng.normal(size=3).tolist()) for i in range(7)]  # fewer than k of a length
    rows += [(540, [-1e13] * 5), (560, None), (580, [float("inf")] * 5), (None, [1.0] * 5), (21, [9.0] * 5), (21, [8.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = exact_top_k(df, df.filter("vec_id % 20 = 0"), 7).collect()
    whole = {}
    for i, v in rows:
        if i is not None and v and np.isfinite(v).all():
            made = np.floor(1024 * np.array(v))
            if i not in whole or made.tobytes() < whole[i].tobytes():
                whole[i] = made
    want = []
    for q in (i for i in whole if i % 20 == 0):
        ids = [i for i in whole if len(whole[i]) == len(whole[q])]
        table = np.array([[int(x) for x in whole[i]] for i in ids], object)
        best = brute(table, np.array(ids), np.array([int(x) for x in whole[q]], object), q, 7)
        want += [(q, n, i, max(-(2**63), min(2**63 - 1, s))) for n, (s, i) in enumerate(best, 1)]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_components_decide_how_many_blocks(spark, monkeypatch):
    seen = []
    near = topk._near
    monkeypatch.setattr(topk, "_near", lambda rows, asked, blocks, *a: seen.append(blocks) or near(rows, asked, blocks, *a))
    monkeypatch.setattr(topk, "BLOCK_VALUES", 400)
    df = spark.createDataFrame([(i, [float(i % 7), 1.0] * 10) for i in range(100)], "vec_id bigint, embedding array<double>")
    assert exact_top_k(df, df.filter("vec_id % 50 = 0"), 3).count() == 6
    assert seen == [5]
