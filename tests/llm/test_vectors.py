"""Vector near-duplicates and exact top-k against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from issuescope.llm import vectors
from issuescope.llm.topk import ImpactIndex, exact_top_k, sort_key
from issuescope.llm.vectors import linked_pairs, quantise, vector_components

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_components(rows, threshold):
    unit = {}
    for place, (vec_id, v) in enumerate(rows):
        if vec_id is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, float)
        unit[place] = x / np.linalg.norm(x)
    near = {p: [q for q in unit if q != p and len(unit[p]) == len(unit[q]) and unit[p] @ unit[q] >= threshold] for p in unit}
    out = []
    for place, (vec_id, _) in enumerate(rows):
        seen, todo = {place}, [place]
        while todo:
            for q in near.get(todo.pop(), []):
                if q not in seen:
                    seen.add(q)
                    todo.append(q)
        low = min((rows[p][0] for p in seen), default=None) if vec_id is not None else None
        out.append((vec_id, len(near.get(place, [])), low, vec_id is not None and low == vec_id))
    return sorted(out, key=repr)


def test_links_and_components_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LEAST_CHUNKS", 3)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 16))
    rows = [(int(i), (centres[i % 12] + rng.normal(size=16) * rng.choice([0.05, 0.3, 1.0])).astype("f4").tolist()) for i in range(150)]
    rows += [(1000 + i, rows[3][1]) for i in range(20)]  # copies
    rows += [(1100, (np.array(rows[3][1], "f4") * 2).tolist())]  # the same direction
    rows += [(1200, None), (1201, []), (1202, [0.0] * 16), (1203, [None] + [1.0] * 15), (1204, [float("nan")] * 16)]
    rows += [(1205, [float("inf")] + [1.0] * 15), (1206, [1.0, 0.0]), (1207, [1.0, 0.01]), (None, rows[3][1])]
    got = vector_components(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA), 0.9)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_components(rows, 0.9)


def test_empty_vector_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vector_components(empty).collect() == []
    assert exact_top_k(empty, empty).collect() == []


@pytest.mark.parametrize("threshold", [0.2, 0.9, 0.999])
def test_error_bounds_lose_nothing(threshold):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 24))
    x[150:] = x[:150] + rng.normal(size=(150, 24)) * 0.1
    x /= np.linalg.norm(x, axis=1)[:, None]
    codes, scale, error = quantise(x)
    bound = error[:, None] + error[None] + 3 * error[:, None] * error[None]
    assert (np.abs(x @ x.T - (codes.astype(float) @ codes.T) * scale[:, None] * scale[None]) <= bound).all()
    got = {(a, b) for i, j in linked_pairs(x, x, threshold) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    assert got == set(zip(*(k.tolist() for k in np.nonzero(np.einsum("ik,jk->ij", x, x) >= threshold)), strict=True))


def brute_top(rows, queries, k):
    whole = {}
    for vec_id, v in rows:
        if vec_id is not None and v and all(x is not None and math.isfinite(x) for x in v):
            whole[vec_id] = [math.floor(1024 * float(np.float32(x))) for x in v]
    out = []
    for q in queries:
        if q not in whole:
            continue
        scores = [(-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q])]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def test_top_k_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(400)]
    rows += [(500 + i, rows[0][1]) for i in range(15)]  # ties
    rows += [(600, None), (700, [float("nan")] * 8), (800, [0.0] * 8), (900, [1.0]), (901, [2.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got = exact_top_k(df, df.filter("vec_id % 100 = 0"), 10)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, [0, 100, 200, 300, 500, 600, 700, 800, 900], 10)


def test_top_k_over_several_blocks(spark, monkeypatch):
    from issuescope.llm import topk

    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(230)]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).withColumn("score", F.lit(1)).withColumn("block", F.lit(2))
    got = exact_top_k(df, df.filter("vec_id % 20 = 0"), 7)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, range(0, 230, 20), 7)


def test_index_stops_early_only_with_proof():
    rng = np.random.default_rng(4)
    block = rng.integers(-300, 300, size=(500, 12))
    block[7] = 2_000  # far ahead
    for query in (np.full(12, 900), rng.integers(-900, 900, size=12), np.zeros(12, int)):
        rows, scores = ImpactIndex(block).top(query, 3)
        best = np.sort(block @ query)[::-1][:3]
        assert np.sort(scores)[::-1][:3].tolist() == best.tolist()


def test_top_k_of_large_components_is_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=2) * 10.0 ** rng.integers(-2, 15)).tolist()) for i in range(60)]
    rows += [(100, [1e10, 0.0]), (101, [1e10, 0.0]), (102, [-1.0, 0.0]), (103, [1e14, -1e14]), (104, [3e4, 3e4])]
    rows += [(200, [1e30, 1.0]), (201, [1e30, 2.0]), (202, [-1e30, 0.0]), (300, [1e306, 0.0])]  # the last is not finite when scaled
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(tuple(r) for r in exact_top_k(df, df.filter("vec_id % 20 = 0"), 5).collect())
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in rows if math.isfinite(1024 * max(map(abs, v)))}
    want = []
    for q in (i for i in whole if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)
        want += [(q, n, i, max(-(2**63), min(2**63 - 1, -s))) for n, (s, i) in enumerate(scores[:5], 1)]
    assert got == sorted(want)
    assert any(s[3] == 2**63 - 1 for s in got) and {s[0] for s in got} >= {0, 20, 40, 100, 200}


def test_score_that_fits_a_long_is_kept_beside_ones_that_do_not(spark):
    df = spark.createDataFrame(
        [(100, [1e10, 0.0], 0), (1, [1e10, 0.0], 0), (2, [-1.0, 0.0], 0)], "vec_id bigint, embedding array<double>, label int"
    )
    got = exact_top_k(df, df.filter("vec_id = 100"), 10).collect()
    assert [tuple(r) for r in got] == [(100, 1, 1, 2**63 - 1), (100, 2, 2, -(1024 * 10**10) * 1024)]


def test_sort_keys_follow_scores():
    scores = [0, 1, -1, 255, 256, -255, -256, 2**63, -(2**63), 2**200, -(2**200), 2**200 + 1]
    assert sorted(scores, key=sort_key) == sorted(scores, reverse=True)
