"""The curriculum mix against a plain-Python version."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from issuescope.llm.mixing import curriculum, demand_position, plan_mix


def plain(rows, budget=1.5):
    sized = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, s in rows]
    sizes = defaultdict(int)
    for _, s, n in sized:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    stopped = set()
    level = 0.0
    while True:
        open_ = [s for s in order if s not in stopped]
        if not open_:
            break
        level = (budget * sum(sizes.values()) - sum(2 * sizes[s] for s in stopped)) / sum(weight[s] for s in open_)
        more = {s for s in open_ if 2 * sizes[s] <= weight[s] * level}
        if not more:
            break
        stopped |= more
    target = {s: float(2 * sizes[s]) if s in stopped else weight[s] * level for s in order}
    out, before = [], defaultdict(int)
    key = lambda r: (hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest(), r[0] or 0, r[2])
    for d, s, n in sorted(sized, key=key):
        want = int(target[s] + 0.5)
        full, rest = divmod(want, sizes[s]) if sizes[s] else (0, 0)
        out.append((d, n, sizes[s], target[s], n * full + max(0, min(n, rest - before[s]))))
        before[s] += n
    return out


def documents(spark, rows):
    return spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id long, text string, source string, size int, target double")


ROWS = [
    *[(i, "word " * (1 + i * 7 % 40), "abcdé"[i % 5]) for i in range(200)],
    *[(1000 + i, "hot " * 12, "hot") for i in range(100)],
    (2000, None, "abc"), (2001, "", None), (2002, "one two\tthree\x0bfour", None), (None, "no id", "x"), (2003, None, "only null"),
    (2004, "twice a b", "b"), (2004, "twice a b", "b"), (2005, "long " * 30_000, "long"),
]


def test_plan_matches_plain_python(spark):
    got = plan_mix(documents(spark, ROWS).repartition(5)).select("doc_id", "size", "source_size", "target", "taken").collect()
    key = lambda r: repr((r[0], r[1], r[2], r[4]))
    for mine, theirs in zip(sorted(map(tuple, got), key=key), sorted(plain(ROWS), key=key), strict=True):
        assert (mine[0], mine[1], mine[2], mine[4]) == (theirs[0], theirs[1], theirs[2], theirs[4])
        assert mine[3] == pytest.approx(theirs[3], rel=1e-12)


def test_sources_meet_their_targets_and_repeats_are_bounded(spark):
    plan = plan_mix(documents(spark, ROWS)).collect()
    for r in plan:
        assert r.taken <= 2 * r.size
        assert r.position is None or 0 <= r.position <= 1
    for size in {r.source_size for r in plan} - {0}:
        own = [r for r in plan if r.source_size == size]
        if len({r.target for r in own}) == 1 and sum(r.size for r in own) == size:  # no other source of that size
            assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5
    assert sum(r.taken for r in plan) == pytest.approx(1.5 * sum(r.size for r in plan), abs=10)


def test_without_words_or_rows(spark):
    assert plan_mix(documents(spark, [])).collect() == []
    got = plan_mix(documents(spark, [(1, None, None), (2, " ", "a")])).collect()
    assert {(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}


def test_positions_invert_the_demand(spark):
    df = spark.range(0, 101).select((F.col("id") / 100).alias("share"))
    for trend in (0.5, 1.0, 2.0):
        for r in df.select("share", demand_position(F.col("share"), F.lit(trend)).alias("t")).collect():
            met = (r.t + (trend - 1) * r.t**2 / 2) / ((1 + trend) / 2)
            assert met == pytest.approx(r.share, abs=1e-12)


def test_curriculum_returns_whole_documents_as_often_as_taken(spark):
    docs = documents(spark, ROWS)
    plan = plan_mix(docs).collect()
    mixed = curriculum(docs)
    assert mixed.columns == docs.columns
    times = defaultdict(int)
    for r in mixed.collect():
        times[r.doc_id] += 1
        assert r.doc_id is None or r.doc_id == 2004 or r.text in (t for d, t, _ in ROWS if d == r.doc_id)
    expected = defaultdict(int)
    for r in plan:
        expected[r.doc_id] += int(r.taken / r.size + 0.5) if r.size else 0
    assert {d: n for d, n in times.items() if n} == {d: n for d, n in expected.items() if n}
