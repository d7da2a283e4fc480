"""Near-duplicate documents against brute force over full sets."""

import math
import random

import pytest

from issuescope.llm import minhash
from issuescope.llm.common import connected_components
from issuescope.llm.minhash import minhash_components

SCHEMA = "doc_id long, text string, rep long, sig string"  # with names that the operator uses itself


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent=85):
    sets = {}
    for doc, text in rows:
        if doc is not None:
            sets.setdefault(doc, []).append(shingles(text))
    docs = sorted(sets)
    parent = {d: d for d in docs}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    out = []
    for doc, text in rows:
        if doc is None:
            out.append((None, len(shingles(text)), None, False))
        else:
            component = find(doc) if shingles(text) else doc
            out.append((doc, len(shingles(text)), component, component == doc))
    return sorted(out, key=repr)


def run(spark, rows, **settings):
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in minhash_components(df, **settings).collect()), key=repr)


def corpus(seed, groups, size, words=80):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    rows = []
    for group in range(groups):
        base = [rng.choice(vocabulary) for _ in range(words)] + (passage if group % 2 else [])
        for _ in range(rng.randint(1, size)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows), rng.choice([" ", "\t", "\n"]).join(text)))
    return rows


def test_components_match_brute_force(spark):
    rows = corpus(1, 40, 6)
    assert run(spark, rows) == brute(rows)


def test_one_large_group_of_near_copies_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(minhash, "LIST_CHUNK", 8)
    monkeypatch.setattr(minhash, "SET_CHUNK", 8)
    rows = corpus(2, 2, 1) + [(1000 + i, t) for i, (_, t) in enumerate(corpus(3, 1, 1) * 1)]
    rng = random.Random(4)
    base = rows[-1][1].split()
    for i in range(90):
        text = list(base)
        for _ in range(rng.randint(0, 8)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        rows.append((2000 + i, " ".join(text)))
    assert run(spark, rows) == brute(rows)


def test_frequent_values_do_not_hide_links(spark, monkeypatch):
    """With more frequent values than the order knows, lists get longer and the result stays."""
    monkeypatch.setattr(minhash, "FREQUENT_VALUES", 1)
    rows = corpus(5, 15, 5, words=40)
    assert run(spark, rows) == brute(rows)


def test_edge_rows(spark):
    long = " ".join(f"w{i % 9973}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three"), (7, "ÀB c"), (8, "àB c"),
        (9, long), (10, long + " end"), (11, "same same same same same same same"), (11, "same same same same same same same"),
        (None, "one two"), (12, "one two"), (12, "other words here entirely and more"), (13, "other words here entirely and more"),
        (-5, "one\x0btwo"), (14, "one\xa0two"), (15, "one two"),
    ]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_a_threshold_of_its_own(spark):
    rows = corpus(6, 12, 6, words=30)
    assert run(spark, rows, percent=95) == brute(rows, 95)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(300, 340)]
    edges = spark.createDataFrame([*chain, *star, (7, 7), (340, 160)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert {got[i] for i in range(100, 161)} | {got[340]} == {100}
    assert {got[i] for i in range(300, 340)} | {got[5]} == {5}
    assert len(got) == 61 + 1 + 41


def test_the_filter_misses_a_stated_share_at_every_threshold():
    """Binomial tails in whole numbers: at most ``MISSED`` of the pairs at the threshold have too few equal coordinates."""
    for percent in (80, 85, 90, 95, 100):
        tail = lambda m: sum(math.comb(64, j) * percent**j * (100 - percent) ** (64 - j) for j in range(m)) / 100**64  # noqa: E731, B023
        matches = minhash.least_matches(percent)
        assert tail(matches) <= minhash.MISSED < (tail(matches + 1) if matches < 64 else 1)
    assert [minhash.least_matches(p) for p in (80, 85)] == [34, 39]


def test_components_match_brute_force_at_four_fifths(spark):
    rows = corpus(8, 40, 6)
    assert run(spark, rows, percent=80) == brute(rows, 80)


def test_lower_thresholds_are_refused_with_the_miss_rate(spark):
    with pytest.raises(ValueError, match="misses at most 1e-06"):
        minhash_components(spark.createDataFrame([], SCHEMA), 79)
