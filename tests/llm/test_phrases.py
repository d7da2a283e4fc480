"""Collocations against a brute-force version, also where fingerprints collide."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows

from issuescope.llm import phrases as P
from issuescope.llm import queries as Q

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces_of(text):
    for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute(documents, least, top, longest=5, cover=100):
    counts, totals = {}, Counter()
    for text, lang in documents:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + n])] += 1
    out = []
    for lang, found in counts.items():
        frequent = {p: f for p, f in found.items() if f >= least}
        best = []
        for p, a in frequent.items():
            if len(p) < 2:
                continue
            longer = [
                f
                for q, f in frequent.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if any(100 * f >= cover * a for f in longer):
                continue
            score, k = min((1000 * a * totals[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out, key=repr)


def texts(seed, n):
    rng = np.random.default_rng(seed)
    words = ["a", "of", "THE", "the", "new", "york", "city", "é", "zürich", "x" * 30, "longer-than-eight", "longer-than-eighty"]
    out = []
    for _ in range(n):
        picked = [words[i] for i in rng.zipf(1.4, 40) % len(words)]
        seps = rng.choice([" ", "  ", "\t", ", ", ".", "\n"], 40, p=[0.6, 0.1, 0.1, 0.1, 0.05, 0.05])
        text = "".join(w + s for w, s in zip(picked, seps, strict=True))
        out.append((text + " New York City hall", str(rng.choice(["en", "de"]))))
    return out


def collocations(spark, documents, **settings):
    df = spark.createDataFrame(documents, "text string, lang string")
    return rows(P.collocations(df, **settings), *COLUMNS)


@pytest.mark.parametrize("key_bits", [64, 6])
def test_against_brute_force(spark, key_bits):
    documents = texts(1, 120)
    got = collocations(spark, documents, least=10, top=25, key_bits=key_bits)
    assert got == brute(documents, 10, 25)
    assert {r[0] for r in got} == {"en", "de"}


def test_nulls_copies_and_one_hot_language(spark):
    same = [("red blue; green red  blue", None)] * 40 + [("red blue", "und")] * 3
    documents = [*same, (None, "en"), ("", "en"), ("  ..\n", None), (None, None), ("solo", "fr")]
    got = collocations(spark, documents, least=5, top=10)
    assert got == brute(documents, 5, 10)
    assert got[0][:4] == ("und", 1, "red blue", 83)


def test_ties_are_cut_by_phrase_in_byte_order(spark):
    documents = [(f"{w} {w}x.", "en") for w in ("b", "a", "é", "z") for _ in range(6)]
    got = collocations(spark, documents, least=5, top=3)
    assert got == brute(documents, 5, 3)
    assert [r[2] for r in got] == ["a ax", "b bx", "z zx"]


def test_longer_phrases_cover_by_percent(spark):
    documents = [("one two three four five six", "en")] * 9 + [("two three", "en")] * 3
    for cover in (100, 70):
        assert collocations(spark, documents, least=5, top=10, cover_percent=cover) == brute(documents, 5, 10, 5, cover)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert P.collocations(empty).collect() == []
    documents = [("ping pong", "en")] * 6
    wide = spark.createDataFrame(
        [(*d, 1, 2, "z", 4) for d in documents], "text string, lang string, key int, count int, phrase string, words int"
    )
    assert rows(P.collocations(wide, least=5), *COLUMNS) == brute(documents, 5, 10)


def test_long_texts_are_cut_between_pieces(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_BYTES", 64)
    batch = pa.RecordBatch.from_pydict({"body": [b"a b c. " * 50, b"", None, b"w" * 500 + b" v. u", b"x y"]})
    seen = Counter()
    for data, starts, row in P.blocks(batch):
        words = P.Words(data, starts, tuple(P._Powers(b) for b in P._BASES))
        for i in words.grams(2):
            seen[int(row[words.text[i]]), words.phrase(int(i), 2)] += 1
    assert seen == {(0, "a b"): 50, (0, "b c"): 50, (3, "w" * 500 + " v"): 1, (4, "x y"): 1}


def test_words_of_texts_without_blanks_between_them():
    data = np.frombuffer(b"ab" b"cd ef" b"gh", np.uint8)
    words = P.Words(data, np.array([0, 2, 7]), tuple(P._Powers(b) for b in P._BASES))
    assert [words.phrase(i, 1) for i in range(len(words))] == ["ab", "cd", "ef", "gh"]
    assert words.grams(2).tolist() == [1]


def test_words_of_the_same_text_have_the_same_hash_at_every_place():
    words = P.Words(
        np.frombuffer(b"longer-than-eight x longer-than-eight xx longer-than-eight.", np.uint8),
        np.array([0]),
        tuple(P._Powers(b) for b in P._BASES),
    )
    with np.errstate(over="ignore"):
        key, check = words.fingerprints(np.arange(5), 1, np.zeros(1, np.uint64))
    assert key[0] == key[2] == key[4] and check[0] == check[2] == check[4]
    assert len(set(key.tolist())) == 3 and len(set(check.tolist())) == 3


def test_query_over_the_table(spark):
    sf = "/root/testdata/sf0.001"
    documents = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang").collect()]
    assert rows(Q.op12_collocations(spark, sf), *COLUMNS) == brute(documents, 100, 2000)
