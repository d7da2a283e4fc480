"""The pipeline, stage by stage, on a small corpus with planted cases."""

import re
from collections import Counter
from itertools import combinations

import corpus_pipeline
from test_classifiers import toxic_corpus

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _turn int"


def corpus(spark, tmp_path):
    rows, labels = toxic_corpus(400)
    docs = [(i, t, "en", f"s{i % 3}", len(t), 7) for i, t, *_ in rows]
    docs += [(1000 + i, docs[2 + 7 * i][1], "en", "s1", 1, 1) for i in range(5)]  # copies
    docs += [(2000, "123 456 !!", "en", "s0", 9, 1), (2001, None, None, None, None, None), (None, docs[3][1], "en", "s2", 1, 1)]
    docs += [docs[9]]  # a repeated row
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return spark.read.parquet(f"{tmp_path}/documents.parquet"), labels


def smallest_of_groups(docs):
    """The ids that stay: of documents that are linked by 0.8 of their 5-word shingles the smallest."""
    sets = {}
    for i, text in docs:
        words = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i for i in sets if find(i) == i}


def ends_meet(pieces, documents):
    """Sequences are filled without gaps up to 2,048, and every document is there from its first token to its end."""
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, Counter())[p.piece, p.start, p.length] += 1
    assert by_doc.keys() == documents.keys()
    for doc, cuts in by_doc.items():
        assert sum(n for (piece, *_), n in cuts.items() if piece == 0) == documents[doc]
        at = 0
        for (piece, start, length), n in sorted(cuts.items()):
            if n == documents[doc]:  # one text under this id
                assert start == at
                at += length


def test_stages(spark, tmp_path):
    docs, labels = corpus(spark, tmp_path)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "language", "near_duplicates", "mixing", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    clean = stage["toxicity"](spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    left = {r.doc_id for r in clean.collect()}
    toxic = {i for i, q, t in labels if t}
    assert len(toxic & left) <= 0.05 * len(toxic)
    assert {i for i, q, t in labels if q and not t} <= left
    spoken = stage["language"](spark, clean, str(tmp_path))
    ids = {r.doc_id for r in spoken.collect()}
    assert not {2000, 2001} & ids
    assert left - {2000, 2001} == ids
    single = stage["near_duplicates"](spark, spoken, str(tmp_path))
    assert single.columns == docs.columns and single.filter("_turn = 7").count() > 300
    counts = Counter(r.doc_id for r in single.collect())
    assert all(n == 1 for i, n in counts.items() if i is not None)
    assert {i for i in counts if i is not None} == smallest_of_groups(
        [(r.doc_id, r.text) for r in spoken.collect() if r.doc_id is not None]
    )
    assert counts[None] == 1
    mixed = stage["mixing"](spark, single, str(tmp_path))
    assert mixed.columns == docs.columns and mixed.filter("_turn = 7").count() > 300
    assert {r.doc_id for r in mixed.collect()} <= set(counts)
    packed = stage["packing"](spark, mixed, str(tmp_path))
    assert packed.filter("piece = 0").count() == mixed.count()
    ends_meet(packed.collect(), Counter(r.doc_id for r in mixed.collect()))


def test_run_and_empty_tables(spark, tmp_path):
    docs, _ = corpus(spark, tmp_path / "full")
    assert corpus_pipeline.run(spark, str(tmp_path / "full")).count() > 0
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []


def test_near_copies_of_four_fifths_go(spark, tmp_path):
    """40 shingles against the same and 9, 10 or 11 more: 0.816 and 0.8 are near copies, 0.784 is none."""
    docs = []
    for doc, more in ((10, 9), (20, 10), (30, 11)):
        words = [f"w{doc}x{i}" for i in range(44 + more)]
        docs += [(doc, " ".join(words[:44]), "en", "s", 1, 1), (doc + 1, " ".join(words), "en", "s", 1, 1)]
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    left = stage(spark, spark.createDataFrame(docs, SCHEMA), str(tmp_path))
    assert sorted(r.doc_id for r in left.collect()) == [10, 20, 30, 31]


def test_repeated_ids_keep_their_texts_and_plans(spark, tmp_path):
    schema = "doc_id long, text string, source string, mix_n int, turn int"
    words = lambda w, n: " ".join(f"{w}{i}" for i in range(n))
    docs = [(3, words("a", 30), "s", 5, 6), (3, words("b", 50), "s", 5, 6), (3, words("b", 50), "s", 5, 6)]
    docs += [(None, words(f"n{i}", 10 + i), "t", 5, 6) for i in range(40)]
    df = spark.createDataFrame(docs, schema)
    stage = dict(corpus_pipeline.STAGES)
    single = stage["near_duplicates"](spark, df, str(tmp_path))
    assert Counter(r.text for r in single.collect()) == Counter(t for _, t, *_ in [*docs[:2], *docs[3:]])
    mixed = stage["mixing"](spark, single, str(tmp_path)).collect()
    assert {(r.mix_n, r.turn) for r in mixed} == {(5, 6)}
    for source, size in (("s", 80), ("t", sum(10 + i for i in range(40)))):
        taken = Counter(r.text for r in mixed if r.source == source)
        assert max(taken.values()) <= 2
        total = sum(len(t.split()) * n for t, n in taken.items())
        target = {"s": 160.0, "t": 1.5 * (80 + 1180) - 160}[source]
        assert size <= 1180 and abs(total - target) <= 50 / 2
