"""Toxicity chain and byte network: held-out accuracy, and defined results for odd rows."""

import pickle
import random
import zlib

import numpy as np

from issuescope.llm.language import ByteNetwork, fit_language, identify_language, keep_identified, windows
from issuescope.llm.toxicity import drop_toxic, fit_toxicity, score_toxicity, train_chain

DOCS = "doc_id long, text string, lang string, source string, toxic int, place string"


def toxic_corpus(n=900, seed=0):
    rng = random.Random(seed)
    plain = [f"{a}{b}" for a in ("ba", "ko", "li", "mu", "ter", "son") for b in ("na", "ri", "to", "la", "s", "den", "ge")]
    bad = ["vilk", "grumm"]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(10, 200))
        toxic = i % 5 == 0
        for _ in range(rng.randint(2, 5) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(bad) + rng.choice(["", "en", "ung", "s,"])
        junk = i % 7 == 1
        text = " ".join(words).upper() + "!!" if junk else " ".join(words)
        rows.append((i, text, "en", "s", 0, "p"))
        labels.append((i, int(not junk), int(toxic and not junk)))
    return rows, labels


def test_chain_on_held_out_documents(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows, DOCS)
    model = fit_toxicity(docs, spark.createDataFrame(labels[:600], "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r for r in score_toxicity(docs, model).collect()}
    held = [(got[i].toxic, bool(t)) for i, q, t in labels[600:] if q]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert [r.doc_id for r in drop_toxic(docs, model).orderBy("doc_id").collect()] == [i for i in sorted(got) if got[i].kept]
    assert drop_toxic(docs, model).schema == docs.schema


def test_later_models_see_earlier_odds():
    rng = np.random.default_rng(0)
    sparse = [np.array([int(i % 2)], np.int32) for i in range(200)]
    marks = np.array([[i % 2, i % 2] for i in range(200)], float)
    chain = train_chain(sparse, np.c_[np.ones(200), rng.normal(size=(200, 4))], marks, np.arange(200) % 3)
    assert [len(m.dense) for m in chain["models"]] == [5, 6, 7]
    assert chain["models"][1].dense[5] > 0


def test_odd_rows_and_tables(spark):
    rows, labels = toxic_corpus(60)
    docs = spark.createDataFrame([*rows, (1, None, None, None, None, None), (None, "", None, None, None, None), (1, "x " * 50_000, "", "", 1, "")], DOCS)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, None, 0), (4, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    got = score_toxicity(docs, fit_toxicity(docs, marks)).collect()
    assert len(got) == 63
    assert all(r.p_toxic == 0 and r.kept for r in got if r.doc_id is None)
    assert fit_toxicity(docs, marks.limit(0)) is None
    assert all(r.kept for r in score_toxicity(docs, None).collect())
    assert score_toxicity(docs.limit(0), None).collect() == []
    one_class = marks.filter("toxic = 0 AND quality = 1")
    assert all(r.kept for r in score_toxicity(docs, fit_toxicity(docs, one_class)).collect())


def language_rows(n=400, seed=0):
    rng = random.Random(seed)
    words = {
        "en": ["the", "thing", "was", "ing", "where", "shed"],
        "de": ["der", "für", "schön", "ung", "über", "nicht"],
        "fr": ["les", "été", "eaux", "où", "ça", "quelle"],
    }
    rows = []
    for i in range(n):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, " ".join(rng.choices(words[lang], k=rng.randint(3, 300))), lang, "s", 0, "p"))
    return rows


def test_language_on_held_out_documents(spark):
    rows = language_rows()
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in identify_language(docs, fit_language(docs)).collect()}
    for i in got:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= got[i].score <= 1
    held = [(got[i].lang_pred, lang) for i, _, lang, *_ in rows if got[i].held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.97


def test_language_of_odd_rows(spark):
    rows = [*language_rows(90), (1000, None, "en", None, None, None), (1001, "", "en", None, None, None), (1002, "12 34 !?", "en", None, None, None)]
    rows += [(None, "the thing", None, None, None, None), (1003, "the " * 60_000, None, None, None, None), (1003, "the " * 60_000, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    model = fit_language(docs)
    got = identify_language(docs, model).collect()
    assert len(got) == len(rows)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (1000, 1001, 1002))
    assert {r.lang_pred for r in got if r.doc_id == 1003} == {"en"}
    kept = keep_identified(docs, model)
    assert kept.schema == docs.schema
    assert not {1000, 1001, 1002} & {r.doc_id for r in kept.collect()}
    nothing = docs.filter("lang = 'xx'")
    assert fit_language(nothing) is None
    assert {(r.lang_pred, r.score) for r in identify_language(docs, None).collect()} == {("und", 0.0)}
    assert identify_language(nothing, model).collect() == []


def test_tables_predict_what_the_network_computes():
    rng = np.random.default_rng(0)
    network = ByteNetwork(["a", "b", "c"])
    network.bias = [rng.normal(size=b.shape).astype(np.float32) for b in network.bias]
    x = rng.integers(0, 256, (5, 256)).astype(np.uint8)
    hidden = []
    for f, b in zip(network.filters, network.bias, strict=True):
        w = len(f) // network.embed.shape[1]
        spans = np.stack([network.embed[x[:, i : i + w]].reshape(5, -1) for i in range(256 - w + 1)], axis=1)
        hidden.append((spans @ f + b).max(axis=1))
    z = np.maximum(np.concatenate(hidden, axis=1), 0) @ network.out + network.out_bias
    expected = np.exp(z - z.max(axis=1, keepdims=True))
    np.testing.assert_allclose(network.predict(x, network.tables()), expected / expected.sum(axis=1, keepdims=True), rtol=1e-4, atol=1e-6)


def test_windows_hold_the_whole_text():
    for n in (1, 255, 256, 257, 5000):
        assert windows(b"x" * n).tobytes().rstrip(b"\0") == b"x" * n


def test_reruns_learn_the_same_from_ids_with_several_texts(spark):
    rows, labels = toxic_corpus(120)
    rows += [(i, t + " other", lang, *r) for i, t, lang, *r in rows[:60]]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    one = spark.createDataFrame(rows, DOCS).repartition(3)
    two = spark.createDataFrame(rows[::-1], DOCS).repartition(5)
    assert fit_language(one) == fit_language(two) is not None
    a, b = (pickle.loads(fit_toxicity(docs, marks)) for docs in (one, two))
    assert a["threshold"] == b["threshold"]
    for x, y in zip(a["models"], b["models"], strict=True):
        assert (x.ids == y.ids).all() and (x.weight == y.weight).all() and (x.dense == y.dense).all()
    few = pickle.loads(fit_toxicity(one, marks, most_features=5))
    assert max(len(m.ids) for m in few["models"]) <= 5 < max(len(m.ids) for m in a["models"])
