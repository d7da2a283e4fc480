"""Token ids, the bit-plane files, and packing."""

import gc
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from issuescope.llm import packing, tokens
from issuescope.llm.packing import best_fit, crossover, evolve_shards, least_bins, pack_documents
from issuescope.llm.tokens import join_planes, pack_chunk, read_token_files, shuffle_planes, tokenizer_ids, unpack_chunk, write_token_files

NAMES = ("word_bpe_49k.json", "byte_bpe_50k.json")


def library(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


@pytest.mark.parametrize("name", NAMES)
def test_pieces_give_the_ids_of_the_whole(name):
    rng = random.Random(0)
    parts = [" ", "\n", "\t", "a", "b", "ß", "'s", "'", "1", "23", "!!", "é", "é", "Σ", "<|endoftext|>", "x ", "中", "\r\n", "  ", "\n\n", "İ", "A", "\x1c", "\x85", "\0", "×"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(4000)] + ["word " * 5000, "a" * 300, ""]
    of, whole = tokenizer_ids(name), library(name)
    for text in texts:
        assert np.frombuffer(of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, ascii(text[:80])


def odd_words(rng, n):
    """Texts of words that come once, bare and with marks, in plain lines and in others."""
    texts = []
    for i in range(n):
        word = "".join(rng.choices("abcdeéüß", k=10)) + "qxz"[i % 3]
        forms = [word, word + ",", word.title() + ".", f"({word})", word + ",&&&", word + "'s", word + "7", "x" + word * 9]
        texts.append(" ".join(forms) + f"\n{word}\n{word}; 12 <|endoftext|> {word}<" + rng.choice(["", "", " ", "\0", "  \n \0 " + word]))
    return texts


def held_pieces():
    return sum(len(p) + len(p.older) for p in gc.get_objects() if isinstance(p, tokens._Pieces))


def test_words_and_their_parts_are_held_once():
    rng = random.Random(3)
    whole = library(NAMES[1])
    tokens.tokenizer_ids.cache_clear()
    of = tokenizer_ids(NAMES[1])
    gc.collect()
    before = held_pieces()
    words = ["".join(rng.choices("abcdefgh", k=12)) for _ in range(500)]
    for word in words:
        text = f"a {word} {word}, {word}. {word}! {word}? {word},&&&"
        assert np.frombuffer(of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert held_pieces() - before <= len(words) + 20


def test_words_are_held_up_to_a_number(monkeypatch):
    monkeypatch.setattr(tokens, "WORD_CACHE", 50)
    whole = library(NAMES[1])
    tokens.tokenizer_ids.cache_clear()
    of = tokenizer_ids(NAMES[1])
    words = next(c.cell_contents for c in of.__closure__ if isinstance(c.cell_contents, tokens._Words))
    for text in odd_words(random.Random(4), 300):
        assert np.frombuffer(of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, ascii(text)
        assert len(words) <= 50 and len(words.older) <= 50
    tokens.tokenizer_ids.cache_clear()


def odd_texts():
    rng = random.Random(5)
    marks = [" ", "\n", "\t", "\0", "ß", "İ", "ŉx", "ſ", "'S", "<|endoftext|>", "<|ENDOFTEXT|>", "中", "é", "\r\n", "  ", "\n\n", "A1", "\x85", "Σ", "ΑΣ"]
    texts = ["".join(rng.choices(marks, k=rng.randint(0, 12))) for _ in range(1500)]
    return texts + odd_words(rng, 60) + ["", "", "\n", " ", "z" * 300 + " b", "word " * 3000, "Word, word. WORD; straße, STRASSE!?"] * 2


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("known, group", [(700_000, 12 << 20), (50, 2000)])
def test_texts_together_give_the_ids_of_each(name, known, group, monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_WORDS", known)
    monkeypatch.setattr(tokens, "GROUP_BYTES", group)
    tokens._known.cache_clear()
    whole, texts = library(name), [*odd_texts(), None]
    table = pa.table({"at": range(len(texts)), "text": pa.array(texts, pa.string())})
    seen = 0
    for rows, encoded in tokens.encoded_texts(iter(table.to_batches(100)), name):
        for at, ids in zip(rows.column("at").to_pylist(), encoded, strict=True):
            assert at == seen
            want = whole.encode(texts[at] or "", add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want, ascii((texts[at] or "")[:80])
            seen += 1
        assert len(tokens._known(name).words) <= known
    assert seen == len(texts)
    tokens._known.cache_clear()


@pytest.mark.parametrize("name", NAMES)
def test_every_word_of_many_texts_is_encoded_once(name, monkeypatch):
    """Whatever marks stand beside it: those with long letters were put together anew wherever they came."""
    monkeypatch.setattr(tokens, "GROUP_BYTES", 5000)
    known, encoded = tokens._Known(tokenizer_ids(name)), []
    word_ids = known.word_ids
    known.word_ids = lambda word: encoded.append(word) or word_ids(word)
    monkeypatch.setattr(tokens, "_known", lambda _: known)
    words = ["abcdefgh"[i % 8] * (7 + i % 3) + "ijklmnop"[i // 8 % 8] + "," for i in range(192)]
    texts = ["start " + " ".join(words) for _ in range(50)]
    list(tokens.encoded_texts(iter(pa.table({"text": texts}).to_batches(10)), name))
    assert sorted(encoded) == sorted({*words, encoded[0]}) and len(encoded) == len(set(words)) + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=70), st.sampled_from(["byte", "bit"]))
def test_planes_round_trip(ids, planes):
    ids = np.array(ids, "<u4")
    assert join_planes(shuffle_planes(ids, planes), len(ids), planes).tolist() == ids.tolist()
    assert unpack_chunk(pack_chunk(ids, planes), len(ids), planes).tolist() == ids.tolist()


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_files_round_trip(spark, tmp_path, monkeypatch, planes):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["alpha", "Beta", "gamma", "42", "!?"], k=rng.randint(0, 60)))) for i in range(0, 300, 2)]
    rows += [(1, None), (3, ""), (5, "same"), (5, "same"), (9_000_000_000, "long " * 20_000), (-4, "first")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 7, "p") for r in rows], "doc_id long, text string, part int, chunk string")
    write_token_files(df.repartition(3), str(tmp_path / "t"), NAMES[0], 2, planes)
    got = read_token_files(spark, str(tmp_path / "t")).collect()
    whole, start = library(NAMES[0]), 0
    by_start = sorted(got, key=lambda r: r.start)
    for (doc, text), read in zip(sorted(rows, key=lambda r: r[0]), by_start, strict=True):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        assert (read.doc_id, read.start, np.frombuffer(read.ids, "<u4").tolist()) == (doc, start, ids)
        start += len(ids)


def test_empty_and_null_id_files(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    write_token_files(empty, str(tmp_path / "e"), NAMES[0], 2)
    assert read_token_files(spark, str(tmp_path / "e")).collect() == []
    one = spark.createDataFrame([(None, "a"), (1, "b")], "doc_id long, text string")
    write_token_files(one, str(tmp_path / "n"), NAMES[0], 2)
    assert [(r.doc_id, r.start) for r in read_token_files(spark, str(tmp_path / "n")).orderBy("start").collect()] == [(None, 0), (1, 2)]


def check_packing(rows, texts, capacity=2048):
    whole = library(NAMES[1])
    bins = defaultdict(list)
    by_doc = defaultdict(list)
    for r in rows:
        assert 0 < r.length <= capacity
        bins[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, text, times in texts:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted(by_doc[doc], key=lambda r: r.piece)
        assert len(pieces) == times * -(-len(ids) // capacity)
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
            assert r.piece == 0 or r.length == capacity
    return len(bins)


def test_packing_is_whole_gapless_and_tight(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 64)
    rng = random.Random(2)
    texts = [(i, "ab " * rng.randint(0, 1000), 1) for i in range(200)]
    texts += [(300 + i, "ab " * n, 1) for i, n in enumerate([1, 682, 683, 1023, 1024, 2047, 2048, 5000])]
    texts += [(500, None, 1), (501, "", 1), (502, "twice twice", 2), (503, "ab " * 2048 + "x", 1)]
    rows = [(d, t, "s") for d, t, n in texts for _ in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(3)
    got = pack_documents(df).collect()
    used = check_packing(got, texts)
    total = sum(r.length for r in got)
    assert used <= -(-total // 2048) + 5  # about one for each shard


def test_packing_an_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_crossover_keeps_every_item_once_and_fits():
    rng = np.random.default_rng(0)
    lengths = np.sort(rng.integers(1, 2048, 300))[::-1]
    people = []
    for seed in range(2):
        bins, fills = np.full(300, -1), []
        best_fit(lengths, np.random.default_rng(seed).permutation(300), bins, fills, 2048)
        people.append(bins)
    child = crossover(lengths, people[0], people[1], 2048, rng)
    assert (child >= 0).all()
    assert np.bincount(child, lengths).max() <= 2048
    assert set(child.tolist()) == set(range(child.max() + 1))


def fewest_bins(lengths, capacity):
    """By trying all, largest first into every different room."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= lengths[i]}:
            rest = list(rooms)
            rest.remove(room)
            place(i + 1, [*rest, room - lengths[i]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


@given(st.lists(st.integers(1, 20), max_size=8))
@settings(max_examples=150, deadline=None)
def test_no_packing_has_fewer_than_the_least_bins(lengths):
    lengths = sorted(lengths, reverse=True)
    least = least_bins(np.array(lengths, int), 20)
    assert -(-sum(lengths) // 20) <= least <= fewest_bins(lengths, 20)


def test_islands_find_fewer_bins_than_best_fit(spark):
    """Lengths on which longest first leaves room in every bin, beside a shard that needs no search."""
    hard = np.sort(np.random.default_rng(3).integers(400, 801, 1500))[::-1]
    rows = [(0, int(n), int(k)) for n, k in zip(*np.unique(hard, return_counts=True), strict=True)] + [(1, 1024, 40)]
    got = {r.shard: r for r in evolve_shards(spark.createDataFrame(rows, "shard long, length long, pieces long"), 2048).collect()}
    bins, fills = np.full(len(hard), -1), []
    best_fit(hard, np.arange(len(hard)), bins, fills, 2048)
    found = np.frombuffer(got[0].bins, "<i4")
    assert np.bincount(found, hard).max() <= 2048 and len(set(found.tolist())) == got[0].n_bins
    assert got[0].least <= got[0].n_bins < 0.99 * len(fills)
    assert got[1].n_bins == got[1].least == 20


def test_query_digest_types(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    write_token_files(df, str(tmp_path / "d"), NAMES[0], 2)
    row = read_token_files(spark, str(tmp_path / "d")).select(F.crc32("ids").alias("c"), F.octet_length("ids").alias("n")).head()
    ids = np.array([*library(NAMES[0]).encode("a b", add_special_tokens=False).ids, 2], "<u4")
    assert (row.c, row.n) == (zlib.crc32(ids.tobytes()), 4 * len(ids))
    assert tokens.CHUNK_IDS > 0
