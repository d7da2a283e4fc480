import pytest
from conftest import rows
from pyspark.sql import functions as F

from issuescope.functions.answers import parse_label_ids
from issuescope.functions.text import clean_text, strip_fence, text_key, truncate_text
from issuescope.operators.first import dedup_first, first_n_per_key, with_rank
from issuescope.operators.groups import distribution
from issuescope.operators.labels import (
    add_wide_columns,
    attach_labels,
    label_flags,
    label_vocabulary,
    merge_labels,
    numbered_block,
    observed_labels,
    parse_single_label,
    parse_translations,
    translation_fault,
    sparse_labels,
    synonym_table,
    translate_labels,
)
from issuescope.sources.catalogue import catalogue_table

FENCE = "`" * 3


def one(spark, column):
    return spark.range(1).select(column.alias("x")).head().x


def test_clean_and_truncate(spark):
    def lit(s):
        return F.lit(s).cast("string")

    assert one(spark, clean_text(lit(" \x1c a b　\n\x85"))) == "a b"
    assert one(spark, clean_text(lit(None))) == ""
    assert one(spark, truncate_text(lit("  abcdef "), 3)) == "abc..."
    assert one(spark, truncate_text(lit(" abc "), 3)) == "abc"
    assert one(spark, truncate_text(lit("я" * 5), 4)) == "яяяя..."
    assert one(spark, truncate_text(lit(" \t"), 3)) is None
    assert one(spark, truncate_text(lit(None), 3)) is None


def test_text_key_is_a_digest_of_text_and_labels(spark):
    import hashlib

    for labels in (["a", "б"], []):
        want = hashlib.sha256(("text|" + "|".join(labels)).encode()).hexdigest()
        assert one(spark, text_key(F.lit("text"), labels)) == want[:16]
        assert one(spark, text_key(F.lit("text"), labels, 64)) == want


def test_fences(spark):
    def bare(s):
        return one(spark, strip_fence(F.lit(s)))

    assert bare(f"{FENCE}json\n[1]\n{FENCE}") == "[1]\n"
    assert bare(f"{FENCE}JS\n[1]{FENCE}") == "[1]"
    assert bare(f"{FENCE}python\n[1]{FENCE}") == "python\n[1]"
    assert bare(f"{FENCE}json") == "json"
    assert bare(" [1] ") == "[1]"


IDS = [
    ('{"problem_ids": [1, 3]}', [1, 3], False),
    (f'{FENCE}json\n{{"problem_ids": [2, 99, 1, 3, 4]}}\n{FENCE}', [2, 99, 1], False),
    ('{"problem_ids": []}', [], False),
    ('{"problem_ids": "1"}', [], False),
    ("not json", [], True),
    ('{"problem_ids": ["1", 2.9, true, 2, 2]}', [2, 1, 2], False),
    ("[1, 2]", [], True),
    ("{}", [], False),
    ('{"problem_ids": null}', [], False),
    ('{"problem_ids": [null, {"a": 1}, [4], -2.7, 1e1, false]}', [-2, 10, 0], False),
    (None, [], True),
]


def test_label_ids(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _, _) in enumerate(IDS)], "i int, c string")
    got = df.select("i", parse_label_ids("c", 3).alias("p")).orderBy("i").collect()
    assert [(r.p.ids, r.p.parse_error is not None) for r in got] == [(ids, bad) for _, ids, bad in IDS]


CATALOGUE = ["Безработица", "Бедность", "Инфляция", "Коррупция", "Наводнения"]
ENGLISH = ["work", "poor", "", "graft", "flood"]


def labelled(spark, **more):
    words = spark.createDataFrame(
        [(label, "en", word) for label, word in zip(CATALOGUE, ENGLISH, strict=True)],
        "label string, lang string, translation string",
    )
    ids = [[1, 3], [2, 99, 1], [], [2, 1, 2], [3], [0, -1]]
    df = spark.createDataFrame(list(enumerate(ids)), "row_id long, label_ids array<int>")
    return attach_labels(df, catalogue_table(spark, CATALOGUE), translations=words, langs=["en"], **more)


WANT = [
    ("Безработица|Инфляция", "Безработица", "work", "work"),
    ("Бедность|Безработица", "Бедность", "poor|work", "poor"),
    ("", "", "", ""),
    ("Бедность|Безработица|Бедность", "Бедность", "poor|work|poor", "poor"),
    ("Инфляция", "Инфляция", "", ""),
    ("", "", "", ""),
]


@pytest.mark.parametrize("more", [{}, {"carried_bytes": 0, "row_id": "row_id"}, {"carried_bytes": 0, "hot_rows": 1}])
def test_labels_of_ids(spark, more):
    got = labelled(spark, **more).orderBy("row_id").collect()
    names = ("problem_russ_candidates", "problem_russ", "problem_en_candidates", "problem_en")
    assert [tuple(r[n] for n in names) for r in got] == WANT


def test_names_are_carried_without_a_shuffle_of_rows_up_to_a_size(spark):
    df = spark.createDataFrame([([1, 2],)], "label_ids array<int>")

    def joins(**more):
        named = attach_labels(df, catalogue_table(spark, CATALOGUE), **more)
        return named._jdf.queryExecution().sparkPlan().toString().count("Join")

    assert joins() == 0
    assert joins(carried_bytes=0) > 0


@pytest.mark.parametrize("more", [{}, {"carried_bytes": 0}])
def test_labels_of_an_empty_list(spark, more):
    df = spark.createDataFrame([([1, None],), (None,), ([],)], "label_ids array<int>")
    empty = spark.createDataFrame([], "label_id int, label string")
    got = attach_labels(df, empty, **more)
    assert rows(got, "problem_russ", "problem_russ_candidates") == [("", "")] * 3
    nameless = spark.createDataFrame([(1, None), (None, "A"), (2, "")], "label_id int, label string")
    assert rows(attach_labels(df, nameless, **more), "problem_russ_candidates") == [("",)] * 3


@pytest.mark.parametrize("carried_bytes", [0, 4 << 20])
def test_three_languages_gaps_nulls_and_many_labels(spark, carried_bytes):
    """Ids with gaps, above 10,000 labels, without a row number; carried to the rows and joined."""
    catalogue = spark.range(1, 12_001).select((F.col("id") * 7).cast("int").alias("label_id"), F.concat(F.lit("L"), "id").alias("label"))
    words = spark.createDataFrame(
        [("L1", lang, f"{lang}1") for lang in ("a", "b", "c")] + [("L1", "a", "z")], "label string, lang string, translation string"
    )
    df = spark.createDataFrame([([84_000, 7],), (None,), ([1, 14],), ([7],), ([7],)], "label_ids array<int>")
    got = attach_labels(df, catalogue, translations=words, langs=["a", "b", "c"], hot_rows=2, carried_bytes=carried_bytes)
    names = ("problem_russ_candidates", "problem_a", "problem_b_candidates", "problem_c")
    assert rows(got, *names) == [("", "", "", ""), ("L1", "a1", "b1", "c1"), ("L1", "a1", "b1", "c1"), ("L12000|L1", "a1", "b1", "c1"), ("L2", "", "", "")]


@pytest.mark.parametrize("more", [{}, {"carried_bytes": 0}])
def test_repeated_ids_end_the_job(spark, more):
    twice = spark.createDataFrame([(1, "A"), (1, "B")], "label_id int, label string")
    df = spark.createDataFrame([([1],)], "label_ids array<int>")
    with pytest.raises(Exception, match="repeated label id 1"):
        attach_labels(df, twice, **more).collect()


def test_prompt_answer_and_label_agree_on_ids_with_gaps(spark):
    catalogue = spark.createDataFrame([(7, "G"), (1, "A"), (3, "C")], "label_id int, label string")
    assert numbered_block(catalogue).head().block == "1. A\n3. C\n7. G"
    df = spark.createDataFrame([([3, 7],)], "label_ids array<int>")
    assert attach_labels(df, catalogue).head().problem_russ_candidates == "C|G"
    answers = spark.createDataFrame([('{"translations": {"en": ["a", "c", "g"]}}', None)], "content string, error string")
    assert rows(parse_translations(answers, catalogue, ["en"])) == [("A", "en", "a"), ("C", "en", "c"), ("G", "en", "g")]


@pytest.mark.parametrize("said", ["sorry", None, "[1]", '{"translations": 3}'])
def test_translation_faults(spark, said):
    answers = spark.createDataFrame([(said, None)], "content string, error string")
    assert "malformed" in translation_fault(answers)
    good = spark.createDataFrame([('{"translations": {}}', None)], "content string, error string")
    assert translation_fault(good) is None


def test_wide_columns(spark):
    df = labelled(spark)
    wide = add_wide_columns(df, [*CATALOGUE, "Бедность"], ["en"])
    flags = [c for c in wide.columns if c.startswith(("ru_", "en_"))]
    assert flags == [f"ru_{c}" for c in CATALOGUE] + ["en_poor", "en_work"]
    for r in wide.collect():
        known = set(r.problem_russ_candidates.split("|")) & set(CATALOGUE)
        assert sum(r[f"ru_{c}"] for c in CATALOGUE) == len(known)
    assert wide.count() == df.count()
    assert rows(observed_labels(df, "problem_en_candidates")) == [("poor",), ("work",)]


MERGE = [
    ("Экология", " ИНФЛЯЦИЯ ", "Экология, климат и загрязнение"),
    ("Pollution", "Засуха", "Экология, климат и загрязнение"),
    ("Коррупция", "стоимость электроэнергии", "Электроэнергия: сбои и высокая стоимость"),
    ("Pollution", None, "Pollution"),
    ("нет", "Засуха", "Экология, климат и загрязнение"),
    ("нет", None, "нет"),
    (None, None, None),
    (None, "инфляция", "Инфляция и рост цен (продукты, топливо)"),
    (" Raw ", "x", " Raw "),
]


def test_merging(spark):
    df = spark.createDataFrame([(i, b, r) for i, (b, r, _) in enumerate(MERGE)], "row_id int, problem string, problem_ru string")
    table = synonym_table(spark)
    got = [r.label for r in merge_labels(df, table).orderBy("row_id").collect()]
    assert got == [m[2] for m in MERGE]
    named = merge_labels(df, table, null_label="nan").orderBy("row_id").collect()
    assert named[6].label == "nan"
    # A synonym in two groups belongs to the group of smaller priority and makes no second row.
    twice = spark.createDataFrame([("a", "second", 2), ("a", "first", 1)], "synonym string, canonical string, priority int")
    small = spark.createDataFrame([(1, "A", None)], "row_id int, problem string, problem_ru string")
    assert rows(merge_labels(small, twice), "label") == [("first",)]


def test_single_label(spark):
    answers = [" floods. ", "НЕТ", "Flooding", "", None, "`'Floods'`", "INFLATION"]
    df = spark.createDataFrame(list(enumerate(answers)), "i int, answer string")
    catalogue = catalogue_table(spark, ["Floods", "Inflation", "FLOODS"])
    got = [r.label for r in parse_single_label(df, catalogue, "answer").orderBy("i").collect()]
    assert got == ["Floods", "нет", "нет", "нет", "нет", "Floods", "Inflation"]


def test_translations(spark):
    answers = spark.createDataFrame([('{"translations": {"en": [" x ", "y", "z"], "fr": ["q"]}}',)], "content string")
    got = rows(parse_translations(answers, catalogue_table(spark, ["A", "B", "A"]), ["en", "sw"]))
    assert got == [("A", "en", "z"), ("B", "en", "y")]


def test_numbered_block(spark):
    catalogue = spark.createDataFrame([(2, None), (1, "A"), (3, "C")], "label_id int, label string")
    assert numbered_block(catalogue).head().block == "1. A\n2. \n3. C"


def test_dedup(spark):
    titles = ["A", "A", None, None, "B"]
    df = spark.createDataFrame(list(enumerate(titles, 1)), "row_id long, title string").repartition(3)
    once = dedup_first(df, "title")
    assert rows(once, "row_id") == [(1,), (3,), (5,)]
    assert rows(dedup_first(once, "title")) == rows(once)
    assert rows(dedup_first(df, "title", nulls="keep"), "row_id") == [(1,), (3,), (4,), (5,)]


def test_first_n_does_not_depend_on_partitions_or_the_group_limit(spark):
    df = spark.range(5000).select((F.col("id") % 3).cast("string").alias("key"), ((F.col("id") * 7919) % 5000).alias("o"))
    want = rows(df.groupBy("key").agg(F.slice(F.array_sort(F.collect_list("o")), 1, 40).alias("o")))
    for parts in (1, 7):
        for rounds in (True, False):
            got = first_n_per_key(df.repartition(parts), "key", "o", 40, two_rounds=rounds)
            listed = got.groupBy("key").agg(F.array_sort(F.collect_list("o")).alias("o"))
            assert rows(listed) == want
    large = first_n_per_key(df, "key", "o", 1500)
    assert large.count() == 4500


def test_rank_is_global(spark):
    counts = [(f"l{i}", 1 + i % 4, (i * 2_000_003) % 9_000_011) for i in range(300)]
    df = spark.createDataFrame(counts, "label string, count bigint, first_row_id bigint")
    want = {c[0]: n for n, c in enumerate(sorted(counts, key=lambda c: (-c[1], c[2], c[0])), 1)}
    assert {r.label: r["rank"] for r in with_rank(df).collect()} == want


def test_distribution(spark):
    labels = ["b", "a", None, "нет", "a", "c", "b", "нет", "нет"]
    df = spark.createDataFrame(list(enumerate(labels)), "row_id long, label string")
    assert rows(distribution(df)) == [("a", 2, 2), ("b", 2, 1), ("c", 1, 3)]
    assert rows(distribution(df, exclude=None))[-1] == ("нет", 3, 1)


def test_columns_named_like_helpers_stay(spark):
    df = spark.createDataFrame(
        [(1, "t", 7, "x", "l"), (2, "t", 8, "y", "m"), (3, None, 9, "z", "l"), (4, None, 1, "z", "l")],
        "row_id int, title string, _position int, _first string, _label string",
    )
    kept = dedup_first(df, "title")
    assert kept.columns == df.columns
    assert rows(kept) == [(1, "t", 7, "x", "l"), (3, None, 9, "z", "l")]
    assert rows(dedup_first(df, "title", nulls="keep"), "row_id") == [(1,), (3,), (4,)]
    dictionary = spark.createDataFrame([("l", "L")], "label string, translation string")
    named = translate_labels(df.withColumnRenamed("title", "entry"), dictionary, "_label", "out")
    assert named.columns == ["row_id", "entry", "_position", "_first", "_label", "out"]
    assert rows(named, "row_id", "out") == [(1, "L"), (2, None), (3, "L"), (4, "L")]


def test_sparse_one_hot_of_twenty_thousand_labels(spark):
    names = [f"label {i * 7919 % 20_000:05d}" for i in range(20_000)]
    catalogue = catalogue_table(spark, names)
    df = spark.range(300).select(
        F.col("id").alias("row_id"),
        F.array(*[(F.col("id") * 67 + k * 331) % 20_000 + 1 for k in range(3)]).cast("array<int>").alias("label_ids"),
    )
    labelled = attach_labels(df, catalogue, row_id="row_id").drop("label_ids")
    labelled = labelled.withColumn("problem_en_candidates", F.lit("b|a|b"))
    flags = label_flags(labelled, langs=["en"])
    vocabulary = label_vocabulary(flags, catalogue)
    numbers = {(r.prefix, r.label): r.column for r in vocabulary.collect()}
    assert len(numbers) == 20_002 and sorted(numbers.values()) == list(range(20_002))
    assert [numbers["ru", n] for n in names[:5]] == [0, 1, 2, 3, 4]
    assert numbers["en", "a"] == 20_000 and numbers["en", "b"] == 20_001
    got = {r.row_id: r.columns for r in sparse_labels(flags, vocabulary).collect()}
    assert all(
        got[i] == sorted({(i * 67 + k * 331) % 20_000 for k in range(3)}) + [20_000, 20_001] for i in range(300)
    )
    assert label_flags(labelled.limit(0), langs=["en"]).collect() == []


def test_hot_labels_are_dealt_out_where_the_side_is_not_broadcast(spark):
    """Nine rows in ten share one label, and some have none; with both plans the result is the same."""
    df = spark.range(4_000).select(
        F.col("id").alias("row_id"),
        F.expr("CASE WHEN id % 20 = 0 THEN NULL WHEN id % 20 = 1 THEN concat('l', id) ELSE 'hot' END").alias("problem"),
        F.lit(7).alias("dealt_lane"),
        F.lit(8).alias("match_problem"),
        F.lit(9).alias("label_found"),
    )
    words = [("hot", "Hot"), *[(f"l{i}", f"L{i}") for i in range(0, 4_000, 2)]]
    dictionary = spark.createDataFrame(words, "label string, translation string")
    synonyms = dictionary.selectExpr("label AS synonym", "translation AS canonical", "1 AS priority")
    catalogue = dictionary.selectExpr("translation AS label", "1 AS label_id")
    jobs = [
        translate_labels(df, dictionary, output="out"),
        merge_labels(df, synonyms, ru=None, output="out"),
        parse_single_label(df, catalogue, "problem", "out"),
    ]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    small = [rows(job, "row_id", "out") for job in jobs]
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for job, want in zip(jobs, small, strict=True):
            # The same plan anew, as settings are read when a query is planned.
            again = job.select("*")
            assert rows(again, "row_id", "out") == want
            in_task = [r["count"] for r in again.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(in_task) == 4_000 and max(in_task) < 2_000
            assert again.columns[:5] == df.columns
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    expected = {i: None if i % 20 == 0 else f"l{i}" if i % 20 == 1 else "hot" for i in range(4_000)}
    known = dict(words)
    assert dict(small[0]) == {i: known.get(x) for i, x in expected.items()}
    assert dict(small[1]) == {i: known.get(x, x) for i, x in expected.items()}
