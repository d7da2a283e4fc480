import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from issuescope.operators import classify, completions
from issuescope.operators.classify import classify_messages, lexicon_classify, memo_rows
from issuescope.operators.completions import (
    CallSettings,
    Prompt,
    answer_table,
    call_tasks,
    classify_requests,
    estimated_tokens,
    read_ledger,
    run_completions,
    sections_from_answers,
    translate_requests,
)
from issuescope.operators.lookup import hot_keys, spread_lookup
from issuescope.operators.report import ORDER_COLUMNS
from issuescope.plans.jobs import (
    classify_job,
    load_messages,
    noted_report_job,
    report_job,
    single_label_job,
    translate_catalogue,
)
from issuescope.session import stage_table, work_dir
from issuescope.sources.catalogue import catalogue_table
from issuescope.sources.memo import read_memo
from issuescope.sources.roles import ColumnRoles

LABELS = ["Безработица", "Бедность", "Инфляция"]


def logged(folder, answer):
    """A model that leaves a line per call, from whatever process it runs in."""

    def complete(model, messages, temperature, max_tokens):
        with open(f"{folder}/calls.txt", "a", encoding="utf-8") as log:
            log.write(json.dumps([model, messages[1]["content"], temperature, max_tokens]) + "\n")
        return answer(model, messages[1]["content"])

    return complete


def calls(folder):
    try:
        with open(f"{folder}/calls.txt", encoding="utf-8") as log:
            return [json.loads(line) for line in log]
    except FileNotFoundError:
        return []


def by_text():
    def answer(model, user):
        if "work" in user:
            content = '{"problem_ids": [1, 3]}'
        elif "bad" in user:
            content = "sorry"
        elif "fail" in user:
            raise RuntimeError("limit")
        else:
            content = "```json\n{\"problem_ids\": [2]}\n```"
        return content, {"prompt_tokens": 10, "completion_tokens": 2}

    return answer


MESSAGES = [(1, " work "), (2, "work"), (3, None), (4, "  "), (5, "bad"), (6, "fail"), (7, "other"), (8, "work")]


def test_identical_texts_are_asked_once_and_remembered(spark, tmp_path):
    df = spark.createDataFrame(MESSAGES, "row_id long, message string").repartition(3)
    catalogue = catalogue_table(spark, LABELS)
    model = logged(tmp_path, by_text())
    for hot_rows in (1, 2, 100):
        start = len(calls(tmp_path))
        table, answers = classify_messages(df, catalogue, model, hot_rows=hot_rows)
        got = {r.row_id: (r.label_ids, r.parse_error is not None) for r in table.collect()}
        table.count()
        assert len(calls(tmp_path)) - start == 4
        assert got == {
            1: ([1, 3], False),
            2: ([1, 3], False),
            3: ([], False),
            4: ([], False),
            5: ([], True),
            6: ([], True),
            7: ([2], False),
            8: ([1, 3], False),
        }
    memo = memo_rows(answers)
    assert memo.count() == 2
    start = len(calls(tmp_path))
    again, _ = classify_messages(df, catalogue, model, memo=memo)
    assert {r.row_id: r.label_ids for r in again.collect()} == {i: ids for i, (ids, _) in got.items()}
    assert len(calls(tmp_path)) - start == 2  # only the two without a good answer
    # Another limit of labels, or another list of labels, is another question.
    classify_messages(df, catalogue, model, memo=memo, max_labels=1)
    classify_messages(df, catalogue_table(spark, LABELS[:2]), model, memo=memo)
    assert len(calls(tmp_path)) - start == 10


def test_answers(spark, tmp_path):
    requests = classify_requests(
        spark.createDataFrame([(1, "a"), (2, "fail"), (3, " ")], "row_id long, message string"),
        catalogue_table(spark, LABELS),
    )

    def plain(model, messages, temperature, max_tokens):
        if "fail" in messages[1]["content"]:
            raise ValueError("no")
        return "  x \n", None if model else {}

    got = rows(run_completions(requests, plain, parallelism=2).drop("model"))
    assert got == [(1, "classify", "x", None, 0, 0, 0), (2, "classify", None, "no", 0, 0, 0)]

    def second_try(model, messages, temperature, max_tokens):
        text = messages[1]["content"]
        with open(f"{tmp_path}/calls.txt", "a+", encoding="utf-8") as log:
            log.seek(0)
            tried = any(json.loads(line)[1] == text for line in log)
            log.write(json.dumps([model, text]) + "\n")
        if "fail" in text and not tried:
            raise ValueError("busy")
        return "ok", {"prompt_tokens": 3, "completion_tokens": 4, "total_tokens": 9}

    table = answer_table(requests, second_try, rounds=3)
    assert rows(table, "request_id", "content", "error", "total_tokens") == [(1, "ok", None, 9), (2, "ok", None, 9)]
    assert len(calls(tmp_path)) == 3


def test_requests(spark):
    catalogue = catalogue_table(spark, LABELS)
    asked = translate_requests(catalogue, ["en", "sw"]).head()
    assert "1. Безработица\n2. Бедность\n3. Инфляция" in asked.messages[1].content
    assert "en, sw" in asked.messages[1].content and (asked.temperature, asked.max_tokens) == (0.0, 2000)
    df = spark.createDataFrame([(1, " " + "я" * 3000)], "row_id long, message string")
    words = spark.createDataFrame([("Бедность", "en", "poor")], "label string, lang string, translation string")
    many = classify_requests(df, catalogue, translations=words, langs=["en"]).head()
    assert "я" * 3000 in many.messages[1].content
    assert "\n[en]\n1. \n2. poor\n3. " in many.messages[1].content
    single = classify_requests(df, catalogue, single=True).head()
    assert single.messages[1].content.endswith("\n " + "я" * 1999) and single.max_tokens == 10


def test_settings_reach_the_model_and_calls_overlap(spark):
    import threading

    df = spark.createDataFrame([(i, f"text {i}") for i in range(8)], "row_id long, message string").coalesce(1)
    prompt = Prompt("S {max_labels}", "U {text}")
    requests = classify_requests(df, catalogue_table(spark, LABELS), prompt=prompt, model="m", temperature=0.7, max_tokens=9)

    def complete(model, messages, temperature, max_tokens):
        # All four calls of a group have to be under way before any of them ends.
        if not hasattr(threading, "_meeting"):
            threading._meeting = threading.Barrier(4, timeout=60)
        threading._meeting.wait()
        return f"{model} {messages[0]['content']} {temperature} {max_tokens}", None

    got = run_completions(requests, complete, calls_per_task=4).collect()
    assert {(r.content, r.error) for r in got} == {("m S 3 0.7 9", None)}
    whole = classify_requests(df, catalogue_table(spark, LABELS), single=True, max_chars=None).head()
    assert "text 0" in whole.messages[1].content


def test_a_broken_translation_stops_before_any_other_call(spark, tmp_path):
    df = spark.createDataFrame([(1, "work")], "row_id long, text string")
    complete = logged(tmp_path, lambda name, user: ("sorry", None))
    with pytest.raises(RuntimeError, match="could not be translated: malformed"):
        classify_job(df, ColumnRoles("text"), catalogue_table(spark, LABELS), complete, ["en"])
    assert len(calls(tmp_path)) == 1
    with pytest.raises(ValueError):
        classify_job(df, ColumnRoles("text"), catalogue_table(spark, LABELS), complete, ["a", "b", "c"])


def test_lexicon(spark):
    df = spark.createDataFrame([(1, "aaaa B b"), (2, "C"), (3, None), (4, "x" * 5000 + " c aa")], "row_id long, message string")
    terms = [(1, "aa"), (2, "b"), (3, "c"), (3, "B ")]
    lexicon = spark.createDataFrame(terms, "label_id int, term string")
    got = {r.row_id: r.label_ids for r in lexicon_classify(df, lexicon).collect()}
    assert got == {1: [1, 2, 3], 2: [3], 3: [], 4: [1, 3]}
    assert [r.label_ids for r in lexicon_classify(df, lexicon, max_labels=1).collect()] == [[1], [3], [], [1]]


def test_lookup_with_hot_keys(spark):
    df = spark.range(3000).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 100).cast("string")).alias("k")
    )
    nulls = spark.range(6000, 8000).select(F.col("id").alias("row_id"), F.lit(None).cast("string").alias("k"))
    df = df.unionByName(spark.createDataFrame([(5000, None), (5001, "unknown")], "row_id long, k string")).unionByName(nulls)
    answers = df.filter("k <> 'unknown'").groupBy("k").agg(F.count("*").alias("n"), F.max("row_id").alias("v"))
    want = rows(df.join(answers.select("k", "v"), "k", "left").select("row_id", "k", "v"))
    for least in (1, 100, 10**6):
        assert rows(spread_lookup(df, answers, "k", "row_id", "n", least)) == want
    assert rows(hot_keys(answers, "k", "n", 100), "k") == [("hot",)]


def test_classify_job(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("Заголовок;Сообщение;x.y z\nt1;work;1\nt1;copy;2\nt2;other;3\n;;4\n;bad;5\n", encoding="utf-8")
    df, roles = load_messages(spark, str(path), require_problem=False)
    assert df.count() == 3  # one of each title; the untitled rows count as one title
    catalogue = catalogue_table(spark, LABELS)

    answer = by_text()

    def model(name, user):
        if "Языки" in user:
            return '{"translations": {"en": ["jobs", "poor", ""]}}', None
        return answer(name, user)

    memo = str(tmp_path / "memo")
    complete = logged(tmp_path, model)
    table, usage = classify_job(df, roles, catalogue, complete, ["en"], wide=True, memo_path=memo)
    got = {r["Заголовок"]: r for r in table.collect()}
    assert (got["t1"].problem_russ_candidates, got["t1"].problem_en_candidates) == ("Безработица|Инфляция", "jobs")
    assert (got["t2"].problem_russ, got["t2"].problem_en) == ("Бедность", "poor")
    assert got["t1"]["ru_Инфляция"] and got["t1"]["en_jobs"] and not got["t2"]["en_jobs"]
    assert got[None].problem_russ == "" and got[None]["x.y z"] == "4"
    assert usage.count() == 3 and read_memo(spark, memo).count() == 2
    before = len(calls(tmp_path))
    classify_job(df, roles, catalogue, complete, ["en"], memo_path=memo)
    assert len(calls(tmp_path)) - before == 1  # the label list only
    with pytest.raises(ValueError):
        classify_job(df, roles, catalogue, complete, [])

    def down(*_):
        raise RuntimeError("down")

    with pytest.raises(RuntimeError, match="down"):
        translate_catalogue(catalogue, ["en"], down)


def test_single_label_job(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b"), (5, " ")], "row_id long, text string")

    def complete(model, messages, temperature, max_tokens):
        return ("'бедность'." if messages[1]["content"].endswith("a") else "иное"), None

    table, usage = single_label_job(df, "text", catalogue_table(spark, LABELS), complete, hot_rows=2)
    assert rows(table, "row_id", "проблема") == [(1, "Бедность"), (2, "Бедность"), (3, "нет"), (4, "нет"), (5, "нет")]
    assert usage.count() == 2


def test_report_job(spark):
    data = [
        (1, "Экология", "m1", None, "u1"),
        (2, "Экология", "m2", "ru", "u2"),
        (3, "Бедность", "lost", None, None),
        (4, "Коррупция", "unedited", "Взятки", None),
        (5, "нет", "x", None, None),
        (6, "Засуха", None, None, None),
    ]
    df = spark.createDataFrame(data, "row_id long, `проблема` string, text string, problem_ru string, link string")
    roles = ColumnRoles("text", "проблема", "problem_ru", "link")

    def complete(model, messages, temperature, max_tokens):
        user = messages[1]["content"]
        if "lost" in user or ("Страна:" in user and "unedited" in user):
            raise RuntimeError("limit (x)")
        body = user if "Страна:" not in user else "Описание проблемы\nтекст\nИсточники\nhttp://a"
        return body, {"prompt_tokens": 10, "completion_tokens": 1}

    report = report_job(df, roles, complete, "Tanzania", dt.datetime(2024, 3, 5), settings=CallSettings(parallelism=2))
    got = [(r.kind, r.text) for r in report.table.orderBy(*ORDER_COLUMNS).collect() if r.part == "sections"]
    failed = ("paragraph", "Не удалось получить анализ. Ошибка: limit (x)")
    assert got == [
        ("section_title", "ru (Экология, климат и загрязнение)"),
        ("subheading", "Описание проблемы"),
        ("paragraph", "текст"),
        ("subheading", "Источники"),
        ("source", "http://a"),
        ("section_title", "Бедность"),
        failed,
        ("section_title", "Взятки"),
        failed,
    ]
    assert rows(report.usage, "stage", "prompt_tokens") == [("edit", 10), ("generate", 10)]
    ranks = {r.label: (r["count"], r["rank"]) for r in report.groups.collect()}
    assert ranks == {"Экология, климат и загрязнение": (3, 1), "Бедность": (1, 2), "Коррупция": (1, 3)}


def test_section_titles_of_failures(spark):
    groups = spark.createDataFrame([("A", None, 1), ("B", "б", 2)], "label string, problem_ru string, rank int")
    answers = "request_id string, content string, error string"
    written = spark.createDataFrame([("A", "x", None), ("B", None, "e")], answers)
    edited = spark.createDataFrame([("A", "y", None)], answers)
    assert rows(sections_from_answers(groups, written, edited), "title", "text", "failed") == [
        ("A", "y", False),
        ("б", "Не удалось получить анализ. Ошибка: e", True),
    ]


def test_work_dir_is_the_one_the_session_names(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_noted_report_job(spark):
    data = [
        (1, "Floods", None, "Потоп", "u0"),
        (2, "Floods", "m1", None, "u1"),
        (3, "Floods", "m2", "Наводнения", "u1"),
        (4, "Poverty", "lost", "Бедность", None),
        (5, "Empty", None, None, None),
    ]
    df = spark.createDataFrame(data, "row_id long, problem string, text string, problem_ru string, link string")

    def complete(model, messages, temperature, max_tokens):
        user = messages[1]["content"]
        if "lost" in user:
            raise RuntimeError("limit")
        assert "- m1\n\n- m2" in user and "- u1" in user and "- u0" not in user
        return "## Суть\n\nтекст\n\n## Выводы\n\nвывод", {"prompt_tokens": 4, "completion_tokens": 1}

    roles = ColumnRoles("text", "problem", "problem_ru", "link")
    report = noted_report_job(df, roles, complete, "Tanzania", dt.datetime(2024, 3, 5))
    got = report.table.orderBy(*ORDER_COLUMNS).collect()
    assert list(dict.fromkeys(r.part for r in got)) == ["title", "date", "description", "distribution", "toc", "sections"]
    assert got[0].text == "Проблемы жителей Танзании: тематический анализ"
    # The first message of the label has no translation, although its first row and a later one have.
    assert [(r.kind, r.text) for r in got if r.part == "sections"] == [
        ("section_title", "Floods"),
        ("subheading", "Суть"),
        ("paragraph", "текст"),
        ("subheading", "Источники и материалы:"),
        ("source", "u1"),
        ("section_title", "Poverty — Бедность"),
        ("paragraph", "Не удалось получить анализ из модели. Ошибка: limit"),
    ]
    assert [r.text for r in got if r.kind == "toc_line"] == ["1. Floods — Потоп", "2. Poverty — Бедность", "3. Empty"]
    counts = {r.text: r.value for r in got if r.kind == "table_row"}
    assert counts == {"Потоп": 1, "Floods": 1, "Наводнения": 1, "Бедность": 1, "Empty": 1}
    assert report.usage.count() == 2


def test_lexicon_of_ten_thousand_terms_in_one_walk(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    words = docs.select(F.explode(F.split(F.lower("text"), r"\s+")).alias("w")).filter("w <> ''").distinct()
    terms = [(i % 50, r.w) for i, r in enumerate(words.orderBy("w").limit(10_000).collect())]
    terms += [(50, terms[0][1]), (51, "aa"), (52, "th")]
    lexicon = spark.createDataFrame(terms, "label_id int, term string")
    got = {r.doc_id: r.label_ids for r in lexicon_classify(docs, lexicon, "text", 5).collect()}
    for r in docs.limit(20).collect():
        scores = {}
        for label_id, term in terms:
            scores[label_id] = scores.get(label_id, 0) + (r.text or "").lower().count(term)
        best = sorted((-n, i) for i, n in scores.items() if n)[:5]
        assert got[r.doc_id] == [i for _, i in best]


def test_lexicon_size_is_checked_and_columns_stay(spark, monkeypatch):
    df = spark.createDataFrame([(1, "Aa aaa", "mine")], "row_id int, message string, _lowered string")
    lexicon = spark.createDataFrame([(1, "aa"), (2, "AAA")], "label_id int, term string")
    assert lexicon_classify(df, lexicon).collect() == [(1, "Aa aaa", "mine", [1, 2])]
    monkeypatch.setattr(classify, "LEXICON_BYTES", 4)
    with pytest.raises(ValueError, match="bytes of terms"):
        lexicon_classify(df, lexicon)


def test_a_list_too_long_for_requests_ends_the_job(spark, monkeypatch):
    df = spark.createDataFrame([(1, "text")], "row_id int, message string")
    catalogue = catalogue_table(spark, ["a" * 50, "b"])
    said = classify_requests(df, catalogue).head().messages[1].content
    assert "1. " + "a" * 50 + "\n2. b" in said
    monkeypatch.setattr(completions, "LIST_CHARS", 20)
    with pytest.raises(Exception, match="too long for a request"):
        classify_requests(df, catalogue).collect()


def plain_requests(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "row_id bigint, message string")
    return stage_table(classify_requests(df, catalogue_table(spark, ["a"]), keep=("row_id",)), "requests")


def test_ledger_pays_only_once_after_a_task_was_killed(spark, tmp_path):
    calls, ledger = tmp_path / "calls", str(tmp_path / "ledger")
    calls.mkdir()

    def counted(deadly):
        def complete(model, messages, temperature, max_tokens):
            import os
            import uuid

            text = messages[1]["content"]
            if deadly and "text 78 " in text:
                os._exit(1)
            (calls / uuid.uuid4().hex).write_text(text)
            return f"said {len(text)}", {"prompt_tokens": 2, "completion_tokens": 1}

        return complete

    requests = plain_requests(spark, [f"text {i} " + "x" * (i % 7) for i in range(160)] + ["text 5 " + "x" * 5] * 3)
    settings = {"parallelism": 2, "ledger": ledger, "calls_per_commit": 5, "keep": ("row_id",)}
    with pytest.raises(Exception):  # noqa: B017
        answer_table(requests, counted(True), **settings)
    kept = read_ledger(spark, ledger).count()
    paid = len(list(calls.iterdir()))
    # One step in sixteen at most is lost.
    assert kept < 160 and paid - kept <= 30
    answers = answer_table(requests, counted(False), **settings)
    assert len(list(calls.iterdir())) == paid + 160 - kept
    assert answers.count() == 163 and answers.filter("error IS NOT NULL OR content IS NULL").count() == 0
    assert answers.schema == answer_table(requests, counted(False), 2, ("row_id",)).schema
    before = len(list(calls.iterdir()))
    answer_table(requests, counted(False), **settings)
    assert len(list(calls.iterdir())) == before


def test_ledger_keeps_no_failures(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    requests = plain_requests(spark, ["good", "bad"])

    def complete(fails):
        def ask(model, messages, temperature, max_tokens):
            if fails and "bad" in messages[1]["content"]:
                raise ValueError("no")
            return "yes", None

        return ask

    first = answer_table(requests, complete(True), ledger=ledger, rounds=2)
    assert rows(first, "request_id", "content", "error") == [(0, "yes", None), (1, None, "no")]
    assert read_ledger(spark, ledger).count() == 1
    assert rows(answer_table(requests, complete(False), ledger=ledger), "content", "error") == [("yes", None)] * 2


def test_steps_of_a_ledger_read_their_own_requests_only(spark, tmp_path):
    n = 60
    requests = plain_requests(spark, [f"text {i}" for i in range(n)])
    passes = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def looked_at(value):
        passes.add(1)
        return value

    requests = requests.withColumn("max_tokens", looked_at.asNondeterministic()("max_tokens").cast("int"))
    complete = lambda model, messages, temperature, max_tokens: (messages[1]["content"], None)
    settings = {"parallelism": 2, "ledger": str(tmp_path / "ledger"), "calls_per_commit": 2}
    answers = answer_table(requests, complete, **settings)
    assert answers.filter("error IS NULL").select("content").distinct().count() == n
    # Once for the digests and once for the requests, not once for each of the 15 steps.
    assert passes.value <= 3 * n


def test_call_tasks_are_even_on_skewed_texts(spark):
    rng = __import__("random").Random(4)
    texts = ["x" * int(20 + rng.paretovariate(1.1) * 50) for _ in range(3000)]
    texts = [t[:6000] for t in texts]
    requests = plain_requests(spark, texts)
    dealt = call_tasks(requests, 8)
    assert dealt.columns == [*requests.columns, "call_task"] and dealt.count() == 3000
    sums = [r.n for r in dealt.groupBy("call_task").agg(F.sum(estimated_tokens()).alias("n")).collect()]
    assert len(sums) == 8 and max(sums) <= 1.2 * sum(sums) / 8
    placed = dealt.repartitionById(8, F.col("call_task")).select("call_task", F.spark_partition_id().alias("p")).distinct()
    assert all(r.p == r.call_task for r in placed.collect())
