import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from issuescope.operators.blocks import filter_blocks, parse_blocks, quote_spans, split_paragraphs
from issuescope.operators.groups import (
    assemble_groups,
    corpus_summary,
    distribution,
    keep_frequent,
    labels_by_lang,
    top_links,
    top_messages,
)
from issuescope.operators.report import (
    ORDER_COLUMNS,
    build_report,
    country_display,
    report_basename,
    report_date,
    section_blocks,
    toc,
)
from issuescope.operators.usage import cost_estimate, price_table, usage_summary

SECTION = "\n".join(
    [
        "Описание проблемы:",
        "Интро.",
        "http://outside.x",
        "ЦИТАТЫ",
        "- one (один)",
        "http://in.q",
        "",
        "Пример 2",
        "  «кавычки»",
        "  indented",
        "Источники:",
        "https://a",
        "https://b",
        "note dropped",
        "https://c",
        "after (x)",
        "Источники",
        "https://d",
    ]
)
BLOCKS = [
    ("subheading", "Описание проблемы:"),
    ("paragraph", "Интро."),
    ("paragraph", "http://outside.x"),
    ("subheading", "ЦИТАТЫ"),
    ("quote", "one (один)"),
    ("quote", "http://in.q"),
    ("subheading", "Пример 2"),
    ("quote", "«кавычки»"),
    ("paragraph", "  indented"),
    ("subheading", "Источники:"),
    ("sources", ["https://a", "https://b"]),
    ("paragraph", "https://c"),
    ("quote", "after (x)"),
    ("subheading", "Источники"),
    ("sources", ["https://d"]),
]


def blocks_of(spark, *texts, **more):
    df = spark.createDataFrame(list(enumerate(texts)), "section_id int, text string")
    parsed = parse_blocks(df, **more).orderBy("section_id", "block_no").collect()
    return [(r.type, r["items"] if r.type == "sources" else r.text) for r in parsed]


def test_section_text(spark):
    assert blocks_of(spark, SECTION) == BLOCKS


def test_line_breaks_and_blanks(spark):
    text = "  \n\r\n a \t\r\nb\x85\x1c c   d  \x0b- e　\r- \r" + "x" * 10 + " " * 50 + "\n\n"
    want = [
        ("paragraph", " a"),
        ("paragraph", "b"),
        ("paragraph", " c   d"),
        ("quote", "e"),
        ("paragraph", "-"),
        ("paragraph", "x" * 10),
    ]
    assert blocks_of(spark, text) == want


def test_modes(spark):
    lines = ["источники", "- x", "https://a", "ИСТОЧНИКИ :", "https://b (x)", "цитаты:", "p", "источники", "пример  3:", "q"]
    assert blocks_of(spark, "\n".join(lines)) == [
        ("subheading", "источники"),
        ("paragraph", "https://a"),
        ("subheading", "ИСТОЧНИКИ :"),
        ("sources", ["https://b (x)"]),
        ("subheading", "цитаты:"),
        ("quote", "p"),
        ("subheading", "источники"),
        ("subheading", "пример  3:"),
        ("paragraph", "q"),
    ]
    # A heading is a whole line; quotes begin with a sign or end in brackets.
    lines = ["Цитаты жителей", "Примеры", "'x", "a) (b", "(a) ", "https://x (y)", "—x", "• "]
    assert blocks_of(spark, "\n".join(lines)) == [
        ("paragraph", "Цитаты жителей"),
        ("paragraph", "Примеры"),
        ("quote", "'x"),
        ("paragraph", "a) (b"),
        ("quote", "(a)"),
        ("quote", "https://x (y)"),
        ("paragraph", "—x"),
        ("paragraph", "•"),
    ]


def by_hand(text):
    """The same rules line by line, for texts whose only line break is \\n."""
    import re

    out, mode, links = [], None, []
    head = re.compile(r"(описание проблемы\s*:?|пример\s+\d+\s*:?|цитаты\s*:?|источники\s*:?)$", re.I)
    for line in [x.rstrip() for x in text.split("\n")] + ["Цитаты"]:
        s = line.strip()
        if mode == "s" and s.startswith(("http://", "https://")):
            links.append(s)
            continue
        if not s:
            continue
        if links:
            out.append(("sources", links))
            links = []
        if head.match(s):
            mode = {"ц": "q", "и": "s"}.get(s.lower()[0])
            out.append(("subheading", s))
        elif mode == "s":
            mode = None
        elif mode == "q" or s.startswith(("- ", "— ", "• ", *'"«“„\'‚')) or (s.endswith(")") and "(" in s):
            out.append(("quote", s[2:].strip() if s.startswith(("- ", "— ", "• ")) else s))
        else:
            out.append(("paragraph", line))
    return out[:-1]


def test_blocks_against_a_plain_loop(spark):
    import random

    pool = ["Источники", "Цитаты:", "Пример 1", "http://a", "https://b (c)", "- x", "  text", "(y)", "", "«z»", "Описание проблемы"]
    rng = random.Random(7)
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "section_id int, text string")
    found = {}
    for r in parse_blocks(df).orderBy("section_id", "block_no").collect():
        found.setdefault(r.section_id, []).append((r.type, r["items"] if r.type == "sources" else r.text))
    for i, text in enumerate(texts):
        assert found.get(i, []) == by_hand(text), text


def test_fallback(spark):
    assert blocks_of(spark, "", None, " \n") == []
    assert blocks_of(spark, "", None, " \n", "x", fallback=True) == [
        ("paragraph", ""),
        ("paragraph", ""),
        ("paragraph", " \n"),
        ("paragraph", "x"),
    ]


def test_block_filter(spark):
    df = spark.createDataFrame(
        [
            (1, "Ok", 0, "subheading", " ИСТОЧНИКИ:", None),
            (1, "Ok", 1, "paragraph", "о Запрете речь", None),
            (1, "Ok", 2, "sources", None, ["http://ban1", "http://ok"]),
            (1, "Ok", 3, "quote", None, None),
            (1, "Ok", 4, "table", "x", None),
            (2, "BAN2 title", 0, "paragraph", "x", None),
            (3, "Ok", 0, "sources", None, ["http://ban1"]),
            (4, "Ok", 0, "sources", None, []),
            (5, "запретный", 0, "paragraph", "незапрете", None),
        ],
        "section_id int, title string, block_no int, type string, text string, items array<string>",
    )
    patterns = [r"\bban\w*\b", r"\bзапрете\b"]
    kept = rows(filter_blocks(df, patterns, "title"), "section_id", "block_no", "items")
    assert kept == [(1, 2, ["http://ok"]), (1, 3, None), (5, 0, None)]
    assert rows(filter_blocks(df), "section_id", "block_no") == [(1, 1), (1, 2), (1, 3), (2, 0), (3, 0), (5, 0)]


def test_paragraphs_and_quotes(spark):
    text = '## A ## b\n\nline 1\nline 2\n\n \n\n##Выводы\n\nвывод: x\n\nsaid "a" and ""b" c "d'
    df = spark.createDataFrame([(1, text)], "section_id int, text string")
    parts = split_paragraphs(df)
    assert [(r.block_no, r.type, r.text) for r in parts.orderBy("block_no").collect()] == [
        (0, "subheading", "A  b"),
        (1, "paragraph", "line 1\nline 2"),
        (2, "paragraph", 'said "a" and ""b" c "d'),
    ]
    runs = quote_spans(parts).filter("block_no = 2").orderBy("run_no").collect()
    assert [(r.kind, r.text) for r in runs] == [
        ("plain", "said "),
        ("quoted", '"a"'),
        ("plain", ' and "'),
        ("quoted", '"b"'),
        ("plain", ' c "d'),
    ]


def message_table(spark):
    data = [
        (1, "A", None, None, "u1", None),
        (2, "A", "  ", "x", "u2", "e1"),
        (3, "A", " first ", "ru", "u2", None),
        (4, "A", "second long", "other", "u3", "e2"),
        (5, "A", "third", None, "u4", None),
        (6, "B", None, "b", "u9", "eb"),
        (7, "B", " ", None, None, None),
        (8, "нет", "text", None, "u1", None),
        (9, None, "text", None, "u1", None),
        (10, "C", "c", None, None, None),
    ]
    return spark.createDataFrame(
        data, "row_id long, label string, message string, problem_ru string, link string, problem_en string"
    )


def test_groups(spark):
    df = message_table(spark).repartition(5)
    got = {r.label: r for r in assemble_groups(df, max_messages=2, max_chars=6).collect()}
    assert set(got) == {"A", "C"}  # B has no usable message
    a, c = got["A"], got["C"]
    assert (a.problem_ru, a.messages, a.links, a["count"], a["rank"]) == ("x", ["first", "second..."], ["u2", "u3", "u4"], 5, 1)
    assert a.labels_by_lang == {"ru": "x", "en": "e1"}
    assert (c.problem_ru, c.messages, c.links, c["count"], c["rank"]) == (None, ["c"], [], 1, 3)
    assert rows(distribution(df)) == [("A", 5, 1), ("B", 2, 2), ("C", 1, 3)]
    assert assemble_groups(df, max_messages=0).count() == 0


def test_parts_of_groups(spark):
    df = message_table(spark).filter("label <> 'нет'")
    assert rows(top_messages(df, max_messages=1), "label", "message") == [("A", "first"), ("C", "c")]
    assert rows(top_links(df), "label", "link") == [("A", "u2"), ("A", "u3"), ("A", "u4")]
    assert rows(labels_by_lang(df).filter("label = 'B'")) == [("B", "en", None), ("B", "ru", None)]
    assert rows(keep_frequent(df), "row_id") == [(i,) for i in range(1, 8)]
    assert tuple(corpus_summary(message_table(spark)).head()) == (10, 6, 8, 4)


def test_a_hot_label_is_counted_whole(spark):
    df = spark.range(20000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("l"), F.col("id") % 50)).alias("label"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("m"), "id")).alias("message"),
        F.concat(F.lit("u"), F.floor(F.col("id") / 100)).alias("link"),
    )
    assert {r.label: r["count"] for r in distribution(df).collect()}["hot"] == 6667
    for parts in (1, 7):
        got = top_messages(df.repartition(parts), max_messages=5).filter("label = 'hot'").orderBy("position")
        assert [r.row_id for r in got.collect()] == [0, 6, 12, 18, 24]
        links = top_links(df.repartition(parts)).filter("label = 'hot'").orderBy("position")
        assert [r.link for r in links.collect()] == ["u0", "u1", "u2"]


def test_usage_and_cost(spark):
    df = spark.createDataFrame(
        [("classify", "gpt-4.1-mini", 600, 300, 900), ("classify", "gpt-4.1-mini", 400, 200, 600), ("edit", "x", 5, 5, 10)],
        "stage string, model string, prompt_tokens long, completion_tokens long, total_tokens long",
    )
    costs = {r.stage: r.usd for r in cost_estimate(df, price_table(spark)).collect()}
    assert abs(costs["classify"] - 0.0012) < 1e-12 and costs["edit"] is None
    totals = {(r.stage, r.model): (r.calls, r.total_tokens) for r in usage_summary(df).collect()}
    assert totals[(None, None)] == (3, 1510) and totals[("classify", None)] == (2, 1500)


AS_OF = dt.datetime(2024, 3, 5, 14, 7)


def test_dates_and_names(spark):
    assert report_date(AS_OF) == "05.03.2024"
    assert report_basename(AS_OF) == "problems_report_20240305_1407"
    df = spark.createDataFrame([("Tanzania",), ("Togo",)], "country string")
    assert rows(country_display(df), "display") == [("Togo",), ("Танзании",)]


def test_report_order(spark):
    sections = spark.createDataFrame(
        [("A", 1, "ru (A)", "Источники\nhttp://a\nhttp://b\n\nИсточники\nhttp://c", False), ("B", 2, "B", "Ошибка (x)\n- y", True)],
        "label string, rank int, title string, text string, failed boolean",
    )
    labels = spark.createDataFrame([("A", 5, 1, "ru"), ("B", 2, 2, None)], "label string, count long, rank int, problem_ru string")
    text = spark.createDataFrame([("about",)], "text string")
    blocks = filter_blocks(section_blocks(sections), (), "title")
    for layout, second in (("report", "toc"), ("notebook", "description")):
        table = build_report(blocks, labels, toc(labels), text, "Togo", AS_OF, layout=layout)
        got = table.orderBy(*ORDER_COLUMNS).collect()
        assert list(dict.fromkeys(r.part for r in got))[2] == second
        assert [(r.kind, r.text) for r in got if r.part == "sections"] == [
            ("section_title", "ru (A)"),
            ("subheading", "Источники"),
            ("source", "http://a"),
            ("source", "http://b"),
            ("subheading", "Источники"),
            ("source", "http://c"),
            ("section_title", "B"),
            ("paragraph", "Ошибка (x)\n- y"),
        ]
        assert [r.text for r in got if r.part == "toc"] == ["Оглавление", "1. A — ru", "2. B"]
        assert [(r.kind, r.value) for r in got if r.part == "distribution"] == [
            ("heading", None),
            ("table_header", None),
            ("table_row", 5),
            ("table_row", 2),
        ]
    empty = build_report(blocks, labels.limit(0), toc(labels.limit(0)), text, "Togo", AS_OF)
    assert empty.filter("part = 'distribution'").count() == 0


def test_a_very_long_text(spark):
    lines = ["Описание проблемы", *[f"line {i} (x)" if i % 3 else f"p {i}" for i in range(60000)], "Источники"]
    text = "\n".join(lines + [f"https://a/{i}" for i in range(30000)])
    df = spark.createDataFrame([(1, text)], "section_id int, text string")
    parsed = filter_blocks(parse_blocks(df, fallback=True), ["line 11 "])
    counts = {r.type: r["count"] for r in parsed.groupBy("type").count().collect()}
    assert counts == {"subheading": 1, "quote": 39999, "paragraph": 20000, "sources": 1}
    links = parsed.filter("type = 'sources'").head()["items"]
    assert len(links) == 30000 and links[-1] == "https://a/29999"
