import hashlib

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from issuescope.sources.catalogue import read_catalogue
from issuescope.operators.classify import match_memo
from issuescope.sources.memo import append_memo, compact_memo, memo_table, read_memo
from issuescope.sources.messages import read_messages
from issuescope.sources.records import LineScanner
from issuescope.sources.roles import resolve_columns
from issuescope.sources.sinks import classified_path, write_classified, write_distribution

SAMPLE = (
    "﻿t;m;l\n"
    "a;b;c\n"
    "short;x\n"
    "long;a;b;c;d\n"
    "\n"
    ";;\n"
    'q;"x;y ""z"";\nw;w;w;w";z\n'
    'qshort;"x;y;z;w;v"\n'
    "gap;a;b;;e\n"
    "gap2;a;b;;;\n"
    "trail;a;b;\n"
    'qlong;"a;b";c;;"e;f"\n'
    "end;1;2\n"
)
KEPT = [
    ("a", "b", "c"),
    ("short", "x", None),
    (None, None, None),
    ("q", 'x;y "z";\nw;w;w;w', "z"),
    ("qshort", "x;y;z;w;v", None),
    ("end", "1", "2"),
]


def test_long_rows_are_skipped_and_short_rows_padded(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text(SAMPLE, encoding="utf-8")
    df = read_messages(spark, str(path))
    assert df.columns == ["row_id", "t", "m", "l"]
    assert [tuple(r)[1:] for r in df.orderBy("row_id").collect()] == KEPT


def test_reading_single_columns_keeps_the_same_rows(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text(SAMPLE, encoding="utf-8")
    df = read_messages(spark, str(path))
    assert df.count() == len(KEPT)
    assert [r.t for r in df.select("row_id", "t").orderBy("row_id").collect()] == [k[0] for k in KEPT]


def test_row_ids_follow_files_and_rows(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    sizes = {"a b.csv": 3, "b.csv": 200, "c.csv": 1, "d.csv": 50}
    for name, n in sizes.items():
        (folder / name).write_text("t;m\n" + "".join(f"{name}-{i};x\n" for i in range(n)), encoding="utf-8")
    df = read_messages(spark, str(folder))
    got = [r.t for r in df.orderBy("row_id").collect()]
    assert got == [f"{name}-{i}" for name, n in sizes.items() for i in range(n)]
    assert df.select("row_id").distinct().count() == len(got)


def test_comma_files_and_missing_values(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('a,b,c\nNA,null,x\n"","N/A",none\n', encoding="utf-8")
    df = read_messages(spark, str(path))
    assert [tuple(r)[1:] for r in df.orderBy("row_id").collect()] == [(None, None, "x"), (None, None, "none")]


def test_headers_that_differ_in_case(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("Проблема;проблема;text\nA;b;c\n", encoding="utf-8")
    df = read_messages(spark, str(path))
    roles = resolve_columns(df)
    assert roles.problem == "проблема"
    assert df.select(roles.problem).head()[0] == "b"


def test_roles(spark):
    df = spark.createDataFrame([("a", "b", "c", "d")], "text string, problem_ru string, problem_russ string, `Ссылка` string")
    roles = resolve_columns(df)
    assert (roles.problem, roles.problem_ru, roles.message, roles.link) == (
        "problem_russ",
        "problem_russ",
        "text",
        "Ссылка",
    )
    with pytest.raises(ValueError, match="message"):
        resolve_columns(df.drop("text"))
    plain = df.select("text")
    with pytest.raises(ValueError, match="label"):
        resolve_columns(plain)
    assert resolve_columns(plain, require_problem=False).problem is None


def test_catalogue(spark, tmp_path):
    path = tmp_path / "labels.txt"
    path.write_text("A\n\n  B \r\nA\n", encoding="utf-8")
    assert rows(read_catalogue(spark, str(path))) == [(1, "A"), (2, "B"), (3, "A")]
    empty = tmp_path / "empty.txt"
    empty.write_text(" \n", encoding="utf-8")
    with pytest.raises(ValueError):
        read_catalogue(spark, str(empty))
    assert read_catalogue(spark, str(empty), allow_empty=True).count() == 0


def test_memo(spark, tmp_path):
    path = str(tmp_path / "memo")
    assert read_memo(spark, path).count() == 0
    new = spark.createDataFrame([("k1", "m", 3, [1, 2]), ("k2", "m", 3, [])], memo_table(spark).schema)
    append_memo(new, path)
    append_memo(new.withColumn("max_labels", F.lit(1)), path, read_memo(spark, path))
    append_memo(new, path, read_memo(spark, path))
    assert rows(read_memo(spark, path), "key", "max_labels") == [("k1", 1), ("k1", 3), ("k2", 1), ("k2", 3)]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame(
        [('x;"y"', "a\nb", "", ["p", "q"]), (None, " s ", "e", [])], "t string, m string, e string, names array<string>"
    )
    write_classified(df.coalesce(1), path, "csv")
    back = read_messages(spark, path).orderBy("row_id")
    assert [tuple(r)[1:] for r in back.collect()] == [('x;"y"', "a\nb", None, "p|q"), (None, " s ", "e", None)]
    assert classified_path("/d/x.csv") == "/d/x_classified.csv"


def test_frequency_table_keeps_labels(spark, tmp_path):
    path = str(tmp_path / "freq")
    ranked = spark.createDataFrame([("b", 2, 2), ("a", 5, 1)], "label string, count bigint, rank int")
    write_distribution(ranked, path)
    back = read_messages(spark, path).orderBy("row_id").collect()
    assert [(r.label, r["count"]) for r in back] == [("a", "5"), ("b", "2")]


def one_piece(spark, path, sep=";"):
    """The rows as Spark's own reader finds them in a whole file."""
    df = (
        spark.read.option("sep", sep).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    )
    return [tuple(r) for r in df.collect()]


def random_field(rng):
    kind = rng.integers(0, 6)
    word = "".join(rng.choice(list('ab é;x"'), int(rng.integers(1, 9))))
    if kind == 0:
        return word.replace(";", "").lstrip('" ') + "u"
    if kind == 1:
        return f'5" {kind}'
    lines = "\n" * int(rng.integers(0, 4)) + word
    return '"' + (lines + word * int(rng.integers(0, 9))).replace('"', '""') + 'z"'


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_files_with_line_breaks_in_fields_are_read_in_pieces(spark, tmp_path, line_end):
    rng = np.random.default_rng(7)
    folder = tmp_path / "pieces"
    folder.mkdir()
    for name in ("a.csv", "b.csv"):
        body = [";".join(random_field(rng) for _ in range(3)) for _ in range(50)]
        body.insert(25, '"' + "long\n" * 60 + '";y;z')
        (folder / name).write_bytes(("a;b;c\n" + "\n".join(body) + "\n").replace("\n", line_end).encode())
    want = one_piece(spark, str(folder / "a.csv")) + one_piece(spark, str(folder / "b.csv"))
    # Spark's reader of whole files makes line ends inside fields alike; here they stay as they are.
    want = [tuple(v and v.replace("\n", line_end) for v in r) for r in want]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("150", "1000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            df = read_messages(spark, str(folder), na_values=())
            got = df.orderBy("row_id").collect()
            assert [tuple(r)[1:] for r in got] == want
            assert len({r.row_id for r in got}) == len(got)
            if size == "150":
                assert df.rdd.getNumPartitions() > 20
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_other_encodings_and_line_ends(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_bytes('t;m\nä;"ö\nü"\n'.encode("iso-8859-1"))
    assert [tuple(r)[1:] for r in read_messages(spark, str(path), encoding="ISO-8859-1").collect()] == [("ä", "ö\nü")]
    old = tmp_path / "old.csv"
    old.write_bytes(b't;m\ra;"b\rc"\rd;e\r')
    assert [tuple(r)[1:] for r in read_messages(spark, str(old)).orderBy("row_id").collect()] == [("a", "b\rc"), ("d", "e")]
    with pytest.raises(ValueError, match="UTF-16"):
        read_messages(spark, str(path), encoding="UTF-16")


def test_quotes_inside_plain_fields_open_nothing():
    scanner = LineScanner(";")
    assert [scanner.after(line, False) for line in (b'a;5" x;b', b'"a', b'"a""', b'"a"";b', b'"a"x;"b', b'""', b"")] == [
        False, True, True, True, True, False, False,
    ]
    assert [scanner.after(line, True) for line in (b"", b'x"', b'x"";', b'x";"y', b'x";5" y', b'"a;"b')] == [
        True, False, True, True, False, True,
    ]


def memo_rows_of(spark, numbers, model="m"):
    rows_ = [(hashlib.sha256(str(i).encode()).hexdigest(), model, 3, [i]) for i in numbers]
    return spark.createDataFrame(rows_, memo_table(spark).schema)


def test_memo_is_joined_where_it_lies_and_pruned(spark, tmp_path):
    path = str(tmp_path / "memo with 'quotes'")
    append_memo(memo_rows_of(spark, range(400)), path, buckets=8)
    append_memo(memo_rows_of(spark, range(400), "other"), path)
    texts = memo_rows_of(spark, [*range(3), 999]).select("key")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        memo = read_memo(spark, path, "m", 3, texts)
        joined = match_memo(texts, memo)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        got = rows(joined, "label_ids")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == sorted([([0],), ([1],), ([2],), (None,)], key=repr)
    # The texts are shuffled to the buckets, the memo is not shuffled.
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan and "part" in plan
    files = {f for f in memo.inputFiles()}
    assert 0 < len(files) < len(set(read_memo(spark, path, "m").inputFiles())) / 2
    assert all("model=m/" in f for f in files)


def test_many_runs_leave_few_files(spark, tmp_path):
    path = str(tmp_path / "memo")
    assert compact_memo(spark, path) is None
    for run in range(5):
        append_memo(memo_rows_of(spark, range(run * 20, run * 20 + 40)), path, buckets=2, compact_after=4)
    memo = read_memo(spark, path)
    assert len(memo.inputFiles()) <= 2 * 16 * 2
    assert sorted(r.label_ids[0] for r in memo.dropDuplicates(["key"]).collect()) == list(range(120))
    old = compact_memo(spark, path)
    memo = read_memo(spark, path)
    assert len(memo.inputFiles()) <= 16 * 2 and memo.count() == 120
    assert old.startswith(path) and read_memo(spark, path, "absent").count() == 0
