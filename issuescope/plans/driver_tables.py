"""Message, answer and section tables made from the shared test tables.

The test tables hold no labels, links or section texts, so these columns are derived from the ones there are:
the base label from the source, the translated label from the language, the link from the page of the same
number.  Every row and every text is kept.  ``*_SQL`` gives the same table in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import LABEL_DICTIONARY, SYNONYM_GROUPS
from ..operators.lookup import literal_table
from ..session import spread_small

# One label holds more than a third of the rows.
PROBLEM_OF_SOURCE = {
    "Экология": ("src0", "src3", "src6", "src9", "src12", "src15", "src18"),
    "Pollution": ("src1", "src7"),
    "Коррупция": ("src2", "src8"),
    "Инфляция": ("src4", "src10"),
    "нет": ("src5", "src14"),
    "Бедность": ("src11", "src13", "src17", "src19"),
}
PROBLEM_OF_LANG = {"de": " ИНФЛЯЦИЯ ", "fr": "стоимость электроэнергии", "es": "Бедность"}
NO_MESSAGE, BLANK_MESSAGE = "src11", "src13"

# (id, term, label, English, Swahili); the terms occur in the test texts, one English name is missing.
CATALOGUE = (
    (1, "thing", "Безработица", "work", "kazi"),
    (2, "nicht", "Бедность", "poor", ""),
    (3, "eaux", "Инфляция", "", "bei"),
    (4, "ation", "Коррупция", "graft", "rushwa"),
    (5, "ción", "Наводнения", "flood", "mafuriko"),
    (6, "the", "Засуха", "drought", "ukame"),
    (7, "der", "Экология", "nature", ""),
)

FENCE = "`" * 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents for work that takes long per text."""
    return spread_small(documents(spark, sf_dir))


def _sql_case(column: str, names: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{v}' THEN '{n}'" for v, n in names.items()) + " END"


_SOURCE_NAMES = {source: label for label, sources in PROBLEM_OF_SOURCE.items() for source in sources}


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id, title, message, problem, problem_ru, problem_en, problem_en_candidates, link."""
    docs = documents(spark, sf_dir)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    joined = docs.join(pages, docs.doc_id == pages.page_id, "left")
    home = F.when(F.col("lang") != "en", F.concat(F.lit("https://"), "source", F.lit(".example.org/"), "lang"))
    return joined.select(
        F.col("doc_id").alias("row_id"),
        F.when(F.col("lang") != "es", F.substring_index("text", "\n", 1)).alias("title"),
        F.when(F.col("source") == BLANK_MESSAGE, F.lit("   "))
        .when(F.col("source") != NO_MESSAGE, F.col("text"))
        .alias("message"),
        F.expr(_sql_case("source", _SOURCE_NAMES)).alias("problem"),
        F.expr(_sql_case("lang", PROBLEM_OF_LANG)).alias("problem_ru"),
        F.when(F.col("lang") != "es", F.concat("source", F.lit("/"), "lang")).alias("problem_en"),
        F.col("source").alias("problem_en_candidates"),
        F.coalesce("url", home).alias("link"),
    )


MESSAGES_SQL = f"""messages AS (
  SELECT d.doc_id AS row_id,
    CASE WHEN d.lang <> 'es' THEN split_part(d.text, chr(10), 1) END AS title,
    CASE WHEN d.source = '{BLANK_MESSAGE}' THEN '   ' WHEN d.source <> '{NO_MESSAGE}' THEN d.text END AS message,
    {_sql_case("d.source", _SOURCE_NAMES)} AS problem,
    {_sql_case("d.lang", PROBLEM_OF_LANG)} AS problem_ru,
    CASE WHEN d.lang <> 'es' THEN d.source || '/' || d.lang END AS problem_en,
    coalesce(p.url, CASE WHEN d.lang <> 'en' THEN 'https://' || d.source || '.example.org/' || d.lang END) AS link
  FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id)"""


def catalogue(spark: SparkSession) -> DataFrame:
    return literal_table(spark, [(c[0], c[2]) for c in CATALOGUE], "label_id int, label string")


def lexicon(spark: SparkSession) -> DataFrame:
    return literal_table(spark, [(c[0], c[1]) for c in CATALOGUE], "label_id int, term string")


def translations(spark: SparkSession) -> DataFrame:
    rows = [(c[2], lang, c[i]) for c in CATALOGUE for lang, i in (("en", 3), ("sw", 4))]
    return literal_table(spark, rows, "label string, lang string, translation string")


CATALOGUE_SQL = (
    "catalogue AS (SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{t}', '{n}', '{e}', '{s}')" for i, t, n, e, s in CATALOGUE)
    + ") AS t(label_id, term, label, label_en, label_sw))"
)

SYNONYMS_SQL = (
    "synonyms AS (SELECT * FROM (VALUES "
    + ", ".join(
        f"('{s}', '{canonical}', {priority})"
        for priority, (canonical, group) in enumerate(SYNONYM_GROUPS, 1)
        for s in group
    )
    + ") AS t(synonym, canonical, priority))"
)

DICTIONARY_SQL = (
    "dictionary AS (SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{label}', '{ru}')" for i, (label, ru) in enumerate(LABEL_DICTIONARY))
    + ") AS t(no, label, translation))"
)


def english_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id, problem: the dictionary label whose place is the number of the source; the last three are unknown."""
    names = F.array(*[F.lit(label) for label, _ in LABEL_DICTIONARY])
    number = F.substr("source", F.lit(4)).cast("int")
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("row_id"),
        F.when(number < 17, F.get(names, number)).otherwise(F.col("source")).alias("problem"),
    )


ENGLISH_SQL = f"""{DICTIONARY_SQL}, english AS (
  SELECT d.doc_id AS row_id, CASE WHEN t.no < 17 THEN t.label ELSE d.source END AS problem
  FROM documents d JOIN dictionary t ON t.no = CAST(substr(d.source, 4) AS INTEGER))"""


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id, stage, model, content, token counts: model answers of every kind, by language and source."""
    content = (
        F.when(F.col("lang") == "fr", f'{FENCE}json\n{{"problem_ids": [2, 99, 1, 3, 4]}}\n{FENCE}')
        .when(F.col("lang") == "de", '{"problem_ids": ["1", 2.9, true, 2, 2]}')
        .when(F.col("lang") == "es", F.concat(F.lit('{"problem_ids": "'), "source", F.lit('"}')))
        .when(F.col("source") == "src0", "not json")
        .when(F.col("source") == "src1", '{"problem_ids": []}')
        .when(F.col("source") == "src2", "[1, 2]")
        .otherwise(
            F.concat(
                F.lit('{"text": '),
                F.char_length("text").cast("string"),
                F.lit(', "problem_ids": ['),
                F.substr("source", F.lit(4)),
                F.lit(", 3, 6]}"),
            )
        )
    )
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("row_id"),
        F.when(F.col("lang") == "en", "classify").when(F.col("lang") == "fr", "generate").otherwise("edit").alias("stage"),
        F.when(F.col("lang") == "en", "gpt-4.1-mini")
        .when(F.col("source") == "src19", "unpriced")
        .otherwise("gpt-4.1")
        .alias("model"),
        content.alias("content"),
        F.col("n_chars").alias("prompt_tokens"),
        F.char_length(F.substring_index("text", "\n", 1)).cast("bigint").alias("completion_tokens"),
    ).withColumn("total_tokens", F.col("prompt_tokens") + F.col("completion_tokens"))


ANSWERS_SQL = f"""answers AS (
  SELECT *, prompt_tokens + completion_tokens AS total_tokens FROM (
    SELECT doc_id AS row_id,
      CASE lang WHEN 'en' THEN 'classify' WHEN 'fr' THEN 'generate' ELSE 'edit' END AS stage,
      CASE WHEN lang = 'en' THEN 'gpt-4.1-mini' WHEN source = 'src19' THEN 'unpriced' ELSE 'gpt-4.1' END AS model,
      CASE WHEN lang = 'fr' THEN concat('{FENCE}json', chr(10), '{{"problem_ids": [2, 99, 1, 3, 4]}}', chr(10), '{FENCE}')
        WHEN lang = 'de' THEN '{{"problem_ids": ["1", 2.9, true, 2, 2]}}'
        WHEN lang = 'es' THEN '{{"problem_ids": "' || source || '"}}'
        WHEN source = 'src0' THEN 'not json'
        WHEN source = 'src1' THEN '{{"problem_ids": []}}'
        WHEN source = 'src2' THEN '[1, 2]'
        ELSE '{{"text": ' || length(text) || ', "problem_ids": [' || substr(source, 4) || ', 3, 6]}}' END AS content,
      n_chars AS prompt_tokens, CAST(length(split_part(text, chr(10), 1)) AS BIGINT) AS completion_tokens
    FROM documents) AS a)"""


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """section_id, title, text: a section around every whole document, with all kinds of lines."""
    first = F.substring_index("text", "\n", 1)
    lines = [
        F.lit("Описание проблемы:"),
        F.col("text"),
        F.concat(F.lit("https://example.org/"), "lang"),
        F.lit("Пример 1"),
        F.concat(F.lit("  "), first),
        F.lit("ЦИТАТЫ:"),
        F.concat(F.lit("- "), first, F.lit(" (x)")),
        F.concat(F.lit("http://quoted.example/"), "source"),
        F.lit(""),
        F.lit("Источники"),
        F.concat(F.lit("https://example.org/"), "source"),
        F.concat(F.lit("https://example.net/"), "lang"),
        F.when(F.col("lang") == "en", first),
        F.lit("http://late.example/x"),
        F.concat(F.lit("«"), first, F.lit("»")),
    ]
    return spread_documents(spark, sf_dir).select(
        F.col("doc_id").alias("section_id"),
        F.concat("source", F.lit(" "), "lang").alias("title"),
        F.concat_ws("\n", *lines).alias("text"),
    )


SECTIONS_SQL = """sections AS (
  SELECT doc_id AS section_id, source || ' ' || lang AS title, concat_ws(chr(10), 'Описание проблемы:', text,
    'https://example.org/' || lang, 'Пример 1', '  ' || first, 'ЦИТАТЫ:', '- ' || first || ' (x)',
    'http://quoted.example/' || source, '', 'Источники', 'https://example.org/' || source,
    'https://example.net/' || lang, CASE WHEN lang = 'en' THEN first END, 'http://late.example/x',
    '«' || first || '»') AS text
  FROM (SELECT *, split_part(text, chr(10), 1) AS first FROM documents) AS d)"""


def noted_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """section_id, text: the documents with marked subheadings, blank lines, quotes and a conclusion."""
    first = F.substring_index("text", "\n", 1)
    return spread_documents(spark, sf_dir).select(
        F.col("doc_id").alias("section_id"),
        F.concat(
            F.lit("## "),
            F.col("source"),
            F.lit(" ##\n\n"),
            F.replace("text", F.lit("\n"), F.lit("\n\n")),
            F.lit("\n\n  \n\nsaid \""),
            first,
            F.lit("\" and \""),
            F.col("lang"),
            F.lit("\"\n\n## Выводы\n\nВывод: "),
            first,
        ).alias("text"),
    )


NOTED_SQL = """noted AS (
  SELECT doc_id AS section_id, concat('## ', source, ' ##', chr(10), chr(10),
    replace(text, chr(10), chr(10) || chr(10)), chr(10), chr(10), '  ', chr(10), chr(10), 'said "',
    split_part(text, chr(10), 1), '" and "', lang, '"', chr(10), chr(10), '## Выводы', chr(10), chr(10),
    'Вывод: ', split_part(text, chr(10), 1)) AS text
  FROM documents)"""
