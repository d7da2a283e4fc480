"""One query per operator over the shared test tables, with the same question in plain SQL."""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import CLASSIFY_MODEL, HEADING_PATTERN, MAX_LABELS, MODEL_PRICES, WHITESPACE
from ..functions.answers import parse_label_ids
from ..functions.text import bullet_list, clean_text, label_key, text_key, truncate_text
from ..operators import blocks as B
from ..operators import classify as C
from ..operators import completions as M
from ..operators import first as P
from ..operators import groups as G
from ..operators import labels as L
from ..operators import report as R
from ..operators import usage as U
from ..session import stage_table, work_dir
from ..sources.catalogue import read_catalogue
from ..sources.memo import append_memo, read_memo
from ..sources.messages import read_messages
from ..sources.sinks import write_classified, write_distribution, write_report
from . import driver_tables as D
from .jobs import load_messages, report_of

AS_OF = dt.datetime(2024, 3, 5, 14, 7)
BANNED = (r"\bsrc7\b", r"ththe\w*", r"example\.net/de")
COUNTRY = "Tanzania"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_WS = f"'{WHITESPACE}'"


def query(sql: str | None):
    """Register a query with its SQL twin."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def _joined(column: str, sep: str = "|"):
    return F.array_join(F.transform(column, lambda x: x.cast("string")), sep).alias(column)


def merged_messages(spark: SparkSession, d: str) -> DataFrame:
    return L.merge_labels(D.messages(spark, d), L.synonym_table(spark))


_KEY = f"lower(trim(coalesce({{}}, ''), {_WS}))"
MERGED_SQL = f"""{D.MESSAGES_SQL}, {D.SYNONYMS_SQL}, merged AS (
  SELECT m.*, coalesce(CASE WHEN b.priority IS NULL OR r.priority < b.priority THEN r.canonical ELSE b.canonical END,
    m.problem) AS label
  FROM messages m LEFT JOIN synonyms b ON b.synonym = {_KEY.format("m.problem")}
  LEFT JOIN synonyms r ON r.synonym = {_KEY.format("m.problem_ru")})"""

COUNTS_SQL = f"""{MERGED_SQL}, counted AS (
  SELECT label, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, min(row_id), label) AS rank
  FROM merged WHERE label IS NOT NULL AND label <> 'нет' GROUP BY label)"""


def _short_sql(column: str, n: int) -> str:
    s = f"trim({column}, {_WS})"
    return f"nullif(CASE WHEN length({s}) > {n} THEN substr({s}, 1, {n}) || '...' ELSE {s} END, '')"


# ---------------------------------------------------------------- messages in


@query(
    f"""WITH {D.MESSAGES_SQL}
    SELECT row_id, title, message FROM (
      SELECT *, row_number() OVER (PARTITION BY title ORDER BY row_id) AS n FROM messages) AS t WHERE n = 1"""
)
def dedup_first_title(spark, d):
    return P.dedup_first(D.messages(spark, d).select("row_id", "title", "message"), "title")


@query(
    f"""WITH {D.MESSAGES_SQL}
    SELECT row_id, title FROM (
      SELECT *, row_number() OVER (PARTITION BY title ORDER BY row_id) AS n FROM messages) AS t
    WHERE n = 1 OR title IS NULL"""
)
def dedup_keep_untitled(spark, d):
    return P.dedup_first(D.messages(spark, d).select("row_id", "title"), "title", nulls="keep")


@query(
    f"""SELECT doc_id, trim(coalesce(text, ''), {_WS}) AS clean, {_short_sql("text", 2000)} AS short,
      substr(text, 1, 2000) AS sent, lower(trim(coalesce(source, ''), {_WS})) AS key FROM documents"""
)
def clean_truncate(spark, d):
    return D.documents(spark, d).select(
        "doc_id",
        clean_text("text").alias("clean"),
        truncate_text("text", 2000).alias("short"),
        F.substring("text", 1, 2000).alias("sent"),
        label_key("source").alias("key"),
    )


_LABELS = [c[2] for c in D.CATALOGUE]


@query(
    f"""SELECT substr(sha256(concat(trim(text, {_WS}), '|{"|".join(_LABELS)}')), 1, 16) AS key,
      count(*) AS copies, CAST(max(length(trim(text, {_WS}))) AS BIGINT) AS chars FROM documents GROUP BY 1"""
)
def text_key_distinct(spark, d):
    keyed = D.documents(spark, d).select(
        "doc_id", clean_text("text").alias("text"), text_key(clean_text("text"), _LABELS).alias("key")
    )
    texts = C.distinct_texts(keyed, "key", "text", "doc_id")
    return texts.select("key", "copies", F.char_length("text").cast("long").alias("chars"))


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(source, '') AS source, nullif(text, '') AS text FROM documents"""
)
def csv_round_trip(spark, d):
    path = f"{work_dir(spark)}/issuescope/csv-{uuid.uuid4().hex}"
    write_classified(D.documents(spark, d).select("doc_id", "source", "text"), path, "csv")
    return read_messages(spark, path).drop("row_id")


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id % 3 <> 2 THEN nullif(source, '') END AS source,
      nullif(text, '') AS text FROM documents WHERE doc_id % 3 <> 1"""
)
def ragged_round_trip(spark, d):
    """Files as other programs write them: quoted texts with line breaks and quotes, too many fields, too few."""
    path = f"{work_dir(spark)}/issuescope/ragged-{uuid.uuid4().hex}"
    said = F.concat(F.lit('"'), F.replace(F.coalesce("text", F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    rest = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(";"), "source"))
    more = F.when(F.col("doc_id") % 3 == 1, F.lit(';"one";too many'))
    fields = [F.col("doc_id").cast("string"), F.lit(";"), said, F.coalesce(rest, more, F.lit(""))]
    lines = D.documents(spark, d).select(F.concat(*fields).alias("value"))
    lines.mapInArrow(_with_header("doc_id;text;source"), "value string").write.text(path)
    return read_messages(spark, path).drop("row_id")


def _with_header(header: str):
    """Put a line in front of every task's rows, which become one file."""

    def start(batches):
        first = True
        for batch in batches:
            if first and batch.num_rows:
                yield pa.RecordBatch.from_pydict({"value": [header]})
                first = False
            yield batch

    return start


# ---------------------------------------------------------------- labels

_SCORES_SQL = f"""{D.CATALOGUE_SQL}, scores AS (
  SELECT d.doc_id, c.label_id, c.label, len(string_split(lower(d.text), c.term)) - 1 AS score
  FROM documents d, catalogue c), best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label_id) AS n FROM scores WHERE score > 0)"""


@query(
    f"""WITH {_SCORES_SQL}
    SELECT d.doc_id, coalesce(string_agg(CAST(b.label_id AS VARCHAR), '|' ORDER BY b.n), '') AS label_ids
    FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id AND b.n <= 3 GROUP BY d.doc_id"""
)
def lexicon_multi_label(spark, d):
    docs = D.spread_documents(spark, d).select("doc_id", "text")
    return C.lexicon_classify(docs, D.lexicon(spark), "text").select("doc_id", _joined("label_ids"))


@query(
    f"""WITH {_SCORES_SQL}
    SELECT d.doc_id, coalesce(b.label, 'нет') AS label
    FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id AND b.n = 1"""
)
def lexicon_single_label(spark, d):
    docs = D.spread_documents(spark, d).select("doc_id", "text")
    one = C.lexicon_classify(docs, D.lexicon(spark), "text", max_labels=1).select("doc_id", "label_ids")
    named = L.attach_labels(one, D.catalogue(spark), row_id="doc_id")
    answer = F.concat(F.lit(" «"), "problem_russ", F.lit("». "))
    said = named.select("doc_id", F.translate(answer, "«»", '""').alias("answer"))
    return L.parse_single_label(said, D.catalogue(spark), "answer").select("doc_id", "label")


@query(f"WITH {MERGED_SQL} SELECT row_id, label FROM merged")
def merge_synonyms(spark, d):
    return merged_messages(spark, d).select("row_id", "label")


@query(f"WITH {COUNTS_SQL} SELECT label, count, rank FROM counted")
def distribution_merged(spark, d):
    return G.distribution(merged_messages(spark, d))


@query(
    f"""WITH {_SCORES_SQL}, {D.SYNONYMS_SQL}, first_titles AS (
      SELECT doc_id FROM (
        SELECT doc_id, row_number() OVER (PARTITION BY split_part(text, chr(10), 1) ORDER BY doc_id) AS n FROM documents) AS t
      WHERE n = 1), named AS (
      SELECT f.doc_id, coalesce(s.canonical, b.label) AS label
      FROM first_titles f JOIN best b ON b.doc_id = f.doc_id AND b.n = 1
      LEFT JOIN synonyms s ON s.synonym = lower(b.label))
    SELECT label, count(*) AS count,
      row_number() OVER (ORDER BY count(*) DESC, min(doc_id), label) AS rank FROM named GROUP BY label"""
)
def issue_distribution(spark, d):
    """Raw texts to a ranked table of merged labels: first of each title, labelled by terms, merged, counted."""
    docs = D.documents(spark, d).select(
        F.col("doc_id").alias("row_id"), F.substring_index("text", "\n", 1).alias("title"), "text"
    )
    first = P.dedup_first(docs, "title")
    labelled = L.attach_labels(
        C.lexicon_classify(first, D.lexicon(spark), "text", 1).select("row_id", "label_ids"), D.catalogue(spark)
    )
    named = labelled.select("row_id", F.nullif("problem_russ", F.lit("")).alias("problem"))
    return G.distribution(L.merge_labels(named, L.synonym_table(spark), ru=None))


@query(
    f"""WITH {D.MESSAGES_SQL}
    SELECT coalesce(problem_ru, problem) AS label, count(*) AS count,
      row_number() OVER (ORDER BY count(*) DESC, min(row_id)) AS rank
    FROM messages WHERE coalesce(problem_ru, problem) IS NOT NULL GROUP BY 1"""
)
def distribution_fallback(spark, d):
    named = D.messages(spark, d).select("row_id", F.coalesce("problem_ru", "problem").alias("label"))
    return G.distribution(named, exclude=None)


_TITLES_SQL = "titled AS (SELECT doc_id AS row_id, split_part(text, chr(10), 1) AS title FROM documents)"


@query(
    f"""WITH {_TITLES_SQL}
    SELECT title AS label, count(*) AS count,
      row_number() OVER (ORDER BY count(*) DESC, min(row_id), title) AS rank FROM titled GROUP BY title"""
)
def distribution_titles(spark, d):
    """Free text as the label: far more labels than a catalogue has."""
    return G.distribution(_titled(spark, d), label="title", exclude=None)


@query(
    f"""WITH {D.ENGLISH_SQL}
    SELECT t.translation AS label, count(*) AS count,
      row_number() OVER (ORDER BY count(*) DESC, min(row_id)) AS rank
    FROM english e JOIN dictionary t ON t.label = e.problem GROUP BY t.translation"""
)
def value_counts_translated(spark, d):
    translated = L.translate_labels(D.english_messages(spark, d), L.dictionary_table(spark))
    return G.distribution(translated, label="problem_russ", exclude=None)


@query(
    f"""WITH {_TITLES_SQL}
    SELECT title AS label, count(*) AS count FROM titled GROUP BY title HAVING count(*) > 1"""
)
def frequent_labels(spark, d):
    return G.frequent_labels(_titled(spark, d), "title", exclude=None)


@query(
    f"""WITH {_TITLES_SQL}
    SELECT row_id, title FROM titled WHERE title <> 'нет'
      AND title IN (SELECT title FROM titled GROUP BY title HAVING count(*) > 1)"""
)
def keep_frequent(spark, d):
    return G.keep_frequent(_titled(spark, d), "title")


def _titled(spark, d):
    return D.documents(spark, d).select(
        F.col("doc_id").alias("row_id"), F.substring_index("text", "\n", 1).alias("title")
    )


@query(
    f"""WITH {D.ENGLISH_SQL}
    SELECT e.row_id, e.problem, t.translation AS problem_russ
    FROM english e LEFT JOIN dictionary t ON t.label = e.problem"""
)
def translate_dictionary(spark, d):
    return L.translate_labels(D.english_messages(spark, d), L.dictionary_table(spark))


# The third CASE keeps a JSON text from being typed when it is none.
_IDS_SQL = f"""{D.ANSWERS_SQL}, bare AS (
  SELECT row_id, CASE WHEN starts_with(trim(content, {_WS}), '{D.FENCE}')
    THEN regexp_replace(trim(trim(content, {_WS}), '`'), '^(?i:json|javascript|js)' || chr(10), '')
    ELSE trim(content, {_WS}) END AS body FROM answers), docs AS (
  SELECT row_id, CASE WHEN json_valid(body) AND json_type(CAST(body AS JSON)) = 'OBJECT' THEN CAST(body AS JSON) END AS doc
  FROM bare), given AS (
  SELECT row_id, unnest(CASE WHEN json_type(doc -> 'problem_ids') = 'ARRAY' THEN CAST(doc -> 'problem_ids' AS JSON[]) END) AS item,
    generate_subscripts(CASE WHEN json_type(doc -> 'problem_ids') = 'ARRAY' THEN CAST(doc -> 'problem_ids' AS JSON[]) END, 1) AS pos
  FROM docs), numbers AS (
  SELECT row_id, row_number() OVER (PARTITION BY row_id ORDER BY pos) AS n,
    CASE WHEN json_type(item) = 'BOOLEAN' THEN CAST(CAST(item AS BOOLEAN) AS INTEGER)
      ELSE CAST(trunc(CAST(item AS DOUBLE)) AS INTEGER) END AS label_id
  FROM given WHERE json_type(item) IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'BOOLEAN')), ids AS (
  SELECT * FROM numbers WHERE n <= 3)"""


@query(
    f"""WITH {_IDS_SQL}
    SELECT d.row_id, coalesce(string_agg(CAST(i.label_id AS VARCHAR), '|' ORDER BY i.n), '') AS label_ids,
      d.doc IS NULL AS failed
    FROM docs d LEFT JOIN ids i ON i.row_id = d.row_id GROUP BY d.row_id, d.doc IS NULL"""
)
def parse_ids(spark, d):
    parsed = D.answers(spark, d).select("row_id", parse_label_ids("content", 3).alias("p"))
    return parsed.select(
        "row_id",
        F.col("p.ids").alias("label_ids"),
        F.col("p.parse_error").isNotNull().alias("failed"),
    ).withColumn("label_ids", _joined("label_ids"))


def _label_ids(spark, d):
    return D.answers(spark, d).select("row_id", parse_label_ids("content", 3).getField("ids").alias("label_ids"))


@query(
    f"""WITH {_IDS_SQL}, {D.CATALOGUE_SQL}
    SELECT a.row_id, coalesce(string_agg(c.label, '|' ORDER BY i.n), '') AS problem_russ_candidates,
      coalesce(arg_min(c.label, i.n), '') AS problem_russ
    FROM answers a LEFT JOIN (ids i JOIN catalogue c ON c.label_id = i.label_id) ON i.row_id = a.row_id GROUP BY a.row_id"""
)
def ids_to_labels(spark, d):
    return L.attach_labels(_label_ids(spark, d), D.catalogue(spark)).drop("label_ids")


_WIDE_LABELS_SQL = f"""{_IDS_SQL}, {D.CATALOGUE_SQL}, wide AS (
  SELECT a.row_id, coalesce(string_agg(c.label, '|' ORDER BY i.n), '') AS ru,
    coalesce(string_agg(c.label_en, '|' ORDER BY i.n) FILTER (c.label_en <> ''), '') AS en,
    coalesce(arg_min(c.label_en, i.n) FILTER (c.label_en <> ''), '') AS first_en,
    coalesce(string_agg(c.label_sw, '|' ORDER BY i.n) FILTER (c.label_sw <> ''), '') AS sw,
    coalesce(arg_min(c.label_sw, i.n) FILTER (c.label_sw <> ''), '') AS first_sw
  FROM answers a LEFT JOIN (ids i JOIN catalogue c ON c.label_id = i.label_id) ON i.row_id = a.row_id GROUP BY a.row_id)"""


def _multilang(spark, d):
    return L.attach_labels(
        _label_ids(spark, d), D.catalogue(spark), translations=D.translations(spark), langs=("en", "sw")
    ).drop("label_ids")


@query(
    f"""WITH {_WIDE_LABELS_SQL}
    SELECT row_id, ru AS problem_russ_candidates, split_part(ru, '|', 1) AS problem_russ, en AS problem_en_candidates,
      first_en AS problem_en, sw AS problem_sw_candidates, first_sw AS problem_sw FROM wide"""
)
def labels_multilang(spark, d):
    return _multilang(spark, d)


@query(
    f"""WITH {_WIDE_LABELS_SQL}
    SELECT row_id, ru AS problem_russ_candidates, split_part(ru, '|', 1) AS problem_russ, en AS problem_en_candidates,
      first_en AS problem_en, sw AS problem_sw_candidates, first_sw AS problem_sw FROM wide"""
)
def labels_multilang_joined(spark, d):
    """The same as for a list too long to be carried to the rows, with every repeated list of ids spread."""
    return L.attach_labels(
        _label_ids(spark, d),
        D.catalogue(spark),
        translations=D.translations(spark),
        langs=("en", "sw"),
        row_id="row_id",
        hot_rows=2,
        carried_bytes=0,
    ).drop("label_ids")


_WORDS = ("Nicht", "In", "Letre", "The", "Du", "Thnt", "Der", "De")


@query(
    f"""WITH labels_known AS (SELECT * FROM (VALUES {", ".join(f"('{w}')" for w in _WORDS)}) AS t(label)),
      said AS (SELECT doc_id, ' «' || upper(split_part(split_part(text, chr(10), 1), ' ', 1)) || '». ' AS answer FROM documents)
    SELECT s.doc_id, coalesce(k.label, 'нет') AS label
    FROM (SELECT doc_id, lower(trim(trim(translate(answer, '«»', '""'), {_WS}), ' .,:;"''`')) AS key FROM said) AS s
    LEFT JOIN labels_known k ON lower(k.label) = s.key"""
)
def parse_single(spark, d):
    from ..sources.catalogue import catalogue_table

    word = F.split_part(F.substring_index("text", "\n", 1), F.lit(" "), F.lit(1))
    answer = F.translate(F.concat(F.lit(" «"), F.upper(word), F.lit("». ")), "«»", '""')
    said = D.documents(spark, d).select("doc_id", answer.alias("answer"))
    return L.parse_single_label(said, catalogue_table(spark, _WORDS), "answer").select("doc_id", "label")


@query(
    f"""WITH {_WIDE_LABELS_SQL}
    SELECT row_id, {", ".join(f"list_contains(string_split(ru, '|'), '{n}') AS \"ru_{n}\"" for n in _LABELS)},
      {", ".join(f"list_contains(string_split(en, '|'), '{n}') AS \"en_{n}\"" for n in ("drought", "flood", "graft", "nature", "poor", "work"))}
    FROM wide"""
)
def wide_onehot(spark, d):
    labelled = _multilang(spark, d)
    wide = L.add_wide_columns(labelled, _LABELS, ("en",))
    return wide.drop(*[c for c in labelled.columns if c != "row_id"])


@query(
    f"""WITH {_WIDE_LABELS_SQL}, flags AS (
      SELECT row_id, 'ru' AS prefix, unnest(list_distinct(string_split(ru, '|'))) AS label FROM wide WHERE ru <> ''
      UNION ALL SELECT row_id, 'en', unnest(list_distinct(string_split(en, '|'))) FROM wide WHERE en <> ''
      UNION ALL SELECT row_id, 'sw', unnest(list_distinct(string_split(sw, '|'))) FROM wide WHERE sw <> ''), vocabulary AS (
      SELECT 'ru' AS prefix, label, label_id - 1 AS col FROM catalogue UNION ALL
      SELECT prefix, label, (SELECT count(*) FROM catalogue) + row_number() OVER (ORDER BY prefix, label) - 1
      FROM (SELECT DISTINCT prefix, label FROM flags WHERE prefix <> 'ru') AS t)
    SELECT row_id, string_agg(CAST(col AS VARCHAR), '|' ORDER BY col) AS columns
    FROM flags JOIN vocabulary USING (prefix, label) GROUP BY row_id"""
)
def sparse_onehot(spark, d):
    """The wide table without a column per label: the numbers of the true ones."""
    flags = L.label_flags(_multilang(spark, d), langs=("en", "sw"))
    vocabulary = stage_table(L.label_vocabulary(flags, D.catalogue(spark)), "vocabulary")
    return L.sparse_labels(flags, vocabulary).select("row_id", _joined("columns"))


@query(
    f"""WITH {_WIDE_LABELS_SQL}
    SELECT DISTINCT unnest(string_split(sw, '|')) AS label FROM wide WHERE sw <> ''"""
)
def observed_labels(spark, d):
    return L.observed_labels(_multilang(spark, d), "problem_sw_candidates")


_SOURCE_LIST_SQL = """sources AS (
  SELECT source AS label, CAST(row_number() OVER (ORDER BY count(*) DESC, min(doc_id)) AS INTEGER) AS label_id
  FROM documents GROUP BY source)"""


def _source_list(spark, d):
    """The sources as a catalogue: a label list that comes from the data."""
    ranked = G.distribution(D.documents(spark, d), "source", "doc_id", exclude=None)
    return ranked.select(F.col("rank").alias("label_id"), "label")


@query(
    f"""WITH {_SOURCE_LIST_SQL}
    SELECT string_agg(label_id || '. ' || label, chr(10) ORDER BY label_id) AS block FROM sources"""
)
def numbered_block(spark, d):
    return L.numbered_block(_source_list(spark, d))


@query(
    f"""WITH {_SOURCE_LIST_SQL}
    SELECT label, 'en' AS lang, upper(label) AS translation FROM sources
    UNION ALL SELECT label, 'sw', '' FROM sources WHERE label_id <= 5"""
)
def parse_translations(spark, d):
    names = _source_list(spark, d)
    listed = F.array_sort(F.collect_list(F.struct("label_id", "label")))
    padded = F.transform(listed, lambda x: F.concat(F.lit(" "), F.upper(x.getField("label")), F.lit("\n")))
    blanks = F.transform(F.slice(padded, 1, 5), lambda x: F.lit(" "))
    content = F.to_json(
        F.struct(F.create_map(F.lit("en"), padded, F.lit("sw"), blanks, F.lit("fr"), padded).alias("translations"))
    )
    return L.parse_translations(names.agg(content.alias("content")), names, ("en", "sw"))


# ---------------------------------------------------------------- groups


@query(
    f"""WITH {MERGED_SQL}, usable AS (SELECT label, row_id, {_short_sql("message", 2000)} AS message FROM merged)
    SELECT label, row_id, message, CAST(position AS INTEGER) AS position FROM (
      SELECT *, row_number() OVER (PARTITION BY label ORDER BY row_id) AS position
      FROM usable WHERE label IS NOT NULL AND message IS NOT NULL) AS t WHERE position <= 30"""
)
def top_messages(spark, d):
    return G.top_messages(merged_messages(spark, d))


_LINKS_SQL = """links AS (
  SELECT label, link, row_number() OVER (PARTITION BY label ORDER BY min(row_id)) AS position
  FROM merged WHERE label IS NOT NULL AND message IS NOT NULL AND link IS NOT NULL GROUP BY label, link)"""


@query(
    f"""WITH {MERGED_SQL}, {_LINKS_SQL}
    SELECT label, link, CAST(position AS INTEGER) AS position FROM links WHERE position <= 3"""
)
def top_links(spark, d):
    return G.top_links(merged_messages(spark, d))


@query(
    f"""WITH {MERGED_SQL}
    SELECT label, arg_min(problem_ru, row_id) FILTER (problem_ru IS NOT NULL) AS problem_ru
    FROM merged WHERE message IS NOT NULL GROUP BY label"""
)
def first_non_null_label(spark, d):
    return P.first_non_null(
        merged_messages(spark, d), "label", "problem_ru", usable=F.col("message").isNotNull()
    )


@query(
    f"""WITH {MERGED_SQL}
    SELECT label, problem_ru FROM (
      SELECT *, row_number() OVER (PARTITION BY label ORDER BY row_id) AS n FROM merged) AS t WHERE n = 1"""
)
def first_row_label(spark, d):
    return P.first_row_value(merged_messages(spark, d), "label", "problem_ru")


@query(
    f"""WITH {MERGED_SQL}, kept AS (SELECT * FROM merged WHERE label <> 'нет')
    SELECT label, 'ru' AS lang, arg_min(problem_ru, row_id) FILTER (message IS NOT NULL AND problem_ru IS NOT NULL) AS value
    FROM kept GROUP BY label
    UNION ALL SELECT label, 'en', arg_min(problem_en, row_id) FILTER (message IS NOT NULL AND problem_en IS NOT NULL)
    FROM kept GROUP BY label"""
)
def labels_by_lang(spark, d):
    return G.labels_by_lang(merged_messages(spark, d))


GROUPS_SQL = f"""{COUNTS_SQL}, {_LINKS_SQL}, usable AS (
  SELECT label, row_id, {_short_sql("message", 2000)} AS message FROM merged), firsts AS (
  SELECT label, string_agg(message, '\n\n' ORDER BY row_id) AS messages FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY row_id) AS n FROM usable WHERE message IS NOT NULL) AS t
  WHERE n <= 30 GROUP BY label), heads AS (
  SELECT label, arg_min(problem_ru, row_id) FILTER (problem_ru IS NOT NULL) AS problem_ru,
    arg_min(problem_en, row_id) FILTER (problem_en IS NOT NULL) AS problem_en
  FROM merged WHERE message IS NOT NULL GROUP BY label), link_lists AS (
  SELECT label, string_agg(link, '\n' ORDER BY position) AS links FROM links WHERE position <= 3 GROUP BY label), groups_ AS (
  SELECT c.label, h.problem_ru, h.problem_en, f.messages, coalesce(l.links, '') AS links, c.count, c.rank
  FROM counted c JOIN firsts f ON f.label = c.label LEFT JOIN heads h ON h.label = c.label
  LEFT JOIN link_lists l ON l.label = c.label)"""


def _groups(spark, d):
    return G.assemble_groups(merged_messages(spark, d))


@query(f"WITH {GROUPS_SQL} SELECT * FROM groups_")
def group_records(spark, d):
    return _groups(spark, d).select(
        "label",
        "problem_ru",
        F.col("labels_by_lang")["en"].alias("problem_en"),
        _joined("messages", "\n\n"),
        _joined("links", "\n"),
        "count",
        "rank",
    )


@query(
    f"""WITH {D.MESSAGES_SQL}
    SELECT count(*) AS n_rows, CAST(8 AS BIGINT) AS n_columns, count(message) AS n_messages,
      count(DISTINCT problem) AS n_labels FROM messages"""
)
def corpus_summary(spark, d):
    return G.corpus_summary(D.messages(spark, d), label="problem")


# ---------------------------------------------------------------- requests and answers

_LIST_BLOCK = "\n".join(f"{i}. {name}" for i, name in enumerate(_LABELS, 1))
_EN_BLOCK = "\n[en]\n" + "\n".join(f"{i}. {c[3]}" for i, c in enumerate(D.CATALOGUE, 1))


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_prompt(template: str, **values: str) -> str:
    """A template as a SQL expression; values are SQL expressions."""
    parts = re.split(r"\{(\w+)\}", template.replace("{{", "\0").replace("}}", "\1"))
    literal = [_sql_text(p.replace("\0", "{").replace("\1", "}")) if i % 2 == 0 else values[p] for i, p in enumerate(parts)]
    return f"trim(concat({', '.join(literal)}), ' ' || chr(10))"


_CLASSIFY_SQL = _sql_prompt(
    M.CLASSIFY_PROMPT.user,
    text="clean",
    labels=_sql_text(_LIST_BLOCK),
    translations=_sql_text(_EN_BLOCK),
    max_labels="'3'",
)


def _request_parts(requests):
    return requests.select(
        "request_id",
        "stage",
        "model",
        F.col("messages")[0]["content"].alias("system"),
        F.col("messages")[1]["content"].alias("user"),
        "temperature",
        "max_tokens",
    )


@query(
    f"""SELECT doc_id AS request_id, 'classify' AS stage, 'gpt-4.1-mini' AS model,
      {_sql_text(M.CLASSIFY_PROMPT.system)} AS system, {_CLASSIFY_SQL} AS "user",
      CAST(0 AS DOUBLE) AS temperature, 800 AS max_tokens
    FROM (SELECT *, trim(text, {_WS}) AS clean FROM documents) AS t WHERE clean <> ''"""
)
def classify_requests(spark, d):
    return _request_parts(
        M.classify_requests(
            D.documents(spark, d),
            D.catalogue(spark),
            "text",
            "doc_id",
            translations=D.translations(spark),
            langs=("en",),
        )
    )


_SINGLE_SQL = _sql_prompt(
    M.SINGLE_LABEL_PROMPT.user, text="substr(message, 1, 2000)", labels=_sql_text(", ".join(_LABELS))
)


@query(
    f"""WITH {D.MESSAGES_SQL}
    SELECT row_id AS request_id, 'classify' AS stage, 'gpt-4.1-mini' AS model,
      {_sql_text(M.SINGLE_LABEL_PROMPT.system)} AS system, {_SINGLE_SQL} AS "user",
      CAST(0 AS DOUBLE) AS temperature, 10 AS max_tokens
    FROM messages WHERE trim(coalesce(message, ''), {_WS}) <> ''"""
)
def single_label_requests(spark, d):
    return _request_parts(M.classify_requests(D.messages(spark, d), D.catalogue(spark), single=True))


_SECTION_SQL = _sql_prompt(
    M.SECTION_PROMPT.user,
    title="label || CASE WHEN coalesce(problem_ru, '') <> '' THEN ' / ' || problem_ru ELSE '' END",
    max_messages="'30'",
    messages="'- ' || replace(messages, '\n\n', '\n\n- ')",
    links="CASE WHEN links = '' THEN '' ELSE '- ' || replace(links, '\n', '\n- ') END",
)


@query(
    f"""WITH {GROUPS_SQL}
    SELECT label AS request_id, 'generate' AS stage, 'gpt-4.1' AS model,
      {_sql_text(M.SECTION_PROMPT.system.format(country=COUNTRY))} AS system, {_SECTION_SQL} AS "user",
      CAST(0.2 AS DOUBLE) AS temperature, 5000 AS max_tokens FROM groups_"""
)
def section_requests(spark, d):
    return _request_parts(M.section_requests(_groups(spark, d), COUNTRY, with_links=True))


_EDIT_SQL = _sql_prompt(
    M.EDIT_PROMPT.user,
    country=f"'{COUNTRY}'",
    section="text",
    links="'- https://example.org/' || title || chr(10) || '- second'",
)


@query(
    f"""WITH {D.SECTIONS_SQL}
    SELECT section_id AS request_id, 'edit' AS stage, 'gpt-4.1' AS model, {_sql_text(M.EDIT_PROMPT.system)} AS system,
      {_EDIT_SQL} AS "user", CAST(0.2 AS DOUBLE) AS temperature, 5000 AS max_tokens FROM sections"""
)
def edit_requests(spark, d):
    listed = F.array(F.concat(F.lit("https://example.org/"), "title"), F.lit("second"))
    sections = D.sections(spark, d).withColumn("links", listed)
    return _request_parts(M.edit_requests(sections, COUNTRY, "text", "section_id"))


def request_counter():
    """A stand-in for a model: answers with a label id that depends on the length of the request."""

    def complete(model, messages, temperature, max_tokens):
        text = messages[1]["content"]
        if len(text) % 10 == 9:
            raise RuntimeError("no answer")
        usage = {"prompt_tokens": len(text), "completion_tokens": 7}
        return json.dumps({"problem_ids": [1 + len(text) % 7]}) + " ", usage

    return complete


_FAKE_SQL = f"""WITH sent AS (SELECT doc_id AS request_id, length({_CLASSIFY_SQL}) AS n
      FROM (SELECT *, trim(text, {_WS}) AS clean FROM documents) AS t WHERE clean <> '')
    SELECT request_id, 'classify' AS stage, CASE WHEN n % 10 <> 9 THEN '{{"problem_ids": [' || (1 + n % 7) || ']}}' END AS content,
      CASE WHEN n % 10 = 9 THEN 'no answer' END AS error, CASE WHEN n % 10 = 9 THEN 0 ELSE n END AS prompt_tokens,
      CAST(CASE WHEN n % 10 = 9 THEN 0 ELSE 7 END AS BIGINT) AS completion_tokens,
      CASE WHEN n % 10 = 9 THEN 0 ELSE n + 7 END AS total_tokens FROM sent"""


@query(_FAKE_SQL)
def completions_fake(spark, d):
    return M.run_completions(_fake_requests(spark, d), request_counter()).drop("model")


def _fake_requests(spark, d):
    return M.classify_requests(
        D.documents(spark, d),
        D.catalogue(spark),
        "text",
        "doc_id",
        translations=D.translations(spark),
        langs=("en",),
    )


@query(_FAKE_SQL)
def completions_ledger(spark, d):
    """The documents of one language are answered by an earlier job; this one asks for the rest."""
    ledger = f"{work_dir(spark)}/issuescope/ledger-{uuid.uuid4().hex}"
    requests = stage_table(_fake_requests(spark, d), "requests")
    earlier = D.documents(spark, d).filter("lang = 'en'").select(F.col("doc_id").alias("request_id"))
    M.answer_table(requests.join(earlier, "request_id", "left_semi"), request_counter(), ledger=ledger)
    return M.answer_table(requests, request_counter(), ledger=ledger).drop("model")


@query(
    """WITH sized AS (SELECT doc_id AS request_id, greatest(1, length(coalesce(text, ''))) AS n,
        md5(CAST(doc_id AS VARCHAR)) AS k FROM documents), summed AS (
      SELECT request_id, sum(n) OVER () AS total,
        coalesce(sum(n) OVER (ORDER BY k, request_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM sized)
    SELECT request_id, CAST(before * 8 // total AS INTEGER) AS call_task FROM summed"""
)
def call_tasks(spark, d):
    docs = D.documents(spark, d).select(F.col("doc_id").alias("request_id"), "text")
    chars = F.greatest(F.lit(1), F.char_length(F.coalesce("text", F.lit(""))))
    return M.call_tasks(docs, 8, chars).select("request_id", "call_task")




def text_counter():
    """A stand-in for a model: the label id depends on the length of the text alone."""

    def complete(model, messages, temperature, max_tokens):
        text = messages[1]["content"].split("Текст:\n", 1)[1].rsplit("\n\nПроблемы:\n", 1)[0]
        answer = json.dumps({"problem_ids": [1 + len(text) % 9, 2]})
        return answer, {"prompt_tokens": len(text), "completion_tokens": 3}

    return complete


@query(
    f"""WITH {D.MESSAGES_SQL}, {D.CATALOGUE_SQL}, cleaned AS (
      SELECT row_id, trim(coalesce(message, ''), {_WS}) AS clean FROM messages)
    SELECT m.row_id, CASE WHEN m.clean = '' THEN '' WHEN length(m.clean) % 4 = 0 THEN 'Инфляция'
        ELSE coalesce(c.label || '|', '') || 'Бедность' END AS problem_russ_candidates,
      CASE WHEN m.clean = '' THEN '' WHEN length(m.clean) % 4 = 0 THEN 'Инфляция' ELSE coalesce(c.label, 'Бедность') END
        AS problem_russ
    FROM cleaned m LEFT JOIN catalogue c ON c.label_id = 1 + length(m.clean) % 9"""
)
def classify_memoised(spark, d):
    """A quarter of the texts, those whose length four divides, are answered by the memo."""
    messages = D.messages(spark, d).select("row_id", "message")
    text = clean_text("message")
    memo = messages.filter((text != "") & (F.char_length(text) % 4 == 0)).select(
        text_key(text, _LABELS, 64).alias("key"),
        F.lit(CLASSIFY_MODEL).alias("model"),
        F.lit(MAX_LABELS).alias("max_labels"),
        F.array(F.lit(3)).alias("label_ids"),
    )
    labelled, _ = C.classify_messages(messages, D.catalogue(spark), text_counter(), memo=memo, hot_rows=50)
    return L.attach_labels(labelled, D.catalogue(spark)).drop("label_ids", "parse_error", "message")


@query(
    f"""WITH texts AS (
      SELECT sha256(concat(trim(text, {_WS}), '|{"|".join(_LABELS)}')) AS key, count(*) AS copies,
        max(CASE WHEN source IN (SELECT source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1))
          AND doc_id IN (SELECT doc_id FROM labels) THEN 1 ELSE 0 END) AS known
      FROM documents GROUP BY 1)
    SELECT key, copies, known = 1 AS hit, CASE WHEN known = 1 THEN '1|2' END AS label_ids FROM texts"""
)
def memo_hits_misses(spark, d):
    """Texts of labelled documents from sources with a toxic one are in the memo; the others have to be asked."""
    key = text_key(clean_text("text"), _LABELS, 64)
    docs = D.documents(spark, d).select("doc_id", "source", key.alias("key"), clean_text("text").alias("text"))
    known = D.table(spark, d, "labels")
    flagged = docs.join(known.filter("toxic = 1"), "doc_id", "left_semi").select("source").distinct()
    memo = (
        docs.join(known, "doc_id", "left_semi")
        .join(flagged, "source", "left_semi")
        .select("key")
        .distinct()
        .withColumn("label_ids", F.array(F.lit(1), F.lit(2)))
    )
    hits, misses = C.split_by_memo(C.distinct_texts(docs, "key", "text", "doc_id"), memo)
    found = hits.select("key", "copies", F.lit(True).alias("hit"), _joined("label_ids"))
    return found.unionByName(
        misses.select("key", "copies", F.lit(False).alias("hit"), F.lit(None).cast("string").alias("label_ids"))
    )


@query(
    f"""WITH {D.ANSWERS_SQL}
    SELECT stage, model, count(*) AS calls, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
      CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens, CAST(sum(total_tokens) AS BIGINT) AS total_tokens
    FROM answers GROUP BY ROLLUP (stage, model)"""
)
def usage_rollup(spark, d):
    return U.usage_summary(D.answers(spark, d))


@query(
    f"""WITH {D.ANSWERS_SQL}, prices AS (SELECT * FROM (VALUES
      {", ".join(f"('{m}', CAST({i} AS DOUBLE), CAST({o} AS DOUBLE))" for m, i, o in MODEL_PRICES)}) AS t(model, usd_in, usd_out))
    SELECT a.stage, a.model, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
      CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens, CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
      (CAST(sum(prompt_tokens) AS DOUBLE) * min(p.usd_in) + CAST(sum(completion_tokens) AS DOUBLE) * min(p.usd_out)) / 1000000 AS usd
    FROM answers a LEFT JOIN prices p ON p.model = a.model GROUP BY a.stage, a.model"""
)
def cost_by_stage(spark, d):
    return U.cost_estimate(D.answers(spark, d), U.price_table(spark))


# ---------------------------------------------------------------- section texts

_HEAD_SQL = "(?i)" + HEADING_PATTERN.split(")", 1)[1].replace(r"\d", "[0-9]")


def _blocks_sql(source: str, keys: str) -> str:
    """Line modes by windows: the last heading, and the first line that breaks a run of links."""
    s = f"trim(line, {_WS})"
    quote = (
        f"(left({s}, 2) IN ('- ', '— ', '• ') OR left({s}, 1) IN ('\"', '«', '“', '„', '''', '‚') "
        f"OR (right({s}, 1) = ')' AND contains({s}, '(')))"
    )
    return f"""lines AS (
  SELECT {keys}, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM {source}), kept AS (
  SELECT {keys}, pos, rtrim(raw, {_WS}) AS line FROM lines WHERE trim(raw, {_WS}) <> ''), typed AS (
  SELECT *, {s} AS bare, regexp_matches({s}, '{_HEAD_SQL}') AS head, {quote} AS quoted,
    (starts_with({s}, 'http://') OR starts_with({s}, 'https://')) AS link FROM kept), parts AS (
  SELECT *, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY pos) AS part FROM typed), modes AS (
  SELECT *, first_value(CASE WHEN NOT head THEN 'none' WHEN starts_with(lower(bare), 'цитаты') THEN 'quotes'
      WHEN starts_with(lower(bare), 'источники') THEN 'sources' ELSE 'none' END) OVER (PARTITION BY {keys}, part ORDER BY pos) AS mode,
    sum(CASE WHEN head OR link THEN 0 ELSE 1 END) OVER (PARTITION BY {keys}, part ORDER BY pos) AS broken FROM parts), final AS (
  SELECT {keys}, part, pos, line, bare, CASE WHEN head THEN 'subheading'
    WHEN mode = 'sources' AND broken = 0 THEN 'sources' WHEN mode = 'sources' AND broken = 1 AND NOT link THEN 'dropped'
    WHEN mode = 'quotes' OR quoted THEN 'quote' ELSE 'paragraph' END AS type FROM modes), folded AS (
  SELECT {keys}, pos, type, CASE type WHEN 'paragraph' THEN line WHEN 'subheading' THEN bare
    ELSE CASE WHEN left(bare, 2) IN ('- ', '— ', '• ') THEN trim(substr(bare, 3), {_WS}) ELSE bare END END AS text,
    CAST(NULL AS VARCHAR) AS items FROM final WHERE type NOT IN ('sources', 'dropped')
  UNION ALL SELECT {keys}, min(pos), 'sources', NULL, string_agg(bare, chr(10) ORDER BY pos) FROM final
  WHERE type = 'sources' GROUP BY {keys}, part), blocks AS (
  SELECT {keys}, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY pos) - 1 AS INTEGER) AS block_no, type, text, items
  FROM folded)"""


_KEYS = "section_id, title"


@query(f"WITH {D.SECTIONS_SQL}, {_blocks_sql('sections', _KEYS)} SELECT section_id, block_no, type, text, items FROM blocks")
def parse_blocks(spark, d):
    return B.parse_blocks(D.sections(spark, d)).withColumn("items", F.array_join("items", "\n"))


_BANNED_SQL = "(?i)(" + "|".join(BANNED) + ")"


def _filtered_sql() -> str:
    hit = f"regexp_matches({{}}, '{_BANNED_SQL}')"
    return f"""shown AS (
  SELECT {_KEYS}, block_no, type, text, CASE WHEN type = 'sources' THEN
    array_to_string(list_filter(string_split(items, chr(10)), lambda x: NOT {hit.format("x")}), chr(10)) END AS items
  FROM blocks WHERE NOT {hit.format("title")} AND NOT coalesce({hit.format("text")}, false)
    AND NOT (type = 'subheading' AND starts_with(lower(text), 'источники'))), filtered AS (
  SELECT * FROM shown WHERE type <> 'sources' OR items <> '')"""


@query(
    f"""WITH {D.SECTIONS_SQL}, {_blocks_sql("sections", _KEYS)}, {_filtered_sql()}
    SELECT section_id, block_no, type, text, items FROM filtered"""
)
def filter_blocks(spark, d):
    parsed = B.parse_blocks(D.sections(spark, d), keep=("section_id", "title"))
    kept = B.filter_blocks(parsed, BANNED, "title")
    return kept.select("section_id", "block_no", "type", "text", F.array_join("items", "\n").alias("items"))


_PARAGRAPHS_SQL = f"""{D.NOTED_SQL}, pieces AS (
  SELECT section_id, trim(unnest(string_split(text, chr(10) || chr(10))), {_WS}) AS piece,
    generate_subscripts(string_split(text, chr(10) || chr(10)), 1) AS pos FROM noted), marked AS (
  SELECT section_id, pos, CASE WHEN starts_with(piece, '##') THEN 'subheading' ELSE 'paragraph' END AS type,
    CASE WHEN starts_with(piece, '##') THEN trim(replace(piece, '##', ''), {_WS}) ELSE piece END AS text
  FROM pieces WHERE piece <> ''), paragraphs AS (
  SELECT section_id, CAST(row_number() OVER (PARTITION BY section_id ORDER BY pos) - 1 AS INTEGER) AS block_no, type, text
  FROM marked WHERE NOT starts_with(lower(text), 'вывод'))"""


@query(f"WITH {_PARAGRAPHS_SQL} SELECT * FROM paragraphs")
def split_paragraphs(spark, d):
    return B.split_paragraphs(D.noted_texts(spark, d))


@query(
    f"""WITH {_PARAGRAPHS_SQL}, cut AS (
      SELECT section_id, block_no, regexp_extract_all(text, '"[^"]+"|[^"]+|"') AS bits FROM paragraphs), spans AS (
      SELECT section_id, block_no, unnest(bits) AS bit, generate_subscripts(bits, 1) AS pos FROM cut), typed AS (
      SELECT *, length(bit) > 2 AND left(bit, 1) = '"' AND right(bit, 1) = '"' AS quoted FROM spans), runs AS (
      SELECT *, sum(CASE WHEN quoted THEN 1 ELSE 0 END) OVER (PARTITION BY section_id, block_no ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM typed), folded AS (
      SELECT section_id, block_no, run, quoted, string_agg(bit, '' ORDER BY pos) AS text, min(pos) AS pos
      FROM runs GROUP BY ALL)
    SELECT section_id, block_no, CAST(row_number() OVER (PARTITION BY section_id, block_no ORDER BY pos) - 1 AS INTEGER) AS run_no,
      CASE WHEN quoted THEN 'quoted' ELSE 'plain' END AS kind, text FROM folded"""
)
def quote_spans(spark, d):
    return B.quote_spans(B.split_paragraphs(D.noted_texts(spark, d)))


# ---------------------------------------------------------------- report

_TOC_SQL = f"""{COUNTS_SQL}, toc AS (
  SELECT c.rank, c.rank || '. ' || c.label || CASE WHEN coalesce(f.problem_ru, '') <> '' THEN ' — ' || f.problem_ru ELSE '' END AS text
  FROM counted c JOIN (SELECT label, problem_ru, row_number() OVER (PARTITION BY label ORDER BY row_id) AS n FROM merged) AS f
  ON f.label = c.label AND f.n = 1)"""


@query(f"WITH {_TOC_SQL} SELECT * FROM toc")
def toc(spark, d):
    summary = G.label_summary(merged_messages(spark, d), ["problem_ru"], first_rows=["problem_ru"])
    labels = G.ranked_labels(summary)
    return R.toc(labels.select("label", F.col("first_problem_ru").alias("problem_ru"), "rank"))


@query(
    f"""WITH {D.MESSAGES_SQL}
    SELECT row_id, CASE WHEN coalesce(problem_ru, '') <> '' AND problem_ru <> problem THEN problem_ru || ' (' || problem || ')'
        ELSE problem END AS section_title,
      problem || CASE WHEN coalesce(problem_ru, '') <> '' THEN ' / ' || problem_ru ELSE '' END AS prompt_title
    FROM messages"""
)
def section_titles(spark, d):
    label, ru = F.col("problem"), F.col("problem_ru")
    return D.messages(spark, d).select(
        "row_id",
        M.section_title(ru, label).alias("section_title"),
        M.prompt_title(label, ru).alias("prompt_title"),
    )


@query(
    """SELECT doc_id, CASE WHEN lang = 'en' THEN 'Танзании' ELSE lang END AS display FROM documents"""
)
def display_name(spark, d):
    named = D.documents(spark, d).select(
        "doc_id", F.when(F.col("lang") == "en", COUNTRY).otherwise(F.col("lang")).alias("country")
    )
    return R.country_display(named).drop("country")


_DESCRIPTION_SQL = """SELECT concat('Отчёт обобщает сообщения из открытых источников. Дата: 05.03.2024. Сообщений с текстом: ',
  count(message), '. Тематических категорий: ', count(DISTINCT label), '.') AS text FROM merged"""


@query(f"WITH {MERGED_SQL} {_DESCRIPTION_SQL}")
def description(spark, d):
    return R.description_block(G.corpus_summary(merged_messages(spark, d)), AS_OF)


def _report(spark, d):
    rows = stage_table(G.group_rows(merged_messages(spark, d)), "report-rows")
    summary = stage_table(G.summary_of(rows), "label-summary")
    text = F.concat(
        F.lit("Описание проблемы\n"),
        "label",
        F.lit("\nЦитаты:\n"),
        bullet_list(F.col("messages"), "\n"),
        F.lit("\nИсточники\n"),
        F.array_join("links", "\n"),
    )
    labels = G.ranked_labels(summary)
    sections = G.groups_of(rows, labels).select(
        "rank",
        M.section_title(F.col("problem_ru"), F.col("label")).alias("title"),
        text.alias("text"),
        F.lit(False).alias("failed"),
    )
    return report_of(labels, G.summary_facts(summary), sections, COUNTRY, AS_OF, BANNED)


def _report_sql() -> str:
    sections = f"""sections AS (
  SELECT rank AS section_id, CASE WHEN coalesce(problem_ru, '') <> '' AND problem_ru <> label
      THEN problem_ru || ' (' || label || ')' ELSE label END AS title,
    concat('Описание проблемы', chr(10), label, chr(10), 'Цитаты:', chr(10), '- ', replace(messages, '\n\n', '\n- '),
      chr(10), 'Источники', chr(10), links) AS text FROM groups_)"""
    toc_cte = _TOC_SQL[len(COUNTS_SQL) + 2 :]
    part = "SELECT {} AS part_no, '{}' AS part, {} AS section_no, {} AS block_no, {} AS item_no, {} AS kind, {} AS text, {} AS value"
    none = "CAST(NULL AS BIGINT)"
    title = (
        "'Проблемное поле жителей Танзании: тематический анализ на основании материалов социальных сетей "
        "и электронных медиа'"
    )
    rows = [
        part.format(1, "title", 0, 0, 0, "'title'", title, none),
        part.format(2, "date", 0, 0, 0, "'paragraph'", "'Дата формирования отчёта: 05.03.2024'", none),
        part.format(3, "toc", 0, 0, 0, "'heading'", "'Оглавление'", none),
        part.format(3, "toc", 0, "rank", 0, "'toc_line'", "text", none) + " FROM toc",
        part.format(4, "description", 0, 0, 0, "'heading'", "'Описание исследования'", none),
        part.format(4, "description", 0, 1, 0, "'paragraph'", "text", none) + f" FROM ({_DESCRIPTION_SQL}) AS x",
        part.format(5, "distribution", 0, -1, 0, "'heading'", "'Распределение проблем'", none)
        + " WHERE EXISTS (SELECT 1 FROM counted)",
        part.format(5, "distribution", 0, 0, 0, "'table_header'", "'Проблема|Количество'", none)
        + " WHERE EXISTS (SELECT 1 FROM counted)",
        part.format(5, "distribution", 0, "rank", 0, "'table_row'", "label", "count") + " FROM counted",
        part.format(6, "sections", "section_id", -1, 0, "'section_title'", "title", none)
        + " FROM (SELECT DISTINCT section_id, title FROM filtered) AS x",
        part.format(6, "sections", "section_id", "block_no", 0, "type", "text", none)
        + " FROM filtered WHERE type <> 'sources'",
        part.format(6, "sections", "section_id", "block_no", 0, "'subheading'", "'Источники'", none)
        + " FROM filtered WHERE type = 'sources'",
        part.format(6, "sections", "section_id", "block_no", "CAST(pos AS INTEGER)", "'source'", "link", none)
        + " FROM (SELECT *, unnest(string_split(items, chr(10))) AS link,"
        " generate_subscripts(string_split(items, chr(10)), 1) AS pos FROM filtered WHERE type = 'sources') AS x",
    ]
    return (
        f"WITH {GROUPS_SQL}, {toc_cte}, {sections}, {_blocks_sql('sections', _KEYS)}, {_filtered_sql()} "
        + " UNION ALL ".join(rows)
    )


@query(_report_sql())
def report_blocks(spark, d):
    return _report(spark, d)


@query(_report_sql())
def report_round_trip(spark, d):
    """The report as it is read back from where it was written."""
    path = f"{work_dir(spark)}/issuescope/report-{uuid.uuid4().hex}"
    write_report(_report(spark, d), path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- lists, memos and files


@query(
    f"""WITH {_SOURCE_LIST_SQL}
    SELECT 'translate' AS request_id, 'translate' AS stage, 'gpt-4.1-mini' AS model,
      'Переведи названия проблем. Ответ — только JSON.' AS system,
      concat('Названия:', chr(10), string_agg(label_id || '. ' || label, chr(10) ORDER BY label_id), chr(10), chr(10),
        'Языки: en, sw', chr(10), chr(10),
        'Формат: {{"translations": {{"<язык>": ["перевод 1", "перевод 2"]}}}} в порядке списка.') AS "user",
      CAST(0 AS DOUBLE) AS temperature, 2000 AS max_tokens FROM sources"""
)
def translate_requests(spark, d):
    return _request_parts(M.translate_requests(_source_list(spark, d), ("en", "sw")))


@query(
    """WITH list AS (SELECT 3 * doc_id + 1 AS label_id, concat(source, '-', doc_id) AS label FROM documents),
    ids AS (SELECT doc_id, unnest([3 * doc_id + 1, doc_id, 3 * (doc_id // 2) + 1]) AS label_id, unnest([1, 2, 3]) AS n
      FROM documents)
    SELECT d.doc_id, coalesce(string_agg(x.label, '|' ORDER BY x.n), '') AS problem_russ_candidates,
      coalesce(arg_min(x.label, x.n), '') AS problem_russ
    FROM documents d LEFT JOIN (SELECT ids.doc_id, n, label FROM ids JOIN list USING (label_id)) AS x ON x.doc_id = d.doc_id
    GROUP BY d.doc_id"""
)
def labels_of_a_long_list_with_gaps(spark, d):
    """A label for every document, under ids with gaps; rows are not numbered by the caller."""
    docs = D.documents(spark, d)
    number = F.col("doc_id") * 3 + 1
    listed = docs.select(number.alias("label_id"), F.concat(F.coalesce("source", F.lit("")), F.lit("-"), "doc_id").alias("label"))
    ids = F.array(number, F.col("doc_id"), F.floor(F.col("doc_id") / 2) * 3 + 1)
    return L.attach_labels(docs.select("doc_id", ids.alias("label_ids")), listed).drop("label_ids")


@query(
    """SELECT DISTINCT sha256(coalesce(text, '')) AS key, coalesce(lang, '-') AS model, 3 AS max_labels, '1|2' AS label_ids
    FROM documents"""
)
def memo_round_trip(spark, d):
    """Answers of one language are there already when those of all are added."""
    path = f"{work_dir(spark)}/issuescope/memo-{uuid.uuid4().hex}"
    new = D.documents(spark, d).select(
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"),
        F.coalesce("lang", F.lit("-")).alias("model"),
        F.lit(3).alias("max_labels"),
        F.array(F.lit(1), F.lit(2)).alias("label_ids"),
    )
    new = new.distinct()
    append_memo(new.filter("model = 'en'"), path)
    append_memo(new, path, read_memo(spark, path))
    return read_memo(spark, path).select("key", "model", "max_labels", _joined("label_ids"))


@query(
    """SELECT CAST(row_number() OVER (ORDER BY source) AS INTEGER) AS label_id, source AS label
    FROM (SELECT DISTINCT source FROM documents WHERE source <> '') AS t"""
)
def label_list_round_trip(spark, d):
    path = f"{work_dir(spark)}/issuescope/list-{uuid.uuid4().hex}"
    names = D.documents(spark, d).filter("source <> ''").select("source").distinct()
    names.coalesce(1).sortWithinPartitions("source").write.text(path)  # a label list is one file
    return read_catalogue(spark, path)


@query(
    """SELECT source AS label, CAST(count(*) AS VARCHAR) AS count,
      CAST(row_number() OVER (ORDER BY count(*) DESC, min(doc_id)) AS VARCHAR) AS rank
    FROM documents WHERE source IS NOT NULL GROUP BY source"""
)
def frequency_round_trip(spark, d):
    path = f"{work_dir(spark)}/issuescope/counts-{uuid.uuid4().hex}"
    write_distribution(G.distribution(D.documents(spark, d), "source", "doc_id", exclude=None), path)
    return read_messages(spark, path, ";").drop("row_id")


@query("""SELECT concat('t', doc_id) AS title, nullif(text, '') AS message, nullif(source, '') AS link FROM documents""")
def load_round_trip(spark, d):
    """A message file with columns known by name, read back through their roles."""
    path = f"{work_dir(spark)}/issuescope/messages-{uuid.uuid4().hex}"
    docs = D.documents(spark, d).select(
        F.concat(F.lit("t"), "doc_id").alias("Заголовок"), F.col("source").alias("Ссылка"), F.col("text").alias("Сообщение")
    )
    write_classified(docs, path, "csv")
    df, roles = load_messages(spark, path, require_problem=False)
    return df.select(F.col(roles.title).alias("title"), F.col(roles.message).alias("message"), F.col(roles.link).alias("link"))
