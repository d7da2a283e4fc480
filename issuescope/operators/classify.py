"""Assigning labels to messages: by terms, or by a model asked once per distinct text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CLASSIFY_MODEL, MAX_LABELS
from ..functions.answers import parse_label_ids
from ..functions.text import clean_text, text_key
from ..session import stage_table
from ..sources.memo import read_memo
from .completions import CallSettings, Completion, answer_table, classify_requests
from .lookup import HOT_ROWS, columns_of, quoted, spread_lookup

#: Terms that one automaton may hold, in bytes.
LEXICON_BYTES = 16 << 20


class TermCounter:
    """Counts the terms of a lexicon in one walk over a text, however many terms there are.

    Occurrences of one term do not overlap each other, those of different terms may.  A label may have several terms,
    and a term several labels.
    """

    def __init__(self, terms: Sequence[tuple[int, str]]):
        self.labels: dict[str, list[int]] = {}
        for label_id, term in terms:
            self.labels.setdefault(term, []).append(label_id)
        self.automaton = ahocorasick.Automaton()
        for term in self.labels:
            self.automaton.add_word(term, term)
        self.automaton.make_automaton()

    def counts(self, text: str) -> dict[int, int]:
        free: dict[str, int] = {}
        found: dict[int, int] = {}
        for last, term in self.automaton.iter(text):
            if last - len(term) + 1 >= free.get(term, 0):
                free[term] = last + 1
                for label_id in self.labels[term]:
                    found[label_id] = found.get(label_id, 0) + 1
        return found

    def best(self, text: str, max_labels: int) -> list[int]:
        """The labels found most often, ties by id."""
        ranked = sorted((-n, label_id) for label_id, n in self.counts(text).items())
        return [label_id for _, label_id in ranked[:max_labels]]


def lexicon_label_ids(text: Column, terms: Sequence[tuple[int, str]], max_labels: int = MAX_LABELS) -> Column:
    """The ids whose terms occur most often in a lower-cased column, most frequent first, ties by id."""
    terms = list(terms)
    if not all(term for _, term in terms):
        raise ValueError("a term must not be empty")
    if not terms:
        return F.array().cast("array<int>")

    @F.pandas_udf("array<int>")
    def label_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = TermCounter(terms)
        for texts in batches:
            yield texts.map(lambda text: counter.best(text, max_labels))

    return label_ids(text)


def lexicon_classify(
    df: DataFrame, lexicon: DataFrame, text: str = "message", max_labels: int = MAX_LABELS, output: str = "label_ids"
) -> DataFrame:
    """Add the ids of the labels whose terms are most frequent in the whole text, without regard to case.

    ``lexicon`` has (label_id, term).  It becomes one automaton per task, so it may hold ``LEXICON_BYTES`` of terms;
    a larger one ends the job before it is collected.  The time for a text does not depend on the number of terms.
    Needs no shuffle and no model; other columns do not leave the JVM.
    """
    listed = lexicon.select("label_id", F.lower("term").alias("term"))
    size = listed.agg(F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("bytes")).head().bytes
    if size > LEXICON_BYTES:
        raise ValueError(f"{size} bytes of terms; one automaton holds {LEXICON_BYTES}")
    terms = sorted((r.label_id, r.term) for r in listed.collect())
    lowered = F.lower(F.coalesce(quoted(text), F.lit("")))
    return df.withColumn(output, lexicon_label_ids(lowered, terms, max_labels))


def distinct_texts(df: DataFrame, key: str, text: str, row_id: str = "row_id") -> DataFrame:
    """(key, text, copies) of the rows whose text is not blank.

    Equal keys mean equal texts, so the first copy will do.  Only keys and row numbers are aggregated, by hash; then the
    texts of the first rows are fetched, so that no whole text is ever sorted.
    """
    written = df.filter(F.col(text) != "")
    first = written.groupBy(F.col(key).alias("key")).agg(
        F.min(row_id).alias("_first"), F.count(F.lit(1)).alias("copies")
    )
    texts = written.select(F.col(row_id).alias("_first"), F.col(text).alias("text"))
    return first.hint("shuffle_hash").join(texts, "_first").select("key", "text", "copies")


def match_memo(texts: DataFrame, memo: DataFrame) -> DataFrame:
    """``texts`` with the ``label_ids`` of the memo and ``_known``, which is null for texts it does not have."""
    known = memo.groupBy("key").agg(F.min("label_ids").alias("label_ids"), F.lit(True).alias("_known"))
    return texts.join(known, "key", "left")


def split_by_memo(texts: DataFrame, memo: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits with their ``label_ids``, misses), from one join, which is written to the shared folder."""
    matched = stage_table(match_memo(texts, memo), "matched-texts")
    return matched.filter("_known").drop("_known"), matched.filter("_known IS NULL").drop("_known", "label_ids")


def classify_messages(
    df: DataFrame,
    catalogue: DataFrame,
    complete: Completion,
    text: str = "message",
    row_id: str = "row_id",
    memo: DataFrame | str | None = None,
    translations: DataFrame | None = None,
    langs: Sequence[str] = (),
    max_labels: int = MAX_LABELS,
    settings: CallSettings = CallSettings(),
    hot_rows: int = HOT_ROWS,
    key_chars: int = 64,
) -> tuple[DataFrame, DataFrame]:
    """Ask a model for the labels of every message; identical texts are asked once.

    Returns (``df`` with ``label_ids`` and ``parse_error``, answers).  ``answers`` is a written table with the
    key, the ids, usage and errors of the new calls; its good rows extend the memo (see ``memo_rows``).  Blank
    messages get no labels and no call.  ``memo`` is a table or the path of a memo, of which only the folders that may
    hold the messages' texts are read.

    The key is the whole digest by default: 16 digits, the form of ``text_key``, would make some of a hundred
    billion texts share an answer.
    """
    # The list is part of every request anyway.
    labels = [r.label for r in sorted(catalogue.select("label_id", "label").collect(), key=lambda r: r.label_id)]
    spark = df.sparkSession
    model = settings.classify.get("model", CLASSIFY_MODEL)
    cleaned = df.withColumn("_text", clean_text(text))
    keyed = cleaned.withColumn("_key", F.when(F.col("_text") != "", text_key("_text", labels, key_chars)))
    texts = distinct_texts(keyed.select(row_id, "_key", "_text"), "_key", "_text", row_id)
    if memo is None:
        texts = texts.withColumns({"label_ids": F.lit(None).cast("array<int>"), "_known": F.lit(None).cast("boolean")})
    elif isinstance(memo, str):
        texts = stage_table(texts, "keyed-texts")
        texts = match_memo(texts, read_memo(spark, memo, model, max_labels, texts))
    else:
        texts = match_memo(texts, memo.filter((F.col("model") == model) & (F.col("max_labels") == max_labels)))
    # Texts that have an answer are not needed again.
    texts = stage_table(
        texts.withColumn("text", F.when(F.col("_known").isNull(), F.col("text"))), "distinct-texts"
    )
    hits = texts.filter("_known").select(
        "key", "copies", "label_ids", F.lit(None).cast("string").alias("parse_error")
    )
    requests = classify_requests(
        texts.filter("_known IS NULL"),
        catalogue,
        text="text",
        request_id="key",
        translations=translations,
        langs=langs,
        max_labels=max_labels,
        keep=("copies",),
        **settings.classify,
    )
    raw = run_and_parse(requests, complete, max_labels, settings)
    found = hits.unionByName(raw.select(F.col("request_id").alias("key"), "copies", "label_ids", "parse_error"))
    labelled = spread_lookup(
        keyed, found.withColumnRenamed("key", "_key"), "_key", row_id, "copies", hot_rows
    )
    empty = F.array().cast("array<int>")
    result = labelled.select(
        *columns_of(df), F.coalesce("label_ids", empty).alias("label_ids"), "parse_error"
    )
    return result, raw


def run_and_parse(
    requests: DataFrame, complete: Completion, max_labels: int, settings: CallSettings
) -> DataFrame:
    answers = answer_table(requests, complete, keep=("copies",), name="classify-answers", **settings.running)
    parsed = answers.withColumn("_parsed", parse_label_ids("content", max_labels))
    return parsed.select(
        *answers.columns,
        F.lit(max_labels).alias("max_labels"),
        F.col("_parsed.ids").alias("label_ids"),
        F.coalesce("error", "_parsed.parse_error").alias("parse_error"),
    )


def memo_rows(answers: DataFrame) -> DataFrame:
    """The good new answers in the form of the memo."""
    return answers.filter("parse_error IS NULL").select(
        F.col("request_id").alias("key"), "model", "max_labels", "label_ids"
    )
