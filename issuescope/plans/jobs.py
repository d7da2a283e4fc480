"""Whole jobs: classify a message table, and write a report about it.

What is paid for (model answers) or read several times (the cut messages) is written to the shared folder once;
everything else stays a lazy plan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (
    MAX_LABELS,
    MAX_LINKS,
    MAX_MESSAGE_CHARS,
    MAX_MESSAGES,
    NO_LABEL,
    NOTED_FAILED_TEXT,
    NOTED_MAX_MESSAGES,
    NOTED_REPORT_TITLE,
    NOTED_SOURCES_TITLE,
    PROBLEM_COLUMNS,
)
from ..functions.text import clean_text
from ..operators.blocks import filter_blocks
from ..operators.classify import classify_messages, distinct_texts, memo_rows
from ..operators.completions import (
    CallSettings,
    Completion,
    answer_table,
    classify_requests,
    edit_requests,
    section_requests,
    sections_from_answers,
    translate_requests,
)
from ..operators.first import dedup_first
from ..operators.groups import (
    distribution,
    group_rows,
    groups_of,
    language_columns,
    ranked_labels,
    summary_facts,
    summary_of,
)
from ..operators.labels import (
    add_wide_columns,
    attach_labels,
    check_langs,
    merge_labels,
    parse_single_label,
    parse_translations,
    synonym_table,
    translation_fault,
)
from ..operators.lookup import HOT_ROWS, columns_of, spread_lookup
from ..operators.report import (
    build_report,
    description_block,
    noted_blocks,
    notebook_heading,
    section_blocks,
    toc,
)
from ..session import stage_table
from ..sources.memo import append_memo
from ..sources.messages import read_messages
from ..sources.roles import ColumnRoles, resolve_columns

_USAGE = ("stage", "model", "prompt_tokens", "completion_tokens", "total_tokens")


def load_messages(
    spark: SparkSession, path: str, require_problem: bool = True, sep: str | None = None, nulls: str = "collapse"
) -> tuple[DataFrame, ColumnRoles]:
    """Read a message file, find its columns and keep the first message of every title."""
    df = read_messages(spark, path, sep)
    roles = resolve_columns(df, require_problem)
    return (dedup_first(df, roles.title, nulls=nulls) if roles.title else df), roles


def translate_catalogue(
    catalogue: DataFrame, langs: Sequence[str], complete: Completion, settings: CallSettings = CallSettings()
):
    """((label, lang, translation), answers): one call for the whole list; without its answer nothing goes on."""
    answers = answer_table(
        translate_requests(catalogue, langs, **settings.translate), complete, name="translations", **settings.running
    )
    fault = translation_fault(answers)
    if fault:
        raise RuntimeError(f"the label list could not be translated: {fault}")
    return parse_translations(answers, catalogue, langs), answers


def classify_job(
    df: DataFrame,
    roles: ColumnRoles,
    catalogue: DataFrame,
    complete: Completion,
    langs: Sequence[str],
    max_labels: int = MAX_LABELS,
    wide: bool = False,
    memo_path: str | None = None,
    settings: CallSettings = CallSettings(),
    max_langs: int | None = 2,
) -> tuple[DataFrame, DataFrame]:
    """Labels for every message, in Russian and in ``langs``, of which there may be ``max_langs``: (table, usage of the
    calls).

    With ``memo_path`` texts answered in earlier runs are not asked again.
    """
    langs = check_langs(langs, max_langs)
    if not langs:
        raise ValueError("name a language")
    translations, asked = translate_catalogue(catalogue, langs, complete, settings)
    labelled, answers = classify_messages(
        df,
        catalogue,
        complete,
        roles.message,
        memo=memo_path,
        translations=translations,
        langs=langs,
        max_labels=max_labels,
        settings=settings,
    )
    if memo_path:
        append_memo(memo_rows(answers), memo_path)
    table = attach_labels(labelled, catalogue, translations=translations, langs=langs).drop("label_ids")
    if wide:
        # Written once, as the labels that become columns are looked up first.
        table = stage_table(table, "classified")
        labels = [r.label for r in catalogue.orderBy("label_id").collect()]
        table = add_wide_columns(table, labels, langs)
    return table, asked.select(*_USAGE).unionByName(answers.select(*_USAGE))


def single_label_job(
    df: DataFrame,
    message: str,
    catalogue: DataFrame,
    complete: Completion,
    output: str = PROBLEM_COLUMNS[0],
    row_id: str = "row_id",
    settings: CallSettings = CallSettings(),
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """One label per message, asked by name; identical texts are asked once: (table, usage of the calls).

    ``settings.classify`` may also hold ``max_chars``, how much of a text is sent.
    """
    keyed = df.withColumn("_text", F.coalesce(F.col(message), F.lit(""))).withColumn(
        "_key", F.when(clean_text("_text") != "", F.sha2("_text", 256))
    )
    texts = stage_table(
        distinct_texts(keyed.filter("_key IS NOT NULL").select(row_id, "_key", "_text"), "_key", "_text", row_id),
        "single-texts",
    )
    requests = classify_requests(texts, catalogue, "text", "key", single=True, keep=("copies",), **settings.classify)
    answers = answer_table(requests, complete, keep=("copies",), name="single-answers", **settings.running)
    named = parse_single_label(
        answers.select(F.col("request_id").alias("_key"), "copies", "content", "error"),
        catalogue,
        "content",
        "_label",
    )
    found = named.select("_key", "copies", "_label", F.col("error").alias("classify_error"))
    joined = spread_lookup(keyed, found, "_key", row_id, "copies", hot_rows)
    table = joined.select(
        *columns_of(df),
        F.coalesce("_label", F.lit(NO_LABEL)).alias(output),
        "classify_error",
    )
    return table, answers.select(*_USAGE)


def report_of(
    labels: DataFrame,
    facts: DataFrame,
    sections: DataFrame,
    country: str,
    as_of: dt.datetime,
    banned: Sequence[str] = (),
    layout: str = "report",
    description: str | None = None,
) -> DataFrame:
    """The report table of ``ranked_labels``, corpus facts and sections (rank, title, text, failed)."""
    lines = labels.select("label", F.col("first_problem_ru").alias("problem_ru"), "rank")
    return build_report(
        filter_blocks(section_blocks(sections), banned, "title"),
        labels,
        toc(lines),
        description_block(facts, as_of, **({} if description is None else {"template": description})),
        country,
        as_of,
        layout=layout,
    )


@dataclass(frozen=True)
class Report:
    table: DataFrame
    groups: DataFrame
    usage: DataFrame


def report_job(
    df: DataFrame,
    roles: ColumnRoles,
    complete: Completion,
    country: str,
    as_of: dt.datetime,
    synonyms: DataFrame | None = None,
    max_messages: int = MAX_MESSAGES,
    max_chars: int = MAX_MESSAGE_CHARS,
    max_links: int = MAX_LINKS,
    banned: Sequence[str] = (),
    layout: str = "report",
    settings: CallSettings = CallSettings(),
    description: str | None = None,
    catalogue: DataFrame | None = None,
    langs: Sequence[str] = (),
) -> Report:
    """Group the messages by merged label, have a section written and edited per label, and build the report.

    Messages without a Russian label column are classified first if there is a ``catalogue`` and ``langs``.
    ``description`` replaces the template of the description.
    """
    spark = df.sparkSession
    first_calls = None
    if roles.problem_ru is None and catalogue is not None:
        df, first_calls = classify_job(df, roles, catalogue, complete, langs, settings=settings)
        df = stage_table(df, "classified")
        found = resolve_columns(df, False)
        roles = replace(found, message=roles.message, problem=found.problem or found.problem_ru)
    if roles.problem is None:
        raise ValueError("a report needs a label column")
    merged = merge_labels(
        df, synonyms if synonyms is not None else synonym_table(spark), roles.problem, roles.problem_ru, "label"
    )
    rows = stage_table(
        group_rows(merged, "label", roles.problem_ru, roles.message, roles.link, max_chars=max_chars), "report-rows"
    )
    langs = list(language_columns(df.columns))
    summary = stage_table(summary_of(rows, langs), "label-summary")
    labels = ranked_labels(summary)
    groups = stage_table(groups_of(rows, labels, langs, max_messages, max_links), "groups")
    written = answer_table(
        section_requests(groups, country, max_messages, **settings.generate), complete, name="sections", **settings.running
    )
    drafts = groups.select("label", "links").join(
        written.filter("error IS NULL").select(F.col("request_id").alias("label"), "content"), "label"
    )
    edited = answer_table(edit_requests(drafts, country, **settings.edit), complete, name="edited", **settings.running)
    # The report and the usage read the sections several times.
    sections = stage_table(sections_from_answers(groups, written, edited), "written-sections")
    table = report_of(labels, summary_facts(summary), sections, country, as_of, banned, layout, description)
    # A section that failed counts with no tokens at all.
    failed = sections.filter("failed").select(F.col("label").alias("request_id"))
    calls = written.unionByName(edited).join(failed, "request_id", "left_anti")
    usage = calls.select(*_USAGE)
    return Report(table, groups, usage if first_calls is None else first_calls.unionByName(usage))


def noted_report_job(
    df: DataFrame,
    roles: ColumnRoles,
    complete: Completion,
    country: str,
    as_of: dt.datetime,
    max_messages: int = NOTED_MAX_MESSAGES,
    max_chars: int = MAX_MESSAGE_CHARS,
    max_links: int = MAX_LINKS,
    settings: CallSettings = CallSettings(),
    description: str | None = None,
) -> Report:
    """The report in its first form: labels as they are, one call per label, and no editing.

    Sections are titled by label and translation, the translation being that of the first message; the texts mark
    their subheadings with ``##``.  The distribution counts translated labels.
    """
    if roles.problem is None:
        raise ValueError("a report needs a label column")
    rows = stage_table(
        group_rows(df, roles.problem, roles.problem_ru, roles.message, roles.link, max_chars=max_chars), "report-rows"
    )
    summary = stage_table(summary_of(rows), "label-summary")
    labels = ranked_labels(summary, exclude=None)
    first = labels.withColumn("problem_ru", F.col("first_usable_problem_ru"))
    groups = stage_table(groups_of(rows, first, (), max_messages, max_links), "groups")
    requests = section_requests(groups, country, max_messages, with_links=True, **settings.generate)
    written = answer_table(requests, complete, name="sections", **settings.running)
    answers = written.select(F.col("request_id").alias("label"), "content", "error")
    sections = groups.join(answers, "label", "left").select(
        "rank",
        notebook_heading(F.col("label"), F.col("problem_ru")).alias("title"),
        F.coalesce(F.concat(F.lit(NOTED_FAILED_TEXT), "error"), F.col("content")).alias("text"),
        "links",
    )
    shown = rows.select("row_id", F.coalesce("problem_ru", "label").alias("label"))
    table = build_report(
        noted_blocks(sections),
        distribution(shown, exclude=None),
        toc(labels.select("label", F.col("first_problem_ru").alias("problem_ru"), "rank")),
        description_block(summary_facts(summary), as_of, **({} if description is None else {"template": description})),
        country,
        as_of,
        title=NOTED_REPORT_TITLE,
        layout="notebook",
        sources_title=NOTED_SOURCES_TITLE,
    )
    return Report(table, groups, written.select(*_USAGE))
