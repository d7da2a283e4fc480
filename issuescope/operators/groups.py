"""Distributions and per-label groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import MAX_LINKS, MAX_MESSAGE_CHARS, MAX_MESSAGES, NO_LABEL
from ..functions.text import lstrip, truncate_text
from ..session import stage_table
from .first import first_n_per_key, first_non_null_of, first_row_value_of, value_profile, with_rank
from .lookup import HOT_ROWS, quoted, spread_lookup


def label_counts(
    df: DataFrame, label: str = "label", row_id: str = "row_id", exclude: str | None = NO_LABEL
) -> DataFrame:
    """(label, count, first_row_id); null labels and the ``exclude`` mark are left out."""
    kept = df.filter(F.col(label).isNotNull())
    if exclude is not None:
        kept = kept.filter(F.col(label) != exclude)
    return kept.groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("count"), F.min(row_id).alias("first_row_id")
    )


def distribution(
    df: DataFrame, label: str = "label", row_id: str = "row_id", exclude: str | None = NO_LABEL
) -> DataFrame:
    """(label, count, rank): labels by falling count, ties by first appearance."""
    return with_rank(label_counts(df, label, row_id, exclude)).select("label", "count", "rank")


def frequent_labels(
    df: DataFrame, label: str = "label", min_count: int = 2, exclude: str | None = NO_LABEL
) -> DataFrame:
    """(label, count) of the labels with at least ``min_count`` rows."""
    kept = df.filter(F.col(label).isNotNull())
    if exclude is not None:
        kept = kept.filter(F.col(label) != exclude)
    counts = kept.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    return counts.filter(F.col("count") >= min_count)


def keep_frequent(
    df: DataFrame,
    label: str = "label",
    min_count: int = 2,
    exclude: str | None = NO_LABEL,
    row_id: str = "row_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The rows whose label is frequent.

    A semi join by ``spread_lookup``: labels may be free text with one value on a third of the rows.
    """
    frequent = frequent_labels(df, label, min_count, exclude).select(
        F.col("label").alias(label), F.col("count").alias("_copies"), F.lit(True).alias("_frequent")
    )
    return spread_lookup(df, frequent, label, row_id, "_copies", hot_rows).filter("_frequent").drop("_frequent")


def top_messages(
    df: DataFrame,
    label: str = "label",
    message: str = "message",
    row_id: str = "row_id",
    max_messages: int = MAX_MESSAGES,
    max_chars: int = MAX_MESSAGE_CHARS,
) -> DataFrame:
    """(label, row_id, message, position): the first usable messages of every label.

    Messages are cut before they are ranked, so that only short rows are sorted and shuffled.
    """
    # lstrip is enough to tell a blank message, and cheaper than the whole cut made twice.
    written = df.filter(F.col(label).isNotNull() & (lstrip(message) != ""))
    short = written.select(
        F.col(label).alias("label"),
        F.col(row_id).alias("row_id"),
        truncate_text(message, max_chars).alias("message"),
    )
    return first_n_per_key(short, "label", "row_id", max_messages)


def top_links(
    df: DataFrame,
    label: str = "label",
    link: str = "link",
    has_message: Column | None = None,
    row_id: str = "row_id",
    max_links: int = MAX_LINKS,
) -> DataFrame:
    """(label, link, position): the first distinct links of every label, over rows that have a message.

    Copies of a link are merged per task before the shuffle, and the shuffle is by (label, link), so neither a
    hot label nor a hot link gathers in one task.
    """
    has_message = F.col("message").isNotNull() if has_message is None else has_message
    links = (
        df.filter(F.col(label).isNotNull() & has_message & F.col(link).isNotNull())
        .groupBy(F.col(label).alias("label"), F.col(link).alias("link"))
        .agg(F.min(row_id).alias("_first"))
    )
    # The same row may not carry two links, so _first orders them fully.
    return first_n_per_key(links, "label", "_first", max_links, two_rounds=False).drop("_first")


def _in_order(value: str, position: str = "position"):
    pairs = F.array_sort(F.collect_list(F.struct(position, F.col(value).alias("value"))))
    return F.transform(pairs, lambda p: p.getField("value"))


def language_columns(columns: Sequence[str]) -> dict[str, str]:
    """Columns that hold one label per language, by the name after ``problem_``."""
    return {
        c.split("_", 1)[1]: c for c in columns if c.startswith("problem_") and not c.endswith("_candidates")
    }


def label_summary(
    df: DataFrame,
    columns: Sequence[str],
    label: str = "label",
    has_message: Column | None = None,
    row_id: str = "row_id",
    first_rows: Sequence[str] = (),
) -> DataFrame:
    """Everything a report asks per label, in one pass over the rows.

    (label, count, n_messages, first_row_id, <columns>, ...): rows, rows with a message, and of each column the
    first value that is not null, over rows with a message.  For columns in ``first_rows`` there is also
    ``first_<column>``, the value of the very first row, and ``first_usable_<column>``, that of the first row with
    a message; both may be null.  Rows without a label form a line of their own.
    """
    has_message = F.col("message").isNotNull() if has_message is None else has_message
    names = {c: f"_value_{i}" for i, c in enumerate(columns)}
    renamed = df.select(
        F.col(label).alias("label"),
        F.col(row_id).alias("row_id"),
        has_message.alias("_usable"),
        *[quoted(c).alias(n) for c, n in names.items()],
    )
    profile = value_profile(renamed, "label", list(names.values()), "row_id", F.col("_usable"))
    return profile.groupBy("label").agg(
        F.sum("rows").alias("count"),
        F.sum("usable_rows").alias("n_messages"),
        F.min("first_row_id").alias("first_row_id"),
        *[first_non_null_of(n).alias(c) for c, n in names.items()],
        *[first_row_value_of(names[c], "first_row_id").alias(f"first_{c}") for c in first_rows],
        *[first_row_value_of(names[c]).alias(f"first_usable_{c}") for c in first_rows],
    )


def ranked_labels(summary: DataFrame, exclude: str | None = NO_LABEL) -> DataFrame:
    """The labels of a written summary in the order of ``distribution``, with their ``rank``."""
    kept = summary.filter(F.col("label").isNotNull())
    if exclude is not None:
        kept = kept.filter(F.col("label") != exclude)
    return with_rank(kept)


def summary_facts(summary: DataFrame) -> DataFrame:
    """One row of facts from a summary: rows, rows with a message, distinct labels."""
    return summary.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("n_messages"), F.lit(0)).alias("n_messages"),
        F.count("label").alias("n_labels"),
    )


def labels_by_lang(
    df: DataFrame,
    label: str = "label",
    message: str = "message",
    row_id: str = "row_id",
    exclude: str | None = NO_LABEL,
) -> DataFrame:
    """(label, lang, value): the first non-null entry of every language column."""
    found = language_columns(df.columns)
    kept = df.filter(F.col(label).isNotNull())
    if exclude is not None:
        kept = kept.filter(F.col(label) != exclude)
    summary = label_summary(kept, list(found.values()), label, F.col(message).isNotNull(), row_id)
    pairs = F.array(
        *[F.struct(F.lit(lang).alias("lang"), quoted(c).alias("value")) for lang, c in found.items()]
    )
    return summary.select("label", F.inline(pairs))


def group_rows(
    df: DataFrame,
    label: str = "label",
    problem_ru: str | None = "problem_ru",
    message: str = "message",
    link: str | None = "link",
    row_id: str = "row_id",
    max_chars: int = MAX_MESSAGE_CHARS,
) -> DataFrame:
    """What a report needs of the messages, with texts cut to the length in which they are quoted.

    Columns: row_id, label, problem_ru, message (null if blank), has_message, link, labels_by_lang.  A report
    reads these rows several times; ``stage_table`` them first, so that the whole texts are read once.
    """
    found = language_columns(df.columns)
    entries = [e for lang, c in found.items() for e in (F.lit(lang), quoted(c))]
    nothing = F.lit(None).cast("string")
    return df.select(
        F.col(row_id).alias("row_id"),
        F.col(label).alias("label"),
        (quoted(problem_ru) if problem_ru else nothing).alias("problem_ru"),
        truncate_text(message, max_chars).alias("message"),
        F.col(message).isNotNull().alias("has_message"),
        (F.col(link) if link else nothing).alias("link"),
        F.create_map(*entries).cast("map<string,string>").alias("labels_by_lang"),
    )


def summary_of(rows: DataFrame, langs: Sequence[str] = ()) -> DataFrame:
    """The ``label_summary`` of ``group_rows``, with one column per language."""
    named = {f"lang_{lang}": F.col("labels_by_lang")[lang] for lang in langs}
    wide = rows.withColumns(named) if named else rows
    return label_summary(
        wide, ["problem_ru", *named], has_message=F.col("has_message"), first_rows=["problem_ru"]
    )


def groups_of(
    rows: DataFrame,
    labels: DataFrame,
    langs: Sequence[str] = (),
    max_messages: int = MAX_MESSAGES,
    max_links: int = MAX_LINKS,
) -> DataFrame:
    """One row per label that has a usable message, from ``group_rows`` and their ``ranked_labels``.

    Columns: label, problem_ru, messages, links, count, labels_by_lang, rank.  The rank is that of
    ``distribution``, so labels without messages leave gaps.
    """
    entries = [e for lang in langs for e in (F.lit(lang), quoted(f"lang_{lang}"))]
    heads = labels.select(
        "label",
        "problem_ru",
        "count",
        F.create_map(*entries).cast("map<string,string>").alias("labels_by_lang"),
        "rank",
    )
    # Rows of labels that are not ranked drop out in the joins below.
    usable = rows.filter("label IS NOT NULL AND message IS NOT NULL")
    messages = first_n_per_key(usable.select("label", "row_id", "message"), "label", "row_id", max_messages)
    links = top_links(rows, has_message=F.col("has_message"), max_links=max_links)
    return (
        heads.join(messages.groupBy("label").agg(_in_order("message").alias("messages")), "label")
        .join(links.groupBy("label").agg(_in_order("link").alias("links")), "label", "left")
        .withColumn("links", F.coalesce("links", F.array().cast("array<string>")))
        .select("label", "problem_ru", "messages", "links", "count", "labels_by_lang", "rank")
    )


def assemble_groups(
    df: DataFrame,
    label: str = "label",
    problem_ru: str | None = "problem_ru",
    message: str = "message",
    link: str | None = "link",
    row_id: str = "row_id",
    max_messages: int = MAX_MESSAGES,
    max_chars: int = MAX_MESSAGE_CHARS,
    max_links: int = MAX_LINKS,
) -> DataFrame:
    """The groups of a message table; its cut rows and their summary are written to the shared folder first."""
    langs = list(language_columns(df.columns))
    rows = stage_table(group_rows(df, label, problem_ru, message, link, row_id, max_chars), "group-rows")
    labels = ranked_labels(stage_table(summary_of(rows, langs), "label-summary"))
    return groups_of(rows, labels, langs, max_messages, max_links)


def corpus_summary(df: DataFrame, message: str = "message", label: str = "label") -> DataFrame:
    """One row of facts: rows, columns, rows with a message, distinct labels."""
    per_label = df.groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(message).alias("messages")
    )
    return per_label.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.coalesce(F.sum("messages"), F.lit(0)).alias("n_messages"),
        F.count("label").alias("n_labels"),
    )
