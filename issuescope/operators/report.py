"""The report as an ordered table of blocks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    COUNTRY_DISPLAY,
    DESCRIPTION_HEADING,
    DISTRIBUTION_COLUMNS,
    DISTRIBUTION_HEADING,
    REPORT_DATE_LINE,
    REPORT_TITLE,
    SOURCES_TITLE,
    TOC_HEADING,
)
from ..functions.text import optional_suffix, render
from .blocks import parse_blocks, split_paragraphs
from .lookup import literal_table, lookup_or_self

# Places of the parts, as in the report of the command line and in that of the notebook.
PART_ORDERS = {
    "report": ("title", "date", "toc", "description", "distribution", "sections"),
    "notebook": ("title", "date", "description", "distribution", "toc", "sections"),
}

DESCRIPTION = (
    "Отчёт обобщает сообщения из открытых источников. Дата: {date}. Сообщений с текстом: {n_messages}. "
    "Тематических категорий: {n_labels}."
)

# Block number of what closes a section, behind all numbers a text can reach.
LAST_BLOCK = 2**31 - 1

ORDER_COLUMNS = ("part_no", "section_no", "block_no", "item_no")


def report_date(as_of: dt.datetime) -> str:
    return as_of.strftime("%d.%m.%Y")


def report_basename(as_of: dt.datetime) -> str:
    return f"problems_report_{as_of.strftime('%Y%m%d_%H%M')}"


def country_display(df: DataFrame, column: str = "country", output: str = "display", pairs=COUNTRY_DISPLAY):
    """The country as it reads in a title; names without an entry stay as they are."""
    return lookup_or_self(df, literal_table(df.sparkSession, pairs, "name string, shown string"), column, output)


def notebook_heading(label: Column, ru: Column) -> Column:
    return optional_suffix(label, ru, " — ")


def toc(labels: DataFrame) -> DataFrame:
    """(rank, text): one line per label in order of rank, also for labels that have no section.

    ``labels`` has label, problem_ru and rank.
    """
    line = F.concat(
        F.col("rank").cast("string"), F.lit(". "), notebook_heading(F.col("label"), F.col("problem_ru"))
    )
    return labels.select("rank", line.alias("text"))


def description_block(facts: DataFrame, as_of: dt.datetime, template: str = DESCRIPTION) -> DataFrame:
    """(text): the template filled with the corpus facts."""
    values = {c: F.col(c).cast("string") for c in facts.columns}
    return facts.select(render(template, date=report_date(as_of), **values).alias("text"))


def _rows(df: DataFrame, part: str, layout: str, kind, text, section=0, block=0, item=0, value=None) -> DataFrame:
    def as_column(v):
        return v if isinstance(v, Column) else F.lit(v)

    return df.select(
        F.lit(PART_ORDERS[layout].index(part) + 1).alias("part_no"),
        F.lit(part).alias("part"),
        as_column(section).cast("int").alias("section_no"),
        as_column(block).cast("int").alias("block_no"),
        as_column(item).cast("int").alias("item_no"),
        as_column(kind).alias("kind"),
        as_column(text).cast("string").alias("text"),
        as_column(value).cast("bigint").alias("value"),
    )


def section_rows(blocks: DataFrame, layout: str = "report", sources_title: str = SOURCES_TITLE) -> DataFrame:
    """The sections of the report: a title row, then the blocks; links follow a subheading of their own.

    ``blocks`` has section_no, title, block_no, type, text and items, already filtered.
    """
    lead = F.struct(F.lit("subheading").alias("kind"), F.lit(sources_title).alias("text"))
    links = F.transform("items", lambda u: F.struct(F.lit("source").alias("kind"), u.alias("text")))
    whole = F.array(F.struct(F.col("type").alias("kind"), F.col("text").alias("text")))
    rows = F.when(F.col("type") == "sources", F.concat(F.array(lead), links)).otherwise(whole)
    single = blocks.select("section_no", "block_no", F.posexplode(rows).alias("item_no", "_row"))
    titles = blocks.select("section_no", "title").distinct()
    body = _rows(
        single,
        "sections",
        layout,
        F.col("_row.kind"),
        F.col("_row.text"),
        section=F.col("section_no"),
        block=F.col("block_no"),
        item=F.col("item_no"),
    )
    heads = _rows(
        titles, "sections", layout, "section_title", F.col("title"), section=F.col("section_no"), block=-1
    )
    return heads.unionByName(body)


def section_blocks(sections: DataFrame) -> DataFrame:
    """Sections with rank, title, text and failed -> blocks with section_no and title.

    The text of a failed section is an error message and stays one paragraph, whatever it looks like.
    """
    numbered = sections.withColumn("section_no", F.col("rank"))
    parsed = parse_blocks(numbered.filter("NOT failed"), keep=("section_no", "title"), fallback=True)
    errors = numbered.filter("failed").select(
        "section_no",
        "title",
        F.lit(0).alias("block_no"),
        F.lit("paragraph").alias("type"),
        "text",
        F.lit(None).cast("array<string>").alias("items"),
    )
    return parsed.unionByName(errors)


def noted_blocks(sections: DataFrame) -> DataFrame:
    """Sections with rank, title, text and links -> blocks with section_no and title.

    The texts have blank lines between paragraphs; the links of the group close the section.
    """
    numbered = sections.withColumn("section_no", F.col("rank"))
    no_items = F.lit(None).cast("array<string>").alias("items")
    parsed = split_paragraphs(numbered, keep=("section_no", "title")).select("*", no_items)
    sources = numbered.filter(F.size("links") > 0).select(
        "section_no",
        "title",
        F.lit(LAST_BLOCK).alias("block_no"),
        F.lit("sources").alias("type"),
        F.lit(None).cast("string").alias("text"),
        F.col("links").alias("items"),
    )
    return parsed.unionByName(sources)


def build_report(
    blocks: DataFrame,
    ranked: DataFrame,
    toc_lines: DataFrame,
    description: DataFrame,
    country: str,
    as_of: dt.datetime,
    title: str = REPORT_TITLE,
    layout: str = "report",
    sources_title: str = SOURCES_TITLE,
) -> DataFrame:
    """All parts of the report in one table, to be read in the order of ``ORDER_COLUMNS``.

    ``blocks`` are filtered section blocks (see ``section_rows``); ``ranked`` is the distribution, whose rows
    have the count as ``value``.
    """
    one = blocks.sparkSession.range(1)
    shown = dict(COUNTRY_DISPLAY).get(country, country)
    # The heading and the table header are there only when the distribution has rows; rank 1 stands for that.
    top = ranked.filter("rank = 1")
    parts = [
        _rows(one, "title", layout, "title", title.format(country=shown)),
        _rows(one, "date", layout, "paragraph", REPORT_DATE_LINE + report_date(as_of)),
        _rows(one, "toc", layout, "heading", TOC_HEADING),
        _rows(toc_lines, "toc", layout, "toc_line", F.col("text"), block=F.col("rank")),
        _rows(one, "description", layout, "heading", DESCRIPTION_HEADING),
        _rows(description, "description", layout, "paragraph", F.col("text"), block=1),
        _rows(top, "distribution", layout, "heading", DISTRIBUTION_HEADING, block=-1),
        _rows(top, "distribution", layout, "table_header", "|".join(DISTRIBUTION_COLUMNS)),
        _rows(
            ranked,
            "distribution",
            layout,
            "table_row",
            F.col("label"),
            block=F.col("rank"),
            value=F.col("count"),
        ),
        section_rows(blocks, layout, sources_title),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
