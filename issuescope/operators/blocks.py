"""Section texts as typed blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    BULLETS,
    CONCLUSION_PREFIX,
    HEADING_PATTERN,
    HEADING_WORDS,
    LINE_BREAK,
    OPENING_QUOTES,
    QUOTES_HEADING,
    SOURCES_HEADING,
)
from ..functions.text import clean_text, lstrip, rstrip, strip



def text_lines(text: Column) -> Column:
    """The lines that are not blank, without the blanks at their ends; leading blanks stay."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), LINE_BREAK), rstrip), lambda x: x != "")


def _starts_with_any(s: Column, prefixes: Sequence[str]) -> Column:
    hit = F.startswith(s, F.lit(prefixes[0]))
    for prefix in prefixes[1:]:
        hit = hit | F.startswith(s, F.lit(prefix))
    return hit


def is_heading(s: Column) -> Column:
    return s.rlike(HEADING_PATTERN)


def is_link(s: Column) -> Column:
    return _starts_with_any(s, ("http://", "https://"))


def is_quote(s: Column) -> Column:
    in_brackets = F.endswith(s, F.lit(")")) & F.contains(s, F.lit("("))
    return _starts_with_any(s, BULLETS) | F.substring(s, 1, 1).isin(*OPENING_QUOTES) | in_brackets


def _line_code(s: Column) -> Column:
    """One letter per stripped line.

    q, s, h: a heading (of quotes, of sources, other); k, l: a link (like a quote or not); u, p: other lines.
    """
    start = F.lower(F.substring(s, 1, max(map(len, HEADING_WORDS))))
    heading = (
        F.when(F.startswith(start, F.lit(QUOTES_HEADING)), F.lit("q"))
        .when(F.startswith(start, F.lit(SOURCES_HEADING)), F.lit("s"))
        .otherwise(F.lit("h"))
    )
    # The first word decides for most lines, without the regular expression.
    return (
        F.when(_starts_with_any(start, HEADING_WORDS) & is_heading(s), heading)
        .when(is_link(s), F.when(is_quote(s), F.lit("k")).otherwise(F.lit("l")))
        .otherwise(F.when(is_quote(s), F.lit("u")).otherwise(F.lit("p")))
    )


def _resolve_modes(codes: Column) -> Column:
    r"""What a line is depends on the headings above it; the letters of a text show that at a glance.

    ``\G`` continues directly after the match before, so each pattern walks one run of lines.
    """
    # Links right under a sources heading: L begins the list, m goes on with it.
    codes = F.regexp_replace(codes, "(?<=s)[kl]", "L")
    codes = F.regexp_replace(codes, r"(?:(?<=L)|(?!^)\G)[kl]", "m")
    # The first other line ends the list and is dropped.
    codes = F.regexp_replace(codes, "(?<=[sLm])[up]", "x")
    # Under a quotes heading everything is a quote.
    return F.regexp_replace(codes, r"(?:(?<=q)|(?!^)\G)[klup]", "u")


def _quote_text(s: Column) -> Column:
    return F.when(_starts_with_any(s, BULLETS), lstrip(F.substr(s, F.lit(3)))).otherwise(s)


def parse_blocks(
    df: DataFrame, text: str = "text", keep: Sequence[str] = ("section_id",), fallback: bool = False
) -> DataFrame:
    """Section texts -> (<keep>, block_no, type, text, items).

    Types are subheading, paragraph, quote and sources; ``items`` holds the links of a sources block.
    ``fallback`` turns a text without blocks into one paragraph.

    A text is parsed where it lies: its lines become letters, the letters settle what each line is, and the
    lines are joined again with one break per block.  No line is shuffled.
    """
    cut = df.select(*keep, F.col(text).alias("_whole"), text_lines(F.col(text)).alias("_lines"))
    bare = cut.withColumn("_bare", F.transform("_lines", lstrip))
    coded = bare.withColumn("_codes", _resolve_modes(F.array_join(F.transform("_bare", _line_code), "")))
    triples = F.arrays_zip(
        F.col("_lines").alias("line"), F.col("_bare").alias("bare"), F.split("_codes", "").alias("code")
    )

    def packed(triple: Column) -> Column:
        # Lines hold no line breaks, so these can separate blocks (\n) and list items (\r).
        line, bare, code = (triple.getField(f) for f in ("line", "bare", "code"))
        return (
            F.when(code.isin("l", "p"), F.concat(F.lit("\np"), line))
            .when(code.isin("u", "k"), F.concat(F.lit("\nu"), _quote_text(bare)))
            .when(code == "m", F.concat(F.lit("\r"), bare))
            .when(code == "x", F.lit(""))
            .otherwise(F.concat(F.lit("\n"), code, bare))
        )

    joined = F.array_join(F.transform(triples, packed), "")
    blocks = F.when(F.size("_lines") > 0, F.split(F.substr(joined, F.lit(2)), "\n"))
    if fallback:
        blocks = F.coalesce(blocks, F.array(F.concat(F.lit("p"), F.coalesce("_whole", F.lit("")))))
    # Only the keys go along: a long text next to each of its blocks would be copied once per block.
    single = coded.select(*keep, F.posexplode(blocks).alias("block_no", "_block"))
    code, body = F.substring("_block", 1, 1), F.substr("_block", F.lit(2))
    kind = (
        F.when(code == "p", F.lit("paragraph"))
        .when(code == "u", F.lit("quote"))
        .when(code == "L", F.lit("sources"))
        .otherwise(F.lit("subheading"))
    )
    return single.select(
        *keep,
        "block_no",
        kind.alias("type"),
        F.when(code != "L", body).alias("text"),
        F.when(code == "L", F.split(body, "\r")).alias("items"),
    )


def filter_blocks(blocks: DataFrame, patterns: Sequence[str] = (), title: str | None = None) -> DataFrame:
    """Remove blocks the report does not show.

    Subheadings that announce sources go (a sources block brings its own), as do blocks of unknown type and
    sources blocks without links.  ``patterns`` are regular expressions matched without regard to case: they
    remove blocks and single links, and whole sections by their ``title`` column.  A section that loses all its
    blocks has no rows left.
    """

    def banned(c: Column) -> Column:
        hit = F.lit(False)
        for pattern in patterns:
            hit = hit | F.coalesce(c.rlike(f"(?iU){pattern}"), F.lit(False))
        return hit

    announces = (F.col("type") == "subheading") & F.startswith(
        F.lower(clean_text("text")), F.lit(SOURCES_HEADING)
    )
    shown = blocks.filter(F.col("type").isin("paragraph", "quote", "subheading", "sources") & ~announces)
    if patterns:
        if title is not None:
            shown = shown.filter(~banned(F.col(title)))
        shown = shown.filter((F.col("type") == "sources") | ~banned(F.col("text")))
        shown = shown.withColumn("items", F.filter("items", lambda link: ~banned(link)))
    return shown.filter((F.col("type") != "sources") | (F.size("items") > 0))


def split_paragraphs(df: DataFrame, text: str = "text", keep: Sequence[str] = ("section_id",)) -> DataFrame:
    """Texts with blank lines between paragraphs -> (<keep>, block_no, type, text).

    A paragraph that starts with ``##`` is a subheading and loses all its ``##``; concluding paragraphs go.
    """
    parts = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n\n"), strip)

    def typed(part: Column) -> Column:
        heading = F.startswith(part, F.lit("##"))
        body = F.when(heading, strip(F.replace(part, F.lit("##"), F.lit("")))).otherwise(part)
        kind = F.when(heading, F.lit("subheading")).otherwise(F.lit("paragraph"))
        return F.struct(kind.alias("type"), body.alias("text"))

    blocks = F.filter(
        F.transform(F.filter(parts, lambda p: p != ""), typed),
        lambda b: ~F.startswith(F.lower(b.getField("text")), F.lit(CONCLUSION_PREFIX)),
    )
    single = df.select(*keep, F.posexplode(blocks).alias("block_no", "_block"))
    return single.select(*keep, "block_no", "_block.type", "_block.text")


def quote_spans(df: DataFrame, text: str = "text", keep: Sequence[str] = ("section_id", "block_no")) -> DataFrame:
    """Split texts at ``"quoted"`` spans -> (<keep>, run_no, kind, text) with kind plain or quoted."""
    pattern = '"[^"]+"'
    plain = F.split(text, pattern)
    quoted = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    pairs = F.arrays_zip(plain.alias("plain"), quoted.alias("quoted"))

    def run(kind: str, body: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), body.alias("text"))

    runs = F.filter(
        F.flatten(
            F.transform(
                pairs, lambda p: F.array(run("plain", p.getField("plain")), run("quoted", p.getField("quoted")))
            )
        ),
        lambda r: r.getField("text") != "",
    )
    single = df.select(*keep, F.posexplode(runs).alias("run_no", "_run"))
    return single.select(*keep, "run_no", "_run.kind", "_run.text")
