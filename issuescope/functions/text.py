"""Column expressions over text.  All of them stay inside the JVM."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import WHITESPACE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove Unicode whitespace at both ends (``trim`` alone removes spaces only)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def lstrip(c: Column | str) -> Column:
    return F.ltrim(_col(c), F.lit(WHITESPACE))


def rstrip(c: Column | str) -> Column:
    return F.rtrim(_col(c), F.lit(WHITESPACE))


def clean_text(c: Column | str) -> Column:
    """Stripped text; null becomes the empty string."""
    return strip(F.coalesce(_col(c), F.lit("")))


def truncate_text(c: Column | str, max_chars: int, ellipsis: str = "...") -> Column:
    """Stripped text, cut to ``max_chars`` code points plus ``ellipsis``; blank and null become null."""
    s = strip(c)
    cut = F.concat(F.substring(s, 1, max_chars), F.lit(ellipsis))
    return F.nullif(F.when(F.char_length(s) > max_chars, cut).otherwise(s), F.lit(""))


def label_key(c: Column | str) -> Column:
    """The form in which labels are compared."""
    return F.lower(clean_text(c))


def text_key(c: Column | str, labels: Sequence[str], hex_chars: int = 16) -> Column:
    """Identity of a text under a label list: leading hex digits of a SHA-256."""
    if not 1 <= hex_chars <= 64:
        raise ValueError("hex_chars must lie between 1 and 64")
    joined = F.concat(_col(c), F.lit("|" + "|".join(labels)))
    return F.substring(F.sha2(joined, 256), 1, hex_chars)


def strip_fence(c: Column | str) -> Column:
    """Remove a code fence around a model answer, with its language hint."""
    s = strip(c)
    inner = F.btrim(s, F.lit("`"))
    bare = F.regexp_replace(inner, r"\A(?i:json|javascript|js)\n", "")
    return F.when(F.startswith(s, F.lit("```")), bare).otherwise(s)


def render(template: str, **values: Column | str) -> Column:
    """Fill the ``{name}`` places of a template with columns or constants."""
    parts = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            value = values[name]
            parts.append(F.lit(value) if not isinstance(value, Column) else F.coalesce(value, F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def bullet_list(items: Column, separator: str) -> Column:
    """``- item`` lines; a null array gives the empty string."""
    lines = F.transform(items, lambda x: F.concat(F.lit("- "), x))
    return F.coalesce(F.array_join(lines, separator), F.lit(""))


def optional_suffix(base: Column, extra: Column, before: str, after: str = "") -> Column:
    """``base`` alone, or followed by ``extra`` when that is neither null nor empty."""
    return F.when(
        F.coalesce(extra, F.lit("")) != "", F.concat(base, F.lit(before), extra, F.lit(after))
    ).otherwise(base)
