"""Which column plays which part."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..constants import LINK_COLUMN, MESSAGE_COLUMNS, PROBLEM_COLUMNS, PROBLEM_RU_COLUMNS, TITLE_COLUMN


@dataclass(frozen=True)
class ColumnRoles:
    """Column names by role; None where the data has no such column."""

    message: str
    problem: str | None = None
    problem_ru: str | None = None
    link: str | None = None
    title: str | None = None


def first_present(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """The first candidate among the columns, letter case included."""
    present = set(columns)
    return next((c for c in candidates if c in present), None)


def resolve_columns(
    df: DataFrame,
    require_problem: bool = True,
    problem: Sequence[str] = PROBLEM_COLUMNS,
    problem_ru: Sequence[str] = PROBLEM_RU_COLUMNS,
    message: Sequence[str] = MESSAGE_COLUMNS,
    link: Sequence[str] = (LINK_COLUMN,),
    title: Sequence[str] = (TITLE_COLUMN,),
) -> ColumnRoles:
    """Find the columns by name.  Without a base label column the translated one serves for both."""
    columns = df.columns
    ru = first_present(columns, problem_ru)
    base = first_present(columns, problem) or ru
    if base is None and require_problem:
        raise ValueError(f"no label column; looked for {list(problem)}")
    text = first_present(columns, message)
    if text is None:
        raise ValueError(f"no message column; looked for {list(message)}")
    return ColumnRoles(text, base, ru, first_present(columns, link), first_present(columns, title))
