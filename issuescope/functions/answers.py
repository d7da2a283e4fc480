"""Column expressions that read model answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_fence

_NUMERIC = r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT|BOOLEAN)$"


def parse_label_ids(answer: Column | str, max_labels: int) -> Column:
    """``{"problem_ids": [...]}`` -> struct(ids array<int>, parse_error string).

    Only JSON numbers and booleans count (a number in quotes does not); they are truncated to integers and cut
    to ``max_labels`` before anyone asks whether the ids exist.  A non-list gives no ids.  Text that is not a
    JSON object is reported in ``parse_error``.
    """
    doc = F.try_parse_json(strip_fence(answer))
    is_object = F.coalesce(F.startswith(F.schema_of_variant(doc), F.lit("OBJECT")), F.lit(False))
    given = F.coalesce(
        F.try_variant_get(doc, "$.problem_ids", "array<variant>"), F.array().cast("array<variant>")
    )
    numbers = F.filter(given, lambda v: F.coalesce(F.schema_of_variant(v).rlike(_NUMERIC), F.lit(False)))
    kept = F.transform(F.slice(numbers, 1, max_labels), lambda v: F.try_variant_get(v, "$", "int"))
    return F.when(
        is_object,
        F.struct(
            F.filter(kept, lambda i: i.isNotNull()).alias("ids"),
            F.lit(None).cast("string").alias("parse_error"),
        ),
    ).otherwise(
        F.struct(
            F.array().cast("array<int>").alias("ids"), F.lit("answer is not a JSON object").alias("parse_error")
        )
    )


def single_label_key(answer: Column | str) -> Column:
    """A one-label answer in the form in which labels are looked up."""
    from .text import clean_text

    return F.lower(F.btrim(clean_text(answer), F.lit(" .,:;\"'`")))
