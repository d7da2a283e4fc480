"""A corpus pipeline: toxicity, language, near duplicates, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of ``docs``.
``run`` writes each stage's table to the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from issuescope.llm.common import load
from issuescope.llm.language import fit_language, keep_identified
from issuescope.llm.minhash import minhash_components
from issuescope.llm.mixing import curriculum
from issuescope.llm.packing import pack_documents
from issuescope.llm.toxicity import drop_toxic, fit_toxicity
from issuescope.operators.lookup import columns_of, free_name
from issuescope.session import stage_table

#: Documents that share this part of their 5-word shingles are near copies.
NEAR_PERCENT = 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain finds toxic go.

    Null and empty texts are scored like any other; rows that repeat a text stay or go together; an empty table gives an
    empty one.
    """
    return drop_toxic(docs, fit_toxicity(docs, load(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: those without a letter, null and empty ones among them.

    Rows that repeat a text stay or go together; an empty table gives an empty one.
    """
    return keep_identified(docs, fit_language(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies, 0.8 and more alike, the document with the smallest id stays.

    Documents without words are in no group and stay.  Of rows that repeat both id and text one stays, of rows that
    repeat an id with other texts all; rows without an id cannot be told apart and all stay.  Columns of any name are
    kept; an empty table gives an empty one.
    """
    dropped = stage_table(
        minhash_components(docs, NEAR_PERCENT).filter("doc_id IS NOT NULL AND NOT kept").select("doc_id").distinct(), "dropped"
    )
    name = free_name(docs, "turn")
    text = F.xxhash64("text")
    rest = docs.filter("doc_id IS NOT NULL").join(dropped, "doc_id", "left_anti")
    rest = rest.withColumn(name, F.row_number().over(Window.partitionBy("doc_id", text).orderBy(text))).filter(F.col(name) == 1)
    return rest.select(*columns_of(docs)).unionByName(docs.filter("doc_id IS NULL"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source comes to its target: documents are left out or repeated, in the order of training.

    A null source is a source of its own; documents without words are never taken.  See ``curriculum``.
    """
    return curriculum(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document and its place in a sequence of 2,048 tokens.

    Null and empty texts are pieces of one token, repeated rows are packed as often as they occur, rows without an id are
    packed too, and an empty table gives an empty one.
    """
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: Classifiers trained here and the tokenizer have no SQL form; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
