"""From raw documents to packed training batches: five stages, each an operator of ``starward.llm``.

``STAGES`` are ``(name, function)``; a function takes the session, the documents that its predecessor kept
and the folder of the tables.  All but the last return the columns of ``documents``.

* ``language`` drops documents without a letter or in no learned language.
* ``quality`` drops documents that fail the base rules or lie outside their language's perplexity band.
* ``near_dedup`` keeps of each group of near copies the document with the smallest id.
* ``span_dedup`` takes out sentences that an earlier document has; what is then empty goes.
* ``packing`` returns the batches' rows, ``doc_id`` first.

The stages ``language``, ``near_dedup`` and ``span_dedup`` have no SQL, so neither has the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starward.llm.common import prepared
from starward.llm.language import in_a_language
from starward.llm.packing import pack
from starward.llm.perplexity import kept_documents
from starward.llm.simhash import one_of_each
from starward.llm.spans import remaining
from starward.sources.scratch import staged


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return in_a_language(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return one_of_each(docs)


def span_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    left = remaining(docs)
    if "n_chars" in left.columns:
        left = left.withColumn("n_chars", F.char_length("text").cast("bigint"))
    return left


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return pack(docs)


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("span_dedup", span_dedup),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next stage."""
    docs = prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
