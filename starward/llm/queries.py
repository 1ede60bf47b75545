"""One query for each operator, over its whole table with the parameters for production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starward.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def oracles() -> dict[str, str]:
    from starward.llm.packing import pack_sql
    from starward.llm.search import ranked_sql
    from starward.llm.urls import judge_sql
    from starward.llm.variants import variants_sql

    return {
        "op2_url_association_rules": judge_sql(),
        "op10_length_bucket_packing": pack_sql(),
        "op12_document_fp_tree": ranked_sql(),
        "op13_permuterm_variants": variants_sql(),
    }


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    from starward.llm.tokens import token_counts

    return token_counts(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query
def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from starward.llm.simhash import near_duplicates

    return near_duplicates(table(spark, folder, "documents"))


@query
def op5_kd_sharding(spark: SparkSession, folder: str) -> DataFrame:
    from starward.llm.sharding import shard_documents

    return shard_documents(table(spark, folder, "documents"))


@query
def op10_length_bucket_packing(spark: SparkSession, folder: str) -> DataFrame:
    from starward.llm.packing import pack

    return pack(table(spark, folder, "documents"))


@query
def op3_sentence_span_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from starward.llm.spans import drop_repeated_spans

    return drop_repeated_spans(table(spark, folder, "documents")).select("doc_id", "text", "n_sentences", "n_removed")


@query
def op4_ngram_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    from starward.llm.perplexity import judge

    return judge(table(spark, folder, "documents"))


@query
def op1_bloom_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from starward.llm.language import identify

    return identify(table(spark, folder, "documents"))


@query
def op6_distinct_word_bpe(spark: SparkSession, folder: str) -> DataFrame:
    from starward.llm.bpe import encode_and_decode

    return encode_and_decode(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query
def op7_hash_prefix_forest(spark: SparkSession, folder: str) -> DataFrame:
    from starward.llm.forest import nearest

    return nearest(table(spark, folder, "embeddings"))


@query
def op2_url_association_rules(spark: SparkSession, folder: str) -> DataFrame:
    from starward.llm.urls import judge_urls

    return judge_urls(table(spark, folder, "pages"), table(spark, folder, "labels"))


@query
def op11_recurrent_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from starward.llm.toxicity import judge_toxicity

    return judge_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op12_document_fp_tree(spark: SparkSession, folder: str) -> DataFrame:
    from starward.llm.search import ranked

    return ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op13_permuterm_variants(spark: SparkSession, folder: str) -> DataFrame:
    from starward.llm.variants import spelling_variants

    return spelling_variants(table(spark, folder, "documents"))


ORACLE_SQL.update(oracles())
