"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    exact,
    language,
    licences,
    minhash,
    mixing,
    prefixes,
    quantise,
    ranked,
    recurrent,
    reputation,
    toxicity,
    trie,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, good): a page shows the document whose number its path ends with;
    it is good if the document has good quality and is not toxic."""
    number = F.regexp_extract(reputation.url_path(F.col("url")), "/([0-9]{1,18})", 1)
    shown = pages.select("page_id", number.try_cast("long").alias("doc_id"))
    marks = labels.filter("quality IS NOT NULL AND toxic IS NOT NULL")
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")
    marks = marks.groupBy("doc_id").agg(F.min(good).alias("good"))
    return shown.join(marks, "doc_id").select("page_id", "good")


def op3_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    return reputation.judge_urls(pages, page_outcomes(pages, labels))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.token_counts(table(spark, sf_dir, "documents"))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(table(spark, sf_dir, "documents"))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent.language_model_scores(table(spark, sf_dir, "documents"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantise.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixing.document_copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", taken
    )


def op11_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.top_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_url_reputation": op3_url_reputation,
    "op4_minhash": op4_minhash,
    "op5_token_counts": op5_token_counts,
    "op6_licences": op6_licences,
    "op7_language_model": op7_language_model,
    "op8_embeddings": op8_embeddings,
    "op9_language": op9_language,
    "op10_mixing": op10_mixing,
    "op11_exact_duplicates": op11_exact_duplicates,
    "op12_ranked_search": op12_ranked_search,
    "op13_prefix_trie": op13_prefix_trie,
}
