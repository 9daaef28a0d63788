"""The registered queries of the training-data operators, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fill_in_middle, langid, license_scan, mixing, packing, pii, quality_rules, ranked_search, simhash, suffix_dedup, topk_search, toxicity, url_filter
from .common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("notices", F.array_join("notices", ","))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.clean_lines(table(spark, sf_dir, "documents")).drop("clean_text")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.decide(url_filter.page_captures(pages), url_filter.page_entries(pages))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.plan(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "rate")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.learn(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.transform(table(spark, sf_dir, "documents")).drop("output", "restored")


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def queries() -> dict[str, Query]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_topk_search": op2_topk_search,
        "op3_toxicity": op3_toxicity,
        "op4_quality_rules": op4_quality_rules,
        "op5_url_filter": op5_url_filter,
        "op6_simhash": op6_simhash,
        "op7_mixing": op7_mixing,
        "op8_language_id": op8_language_id,
        "op9_pii": op9_pii,
        "op10_packing": op10_packing,
        "op11_ranked_search": op11_ranked_search,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_suffix_dedup": op13_suffix_dedup,
    }


def oracle_sql() -> dict[str, str]:
    """Learned models, connected components, Newton iterations, best-fit packing and suffix arrays have none."""
    return {
        "op1_license_scan": license_scan.sql(),
        "op2_topk_search": topk_search.SQL,
        "op4_quality_rules": quality_rules.SQL,
        "op5_url_filter": url_filter.SQL,
        "op11_ranked_search": ranked_search.SQL,
        "op12_fill_in_middle": fill_in_middle.SQL,
    }
