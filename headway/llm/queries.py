"""The numbered operators as queries over the given tables, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headway.llm import decontaminate, html, jaccard, lexical, lm, mixing, oracle, passages, quality, reputation, resample, sharding, templates, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


@query("op1_balanced_label_propagation")
def op1_balanced_label_propagation(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"))


@query("op2_ngram_jaccard_join", oracle.JACCARD)
def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents"), n=3, num=90, den=100)


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op4_html_extraction")
def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


@query("op5_lm_scoring")
def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.lm_scores(table(spark, folder, "documents"))


@query("op6_mix_sources")
def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@query("op7_benchmark_decontamination", oracle.DECONTAMINATION)
def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.decontamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op8_line_templates", oracle.TEMPLATES)
def op8_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    return templates.drop_templates(table(spark, folder, "documents"))


@query("op9_shared_passages")
def op9_shared_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.shared_passages(table(spark, folder, "documents"))


@query("op10_quality_rules", oracle.QUALITY)
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.quality_rules(table(spark, folder, "documents"))
    return found.drop("n_lines", "n_echo_words")


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


@query("op11_url_reputation", oracle.URL_FILTER)
def op11_url_reputation(spark: SparkSession, folder: str) -> DataFrame:
    found = reputation.url_filter(table(spark, folder, "pages"), URL_RULES)
    return found.drop("bad_rate", "bound")


@query("op12_norm_bucket_search", oracle.LEXICAL)
def op12_norm_bucket_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_importance_resample", oracle.RESAMPLE)
def op13_importance_resample(spark: SparkSession, folder: str) -> DataFrame:
    return resample.importance_resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
