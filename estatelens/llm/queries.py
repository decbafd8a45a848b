"""The operators of this package over whole tables, as thin queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelens.llm import (
    contamination,
    distribution_rules,
    fill_middle,
    fingerprints,
    language,
    licenses,
    line_crf,
    mixing,
    personal,
    recurrent_lm,
    resampling,
    secret_scan,
    spans,
    toxicity,
)
from estatelens.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["start"])

    def labels(kept):
        return F.array_join(F.sort_array(F.array_distinct(F.transform(kept, lambda s: s["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["found"])), F.lit(0.0)).alias("score"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_folder(spark)
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_folder(spark)
    found = personal.find_personal(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[spans.kind_count(F.col("base"), k).alias(f"n_{k}") for k in personal.BASE_KINDS],
        personal.digest(F.col("base")).alias("base_sha256"),
        spans.joined(F.col("spans")).alias("spans"),
    )


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_language(table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_folder(spark)
    found = fingerprints.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", fingerprints.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op6_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_folder(spark)
    found = contamination.scan_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        contamination.items_digest(F.col("items")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_folder(spark)
    judged = distribution_rules.quality_rules(table(spark, sf_dir, "documents"))
    return judged.withColumns({c: F.round(c, 6) for c in ("class_js", "common_js")})


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secret_scan.BASE_RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *[spans.kind_count(F.col("spans"), k).alias(f"n_{k}") for k in kinds],
        secret_scan.digest(base).alias("base_sha256"),
        spans.joined(F.col("spans")).alias("spans"),
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_folder(spark)
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        F.round(F.get("positions", F.lit(0)), 9).alias("first_position"),
    )


def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score_documents(table(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.col("n_features").cast("bigint").alias("n_features"), "weight", "score", "rank")


def registered() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_license_scan,
            op2_toxicity,
            op3_personal_data,
            op4_language,
            op5_near_duplicates,
            op6_contamination,
            op7_quality_rules,
            op8_secrets,
            op9_mixing,
            op10_line_quality,
            op11_language_model,
            op12_fill_middle,
            op13_resampling,
        )
    }
