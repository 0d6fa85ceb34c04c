"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (decontaminate, fingerprint, importance, lang_id, license_scan, mixing, nearest, ngram_join, secret_scan,
               spelling, substring_dedup, token_output, warc)
from .common import documents
from .oracle import ORACLES


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(documents(spark, sf_dir))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "warc")
    return warc.read_warc(warc.write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), root), root)


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.tokens_written(documents(spark, sf_dir), scratch_path(spark, "tokens"), tokenizer_path())


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find_items(documents(spark, sf_dir), items).drop("doc_key")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; a null id is not."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    learn = F.when(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull(), F.col("lang"))
    return (lang_id.predict(docs, lang_id.fit(docs, learn))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_pairs(documents(spark, sf_dir))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_scan(documents(spark, sf_dir), scratch_path(spark, "secret-ledger"))
    base = F.filter("spans", lambda s: s["order"] < len(secret_scan.BASE_RULES))

    def n(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", n("assign"), n("access"), n("hex"),
                        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
                        secret_scan.joined(F.col("spans")).alias("spans"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "n_links")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return importance.ranked(documents(spark, sf_dir), target).select("doc_id", "n_features", "weight", "score", "rank")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(documents(spark, sf_dir), thin_by=31, least_length=7, least_count=2)
    return spelling.variant_groups(words)


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_license_scan, op2_warc, op3_token_output, op4_decontamination, op5_language_id, op6_fingerprint,
        op7_substring_dedup, op8_secret_scan, op9_ngram_join, op10_mixing, op11_importance_resampling,
        op12_spelling_variants, op13_nearest_neighbours, pipeline)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
