"""Corpus pipeline: language ID, near-duplicate removal, decontamination,
mixing, token output. Each stage reads what its predecessor wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthcast.llm import decontaminate, lang_id, mixing, ngram_join, token_output
from monthcast.llm.common import written
from monthcast.llm.queries import held_out, tokenizer_path
from monthcast.session import scratch_path

LEAST_SCORE = 0.5

#: Rows of whole texts that Spark sends a Python worker at once, and the bytes of them.
ARROW_ROWS, ARROW_BYTES = 1000, 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """The first two stages run one after the other in the same Python
    workers, which keep the memory of their largest batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: null texts, texts without letters, and texts between
    languages (the best one's posterior is under ``LEAST_SCORE``) go. The
    posterior is over the learned languages alone, so a text in another
    language or of letter junk is not told from them and mostly stays."""
    bounded_batches(spark)
    learn = F.when(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull(), F.col("lang"))
    return lang_id.in_known_language(docs, lang_id.fit(docs, learn), LEAST_SCORE)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each group of near duplicates stays, that
    of the smallest id."""
    bounded_batches(spark)
    return ngram_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that hold a benchmark item go."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents stand as often as the mix takes them."""
    return mixing.mixed(docs)


def as_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: the id files, read back: one row for each document of the
    mix, copies included."""
    return token_output.tokens_written(docs, scratch_path(spark, "pipeline-tokens"), tokenizer_path())


STAGES = [("language ID", known_language), ("n-gram Jaccard join", one_of_each_group),
          ("benchmark decontamination", without_benchmark), ("mixing sources to target weights", mixed_to_targets),
          ("token-ID / binary output", as_token_ids)]

#: The model of the first stage and the tokenizer of the last have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return docs
