"""A training-corpus pipeline: quality filter, near-duplicate join, substring dedup, decontamination, encoding.

Part of the subpackage emberlog.llm. Each stage takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next one's docs. All but the last return the
columns of docs. Nulls, repeated rows and empty texts are treated as the operators say.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm import bpe, byte_cnn, common, decontamination, ngram_join, substring_dedup


def _small_batches(spark: SparkSession) -> None:
    """Fewer rows for each Arrow batch: executors hold several batches of whole texts at once, in the JVM and in Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    _small_batches(spark)
    return byte_cnn.keep_good(docs, byte_cnn.train(docs, common.table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 stays, that with the smallest id."""
    _small_batches(spark)
    return ngram_join.keep_one(docs, width=5, num=80, den=100)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in repeated windows go from the texts, and n_chars follows; texts without any stay as they are."""
    _small_batches(spark)
    out = substring_dedup.remove_repeats(docs, [c for c in docs.columns if c != "text"], texts=True)
    changed = {"text": F.col("kept"), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("rec.n_chars")) if "n_chars" in docs.columns else None}
    return out.select([changed[c].alias(c) if c in changed else F.col(f"rec.`{c}`").alias(c) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    _small_batches(spark)
    return decontamination.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become tokens, which are written; less is remembered than by default, and for a task only, as Python workers go on from stage to stage."""
    _small_batches(spark)
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids=True, states=40_000, pieces=60_000, keep=False)


STAGES = [("quality_classifier", quality), ("ngram_jaccard_join", near_duplicates), ("substring_dedup", substrings), ("benchmark_decontamination", decontaminate), ("byte_level_bpe", encode)]

#: Trained models and components of links are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage saved on its way, and its input, go once it is written."""
    docs, before = common.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path, mark = f"{common.shared_folder(spark)}/emberlog-pipeline-{name}-{uuid.uuid4().hex}", common.saved_so_far()
        stage(spark, docs, sf_dir).write.parquet(path)
        common.drop_since(spark, mark)
        if before:
            common.remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
