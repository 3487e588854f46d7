"""A corpus pipeline: each stage applies one operator to all documents that its predecessor kept."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import linededup, mixing, neardup, queries, toxicity
from tidemark.llm.common import table
from tidemark.session import delete_path, scratch_path


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that the classifier calls toxic go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: lines that an earlier document holds go; n_chars is counted anew."""
    return linededup.cut_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one document of each group of near copies stays."""
    return neardup.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: sources at their target weights; repeated passes are rows of their own."""
    return mixing.mixed_texts(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: token counts and digests of the ids and of the decoded bytes."""
    return queries.digests(docs)


STAGES = [
    ("toxicity", toxic_documents),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

#: SQL can express neither the classifier nor the encoding; tests compare with plain Python instead.
ORACLE_SQL = None


#: Bytes of texts that a Python worker gets at a time. Executors run all stages in turn, so buffers that one
#: stage needed stay beside what the next one does.
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


@contextlib.contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of ``BATCH_BYTES`` while the block runs; then the session's own setting again."""
    own = spark.conf.get(BATCH_KEY)
    spark.conf.set(BATCH_KEY, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(BATCH_KEY, own)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet to the shared folder and read again.

    A stage's folder goes once the next one is written.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    with small_batches(spark):
        for name, stage in STAGES:
            path = scratch_path(spark, f"pipeline-{name}")
            stage(spark, docs, sf_dir).write.parquet(path)
            if before:
                delete_path(spark, before)
            docs, before = spark.read.parquet(path), path
    return docs
