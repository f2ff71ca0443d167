"""A corpus pipeline of five stages, each an operator over all that the stage before it kept.

A stage takes (spark, documents, folder of the tables) and returns documents with the same columns;
the last one returns packed sequences. ``run`` writes each stage as Parquet to the shared folder of
``spark.checkpoint.dir`` and reads it again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerline.llm import lines, neardup, packing, quality, toxicity
from layerline.llm.common import table
from layerline.llm.queries import tokenizer_path
from layerline.operators.scale import materialize


def _kept(documents: DataFrame, judged: DataFrame, wanted) -> DataFrame:
    """Documents whose verdict is good; a verdict belongs to a key and a text.

    Verdicts are two numbers a row, their join to the texts is Spark's to choose.
    """
    good = judged.where(wanted).select(F.col("doc_id").alias("_k"), F.col("text_hash").alias("_t")).distinct()
    same = documents["doc_id"].eqNullSafe(good["_k"]) & (F.xxhash64(documents["text"]) == good["_t"])
    return documents.join(good, same, "left_semi")


def drop_toxic(spark: SparkSession, documents: DataFrame, folder: str) -> DataFrame:
    """Documents predicted toxic go; learnt from the labels of the tables."""
    settings = toxicity.Settings()
    sample = toxicity.training_sample(documents, table(spark, folder, "labels"), settings)
    return toxicity.keep_clean(documents, toxicity.fit(sample, settings), bits=settings.bits)


def drop_low_quality(spark: SparkSession, documents: DataFrame, folder: str) -> DataFrame:
    """Documents that fail the base rule, or come from a host that does, go."""
    return _kept(documents, quality.judge(documents), F.col("kept"))


def drop_lines(spark: SparkSession, documents: DataFrame, folder: str) -> DataFrame:
    """Lines that repeat an earlier one, or nearly; n_chars follows the text."""
    found = lines.deduplicate(documents, counts=False)
    size = F.length("text").cast(documents.schema["n_chars"].dataType)
    return found.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(size))


def drop_near_duplicates(spark: SparkSession, documents: DataFrame, folder: str) -> DataFrame:
    """One row of each group of near-duplicates (five words, 0.8) stays: the least (doc_id, text hash).

    Null keys come last. Of rows with the same key and text the one with the least hash of the row stays;
    rows without words and key are linked with nothing and all stay.
    """
    return neardup.keep_first(documents)


def pack(spark: SparkSession, documents: DataFrame, folder: str) -> DataFrame:
    """Token sequences, with their ids."""
    return packing.pack(documents, tokenizer_path("word_bpe_49k.json"), with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("packing", pack),
]

#: Learnt scores, edit distances and a tokenizer have no SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        documents = materialize(stage(spark, documents, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, documents, folder)
