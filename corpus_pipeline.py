"""The corpus pipeline: each stage reads all that its predecessor kept and returns the columns of documents, the last one packed pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriloom.llm import line_dedup, mixing, near_dedup, packing, toxicity
from veriloom.llm.common import cut, table
from veriloom.sources import storage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's threshold; the classifier learns from the labels of those that are there."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).where(~F.col("toxic")).select(*docs.columns)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines whose templates recur."""
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.drop_near_copies(docs).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks."""
    return mixing.emit(mixing.mix_sources(docs)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with their ids."""
    packed = packing.pack(docs)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_recurring_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: A trained classifier and a tokenizer are no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        since = storage.mark()
        made = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return made
        docs = cut(made)
        storage.discard(spark, since, but=docs)  # the stage's own tables
    return docs
