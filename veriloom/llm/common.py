"""Helpers that the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veriloom.functions.text import let
from veriloom.sources.storage import cut, shared_dir

__all__ = ["BLANKS", "BROADCAST_ROWS", "WORD", "cut", "let", "lookup", "sampled", "shared_dir", "split_join", "table", "word_count", "words"]

#: A word is a run of characters other than the space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
#: A table of so many rows at most may be sent to every executor.
BROADCAST_ROWS = 200_000
#: The same where rows are joined by key from a table that grows with the corpus.
SMALL_ROWS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """Array of a text's words; null text: none."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def lookup(df: DataFrame, small: DataFrame, on: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join, nulls equal, with a table that has one row for each key; broadcast if it has few enough rows, else a shuffled join whose hot keys AQE splits."""
    key = small.withColumnRenamed(on, "_key")
    few = small.limit(rows + 1).count() <= rows
    return df.join(F.broadcast(key) if few else key, df[on].eqNullSafe(key["_key"]), "left").drop("_key")


def sampled(docs: DataFrame, rows: int, bytes_most: int, seed: int = 0) -> DataFrame:
    """text of about `rows` rows of docs at most, chosen by a hash of each row's place, that hold bytes_most bytes at most (or one text).

    Whole texts; written to the shared folder, nothing passes through the driver but their lengths.
    """
    n = docs.count()
    numbered = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)).alias("_h"))
    share = min(1.0, rows / max(1, n))
    some = cut(numbered.where(F.col("_h") < F.lit(int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1)).withColumn("_n", F.octet_length("text")))
    before = Window.orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)  # of the sample's hashes and lengths only
    last = some.select("_h", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("b")).where(F.col("b") < bytes_most).agg(F.max("_h").alias("h")).first()["h"]
    return some.where(F.col("_h") <= F.lit(-(2**63) if last is None else last)).select("text")


def split_join(rows: DataFrame, small: DataFrame, on: list[str], weight: str, hot: float = 0.005, how: str = "inner", few: int = SMALL_ROWS) -> DataFrame:
    """rows joined with small (a row for each key), whose column `weight` says how many of rows have its key.

    small is broadcast if it has few rows. Beyond that only its keys with over the share hot of all weights are, 1 / hot
    rows at most, so that no task gets all rows of one key; the others meet by the shuffle. Keys hold no nulls; rows and
    small are read twice. how: inner or left.
    """
    n, total = small.agg(F.count("*"), F.sum(weight)).first()
    if n <= few:
        return rows.join(F.broadcast(small), on, how)
    heavy = F.broadcast(small.where(F.col(weight) > hot * total).withColumn("_hot", F.lit(True)))
    first = rows.join(heavy, on, "left")
    added = [c for c in small.columns if c not in on]
    rest = first.where(F.col("_hot").isNull()).drop("_hot", *added).join(small.where(F.col(weight) <= hot * total), on, how)
    return first.where("_hot").drop("_hot").unionByName(rest)
