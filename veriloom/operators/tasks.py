"""Task lists: loading, shards, resuming."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veriloom.sources.storage import cut


def load_tasks(inventory: DataFrame, ids: DataFrame | None = None, root: str = "") -> DataFrame:
    """id, informal_statement, formal_statement, tag (empty by default), version, source_file; of ids, if given."""
    tag = F.coalesce("tag", F.expr("cast(array() as array<string>)")) if "tag" in inventory.columns else F.expr("cast(array() as array<string>)")
    version = F.col("version") if "version" in inventory.columns else F.lit(None).cast("string")
    tasks = inventory.select(F.col("id").cast("int").alias("id"), "informal_statement", "formal_statement", tag.alias("tag"), version.alias("version"))
    tasks = tasks.withColumn("source_file", F.concat(F.lit(f"{root}/tasks/"), F.col("id").cast("string"), F.lit(".lean")))
    return tasks if ids is None else tasks.join(ids.select(F.col("id").cast("int").alias("id")).distinct(), "id", "left_semi")


def ordinal(rows: DataFrame, order: list[str], parts: int | None = None, pos: str = "row_pos") -> DataFrame:
    """row_pos, from 0, in the given order, without one task that sorts everything: ranges are sorted, written once with each row's place, and counted.

    Of rows that are equal in all columns of the order, any may come first. A column named `pos` is replaced; no other name
    clashes. parts: the number of ranges, else the session's number of shuffle partitions.
    """
    bits = 33  # of monotonically_increasing_id, below the partition's number
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != pos]).alias("row")
    ranged = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    dealt = cut(ranged.sortWithinPartitions(*order).select(row, F.monotonically_increasing_id().alias("at")))
    part = F.shiftright("at", bits).alias("part")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    base = dealt.groupBy(part).agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = dealt.select("row", "at", part).join(F.broadcast(base), "part")
    return placed.select("row.*", (F.col("base") + F.col("at").bitwiseAND((1 << bits) - 1)).alias(pos))


def by_id(results: DataFrame, key: str = "id") -> DataFrame:
    """Results in the order of their ids as numbers."""
    return results.orderBy(F.col(key).cast("long"))


def shard(rows: DataFrame, shards: int, pos: str = "row_pos") -> DataFrame:
    if shards < 1:
        raise ValueError("shards must be positive")
    return rows.withColumn("shard", F.pmod(F.col(pos), F.lit(shards)))


def pending(tasks: DataFrame, prior: DataFrame, key: str = "id", force: bool = False) -> DataFrame:
    """Tasks without a prior result; all if forced."""
    return tasks if force else tasks.join(prior.select(key), key, "left_anti")


def merge(tasks: DataFrame, prior: DataFrame, new: DataFrame, key: str = "id", pos: str = "line") -> DataFrame:
    """Results of the current tasks: the new ones, else the prior ones (of an id's several, the last line); others are dropped."""
    last = prior.groupBy(key).agg(F.max_by(F.struct(*[c for c in prior.columns if c != key]), F.col(pos)).alias("r")).select(key, "r.*").drop(pos)
    reused = last.join(new.select(key), key, "left_anti")
    return reused.unionByName(new, allowMissingColumns=True).join(tasks.select(key).distinct(), key, "left_semi")
