"""Connected components of a table of links, by alternating star steps; nothing but a checksum reaches the driver.

A node with a large share of all links is joined by a broadcast (split_join), so that the hub of a large component is not one
task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, split_join


#: Links of so many nodes at most are joined plainly: one task could take them all.
PLAIN = 1_000_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def _join(rows: DataFrame, least: DataFrame, on: str, n: int) -> DataFrame:
    """rows with m of their node; tables of few links need no split."""
    return rows.join(least.drop("n"), on) if n <= PLAIN else split_join(cut(rows), cut(least), [on], "n", few=0).drop("n")


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component (its smallest node) for every node of links (a, b), in either direction, repeats and loops allowed."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges = cut(edges)
    state = _state(edges)
    for _ in range(rounds):
        if not state[0]:
            break
        # Large star: a node's larger neighbours go to its smallest one.
        both = edges.select(F.col("hi").alias("x"), F.col("lo").alias("y")).union(edges.select(F.col("lo").alias("x"), F.col("hi").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"), F.count_if(F.col("y") > F.col("x")).alias("n")).where("n > 0")
        large = _join(both.where("y > x"), least, "x", state[0]).select(F.col("y").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        # Small star: a node and its smaller neighbours go to the smallest of these.
        least = large.groupBy("hi").agg(F.min("lo").alias("m"), F.count("*").alias("n"))
        small = _join(large, least, "hi", state[0])
        small = small.select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*").where("hi <> lo").distinct()
        edges = cut(small)
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"no end after {rounds} rounds")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
