"""Mixing sources to target weights with DataFrame functions only.

Words are summed by source (partial sums first, so that a hot source costs no more than another), target words follow
from the weights by filling up to a cap, and each document is taken floor(rate) times and once more by a Bernoulli draw whose
probability is the fraction. The draw is a hash of the document's id, so reruns agree. Texts are read twice, for the sums
and for the rows: a second count of words costs less than a copy of all texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, lookup, word_count


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size, weight, target, from rows of (source, size).

    Sources in order of code points, null last, get the weights in turn. share of all words is dealt by weight; a source
    stops at cap times its words and the excess goes to the others by weight. One row for each source; the windows run over
    these rows, which a corpus has few of.
    """
    per = cut(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    # Sources reach their cap in order of cap / weight: with the first k of them full, the rest share what remains.
    fill = Window.orderBy("at_level", F.col("source").asc_nulls_last())
    before, every = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    per = per.withColumn("at_level", cap * F.col("source_size") / F.col("weight"))
    per = per.withColumn("left", share * F.sum("source_size").over(every) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
    per = per.withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    per = per.withColumn("level", F.col("left") / F.col("open"))
    per = per.withColumn("level", F.min(F.when(F.col("level") <= F.col("at_level"), F.struct("at_level", F.col("source").isNull(), "source", "level"))).over(every)["level"])
    # No level fits only if all are full.
    target = F.least(cap * F.col("source_size"), F.coalesce(F.col("level") * F.col("weight"), cap * F.col("source_size")))
    return per.select("source", "source_size", "weight", target.alias("target"))


def draw(doc_id: Column, seed: str) -> Column:
    """0 <= x < 1 from 52 bits of the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: str = "mix") -> DataFrame:
    """docs and size, source_size, target, copies, taken (= copies * size).

    Null text: size 0. Null sources are a source, the last. Null ids draw as an empty id. Equal ids draw alike. Where docs
    has columns of these names, they are replaced; no other name clashes. Empty: no rows.
    """
    names = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("source"), word_count(F.col("text")).alias("size"))
    targets = cut(source_targets(sized.select("source", "size"), weights, share, cap))
    out = lookup(sized, targets.select("source", "source_size", "target"), "source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = (F.floor(rate) + (draw(F.col("row.doc_id"), seed) < rate - F.floor(rate)).cast("int")).cast("int")
    out = out.withColumn("copies", copies).withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in names], "size", "source_size", "target", "copies", "taken")


def emit(mixed: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it."""
    rows = mixed.where("copies > 0").select(F.struct(*[F.col(f"`{c}`") for c in mixed.columns]).alias("row"), F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select("row.*")
