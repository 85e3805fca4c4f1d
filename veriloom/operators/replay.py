"""Accept/revert histories as window functions over recorded attempts. One shuffle by project serves every window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def truncate_at_success(attempts: DataFrame, by: list[str], order: list[str], success: str = "success") -> DataFrame:
    """A project's attempts to its first success, that one included."""
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    done = F.coalesce(F.max(F.coalesce(F.col(success), F.lit(False)).cast("int")).over(before), F.lit(0))
    return attempts.withColumn("_done", done).where("_done = 0").drop("_done")


def last_attempt(attempts: DataFrame, by: list[str], order: str) -> DataFrame:
    rest = [c for c in attempts.columns if c not in by]
    return attempts.groupBy(*by).agg(F.max_by(F.struct(*rest), F.col(order)).alias("a")).select(*by, "a.*")


def replay(attempts: DataFrame, by: str = "project", order: list[str] | None = None, start: Column | None = None) -> DataFrame:
    """accepted, retained, current_errors, current_holes, draft_holes, draft_errors for each attempt (errors, holes, raised).

    An attempt is accepted if (errors, holes) is strictly less than the least so far, start (a struct of both; none: every
    first attempt that doesn't raise is accepted) included. A raising attempt is never accepted or retained. Since the last
    acceptance, an attempt that isn't accepted is retained if its (holes, errors), in that order, is strictly less than the
    frontier, which begins at the accepted values.
    """
    w = Window.partitionBy(by).orderBy(*(order or ["attempt"]))
    before, upto = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    ok = ~F.coalesce(F.col("raised"), F.lit(False))
    objective = F.when(ok, F.struct(F.col("errors").cast("int").alias("errors"), F.col("holes").cast("int").alias("holes")))
    out = attempts.withColumn("_o", objective)
    least = F.min("_o").over(before)
    best = F.least(least, start) if start is not None else least
    out = out.withColumn("_best", best).withColumn("accepted", F.col("_o").isNotNull() & (F.col("_best").isNull() | (F.col("_o") < F.col("_best"))))
    out = out.withColumn("_cur", F.least(F.col("_best"), F.col("_o"))).withColumn("_epoch", F.sum(F.col("accepted").cast("int")).over(upto))
    rank = lambda s: F.struct(s["holes"].alias("holes"), s["errors"].alias("errors"))
    out = out.withColumn("_r", F.when(F.col("_o").isNotNull(), rank(F.col("_o"))))
    e = Window.partitionBy(by, "_epoch").orderBy(*(order or ["attempt"]))
    frontier = F.min("_r").over(e.rowsBetween(Window.unboundedPreceding, -1))
    if start is not None:  # before any acceptance, the frontier begins at start
        frontier = F.when(F.col("_epoch") == 0, F.least(frontier, rank(start))).otherwise(frontier)
    out = out.withColumn("_f", frontier)
    out = out.withColumn("retained", F.coalesce(~F.col("accepted") & (F.col("_r") < F.col("_f")), F.lit(False)))
    draft = F.when(F.col("accepted"), F.col("_r")).otherwise(F.least(F.col("_f"), F.col("_r")))
    out = out.withColumn("_d", draft)
    return out.select(*attempts.columns, "accepted", "retained", F.col("_cur.errors").alias("current_errors"), F.col("_cur.holes").alias("current_holes"), F.col("_d.holes").alias("draft_holes"), F.col("_d.errors").alias("draft_errors"))
