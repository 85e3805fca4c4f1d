"""Run metrics. Everything is a partial aggregate first, so that a run of any size ends in a few rows; ids are rows, never one list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _share(n: Column, of: Column) -> Column:
    return F.coalesce(F.try_divide(n.cast("double"), of.cast("double")), F.lit(0.0))


def pass_at_k(attempts: DataFrame, task: str = "task", idx: str = "idx", success: str = "success") -> DataFrame:
    """k, n_passed, n_tasks, pass_at for k from 1 to the most attempts of any task: shares of tasks with a success in the first k."""
    per = attempts.groupBy(task).agg(F.min(F.when(F.col(success), F.col(idx))).alias("first"), F.max(idx).alias("n"))
    by_first = per.groupBy("first").agg(F.count("*").alias("tasks"))
    total = per.agg(F.count("*").alias("n_tasks"), F.max("n").alias("most"))
    ks = total.where("most >= 1").select("n_tasks", F.explode(F.sequence(F.lit(1), F.col("most").cast("int"))).alias("k"))
    hits = by_first.where("first IS NOT NULL").select(F.col("first").cast("int").alias("k"), "tasks")
    upto = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)  # a row for each k
    out = ks.join(hits, "k", "left").withColumn("n_passed", F.coalesce(F.sum("tasks").over(upto), F.lit(0)))
    return out.select("k", "n_passed", "n_tasks", _share(F.col("n_passed"), F.col("n_tasks")).alias("pass_at"))


def run_metrics(results: DataFrame) -> DataFrame:
    """One row of totals from results (id, success, attempt_count, wall_seconds, attempts); the failed ids are rows of failed_ids()."""
    ok = F.coalesce("success", F.lit(False))
    seconds = F.aggregate(F.coalesce("attempts", F.expr("array()")), F.lit(0.0), lambda a, x: a + F.coalesce(x["verification"]["lean_seconds"].cast("double"), F.lit(0.0)))
    calls = F.aggregate(F.coalesce("attempts", F.expr("array()")), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x["verifier_calls"].cast("long"), F.lit(0).cast("long")))
    return results.agg(
        F.count("*").alias("attempted"), F.count_if(ok).alias("solved"), F.count_if(~ok).alias("n_failed"), F.round(F.coalesce(F.sum("wall_seconds"), F.lit(0.0)), 3).alias("total_wall_seconds_sum"),
        F.coalesce(F.sum("attempt_count"), F.lit(0)).alias("total_attempts"), F.coalesce(F.sum(calls), F.lit(0)).alias("verifier_calls"), F.round(F.coalesce(F.sum(seconds), F.lit(0.0)), 3).alias("lean_seconds_sum"),
    ).withColumn("psr", _share(F.col("solved"), F.col("attempted")))


def failed_ids(rows: DataFrame, success: str = "success", error: str | None = None) -> DataFrame:
    """id, reason of the rows that didn't succeed: `failed`, or `infrastructure` for those with an error. A row for each, in no order."""
    lost = F.col(error).isNotNull() if error else F.lit(False)
    failed = rows.where(lost | ~F.coalesce(success, F.lit(False)))
    return failed.select("id", F.when(lost, "infrastructure").otherwise("failed").alias("reason"))


def flat_attempts(results: DataFrame) -> DataFrame:
    """task, idx (from 1), success from results with nested attempts; a null verification is a failure; a task without attempts has one row of idx 0."""
    nested = results.select(F.col("id").alias("task"), F.posexplode_outer("attempts").alias("pos", "a"))
    return nested.select("task", F.coalesce(F.col("pos") + 1, F.lit(0)).alias("idx"), F.coalesce("a.verification.success", F.lit(False)).alias("success"))


def call_accounting(trace: DataFrame, by: str = "project") -> DataFrame:
    """planner_calls, executor_calls, tokens and tokens_dedup from trace rows (planning_round, planner_tokens, executor_tokens).

    tokens adds a plan's tokens again with every attempt under it, as run reports do; tokens_dedup adds them once.
    """
    rounds = trace.groupBy(by, "planning_round").agg(F.count("*").alias("n"), F.sum("planner_tokens").alias("p"), F.max("planner_tokens").alias("once"), F.sum("executor_tokens").alias("e"))
    return rounds.groupBy(by).agg(F.count("*").alias("planner_calls"), F.sum("n").alias("executor_calls"), F.sum(F.col("p") + F.col("e")).alias("tokens"), F.sum(F.col("once") + F.col("e")).alias("tokens_dedup"))


def audited_metrics(rows: DataFrame) -> DataFrame:
    """One row from (id, passed, verifier_calls, planner_calls, executor_calls, tokens): solved by the final audit."""
    ok = F.coalesce("passed", F.lit(False))
    total = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("verifier_calls", "planner_calls", "executor_calls", "tokens")]
    out = rows.agg(F.count("*").alias("attempted"), F.count_if(ok).alias("solved"), F.count_if(~ok).alias("n_failed"), *total)
    return out.withColumn("psr", _share(F.col("solved"), F.col("attempted")))


def subset_metrics(rows: DataFrame) -> DataFrame:
    """As audited_metrics, without tokens; rows with an error count as n_infrastructure and not as attempted."""
    good = F.col("error").isNull()
    ok = good & F.coalesce("passed", F.lit(False))
    total = [F.coalesce(F.sum(F.when(good, F.col(c))), F.lit(0)).alias(c) for c in ("verifier_calls", "planner_calls", "executor_calls")]
    out = rows.agg(F.count_if(good).alias("attempted"), F.count_if(ok).alias("solved"), F.count_if(good & ~ok).alias("n_failed"), F.count_if(~good).alias("n_infrastructure"), *total)
    return out.withColumn("psr", _share(F.col("solved"), F.col("attempted")))


def verification_rollup(checks: DataFrame, by: str, last: int = 30_000, projects: DataFrame | None = None) -> DataFrame:
    """One verification of a project from its files' (path, exit_code, errors, holes, output, seconds, forbidden).

    Of the outputs, joined in the order of paths, only the files that reach into the last characters are brought together.
    projects (by): those without a file get a row too, a success.
    """
    out = checks.groupBy(by).agg(
        F.bool_and(F.coalesce(F.col("exit_code") == 0, F.lit(False))).alias("success"), F.sum("errors").alias("global_errors"), F.sum("holes").alias("holes"),
        F.round(F.sum("seconds"), 3).alias("seconds"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("forbidden")))).alias("forbidden"),
    )
    later = Window.partitionBy(by).orderBy(F.desc("path"), F.desc("output")).rowsBetween(Window.unboundedPreceding, -1)
    ends = checks.select(by, "path", "output").withColumn("after", F.coalesce(F.sum(F.length("output") + 1).over(later), F.lit(0))).where(F.col("after") <= last)
    tails = ends.groupBy(by).agg(F.right(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("path", "output"))), lambda x: x["output"]), "\n"), F.lit(last)).alias("output"))
    out = out.join(tails, by, "left")
    if projects is not None:
        out = projects.select(by).distinct().join(out, by, "left").withColumn("success", F.coalesce("success", F.lit(True))).fillna(0, ["global_errors", "holes", "seconds"]).fillna("", ["output"])
        out = out.withColumn("forbidden", F.coalesce("forbidden", F.expr("cast(array() as array<string>)")))
    return out.withColumn("exit_code", F.when(F.col("success"), 0).otherwise(1))


def alignment_scores(alignments: DataFrame, items: DataFrame, by: str = "row_id") -> DataFrame:
    """matched, total, scc for each row of items (row_id, ...); alignments (row_id, matched). More matches than items score above 1."""
    m = alignments.groupBy(by).agg(F.count_if(F.coalesce("matched", F.lit(False))).alias("matched"))
    t = items.groupBy(by).agg(F.count("*").alias("total"))
    both = t.join(m, by, "full").select(by, F.coalesce("matched", F.lit(0)).alias("matched"), F.coalesce("total", F.lit(0)).alias("total"))
    return both.withColumn("scc", _share(F.col("matched"), F.col("total")))
