"""The book's repair: texts are read once, and a project that nothing moves any more has its whole budget."""

from __future__ import annotations

import json
import time

from pyspark.sql import functions as F

from veriloom.functions import text as T
from veriloom.operators import projects
from veriloom.plans import pipelines


def test_an_answer_is_read_once(spark):
    """Before, each use of the patch and of what raised parsed the answers again."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(k):
        seen.add(1)
        return json.dumps({"files": [{"path": f"A{k}.lean", "content": "x"}]}) if k else "no JSON"

    answers = spark.range(8, numPartitions=2).select(F.col("id").alias("project"), told("id").alias("text"))
    patch, raised = pipelines._patch(answers)
    assert patch.count() == 7 and {r.project for r in raised.where("raised").collect()} == {0} and patch.where("content <> 'x\n'").count() == 0
    assert seen.value == 8


def test_blank_lines_are_walked_once(spark):
    """Before, each line of a masked comment began a walk to the comment's end for each word that may stand there."""
    began, long = time.monotonic(), "/-" + (" " * 40 + "\n") * 10_000 + "-/\naxiom a\n"
    found = projects.escape_hatches(spark.createDataFrame([(1, long.replace("axiom", "sorry"))], "p int, content string")).collect()
    assert [(r.kind, r.line) for r in found] == [("sorry", 10_002)] and time.monotonic() - began < 15


def test_blanks_are_those_of_regular_expressions(spark):
    every = spark.range(1, 0x3100).where("id NOT BETWEEN 55296 AND 57343").select(F.decode(F.encode(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')"), "UTF-8"), "UTF-8").alias("c"))
    got = every.select("c", T.strip(F.concat("c", F.lit("x"), "c")).alias("s"), F.regexp_like("c", F.lit(r"(?U)^\s\z")).alias("blank"))
    assert got.where((F.col("s") == "x") != F.col("blank")).count() == 0 and got.where("blank").count() == 25


def script(rows, column):
    """Rows and answers that depend on what is shown alone."""
    return rows.withColumn("name", F.regexp_extract(column, r"name (\w+)", 1))


def plan_more(rows):
    """A plan that grows for two rounds and then stays."""
    more = F.concat("prior_plan", F.lit("x"))
    return rows.select("project", F.when(F.length("prior_plan") < 2, more).otherwise(F.col("prior_plan")).alias("text"), F.length("goal").alias("tokens"))


def propose_some(rows):
    rows = rows.withColumn("a", F.filter("files", lambda f: f["path"] == "A.lean")[0]["content"])
    rows = script(rows, F.col("a")).withColumn("long", F.length("plan"))
    one = F.replace("a", F.lit("a : True := by\n  sorry"), F.lit("a : True := by\n  trivial"))
    all_ = F.replace("a", F.lit("sorry"), F.lit("trivial"))
    name = F.col("name")
    content = (
        F.when(name == "late", F.when(F.col("long") == 2, all_).otherwise(F.col("a")))  # solved once the plan has grown
        .when(name == "steps", F.when(F.col("long") == 1, one).otherwise(F.replace("a", F.lit("trivial"), F.lit("sorry"))))  # accepted, then worse
        .when(name == "draft", F.when(F.contains("a", F.lit("broken")), F.col("a")).otherwise(F.concat(F.lit("broken\n"), all_)))  # kept as a draft, which nothing ends
        .when(name == "swing", F.when(F.col("feedback") == "", F.concat(F.lit("broken\n"), "a")).otherwise(F.replace("a", F.lit("broken\n"), F.lit(""))))  # the feedback changes with every attempt
        .when(name == "change", F.replace("a", F.lit(": True"), F.lit(": False")))
        .otherwise(all_)
    )
    answer = F.to_json(F.struct(F.array(F.struct(F.lit("A.lean").alias("path"), content.alias("content"))).alias("files")))
    return rows.select("project", F.when(name == "mute", "no JSON").otherwise(answer).alias("text"), (F.length("feedback") + F.col("long")).alias("tokens"))


class Counted:
    def __init__(self, ask):
        self.ask, self.rows = ask, 0

    def __call__(self, rows):
        self.rows += rows.count()
        return self.ask(rows)


def test_equal_questions_are_asked_once_with_the_results_of_all(spark):
    """Rows, verdicts and calls of marked models equal those of models that are asked every time, with less asked."""
    from veriloom.operators.metrics import call_accounting
    from veriloom.operators.verifier import OfflineVerifier

    names = ("late", "steps", "draft", "swing", "change", "mute", "easy")
    rows = [(k, "A.lean", f"-- name {name}\ntheorem a : True := by\n  sorry\ntheorem b : True := by\n  sorry\n") for k, name in enumerate(names)]
    files = spark.createDataFrame(rows, "project int, path string, content string")
    seen = lambda df: sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)

    def run(mark):
        plan, propose = Counted(plan_more), Counted(propose_some)
        done, verdicts, trace = pipelines.repair(files, mark(plan), mark(propose), OfflineVerifier(), pipelines.Budget(4, 2))
        return [seen(x) for x in (done, verdicts, trace, call_accounting(trace))], plan.rows, propose.rows

    every, plans, proposals = run(lambda ask: ask)
    once, fewer_plans, fewer_proposals = run(pipelines.fixed)
    assert once == every
    calls = {project: (planner, executor) for executor, planner, project, *_ in once[3]}
    assert calls == {0: (2, 3), **{k: (4, 8) for k in range(1, 6)}, 6: (1, 1)}
    assert (plans, proposals) == (sum(p for p, _ in calls.values()), sum(e for _, e in calls.values()))
    assert fewer_plans < plans and fewer_proposals < proposals


def test_a_book_has_its_whole_budget(spark):
    """Before, book_pipeline's projects had 2 rounds of 2 attempts, not the 21 of 10 that a run has by default."""
    rows = spark.createDataFrame([(k, "e" * k, "s") for k in range(10, 24)], "id int, content string, name string")
    got = {r.id: r for r in pipelines.offline_book(rows).collect()}
    size = lambda k: len(f"/- {'e' * k} -/\ntheorem {'other' if k % 11 == 5 else 't'}{k} : True := by\n  sorry\n")
    bad = {k for k in got if size(k) % 7 == 3}
    assert 0 < len(bad) < len(got) and {k for k, r in got.items() if not r.success} == bad
    assert {(r.planner_calls, r.executor_calls, r.verifier_calls) for k, r in got.items() if k in bad} == {(21, 210, 23)}
    assert {(r.planner_calls, r.executor_calls, r.verifier_calls) for k, r in got.items() if k not in bad} == {(1, 1, 4)}
