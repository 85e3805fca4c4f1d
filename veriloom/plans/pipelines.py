"""The graphs: statement compilation, splitting and proof repair as bulk-synchronous rounds over versioned file tables.

A round asks the model for all open projects at once, makes a candidate version, verifies it and keeps, project by project,
the candidate or the current files. Each round's tables are written (cut), so no call is ever repeated, and deleted (discard)
once the next round needs them no more: disk holds the files and one round's tables, however many rounds there are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.functions import text as T
from veriloom.operators import projects, providers, retrieval, signatures, versions
from veriloom.operators.verifier import OfflineVerifier, Verifier, goal_state
from veriloom.plans import stages
from veriloom.sources import keyed, storage
from veriloom.sources.storage import cut

FILES = "files array<struct<path:string,content:string>>, delete array<string>"


@dataclass(frozen=True)
class Budget:
    planning_rounds: int = 21
    executor_attempts: int = 10
    statement_repairs: int = 10


#: rows with project and what a model needs -> project, text (its JSON answer), tokens.
Ask = Callable[[DataFrame], DataFrame]


def _shown(files: DataFrame) -> DataFrame:
    return files.groupBy("project").agg(F.sort_array(F.collect_list(F.struct("path", "content"))).alias("files"))


def _patch(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(patch files, project and raised) from answers, which are read once, into a table; raised: no JSON object, or an unsafe path."""
    body = answers.withColumn("_b", F.from_json(T.json_object(F.col("text")), FILES))
    files = F.coalesce("_b.files", F.expr("cast(array() as array<struct<path:string,content:string>>)"))
    safe = F.forall(files, lambda f: F.coalesce(T.safe_path(f["path"]), F.lit(False)))
    read = cut(body.select("project", files.alias("f"), (F.col("_b").isNull() | ~safe).alias("raised")))
    patch = read.where(~F.col("raised")).select("project", F.explode("f").alias("x")).select("project", "x.path", T.normal_content(F.col("x.content")).alias("content"))
    return patch.dropDuplicates(["project", "path"]), read.select("project", "raised")


def _verdict(verifier: Verifier, files: DataFrame) -> DataFrame:
    return verifier.verify(files).select("project", "exit_code", "global_errors", "holes", "output")


def _none(rows: DataFrame) -> bool:
    return not rows.limit(1).count()


def generate_files(rows: DataFrame, ask: Ask, templates: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(files, provenance) of projects from rows (project, math_items, blueprints): the model's files over the templates (path to content).

    provenance: project, item, provenance of each item. An answer that can't be read or holds an unsafe path raises.
    """
    since = storage.mark()
    asked = rows.select("project", F.to_json(F.struct(F.col("math_items").alias("items"), F.col("blueprints"))).alias("payload"), "math_items", "blueprints")
    patch, raised = _patch(cut(ask(asked)))
    if not _none(raised.where("raised")):
        raise ValueError("a generated project can't be read or has an unsafe path")
    if templates:
        shared = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(c).alias("content")) for p, c in templates.items()])
        patch = projects.overlay(rows.select("project", F.explode(shared).alias("f")).select("project", "f.*"), patch)
    made = cut(patch)
    storage.discard(rows.sparkSession, since, but=made)
    return made, stages.provenance(rows, "project")


def compile_statements(files: DataFrame, ask: Ask, verifier: Verifier, budget: Budget = Budget()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(files, verdicts, trace): repair rounds for projects that don't build; a candidate stays if its errors strictly fall."""
    since = storage.mark()
    files = cut(projects.checked_paths(files))
    state = cut(_verdict(verifier, files))
    trace = cut(state.select("project", F.lit(0).alias("round"), F.lit("generate").alias("action"), F.lit(True).alias("accepted")))
    for k in range(1, budget.statement_repairs + 1):
        failing = state.where("exit_code <> 0")
        if _none(failing):
            break
        open_files = files.join(failing.select("project"), "project", "left_semi")
        answers = cut(ask(_shown(open_files).join(failing.select("project", T.tail(F.col("output"), 10_000).alias("feedback")), "project")))
        patch, raised = _patch(answers)
        candidate = cut(projects.overlay(open_files, patch))
        new = _verdict(verifier, candidate)
        judged = failing.select("project", F.col("global_errors").alias("old")).join(raised, "project", "left").join(new, "project")
        judged = cut(judged.withColumn("accepted", ~F.coalesce("raised", F.lit(True)) & (F.col("global_errors") < F.col("old"))))
        files = cut(projects.choose(files, candidate, judged))
        won = judged.where("accepted").select(state.columns)
        state = cut(won.unionByName(state.join(won, "project", "left_anti")))
        trace = cut(trace.unionByName(judged.select("project", F.lit(k).alias("round"), F.lit("repair").alias("action"), "accepted")))
        storage.discard(files.sparkSession, since, but=[files, state, trace])
    return files, state, trace


def split_large(files: DataFrame, ask: Ask, verifier: Verifier, max_lines: int = 2_000) -> tuple[DataFrame, DataFrame]:
    """(files, project with needed and accepted): projects with large files ask for a split; it stays if it builds and freezes all statements."""
    since = storage.mark()
    large = cut(projects.large_files(files, max_lines).select("project").distinct())
    everyone = files.select("project").distinct().join(large.withColumn("needed", F.lit(True)), "project", "left").select("project", F.coalesce("needed", F.lit(False)).alias("needed"))
    if _none(large):
        return files, everyone.withColumn("accepted", F.lit(False))
    before = files.join(large, "project", "left_semi")
    answers = cut(ask(_shown(before)))
    patch, raised = _patch(answers)
    gone = answers.select("project", F.explode(F.from_json(T.json_object(F.col("text")), FILES)["delete"]).alias("path"))
    gone = gone.withColumn("path", F.when(T.safe_path(F.col("path")), F.col("path")).otherwise(F.raise_error(F.lit("unsafe delete path"))))
    candidate = cut(projects.overlay(projects.delete(before, gone), patch))
    same = signatures.frozen(signatures.inventory(before), signatures.inventory(candidate))
    judged = large.join(raised, "project", "left").join(_verdict(verifier, candidate), "project", "left").join(same, "project", "left")
    judged = cut(judged.select("project", F.coalesce(~F.col("raised") & (F.col("exit_code") == 0) & F.coalesce("signatures_frozen", F.lit(True)), F.lit(False)).alias("accepted")))
    out = everyone.join(judged, "project", "left").select("project", "needed", F.coalesce("accepted", F.lit(False)).alias("accepted"))
    chosen, out = cut(projects.choose(files, candidate, judged)), cut(out)
    storage.discard(files.sparkSession, since, but=[chosen, out])
    return chosen, out


class Appended:
    """Rows that only grow, a table for each piece. FOLD tables of a level become one of the next, so a row is rewritten a logarithmic number of times and plans stay short."""

    FOLD = 8

    def __init__(self, first: DataFrame):
        self.none, self.levels = first.limit(0), [[first]]

    def add(self, rows: DataFrame) -> None:
        table, level = cut(rows.select(self.none.columns)), 1
        while True:
            if len(self.levels) <= level:
                self.levels.append([])
            self.levels[level].append(table)
            if len(self.levels[level]) < self.FOLD:
                return
            table = cut(reduce(DataFrame.unionByName, self.levels[level]))
            self.levels[level], level = [], level + 1

    def all(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [t for level in self.levels for t in level], self.none)


def tried(open_: DataFrame, shown: DataFrame, answers: DataFrame, verifier: Verifier) -> tuple[DataFrame, DataFrame]:
    """(patch, judged): the files that the answers write, and project, error, _exit, _errors, _holes, _output of each open project's candidate.

    The shown files hold the frozen statements, so a candidate does if its patch states what the files that it replaces state; only these are
    read for that. What can't be read, has an unsafe path or changes a statement isn't verified.
    """
    patch, raised = _patch(answers)
    patch = cut(patch)
    old = shown.join(patch.select("project", "path"), ["project", "path"], "left_semi")
    same = signatures.frozen(signatures.inventory(old), signatures.inventory(patch))
    unread, changed = F.coalesce("raised", F.lit(True)), ~F.coalesce("signatures_frozen", F.lit(True))
    error = F.when(unread, "unreadable or unsafe answer").when(changed, "changed a frozen statement").alias("error")
    sound = cut(open_.select("project").join(raised, "project", "left").join(same, "project", "left").select("project", error))
    candidate = projects.overlay(shown, patch).join(sound.where("error IS NULL"), "project", "left_semi")
    return patch, sound.join(_verdict(verifier, candidate).toDF("project", "_exit", "_errors", "_holes", "_output"), "project", "left")


def fixed(part):
    """Marks an Ask, or a verifier's class, whose answer is a function of its question: asked the same again, it says the same, tokens included."""
    part.fixed = True
    return part


@storage.spread
def repair(files: DataFrame, plan: Ask, propose: Ask, verifier: Verifier, budget: Budget = Budget(), corpus: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(files, verdicts, trace): plan and patch until a project builds without holes; then one last build of all.

    A candidate stays if (errors, holes) strictly falls and no statement changed; else, if its (holes, errors) is below the
    draft's, it is the next attempt's base, but not the project's files. Answers that can't be read, unsafe paths and changed
    statements count as raising attempts; they are not verified. A plan is asked with the focus, its goal, the lines that
    the text around it finds in the corpus (path, line, text) and the plan before. verdicts: project, exit_code,
    global_errors, holes, output, verifier_calls, of the last build. An attempt writes the files that it changes and the states
    of open projects, nothing else; repair_stream runs the same as a stream that can be restarted.

    Where plan, propose and verifier are all marked fixed, an equal question isn't asked again: an attempt that leaves files,
    draft and feedback as they were (still) is the round's others, too, and a still project whose new plan is the plan before is
    so in all later rounds. Every attempt has its row and its calls, as if it were made; other models are asked every time.
    """
    since = storage.mark()
    repeats = all(getattr(x, "fixed", False) for x in (plan, propose, verifier))
    base = cut(projects.checked_paths(files).select("project", "path", "content"))
    log = Appended(base.withColumn("version", F.lit(0).cast("long")))
    state = _verdict(verifier, base).withColumn("draft_holes", F.col("holes")).withColumn("draft_errors", F.col("global_errors"))
    state = state.withColumn("feedback", F.col("output")).withColumn("verifier_calls", F.lit(1)).withColumn("plan", F.lit(""))
    # still: the last attempt (its error and tokens) would come out the same again; moved: the files changed in this round; goals: asked in a round.
    state = cut(state.withColumns({"still": F.lit(False), "moved": F.lit(False), "goals": F.lit(0), "error": F.lit(None).cast("string"), "planner_tokens": F.lit(0), "executor_tokens": F.lit(0)}))
    solved: Column = (F.col("holes") == 0) & (F.col("exit_code") == 0)
    done = Appended(cut(state.where(solved)))
    state = cut(state.where(~solved))
    drafts, trace, focus, n = base.limit(0), None, None, 0
    for r in range(1, budget.planning_rounds + 1):
        if _none(state):
            break
        same = state.where("still AND NOT moved").select("project")  # their focus is that of the round before
        fresh = state.join(same, "project", "left_anti") if repeats else state
        current = cut(versions.latest(log.all().join(fresh.select("project"), "project", "left_semi")))
        found = _focus(current, verifier, corpus)
        focus = cut(found.unionByName(focus.join(same, "project", "left_semi"))) if repeats and r > 1 else found
        rows = state.select("project", "output", F.col("plan").alias("prior_plan")).join(focus, "project", "left")
        plans = cut(plan(rows.withColumn("goal", F.coalesce("goal", "output")).drop("retrieval").join(focus.select("project", "retrieval"), "project", "left")))
        plans = plans.select("project", F.col("text").alias("plan"), F.coalesce("tokens", F.lit(0)).alias("planner_tokens"))
        told = state.drop("goals").withColumnsRenamed({"plan": "prior_plan", "planner_tokens": "prior_tokens"}).join(plans, "project", "left").join(focus.select("project", F.lit(1).alias("goals")), "project", "left")
        told = told.withColumn("goals", F.coalesce("goals", F.lit(0))).withColumn("planner_tokens", F.coalesce("planner_tokens", F.lit(0)))
        settled = F.col("still") & ~F.col("moved") & F.col("prior_plan").eqNullSafe(F.col("plan")) & (F.col("prior_tokens") == F.col("planner_tokens"))
        rounds, attempts = budget.planning_rounds - r + 1, budget.executor_attempts
        calls = F.col("goals") + F.when(settled, (rounds - 1) * F.col("goals") + rounds * attempts * F.col("error").isNull().cast("int")).otherwise(0)
        told = told.withColumn("verifier_calls", F.col("verifier_calls") + calls).withColumn("settled", settled).withColumn("moved", F.lit(False)).withColumn("still", F.lit(False))
        told = cut(told.select(*done.none.columns, "settled"))
        resting: list[DataFrame] = []
        state = told.where("NOT settled").drop("settled")
        if repeats and trace is not None:
            ended = told.where("settled")
            trace.add(_again(ended, F.sequence(F.lit(r), F.lit(budget.planning_rounds)), F.sequence(F.lit(1), F.lit(attempts))))
            done.add(ended)
        for a in range(1, budget.executor_attempts + 1):
            if _none(state):
                break
            n += 1
            if (r, a) != (1, 1):
                current = versions.latest(log.all().join(state.select("project"), "project", "left_semi"))
            shown = cut(projects.overlay(current, drafts.join(state.select("project"), "project", "left_semi")))
            feedback = state.select("project", T.tail(F.col("feedback"), 10_000).alias("feedback"))
            answers = cut(propose(_shown(shown).join(plans, "project").join(feedback, "project").join(focus.select("project", "retrieval"), "project", "left")))
            patch, judged = tried(state, shown, answers, verifier)
            judged = judged.join(state.drop("error", "executor_tokens"), "project").join(answers.select("project", F.coalesce("tokens", F.lit(0)).alias("executor_tokens")), "project", "left").withColumn("executor_tokens", F.coalesce("executor_tokens", F.lit(0)))
            ok = F.col("error").isNull() & F.col("_exit").isNotNull()
            judged = judged.withColumn("accepted", F.coalesce(ok & (F.struct("_errors", "_holes") < F.struct("global_errors", "holes")), F.lit(False)))
            judged = cut(judged.withColumn("retained", F.coalesce(ok & ~F.col("accepted") & (F.struct("_holes", "_errors") < F.struct("draft_holes", "draft_errors")), F.lit(False))))
            moved_files = projects.overlay(drafts, patch)  # what a candidate changes of its project's files
            log.add(moved_files.join(judged.where("accepted").select("project"), "project", "left_semi").withColumn("version", F.lit(n).cast("long")))
            pick = lambda new, old: F.when(F.col("accepted"), F.col(new)).otherwise(F.col(old)).alias(old)
            rank = lambda new, old: F.when(F.col("accepted") | F.col("retained"), F.col(new)).otherwise(F.col(old)).alias(old)
            said = F.coalesce("_output", "output")
            still = ~F.col("accepted") & ~F.col("retained") & said.eqNullSafe(F.col("feedback")) if repeats else F.lit(False)
            moved = judged.select(
                "project", pick("_exit", "exit_code"), pick("_errors", "global_errors"), pick("_holes", "holes"), pick("_output", "output"), rank("_holes", "draft_holes"), rank("_errors", "draft_errors"),
                said.alias("feedback"), (F.col("verifier_calls") + F.col("error").isNull().cast("int")).alias("verifier_calls"), "plan",
                still.alias("still"), (F.col("moved") | F.col("accepted")).alias("moved"), "goals", "error", "planner_tokens", "executor_tokens",
            )
            step = judged.select("project", F.lit(r).alias("planning_round"), F.lit(a).alias("executor_attempt"), "accepted", "retained", "error", "planner_tokens", "executor_tokens")
            if trace is None:
                trace = Appended(cut(step.limit(0)))
            done.add(moved.where(solved))
            left = attempts - a
            rested = F.col("still") & F.lit(left > 0)
            open_ = cut(moved.where(~solved).withColumn("verifier_calls", F.col("verifier_calls") + F.when(rested & F.col("error").isNull(), left).otherwise(0)))
            if repeats and left:
                step = step.unionByName(_again(open_.where("still"), F.array(F.lit(r)), F.sequence(F.lit(a + 1), F.lit(attempts))))
                resting.append(open_.where("still"))
            trace.add(step)
            state = open_.where(~rested)
            kept = moved_files.join(judged.where("retained").select("project"), "project", "left_semi")
            old = drafts.join(judged.where("accepted OR retained").select("project"), "project", "left_anti")
            unsolved = reduce(DataFrame.unionByName, resting, state).select("project")
            drafts = cut(old.unionByName(kept).join(unsolved, "project", "left_semi"))
            storage.discard(base.sparkSession, since, but=[log.all(), done.all(), trace.all(), state, *resting, drafts, plans, focus])
        state = reduce(DataFrame.unionByName, resting, state)
    files = cut(versions.latest(log.all()))
    final = cut(_verdict(verifier, files).join(done.all().unionByName(state.select(done.none.columns)).select("project", (F.col("verifier_calls") + 1).alias("verifier_calls")), "project"))
    steps = trace.all() if trace is not None else state.limit(0).selectExpr("project", "0 planning_round", "0 executor_attempt", "false accepted", "false retained", "cast(null as string) error", "0 planner_tokens", "0 executor_tokens")
    steps = cut(steps)
    storage.discard(base.sparkSession, since, but=[files, final, steps])
    return files, final, steps


def _again(still: DataFrame, rounds: Column, attempts: Column) -> DataFrame:
    """The steps of projects whose last attempt comes out the same in all these rounds and attempts."""
    each = still.withColumn("planning_round", F.explode(rounds)).withColumn("executor_attempt", F.explode(attempts))
    no = F.lit(False)
    return each.select("project", "planning_round", "executor_attempt", no.alias("accepted"), no.alias("retained"), "error", "planner_tokens", "executor_tokens")


def _focus(files: DataFrame, verifier: Verifier, corpus: DataFrame | None) -> DataFrame:
    """project, focus (its first hole), context, source (its file), goal, retrieval of the projects with a hole."""
    first = cut(projects.holes(files).groupBy("project").agg(F.min(F.struct("path", "offset", "line")).alias("focus")).select("project", "focus.*"))
    around = first.join(files, ["project", "path"]).select("project", F.struct("path", "offset", "line").alias("focus"), T.around(F.col("content"), F.col("offset")).alias("context"), F.col("content").alias("source"))
    around = cut(around.join(goal_state(verifier, files, first), "project", "left"))
    if corpus is None:
        return around.withColumn("retrieval", F.lit(retrieval.NO_CORPUS))
    asked = around.select(F.col("project").alias("query_id"), F.col("context").alias("query"))
    found = retrieval.shown(asked, corpus, retrieval.search(asked, corpus)).withColumnRenamed("query_id", "project")
    return cut(around.join(found, "project", "left"))


def audit(files: DataFrame, frozen: DataFrame, verifier: Verifier, provenance: DataFrame | None = None) -> DataFrame:
    """project, passed and its evidence: exit_code, holes, findings (kind, path, line), n_findings, signatures_frozen, source_coverage, axiom_exit, axiom_output.

    The axiom question is checked as one more file of the project it asks about. provenance: project, item.
    """
    found = projects.escape_hatches(files.select("project", "path", "content")).groupBy("project").agg(F.sort_array(F.collect_list(F.struct("path", "line", "kind"))).alias("findings"))
    now = cut(signatures.inventory(files))
    question = stages.axiom_query(files, now).select("project", F.lit(AXIOMS).alias("path"), F.col("source").alias("content"))
    axioms = verifier.check(files.select("project", "path", "content").unionByName(question), AXIOMS).select("project", F.col("exit_code").alias("axiom_exit"), F.col("output").alias("axiom_output"))
    rows = _verdict(verifier, files).join(found, "project", "left").join(signatures.frozen(frozen, now), "project", "left").join(axioms, "project", "left")
    covered = provenance.groupBy("project").agg(F.count_distinct("item").alias("source_coverage")) if provenance is not None else rows.select("project", F.lit(0).cast("long").alias("source_coverage"))
    rows = rows.join(covered, "project", "left").withColumn("findings", F.coalesce("findings", F.expr("cast(array() as array<struct<path:string,line:int,kind:string>>)")))
    rows = rows.withColumn("n_findings", F.size("findings")).withColumn("signatures_frozen", F.coalesce("signatures_frozen", F.lit(True))).withColumn("source_coverage", F.coalesce("source_coverage", F.lit(0)))
    gate = stages.audit_gate(F.col("exit_code"), F.col("holes"), F.col("n_findings"), F.col("signatures_frozen"), F.col("axiom_exit"), F.coalesce("axiom_output", F.lit("")))
    return rows.select("project", gate.alias("passed"), "signatures_frozen", "n_findings", "findings", "source_coverage", "exit_code", "holes", "axiom_exit", "axiom_output")


#: The file that asks for the axioms behind a project's declarations.
AXIOMS = "AxiomAudit.lean"


def baseline(tasks: DataFrame, ask: Ask, verifier: Verifier, attempts: int = 3, traces: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(results, attempts) of whole-proof attempts on tasks (project, path, content): each starts from the certified statement, with the last output as feedback.

    ask answers with JSON {"proof": ...}. An attempt succeeds by exit 0, an unchanged statement and no escape hatch in the raw
    text; a task stops at its first success. An answer without a proof is a failed attempt that isn't verified. traces: a folder that keeps
    what the model said at each attempt, by `project/attempt` (the answers' column trace, else their text); see keyed.KeyedResults.
    """
    since = storage.mark()
    rows = cut(tasks.select("project", "path", "content").withColumn("feedback", F.lit("")).withColumn("previous", F.lit("")))
    done, log = None, None
    for k in range(1, attempts + 1):
        if _none(rows):
            break
        answers = cut(ask(rows.withColumn("attempt", F.lit(k))))
        if traces is not None:
            keyed.write_traces(answers.select("project", F.lit(k).alias("attempt"), F.col("trace" if "trace" in answers.columns else "text").alias("trace")), traces)
        proof = F.get_json_object(T.json_object(F.col("text")), "$.proof")
        made = rows.join(answers.select("project", proof.alias("proof")), "project", "left")
        made = cut(made.withColumn("candidate", F.when(F.col("proof").isNotNull() & F.contains("content", F.lit(T.PROOF_MARK)), T.install_proof(F.col("content"), F.col("proof")))))
        said = _verdict(verifier, made.where("candidate IS NOT NULL").select("project", "path", F.col("candidate").alias("content")))
        judged = made.join(said, "project", "left")
        ok = F.col("candidate").isNotNull() & T.baseline_success(F.col("exit_code"), F.col("content"), F.coalesce("candidate", "content"))
        error = F.when(F.col("candidate").isNull(), "no proof in the answer")
        judged = cut(judged.withColumn("success", F.coalesce(ok, F.lit(False))).withColumn("error", error).withColumn("attempt", F.lit(k)))
        step = judged.select("project", "attempt", "success", "error", F.col("candidate").isNotNull().cast("int").alias("verifier_calls"), F.coalesce("output", "error").alias("output"))
        step, won = cut(step), cut(judged.where("success").select("project", "attempt", F.col("candidate").alias("content")))
        log = step if log is None else log.unionByName(step)
        done = won if done is None else done.unionByName(won)
        rows = cut(judged.where("NOT success").select("project", "path", "content", F.coalesce("output", "error", F.lit("")).alias("feedback"), F.coalesce("proof", "previous").alias("previous")))
        storage.discard(tasks.sparkSession, since, but=[rows, log, done])
    if log is None:
        log = tasks.select("project").limit(0).selectExpr("project", "0 attempt", "false success", "cast(null as string) error", "0 verifier_calls", "'' output")
        done = tasks.select("project").limit(0).selectExpr("project", "0 attempt", "'' content")
    log = cut(log)
    per = log.groupBy("project").agg(F.count("*").alias("attempt_count"), F.sum("verifier_calls").alias("verifier_calls"), F.bool_or("success").alias("success"))
    out = tasks.select("project", "path", F.col("content").alias("_before")).join(per, "project", "left").join(done.select("project", "content"), "project", "left")
    return out.select("project", "path", F.coalesce("content", "_before").alias("content"), F.coalesce("success", F.lit(False)).alias("success"), F.coalesce("attempt_count", F.lit(0)).alias("attempt_count"), F.coalesce("verifier_calls", F.lit(0)).alias("verifier_calls")), log


# --- offline runs: answers are functions of what is shown -------------------------------------------------------------
def _answer(files: Column) -> Column:
    return F.to_json(F.struct(files.alias("files")))


@fixed
def offline_plan(rows: DataFrame) -> DataFrame:
    return rows.select("project", F.lit("Use the trivial proof.").alias("text"), F.lit(4).alias("tokens"))


@fixed
def offline_patch(rows: DataFrame) -> DataFrame:
    """Every `sorry` becomes `trivial`; where a file with a theorem has a length that leaves 3 by 7, the project's statements are changed instead."""
    bad = F.exists("files", lambda f: F.contains(f["content"], F.lit("theorem")) & (F.length(f["content"]) % 7 == 3))
    fixed = F.transform("files", lambda f: F.struct(f["path"].alias("path"), F.when(bad, F.replace(f["content"], F.lit(": True"), F.lit(": False"))).otherwise(F.replace(f["content"], F.lit("sorry"), F.lit("trivial"))).alias("content")))
    return rows.select("project", _answer(fixed).alias("text"), F.size("files").alias("tokens"))


def offline_split(rows: DataFrame) -> DataFrame:
    """All files move to a folder of their own; a project whose first file has an even length answers without JSON."""
    moved = F.transform("files", lambda f: F.struct(F.concat(F.lit("Part/"), f["path"]).alias("path"), f["content"].alias("content")))
    whole = F.to_json(F.struct(moved.alias("files"), F.col("files.path").alias("delete")))
    return rows.select("project", F.when(F.length(F.col("files")[0]["content"]) % 2 == 1, whole).otherwise("no JSON").alias("text"), F.size("files").alias("tokens"))


def offline_fix(rows: DataFrame) -> DataFrame:
    fixed = F.transform("files", lambda f: F.struct(f["path"].alias("path"), F.replace(f["content"], F.lit("broken\n"), F.lit("")).alias("content")))
    return rows.select("project", _answer(fixed).alias("text"), F.size("files").alias("tokens"))


def offline_files(rows: DataFrame) -> DataFrame:
    """A file for each item: its statement in a comment, then a theorem of its id; where the statement's length leaves 0 by 10 it doesn't build, 5 by 11 it has another name."""
    note = lambda x: F.replace(F.replace(F.coalesce(x["statement"], F.lit("")), F.lit("-/"), F.lit("- /")), F.lit("/-"), F.lit("/ -"))
    size = lambda x: F.length(F.coalesce(x["statement"], F.lit("")))
    name = lambda x: F.concat(F.when(size(x) % 11 == 5, "other").otherwise("t"), x["id"])
    content = lambda x: F.concat(F.when(size(x) % 10 == 0, "broken\n").otherwise(""), F.lit("/- "), note(x), F.lit(" -/\ntheorem "), name(x), F.lit(" : True := by\n  sorry\n"))
    made = F.transform("math_items", lambda x: F.struct(F.concat(F.lit("Book/T"), x["id"], F.lit(".lean")).alias("path"), content(x).alias("content")))
    return rows.select("project", _answer(made).alias("text"), F.size("math_items").alias("tokens"))


def _named(prompt: str) -> str:
    """A reviewer that matches an item where a file states a theorem of its id."""
    import json

    items, _, files = prompt.rpartition("\n")
    stated = [f["content"] for f in json.loads(files)]
    return json.dumps({"alignments": [{"id": x["id"], "matched": any(f"theorem t{x['id']} " in c for c in stated), "reason": ""} for x in json.loads(items)]})


def _run(files: DataFrame, budget: Budget, provenance: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(after repair: project, success, ...), (audit), (calls)."""
    from veriloom.operators import metrics

    frozen = cut(signatures.inventory(files).select("project", "signature"))
    files, state, trace = repair(files, offline_plan, offline_patch, OfflineVerifier(), budget)
    return state, audit(files, frozen, OfflineVerifier(), provenance), metrics.call_accounting(trace)


def offline_book(rows: DataFrame, budget: Budget = Budget(), max_lines: int = 2_000) -> DataFrame:
    """documents to audited projects, one project for each row (id): items, blueprints, files, repair rounds, alignment, split, proofs, audit."""
    since, spark, small = storage.mark(), rows.sparkSession, []

    def end_step(*needed: DataFrame) -> None:
        storage.discard(spark, since, but=[*needed, *small])

    items = stages.atomic_items(stages.normalize_document(rows, "vqa_pair"))
    items = stages.blueprints(items, providers.Rule(lambda p: "Unfold and simplify."), providers.Rule(lambda p: '{"verdict": "correct", "feedback": ""}' if p.count("e") % 3 else '{"verdict": "incorrect", "feedback": "gap"}'))
    items = cut(items.withColumn("project", F.col("id")).select("id", "project", "math_items", "blueprints"))
    small.append(outlined := cut(items.select("id", F.size(F.filter("blueprints", lambda b: b["accepted"])).alias("accepted_blueprints"))))
    end_step(items)
    files, provenance = generate_files(items, offline_files)
    small.append(provenance := cut(provenance.select("project", "item")))
    small.append(built_at_once := cut(_verdict(OfflineVerifier(), files).select("project", (F.col("exit_code") == 0).alias("built_at_once"))))
    end_step(items, files)
    files, compiled, _ = compile_statements(files, offline_fix, OfflineVerifier(), budget)
    small.append(compiled)
    end_step(items, files)
    small.append(aligned := cut(stages.align(items, files, providers.Rule(_named)).select("id", F.col("statement_alignment.scc").alias("scc"))))
    end_step(files)
    files, split = split_large(files, offline_split, OfflineVerifier(), max_lines)
    small.append(split)
    end_step(files)
    state, audited, calls = _run(files, budget, provenance)
    out = outlined.join(aligned, "id", "left")
    for more in (
        built_at_once, compiled.select("project", (F.col("exit_code") == 0).alias("compiled")), split.select("project", F.col("needed").alias("split_needed"), F.col("accepted").alias("split_accepted")),
        state.select("project", ((F.col("holes") == 0) & (F.col("exit_code") == 0)).alias("success"), "verifier_calls"), audited.select("project", "signatures_frozen", "passed", "source_coverage"), calls,
    ):
        out = out.join(more, F.col("id") == more["project"], "left").drop("project")
    return out.fillna(0, ["planner_calls", "executor_calls", "tokens"])


def offline_benchmark(rows: DataFrame, budget: Budget = Budget(2, 2), task_files: DataFrame | None = None) -> DataFrame:
    """The audited metrics of a task list (id, formal_statement), or of tasks whose files are given (id, content)."""
    from veriloom.operators import metrics

    templates = {"lakefile.lean": "-- build\n", "lean-toolchain.lean": "-- toolchain\n"}
    state, audited, calls = _run(cut(stages.workspaces(rows, templates, task_files=task_files)), budget)
    per = state.select("project", "verifier_calls").join(audited, "project", "left").join(calls, "project", "left")
    per = per.select(F.col("project").alias("id"), "passed", "verifier_calls", F.coalesce("planner_calls", F.lit(0)).alias("planner_calls"), F.coalesce("executor_calls", F.lit(0)).alias("executor_calls"), F.coalesce("tokens", F.lit(0)).alias("tokens"))
    return metrics.audited_metrics(per)


def offline_baseline(rows: DataFrame, attempts: int = 3, traces: str | None = None) -> DataFrame:
    """Results of whole-proof attempts on a task list (id, formal_statement): with n the statement's length, a task is solved at attempt n mod 5, never for 0 or 4; where n mod 3 is 0, the first answer is no JSON."""

    def ask(open_: DataFrame) -> DataFrame:
        n = F.length("content")
        proof = F.when((n % 5 == F.col("attempt")) & (n % 5 < 4), "by\n    trivial").otherwise("sorry")
        return open_.select("project", F.when((n % 3 == 0) & (F.col("attempt") == 1), "no answer").otherwise(F.to_json(F.struct(proof.alias("proof"), F.lit("").alias("notes")))).alias("text"), F.lit(1).alias("tokens"))

    tasks = rows.select(F.col("id").alias("project"), F.concat(F.lit("T"), F.col("id").cast("string"), F.lit(".lean")).alias("path"), F.col("formal_statement").alias("content"))
    return baseline(tasks, ask, OfflineVerifier(), attempts, traces)[0]
