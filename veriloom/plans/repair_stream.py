"""Proof repair as a stream: the state of each project (objective, draft frontier, budget, branch of files) lives in Spark's state store.

The stream reads events: one that starts a project, one for each judged attempt. transformWithState decides what an attempt is worth and
answers with the project's next action: plan, propose or done. Each micro-batch takes the actions of all open projects: it asks the
model, writes the files that the answers change as a version, verifies the candidates and appends their events, which are the
next batch's input. A project's files are a chain of versions, so accepting and reverting move a list of numbers, not files.

A batch is done once its events' folder is there, by one rename, and asks nothing again after a restart; state and offsets are in the
checkpoint. An event that comes twice is left out by its round and attempt.

The states of some PER_KEY projects are one value of the store: every value costs several calls between Python and the store, and every key
an Arrow batch of its own, so a key for each project takes most of the time of a large run. Of a project that ended no texts are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, StructType

from veriloom.functions import text as T
from veriloom.operators import projects, versions
from veriloom.operators.verifier import Verifier
from veriloom.plans import pipelines
from veriloom.plans.pipelines import Ask, Budget
from veriloom.sources import storage

EVENT = (
    "planning_round int, executor_attempt int, error string, exit_code int, global_errors int, holes int, output string, version long, goals int, plan string, retrieval string, "
    "planner_tokens int, executor_tokens int"
)
ACTION = (
    "planning_round int, executor_attempt int, accepted boolean, retained boolean, error string, planner_tokens int, executor_tokens int, next string, next_round int, next_attempt int, "
    "plan string, retrieval string, output string, feedback string, current array<long>, draft array<long>, verifier_calls int"
)
STATE = (
    "exit_code int, global_errors int, holes int, draft_errors int, draft_holes int, output string, feedback string, plan string, retrieval string, planning_round int, executor_attempt int, "
    "verifier_calls int, current array<long>, draft array<long>"
)


#: Projects of one key of the state store, about.
PER_KEY = 32


class Judge(StatefulProcessor):
    """The decisions on a key's projects, one by one. The draft's chain is that of the last retained candidate, none after an acceptance."""

    def __init__(self, budget: Budget, kind: str):
        one = StructType.fromDDL(f"project {kind}, {STATE}")
        self.budget, self.names, self.shape = budget, one.names[1:], StructType().add("states", ArrayType(one))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("repair", self.shape)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.state.get()[0] if self.state.exists() else []
        states = {project: dict(zip(self.names, s)) for project, *s in known}
        for e in sorted(rows, key=lambda e: (e.planning_round, e.executor_attempt)):
            s, accepted, retained = states.get(e.project), False, False
            if s is None:
                if e.planning_round:
                    continue
                s = states[e.project] = {"exit_code": e.exit_code, "global_errors": e.global_errors, "holes": e.holes, "draft_errors": e.global_errors, "draft_holes": e.holes, "output": e.output, "feedback": e.output,
                     "plan": "", "retrieval": None, "planning_round": 1, "executor_attempt": 0, "verifier_calls": 1, "current": [e.version], "draft": []}
            elif (e.planning_round, e.executor_attempt) != (s["planning_round"], s["executor_attempt"]):
                continue  # told before, or the project ended
            else:
                accepted, retained = self._judge(s, e)
            step = self._next(s)
            told = {c: e[c] for c in ("planning_round", "executor_attempt", "error", "planner_tokens", "executor_tokens")}
            kept = {c: s[c] for c in ("plan", "retrieval", "output", "feedback", "verifier_calls")}
            yield Row(project=e.project, **told, **kept, accepted=accepted, retained=retained, next=step, next_round=s["planning_round"], next_attempt=s["executor_attempt"], current=list(s["current"]), draft=list(s["draft"]))
            if step == "done":
                s |= {"plan": None, "retrieval": None, "output": None, "feedback": None, "executor_attempt": None}
        self.state.update(([(project, *(s[n] for n in self.names)) for project, s in states.items()],))

    @staticmethod
    def _judge(s: dict, e: Row) -> tuple[bool, bool]:
        ok = e.error is None and e.exit_code is not None
        accepted = ok and (e.global_errors, e.holes) < (s["global_errors"], s["holes"])
        retained = ok and not accepted and (e.holes, e.global_errors) < (s["draft_holes"], s["draft_errors"])
        chain = [*(s["draft"] or s["current"]), e.version]
        if accepted:
            s |= {"exit_code": e.exit_code, "global_errors": e.global_errors, "holes": e.holes, "output": e.output, "current": chain, "draft": []}
        if retained:
            s["draft"] = chain
        if accepted or retained:
            s |= {"draft_errors": e.global_errors, "draft_holes": e.holes}
        s["feedback"] = e.output if e.output is not None else s["output"]
        s["plan"], s["retrieval"] = e.plan, e.retrieval
        s["verifier_calls"] += e.goals + (e.error is None)
        return accepted, retained

    def _next(self, s: dict) -> str:
        """The next action; moves the round and the attempt on."""
        if s["holes"] == 0 and s["exit_code"] == 0 or self.budget.planning_rounds < 1 or self.budget.executor_attempts < 1:
            return "done"
        if s["executor_attempt"] == 0 or s["executor_attempt"] >= self.budget.executor_attempts:
            s["planning_round"] += s["executor_attempt"] > 0
            s["executor_attempt"] = 1
            return "plan" if s["planning_round"] <= self.budget.planning_rounds else "done"
        s["executor_attempt"] += 1
        return "propose"


@storage.spread
def repair_stream(
    files: DataFrame, plan: Ask, propose: Ask, verifier: Verifier, root: str, budget: Budget = Budget(), corpus: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(files, verdicts, trace) as repair gives them. root: the run's folder; a run that stopped goes on from there (files are read at its first start only)."""
    spark = files.sparkSession
    kind = files.schema["project"].dataType.simpleString()
    event, action = f"project {kind}, {EVENT}", f"project {kind}, {ACTION}"
    log = versions.VersionTable(spark, f"{root}/files", f"project {kind}, path string, content string, version long")
    folder = lambda what, batch: f"{root}/{what}/batch-{batch:012d}"
    first = folder("events", -1)
    if not storage.exists(spark, first):
        log.commit(projects.checked_paths(files), 0)
        said = pipelines._verdict(verifier, log.files(0))
        storage.replace_folder(_event(said, event, version=F.lit(0)), first)

    def act(batch: DataFrame, number: int) -> None:
        if storage.exists(spark, folder("events", number)):
            return
        storage.replace_folder(batch, folder("actions", number))
        actions = spark.read.schema(action).parquet(folder("actions", number))
        open_ = actions.where("next <> 'done'")
        if open_.isEmpty():
            return
        known = log.log()
        current = versions.along(known, open_.where("next = 'plan'").select("project", F.col("current").alias("chain")))
        focus = pipelines._focus(current, verifier, corpus)
        rows = open_.where("next = 'plan'").select("project", "output", F.col("plan").alias("prior_plan")).join(focus, "project", "left")
        asked = rows.withColumn("goal", F.coalesce("goal", "output")).drop("retrieval").join(focus.select("project", "retrieval"), "project", "left")
        planned = storage.cut(plan(asked)).select("project", F.col("text").alias("plan"), F.col("tokens").alias("planner_tokens"))
        planned = planned.join(focus.select("project", "retrieval", F.lit(1).alias("goals")), "project", "left")
        before = open_.where("next = 'propose'").select("project", "plan", "planner_tokens", "retrieval", F.lit(0).alias("goals"))
        plans = storage.cut(planned.select(before.columns).unionByName(before).withColumn("goals", F.coalesce("goals", F.lit(0))))
        chain = F.when(F.size("draft") > 0, F.col("draft")).otherwise(F.col("current"))
        shown = versions.along(known, open_.select("project", chain.alias("chain")))
        feedback = open_.select("project", T.tail(F.col("feedback"), 10_000).alias("feedback"))
        answers = storage.cut(propose(pipelines._shown(shown).join(plans.drop("goals", "retrieval"), "project").join(feedback, "project").join(plans.select("project", "retrieval"), "project")))
        patch, judged = pipelines.tried(open_, shown, answers, verifier)
        version = log.commit(patch, number + 1)
        told = judged.join(plans, "project", "left").join(answers.select("project", F.col("tokens").alias("executor_tokens")), "project", "left").join(open_.select("project", F.col("next_round").alias("planning_round"), F.col("next_attempt").alias("executor_attempt")), "project")
        told = told.withColumnsRenamed({"_exit": "exit_code", "_errors": "global_errors", "_holes": "holes", "_output": "output"})
        storage.replace_folder(_event(told, event, version=F.lit(version)), folder("events", number))

    events = spark.readStream.schema(event).option("recursiveFileLookup", "true").parquet(f"{root}/events")
    keys = max(1, spark.read.schema(event).parquet(first).count() // PER_KEY)  # the same after a restart
    judged = events.withColumn("key", F.pmod(F.xxhash64("project"), F.lit(keys))).groupBy("key").transformWithState(Judge(budget, kind), action, "append", "None")
    # A partition of the state costs a worker and a store in each batch, however few its keys; a store is on disk, so it may be large.
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    with storage.configured(spark, streaming_stateStore_providerClass="org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", shuffle_partitions=str(parts)):
        query = judged.writeStream.foreachBatch(act).outputMode("append").option("checkpointLocation", f"{root}/checkpoint").start()  # the stream keeps the session's settings of now
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    actions = spark.read.schema(action).option("recursiveFileLookup", "true").parquet(f"{root}/actions")
    ended = actions.where("next = 'done'")
    final_files = versions.along(log.log(), ended.select("project", F.col("current").alias("chain")))
    verdicts = pipelines._verdict(verifier, final_files).join(ended.select("project", (F.col("verifier_calls") + 1).alias("verifier_calls")), "project")
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in ("planner_tokens", "executor_tokens")]
    trace = actions.where("planning_round > 0").select("project", "planning_round", "executor_attempt", "accepted", "retained", "error", *numbers)
    return final_files, storage.cut(verdicts), trace


def _event(rows: DataFrame, schema: str, **more) -> DataFrame:
    """rows as events: missing numbers are 0, other missing columns null."""
    zero = ("planning_round", "executor_attempt", "goals")
    shape = StructType.fromDDL(schema)
    have = lambda f: more.get(f.name, F.col(f.name) if f.name in rows.columns else F.lit(0 if f.name in zero else None))
    return rows.select(*[have(f).cast(f.dataType).alias(f.name) for f in shape.fields])
