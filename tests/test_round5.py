"""Repair as a stream over many small projects: its texts and states are shared out."""

from __future__ import annotations

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from veriloom.operators import verifier
from veriloom.plans import pipelines, repair_stream
from veriloom.sources import storage


def test_repair_stream_shares_out_its_work(spark, tmp_path):
    """Before, a batch's texts went through one task, as they are small, and the store had a key for each project."""
    names = ("adaptive.coalescePartitions.minPartitionSize", "adaptive.coalescePartitions.parallelismFirst", "shuffle.partitions", "streaming.stateStore.providerClass")
    settings = lambda: [spark.conf.get(f"spark.sql.{n}") for n in names]
    was, n = settings(), 640
    noise = F.concat_ws("", *[F.sha2(F.concat("id", F.lit(f"-{k}")), 512) for k in range(4)])
    files = spark.range(n).select(F.col("id").alias("project"), F.lit("A.lean").alias("path"), F.concat(F.lit("-- "), noise, F.lit("\ntheorem t : True := by sorry\n")).alias("content"))
    done, verdicts, trace = repair_stream.repair_stream(files, pipelines.offline_plan, pipelines.offline_patch, verifier.OfflineVerifier(), f"file://{tmp_path}/run", pipelines.Budget(1, 1))
    solved = {r.project for r in files.where(F.length("content") % 7 != 3).collect()}
    assert solved == {r.project for r in verdicts.collect() if r.holes == 0} == {r.project for r in trace.collect() if r.accepted} and trace.count() == done.count() == verdicts.count() == n
    assert len(list((tmp_path / "run/files/v-000000000001").glob("part-*"))) > 1
    states = [len(r.states) for r in spark.read.format("statestore").option("stateVarName", "repair").load(f"file://{tmp_path}/run/checkpoint").select("value.states").collect()]
    assert sum(states) == n and len(states) <= n / repair_stream.PER_KEY and settings() == was


def test_judge_keeps_the_projects_of_a_key_apart(spark):
    """An event that comes twice is left out, also for a project that ended: before, such a project ended twice."""

    class Value:
        value = None
        exists = lambda self: self.value is not None
        get = lambda self: self.value

        def update(self, value):
            self.value = value

    state = Value()
    judge = repair_stream.Judge(pipelines.Budget(2, 2), "int")
    judge.init(Row(getValueState=lambda name, shape: state))
    told = lambda p, r, a, holes, version: Row(project=p, planning_round=r, executor_attempt=a, error=None, exit_code=0, global_errors=0, holes=holes, output=f"{p}-{r}-{a}", version=version, goals=0, plan="p", retrieval=None, planner_tokens=1, executor_tokens=1)
    heard = lambda *events: {(a.project, a.next, a.accepted, tuple(a.current), a.feedback) for a in judge.handleInputRows((0,), iter(events), None)}
    first = [told(1, 0, 0, 2, 0), told(2, 0, 0, 0, 0), told(3, 0, 0, 1, 0)]
    assert heard(*first) == {(1, "plan", False, (0,), "1-0-0"), (2, "done", False, (0,), "2-0-0"), (3, "plan", False, (0,), "3-0-0")}
    second = [told(3, 1, 1, 0, 1), told(1, 1, 1, 1, 1), told(4, 1, 1, 0, 1)]
    assert heard(*second) == {(1, "propose", True, (0, 1), "1-1-1"), (3, "done", True, (0, 1), "3-1-1")}
    assert heard(*first, *second) == set()
    assert heard(told(1, 1, 2, 1, 2)) == {(1, "plan", False, (0, 1), "1-1-2")}


def test_small_texts_stay_in_many_tasks(spark):
    texts = spark.range(1500).select("id", F.concat_ws("", *[F.sha2(F.concat("id", F.lit(f"-{k}")), 512) for k in range(4)]).alias("t")).repartition(2)
    tasks = lambda rows: rows.groupBy("id").agg(F.max("t").alias("t")).where("t > ''").select(F.spark_partition_id().alias("k")).distinct().count()
    assert tasks(texts) == 1 and storage.spread(tasks)(texts) >= spark.sparkContext.defaultParallelism


def test_projects_of_suppliers_are_made_by_all_cores(spark, sf_dir, monkeypatch):
    from veriloom import registry_stores

    class Seen(Exception):
        pass

    def seen(files, *rest):
        raise Seen(files.rdd.getNumPartitions())

    monkeypatch.setattr(repair_stream, "repair_stream", seen)
    with pytest.raises(Seen) as parts:
        registry_stores.repair_stream(spark, sf_dir)
    assert parts.value.args[0] >= spark.sparkContext.defaultParallelism
