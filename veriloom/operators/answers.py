"""A log of model answers: a question that was answered once is never asked again, by no run and by no repeated task.

The key of a question is a digest of everything that the answer depends on (model, system text, prompt, schema). Distinct questions
without an answer are dealt to tasks; a task appends each answer to a file of the shared folder before it asks for the next, and one
that is repeated finds what its earlier attempts wrote. A file is closed after SECONDS, so where a store shows files only once they are
closed, a lost executor costs the calls of the last SECONDS, elsewhere those that were on their way. Files are as many as the seconds
that calls take, not as the answers.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriloom.operators.providers import RESPONSE, Provider
from veriloom.sources import storage

ANSWER = "key string, text string, model string, prompt_tokens int, completion_tokens int"
#: A file of answers is closed, and the next one begun, after so long.
SECONDS = 2.0


class AnswerLog:
    """The log in a folder that all tasks reach: tables of answers, and pieces of runs that haven't ended."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def answers(self) -> DataFrame:
        """key, text, model, prompt_tokens, completion_tokens of all answers, those of runs that broke off too; a torn last line is left out."""
        tables = [f"{self.root}/{n}" for n in storage.children(self.spark, self.root) if n.startswith("table-")]
        found = self.spark.read.schema(ANSWER).parquet(*tables) if tables else self.spark.createDataFrame([], ANSWER)
        if storage.children(self.spark, f"{self.root}/pieces"):
            lines = self.spark.read.option("recursiveFileLookup", "true").text(f"{self.root}/pieces")
            read = lines.select(F.from_json("value", f"{ANSWER}, torn string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "torn"}).alias("a")).select("a.*")
            found = found.unionByName(read.where("torn IS NULL AND key IS NOT NULL AND text IS NOT NULL").drop("torn"))
        return found.dropDuplicates(["key"])

    def merge(self) -> None:
        """Makes the pieces a table. Only between runs: pieces of a run that goes on would be lost to its repeated tasks."""
        if storage.children(self.spark, f"{self.root}/pieces"):
            known = {n for n in storage.children(self.spark, self.root) if n.startswith("table-")}
            storage.replace_folder(self.answers(), f"{self.root}/table-{uuid.uuid4().hex}")  # whole, before anything goes
            for name in known | {"pieces"}:
                storage.delete(self.spark, f"{self.root}/{name}")

    def generate(self, rows: DataFrame, provider: Provider, system: str, prompt: str, out: str = "response", schema: dict | None = None, tasks: int | None = None) -> DataFrame:
        """rows with the provider's answers, as providers.generate; equal questions of several rows are one call. Failed calls aren't logged: the next run asks again."""
        model = getattr(provider, "model", None) or type(provider).__name__
        fixed = "\x1f".join([str(model), system, json.dumps(schema, sort_keys=True) if schema else ""])
        key = F.sha2(F.concat(F.lit(fixed + "\x1f"), F.coalesce(prompt, F.lit(""))), 256)
        asked = storage.cut(rows.withColumn("question_key", key))
        distinct = asked.select("question_key", F.coalesce(prompt, F.lit("")).alias("prompt")).dropDuplicates(["question_key"])
        known = self.answers()
        todo = distinct.join(known.select(F.col("key").alias("question_key")), "question_key", "left_anti")
        todo = storage.cut(todo.repartition(tasks, "question_key") if tasks else todo)  # written: a repeated task gets the same questions
        failed = storage.cut(self._call(todo, provider, system, schema))
        said = self.answers().select(F.col("key").alias("question_key"), F.struct("text", "model", "prompt_tokens", "completion_tokens", F.lit(None).cast("string").alias("error")).alias("said"))
        wrong = failed.where("error IS NOT NULL").select("question_key", F.struct(F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("model"), F.lit(0).alias("prompt_tokens"), F.lit(0).alias("completion_tokens"), "error").alias("said"))
        result = storage.cut(asked.join(said.unionByName(wrong), "question_key", "left").withColumn(out, F.col("said").cast(RESPONSE)).drop("said", "question_key"))
        self.merge()
        return result

    def _call(self, todo: DataFrame, provider: Provider, system: str, schema: dict | None) -> DataFrame:
        """question_key, error of the questions (question_key, prompt) after each has been asked, or found among what an earlier attempt of its task wrote."""
        root = f"{self.root}/pieces/{uuid.uuid4().hex}"

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa
            from pyarrow import fs
            from pyspark import TaskContext

            store, base = fs.FileSystem.from_uri(root)
            own = f"{base}/{TaskContext.get().partitionId()}"
            store.create_dir(own, recursive=True)
            before, f, began = _asked_before(store, own), None, 0.0
            try:
                for batch in batches:
                    errors = []
                    for key, prompt in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                        error = None
                        if key not in before:
                            try:
                                r = provider.generate(system, prompt, schema=schema)
                                line = json.dumps({"key": key, "text": r.text, "model": r.model, "prompt_tokens": r.prompt_tokens, "completion_tokens": r.completion_tokens})
                            except Exception as e:  # a row's failure doesn't end the batch
                                error = f"{type(e).__name__}: {e}"
                            else:
                                if f is None:
                                    f, began = store.open_output_stream(f"{own}/{uuid.uuid4().hex}.json", compression=None), time.monotonic()
                                f.write(line.encode() + b"\n")
                                f.flush()
                                if time.monotonic() - began > SECONDS:
                                    f = f.close()
                        errors.append(error)
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(errors, pa.string())], ["question_key", "error"])
            finally:
                if f is not None:
                    f.close()

        return todo.select("question_key", "prompt").mapInArrow(run, "question_key string, error string")


def _asked_before(store, folder: str) -> set[str]:
    """The questions that whole lines of a task's files answer."""
    from pyarrow import fs

    found = set()
    for x in store.get_file_info(fs.FileSelector(folder)):
        if x.base_name.endswith(".json"):
            with store.open_input_stream(x.path) as f:
                found |= {json.loads(line)["key"] for line in f.read().split(b"\n")[:-1] if line}
    return found
