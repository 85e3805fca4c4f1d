"""The proof checker behind one interface: a table of files in, one verification a project out."""

from __future__ import annotations

import os
import subprocess
import tempfile
import time
from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.functions import text as T

SCHEMA = "exit_code int, global_errors int, holes int, output string, seconds double"


class Verifier(Protocol):
    def verify(self, files: DataFrame) -> DataFrame:
        """project, exit_code, global_errors, holes, output, seconds for each project of files (project, path, content)."""
        ...

    def check(self, files: DataFrame, path: str) -> DataFrame:
        """The same for one file (of this path) of each project, the rest of the project beside it."""
        ...

    def check_files(self, files: DataFrame, targets: DataFrame) -> DataFrame:
        """project, path, exit_code, global_errors, holes, output of each target (project, path, level), lower levels of a project first, its other files beside it."""
        ...


class OfflineVerifier:
    """Counts holes and reports a line with the word `broken` in code as an error. It checks plumbing, not proofs."""

    fixed = True  # see pipelines.fixed

    def verify(self, files: DataFrame) -> DataFrame:
        code = files.select("project", T.mask_code(F.col("content")).alias("code"))
        n = code.select("project", T.count_holes(F.col("code")).alias("h"), F.regexp_count("code", F.lit(r"(?=b)\bbroken\b")).alias("e"))
        out = n.groupBy("project").agg(F.sum("h").cast("int").alias("holes"), F.sum("e").cast("int").alias("global_errors"))
        return out.select("project", F.when(F.col("global_errors") > 0, 1).otherwise(0).alias("exit_code"), "global_errors", "holes", F.repeat(F.lit("x: error: broken\n"), F.col("global_errors")).alias("output"), F.lit(0.0).alias("seconds"))

    def check(self, files: DataFrame, path: str) -> DataFrame:
        return self.verify(files.where(F.col("path") == path))

    def check_files(self, files: DataFrame, targets: DataFrame) -> DataFrame:
        wanted = files.join(targets.select("project", "path").hint("merge"), ["project", "path"], "left_semi")
        each = self.verify(wanted.select(F.struct("project", "path").alias("project"), "path", "content"))
        return each.select("project.project", "project.path", "exit_code", "global_errors", "holes", "output")


class ProcessVerifier:
    """Writes a project's files to a folder of the task and runs the build there; check runs file_argv with the file's path, if given, else the build."""

    def __init__(self, argv: tuple[str, ...] = ("lake", "build"), timeout: int = 600, file_argv: tuple[str, ...] | None = None):
        self.argv, self.timeout, self.file_argv = argv, timeout, file_argv

    def verify(self, files: DataFrame) -> DataFrame:
        return self._run(files, self.argv)

    def check(self, files: DataFrame, path: str) -> DataFrame:
        return self._run(files, (*self.file_argv, path) if self.file_argv else self.argv)

    def check_files(self, files: DataFrame, targets: DataFrame) -> DataFrame:
        timeout, argv = self.timeout, self.file_argv or self.argv
        wanted = targets.groupBy("project").agg(F.sort_array(F.collect_list(F.struct("level", "path"))).alias("targets"))
        mine = files.join(wanted.select("project"), "project", "left_semi")
        per = mine.groupBy("project").agg(F.collect_list(F.struct("path", "content")).alias("files")).join(wanted, "project")

        def run(batches: Iterator) -> Iterator:
            import pandas as pd

            for rows in batches:
                out = []
                for r in rows.itertuples():
                    with tempfile.TemporaryDirectory() as own:
                        _write_files(own, r.files)
                        out += [(r.project, t["path"], *_command((*argv, t["path"]), own, timeout)[:2]) for t in r.targets]
                yield pd.DataFrame(out, columns=["project", "path", "exit_code", "output"])

        kind = files.schema["project"].dataType.simpleString()
        made = per.mapInPandas(run, f"project {kind}, path string, exit_code int, output string")
        holes = mine.select("project", "path", T.count_holes(T.mask_code(F.col("content"))).alias("holes"))
        return made.join(holes, ["project", "path"]).select("project", "path", "exit_code", T.count_errors(F.col("output")).cast("int").alias("global_errors"), "holes", "output")

    def _run(self, files: DataFrame, argv: tuple[str, ...]) -> DataFrame:
        timeout = self.timeout
        per = files.groupBy("project").agg(F.collect_list(F.struct("path", "content")).alias("files"), F.sum(T.count_holes(T.mask_code(F.col("content")))).cast("int").alias("holes"))

        def run(batches: Iterator) -> Iterator:
            import pandas as pd

            for rows in batches:
                out = []
                for r in rows.itertuples():
                    with tempfile.TemporaryDirectory() as own:
                        _write_files(own, r.files)
                        code, said, took = _command(argv, own, timeout)
                        out.append((r.project, code, r.holes, said, took))
                yield pd.DataFrame(out, columns=["project", "exit_code", "holes", "output", "seconds"])

        kind = files.schema["project"].dataType.simpleString()
        made = per.mapInPandas(run, f"project {kind}, exit_code int, holes int, output string, seconds double")
        return made.withColumn("global_errors", T.count_errors(F.col("output")).cast("int"))


def _write_files(root: str, files) -> None:
    for f in files:
        path = os.path.join(root, f["path"])
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as o:
            o.write(f["content"])


def _command(argv: tuple[str, ...], folder: str, timeout: int) -> tuple[int, str, float]:
    """(exit code, the end of what it said, seconds) of a program in a folder; 127 where it can't be run or takes too long."""
    began = time.monotonic()
    try:
        done = subprocess.run(argv, cwd=folder, text=True, stdout=subprocess.PIPE, stderr=subprocess.STDOUT, timeout=timeout)
        code, said = done.returncode, done.stdout
    except (OSError, subprocess.TimeoutExpired) as e:
        code, said = 127, f"x: error: {type(e).__name__}: {e}"
    return code, said[-T.OUTPUT_TAIL :], round(time.monotonic() - began, 3)


#: The file that asks for a goal; no project has one of that name.
GOAL_FILE = "GoalQuery.lean"


def goal_state(verifier: Verifier, files: DataFrame, focus: DataFrame, last: int = 10_000) -> DataFrame:
    """project, goal: what the checker says at each project's focus (project, path, line).

    The file in focus is checked once more under another name, with `trace_state` above the line if that holds a hole.
    """
    at = focus.select("project", "path", "line").join(files, ["project", "path"]).select("project", F.coalesce(T.trace_goal(F.col("content"), F.col("line")), "content").alias("content"))
    asked = files.join(at.select("project"), "project", "left_semi").select("project", "path", "content").unionByName(at.select("project", F.lit(GOAL_FILE).alias("path"), "content"))
    return verifier.check(asked, GOAL_FILE).select("project", T.tail(F.col("output"), last).alias("goal"))
