"""Project files over time: an append-only log of changes, read as of any version; a version costs what it changes.

A change is (project, path, content, version), content null where the file is deleted. Nothing is ever rewritten but by
compact(), which folds old changes into one interval table (from_version, to_version) that a filter alone reads as of a version.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veriloom.sources import storage

CHANGE = "project long, path string, content string, version long"
KEY = ["project", "path"]


def changes(before: DataFrame, after: DataFrame, version: int) -> DataFrame:
    """The log's rows that turn the files (project, path, content) before into those after: new and other contents, nulls for deleted files."""
    both = before.select(*KEY, F.col("content").alias("old")).join(after.select(*KEY, F.col("content").alias("new")), KEY, "full")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select(*KEY, F.col("new").alias("content"), F.lit(version).cast("long").alias("version"))


def intervals(log: DataFrame) -> DataFrame:
    """project, path, content, from_version, to_version (exclusive, null: still there) of every content that a file had; equal contents in a row are one interval."""
    w = Window.partitionBy(*KEY).orderBy("version")
    same = F.coalesce(F.lag("content").over(w).eqNullSafe(F.col("content")) & F.lag("version").over(w).isNotNull(), F.lit(False))
    kept = log.withColumn("same", same).where("NOT same")
    return kept.withColumn("to_version", F.lead("version").over(w)).where("content IS NOT NULL").select(*KEY, "content", F.col("version").alias("from_version"), "to_version")


def at(table: DataFrame, version: Column | int) -> DataFrame:
    """The files of an interval table as of a version (a number, or a column of the table): a filter, no shuffle."""
    v = F.lit(version) if isinstance(version, int) else version
    return table.where((F.col("from_version") <= v) & (F.col("to_version").isNull() | (F.col("to_version") > v))).select(*KEY, "content")


def latest(log: DataFrame) -> DataFrame:
    """project, path, content after all changes of the log."""
    last = log.groupBy(*KEY).agg(F.max_by(F.struct("content"), "version").alias("c"))
    return last.select(*KEY, "c.content").where("content IS NOT NULL")


def as_of(log: DataFrame, versions: DataFrame) -> DataFrame:
    """The files as of a version for each project (project, version); projects that it lacks are left out."""
    upto = versions.select("project", F.col("version").alias("upto"))
    return latest(log.join(upto, "project").where("version <= upto").drop("upto"))


def along(log: DataFrame, chains: DataFrame) -> DataFrame:
    """project, path, content of the files that only the versions in each project's chain (project, chain array<long>) make: a branch of the log, whose versions rise along it."""
    steps = chains.select("project", F.explode("chain").alias("version"))
    return latest(log.join(steps, ["project", "version"]))


class VersionTable:
    """The log in a folder, a folder for each version. A version is there once its folder is named by a rename: a commit that fails leaves none, one that is repeated replaces its own."""

    def __init__(self, spark: SparkSession, root: str, schema: str = CHANGE):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def _numbers(self, kind: str) -> list[int]:
        names = storage.children(self.spark, self.root)
        return sorted(int(m[1]) for m in (re.fullmatch(rf"{kind}-(\d+)", n) for n in names) if m)

    def versions(self) -> list[int]:
        """All versions that are there: those of the folded part, too, by its highest."""
        folded = self._numbers("base")[-1:]
        return sorted({*folded, *self._numbers("v")})

    def commit(self, changed: DataFrame, version: int | None = None) -> int:
        """Appends changes (project, path, content; null: deleted) as the next version, or as the given one; returns it."""
        number = version if version is not None else max(self.versions(), default=-1) + 1
        rows = changed.select(*KEY, "content", F.lit(number).cast("long").alias("version"))
        storage.replace_folder(rows, f"{self.root}/v-{number:012d}")
        return number

    def log(self) -> DataFrame:
        """The changes since the last compact(), and one row for each interval's begin (and end) before it."""
        base, top = self._base()
        paths = [f"{self.root}/v-{n:012d}" for n in self._numbers("v") if n > top]
        new = self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
        if base is None:
            return new
        begins = base.select(*KEY, "content", F.col("from_version").alias("version"))
        ends = base.where("to_version IS NOT NULL").select(*KEY, F.lit(None).cast("string").alias("content"), F.col("to_version").alias("version"))
        ends = ends.join(begins.select(*KEY, "version"), [*KEY, "version"], "left_anti")  # where another content follows at once, that is the change
        return new.unionByName(begins).unionByName(ends)

    def _base(self) -> tuple[DataFrame | None, int]:
        folded = self._numbers("base")
        return (self.spark.read.parquet(f"{self.root}/base-{folded[-1]:012d}"), folded[-1]) if folded else (None, -1)

    def files(self, version: int | None = None) -> DataFrame:
        """project, path, content as of a version; none: the last. Up to the folded version that is a filter on one table."""
        base, top = self._base()
        if base is not None and version is not None and version <= top:
            return at(base, version)
        paths = [f"{self.root}/v-{n:012d}" for n in self._numbers("v") if n > top and (version is None or n <= version)]
        new = self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
        old = at(base, top).withColumn("version", F.lit(top).cast("long")) if base is not None else None
        return latest(new if old is None else new.unionByName(old))

    def compact(self) -> int:
        """Folds all versions into one interval table, by which each of them can still be read; returns the highest."""
        top = max(self.versions(), default=-1)
        if top >= 0 and self._base()[1] != top:
            storage.replace_folder(intervals(self.log()), f"{self.root}/base-{top:012d}")
        return top
