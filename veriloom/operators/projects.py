"""Project files as immutable versions: a table of (project, path, content); a step makes another table and a choice keeps one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.functions import text as T

# What is no module of a project.
NOT_SOURCES = r"(?:^|/)\.lake/|(?:^|/)lakefile\.lean\z|(?:^|/)AxiomAudit\.lean\z"


def sources(files: DataFrame) -> DataFrame:
    return files.where(~F.regexp_like("path", F.lit(NOT_SOURCES)))


def module_files(files: DataFrame, project: str = "project") -> DataFrame:
    """Sources without top-level aggregators, whose stem is a directory with sources."""
    own = sources(files)
    stems = files.where(F.contains("path", F.lit("/"))).select(project, F.substring_index("path", "/", 1).alias("_stem")).distinct()
    stem = F.when(~F.contains("path", F.lit("/")), F.regexp_replace("path", r"\.lean\z", ""))
    return own.withColumn("_stem", stem).join(stems, [project, "_stem"], "left_anti").drop("_stem").select(*files.columns)


def checked_paths(patch: DataFrame) -> DataFrame:
    """The patch, contents with one newline at the end; an unsafe path raises."""
    path = F.when(T.safe_path(F.col("path")), F.col("path")).otherwise(F.raise_error(F.concat(F.lit("unsafe output path: "), "path")))
    return patch.withColumn("path", path).withColumn("content", T.normal_content(F.col("content")))


def overlay(base: DataFrame, patch: DataFrame, project: str = "project") -> DataFrame:
    """base with patch's files written over it."""
    key = [project, "path"]
    new = patch.select(*key, F.col("content").alias("_new"))
    return base.select(*key, "content").join(new, key, "full").select(*key, F.coalesce("_new", "content").alias("content"))


def delete(base: DataFrame, paths: DataFrame, project: str = "project") -> DataFrame:
    return base.join(paths.select(project, "path").distinct(), [project, "path"], "left_anti")


def choose(current: DataFrame, candidate: DataFrame, accepted: DataFrame, project: str = "project") -> DataFrame:
    """The candidate's files of accepted projects (project, accepted), the current files of all others: commit or revert."""
    yes = accepted.where("accepted").select(project)
    return candidate.join(yes, project, "left_semi").unionByName(current.join(yes, project, "left_anti"))


def large_files(files: DataFrame, max_lines: int = 2_000) -> DataFrame:
    rows = files.where(~F.regexp_like("path", F.lit(r"(?:^|/)lakefile\.lean\z"))).withColumn("n_lines", T.line_count(F.col("content")))
    return rows.where(F.col("n_lines") > max_lines)


def holes(files: DataFrame) -> DataFrame:
    """The files' keys and line, offset of every hole in code."""
    keys = [c for c in files.columns if c != "content"]
    found = files.select(*keys, "content", F.explode(T.matches(T.mask_code(F.col("content")), T.HOLE)).alias("m"))
    return found.select(*keys, T.line_of(F.col("content"), F.col("m.offset")).alias("line"), F.col("m.offset").alias("offset"))


def escape_hatches(files: DataFrame) -> DataFrame:
    """The files' keys and kind, line of every escape hatch in code; a match of blanks and a word counts where it begins."""
    keys = [c for c in files.columns if c != "content"]
    masked = files.select(*keys, "content", T.mask_code(F.col("content")).alias("code"))
    kinds = F.flatten(F.array(*[_tagged(p, kind) for kind, p in T.ESCAPES.items()]))
    found = masked.select(*keys, "content", F.explode(kinds).alias("m"))
    return found.select(*keys, F.col("m.kind").alias("kind"), T.line_of(F.col("content"), F.col("m.offset")).alias("line"))


def _tagged(pattern: str, kind: str):
    found = F.transform(T.matches(F.col("code"), pattern), lambda m: F.struct(F.lit(kind).alias("kind"), m["offset"].alias("offset")))
    return F.when(F.contains("code", F.lit(kind)), found).otherwise(F.expr("cast(array() as array<struct<kind:string,offset:int>>)"))
