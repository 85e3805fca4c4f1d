"""The import graph of projects: edges from import lines, build levels, cycles, what a change affects, and builds that check only that.

All of it are rounds of joins over frontiers: a round touches the edges of the modules that the last one reached, and there are
as many rounds as the longest chain of imports. A round may broadcast its frontier, so each module once; tables that every round
meets go by the shuffle, as their broadcasts would pass through the driver again in each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.functions import text as T
from veriloom.operators import projects
from veriloom.operators.verifier import Verifier
from veriloom.sources.storage import cut

# Fixed value: a line that imports modules.
IMPORT = r"(?m)^[ \t]*import[ \t]+([^\n]*)"
NODE = ["project", "module"]


def _shuffled(table: DataFrame) -> DataFrame:
    """The table, to be joined by the shuffle whatever its size."""
    return table.hint("merge")


def modules(files: DataFrame) -> DataFrame:
    """project, module, path of the projects' sources."""
    return projects.sources(files).select("project", T.module_name(F.col("path")).alias("module"), "path")


def edges(files: DataFrame) -> DataFrame:
    """project, module, imports: the imports of own modules, each once; comments and strings don't count, modules of other projects neither."""
    own = modules(files).select("project", F.col("module").alias("imports")).distinct()
    lines = F.flatten(F.transform(F.regexp_extract_all(T.mask_code(F.col("content")), F.lit(IMPORT), F.lit(1)), lambda x: F.split(T.strip(x), r"[ \t\r]+")))
    found = projects.sources(files).select("project", T.module_name(F.col("path")).alias("module"), F.explode(lines).alias("imports")).where("imports <> ''").distinct()
    return found.join(_shuffled(own), ["project", "imports"], "left_semi").select("project", "module", "imports")


def levels(nodes: DataFrame, imports: DataFrame) -> DataFrame:
    """project, module, level, on_cycle: 0 for modules without imports, else one more than their highest import; null on and behind cycles.

    on_cycle: on a cycle, or between two. nodes: project, module; imports: edges.
    """
    nodes, imports = cut(nodes.select(*NODE).distinct()), cut(imports)
    found = _peeled(nodes, imports, "module", "imports")
    rest = cut(nodes.join(_shuffled(found), NODE, "left_anti"))
    if rest.isEmpty():
        return found.select(*NODE, "level", F.lit(False).alias("on_cycle"))
    inner = imports.join(_shuffled(rest), NODE, "left_semi").join(_shuffled(rest.withColumnRenamed("module", "imports")), ["project", "imports"], "left_semi")
    behind = _peeled(rest, cut(inner), "imports", "module")  # from the other side: what no module of the rest imports
    flagged = rest.join(_shuffled(behind.select(*NODE, F.lit(False).alias("on_cycle"))), NODE, "left").select(*NODE, F.lit(None).cast("int").alias("level"), F.coalesce("on_cycle", F.lit(True)).alias("on_cycle"))
    return found.select(*NODE, "level", F.lit(False).alias("on_cycle")).unionByName(flagged)


def _peeled(nodes: DataFrame, imports: DataFrame, above: str, below: str) -> DataFrame:
    """project, module, level of the nodes that no cycle holds up, in rounds: those whose edges from `above` to `below` all end in earlier rounds."""
    up = imports.select("project", F.col(above).alias("module"), F.col(below).alias("to"))
    degree = cut(up.groupBy(*NODE).agg(F.count("*").alias("degree")))
    frontier = cut(nodes.join(_shuffled(degree), NODE, "left_anti").select(*NODE, F.lit(0).alias("level")))
    found, level = [frontier], 0
    while not frontier.isEmpty():
        level += 1
        reached = up.join(frontier.select("project", F.col("module").alias("to")), ["project", "to"], "left_semi").select(*NODE).distinct()
        known = reduce(DataFrame.unionByName, found).select("project", F.col("module").alias("to"))
        met = up.join(_shuffled(reached), NODE, "left_semi").join(_shuffled(known), ["project", "to"], "left_semi").groupBy(*NODE).agg(F.count("*").alias("met"))
        frontier = cut(met.join(_shuffled(degree), NODE).where("met = degree").select(*NODE, F.lit(level).alias("level")))
        found.append(frontier)
        if len(found) % 16 == 0:  # short plans
            found = [cut(reduce(DataFrame.unionByName, found))]
    return reduce(DataFrame.unionByName, found)


def affected(imports: DataFrame, changed: DataFrame) -> DataFrame:
    """project, module: the changed modules (project, module) and all that import them, directly or not; cycles end by themselves."""
    down = cut(imports.select("project", F.col("imports").alias("module"), F.col("module").alias("next")))
    frontier = cut(changed.select(*NODE).distinct())
    found = [frontier]
    while not frontier.isEmpty():
        known = reduce(DataFrame.unionByName, found)
        frontier = cut(down.join(frontier, NODE).select("project", F.col("next").alias("module")).distinct().join(_shuffled(known), NODE, "left_anti"))
        found.append(frontier)
        if len(found) % 16 == 0:
            found = [cut(reduce(DataFrame.unionByName, found))]
    return reduce(DataFrame.unionByName, found)


def fingerprints(files: DataFrame) -> DataFrame:
    """project, module, path, level, on_cycle, fingerprint: a digest of a file's text and its imports' fingerprints, level by level; null on and behind cycles."""
    own = cut(projects.sources(files).select("project", T.module_name(F.col("path")).alias("module"), "path", F.sha2("content", 256).alias("text")))
    imports = cut(edges(files))
    placed = cut(own.join(_shuffled(levels(own, imports)), NODE))
    highest = placed.agg(F.max("level")).first()[0]
    done = [cut(placed.where("level = 0").select(*NODE, F.sha2("text", 256).alias("fingerprint")))]
    for k in range(1, (highest or 0) + 1):
        now = placed.where(F.col("level") == k).select(*NODE, "text")
        known = reduce(DataFrame.unionByName, done).select("project", F.col("module").alias("imports"), "fingerprint")
        below = imports.join(_shuffled(now.select(*NODE)), NODE, "left_semi").join(_shuffled(known), ["project", "imports"])
        parts = below.groupBy(*NODE).agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "imports", "fingerprint"))), ",").alias("below"))
        done.append(cut(now.join(_shuffled(parts), NODE).select(*NODE, F.sha2(F.concat_ws("|", "text", "below"), 256).alias("fingerprint"))))
        if len(done) % 16 == 0:  # short plans
            done = [cut(reduce(DataFrame.unionByName, done))]
    done = reduce(DataFrame.unionByName, done)
    return placed.join(_shuffled(done), NODE, "left").select(*NODE, "path", "level", "on_cycle", "fingerprint")


def build(files: DataFrame, verifier: Verifier, prior: DataFrame | None = None) -> DataFrame:
    """A verdict for each source: project, path, level, fingerprint, exit_code, global_errors, holes, output, reused.

    prior: a build before, of these or other projects. A file is checked only if no prior file of its path has its fingerprint, so
    after a change that is the files affected(). Files on and behind cycles aren't checked: exit 1 and an error that says so.
    """
    found = cut(fingerprints(files))
    verdict = ["exit_code", "global_errors", "holes", "output"]
    if prior is None:
        old = found.limit(0).selectExpr("path", "fingerprint", "0 AS exit_code", "0 AS global_errors", "0 AS holes", "'' AS output")
    else:
        old = prior.where("fingerprint IS NOT NULL").groupBy("path", "fingerprint").agg(F.min(F.struct(*verdict)).alias("v")).select("path", "fingerprint", "v.*")
    reused = cut(found.join(_shuffled(old), ["path", "fingerprint"]))
    todo = cut(found.where("fingerprint IS NOT NULL").join(_shuffled(reused.select("project", "path")), ["project", "path"], "left_anti"))
    checked = verifier.check_files(files, todo.select("project", "path", "level"))
    fresh = todo.join(_shuffled(checked), ["project", "path"])
    stuck = found.where("fingerprint IS NULL").select("project", "path", "level", "fingerprint", F.lit(1).alias("exit_code"), F.lit(1).alias("global_errors"), F.lit(0).alias("holes"), F.concat("path", F.lit(": error: import cycle")).alias("output"))
    shape = ["project", "path", "level", "fingerprint", *verdict]
    return cut(reused.select(*shape, F.lit(True).alias("reused")).unionByName(fresh.select(*shape, F.lit(False).alias("reused"))).unionByName(stuck.select(*shape, F.lit(False).alias("reused"))))
