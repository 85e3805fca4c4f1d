"""Declaration signatures: inventory and freeze check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veriloom.functions import text as T

# The commands that open and close scopes and the declarations whose statements are frozen.
DECLARATIONS = "theorem|lemma|def|abbrev|instance|structure|class"
_NAME = r"[\p{L}\p{N}_.']+"
COMMAND = rf"(?md)^[ \t]*+(?:namespace[ \t]+{_NAME}|section(?:[ \t]+{_NAME})?|end(?:[ \t]+{_NAME})?|(?:{DECLARATIONS})[ \t]+{_NAME})"


def _commands(raw: Column, masked: Column) -> Column:
    """Array of (kind, name, start, stop, next) of the commands in masked code."""

    def describe(found: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            bare = F.regexp_replace(m["text"], r"^[ \t]+", "")
            kind = F.regexp_extract(bare, r"^(namespace|section|end)", 1)
            name = F.regexp_extract(bare, rf"^[a-z]+[ \t]+({_NAME})", 1)
            following = F.coalesce(F.get(found, i + 1)["offset"], F.length(raw))
            return F.struct(kind.alias("kind"), name.alias("name"), m["offset"].alias("start"), (m["offset"] + F.length(m["text"])).alias("stop"), following.alias("following"))

        return F.transform(found, one)

    return T.let(T.matches(masked, COMMAND), describe)


def _qualified(commands: Column) -> Column:
    """Array of (name, start, stop, following) of the declarations, names with the namespaces around them. `end` pops whatever is on top."""
    empty = F.struct(F.expr("cast(array() as array<string>)").alias("scope"), F.expr("cast(array() as array<struct<name:string,start:int,stop:int,following:int>>)").alias("out"))

    def step(a: Column, c: Column) -> Column:
        scope = F.when(c["kind"] == "namespace", F.array_append(a["scope"], c["name"])).when(c["kind"] == "section", F.array_append(a["scope"], F.lit(""))).when(c["kind"] == "end", F.slice(a["scope"], 1, F.greatest(F.size(a["scope"]) - 1, F.lit(0)))).otherwise(a["scope"])
        name = F.array_join(F.array_append(F.filter(a["scope"], lambda z: z != ""), c["name"]), ".")
        out = F.when(c["kind"] == "", F.array_append(a["out"], F.struct(name.alias("name"), c["start"].cast("int").alias("start"), c["stop"].cast("int").alias("stop"), c["following"].cast("int").alias("following")))).otherwise(a["out"])
        return F.struct(scope.alias("scope"), out.alias("out"))

    return F.aggregate(commands, empty, step, lambda a: a["out"])


def inventory(files: DataFrame, project: str = "project") -> DataFrame:
    """project, path, start, name, key, signature (SHA-256) of every frozen declaration of files (project, path, content).

    A statement runs from its command to the first `:=` of the raw text; without one before the next command it isn't
    frozen. Names that a project has before get #2, #3, ... in the order of path and place.
    """
    code = files.select(project, "path", "content", T.mask_code(F.col("content")).alias("masked"))
    found = code.select(project, "path", "content", F.explode(_qualified(_commands(F.col("content"), F.col("masked")))).alias("d")).select(project, "path", "content", "d.*")
    at = F.locate(":=", F.substring(F.col("content"), F.col("stop") + 1, F.length("content"))) + F.col("stop") - 1
    found = found.withColumn("at", F.when(F.contains(F.substring(F.col("content"), F.col("stop") + 1, F.length("content")), F.lit(":=")), at))
    frozen = found.where(F.col("at") <= F.col("following"))
    statement = T.strip(F.substring(F.col("content"), F.col("start") + 1, F.col("at") - F.col("start")))
    rows = frozen.select(project, "path", "start", "name", F.sha2(statement, 256).alias("signature"))
    k = F.row_number().over(Window.partitionBy(project, "name").orderBy("path", "start"))
    return rows.withColumn("key", F.when(k == 1, F.col("name")).otherwise(F.concat("name", F.lit("#"), k.cast("string"))))


def frozen(left: DataFrame, right: DataFrame, project: str = "project") -> DataFrame:
    """project, signatures_frozen: whether both sides have the same multiset of signatures; names, files and order don't count."""
    n = lambda df, c: df.groupBy(project, "signature").agg(F.count("*").alias(c))
    both = n(left, "a").join(n(right, "b"), [project, "signature"], "full")
    return both.groupBy(project).agg(F.bool_and(F.coalesce(F.col("a") == F.col("b"), F.lit(False))).alias("signatures_frozen"))
