"""Line dedup by a log-template tree, with DataFrame functions only.

A line goes down a tree of fixed depth: its number of tokens, its LEAD leading tokens (`<*>` for one that holds a digit),
then the templates of that node, which are learnt from the node's own distinct lines. The lines of a node are one group at
first. A group's centre has at each place the token that over half of its lines have there; where none has, the place is a
field. A line fits if at most one in FIELDS of its tokens differ from the centre, fields included. If over half of a group fit,
these are a template, and the others are a group again. Else the group holds several families: it is split by its most
telling place, the one where two of its lines most often agree and not all do. Lines alone with their token there stay
together, as that place may be a field of theirs. This goes on until each group is a template, or one line, or lines of which no two
agree anywhere but where all do. A node may hold any number of templates; the rounds are as many as the deepest node needs, fewer
than its lines have places. A round writes the lines that it settles and those that are left, and deletes the tables of the round before. A template that several documents share recurs: the document with the smallest id keeps its
lines, all others lose them.

Lines travel as hashes, tokens too, as only their equality counts. Tokens are counted for one line of each distinct text, and only in nodes with several of them, from
pre-aggregated (node, place, token) rows; nodes and templates that hold a large share of all lines are joined by a broadcast
of at most 1 / share rows, so none is one task's work.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.sources.storage import discard, mark

from .common import BLANKS, cut, split_join

#: Leading tokens that are levels of the tree.
LEAD = 3
#: Of a line's tokens one in so many may differ from its template's centre.
FIELDS = 4
NO_ID = -(2**63)
NODE = ["n_tokens", "lead"]
LEAF = [*NODE, "leaf"]


def masked(line: Column) -> Column:
    """The line with single spaces and `<*>` for each token that holds a digit; where these are over half of the tokens, the line itself."""
    uneven = F.contains(line, F.lit("  "))
    for blank in BLANKS[1:]:
        uneven = uneven | F.contains(line, F.lit(blank))
    one = F.trim(F.when(uneven, F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")).otherwise(line))
    general = F.regexp_replace(one, "[^ ]*[0-9][^ ]*", "<*>")
    few = 2 * F.regexp_count(one, F.lit("[^ ]*[0-9][^ ]*")) <= F.length(one) - F.length(F.replace(one, F.lit(" "), F.lit(""))) + 1
    return F.when(F.regexp_like(one, F.lit("[0-9]")) & few, general).otherwise(one)


def _filled(line: Column) -> Column:
    """Whether the line has a word."""
    return F.trim(line, F.lit(BLANKS)) != ""


def _keys() -> tuple[Column, Column]:
    """(doc, text_hash): null ids are one document, the smallest."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")


def line_paths(docs: DataFrame) -> DataFrame:
    """doc, text_hash, pos and n_tokens, lead, leaf (a hash of the masked line) of every line with a word."""
    lines = docs.select(*_keys(), F.posexplode(F.split("text", "\n")).alias("pos", "line")).where(_filled(F.col("line")))
    lines = lines.select("doc", "text_hash", "pos", masked(F.col("line")).alias("m"))
    n = (F.length("m") - F.length(F.replace("m", F.lit(" "), F.lit(""))) + 1).alias("n_tokens")
    return lines.select("doc", "text_hash", "pos", n, F.xxhash64(F.substring_index("m", " ", LEAD)).alias("lead"), F.xxhash64("m").alias("leaf"))


def learn_templates(docs: DataFrame, paths: DataFrame, short_tokens: int = 8) -> DataFrame:
    """n_tokens, lead, leaf, template, n_lines of the leaves that fit a centre; lines under short_tokens tokens fit none."""
    since, spark = mark(), docs.sparkSession
    place = F.min(F.struct("doc", "text_hash", "pos")).alias("place")
    leaves = cut(paths.where(F.col("n_tokens") >= short_tokens).groupBy(*LEAF).agg(F.count("*").alias("n_lines"), place))
    several = cut(leaves.groupBy(*NODE).agg(F.count("*").alias("size")).where("size > 1"))
    open_ = split_join(leaves, several, NODE, "size")
    # One line of each leaf, from the document that place names; a document's lines come out of one join row.
    wanted = open_.groupBy("place.doc", "place.text_hash").agg(F.collect_list(F.struct("place.pos", *LEAF, "n_lines")).alias("lines"))
    found = docs.select(*_keys(), "text").join(wanted, ["doc", "text_hash"]).select(F.split("text", "\n").alias("all"), F.explode("lines").alias("x"))
    tokens = F.transform(F.split(masked(F.get("all", F.col("x.pos"))), " "), lambda t: F.xxhash64(t))
    lines = found.select("x.*", tokens.alias("tokens")).drop("pos").dropDuplicates(LEAF)
    lines = cut(lines.withColumn("group", F.xxhash64(*NODE)))
    done = [cut(lines.select(*LEAF, F.lit(0).cast("long").alias("template"), "n_lines").limit(0))]
    while not lines.isEmpty():
        judged, won = _judge(lines)
        both = split_join(judged, won, ["group"], "size", how="left").drop("size")
        # Written at once: a plan over the joins of all rounds holds a broadcast for each of them.
        done.append(cut(both.where("won AND fits").select(*LEAF, F.xxhash64("group", F.lit("template")).alias("template"), "n_lines")))
        lines = cut(_regrouped(both))
        if len(done) == 8:
            done = [cut(reduce(DataFrame.union, done))]
        discard(spark, since, but=[lines, reduce(DataFrame.union, done)])
    return reduce(DataFrame.union, done)


def _judge(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines of groups of two and more with `fits` and `branch` (their token at the group's most telling place, null if there is none), and the groups that are templates (group, size, won)."""
    counted = lines.select("group", F.posexplode("tokens").alias("at", "token")).groupBy("group", "at", "token").agg(F.count("*").alias("n"))
    agree = F.sum(F.col("n").cast("double") * F.col("n")).alias("agree")
    places = counted.groupBy("group", "at").agg(F.max("n").alias("most"), F.max_by("token", "n").alias("common"), F.sum("n").alias("size"), agree)
    token = F.when(F.col("most") * 2 > F.col("size"), F.col("common")).alias("token")
    telling = F.when((F.col("most") > 1) & (F.col("most") < F.col("size")), F.struct("agree", (-F.col("at")).alias("back")))
    centre = F.transform(F.sort_array(F.collect_list(F.struct("at", token))), lambda x: x["token"]).alias("centre")
    groups = cut(places.groupBy("group").agg(centre, F.max("size").alias("size"), (-F.max(telling)["back"]).alias("split")).where("size > 1"))
    both = split_join(lines, groups, ["group"], "size", few=0)  # whole lines: only the hot ones are broadcast
    apart = F.size(F.filter(F.zip_with("tokens", "centre", lambda a, b: ~a.eqNullSafe(b)), lambda x: x))
    judged = cut(both.withColumn("fits", FIELDS * apart <= F.col("n_tokens")).withColumn("branch", F.get("tokens", F.col("split"))).drop("centre", "size", "split"))
    return judged, cut(judged.groupBy("group").agg(F.count("*").alias("size"), (2 * F.count_if("fits") > F.count("*")).alias("won")).where("won"))


def _regrouped(judged: DataFrame) -> DataFrame:
    """The lines that no template took, in the groups of the next round."""
    left = judged.where("(won AND NOT fits) OR (won IS NULL AND branch IS NOT NULL)")
    rest = F.xxhash64("group", F.lit("rest"))
    left = left.withColumn("next", F.when(F.col("won"), rest).otherwise(F.xxhash64("group", "branch")))
    several = cut(left.groupBy("next").agg(F.count("*").alias("size")).where("size > 1"))
    both = split_join(left, several, ["next"], "size", how="left").where("size IS NOT NULL OR won IS NULL")
    return both.select(*LEAF, "n_lines", "tokens", F.when(F.col("size").isNull(), rest).otherwise(F.col("next")).alias("group"))


def recurring(lines: DataFrame, min_docs: int = 2, short_tokens: int = 8, short_min_docs: int = 10) -> DataFrame:
    """n_tokens, lead, template, n_lines and first_doc of the templates that recur."""
    path = [*NODE, "template"]
    per = lines.groupBy(*path, "doc").agg(F.count("*").alias("n")).groupBy(*path).agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_lines"), F.min("doc").alias("first_doc"))
    return per.where(F.col("n_docs") >= F.when(F.col("n_tokens") < short_tokens, F.lit(short_min_docs)).otherwise(F.lit(min_docs))).drop("n_docs")


def dropped_lines(docs: DataFrame, min_docs: int = 2, short_tokens: int = 8, short_min_docs: int = 10) -> DataFrame:
    """doc, text_hash, pos of the lines to drop."""
    paths = cut(line_paths(docs))
    learnt = cut(learn_templates(docs, paths, short_tokens))
    lines = cut(split_join(paths, learnt, LEAF, "n_lines", how="left").select("doc", "text_hash", "pos", *NODE, F.coalesce("template", "leaf").alias("template")))
    again = cut(recurring(lines, min_docs, short_tokens, short_min_docs))
    return split_join(lines, again, [*NODE, "template"], "n_lines").where("doc <> first_doc").select("doc", "text_hash", "pos")


def dedup_lines(docs: DataFrame, min_docs: int = 2, short_tokens: int = 8, short_min_docs: int = 10) -> DataFrame:
    """docs with the dropped lines gone from text, n_lines (all lines with a word) and n_dropped.

    A template recurs if min_docs documents hold it, or short_min_docs if it has under short_tokens tokens. All other
    lines, blank ones too, stay in order. A text that loses every line with a word becomes empty; the row stays. Null
    text stays null. Null ids count as one document, the smallest. Rows with equal id are one document, so they don't
    make a template recur. Columns of the added names in docs are replaced; no other name clashes. Empty: no rows.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    drops = dropped_lines(docs, min_docs, short_tokens, short_min_docs).groupBy("doc", "text_hash").agg(F.collect_set("pos").alias("drop"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), *_keys())  # so that names of docs can't clash with ours
    both = row.join(drops, ["doc", "text_hash"], "left").select("row", F.col("row.text").alias("text"), F.col("drop"))
    filled = F.filter(F.split("text", "\n"), _filled)
    both = both.withColumn("n_lines", F.coalesce(F.when(F.col("text").isNotNull(), F.size(filled)), F.lit(0)).cast("long"))
    both = both.withColumn("n_dropped", F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long"))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("drop", i)), "\n")
    text = F.when(F.col("drop").isNull(), F.col("text")).when(F.col("n_dropped") == F.col("n_lines"), F.lit("")).otherwise(kept)
    return both.select(*[text.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in names], "n_lines", "n_dropped")
