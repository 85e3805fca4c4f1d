"""The trie of conversation prefixes by prefix doubling: names of aligned blocks of 1, 2, 4, ... turns, then of all prefixes, in logarithmic rounds of joins.

Turns with equal role and text share a dense name. Two neighbouring blocks of a size make one of twice the size, named by the
pair of their names. A prefix of d turns is the prefix without d's lowest bit, and the block of that many turns behind it: the
prefixes are named from the highest bit down, all that end at a multiple of 2^k in one round. So equal names are equal sequences,
without any comparison of hashes of long sequences, and no round handles more rows than there are turns. Nodes are then groups of
names. Sums over subtrees double, too: a node that knows the sum of what lies less than 2^k below it adds those of its
descendants 2^k below.

Pairs are counted before they are named, so a hot one (a first turn that a third of all conversations share) is one row of the
names; rows meet their names by joins whose hot partitions Spark splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veriloom.operators.tasks import ordinal

from .common import cut, word_count

#: A conversation takes its first turns from the one whose id is the next lower multiple of FAMILY.
FAMILY, HEADS = 20, 4
_BITS = 33  # of monotonically_increasing_id, below the partition's number


def named(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """rows with a column `name`: a dense number, from 0, for each distinct key (columns without nulls)."""
    distinct = cut(rows.select(*key).distinct().withColumn("at", F.monotonically_increasing_id()))
    part, at = F.shiftright("at", _BITS), F.col("at").bitwiseAND((1 << _BITS) - 1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = distinct.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    names = distinct.withColumn("part", part).join(F.broadcast(offsets), "part").select(*key, (F.col("offset") + at).alias(name))
    return rows.join(names, key)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, i, role_text, n_words) of every rebuilt turn, i from 0, and all conv."""
    some = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    identity = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    light = cut(ordinal(some.select("conv", "turn", identity.alias("role_text"), word_count(F.col("text")).alias("n_words")), ["conv", "turn", "role_text"]))
    first = light.groupBy("conv").agg(F.min("row_pos").alias("first"), F.count("*").alias("size"))
    h = (F.crc32(F.col("conv").cast("string")) % HEADS).cast("long")
    everyone = cut(first.select("conv", "first", "size", h.alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("base")))
    k = F.col("row_pos") - F.col("first")
    heads = cut(light.join(everyone, "conv").withColumn("k", k).where(F.col("k") < HEADS - 1).select(F.col("conv").alias("base"), "k", "role_text", "n_words"))
    taken = everyone.join(heads, "base").where("k < h").select("conv", F.col("k").alias("i"), "role_text", "n_words")
    lent = everyone.select(F.col("conv").alias("base"), F.least("size", F.lit(HEADS - 1)).alias("lent"))
    whole = everyone.join(lent, "base", "left").select("conv", "first", "size", "h", F.least("h", F.coalesce("lent", F.lit(0))).alias("n_heads"))
    rest = light.join(cut(whole), "conv").where(F.col("row_pos") - F.col("first") >= F.col("h"))
    rest = rest.select("conv", (F.col("row_pos") - F.col("first") - F.col("h") + F.col("n_heads")).alias("i"), "role_text", "n_words")
    return taken.unionByName(rest), everyone.select("conv")


def prefix_names(turns: DataFrame) -> DataFrame:
    """conv, depth, name, parent (the name of the prefix one shorter), n_words (of the last turn) of all prefixes from depth 1 on; turns: rebuilt's form."""
    base = cut(named(turns, ["role_text"], "name").select("conv", "i", "name", "n_words"))
    longest = base.agg(F.max("i")).first()[0]
    if longest is None:
        return base.selectExpr("conv", "i AS depth", "name", "name AS parent", "n_words")
    # Blocks of 2^j turns at m * 2^j: (conv, m, name).
    blocks = [base.select("conv", F.col("i").alias("m"), "name")]
    while 2 << (len(blocks) - 1) <= longest + 1:
        below = blocks[-1]
        left = below.where("m % 2 = 0").select("conv", (F.col("m") / 2).cast("long").alias("m"), F.col("name").alias("l"))
        right = below.where("m % 2 = 1").select("conv", F.floor(F.col("m") / 2).alias("m"), F.col("name").alias("r"))
        blocks.append(cut(named(left.join(right, ["conv", "m"]), ["l", "r"], "name").select("conv", "m", "name")))
    # Prefixes of d turns, d a multiple of 2^j: those of 2^(j+1) are known, the others end with one more block. Name -1: the empty prefix.
    known = base.selectExpr("conv", "i AS d", "name").limit(0)
    for j in range(len(blocks) - 1, -1, -1):
        last = blocks[j].where("m % 2 = 0").select("conv", (F.col("m") * (1 << j)).alias("d"), F.col("name").alias("r"))
        found = last.join(known.select("conv", "d", F.col("name").alias("l")), ["conv", "d"], "left").where("d = 0 OR l IS NOT NULL")
        new = named(cut(found.select("conv", "d", F.coalesce("l", F.lit(-1)).alias("l"), "r")), ["l", "r"], "own")
        # A name holds its round, so that those of different rounds differ.
        known = known.unionByName(cut(new.select("conv", (F.col("d") + (1 << j)).alias("d"), (F.col("own") * 64 + j).alias("name"))))
    at = known.select("conv", F.col("d").alias("depth"), "name")
    parents = known.select("conv", (F.col("d") + 1).alias("depth"), F.col("name").alias("parent"))
    words = base.select("conv", (F.col("i") + 1).alias("depth"), "n_words")
    return at.join(words, ["conv", "depth"]).join(parents, ["conv", "depth"], "left").select("conv", "depth", "name", F.coalesce("parent", F.lit(-1)).alias("parent"), "n_words")


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """name and the sums of the values over each node's subtree; nodes: name, parent (null: the root), depth and the values."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    state = cut(nodes.select("name", F.col("parent").alias("up"), *values))  # up: the ancestor 2^k above
    reach = 1
    while reach <= deepest:
        below = cut(state.where("up IS NOT NULL").groupBy(F.col("up").alias("name")).agg(*[F.sum(v).alias(f"more_{v}") for v in values]))
        summed = state.join(below, "name", "left").select("name", "up", *[(F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values])
        ups = state.select(F.col("name").alias("up"), F.col("up").alias("next"))
        state = cut(summed.join(ups, "up", "left").select("name", F.col("next").alias("up"), *values))
        reach *= 2
    return state.drop("up")


def digests(members: DataFrame) -> DataFrame:
    """name, ends_sha256: SHA-256 of each name's conv in ascending order, comma-joined; a task holds a piece of a list at a time."""

    def pieces(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: list[tuple[int, int, list[str]]] = []

        def made():
            out = pa.RecordBatch.from_arrays([pa.array([x[0] for x in held], pa.int64()), pa.array([x[1] for x in held], pa.int64()), pa.array([",".join(x[2]) for x in held], pa.string())], ["name", "first", "ids"])
            held.clear()
            return out

        for batch in batches:
            for name, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and held[-1][0] == name and len(held[-1][2]) < 50_000:
                    held[-1][2].append(str(conv))
                else:
                    if len(held) >= 5_000 or held and len(held[-1][2]) >= 50_000:
                        yield made()
                    held.append((name, conv, [str(conv)]))
        if held:
            yield made()

    def hashed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        name, digest, done = None, None, []
        for batch in batches:
            for now, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                if now != name:
                    if digest is not None:
                        done.append((name, digest.hexdigest()))
                    name, digest = now, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done], pa.string())], ["name", "ends_sha256"])
            done = []
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([digest.hexdigest()], pa.string())], ["name", "ends_sha256"])

    ranged = members.select("name", "conv").repartitionByRange("name", "conv").sortWithinPartitions("name", "conv").mapInArrow(pieces, "name long, first long, ids string")
    return ranged.repartition("name").sortWithinPartitions("name", "first").select("name", "ids").mapInArrow(hashed, "name long, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of turns (conv_id, turn, role, text): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty, null turns come first, rows of one turn in the order of a hash of role and text (repeated rows
    are turns of their own). Rows without conv_id belong to no conversation. Other columns are left out, so none can
    clash. Empty: no rows, not even a root.
    """
    rows, everyone = rebuilt(turns)
    prefixes = cut(prefix_names(cut(rows)))
    root = F.lit(-1).cast("long")
    grouped = prefixes.groupBy("name").agg(F.min("conv").alias("conv_id"), F.first("depth").cast("long").alias("depth"), F.first("parent").alias("parent"), F.count("*").alias("n_convs"), F.first("n_words").alias("n_words"))
    top = everyone.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(root.alias("name"), "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"), "n_convs", F.lit(0).cast("long").alias("n_words"))
    nodes = cut(grouped.unionByName(top))
    children = cut(nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children")))
    nodes = cut(nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    valued = nodes.select("name", "parent", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved_tokens"))
    sums = subtree_sums(valued, ["n_leaves", "saved_tokens"])
    depth = prefixes.groupBy("conv").agg(F.max("depth").alias("depth"))
    ends = prefixes.join(depth, ["conv", "depth"], "left_semi").select("name", "conv").unionByName(everyone.join(depth, "conv", "left_anti").select(root.alias("name"), "conv"))
    parents = nodes.where("n_children > 0").select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(parents, "parent", "left").join(sums, "name").join(digests(ends), "name", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
