"""JSON arrays of any size as rows: the file is cut into pieces that several tasks read, wherever the cuts fall.

What a piece does to a reader's state (within a string, after a backslash, how deep) is a function of the state before: for each of
three ways to begin, how it ends, and by how much the depth changes. Tasks compute it for their ranges, a prefix scan over the ranges
(a row for each) composes the functions, and then every task knows the state that its range begins in and cuts out the array's
elements. An element that crosses ranges is put together from its parts by its number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veriloom.sources import storage

#: Ways to begin: outside of strings, in a string, in a string right after a backslash.
OUTSIDE, INSIDE, ESCAPED = range(3)
#: Ranges that one window may scan: more are scanned by groups of so many, then by groups of groups.
GROUP = 4_096
_MARK = re.compile(r'["\\\[\]{},]')


def effect(piece: str, state: int) -> tuple[int, int]:
    """(state after, change of depth) of a piece that begins in a state."""
    depth = 0
    at = 0
    if state == ESCAPED and piece:
        state, at = INSIDE, 1
    while m := _MARK.search(piece, at):
        c, at = m[0], m.end()
        if state == INSIDE:
            if c == "\\":
                if at == len(piece):
                    return ESCAPED, depth
                at += 1
            elif c == '"':
                state = OUTSIDE
        elif c == '"':
            state = INSIDE
        elif c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
    return state, depth


def elements(piece: str, state: int, depth: int) -> Iterator[tuple[str, bool]]:
    """(text, ended) of the parts of the outer array's elements in a piece that begins in a state at a depth; ended: the element ends with its part."""
    begin = at = 0
    if state == ESCAPED and piece:
        state, at = INSIDE, 1
    while m := _MARK.search(piece, at):
        c, at = m[0], m.end()
        if state == INSIDE:
            if c == "\\":
                at += 1
            elif c == '"':
                state = OUTSIDE
        elif c == '"':
            state = INSIDE
        elif c in "[{":
            depth += 1
            if depth == 1:
                begin = at  # the outer bracket
        elif c in "]}":
            depth -= 1
            if depth == 0:
                yield piece[begin : at - 1], True
                begin = len(piece)
        elif c == "," and depth == 1:
            yield piece[begin : at - 1], True
            begin = at
    if depth >= 1 and begin < len(piece):
        yield piece[begin:], False


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, range, k, piece: the files' text between commas, by ranges of a file that Spark's reader splits; range: where it begins in the file."""
    lines = spark.read.text(path, lineSep=",").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("k"), F.col("value").alias("piece"))
    return lines.withColumn("piece", F.concat("piece", F.lit(",")))  # the last one too: a comma behind the array changes nothing


def array_elements(cut_up: DataFrame) -> DataFrame:
    """file, row_pos, element (JSON text) of the arrays in cut_up: file, range, k (order within the range), piece. A file without an array, or with an empty one, has no rows; what doesn't end raises.

    A task holds one range's pieces by the batch, and one element.
    """
    rows = storage.cut(cut_up.select("file", "range", "k", "piece"))

    def effects(batches: Iterator) -> Iterator:
        import pyarrow as pa

        now, states = None, None
        done: list[tuple] = []
        for batch in batches:
            for file, start, piece in zip(batch.column("file").to_pylist(), batch.column("range").to_pylist(), batch.column("piece").to_pylist()):
                if now != (file, start):
                    if now is not None:
                        done.append((*now, states))
                    now, states = (file, start), [(s, 0) for s in range(3)]
                made = {s: effect(piece, s) for s in {s for s, _ in states}}
                states = [(made[s][0], depth + made[s][1]) for s, depth in states]
        if now is not None:
            done.append((*now, states))
        shape = pa.list_(pa.struct([("to", pa.int32()), ("depth", pa.int64())]))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64()), pa.array([[{"to": s, "depth": d} for s, d in x[2]] for x in done], shape)], ["file", "range", "effect"])

    ordered = lambda x: x.repartition("file", "range").sortWithinPartitions("file", "range", "k")
    functions = storage.cut(ordered(rows).mapInArrow(effects, "file string, range long, effect array<struct<to:int,depth:long>>"))
    begins = _scanned(functions)

    def parts(batches: Iterator) -> Iterator:
        import pyarrow as pa

        now, state, depth, n, seen = None, 0, 0, 0, False
        for batch in batches:
            out = []
            for file, start, k, piece, at_state, at_depth in zip(*(batch.column(c).to_pylist() for c in ("file", "range", "k", "piece", "state", "depth"))):
                if now != (file, start):
                    now, state, depth, n = (file, start), at_state, at_depth, 0
                for text, ended in elements(piece, state, depth):
                    out.append((file, start, n, k, text, ended))
                    n += ended
                state, more = effect(piece, state)
                depth += more
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)], ["file", "range", "n", "k", "part", "ended"])

    begun = ordered(rows.join(begins, ["file", "range"])).select("file", "range", "k", "piece", "state", "depth")
    found = storage.cut(begun.mapInArrow(parts, "file string, range long, n long, k long, part string, ended boolean"))
    # Elements are numbered by how many ended in the ranges before, and in the range.
    ended = found.groupBy("file", "range").agg(F.sum(F.col("ended").cast("long")).alias("m"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    base = ended.select("file", "range", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"))
    numbered = found.join(base, ["file", "range"]).select("file", (F.col("base") + F.col("n")).alias("row_pos"), "range", "k", "part", "ended")
    whole = numbered.groupBy("file", "row_pos").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("range", "k", "part"))), lambda x: x["part"]), "").alias("element"), F.bool_or("ended").alias("ended"))
    text = F.when(F.col("ended"), F.col("element")).otherwise(F.raise_error(F.concat(F.lit("the array doesn't end: "), "file")))
    return whole.select("file", "row_pos", text.alias("element")).where(F.trim("element", F.lit(" \t\r\n")) != "")


def _scanned(functions: DataFrame) -> DataFrame:
    """file, range, state, depth: what each range begins with, by composing the ranges' functions before it, in groups, so that no window gets all of them."""
    numbered = functions.withColumn("i", F.row_number().over(Window.partitionBy("file").orderBy("range")) - 1)
    grouped = numbered.withColumn("g", F.floor(F.col("i") / GROUP))
    empty = F.expr("array(named_struct('to', 0, 'depth', 0L), named_struct('to', 1, 'depth', 0L), named_struct('to', 2, 'depth', 0L))")

    def then(a, f):
        """f after a."""
        return F.transform(a, lambda x: F.struct(F.get(f, x["to"])["to"].alias("to"), (x["depth"] + F.get(f, x["to"])["depth"]).alias("depth")))

    def composed(rows: DataFrame, by: list[str], order: str) -> DataFrame:
        """rows with before, the composition of the functions before each in its group, and whole, that of all."""
        per = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(order, "effect"))).alias("fs"))
        start = F.struct(empty.alias("now"), F.expr("cast(array() as array<array<struct<to:int,depth:long>>>)").alias("out"))
        walked = F.aggregate("fs", start, lambda a, f: F.struct(then(a["now"], f["effect"]).alias("now"), F.array_append(a["out"], a["now"]).alias("out")))
        return per.select(*by, walked.alias("w"), "fs")

    inner = storage.cut(composed(grouped, ["file", "g"], "range"))
    outer = composed(inner.select("file", "g", F.col("w.now").alias("effect")), ["file"], "g")
    of_group = outer.select("file", F.explode(F.arrays_zip(F.col("fs.g").alias("g"), F.col("w.out").alias("first"))).alias("x")).select("file", "x.g", "x.first")
    each = inner.select("file", "g", F.explode(F.arrays_zip(F.col("fs.range").alias("range"), F.col("w.out").alias("own"))).alias("x")).select("file", "g", "x.range", "x.own")
    state = F.get(then(F.col("first"), F.col("own")), F.lit(OUTSIDE))
    return each.join(of_group, ["file", "g"]).select("file", "range", state["to"].alias("state"), state["depth"].alias("depth"))
