"""Harmonic packing: sequences of at most capacity tokens with little padding.

A document's ids are cut into full sequences, then into pieces of exactly capacity / 2, / 4, ... down to SMALLEST, and one
rest below that. A piece belongs to the reciprocal-capacity class j, the largest j of the classes with j * length <=
capacity, and a bin of class j holds j pieces. Workers number their pieces by class on their own; a table with one row for
each worker and class shifts the numbers, and then each piece knows its bin. Exact classes fill their bins; only rests
(under SMALLEST tokens a document) leave padding. The last, unfinished bin of each class, a bounded number of pieces in all,
is laid end to end and cut anew.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import cut, lookup

CAPACITY = 2048
SMALLEST = 128
END = 1


def classes(capacity: int, smallest: int) -> tuple[list[int], list[int]]:
    """Documents in a bin: of the exact classes (powers of two, to capacity / smallest) and of the rests' (steps of about an eighth, the last capacity)."""
    exact = [2**k for k in range(capacity.bit_length()) if capacity % 2**k == 0 and capacity // 2**k >= smallest]
    rests = [exact[-1]]
    while rests[-1] < capacity:
        rests.append(min(capacity, max(rests[-1] + 1, rests[-1] * 9 // 8)))
    return exact, rests


def pieces(docs: DataFrame, tokenizer: str, capacity: int, smallest: int, end: int) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, and part, cls, rank: the worker's partition, the class, the number there."""
    exact, rests = classes(capacity, smallest)

    def cut_all(batches: Iterator) -> Iterator:
        from bisect import bisect_right

        import pyarrow as pa
        from pyspark import TaskContext

        enc, part, counts = tokens.encoder(tokenizer), TaskContext.get().partitionId(), [0] * (len(exact) + len(rests))
        of_length = {n: len(exact) + bisect_right(rests, capacity // n) - 1 for n in range(1, capacity // exact[-1])}
        of_length |= {capacity // j: k for k, j in enumerate(exact)}
        tail = end.to_bytes(4, "little")
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "part", "cls", "rank"]
        for batch in batches:
            coded = enc.stream(batch.column(1))
            for lo in range(0, batch.num_rows, 200):
                cols: list[list] = [[] for _ in names]
                for doc_id, ids in zip(batch.column(0).slice(lo, 200).to_pylist(), coded):
                    ids += tail
                    n, at = len(ids) // 4, 0
                    while at < n:
                        size = next((capacity // j for j in exact if capacity // j <= n - at), n - at)
                        c = of_length[size]
                        for col, x in zip(cols, (doc_id, at, size, ids[4 * at : 4 * (at + size)], n, part, c, counts[c])):
                            col.append(x)
                        counts[c] += 1
                        at += size
                types = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, part long, cls int, rank long"
    return docs.select("doc_id", "text").mapInArrow(cut_all, schema)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, smallest: int = SMALLEST, end: int = END) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset: one row for each piece.

    Each id of each document, with the end id after its text, lies in one piece; a sequence is gapless from offset 0 and
    sequence ids from 0. Null or empty text: the end id alone. Null and repeated doc_ids are packed row by row. Other
    columns are left out. Empty: no rows.
    """
    exact, rests = classes(capacity, smallest)
    made = cut(pieces(docs, tokenizer or tokens.default_path(), capacity, smallest, end))
    per = cut(made.groupBy("cls", "part").agg(F.count("*").alias("n")))
    per_cls = per.groupBy("cls").agg(F.sum("n").alias("n")).withColumn("per_bin", F.element_at(F.array(*map(F.lit, exact + rests)), F.col("cls") + 1))
    per_cls = per_cls.withColumn("bins", F.floor(F.col("n") / F.col("per_bin")))
    earlier = Window.orderBy("cls").rowsBetween(Window.unboundedPreceding, -1)  # a row for each class
    per_cls = per_cls.withColumn("first_bin", F.coalesce(F.sum("bins").over(earlier), F.lit(0))).withColumn("all_bins", F.sum("bins").over(Window.partitionBy()))
    shift = F.coalesce(F.sum("n").over(Window.partitionBy("cls").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    key = (F.col("cls").cast("long") * F.lit(2**40) + F.col("part")).alias("key")
    places = per.select("cls", key, shift.alias("shift")).join(F.broadcast(per_cls.drop("n")), "cls").drop("cls")

    placed = lookup(made.withColumn("key", key), cut(places), "key")
    placed = placed.withColumn("number", F.col("shift") + F.col("rank")).withColumn("bin", F.floor(F.col("number") / F.col("per_bin")))
    out = ["doc_id", "start", "length", "ids", "doc_tokens"]
    full = placed.where("bin < bins").withColumn("sequence_id", F.col("first_bin") + F.col("bin"))
    even = full.where(F.col("cls") < len(exact)).select(*out, "sequence_id", ((F.col("number") % F.col("per_bin")) * F.col("length")).alias("offset"))
    in_bin = Window.partitionBy("sequence_id").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)  # a bin's pieces
    rest = full.where(F.col("cls") >= len(exact)).select(*out, "sequence_id", F.coalesce(F.sum("length").over(in_bin), F.lit(0)).alias("offset"))

    # Under one bin of each class: a fixed number of pieces at most.
    end_to_end = Window.orderBy("cls", "number").rowsBetween(Window.unboundedPreceding, -1)
    last = placed.where("bin >= bins").withColumn("at", F.coalesce(F.sum("length").over(end_to_end), F.lit(0)))
    last = last.withColumn("k", F.explode(F.sequence(F.floor(F.col("at") / capacity), F.floor((F.col("at") + F.col("length") - 1) / capacity))))
    lo = F.greatest(F.col("at"), F.col("k") * capacity)
    hi = F.least(F.col("at") + F.col("length"), (F.col("k") + 1) * capacity)
    last = last.withColumn("lo", lo).withColumn("hi", hi)
    skip, n = F.col("lo") - F.col("at"), F.col("hi") - F.col("lo")
    ids = F.substring("ids", (4 * skip + 1).cast("int"), (4 * n).cast("int"))
    last = last.select("doc_id", (F.col("start") + skip).alias("start"), n.alias("length"), ids.alias("ids"), "doc_tokens", (F.col("all_bins") + F.col("k")).alias("sequence_id"), (F.col("lo") - F.col("k") * capacity).alias("offset"))
    return even.unionByName(rest).unionByName(last)
