"""Bounded samples of labelled texts, models that a task learns from them, and thresholds from held-back rows."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of text of each class after which a sample ends, in the order of its hash: a bound on what one task holds.
SAMPLE_BYTES = 32_000_000
#: Bytes of a model that come back in one row.
CHUNK = 4_000_000


def held_out(mod: int, rest: int):
    """Whether crc32 of the id as text leaves rest by mod; a null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(mod)) == rest, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, rest: int, rows: tuple[int, int], bytes_most: int = SAMPLE_BYTES) -> DataFrame:
    """_id, _y, text, lang of rows[c] labelled documents at most of each class c, the first by a hash of the id, none held out.

    A class's sample also ends once its texts hold bytes_most bytes; texts are whole, of any length, and none is passed
    over for its size. Labels without a document, with a null id or null label don't count; of several labels of an id the
    largest does, and of several rows of an id the smallest text.
    """
    of = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(mod, rest)).groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("_y"))
    of = of.join(docs.select("doc_id"), "doc_id", "left_semi").withColumn("_order", F.xxhash64("doc_id", F.lit(label)))
    ids = None
    for c, n in enumerate(rows):
        some = of.where(F.col("_y") == c).orderBy("_order", "doc_id").limit(n)
        ids = some if ids is None else ids.union(some)
    ids = F.broadcast(ids.withColumnRenamed("doc_id", "_id"))  # sum(rows) rows at most
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    joined = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), lang.alias("lang")).join(ids, F.col("doc_id") == F.col("_id"))
    one = joined.groupBy("_id", "_y", "_order").agg(F.min(F.struct("text", "lang")).alias("t"))
    before = Window.partitionBy("_y").orderBy("_order", "_id").rowsBetween(Window.unboundedPreceding, -1)  # rows[c] rows
    one = one.withColumn("_before", F.coalesce(F.sum(F.octet_length("t.text")).over(before), F.lit(0)))
    return one.where(F.col("_before") < bytes_most).select("_id", "_y", "t.text", "t.lang")


def learnt(rows: DataFrame, fit: Callable[[Iterator], object]):
    """fit's model of a sample, learnt in one task: fit gets (text, label, lang) one by one in the order of ids. The driver gets the model only."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def one_by_one():
            for batch in batches:
                for text, y, lang in zip(batch.column(1), batch.column(2), batch.column(3)):
                    yield text.as_py(), y.as_py(), lang.as_py()

        data = pickle.dumps(fit(one_by_one()), protocol=5)
        for k, lo in enumerate(range(0, len(data), CHUNK)):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([data[lo : lo + CHUNK]], pa.binary())], ["k", "part"])

    sorted_ = rows.select("_id", "text", "_y", "lang").repartition(1).sortWithinPartitions("_id")  # bounded by the sample's rows and bytes
    parts = sorted_.mapInArrow(run, "k int, part binary").collect()
    return pickle.loads(b"".join(bytes(r["part"]) for r in sorted(parts, key=lambda r: r["k"]))) if parts else fit(iter(()))


def threshold(logits, y) -> float:
    """The cut of best F1 of the rarer class; of equal ones, the middle of the widest gap."""
    import numpy as np

    logits, y = np.asarray(logits, dtype=float), np.asarray(y)
    if not len(y) or y.min() == y.max():
        return 0.0
    order = np.argsort(logits)
    s, t = logits[order], y[order]
    rare = int(2 * t.sum() <= len(t))
    below = np.concatenate([[0], np.cumsum(t == rare)])  # of the rare class, below each cut
    n_below = np.arange(len(t) + 1)
    hit, taken = (below[-1] - below, len(t) - n_below) if rare else (below, n_below)
    f1 = 2 * hit / np.maximum(1, taken + below[-1])
    lo, hi = np.concatenate([[s[0] - 2], s]), np.concatenate([s, [s[-1] + 2]])
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    k = best[np.argmax((hi - lo)[best])]
    return float((lo[k] + hi[k]) / 2)
