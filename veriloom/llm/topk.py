"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are dealt to ranges of length, the longest first, and written; a worker takes a range in buckets of BUCKET. The
longest SEEDS vectors give every query a score that its k-th best can't fall below, so a query only goes to the ranges
whose longest vector can reach it. It meets a range's rows there by the shuffle: the range's rows come first, the queries
pass by in batches. In a bucket the score so far is a cosine threshold for the query: above 1 the bucket is skipped; else
the bucket's rows are cut either by length (a prefix of the bucket) or by the feasible range of the query's largest
coordinate, whichever leaves fewer, and what remains is verified by exact integer products.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

K = 5
BUCKET = 2_048
SEEDS = 1_024
#: Rows of a range, about; a task holds one range.
RANGE = 16_384
#: Queries that are searched together.
BATCH = 1_024
#: Products of longer vectors might pass 64 bits.
LONGEST = 2**31


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """uid, vec_id, v (array of floor(scale * x), long) and norm of the rows that take part.

    No part: null vectors, vectors with a null or non-finite component. Null ids take part; as equal scores go, they are the
    smallest. A vector (scaled) that is longer than LONGEST raises, since products must stay within 64 bits.
    """
    x = F.transform("embedding", lambda a: a.cast("double"))
    finite = F.forall("x", lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < F.lit(float("inf"))))
    rows = vectors.where(F.col("embedding").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(finite)
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, a: s + (scale * a) * (scale * a)))
    x = F.when(norm >= LONGEST, F.raise_error(F.lit("a vector is too long for exact products")).cast("array<double>")).otherwise(F.col("x"))
    v = F.transform(x, lambda a: F.floor(scale * a).cast("long"))
    rows = rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", v.alias("v"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, a: s + a.cast("double") * a.cast("double"))))


def _matrix(arrow_column, width: int):
    import numpy as np

    lists = arrow_column.combine_chunks() if hasattr(arrow_column, "combine_chunks") else arrow_column
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(sizes.max(initial=0)))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width).astype(np.int64)
    out = np.zeros((len(sizes), width), dtype=np.int64)  # a shorter vector lacks its last components: zeros
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


#: Stands for a null id inside a task; smaller than any that Spark's long holds but one.
NO_ID = -(2**63)


def _ids(column):
    """Ids as longs."""
    return column.fill_null(NO_ID).to_numpy()


def _product(q, c):
    """Exact products of integer rows: by floats where no sum can pass 2 ** 53."""
    import numpy as np

    width = min(q.shape[1], c.shape[1])
    q, c = q[:, :width], c[:, :width]
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), dtype=np.int64)
    most = float(np.abs(q).max()) * float(np.abs(c).max()) * width
    return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64) if most < 2**53 else q @ c.T


class _Best:
    """The k best (score, vec_id) of each query so far; floor: below it nothing can be among them."""

    def __init__(self, n: int, k: int, floor):
        self.k, self.floor, self.rows = k, floor.copy(), [None] * n

    def add(self, i: int, scores, ids) -> None:
        import numpy as np

        good = scores >= self.floor[i]
        if not good.any():
            return
        scores, ids = scores[good], ids[good]
        if self.rows[i] is not None:
            scores, ids = np.concatenate([self.rows[i][0], scores]), np.concatenate([self.rows[i][1], ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.rows[i] = scores[order], ids[order]
        if len(order) == self.k:
            self.floor[i] = max(self.floor[i], self.rows[i][0][-1])


def _search_bucket(best: _Best, q, q_uid, q_norm, v, uid, vec_id, norm) -> None:
    """One bucket, longest rows first."""
    import numpy as np

    n, longest = len(v), norm[0]
    dense: list[int] = []
    by_coordinate: dict[int, tuple] = {}
    with np.errstate(divide="ignore", invalid="ignore"):
        unit_q = np.nan_to_num(q / q_norm[:, None])
        unit_v = np.nan_to_num(v / norm[:, None])
    floor = best.floor.astype(np.float64)
    floor[best.floor == np.iinfo(np.int64).min] = -np.inf
    for i in range(len(q)):
        need = floor[i]
        rows = None
        if need > 0:
            if need > q_norm[i] * longest * (1 + 1e-9):
                continue  # the cosine would have to pass 1
            t = min(1.0, need / (q_norm[i] * longest)) * (1 - 1e-9)
            prefix = int(np.searchsorted(-norm, -need / q_norm[i] * (1 - 1e-9), side="right"))
            f = int(np.abs(unit_q[i]).argmax())
            if f not in by_coordinate:
                order = np.argsort(unit_v[:, f], kind="stable")
                by_coordinate[f] = order, unit_v[order, f]
            order, values = by_coordinate[f]
            c = unit_q[i, f]
            spread = np.sqrt(max(0.0, (1 - t * t) * (1 - c * c)))
            lo = -1.0 if -c >= t else c * t - spread
            hi = 1.0 if c >= t else c * t + spread
            a, b = np.searchsorted(values, lo - 1e-9, side="left"), np.searchsorted(values, hi + 1e-9, side="right")
            if min(prefix, b - a) * 3 < n:
                rows = np.arange(prefix) if prefix <= b - a else order[a:b]
        if rows is None:
            dense.append(i)
            continue
        rows = rows[uid[rows] != q_uid[i]]
        best.add(i, _product(q[i : i + 1], v[rows])[0], vec_id[rows])
    for lo in range(0, len(dense), 256):
        part = dense[lo : lo + 256]
        for i, scores in zip(part, _product(q[part], v)):
            other = uid != q_uid[i]
            best.add(i, scores[other], vec_id[other])


def _floors(queries: DataFrame, longest, spans: list[float], k: int) -> DataFrame:
    """uid, vec_id, v, norm, floor (a score that the k-th best can't be below; the least long: none) and ranges (how many may matter)."""
    import numpy as np

    s, s_uid = _matrix(longest.column("v"), 0), longest.column("uid").to_numpy()
    sent = queries.sparkSession.sparkContext.broadcast((s, s_uid, np.array(spans)))  # SEEDS vectors, a number for each range

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        s, s_uid, spans = sent.value
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                q, uid, norm = _matrix(part.column(2), s.shape[1]), part.column(0).to_numpy(), part.column(3).to_numpy()
                scores = _product(q, s)
                scores[uid[:, None] == s_uid[None, :]] = np.iinfo(np.int64).min
                floor = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(q), np.iinfo(np.int64).min)
                reach = np.where(floor > 0, np.searchsorted(-spans, -floor / np.maximum(norm, 1e-300) * (1 - 1e-9), side="right"), len(spans))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(floor), pa.array(reach.astype("i4"))], ["uid", "vec_id", "v", "norm", "floor", "ranges"])

    return queries.mapInArrow(run, "uid long, vec_id long, v array<long>, norm double, floor long, ranges int")


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = 256, bucket: int = BUCKET, seeds: int = SEEDS, rows_each: int = RANGE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of highest integer product for each row that is_query marks.

    Candidates are all rows but the query's own; ties go to the smaller vec_id; fewer than k candidates: all. Repeated ids
    are rows of their own, as queries and as candidates. A vector that is shorter than another lacks its last components:
    they count as zero. Zero vectors score 0. Rows that quantised() leaves out take no part. Empty: no rows.
    """
    rows = cut(quantised(vectors, scale))
    n = max(1, -(-rows.count() // rows_each))
    ranged = cut(rows.repartitionByRange(n, F.desc("norm"), "uid").withColumn("range", F.spark_partition_id()))
    stats = ranged.groupBy("range").agg(F.max("norm").alias("longest"), F.count("*").alias("n")).orderBy("range").collect()  # a row for each range
    spans = [0.0] * (stats[-1]["range"] + 1 if stats else 0)
    held = first = 0
    for r in stats:
        spans[r["range"]] = r["longest"]
        first, held = (r["range"], held + r["n"]) if held < seeds else (first, held)
    for k_ in range(len(spans) - 2, -1, -1):  # an empty range reads as the one after it
        spans[k_] = max(spans[k_], spans[k_ + 1])
    longest = ranged.where(F.col("range") <= first).orderBy(F.desc("norm"), "uid").limit(seeds).select("uid", "v").toArrow()
    sent = _floors(rows.where(is_query), longest, spans, k).where("ranges > 0").withColumn("range", F.explode(F.sequence(F.lit(0), F.col("ranges") - 1)))
    both = ranged.select("range", F.lit(0).alias("kind"), "norm", "uid", "vec_id", "v", F.lit(0).cast("long").alias("floor"))
    both = both.union(sent.select("range", F.lit(1), "norm", "uid", "vec_id", "v", "floor"))
    both = both.repartition("range").sortWithinPartitions("range", "kind", F.desc("norm"))

    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        at, held, ready = None, [], None

        def found(part):
            """The k best of the held range for a batch of queries."""
            nonlocal ready
            if ready is None:
                t = pa.Table.from_batches(held)
                ready = _matrix(t.column("v"), 0), t.column("uid").to_numpy(), _ids(t.column("vec_id")), t.column("norm").to_numpy()
            v, uid, vec_id, norm = ready
            q, q_uid, floor = _matrix(part.column("v"), v.shape[1]), part.column("uid").to_numpy(), part.column("floor").to_numpy()
            if q.shape[1] > v.shape[1]:
                v = np.pad(v, ((0, 0), (0, q.shape[1] - v.shape[1])))
            best = _Best(len(q), k, floor)
            for lo in range(0, len(v), bucket):
                hi = lo + bucket
                _search_bucket(best, q, q_uid, part.column("norm").to_numpy(), v[lo:hi], uid[lo:hi], vec_id[lo:hi], norm[lo:hi])
            hits = [(i, x) for i, x in enumerate(best.rows) if x is not None]
            sizes = [len(x[0]) for _, x in hits]
            pick = np.repeat(np.array([i for i, _ in hits], dtype=np.int64), sizes)
            score, ids = (np.concatenate([x[j] for _, x in hits] or [np.array([], dtype=np.int64)]) for j in (0, 1))
            query_id = part.column("vec_id").take(pa.array(pick))
            return pa.RecordBatch.from_arrays([pa.array(q_uid[pick]), query_id, pa.array(ids, pa.int64(), mask=ids == NO_ID), pa.array(score.astype(np.int64))], ["query", "query_id", "vec_id", "score"])

        for batch in batches:
            while batch.num_rows:
                ranges, kinds = batch.column("range").to_numpy(), batch.column("kind").to_numpy()
                if ranges[0] != at:
                    at, held, ready = ranges[0], [], None
                same = (ranges == at) & (kinds == kinds[0])
                size = len(same) if same.all() else int(same.argmin())
                part, batch = batch.slice(0, size), batch.slice(size)
                if kinds[0] == 0:
                    held.append(part)
                elif held:  # else an empty range
                    for lo in range(0, part.num_rows, BATCH):
                        yield found(part.slice(lo, BATCH))

    hits = both.mapInArrow(search, "query long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_first())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
