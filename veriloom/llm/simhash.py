"""SimHash near-dedup with BK-trees.

Texts become 64-bit fingerprints; equal ones are one node. Fingerprints within RADIUS bits agree in whole blocks: of five
blocks, two at least. So a fingerprint goes to ten shards, one for each pair of blocks with its bits there, and every link
lies within a shard. A shard's BK-tree has its children keyed by the integer Hamming distance to the parent, and a search
follows only the edges within the radius. A shard of over SHARD_NODES fingerprints is dealt again by blocks of its
remaining bits; one of over BLOCK_NODES even then is cut into blocks, and each pair of blocks is a tree of its own. A tree is
given to the shard's own queries by the shuffle, since a broadcast of all trees would grow with the corpus. What leaves a
shard is a spanning set of its links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, split_join
from .components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
SHARD_NODES = 5_000
#: Two blocks of so many fingerprints are the most that one tree holds.
BLOCK_NODES = 250_000


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a UTF-8 text, A-Z lower-cased; no words: 0."""
    import numpy as np
    from itertools import repeat
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # of bytes: A-Z and the six blanks only
    if not words:
        return 0
    if len(words) < shingle:
        grams, n = iter([b" ".join(words)]), 1
    else:
        grams, n = map(b" ".join, zip(*(words[k:] for k in range(shingle)))), len(words) - shingle + 1
    hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(seed)), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, 65_536):
        ones += np.unpackbits(hashes[lo : lo + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) for each row; null text: as an empty one."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            fps = [fingerprint(x.as_py() or b"", shingle, seed) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, dtype="<u8").view("<i8"))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def blocks(bits: list[int], n: int) -> list[int]:
    """Masks of n blocks of the given bits."""
    return [sum(1 << b for b in bits[len(bits) * k // n : len(bits) * (k + 1) // n]) for k in range(n)]


def _finer(mask: int, n: int) -> list[int]:
    """The mask and one of n blocks of the bits that it leaves free."""
    return [mask | m for m in blocks([b for b in range(64) if not mask >> b & 1], n)]


def bk_spanning_links(fps, starts, radius: int, first_chunk: int = 256, chunk: int = 32_768):
    """(a, b): indices of links that span each shard's classes, in a chunk of queries those of fewer differing bits first.

    One BK-tree for each shard, children keyed by the distance to the parent; a query follows the edges within radius of
    its own distance. Between chunks of queries, subtrees that have grown into one class are marked: a query of that class
    need not enter them, so that a dense group of copies costs little more than its size.
    """
    import numpy as np

    n = len(fps)
    apart = lambda a, b: np.bitwise_count(fps[a] ^ fps[b]).astype(np.int64)
    top = np.repeat(starts, np.diff(np.append(starts, n)))
    parent, edge = np.full(n, -1), np.zeros(n, dtype=np.int64)
    open_ = np.setdiff1d(np.arange(n), starts, assume_unique=True)
    at, levels = top[open_], []
    while len(open_):
        key = at * 65 + apart(open_, at)
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        child = open_[first]
        levels.append(child)
        parent[child], edge[child] = at[first], key[first] % 65
        deeper = np.ones(len(open_), dtype=bool)
        deeper[first] = False
        at, open_ = child[which][deeper], open_[deeper]
    keys = np.where(parent >= 0, parent * 65 + edge, -1)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    barren = np.searchsorted(keys, np.arange(n) * 65) == np.searchsorted(keys, np.arange(n) * 65 + 65)  # nodes without children
    root = np.arange(n)

    def find(x):
        while True:
            up = root[x]
            if np.array_equal(up, root[up]):
                return up
            root[x] = root[up]

    out_a, out_b = [], []

    def union(a, b, d):
        by = np.argsort(d, kind="stable")
        a, b = a[by], b[by]
        while len(a):
            ra, rb = find(a), find(b)
            far = ra != rb
            a, b, ra, rb = a[far], b[far], ra[far], rb[far]
            if not len(a):
                return
            _, first = np.unique(np.maximum(ra, rb), return_index=True)  # the nearest link of each root
            root[np.maximum(ra, rb)[first]] = np.minimum(ra, rb)[first]
            out_a.append(a[first])
            out_b.append(b[first])

    lo, size = 0, first_chunk
    while lo < n:
        of = find(np.arange(n))
        least, most = of.copy(), of.copy()
        for child in reversed(levels):
            np.minimum.at(least, parent[child], least[child])
            np.maximum.at(most, parent[child], most[child])
        one = np.where(least == most, least, -1)  # the class of a whole subtree
        query = np.arange(lo, min(n, lo + size))
        lo, size = lo + size, min(2 * size, chunk)
        node = top[query]
        new = one[node] != of[query]
        query, node = query[new], node[new]
        while len(query):
            d = apart(query, node)
            near = (d <= radius) & (query != node)
            union(query[near], node[near], d[near])
            inner = ~barren[node]
            query, node, d = query[inner], node[inner], d[inner]
            low = np.searchsorted(keys, node * 65 + np.maximum(1, d - radius), side="left")
            many = np.searchsorted(keys, node * 65 + np.minimum(64, d + radius), side="right") - low
            query = np.repeat(query, many)
            node = order[np.repeat(low - np.cumsum(many) + many, many) + np.arange(len(query))]
            new = one[node] != of[query]
            query, node = query[new], node[new]
    empty = np.array([], dtype=np.int64)
    return np.concatenate([empty, *out_a]), np.concatenate([empty, *out_b])


def _shard_links(rows: DataFrame, radius: int) -> DataFrame:
    """Spanning links (family, a, b) of shards (family, mask, bits, block), each within one partition and in order there."""
    shard = ["family", "mask", "bits", "block"]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def links(t):
            fps = t.column("fp").to_numpy().view(np.uint64)
            new = np.ones(len(fps), dtype=bool)
            new[1:] = False
            for c in shard:
                v = t.column(c).to_numpy()
                new[1:] |= v[1:] != v[:-1]
            a, b = bk_spanning_links(fps, np.flatnonzero(new), radius)
            family = t.column("family").to_numpy()
            return pa.RecordBatch.from_arrays([pa.array(family[a]), pa.array(fps[a].view(np.int64)), pa.array(fps[b].view(np.int64))], ["family", "a", "b"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now]).combine_chunks()
            last = np.ones(held.num_rows, dtype=bool)  # the last shard may go on in the next batch
            for c in shard:
                v = held.column(c).to_numpy()
                last &= v == v[-1]
            whole = 0 if last.all() else held.num_rows - int(last[::-1].argmin())
            if whole:
                yield links(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield links(held)

    return rows.select(*shard, "fp").repartition(*shard).sortWithinPartitions(*shard).mapInArrow(run, "family int, a long, b long")


def _with_sizes(dealt: DataFrame, most: int) -> DataFrame:
    """dealt and size, the fingerprints of its shard where these are over most, else null."""
    shard = ["family", "mask", "bits"]
    return split_join(dealt, cut(dealt.groupBy(*shard).agg(F.count("*").alias("size")).where(F.col("size") > most)), shard, "size", how="left")


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, shard_nodes: int = SHARD_NODES, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """Links (family, a, b) that span the classes of distinct (family, fp) at radius or fewer differing bits.

    Of radius + 2 blocks of bits two agree at least: a shard is a pair of blocks with its bits there. A shard of over
    shard_nodes fingerprints is dealt again by radius + 1 blocks of its free bits, of which one agrees at least: unrelated
    fingerprints part there, and those that stay together are near copies, which one tree takes cheaply. If these are over
    block_nodes, blocks of them by a hash meet pair by pair.
    """
    masks = sorted({a | b for a, b in combinations(blocks(list(range(64)), radius + 2), 2)})
    rows = distinct.select("family", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"), "fp")
    dealt = _with_sizes(rows.withColumn("bits", F.col("fp").bitwiseAND(F.col("mask"))), shard_nodes)
    found = cut(_shard_links(dealt.where("size IS NULL").withColumn("block", F.lit(0).cast("long")), radius))
    hot = cut(dealt.where("size IS NOT NULL").select("family", "mask", "fp"))
    if hot.isEmpty():
        return found
    finer = [(_signed(m), _signed(x)) for m in masks for x in _finer(m, radius + 1)]
    table = F.broadcast(distinct.sparkSession.createDataFrame(finer, "mask long, finer long"))  # radius + 1 rows for each mask
    again = hot.join(table, "mask").select("family", F.col("finer").alias("mask"), "fp").distinct().withColumn("bits", F.col("fp").bitwiseAND(F.col("mask")))
    sized = _with_sizes(cut(again), block_nodes)
    n = F.coalesce(F.ceil(F.col("size") / block_nodes), F.lit(1))
    own = sized.withColumn("n", n).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("n")))
    paired = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    block = F.when(F.col("n") > 1, F.least("own", "other") * F.col("n") + F.greatest("own", "other")).otherwise(F.lit(0).cast("long"))
    return found.union(cut(_shard_links(paired.withColumn("block", block), radius)))


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """doc_id, fp, fingerprint (16 hex digits), component_id (the smallest doc_id reachable over links), a row for each row.

    Null, empty and blank texts have fingerprint zero and link like any other. Null ids take part, but a component's id is
    null only if all its ids are. Repeated ids are rows of their own, of one component if their texts link. Other columns
    are left out. Empty: no rows.
    """
    prints = cut(fingerprints(docs, shingle, seed))
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    of = components(fingerprint_links(nodes.select(F.lit(0).alias("family"), "fp"), radius, shard_nodes).select("a", "b")).withColumnRenamed("node", "fp")
    joined = nodes.join(of, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    ids = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    names = cut(joined.join(ids, "component").select("fp", "component", "component_id"))
    out = prints.join(names, "fp")
    return out.select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component", "component_id")
