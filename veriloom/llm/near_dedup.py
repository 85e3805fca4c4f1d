"""Near-copy removal: SimHash with BK-trees joins the easy groups, a prefix filter finds every other pair, word shingles decide.

Texts whose Jaccard similarity of the sets of five-word shingles reaches SIMILARITY link; one text of each connected group
stays. Candidates come in two steps, and only a pair that passed the exact comparison ever counts as joined:

1. Each text gets FAMILIES fingerprints over two-word shingles, from hashes that differ by a mixing step. A spanning set of
   the pairs within RADIUS bits, the nearest first, is compared. This makes dense groups one class at a linear cost, and
   loses pairs (contiguous edits near the threshold most).
2. The prefix filter loses none: under one order of all shingles, two sets of that similarity share one of the first
   n - ceil(SIMILARITY n) + 1 shingles of each. The order is by the number of texts that hold a shingle, counted over all
   texts, so the first ones are those of one class alone, which can't join it with another: most texts have enough of them
   and meet nobody, also where they share passages with many others. Texts of different classes that share so many of
   their first shingles that they may be similar are compared: first STARS times with one text of each shingle's list, then
   every such pair that is still apart. Lists of more than HOT_LIST texts (a template whose texts are nearly similar) make no
   pairs of rows: blocks of their shingle sets meet, and a task counts the common shingles of two blocks at once. Long texts take part with those shingles only whose hash is below a share of all
   (LEVELS); of these, too, at most n - ceil(SIMILARITY n) can be missing from a similar text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SMALL_ROWS, cut, lookup, split_join
from .components import components
from .simhash import SEED, SHARD_NODES, fingerprint_links

FAMILIES = 3
PRINT_SHINGLE = 2
RADIUS = 5
SHINGLE = 5
SIMILARITY = 0.8
STARS = 2
#: Texts from which the most common shingles are learnt, and how many of these at most: they come last in the order without
#: being counted, which changes no result and keeps their many rows off one task.
SAMPLE = 4_000
OFTEN = 20
COMMON = 100_000
#: Lists of so many texts at most are paired up row by row.
HOT_LIST = 64
#: Of a longer one, texts of a block at most, and their shingles (one text may have more).
BLOCK_TEXTS, BLOCK_SHINGLES = 256, 400_000
#: The number of texts that stands for so many or more.
MANY = 100_000
#: From so many shingles on, the share of hashes that a text takes part with. A share must hold over 1 - SIMILARITY of a text's
#: shingles: by chance it does not for fewer than one in 10 ** 8 texts, which may then miss a partner. Texts of up to 1 /
#: SIMILARITY times the next level's first size take part at both, so that every similar pair has a level in common.
LEVELS = ((0, 1.0), (100, 0.5), (400, 0.35))


def family_prints(text: bytes, families: int = FAMILIES, shingle: int = PRINT_SHINGLE, seed: int = SEED) -> list[int]:
    """The text's fingerprints, A-Z lower-cased; no words: zeros."""
    import numpy as np
    from itertools import repeat
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return [0] * families
    n = max(1, len(words) - shingle + 1)
    grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)))) if len(words) >= shingle else iter([b" ".join(words)])
    hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(seed)), dtype="<u8", count=n)
    out = []
    for f in range(families):
        ones = np.zeros(64, dtype=np.int64)
        for lo in range(0, n, 65_536):
            h = hashes[lo : lo + 65_536].copy()
            if f:  # other bits of the same shingle
                h += np.uint64((0x9E3779B97F4A7C15 * f) % 2**64)
                h ^= h >> np.uint64(30)
                h *= np.uint64(0xBF58476D1CE4E5B9)
                h ^= h >> np.uint64(27)
                h *= np.uint64(0x94D049BB133111EB)
                h ^= h >> np.uint64(31)
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little"))
    return out


def shingle_set(text: str | None, shingle: int = SHINGLE) -> frozenset:
    """Hashes of the text's word shingles, A-Z lower-cased; fewer words: the whole sequence; none: empty."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < shingle:
        return frozenset([xxh64_intdigest(b" ".join(words))] if words else [])
    return frozenset(map(xxh64_intdigest, map(b" ".join, zip(*(words[k:] for k in range(shingle))))))


def similar_pairs(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) of nodes whose texts (node, text) have so similar shingle sets; two texts without words do."""
    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kept: dict[int, frozenset] = {}

        def of(node, text):
            s = kept.get(node)
            if s is None:
                s = shingle_set(text, shingle)
                if len(s) <= 50_000:
                    if len(kept) >= 64:
                        kept.pop(next(iter(kept)))
                    kept[node] = s
            return s

        for batch in batches:
            yes = []
            for a, b, ta, tb in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                x, y = of(a, ta.as_py()), of(b, tb.as_py())
                common = len(x & y)
                yes.append(common >= similarity * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(yes, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def first_shingles(n, similarity: float = SIMILARITY):
    """How many first shingles of a set of n (a column) share one with those of any set of the similarity."""
    return n - F.ceil(similarity * n - 1e-9) + 1


def _common_shingles(texts: DataFrame, n: int) -> list[int]:
    """Shingles that OFTEN or more of a sample's texts hold, COMMON at most; n: about how many texts there are."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for t in batch.column(0):
                s = shingle_set(t.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(np.fromiter(s, dtype="<u8", count=len(s)).view("<i8"))], ["shingle"])

    sample = texts.where(F.pmod("node", F.lit(max(1, n // SAMPLE))) == 0).select("text").mapInArrow(run, "shingle long")
    often = sample.groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "shingle").limit(COMMON)
    return [r.shingle for r in often.collect()]


def shared_shingles(texts: DataFrame, common: list[int], similarity: float = SIMILARITY) -> DataFrame:
    """shingle, level, node, n (the node's shingles), own (those at this level), df (nodes that hold the shingle there, MANY at most).

    Of texts (node, class, text) those shingles that several classes hold, and all common ones.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        last = np.sort(np.array(common, dtype=np.int64))
        ends = [*[lo / similarity for lo, _ in LEVELS[1:]], float("inf")]
        names = ["shingle", "salt", "node", "class", "n", "own"]
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows: list[tuple] = []
                for node, of, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2)):
                    own = shingle_set(text.as_py()) or {0}  # no words: one shingle, the same for all
                    h = np.fromiter(own, dtype="<u8", count=len(own))
                    for level, ((first, share), end) in enumerate(zip(LEVELS, ends)):
                        if first <= len(h) < end:
                            some = h if share == 1 else h[h < np.uint64(share * 2**64)]
                            rows.append((some.view("<i8"), level, node, node ^ of, len(h), len(some)))  # class: mostly 0, packs well
                sizes = [len(r[0]) for r in rows]
                made = np.concatenate([r[0] for r in rows]) if rows else np.array([], dtype=np.int64)
                level, node, of, n, own = (np.repeat(np.array([r[k] for r in rows], dtype=t), sizes) for k, t in ((1, np.int32), (2, np.int64), (3, np.int64), (4, np.int32), (5, np.int32)))
                is_last = last[np.minimum(np.searchsorted(last, made), len(last) - 1)] == made if len(last) else np.zeros(len(made), dtype=bool)
                salt = np.where(is_last, len(LEVELS) * (node % 1024 + 1), 0).astype(np.int32) + level  # common ones are spread by text
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (made, salt, node, of, n, own)], names)

    def several(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def lists(t, whole):
            """The rows of the lists that go on, repeated ones once; whole: the last list ends here."""
            shingle, salt, node = (t.column(c).to_numpy() for c in ("shingle", "salt", "node"))
            once = np.ones(len(shingle), dtype=bool)
            once[1:] = (shingle[1:] != shingle[:-1]) | (salt[1:] != salt[:-1]) | (node[1:] != node[:-1])
            if not once.all():
                t = t.filter(pa.array(once))
                shingle, salt = shingle[once], salt[once]
            of = t.column("class").to_numpy() ^ t.column("node").to_numpy()
            new = np.ones(len(shingle), dtype=bool)
            new[1:] = (shingle[1:] != shingle[:-1]) | (salt[1:] != salt[:-1])
            at = np.flatnonzero(new)
            df = np.diff(np.append(at, len(shingle)))
            common = salt[at] >= len(LEVELS)
            many = (np.minimum.reduceat(of, at) != np.maximum.reduceat(of, at)) | common
            df = np.where(common, MANY, np.minimum(df, MANY))
            if not whole:
                many[-1], df[-1] = True, MANY
            keep = np.repeat(many, np.diff(np.append(at, len(shingle))))
            level, df = pa.array((salt % len(LEVELS)).astype(np.int32)), pa.array(np.repeat(df, np.diff(np.append(at, len(shingle)))).astype(np.int32))
            return pa.table([t.column("shingle"), level, t.column("node"), t.column("n"), t.column("own"), df], ["shingle", "level", "node", "n", "own", "df"]).filter(pa.array(keep)).combine_chunks().to_batches()

        held, long = None, None  # long: the list that went out as one of MANY rows already
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now]).combine_chunks()
            shingle, salt = held.column("shingle").to_numpy(), held.column("salt").to_numpy()
            if long is not None:
                on = (shingle == long[0]) & (salt == long[1])
                size = len(on) if on.all() else int(on.argmin())
                if size:
                    yield from lists(held.slice(0, size), False)
                    held = held.slice(size)
                if not held.num_rows:
                    held = None
                    continue
                long = None
                shingle, salt = shingle[size:], salt[size:]
            ends = (shingle != shingle[-1]) | (salt != salt[-1])
            whole = int(np.flatnonzero(ends)[-1]) + 1 if ends.any() else 0
            if whole:  # the last list may go on in the next batch
                yield from lists(held.slice(0, whole), True)
                held = held.slice(whole)
            if held.num_rows >= MANY:
                long = held.column("shingle")[0].as_py(), held.column("salt")[0].as_py()
                yield from lists(held, False)
                held = None
        if held is not None:
            yield from lists(held, True)

    rows = texts.select("node", "class", "text").mapInArrow(run, "shingle long, salt int, node long, class long, n int, own int")
    return rows.repartition("shingle", "salt").sortWithinPartitions("shingle", "salt", "node").mapInArrow(several, "shingle long, level int, node long, n int, own int, df int")


def prefixes(shared: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """shingle, node, n: of each node's first shingles at each of its levels those that it shares; all others come before them in the order."""
    most = first_shingles(F.col("n"), similarity) - F.col("own")  # less those that it shares with no other class
    enough = shared.groupBy("node", "level", "n", "own").agg(F.count("*").alias("all")).where(F.col("all") + most > 0).select("node", "level", "all")
    counted = shared.join(enough, ["node", "level"]).withColumn("k", F.row_number().over(Window.partitionBy("node", "level").orderBy("df", "shingle")))
    return counted.where(F.col("k") <= F.col("all") + most).select("shingle", "node", "n").distinct()


def _labelled(rows: DataFrame, of: DataFrame, column: str) -> DataFrame:
    """rows with label, the component of the node in the column; a node without links is its own."""
    found = lookup(rows, of.select(F.col("node").alias(column), F.col("component").alias("label")), column)
    return found.withColumn("label", F.coalesce("label", column))


def similar_links(docs: DataFrame, reps: DataFrame, links: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) of similar texts whose components are those of all similar pairs; links: some similar pairs. reps: node, doc_id of each text once."""

    def texts(of: DataFrame) -> DataFrame:
        """node, text of the nodes in reps' form, from the row that reps names; equal rows repeat."""
        owner = of.select(F.col("node").alias("_node"), F.col("doc_id").alias("_id"))
        noded = _noded(docs)
        return noded.join(owner, noded["doc_id"].eqNullSafe(owner["_id"]) & (noded["node"] == owner["_node"]), "left_semi").select("node", "text")

    def compared(pairs: DataFrame) -> DataFrame:
        used = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        return cut(similar_pairs(pairs, cut(texts(reps.join(used, "node")).dropDuplicates(["node"])), similarity))

    links = compared(links)
    of = cut(components(links))
    labelled = _labelled(texts(reps), of, "node").withColumnRenamed("label", "class")
    labelled = cut(labelled)  # each text once, however often it stands in docs
    lists = cut(prefixes(cut(shared_shingles(labelled, _common_shingles(labelled, reps.count()), similarity)), similarity))
    ends = ["a", "b", "n_a", "n_b"]
    for k in range(STARS):
        rows = cut(_labelled(lists, of, "node").select("shingle", "label", "node", "n"))
        hub = cut(rows.groupBy("shingle").agg(F.min_by(F.struct("label", "node", "n"), F.xxhash64("label", "node", F.lit(k))).alias("hub"), F.count("*").alias("size")).where("size > 1"))
        met = split_join(rows, hub, ["shingle"], "size").where("label <> hub.label").select(F.col("node").alias("a"), F.col("hub.node").alias("b"), F.col("n").alias("n_a"), F.col("hub.n").alias("n_b"))
        more = compared(cut(_possible(met.groupBy(*ends).agg(F.count("*").alias("met")), similarity)))
        if more.isEmpty():
            break
        links = links.union(more)
        of = cut(components(links))
    rows = cut(_labelled(lists, of, "node").select("shingle", "label", "node", "n"))
    per = cut(rows.groupBy("shingle", "label").agg(F.count("*").alias("size"), F.sum("n").alias("n_shingles")))
    most = F.max(F.struct("size", "n_shingles", "label")).alias("most")
    long = cut(per.groupBy("shingle").agg(F.sum("size").alias("size"), F.sum("n_shingles").alias("n_shingles"), most).where(F.col("size") > HOT_LIST))
    hot = cut(split_join(rows, long, ["shingle"], "size"))
    if not hot.isEmpty():
        links = links.union(cut(block_links(hot, labelled.select("node", "text"), similarity)))
        rows = rows.join(F.broadcast(long) if long.count() <= SMALL_ROWS else long, "shingle", "left_anti")
    left, right = (rows.select("shingle", F.col("label").alias(f"label_{x}"), F.col("node").alias(x), F.col("n").alias(f"n_{x}")) for x in "ab")
    # Pairs with a long list in common were compared there; those that are left over have all common shingles in short ones.
    met = left.join(right, "shingle").where("label_a < label_b").where(_sizes_fit(similarity)).groupBy(*ends).agg(F.count("*").alias("met"))
    return links.union(compared(cut(_possible(met, similarity))))


def block_links(hot: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) that span, block by block, the similar texts of different labels in each long list.

    hot: shingle, label, node, n, and of its list size, n_shingles and most (the same of its largest label, and that). A list is cut into
    blocks by a hash, those of the largest label apart, which needn't meet each other. Two blocks meet in one task's
    batch as sets of shingles; no texts and no pairs travel.
    """

    def sets(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            made = [np.sort(np.fromiter(s, dtype="<u8", count=len(s)).view("<i8")) for s in (shingle_set(t.as_py()) for t in batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.int64()))], ["node", "own"])

    def met(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def linked(rows):
            """Spanning links of two blocks' rows (block, label, node, own)."""
            block, label, node = (np.array([r[k] for r in rows], dtype=np.int64) for k in range(3))
            size = np.array([len(r[3]) for r in rows])
            first = block == block.min()
            of = np.repeat(np.arange(len(rows)), size)
            own = np.concatenate([np.asarray(r[3], dtype=np.int64) for r in rows])
            names, at = np.unique(own, return_inverse=True)
            sides = [np.flatnonzero(first), np.flatnonzero(~first)] if not first.all() else [np.arange(len(rows))] * 2
            place = [np.full(len(rows), -1), np.full(len(rows), -1)]
            for s, p in zip(sides, place):
                p[s] = np.arange(len(s))
            common = np.zeros((len(sides[0]), len(sides[1])), dtype=np.float32)
            held = np.bincount(at, minlength=len(names)) > 1  # what one text alone has is common to none
            order = np.argsort(at, kind="stable")
            order = order[held[at[order]]]
            for lo in range(0, len(names), 8_192):
                some = order[np.searchsorted(at[order], lo) : np.searchsorted(at[order], lo + 8_192)]
                if len(some):
                    width = min(8_192, len(names) - lo)
                    both = []
                    for s, p in zip(sides, place):
                        m = np.zeros((len(s), width), dtype=np.float32)
                        mine = some[p[of[some]] >= 0]
                        m[p[of[mine]], at[mine] - lo] = 1
                        both.append(m)
                    common += both[0] @ both[1].T
            a, b = sides
            yes = (common >= similarity * (size[a][:, None] + size[b][None, :] - common) - 1e-6) & (label[a][:, None] != label[b][None, :])
            up = {x: x for x in node.tolist()}

            def top(x):
                while up[x] != x:
                    up[x] = up[up[x]]
                    x = up[x]
                return x

            out = []
            for i, j in zip(*np.nonzero(yes)):
                x, y = int(node[a[i]]), int(node[b[j]])
                p, q = top(x), top(y)
                if p != q:
                    up[max(p, q)] = min(p, q)
                    out.append((min(x, y), max(x, y)))
            return out

        def made(rows):
            out = linked(rows) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(2)], ["a", "b"])

        now, held = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shingle", "meeting", "block", "label", "node")]
            for shingle, meeting, block, label, node, own in zip(*columns, batch.column("own")):
                if now != (shingle, meeting):
                    if held:
                        yield made(held)
                    now, held = (shingle, meeting), []
                held.append((block, label, node, own.values.to_numpy()))
        if held:
            yield made(held)

    used = hot.select("node").distinct()
    of = cut(texts.join(used, "node", "left_semi").dropDuplicates(["node"]).mapInArrow(sets, "node long, own array<long>"))
    blocks = lambda size, n: F.greatest(F.ceil(size / BLOCK_TEXTS), F.ceil(n / BLOCK_SHINGLES), F.lit(1))
    large = F.col("label") == F.col("most.label")
    rest, all_ = blocks(F.col("size") - F.col("most.size"), F.col("n_shingles") - F.col("most.n_shingles")), F.col("rest") + blocks(F.col("most.size"), F.col("most.n_shingles"))
    dealt = hot.withColumn("rest", rest).withColumn("all", all_).withColumn("hash", F.xxhash64("node"))
    dealt = dealt.withColumn("block", F.when(large, F.col("rest") + F.pmod("hash", F.col("all") - F.col("rest"))).otherwise(F.pmod("hash", "rest")))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(large, F.col("rest") - 1).otherwise(F.col("all") - 1))))
    paired = paired.select("shingle", (F.least("block", "other") * F.col("all") + F.greatest("block", "other")).alias("meeting"), "block", "label", "node")
    key = ["shingle", "meeting"]
    return paired.join(of, "node").repartition(*key).sortWithinPartitions(*key).select(*key, "block", "label", "node", "own").mapInArrow(met, "a long, b long")


def _sizes_fit(similarity: float):
    return F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b") - 1e-6


def _possible(met: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that may reach the similarity, from a, b, n_a, n_b and met, the number of shingles that both prefixes hold.

    Of the text whose prefix ends first, no other shingle of the prefix is in the other text: met and what lies behind its
    prefix bound the common shingles, which must be at least similarity / (1 + similarity) of n_a + n_b.
    """
    rest = F.greatest(F.ceil(similarity * F.greatest("n_a", "n_b") - 1e-9) - 1, F.lit(0))
    most = F.col("met") + rest >= similarity / (1 + similarity) * (F.col("n_a") + F.col("n_b")) - 1e-6
    return met.where(_sizes_fit(similarity) & most).select("a", "b")


def near_components(docs: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """doc_id, node (a hash of the text), component: a row for each row; rows of one component are copies or near copies."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            made = [[x - 2**64 if x >= 2**63 else x for x in family_prints(t.as_py() or b"")] for t in batch.column(2).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.int64()))], ["doc_id", "node", "fps"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    prints = cut(_noded(docs).select("doc_id", "node", "text").mapInArrow(run, f"doc_id {kind}, node long, fps array<long>"))
    reps = cut(prints.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("fps").alias("fps")))
    owned = cut(reps.select("node", F.posexplode("fps").alias("family", "fp")))
    first = cut(owned.groupBy("family", "fp").agg(F.min("node").alias("first")))
    links = fingerprint_links(first.select("family", "fp"), radius, shard_nodes)
    end = lambda x: first.select("family", F.col("fp").alias(x), F.col("first").alias(f"node_{x}"))
    across = links.join(end("a"), ["family", "a"]).join(end("b"), ["family", "b"]).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    equal = owned.join(first, ["family", "fp"]).where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    pairs = cut(across.union(equal).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    of = components(similar_links(docs, reps, pairs, similarity))
    out = prints.select("doc_id", "node").join(of, "node", "left")
    return out.select("doc_id", "node", F.coalesce("component", "node").alias("component"))


def _noded(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("node"))


def drop_near_copies(docs: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """One row of each component: its smallest doc_id's (null ids only if there is no other).

    Columns as in docs. Null and empty texts are equal, blank ones link with them; of equal rows one stays. A shorter text than
    five words is one shingle. Empty: no rows.
    """
    found = cut(near_components(docs, similarity, radius, shard_nodes))
    head = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node"))
    keep = cut(found.groupBy("component").agg(head.alias("h")).select(F.col("h.doc_id").alias("id"), F.col("h.node").alias("kept")))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # so that names of docs can't clash with ours
    keyed = docs.select(row, F.col("doc_id").alias("own_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    rows = keyed.join(keep, keyed["own_id"].eqNullSafe(keep["id"]) & (keyed["key"] == keep["kept"]), "left_semi")
    repeated = found.groupBy("doc_id", "node").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    return (rows.dropDuplicates(["own_id", "key"]) if repeated else rows).select("row.*")
