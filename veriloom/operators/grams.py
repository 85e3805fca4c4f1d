"""Regular-expression search over a written index of trigrams: what an expression needs is read off its parse, candidates come from posting lists, the expression itself confirms.

An expression becomes alternatives of trigrams that any match must hold (all of one alternative). Of an alternative the rarest
few are looked up. Postings and texts lie in folders by hash, so a search reads the folders of its trigrams and of its candidates.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriloom.sources import storage

GRAM = 3
#: Strings that a part of an expression may stand for, and alternatives of a whole one: beyond, less is asked for, never more.
STRINGS, ALTERNATIVES = 16, 32
#: Trigrams of an alternative that are looked up.
LOOKED_UP = 4
#: Files of a folder of postings.
PIECES = 4


def _grams(text: str) -> frozenset[str]:
    return frozenset(text[k : k + GRAM] for k in range(len(text) - GRAM + 1))


#: Alternatives: None is "anything"; a list of sets of trigrams, one of which a match holds.
Need = list | None


def _either(a: Need, b: Need) -> Need:
    if a is None or b is None or len(a) + len(b) > ALTERNATIVES:
        return None
    return a + b


def _both(a: Need, b: Need) -> Need:
    if a is None or b is None:
        return b if a is None else a
    if len(a) * len(b) > ALTERNATIVES:
        return min(a, b, key=len)
    return [x | y for x, y in product(a, b)]


def _of(strings: set[str]) -> Need:
    if any(len(x) < GRAM for x in strings) or len(strings) > ALTERNATIVES:
        return None
    return [_grams(x) for x in sorted(strings)]


def needs(expression: str) -> Need:
    """The alternatives of trigrams that every match of the expression holds; None: nothing is known."""
    from re import _constants as c
    from re import _parser

    def strings_of(op, given) -> set[str] | None:
        """The strings that one element may stand for, if they are few."""
        if op is c.LITERAL:
            return {chr(given)}
        if op is c.AT or op in (c.ASSERT, c.ASSERT_NOT):
            return {""}
        if op is c.IN and all(x[0] in (c.LITERAL, c.RANGE) for x in given):
            chars = [chr(k) for x in given for k in (range(x[1][0], x[1][1] + 1) if x[0] is c.RANGE else [x[1]])]
            return set(chars) if len(chars) <= STRINGS else None
        return None

    def sequence(parts) -> tuple[set[str] | None, Need]:
        """(all strings that the parts may stand for, if few; what a match needs besides)."""
        now, need, whole = {""}, None, True
        for op, given in parts:
            strings, more = element(op, given)
            if strings is not None:
                joined = {a + b for a, b in product(now, strings)}
                if len(joined) <= STRINGS:
                    now = joined
                    continue
            need, whole = _both(_both(need, _of(now)), more), False
            now = strings if strings is not None else {""}
        return (now, None) if whole else (None, _both(need, _of(now)))

    def element(op, given) -> tuple[set[str] | None, Need]:
        strings = strings_of(op, given)
        if strings is not None:
            return strings, None
        if op is c.SUBPATTERN:
            if given[1]:  # flags
                return None, None
            return sequence(given[3])
        if op is c.ATOMIC_GROUP:
            return sequence(given)
        if op is c.BRANCH:
            found = [sequence(x) for x in given[1]]
            if all(s is not None for s, _ in found) and sum(len(s) for s, _ in found) <= STRINGS:
                return set().union(*(s for s, _ in found)), None
            need: Need = []
            for s, more in found:
                need = _either(need, _of(s) if s is not None else more)
            return None, need
        if op in (c.MAX_REPEAT, c.MIN_REPEAT, c.POSSESSIVE_REPEAT):
            least, most, item = given
            strings, more = sequence(item)
            if least == 0:
                return (strings | {""}, None) if strings is not None and most == 1 and len(strings) < STRINGS else (None, None)
            if strings is not None and least == most == 1:
                return strings, None
            return None, (_of(strings) if strings is not None else more)
        return None, None

    if re.search(r"\[[^\]]*\[", expression):  # a class within a class is read otherwise where the match is confirmed
        return None
    try:
        parsed = _parser.parse(expression)
    except (re.error, OverflowError, RecursionError):
        return None
    if parsed.state.flags & (re.IGNORECASE | re.VERBOSE):
        return None
    strings, need = sequence(parsed)
    return _of(strings) if strings is not None else need


def expressions(queries: DataFrame) -> DataFrame:
    """query_id, pattern, alternative, gram of the expressions (query_id, pattern); alternative null: the index can't help."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            for query, pattern in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                need = needs(pattern) if pattern is not None else None
                rows += [(query, pattern, None, None)] if need is None else [(query, pattern, k, g) for k, x in enumerate(need) for g in sorted(x)]
            kinds = (batch.schema.field(0).type, pa.string(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["query_id", "pattern", "alternative", "gram"])

    kind = queries.schema["query_id"].dataType.simpleString()
    return queries.select("query_id", "pattern").mapInArrow(run, f"query_id {kind}, pattern string, alternative int, gram string")


class GramIndex:
    """The index of a corpus (path, content) in a folder: texts, postings (gram, path) and counts (gram, n), each in `parts` folders by hash."""

    def __init__(self, spark: SparkSession, root: str, parts: int = 64):
        self.spark, self.root, self.parts = spark, root.rstrip("/"), parts

    def _part(self, column: str):
        return F.pmod(F.xxhash64(column), F.lit(self.parts)).cast("int")

    def write(self, corpus: DataFrame) -> None:
        """Once; trigrams don't reach across lines. Null contents have no lines."""
        texts = corpus.where(F.col("content").isNotNull()).select("path", "content", self._part("path").alias("part"))
        texts.repartition(self.parts, "part").write.partitionBy("part").mode("overwrite").parquet(f"{self.root}/texts")
        stored = self.spark.read.parquet(f"{self.root}/texts")
        # Trigrams by code point, in one walk over a text; each once a text before anything is shuffled.
        cut_up = F.array_distinct(F.regexp_extract_all("content", F.lit(rf"(?=([^\n]{{{GRAM}}}))[^\n]"), F.lit(1)))
        rows = stored.select("path", F.explode(cut_up).alias("gram")).withColumn("part", self._part("gram"))
        # A folder's postings are dealt to PIECES files at most: a file for each shuffle partition and folder cost more than the postings.
        piece = F.pmod(F.xxhash64("path"), F.lit(PIECES))
        rows.repartition("part", piece).sortWithinPartitions("part").write.partitionBy("part").mode("overwrite").parquet(f"{self.root}/postings")
        counted = self.spark.read.parquet(f"{self.root}/postings").groupBy("part", "gram").agg(F.count("*").alias("n"))
        counted.repartition("part").sortWithinPartitions("part", "gram").write.partitionBy("part").mode("overwrite").parquet(f"{self.root}/counts")

    def _read(self, what: str, parts: list[int]) -> DataFrame:
        """The folders of those parts only."""
        return self.spark.read.parquet(f"{self.root}/{what}").where(F.col("part").isin(parts))

    def _parts_of(self, rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select("part").distinct().collect())  # as many as there are folders

    def _looked_up(self, asked: DataFrame) -> DataFrame:
        """query_id, alternative, size, rank (from 0, the rarest first), gram, part of the trigrams that are looked up; asked: expressions() with alternatives. Alternatives with a trigram that no text holds are left out."""
        wanted = storage.cut(asked.where("alternative IS NOT NULL").withColumn("part", self._part("gram")))
        parts = self._parts_of(wanted)
        counted = wanted.join(self._read("counts", parts).select("gram", "n"), "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        chosen = counted.groupBy("query_id", "alternative").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "gram"))), 1, LOOKED_UP).alias("g"))
        return storage.cut(chosen.where(F.col("g")[0]["n"] > 0).select("query_id", "alternative", F.size("g").alias("size"), F.posexplode("g.gram").alias("rank", "gram")).withColumn("part", self._part("gram")))

    def candidates(self, asked: DataFrame) -> DataFrame:
        """query_id, path: texts that hold all looked-up trigrams of an alternative; asked: expressions() with alternatives."""
        return self._holding(self._looked_up(asked))

    def _holding(self, grams: DataFrame) -> DataFrame:
        held = self._read("postings", self._parts_of(grams)).select("gram", "path").join(grams.drop("part", "rank"), "gram")
        # One shuffle, by path, serves the count, the distinct pairs and search()'s lists.
        full = held.select("path", "query_id", "alternative", "size").repartition("path").groupBy("path", "query_id", "alternative", "size").agg(F.count("*").alias("n")).where("n = size")
        return full.select("query_id", "path").distinct()

    def search(self, queries: DataFrame) -> DataFrame:
        """query_id, path, line, text of all lines that an expression (query_id, pattern) finds. Those that the index can't help are held against every line; null patterns find nothing."""
        asked = storage.cut(expressions(queries))
        grams = self._looked_up(asked)
        rarest = grams.where("rank = 0").groupBy("query_id").agg(F.collect_set("gram").alias("holds"))
        patterns = storage.cut(asked.where("alternative IS NOT NULL").select("query_id", "pattern").distinct().join(rarest, "query_id"))
        found = self._holding(grams).join(patterns, "query_id").groupBy("path").agg(F.collect_list(F.struct("query_id", "pattern", "holds")).alias("asked"))
        found = storage.cut(found.withColumn("part", self._part("path")))
        rest = storage.cut(asked.where("alternative IS NULL AND pattern IS NOT NULL").select("query_id", "pattern", F.lit(None).cast("array<string>").alias("holds")))
        if rest.isEmpty():
            return _matching(self._read("texts", self._parts_of(found)).select("path", "content").join(found.drop("part"), "path"))
        every = self.spark.read.parquet(f"{self.root}/texts").select("path", "content").join(found.drop("part"), "path", "left")
        together = rest.agg(F.collect_list(F.struct("query_id", "pattern", "holds")).alias("rest"))  # the stated expressions, one row for every text
        met = every.join(F.broadcast(together)).select("path", "content", F.when(F.col("asked").isNull(), F.col("rest")).otherwise(F.concat("asked", "rest")).alias("asked"))
        return _matching(met)


def _matching(texts: DataFrame) -> DataFrame:
    """query_id, path, line, text of the lines that match, from rows (path, content, asked: query_id, pattern, holds). A text is shuffled and cut into lines once, whatever is asked of it.

    holds: trigrams of which a matching line has one; null: any line may match. An expression meets all lines of a text before
    the next one does, and regexp_instr keeps its last expression compiled, which regexp_like doesn't. Every text has a line,
    so posexplode_outer adds none; for posexplode Spark would cut the texts a second time, to ask whether they have any.
    """
    lines = texts.select("path", F.split(F.regexp_replace("content", r"\n\z", ""), "\n").alias("lines"), "asked")
    each = lines.select("path", "lines", F.inline("asked")).select("path", "query_id", "pattern", "holds", F.posexplode_outer("lines").alias("at", "text"))
    may = F.when(F.col("holds").isNull(), True).otherwise(F.exists("holds", lambda g: F.contains("text", g)))
    return each.where(F.when(may, F.regexp_instr("text", F.col("pattern")) > 0)).select("query_id", "path", (F.col("at") + 1).alias("line"), "text")
