"""Retrieval of corpus lines by the terms of a query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veriloom.sources.storage import cut

# Words that are no search terms.
STOP = ("theorem", "lemma", "have", "exact", "import", "Mathlib", "open", "Polynomial", "Show", "that", "sorry", "integrally", "closed")


def terms(query: Column, most: int = 8) -> Column:
    """The query's distinct terms, the longest first, then in order of text, at most `most`."""
    found = F.array_except(F.array_distinct(F.regexp_extract_all(query, F.lit("[A-Za-z][A-Za-z0-9_]{3,}"), F.lit(0))), F.array(*map(F.lit, STOP)))
    ranked = F.sort_array(F.transform(found, lambda x: F.struct((-F.length(x)).alias("n"), x.alias("t"))))
    return F.slice(F.transform(ranked, lambda x: x["t"]), 1, most)


def corpus_lines(corpus: DataFrame, path: str = "path", content: str = "content", tasks: int | None = None) -> DataFrame:
    """path, line (from 1), text. tasks: deals the texts out to so many tasks first, for a corpus that is one file's one part; a large one needs no such shuffle."""
    lines = (corpus.select(path, content).repartition(tasks) if tasks else corpus).select(path, F.posexplode(F.split(F.regexp_replace(content, r"\n\z", ""), "\n")).alias("p", "text"))
    return lines.select(F.col(path).alias("path"), (F.col("p") + 1).alias("line"), "text")


#: What search() answers instead of lines (fixed texts of this library).
NO_CORPUS, NO_TERMS = "[no corpus to search]", ""


def search(queries: DataFrame, lines: DataFrame, per_file: int = 2, most: int = 20, term_chars: int = 4) -> DataFrame:
    """query_id, path, line, text, rank: lines that hold any of a query's terms, per_file for each file, most in all, by path and line.

    A term has letters, digits and underscores only, so it lies within one run of these. Terms meet the corpus's distinct
    runs on their first term_chars characters, the contains test confirms, and what matches meets the lines on the run. Only
    (path, line) travels; texts come for the lines that are left.
    """
    asked = queries.select("query_id", F.explode(terms(F.col("query"))).alias("term")).distinct().withColumn("gram", F.substring("term", 1, term_chars))
    # Cut from the lines once, and written: the distinct runs and the hits are both read from there.
    runs = cut(lines.select("path", "line", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(f"[A-Za-z0-9_]{{{term_chars},}}"), F.lit(0)))).alias("run")))
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("run") - term_chars + 1), lambda i: F.substring(F.col("run"), i, F.lit(term_chars))))
    words = runs.select("run").distinct().select("run", F.explode(grams).alias("gram"))
    matched = cut(words.join(asked, "gram").where(F.contains("run", F.col("term"))).select("query_id", "run").distinct())
    hits = runs.join(_sent(matched), "run").select("query_id", "path", "line").distinct()
    in_file = F.row_number().over(Window.partitionBy("query_id", "path").orderBy("line"))
    overall = F.row_number().over(Window.partitionBy("query_id").orderBy("path", "line"))
    kept = cut(hits.withColumn("k", in_file).where(F.col("k") <= per_file).drop("k").withColumn("rank", overall).where(F.col("rank") <= most))
    return lines.join(_sent(kept), ["path", "line"]).select("query_id", "path", "line", "text", "rank")


def _sent(rows: DataFrame, few: int = 20_000) -> DataFrame:
    """To be broadcast, if it has few rows."""
    return F.broadcast(rows) if rows.limit(few + 1).count() <= few else rows


def shown(queries: DataFrame, lines: DataFrame, found: DataFrame) -> DataFrame:
    """query_id, retrieval: each query's lines as text; a fixed text where there is no corpus, an empty one without terms."""
    text = found.groupBy("query_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "path", "line", "text"))), lambda x: F.concat_ws(":", x["path"].cast("string"), x["line"].cast("string"), x["text"])), "\n").alias("t"))
    empty = lines.isEmpty()
    none = F.lit(NO_CORPUS) if empty else F.lit(NO_TERMS)
    return queries.select("query_id").distinct().join(text, "query_id", "left").select("query_id", F.coalesce("t", none).alias("retrieval"))
