"""The registered queries over versions, import graphs, the trigram index, streams of repair and stores, and the same in ANSI SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.operators import answers, grams, imports, providers, versions
from veriloom.operators.verifier import OfflineVerifier
from veriloom.registry import MASK_SQL, NL, SOURCE_DUCK, SOURCE_SPARK, SOURCES_SQL, dealt, query, sources_of, table
from veriloom.sources import json_array, keyed, storage


def _folder(spark, what: str) -> str:
    return f"{storage.shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


# --- versions ---------------------------------------------------------------------------------------------------------
@query(f"""WITH {SOURCES_SQL}, v AS (
  SELECT 0 AS version, project, path, content FROM src
  UNION ALL SELECT 1, project, path, CASE WHEN p % 5 = 0 THEN replace(content, 'sorry', 'trivial') ELSE content END FROM src
  UNION ALL SELECT 2, project, path, CASE WHEN p % 11 = 0 THEN content || '-- again' WHEN p % 5 = 0 THEN replace(content, 'sorry', 'trivial') ELSE content END FROM src WHERE p % 7 > 0)
SELECT version::BIGINT AS version, project::BIGINT AS project, path, sha256(content) AS digest FROM v""")
def project_versions(spark, sf_dir):
    """Three versions of all projects, written as changes, the older two folded, each read back."""
    src = sources_of(spark, sf_dir)
    fixed = F.when(F.col("p") % 5 == 0, F.replace("content", F.lit("sorry"), F.lit("trivial"))).otherwise(F.col("content"))
    one = src.withColumn("content", fixed)
    two = src.where("p % 7 > 0").withColumn("content", F.when(F.col("p") % 11 == 0, F.concat("content", F.lit("-- again"))).otherwise(fixed))
    log = versions.VersionTable(spark, _folder(spark, "versions"))
    log.commit(src)
    log.commit(versions.changes(log.files(), one, 1))
    log.compact()
    log.commit(versions.changes(log.files(), two, 2))
    read = lambda v: log.files(v).select(F.lit(v).cast("long").alias("version"), "project", "path", F.sha2("content", 256).alias("digest"))
    return read(0).unionByName(read(1)).unionByName(read(2))


@query("""WITH c AS (SELECT user_id AS project, 'F' || event_id % 5 AS path, event_id AS version, CASE WHEN event_id % 6 > 0 THEN event_type END AS content FROM events),
k AS (SELECT *, content IS NOT DISTINCT FROM lag(content) OVER w AND row_number() OVER w > 1 AS same FROM c WINDOW w AS (PARTITION BY project, path ORDER BY version)),
i AS (SELECT *, lead(version) OVER (PARTITION BY project, path ORDER BY version) AS to_version FROM k WHERE NOT same)
SELECT project, path, content, version AS from_version, to_version FROM i WHERE content IS NOT NULL""")
def version_intervals(spark, sf_dir):
    e = F.col("event_id")
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("project"), F.concat(F.lit("F"), (e % 5).cast("string")).alias("path"), F.when(e % 6 > 0, F.col("event_type")).alias("content"), e.alias("version"))
    return versions.intervals(log)


# --- imports ----------------------------------------------------------------------------------------------------------
#: Part p imports p / 2 and p / 3; one in 91 of the larger ones imports its double, which closes a cycle. Imports in comments and strings are none.
GRAPH = f"""concat('/- import Book.F1', {NL}, ' -/', {NL}, '-- import Book.F2', {NL}, CASE WHEN p > 1 THEN concat('import Book.F', CAST(floor(p / 2) AS INTEGER), {NL}) ELSE '' END,
 CASE WHEN p > 2 THEN concat('  import Book.F', CAST(floor(p / 3) AS INTEGER), ' Mathlib.X', {NL}) ELSE '' END, CASE WHEN p % 91 = 5 AND p > 500 THEN concat('import Book.F', p * 2, {NL}) ELSE '' END,
 'def s', p, ' := "import Book.F3"', {NL}, CASE WHEN p % 3 = 0 THEN concat('theorem t : True := by sorry', {NL}) ELSE '' END)"""


def graph_of(spark, sf_dir) -> DataFrame:
    p = dealt(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("p")))
    return p.select("p", (F.col("p") * 0).alias("project"), F.concat(F.lit("Book/F"), F.col("p").cast("string"), F.lit(".lean")).alias("path"), F.expr(GRAPH).alias("content"))


#: e: the imports that stand in code, by the masked text's lines; up: the closure; ok: what no cycle holds up.
GRAPH_SQL = f"""src AS (SELECT p, {GRAPH} AS content FROM (SELECT p_partkey AS p FROM part)), {MASK_SQL},
l AS (SELECT p, unnest(string_split(code, chr(10))) AS line FROM masked),
e AS (SELECT DISTINCT l.p AS a, src.p AS b FROM (SELECT p, unnest(regexp_split_to_array(trim(regexp_replace(line, '^[ \\t]*import[ \\t]+', '')), '[ \\t]+')) AS name FROM l WHERE regexp_matches(line, '^[ \\t]*import[ \\t]+')) l JOIN src ON l.name = 'Book.F' || src.p),
up AS (SELECT a, b FROM e UNION SELECT up.a, e.b FROM up JOIN e ON up.b = e.a),
loops AS (SELECT a AS p FROM up WHERE a = b),
held AS (SELECT p FROM loops UNION SELECT a FROM up JOIN loops ON up.b = loops.p),
lv AS (SELECT p, 0 AS k FROM src WHERE p NOT IN (SELECT a FROM e) UNION SELECT e.a, lv.k + 1 FROM lv JOIN e ON e.b = lv.p WHERE e.a NOT IN (SELECT p FROM held))"""


@query(f"""WITH RECURSIVE {GRAPH_SQL}
SELECT 'Book.F' || src.p AS module, max(k)::INTEGER AS level, src.p IN (SELECT p FROM loops) OR (src.p IN (SELECT p FROM held) AND src.p IN (SELECT b FROM up JOIN loops ON up.a = loops.p)) AS on_cycle FROM src LEFT JOIN lv ON lv.p = src.p GROUP BY src.p""")
def import_levels(spark, sf_dir):
    files = graph_of(spark, sf_dir)
    return imports.levels(imports.modules(files), imports.edges(files)).select("module", "level", "on_cycle")


@query(f"""WITH RECURSIVE {GRAPH_SQL} SELECT DISTINCT 'Book.F' || p AS module FROM (SELECT p FROM src WHERE p % 29 = 7 UNION SELECT a FROM up WHERE b % 29 = 7)""")
def affected_modules(spark, sf_dir):
    files = graph_of(spark, sf_dir)
    return imports.affected(imports.edges(files), imports.modules(files.where("p % 29 = 7"))).select("module")


@query(f"""WITH RECURSIVE {GRAPH_SQL}, hit AS (SELECT p FROM src WHERE p % 29 = 7 UNION SELECT a FROM up WHERE b % 29 = 7)
SELECT 'Book/F' || p || '.lean' AS path, CASE WHEN p IN (SELECT p FROM held) THEN 1 WHEN p % 29 = 7 THEN 1 ELSE 0 END AS exit_code,
  CASE WHEN p NOT IN (SELECT p FROM held) AND p % 3 = 0 THEN 1 ELSE 0 END AS holes, p NOT IN (SELECT p FROM held) AND p NOT IN (SELECT p FROM hit) AS reused FROM src""")
def incremental_build(spark, sf_dir):
    """A second build after one file in 29 broke: only what that affects is checked again."""
    files = graph_of(spark, sf_dir)
    first = imports.build(files.select("project", "path", "content"), OfflineVerifier())
    changed = files.withColumn("content", F.when(F.col("p") % 29 == 7, F.concat("content", F.lit("broken\n"))).otherwise(F.col("content")))
    return imports.build(changed.select("project", "path", "content"), OfflineVerifier(), first).select("path", "exit_code", "holes", "reused")


# --- search -----------------------------------------------------------------------------------------------------------
#: Expressions of the benchmark's items by their words: two words in order, either of two, a word and a class, an optional end.
PATTERNS = """CASE item_id % 4 WHEN 0 THEN concat(a, '.*', b) WHEN 1 THEN concat('(', a, '|', b, ') [a-z]') WHEN 2 THEN concat('\\\\b', a, ' \\\\w+ ') ELSE concat(a, '(?:', b, ')?,') END"""


@query(f"""WITH w AS (SELECT item_id, regexp_extract(text, '([A-Za-z]+)', 1) AS a, regexp_extract(text, '[A-Za-z]+[^A-Za-z]+([A-Za-z]+)', 1) AS b FROM benchmark),
q AS (SELECT item_id AS query_id, {PATTERNS.replace(chr(92) * 2, chr(92))} AS pattern FROM w),
l AS (SELECT doc_id AS path, unnest(string_split(regexp_replace(text, '\\n$', ''), chr(10))) AS text, generate_subscripts(string_split(regexp_replace(text, '\\n$', ''), chr(10)), 1) AS line FROM documents WHERE text IS NOT NULL)
SELECT query_id, path, line::INTEGER AS line, sha256(text) AS digest FROM l JOIN q ON regexp_matches(l.text, q.pattern)""")
def regex_search(spark, sf_dir):
    """Expressions made of the benchmark's words over all documents, by the trigram index."""
    words = table(spark, sf_dir, "benchmark").select("item_id", F.regexp_extract("text", "([A-Za-z]+)", 1).alias("a"), F.regexp_extract("text", "[A-Za-z]+[^A-Za-z]+([A-Za-z]+)", 1).alias("b"))
    asked = words.select(F.col("item_id").alias("query_id"), F.expr(PATTERNS).alias("pattern"))
    index = grams.GramIndex(spark, _folder(spark, "grams"))
    index.write(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.col("text").alias("content")).where("content IS NOT NULL"))
    return index.search(asked).select("query_id", "path", "line", F.sha2("text", 256).alias("digest"))


# --- repair as a stream -----------------------------------------------------------------------------------------------
@query(f"""WITH src AS (SELECT p, 'Book/F' || p || '.lean' AS path, {SOURCE_DUCK} AS content FROM (SELECT s_suppkey AS p FROM supplier)), {MASK_SQL},
h AS (SELECT p, len(regexp_extract_all(code, '\\b(sorry|admit)\\b')) AS before, CASE WHEN length(content) % 7 = 3 THEN len(regexp_extract_all(code, '\\b(sorry|admit)\\b')) ELSE len(regexp_extract_all(code, '\\badmit\\b')) END AS after FROM masked)
SELECT p, after = 0 AS success, (CASE WHEN before = 0 THEN 0 WHEN after = 0 THEN 1 ELSE 4 END)::BIGINT AS attempts, (CASE WHEN after < before THEN 1 ELSE 0 END)::BIGINT AS accepted, after::INTEGER AS holes FROM h""")
def repair_stream(spark, sf_dir):
    """The repair loop as a stream over one project for each supplier, its files made from the key, with offline answers."""
    from veriloom.plans import pipelines
    from veriloom.plans.repair_stream import repair_stream as run

    rows = dealt(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("p")))
    files = rows.select(F.col("p").alias("project"), F.concat(F.lit("Book/F"), F.col("p").cast("string"), F.lit(".lean")).alias("path"), F.expr(SOURCE_SPARK).alias("content"))
    _, verdicts, trace = run(files, pipelines.offline_plan, pipelines.offline_patch, OfflineVerifier(), _folder(spark, "repair"), pipelines.Budget(2, 2))
    per = trace.groupBy("project").agg(F.count("*").alias("attempts"), F.count_if("accepted").alias("accepted"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return verdicts.join(per, "project", "left").select(F.col("project").alias("p"), ((F.col("holes") == 0) & (F.col("exit_code") == 0)).alias("success"), zero("attempts"), zero("accepted"), "holes")


# --- stores -----------------------------------------------------------------------------------------------------------
@query("""SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1)::BIGINT AS row_pos, turn, role, sha256(text) AS digest FROM conversations""")
def json_arrays(spark, sf_dir):
    """Each conversation as one JSON array, cut every 200 characters wherever that falls, and its elements read back."""
    c = table(spark, sf_dir, "conversations")
    per = c.groupBy("conv_id").agg(F.to_json(F.sort_array(F.collect_list(F.struct("turn", "role", "text")))).alias("t"))
    places = F.transform(F.sequence(F.lit(0), F.floor((F.length("t") - 1) / 200)), lambda i: F.struct((i * 200).alias("range"), F.substring("t", (i * 200 + 1).cast("int"), F.lit(200)).alias("piece")))
    cut_up = per.select(F.col("conv_id").cast("string").alias("file"), F.inline(places)).select("file", "range", F.lit(0).cast("long").alias("k"), "piece")
    found = json_array.array_elements(cut_up).select(F.col("file").cast("long").alias("conv_id"), "row_pos", F.from_json("element", "turn long, role string, text string", {"mode": "FAILFAST"}).alias("r"))
    return found.select("conv_id", "row_pos", "r.turn", "r.role", F.sha2("r.text", 256).alias("digest"))


@query("""SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::INTEGER AS n_words, 0 AS asked_again FROM documents""")
def answer_log(spark, sf_dir):
    """A question for each document, asked twice: the second time the log answers all."""
    log = answers.AnswerLog(spark, _folder(spark, "answers"))
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    log.generate(d, providers.Rule(lambda p: str(len(p.encode().split()))), "Count the words.", "text")
    again = log.generate(d, providers.Rule(_refuse), "Count the words.", "text")
    return again.select("doc_id", F.col("response.text").cast("int").alias("n_words"), F.when(F.col("response.error").isNull(), 0).otherwise(1).alias("asked_again"))


def _refuse(prompt: str) -> str:
    raise RuntimeError("asked again")


@query("""SELECT CASE WHEN o_orderkey % 9 = 0 THEN 'errors' ELSE 'results' END AS kind, o_orderkey AS id, CASE WHEN o_orderkey % 9 = 0 THEN 'lost ' || o_orderkey ELSE o_orderstatus END AS said FROM orders
UNION ALL SELECT 'metrics', NULL, ((SELECT count(*) FROM orders))::VARCHAR""")
def keyed_results(spark, sf_dir):
    """Results, errors and metrics of all orders in a keyed store, read back."""
    o = table(spark, sf_dir, "orders")
    rows = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("said"), F.when(F.col("o_orderkey") % 9 == 0, F.concat(F.lit("lost "), F.col("o_orderkey").cast("string"))).alias("error"))
    store = keyed.write_run(rows, _folder(spark, "keyed"), o.agg(F.count("*").alias("n")))
    said = F.when(F.col("kind") == "errors", F.col("body")).when(F.col("kind") == "metrics", F.get_json_object("body", "$.n")).otherwise(F.get_json_object("body", "$.said"))
    return store.read().select("kind", F.when(F.col("kind") != "metrics", F.col("key")).cast("long").alias("id"), said.alias("said"))
