"""The registered queries of the library's own operators over the driver's tables, and the same in ANSI SQL.

The tables hold no proof-language text, so some queries derive it from ids with an SQL expression that both engines read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veriloom.functions import ids as I
from veriloom.functions import text as T
from veriloom.operators import metrics, projects, replay, retrieval, signatures, tasks
from veriloom.plans import stages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- texts derived from ids ---------------------------------------------------------------------------------------------
NL = "chr(10)"
#: A file of part p: comments (nested), a string with an escape, scopes, a private declaration, one or two statements.
SOURCE = f"""concat('import Base', {NL}, '/- note ', CASE WHEN p % 3 = 0 THEN '/- axiom hidden -/ admit ' ELSE 'text ' END, '-/', {NL}, '-- unsafe line ', p, {NL},
 'namespace N', p % 7, {NL}, CASE WHEN p % 2 = 0 THEN concat('section', {NL}) ELSE '' END,
 'theorem t', p % 50, ' (x : Nat) : x = ', p % 5, ' := by', {NL}, '  ', CASE WHEN p % 4 = 0 THEN 'sorry' WHEN p % 4 = 1 THEN 'admit' ELSE 'trivial' END, ' -- sorry', {NL},
 CASE WHEN p % 2 = 0 THEN concat('end', {NL}) ELSE '' END, 'def s', p % 11, ' := "a\\"sorry ', p, '"', {NL},
 CASE WHEN p % 6 = 0 THEN concat('  axiom a', p, ' : False', {NL}) WHEN p % 6 = 1 THEN concat({NL}, 'unsafe def u', p, ' := 1', {NL}) ELSE '' END,
 'end N', p % 7, {NL})"""
SOURCE_DUCK = SOURCE
SOURCE_SPARK = SOURCE.replace('\\"', '\\\\"')
#: Compiler output of event e.
OUTPUT = f"""concat('T.src:', e % 90, ':1: error: bad', {NL}, CASE WHEN e % 3 = 0 THEN concat('x error(kind.', e % 4, '): worse error: twice', {NL}) ELSE 'no terror: here' END, {NL}, CASE WHEN e % 5 = 0 THEN 'error:' ELSE 'fine' END)"""


def dealt(keys: DataFrame) -> DataFrame:
    """Keys p in as many tasks as there are cores at least: the texts that are made of them are far larger than their table, which is one part of one file."""
    cores = keys.sparkSession.sparkContext.defaultParallelism
    return keys.repartition(cores, "p") if keys.rdd.getNumPartitions() < cores else keys


def sources_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = dealt(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("p")))
    return parts.select("p", (F.col("p") % 100).alias("project"), F.concat(F.lit("Book/F"), F.col("p").cast("string"), F.lit(".lean")).alias("path"), F.expr(SOURCE_SPARK).alias("content"))


SOURCES_SQL = f"src AS (SELECT p, p % 100 AS project, 'Book/F' || p || '.lean' AS path, {SOURCE_DUCK} AS content FROM (SELECT p_partkey AS p FROM part))"
#: A walk over the characters of (id, content); masked blanks comments and string bodies.
MASK_SQL = """masked AS (
  SELECT *, CASE WHEN length(content) = 0 THEN '' ELSE list_reduce(range(1, length(content)::BIGINT + 1), lambda a, i:
    CASE WHEN a.skip THEN {'m': a.m, 'd': a.d, 'skip': false, 'o': a.o}
         WHEN a.m = 'l' THEN {'m': CASE WHEN ch[i] = chr(10) THEN 'c' ELSE 'l' END, 'd': a.d, 'skip': false, 'o': a.o || CASE WHEN ch[i] = chr(10) THEN ch[i] ELSE ' ' END}
         WHEN a.m = 'b' AND ch[i] = '/' AND coalesce(ch[i + 1], '') = '-' THEN {'m': 'b', 'd': a.d + 1, 'skip': true, 'o': a.o || '  '}
         WHEN a.m = 'b' AND ch[i] = '-' AND coalesce(ch[i + 1], '') = '/' THEN {'m': CASE WHEN a.d = 1 THEN 'c' ELSE 'b' END, 'd': a.d - 1, 'skip': true, 'o': a.o || '  '}
         WHEN a.m = 'b' THEN {'m': 'b', 'd': a.d, 'skip': false, 'o': a.o || CASE WHEN ch[i] = chr(10) THEN ch[i] ELSE ' ' END}
         WHEN a.m = 's' AND ch[i] = chr(92) AND i < length(content) THEN {'m': 's', 'd': a.d, 'skip': true, 'o': a.o || '  '}
         WHEN a.m = 's' AND ch[i] = '"' THEN {'m': 'c', 'd': a.d, 'skip': false, 'o': a.o || '"'}
         WHEN a.m = 's' THEN {'m': 's', 'd': a.d, 'skip': false, 'o': a.o || CASE WHEN ch[i] = chr(10) THEN ch[i] ELSE ' ' END}
         WHEN ch[i] = '-' AND coalesce(ch[i + 1], '') = '-' THEN {'m': 'l', 'd': a.d, 'skip': true, 'o': a.o || '  '}
         WHEN ch[i] = '/' AND coalesce(ch[i + 1], '') = '-' THEN {'m': 'b', 'd': 1, 'skip': true, 'o': a.o || '  '}
         WHEN ch[i] = '"' THEN {'m': 's', 'd': a.d, 'skip': false, 'o': a.o || '"'}
         ELSE {'m': 'c', 'd': a.d, 'skip': false, 'o': a.o || ch[i]} END,
    {'m': 'c', 'd': 0, 'skip': false, 'o': ''}).o END AS code
  FROM (SELECT *, string_split(content, '') AS ch FROM src))"""


# --- runs and attempts: tasks are users, attempts their events in time ------------------------------------------------
ATTEMPTS_SQL = """a AS (SELECT user_id AS task, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS idx, event_type = 'purchase' AS success, event_id FROM events),
t AS (SELECT *, coalesce(max(success::INT) OVER (PARTITION BY task ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM a),
kept AS (SELECT task, idx, success, event_id FROM t WHERE done = 0)"""


def attempts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    idx = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return events.select(F.col("user_id").alias("task"), idx.alias("idx"), (F.col("event_type") == "purchase").alias("success"), "event_id")


@query(f"""WITH {ATTEMPTS_SQL},
per AS (SELECT task, min(CASE WHEN success THEN idx END) AS first, max(idx) AS n FROM kept GROUP BY task)
SELECT k::INTEGER AS k, (SELECT count(*) FROM per WHERE first <= k) AS n_passed, (SELECT count(*) FROM per) AS n_tasks,
       (SELECT count(*) FROM per WHERE first <= k)::DOUBLE / (SELECT count(*) FROM per) AS pass_at
FROM (SELECT unnest(range(1, (SELECT max(n) FROM per) + 1)) AS k)""")
def pass_at_k(spark, sf_dir):
    return metrics.pass_at_k(replay.truncate_at_success(attempts_of(spark, sf_dir), ["task"], ["idx"]))


def results_of(spark, sf_dir) -> DataFrame:
    kept = replay.truncate_at_success(attempts_of(spark, sf_dir), ["task"], ["idx"])
    attempt = F.struct("idx", (F.col("idx") % 2).alias("verifier_calls"), F.when(F.col("event_id") % 7 > 0, F.struct("success", (F.col("event_id") % 8 / 8).alias("lean_seconds"))).alias("verification"))
    per = kept.groupBy(F.col("task").alias("id")).agg(F.sort_array(F.collect_list(attempt)).alias("attempts"))
    return per.select("id", "attempts", F.exists("attempts", lambda a: F.coalesce(a["verification"]["success"], F.lit(False))).alias("success"), F.size("attempts").alias("attempt_count"), (F.size("attempts") / 4).alias("wall_seconds"))


RESULTS_SQL = f"""{ATTEMPTS_SQL},
per AS (SELECT task AS id, bool_or(success AND event_id % 7 > 0) AS success, count(*) AS n, sum(idx % 2) AS calls, sum(CASE WHEN event_id % 7 > 0 THEN (event_id % 8) / 8.0::DOUBLE ELSE 0 END) AS secs FROM kept GROUP BY task)"""


@query(f"""WITH {RESULTS_SQL}
SELECT count(*) AS attempted, count(*) FILTER (success) AS solved, count(*) FILTER (success)::DOUBLE / count(*) AS psr, count(*) FILTER (NOT success) AS n_failed,
       round(sum(n / 4.0::DOUBLE), 3) AS total_wall_seconds_sum, sum(n)::BIGINT AS total_attempts, sum(calls)::BIGINT AS verifier_calls, round(sum(secs), 3) AS lean_seconds_sum FROM per""")
def run_metrics(spark, sf_dir):
    return metrics.run_metrics(results_of(spark, sf_dir))


@query(f"WITH {RESULTS_SQL} SELECT id, 'failed' AS reason FROM per WHERE NOT success")
def failed_ids(spark, sf_dir):
    return metrics.failed_ids(results_of(spark, sf_dir))


REPLAY_SQL = """s AS (SELECT user_id AS project, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt,
       (event_id * 7 % 11)::INT AS errors, (event_id * 3 % 5)::INT AS holes, event_id % 6 = 0 AS raised FROM events)"""


def history_of(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.select(F.col("user_id").alias("project"), n.alias("attempt"), (F.col("event_id") * 7 % 11).cast("int").alias("errors"), (F.col("event_id") * 3 % 5).cast("int").alias("holes"), (F.col("event_id") % 6 == 0).alias("raised"))


@query(f"""WITH {REPLAY_SQL},
f AS (SELECT project, list({{'attempt': attempt, 'e': errors, 'h': holes, 'r': raised}} ORDER BY attempt) AS xs FROM s GROUP BY project),
w AS (SELECT project, list_reduce(xs, lambda a, x:
  CASE WHEN x.r THEN {{'ce': a.ce, 'ch': a.ch, 'de': a.de, 'dh': a.dh, 'out': list_append(a.out, {{'attempt': x.attempt, 'accepted': false, 'retained': false, 'ce': a.ce, 'ch': a.ch, 'dh': a.dh, 'de': a.de}})}}
       WHEN x.e < a.ce OR (x.e = a.ce AND x.h < a.ch) THEN {{'ce': x.e, 'ch': x.h, 'de': x.e, 'dh': x.h, 'out': list_append(a.out, {{'attempt': x.attempt, 'accepted': true, 'retained': false, 'ce': x.e, 'ch': x.h, 'dh': x.h, 'de': x.e}})}}
       WHEN x.h < a.dh OR (x.h = a.dh AND x.e < a.de) THEN {{'ce': a.ce, 'ch': a.ch, 'de': x.e, 'dh': x.h, 'out': list_append(a.out, {{'attempt': x.attempt, 'accepted': false, 'retained': true, 'ce': a.ce, 'ch': a.ch, 'dh': x.h, 'de': x.e}})}}
       ELSE {{'ce': a.ce, 'ch': a.ch, 'de': a.de, 'dh': a.dh, 'out': list_append(a.out, {{'attempt': x.attempt, 'accepted': false, 'retained': false, 'ce': a.ce, 'ch': a.ch, 'dh': a.dh, 'de': a.de}})}} END,
  {{'ce': 8, 'ch': 4, 'de': 8, 'dh': 4, 'out': [{{'attempt': 0::BIGINT, 'accepted': false, 'retained': false, 'ce': 8, 'ch': 4, 'dh': 4, 'de': 8}}]}}) AS z FROM f),
u AS (SELECT project, unnest(z.out) AS o FROM w)
SELECT project, o.attempt::INTEGER AS attempt, o.accepted AS accepted, o.retained AS retained, o.ce AS current_errors, o.ch AS current_holes, o.dh AS draft_holes, o.de AS draft_errors FROM u WHERE o.attempt > 0""")
def accept_revert_replay(spark, sf_dir):
    start = F.struct(F.lit(8).alias("errors"), F.lit(4).alias("holes"))
    return replay.replay(history_of(spark, sf_dir), start=start).drop("errors", "holes", "raised")


@query(f"""WITH {ATTEMPTS_SQL} SELECT task, max_by(idx, idx)::INTEGER AS idx, max_by(success, idx) AS success FROM kept GROUP BY task""")
def final_attempts(spark, sf_dir):
    kept = replay.truncate_at_success(attempts_of(spark, sf_dir), ["task"], ["idx"])
    return replay.last_attempt(kept.select("task", "idx", "success"), ["task"], "idx").select("task", "idx", "success")


@query("""WITH e AS (SELECT user_id AS project, (event_id % 4)::INT AS planning_round, event_id % 100 AS et, (event_id % 4) * 10 AS pt FROM events),
r AS (SELECT project, planning_round, count(*) AS n, sum(pt) AS p, max(pt) AS once, sum(et) AS e FROM e GROUP BY ALL)
SELECT project, count(*) AS planner_calls, sum(n)::BIGINT AS executor_calls, sum(p + e)::BIGINT AS tokens, sum(once + e)::BIGINT AS tokens_dedup FROM r GROUP BY project""")
def call_accounting(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    trace = e.select(F.col("user_id").alias("project"), (F.col("event_id") % 4).alias("planning_round"), ((F.col("event_id") % 4) * 10).alias("planner_tokens"), (F.col("event_id") % 100).alias("executor_tokens"))
    return metrics.call_accounting(trace)


def audited_of(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    return e.select(
        F.col("event_id").alias("id"), F.when(F.col("event_id") % 10 > 0, F.col("event_type") == "purchase").alias("passed"), F.when(F.col("event_id") % 9 == 0, F.lit("lost")).alias("error"),
        (F.col("event_id") % 5).alias("verifier_calls"), (F.col("event_id") % 3).alias("planner_calls"), (F.col("event_id") % 7).alias("executor_calls"), (F.col("event_id") % 1000).alias("tokens"),
    )


AUDITED_SQL = """e AS (SELECT event_id AS id, CASE WHEN event_id % 10 > 0 THEN event_type = 'purchase' ELSE false END AS passed, event_id % 9 = 0 AS lost,
  event_id % 5 AS v, event_id % 3 AS p, event_id % 7 AS x, event_id % 1000 AS t FROM events)"""


@query(f"""WITH {AUDITED_SQL} SELECT count(*) AS attempted, count(*) FILTER (passed) AS solved, count(*) FILTER (passed)::DOUBLE / count(*) AS psr, count(*) FILTER (NOT passed) AS n_failed,
  sum(v)::BIGINT AS verifier_calls, sum(p)::BIGINT AS planner_calls, sum(x)::BIGINT AS executor_calls, sum(t)::BIGINT AS tokens FROM e""")
def audited_metrics(spark, sf_dir):
    return metrics.audited_metrics(audited_of(spark, sf_dir))


@query(f"""WITH {AUDITED_SQL} SELECT count(*) FILTER (NOT lost) AS attempted, count(*) FILTER (NOT lost AND passed) AS solved, count(*) FILTER (NOT lost AND passed)::DOUBLE / count(*) FILTER (NOT lost) AS psr,
  count(*) FILTER (NOT lost AND NOT passed) AS n_failed, count(*) FILTER (lost) AS n_infrastructure, sum(v) FILTER (NOT lost)::BIGINT AS verifier_calls, sum(p) FILTER (NOT lost)::BIGINT AS planner_calls, sum(x) FILTER (NOT lost)::BIGINT AS executor_calls FROM e""")
def subset_metrics(spark, sf_dir):
    return metrics.subset_metrics(audited_of(spark, sf_dir))


@query(f"WITH {AUDITED_SQL} SELECT id, CASE WHEN lost THEN 'infrastructure' ELSE 'failed' END AS reason FROM e WHERE lost OR NOT passed")
def subset_failures(spark, sf_dir):
    return metrics.failed_ids(audited_of(spark, sf_dir), "passed", "error")


@query("""WITH c AS (SELECT o_custkey AS project, printf('%09d', o_orderkey) AS path, (o_orderkey % 17 = 0)::INT AS exit_code, o_orderkey % 3 AS errors, o_orderkey % 4 AS holes, 'out ' || o_orderkey AS output, (o_orderkey % 8) / 8.0::DOUBLE AS seconds,
  CASE WHEN o_orderkey % 5 = 0 THEN ['sorry', 'admit'] WHEN o_orderkey % 5 = 1 THEN ['axiom'] ELSE [] END AS forbidden FROM orders)
SELECT project, bool_and(exit_code = 0) AS success, sum(errors)::BIGINT AS global_errors, sum(holes)::BIGINT AS holes, right(string_agg(output, chr(10) ORDER BY path), 100) AS output, round(sum(seconds), 3) AS seconds,
  array_to_string(list_sort(list_distinct(flatten(list(forbidden)))), ',') AS forbidden, CASE WHEN bool_and(exit_code = 0) THEN 0 ELSE 1 END AS exit_code FROM c GROUP BY project""")
def verify_rollup(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("k"))
    kinds = F.when(F.col("k") % 5 == 0, F.array(F.lit("sorry"), F.lit("admit"))).when(F.col("k") % 5 == 1, F.array(F.lit("axiom"))).otherwise(F.expr("cast(array() as array<string>)"))
    checks = o.select(F.col("o_custkey").alias("project"), F.format_string("%09d", "k").alias("path"), (F.col("k") % 17 == 0).cast("int").alias("exit_code"), (F.col("k") % 3).alias("errors"), (F.col("k") % 4).alias("holes"), F.concat(F.lit("out "), F.col("k").cast("string")).alias("output"), (F.col("k") % 8 / 8).alias("seconds"), kinds.alias("forbidden"))
    return metrics.verification_rollup(checks, "project", 100).withColumn("forbidden", F.array_join("forbidden", ","))


@query("""WITH i AS (SELECT doc_id % 50 AS row_id, doc_id FROM documents), l AS (SELECT doc_id % 50 AS row_id, quality = 1 AS matched FROM labels)
SELECT coalesce(t.row_id, m.row_id) AS row_id, coalesce(matched, 0) AS matched, coalesce(total, 0) AS total, CASE WHEN coalesce(total, 0) = 0 THEN 0.0::DOUBLE ELSE coalesce(matched, 0)::DOUBLE / total END AS scc
FROM (SELECT row_id, count(*) AS total FROM i GROUP BY row_id) t FULL JOIN (SELECT row_id, count(*) FILTER (matched) AS matched FROM l GROUP BY row_id) m ON t.row_id = m.row_id""")
def alignment_scc(spark, sf_dir):
    items = table(spark, sf_dir, "documents").select((F.col("doc_id") % 50).alias("row_id"))
    found = table(spark, sf_dir, "labels").select((F.col("doc_id") % 50).alias("row_id"), (F.col("quality") == 1).alias("matched"))
    return metrics.alignment_scores(found, items)


# --- tasks ------------------------------------------------------------------------------------------------------------
@query("""SELECT o_orderkey AS id, o_orderpriority FROM orders WHERE o_orderkey IN (SELECT unnest(range(3, 501)) UNION SELECT 1 UNION SELECT unnest(range(900, 1301)))""")
def task_filter(spark, sf_dir):
    wanted = spark.range(1).select(F.explode(I.parse_ids(F.lit("1,3-500,900-1300"))).alias("id"))
    return I.filter_ids(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderpriority"), wanted)


@query("SELECT o_orderkey, row_pos, row_pos % 7 AS shard FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_pos FROM orders)")
def shard_assign(spark, sf_dir):
    rows = tasks.ordinal(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"])
    return tasks.shard(rows, 7).select("o_orderkey", "row_pos", "shard")


RESUME_SQL = """tasks AS (SELECT o_orderkey AS id FROM orders), prior AS (SELECT l_orderkey AS id, l_linenumber || l_returnflag AS line, l_returnflag AS flag FROM lineitem WHERE l_quantity < 20),
new AS (SELECT o_orderkey AS id, o_orderstatus AS flag FROM orders WHERE o_orderkey NOT IN (SELECT id FROM prior))"""


def _resume(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    prior = table(spark, sf_dir, "lineitem").where("l_quantity < 20").select(F.col("l_orderkey").alias("id"), F.concat(F.col("l_linenumber").cast("string"), "l_returnflag").alias("line"), F.col("l_returnflag").alias("flag"))
    return orders, prior


@query(f"WITH {RESUME_SQL} SELECT id FROM tasks WHERE id NOT IN (SELECT id FROM prior)")
def resume_pending(spark, sf_dir):
    orders, prior = _resume(spark, sf_dir)
    return tasks.pending(orders.select(F.col("o_orderkey").alias("id")), prior)


@query(f"""WITH {RESUME_SQL} SELECT id, flag FROM new WHERE id % 3 > 0 UNION ALL
SELECT id, max_by(flag, line) AS flag FROM prior WHERE id % 3 > 0 GROUP BY id""")
def resume_merge(spark, sf_dir):
    orders, prior = _resume(spark, sf_dir)
    todo = orders.where("o_orderkey % 3 > 0").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("flag"))
    return tasks.merge(todo, prior, tasks.pending(todo, prior))


@query("SELECT DISTINCT l_orderkey + 7 AS id FROM lineitem WHERE l_orderkey + 7 NOT IN (SELECT o_orderkey FROM orders)")
def missing_ids(spark, sf_dir):
    wanted = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") + 7).alias("id"))
    return I.missing_ids(wanted, table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")))


@query("""SELECT (SELECT count(*) FROM (SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem)) = 0 AND (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem EXCEPT SELECT o_orderkey FROM orders)) = 0 AS same""")
def same_ids(spark, sf_dir):
    return I.same_ids(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")), table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id")))


# --- documents, items, blueprints -------------------------------------------------------------------------------------
@query("""WITH r AS (SELECT conv_id, turn, CASE WHEN turn % 4 = 0 THEN text END AS vqa, CASE WHEN turn % 4 = 1 THEN '' WHEN turn % 4 = 2 THEN role || ': ' || text END AS messages, CASE WHEN turn % 3 = 0 THEN text END AS content, role AS context FROM conversations)
SELECT conv_id, turn, coalesce(vqa, nullif(messages, ''), nullif(content, ''), nullif(context, ''), '') AS text, 'unknown' AS source_name, sha256(coalesce(vqa, nullif(messages, ''), nullif(content, ''), nullif(context, ''), '')) AS digest FROM r""")
def normalize_document(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    rows = c.select("conv_id", "turn", F.when(F.col("turn") % 4 == 0, F.col("text")).alias("vqa_pair"), F.when(F.col("turn") % 4 == 1, "").when(F.col("turn") % 4 == 2, F.concat("role", F.lit(": "), "text")).alias("messages"), F.when(F.col("turn") % 3 == 0, F.col("text")).alias("content"), F.col("role").alias("context"))
    return stages.normalize_document(rows).select("conv_id", "turn", "document.text", "document.source_name", F.sha2("document.text", 256).alias("digest"))


@query("""WITH i AS (SELECT conv_id, turn, 'i' || turn AS id, text, ['i' || (turn - 1), 'i' || (turn + 1), 'i' || turn, 'i' || (turn - 1), 'zz'] AS deps FROM conversations),
k AS (SELECT conv_id, list(id) AS known FROM i GROUP BY conv_id)
SELECT conv_id, id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1)::INTEGER AS item_order, array_to_string(list_filter(deps, lambda d: list_contains(known, d)), ',') AS dependencies FROM i JOIN k USING (conv_id)""")
def dependency_filter(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    t = F.col("turn")
    own = lambda x: F.concat(F.lit("i"), x.cast("string"))
    item = F.struct(own(t).alias("id"), F.lit("theorem").alias("kind"), F.col("role").alias("name"), F.col("text").alias("statement"), F.lit("").alias("proof"), F.array(own(t - 1), own(t + 1), own(t), own(t - 1), F.lit("zz")).alias("dependencies"))
    rows = c.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text", item.alias("item")))), lambda x: x["item"]).alias("items"))
    out = stages.link_items(rows).select("conv_id", F.explode("math_items").alias("x"))
    return out.select("conv_id", "x.id", F.col("x.order").alias("item_order"), F.array_join("x.dependencies", ",").alias("dependencies"))


@query("SELECT doc_id::VARCHAR AS id, 'exercise' AS kind, length(text)::INTEGER AS span_end, sha256(text) AS statement_digest, 0 AS item_order FROM documents")
def atomic_items(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    x = F.col("math_items")[0]
    out = stages.atomic_items(stages.normalize_document(d))
    return out.select(x["id"].alias("id"), x["kind"].alias("kind"), x["source_span"]["end"].alias("span_end"), F.sha2(x["statement"], 256).alias("statement_digest"), x["order"].alias("item_order"))


@query("""SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN 'unreviewed' WHEN l.quality = 1 THEN 'correct' ELSE 'incorrect' END AS verdict, l.quality IS NULL OR l.quality = 1 AS accepted FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def blueprint_gate(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    verdict = F.when(F.col("quality").isNull(), "unreviewed").when(F.col("quality") == 1, "correct").otherwise("incorrect")
    return rows.select("doc_id", verdict.alias("verdict"), stages.accepted(verdict).alias("accepted"))


# --- source text ------------------------------------------------------------------------------------------------------
@query(f"WITH {SOURCES_SQL}, {MASK_SQL} SELECT p, code, length(code) AS n FROM masked")
def mask_code(spark, sf_dir):
    return sources_of(spark, sf_dir).select("p", T.mask_code(F.col("content")).alias("code")).withColumn("n", F.length("code").cast("long"))


@query("""WITH src AS (SELECT page_id AS p, html AS content FROM pages), """ + MASK_SQL + " SELECT p, sha256(code) AS digest FROM masked")
def mask_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("p"), F.sha2(T.mask_code(F.col("html")), 256).alias("digest"))


@query(f"""WITH {SOURCES_SQL}, {MASK_SQL}, h AS (SELECT path, content, code, strpos(code, 'sorry') AS a, strpos(code, 'admit') AS b FROM masked),
o AS (SELECT path, content, a - 1 AS "offset" FROM h WHERE a > 0 UNION ALL SELECT path, content, b - 1 FROM h WHERE b > 0)
SELECT path, ("offset")::INTEGER AS "offset", (length(content[1:"offset"]) - length(replace(content[1:"offset"], chr(10), '')) + 1)::INTEGER AS line FROM o""")
def hole_inventory(spark, sf_dir):
    return projects.holes(sources_of(spark, sf_dir).select("path", "content"))


@query(f"""WITH {SOURCES_SQL}, {MASK_SQL},
l AS (SELECT path, unnest(string_split(code, chr(10))) AS text, generate_subscripts(string_split(code, chr(10)), 1)::INTEGER AS line FROM masked),
w AS (SELECT path, line, text, CASE WHEN regexp_matches(text, '\\bsorry\\b') THEN 'sorry' WHEN regexp_matches(text, '\\badmit\\b') THEN 'admit' WHEN regexp_matches(text, '^\\s*axiom\\b') THEN 'axiom' WHEN regexp_matches(text, '^\\s*unsafe\\b') THEN 'unsafe' END AS kind FROM l),
b AS (SELECT *, max(CASE WHEN trim(text) <> '' THEN line END) OVER (PARTITION BY path ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS filled FROM w)
SELECT path, kind, (CASE WHEN kind IN ('axiom', 'unsafe') THEN coalesce(filled, 0) + 1 ELSE line END)::INTEGER AS line FROM b WHERE kind IS NOT NULL""")
def escape_hatches(spark, sf_dir):
    return projects.escape_hatches(sources_of(spark, sf_dir).select("path", "content"))


@query(f"""WITH o AS (SELECT e, {OUTPUT} AS output FROM (SELECT event_id AS e FROM events)), l AS (SELECT e, unnest(string_split(right(output, 30000), chr(10))) AS text FROM o)
SELECT e, count(*) FILTER (regexp_matches(text, '\\berror(\\([^)]*\\))?:')) AS n_errors FROM l GROUP BY e""")
def error_count(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("e"))
    return e.select("e", T.count_errors(F.expr(OUTPUT)).cast("long").alias("n_errors"))


SIGNATURES_SQL = f"""{SOURCES_SQL},
d AS (SELECT project, path, 'N' || p % 7 || '.t' || p % 50 AS name, 'theorem t' || p % 50 || ' (x : Nat) : x = ' || p % 5 AS statement, strpos(content, 'theorem t') AS start FROM src
  UNION ALL SELECT project, path, 'N' || p % 7 || '.s' || p % 11, 'def s' || p % 11, strpos(content, 'def s') FROM src),
sig AS (SELECT project, path, name, sha256(statement) AS signature, row_number() OVER (PARTITION BY project, name ORDER BY path, start) AS k FROM d)"""


@query(f"WITH {SIGNATURES_SQL} SELECT project, path, CASE WHEN k = 1 THEN name ELSE name || '#' || k END AS key, signature FROM sig")
def signature_inventory(spark, sf_dir):
    return signatures.inventory(sources_of(spark, sf_dir)).select("project", "path", "key", "signature")


@query(f"""WITH {SOURCES_SQL},
changed AS (SELECT project, CASE WHEN project % 2 = 1 THEN replace(content, '(x : Nat)', '(y : Nat)') ELSE content END AS after, content FROM src),
d AS (SELECT project, unnest(regexp_extract_all(content, '(?:theorem|def)[^\\n]*?:=')) AS a, unnest(regexp_extract_all(after, '(?:theorem|def)[^\\n]*?:=')) AS b FROM changed)
SELECT project, list(a ORDER BY a) = list(b ORDER BY b) AS signatures_frozen FROM d WHERE starts_with(a, 'theorem') OR starts_with(a, 'def') GROUP BY project""")
def signature_freeze(spark, sf_dir):
    files = sources_of(spark, sf_dir)
    changed = F.when(F.col("project") % 2 == 1, F.regexp_replace("content", r"\(x : Nat\)", "(y : Nat)")).otherwise(F.concat("content", F.lit("-- moved\n")))
    after = files.withColumn("content", changed).withColumn("path", F.concat(F.lit("Other/"), "path"))
    return signatures.frozen(signatures.inventory(files), signatures.inventory(after))


#: A part's statement with a proof of its own, and a proof to install: indented by its key, under an outer `by` or not.
STATED = f"concat('theorem t : ', p_brand, ' := by', {NL}, '  let y := by exact 1', {NL}, '  sorry', {NL})"
PROOF = f"""concat(CASE WHEN p_partkey % 2 = 0 THEN concat('by', {NL}) ELSE '' END, repeat(' ', CAST(p_partkey % 5 AS INTEGER)), 'intro x', {NL}, repeat(' ', CAST(p_partkey % 5 + 2 AS INTEGER)), 'exact ', p_size, {NL})"""


@query(f"""WITH t AS (SELECT p_partkey AS p, {STATED} AS source, {PROOF} AS proof FROM part), l AS (SELECT p, source, list_filter(string_split(proof, chr(10)), lambda x: trim(x) <> '' AND x <> 'by') AS lines FROM t),
d AS (SELECT p, source, lines, list_min(list_transform(lines, lambda x: length(x) - length(ltrim(x)))) AS indent FROM l)
SELECT p, split_part(source, ':= by', 1) || ':= by' AS prefix, split_part(source, ':= by', 1) || ':= by' || chr(10) || array_to_string(list_transform(lines, lambda x: '  ' || x[indent + 1:]), chr(10)) || chr(10) AS installed FROM d""")
def install_proof(spark, sf_dir):
    t = table(spark, sf_dir, "part").selectExpr("p_partkey AS p", f"{STATED} AS source", f"{PROOF} AS proof")
    return t.select("p", T.statement_prefix(F.col("source")).alias("prefix"), T.install_proof(F.col("source"), F.col("proof")).alias("installed"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE props END AS body, CASE WHEN event_id % 3 = 2 THEN NULL ELSE (props->>'k')::BIGINT END AS k FROM events""")
def json_object(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    answer = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, F.concat(F.lit(" ```json\n"), "props", F.lit("```\n"))).otherwise(F.concat(F.lit("["), "props", F.lit("]")))
    body = T.json_object(answer)
    return e.select("event_id", body.alias("body"), F.get_json_object(body, "$.k").cast("long").alias("k"))


# --- projects ---------------------------------------------------------------------------------------------------------
@query("""WITH b AS (SELECT l_orderkey AS project, 'F' || l_linenumber || '.lean' AS path, l_shipdate::VARCHAR AS content FROM lineitem), n AS (SELECT l_orderkey AS project, 'F' || (l_linenumber + 1) || '.lean' AS path, l_returnflag AS content FROM lineitem WHERE l_linenumber > 2)
SELECT coalesce(b.project, n.project) AS project, coalesce(b.path, n.path) AS path, CASE WHEN n.content IS NOT NULL THEN n.content ELSE 'old' END AS content FROM b FULL JOIN n ON b.project = n.project AND b.path = n.path""")
def files_overlay(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("project"), "l_linenumber", F.col("l_returnflag").alias("flag"))
    name = lambda x: F.concat(F.lit("F"), x.cast("string"), F.lit(".lean"))
    base = l.select("project", name(F.col("l_linenumber")).alias("path"), F.lit("old").alias("content"))
    patch = l.where("l_linenumber > 2").select("project", name(F.col("l_linenumber") + 1).alias("path"), F.col("flag").alias("content"))
    return projects.overlay(base, patch)


@query("SELECT l_orderkey AS project, 'F' || l_linenumber AS path FROM lineitem WHERE NOT (l_linenumber IN (2, 4) AND l_orderkey % 2 = 0)")
def files_delete(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("project"), F.concat(F.lit("F"), F.col("l_linenumber").cast("string")).alias("path"))
    return projects.delete(l, l.where("project % 2 = 0").where(F.col("path").isin("F2", "F4")))


TREE_SQL = """f AS (SELECT p_partkey % 40 AS project, CASE WHEN p_partkey % 5 = 0 THEN 'Root' || p_partkey % 3 || '.lean' WHEN p_partkey % 5 = 1 THEN 'Root' || p_partkey % 2 || '/A' || p_partkey || '.lean' WHEN p_partkey % 5 = 2 THEN '.lake/x' || p_partkey || '.lean'
  WHEN p_partkey % 5 = 3 THEN 'lakefile.lean' ELSE 'B-' || p_partkey || '.lean' END AS path FROM part)"""


def tree_of(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"))
    s = lambda x: x.cast("string")
    k = F.col("k")
    path = F.when(k % 5 == 0, F.concat(F.lit("Root"), s(k % 3), F.lit(".lean"))).when(k % 5 == 1, F.concat(F.lit("Root"), s(k % 2), F.lit("/A"), s(k), F.lit(".lean"))).when(k % 5 == 2, F.concat(F.lit(".lake/x"), s(k), F.lit(".lean"))).when(k % 5 == 3, F.lit("lakefile.lean")).otherwise(F.concat(F.lit("B-"), s(k), F.lit(".lean")))
    return p.select((k % 40).alias("project"), path.alias("path"))


@query(f"""WITH {TREE_SQL}, d AS (SELECT DISTINCT project, split_part(path, '/', 1) AS stem FROM f WHERE contains(path, '/'))
SELECT f.project, f.path FROM f WHERE NOT (path LIKE '.lake/%' OR path = 'lakefile.lean') AND NOT EXISTS (SELECT 1 FROM d WHERE d.project = f.project AND f.path = d.stem || '.lean')""")
def module_files(spark, sf_dir):
    return projects.module_files(tree_of(spark, sf_dir))


@query(f"""WITH {TREE_SQL} SELECT DISTINCT path, CASE WHEN path LIKE 'Root%' THEN replace(replace(path, '.lean', ''), '/', '.') WHEN path = 'lakefile.lean' THEN 'lakefile' WHEN path LIKE '.lake/%' THEN '«.lake».' || replace(path[7:], '.lean', '') ELSE '«' || replace(path, '.lean', '') || '»' END AS module FROM f""")
def module_names(spark, sf_dir):
    return tree_of(spark, sf_dir).select("path").distinct().select("path", T.module_name(F.col("path")).alias("module"))


@query("""WITH x AS (SELECT p_partkey AS p, CASE p_partkey % 4 WHEN 0 THEN 'A/B' || p_partkey || '.lean' WHEN 1 THEN '../x.lean' WHEN 2 THEN '/abs/x.lean' ELSE 'A/x.txt' END AS path FROM part) SELECT p, path, left(path, 1) <> '/' AND NOT list_contains(string_split(path, '/'), '..') AND regexp_matches(path, '(^|/)[^/]+[.]lean$') AS safe FROM x""")
def path_safety(spark, sf_dir):
    k = F.col("p_partkey")
    path = F.when(k % 4 == 0, F.concat(F.lit("A/B"), k.cast("string"), F.lit(".lean"))).when(k % 4 == 1, "../x.lean").when(k % 4 == 2, "/abs/x.lean").otherwise("A/x.txt")
    return table(spark, sf_dir, "part").select(k.alias("p"), path.alias("path"), T.safe_path(path).alias("safe"))


@query("SELECT doc_id, (length(text) - length(replace(text, chr(10), '')) + CASE WHEN text = '' OR right(text, 1) = chr(10) THEN 0 ELSE 1 END)::INTEGER AS n_lines FROM documents WHERE length(text) - length(replace(text, chr(10), '')) + CASE WHEN text = '' OR right(text, 1) = chr(10) THEN 0 ELSE 1 END > 8")
def large_files(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("D"), F.col("doc_id").cast("string"), F.lit(".lean")).alias("path"), F.col("text").alias("content"))
    return projects.large_files(d, 8).select("doc_id", "n_lines")


# --- retrieval --------------------------------------------------------------------------------------------------------
TERMS_SQL = """q AS (SELECT item_id AS query_id, text AS query FROM benchmark),
tt AS (SELECT DISTINCT query_id, unnest(regexp_extract_all(query, '[A-Za-z][A-Za-z0-9_]{3,}')) AS term FROM q),
ranked AS (SELECT query_id, term, row_number() OVER (PARTITION BY query_id ORDER BY length(term) DESC, term) AS k FROM tt WHERE term NOT IN ('theorem','lemma','have','exact','import','Mathlib','open','Polynomial','Show','that','sorry','integrally','closed')),
terms AS (SELECT query_id, term, k FROM ranked WHERE k <= 8)"""


@query(f"WITH {TERMS_SQL} SELECT query_id, (k - 1)::INTEGER AS pos, term FROM terms")
def retrieval_terms(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.posexplode(retrieval.terms(F.col("text"))).alias("pos", "term"))


@query(f"""WITH {TERMS_SQL}, l AS (SELECT doc_id AS path, unnest(string_split(regexp_replace(text, '\\n$', ''), chr(10))) AS text, generate_subscripts(string_split(regexp_replace(text, '\\n$', ''), chr(10)), 1) AS line FROM documents),
h AS (SELECT DISTINCT query_id, path, line, text FROM l JOIN terms ON contains(l.text, terms.term)),
a AS (SELECT *, row_number() OVER (PARTITION BY query_id, path ORDER BY line) AS k FROM h),
b AS (SELECT query_id, path, line, text, row_number() OVER (PARTITION BY query_id ORDER BY path, line) AS rank FROM a WHERE k <= 2)
SELECT query_id, path, line::INTEGER AS line, text, rank::INTEGER AS rank FROM b WHERE rank <= 20""")
def retrieval_topk(spark, sf_dir):
    corpus = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.col("text").alias("content"))
    cores = spark.sparkContext.defaultParallelism
    lines = retrieval.corpus_lines(corpus, tasks=cores if corpus.rdd.getNumPartitions() < cores else None)
    return retrieval.search(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query")), lines)


@query("""WITH l AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '\\n$', ''), chr(10))) AS text, generate_subscripts(string_split(regexp_replace(text, '\\n$', ''), chr(10)), 1) AS i FROM documents)
SELECT doc_id, coalesce(string_agg(i || ': ' || text, chr(10) ORDER BY i) FILTER (i >= greatest(1, doc_id % 5 - 1) AND i <= least(doc_id % 9, doc_id % 5 - 1 + 400)), '') AS shown FROM l GROUP BY doc_id""")
def read_range(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.read_range(F.col("text"), F.col("doc_id") % 5 - 1, F.col("doc_id") % 9).alias("shown"))


# --- audit ------------------------------------------------------------------------------------------------------------
HATCHES_SQL = """hatches AS (
  SELECT DISTINCT project FROM (SELECT project, unnest(string_split(code, chr(10))) AS line FROM masked) WHERE regexp_matches(line, '\\b(sorry|admit)\\b|^\\s*(axiom|unsafe)\\b'))"""


def audit_projects(spark, sf_dir) -> DataFrame:
    """Projects by the hundred's remainder and by whether a part's file has hatches at all, so that some are clean."""
    return sources_of(spark, sf_dir).withColumn("project", F.when((F.col("p") % 6 > 1) & (F.col("p") % 4 > 1), F.col("project")).otherwise(F.col("project") + 1_000))


AUDIT_SRC_SQL = f"src AS (SELECT p, CASE WHEN p % 6 > 1 AND p % 4 > 1 THEN project ELSE project + 1000 END AS project, path, content FROM (SELECT p, p % 100 AS project, 'Book/F' || p || '.lean' AS path, {SOURCE_DUCK} AS content FROM (SELECT p_partkey AS p FROM part)))"


@query(f"""WITH {AUDIT_SRC_SQL}, {MASK_SQL}, {HATCHES_SQL}, x AS (SELECT project, count(DISTINCT p) AS source_coverage FROM src GROUP BY project)
SELECT x.project, x.project % 3 = 0 AND x.project % 5 > 0 AND x.project NOT IN (SELECT project FROM hatches) AND x.project % 2 = 0 AND x.project % 7 > 0 AS passed, source_coverage FROM x""")
def audit_gate(spark, sf_dir):
    files = audit_projects(spark, sf_dir)
    rows = files.groupBy("project").agg(F.count_distinct("p").alias("source_coverage"))
    p = F.col("project")
    gate = stages.audit_gate(F.when(p % 3 == 0, 0).otherwise(1), F.when(p % 5 == 0, 1).otherwise(0), F.col("n_findings"), p % 2 == 0, F.when(p % 7 == 0, 1).otherwise(0), F.lit("clean"))
    found = projects.escape_hatches(files.select("project", "content")).groupBy("project").agg(F.count("*").alias("n_findings"))
    return rows.join(found, "project", "left").withColumn("n_findings", F.coalesce("n_findings", F.lit(0))).select("project", gate.alias("passed"), "source_coverage")


@query(f"""WITH {AUDIT_SRC_SQL}, {MASK_SQL}, {HATCHES_SQL},
h AS (SELECT project, sum(len(regexp_extract_all(code, '\\b(sorry|admit)\\b')))::INTEGER AS holes, count(*) AS source_coverage FROM masked GROUP BY project)
SELECT project, holes, source_coverage, 0 AS exit_code, true AS signatures_frozen, holes = 0 AND project NOT IN (SELECT project FROM hatches) AS passed FROM h""")
def audit_evidence(spark, sf_dir):
    """The audit itself over all projects, nothing changed since the statements were frozen, by the offline verifier."""
    from veriloom.operators.verifier import OfflineVerifier
    from veriloom.plans import pipelines

    files = audit_projects(spark, sf_dir)
    own = files.select("project", "path", "content")
    provenance = files.select("project", F.col("p").alias("item"))
    return pipelines.audit(own, signatures.inventory(own), OfflineVerifier(), provenance).select("project", "holes", "source_coverage", "exit_code", "signatures_frozen", "passed")


@query("""WITH r AS (SELECT l_orderkey AS k, l_linenumber AS n, (l_partkey % 3)::INT AS exit_code, l_suppkey % 2 AS holes, l_partkey % 5 = 0 AS forbidden, l_linenumber % 2 = 0 AS reject FROM lineitem)
SELECT k, n, exit_code = 0 AND (NOT reject OR (holes = 0 AND NOT forbidden)) AS success FROM r""")
def verify_success(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), "l_partkey", "l_suppkey")
    kinds = F.when(F.col("l_partkey") % 5 == 0, F.array(F.lit("sorry"))).otherwise(F.expr("cast(array() as array<string>)"))
    return l.select("k", "n", T.verified(F.col("l_partkey") % 3, kinds, F.col("l_suppkey") % 2, F.col("n") % 2 == 0).alias("success"))


@query(f"""WITH {SOURCES_SQL}, c AS (SELECT p, content, CASE WHEN p % 5 = 0 THEN replace(content, '(x : Nat)', '(y : Nat)') ELSE replace(replace(content, 'sorry', 'trivial'), 'admit', 'trivial') END AS after FROM src)
SELECT p, p % 3 < 2 AND split_part(content, ':= by', 1) = split_part(after, ':= by', 1) AND NOT regexp_matches(after, '\\b(sorry|admit)\\b') AND len(list_filter(string_split(after, chr(10)), lambda x: regexp_matches(x, '^\\s*(axiom|unsafe)\\b'))) = 0 AS success FROM c""")
def raw_success(spark, sf_dir):
    files = sources_of(spark, sf_dir)
    after = F.when(F.col("p") % 5 == 0, F.replace("content", F.lit("(x : Nat)"), F.lit("(y : Nat)"))).otherwise(F.replace(F.replace("content", F.lit("sorry"), F.lit("trivial")), F.lit("admit"), F.lit("trivial")))
    return files.select("p", T.baseline_success(F.when(F.col("p") % 3 < 2, 0).otherwise(1), F.col("content"), after).alias("success"))


#: A statement with a text in its comment.
def _stated(name: str, text: str) -> str:
    bare = f"replace(replace(coalesce({text}, ''), '-/', '- /'), '/-', '/ -')"
    return f"concat('/- ', {bare}, ' -/', {NL}, 'theorem ', {name}, ' : True := by', {NL}, '  sorry', {NL})"


@query(f"""WITH s AS (SELECT p_partkey AS id, {_stated("concat('t', p_partkey)", "p_name")} AS source FROM part), t AS (SELECT id, source, length(source) % 5 AS hit, length(source) % 3 = 0 AS mute FROM s),
u AS (SELECT *, hit BETWEEN 1 AND 3 AND NOT (mute AND hit = 1) AS success FROM t)
SELECT id, success, (CASE WHEN success THEN hit ELSE 3 END)::BIGINT AS attempt_count, (CASE WHEN success THEN hit ELSE 3 END - mute::INT)::BIGINT AS verifier_calls, CASE WHEN success THEN replace(source, '  sorry', '  trivial') ELSE source END AS content FROM u""")
def baseline_run(spark, sf_dir):
    """Whole-proof attempts over a task list with answers that depend on the statement, and the offline verifier."""
    from veriloom.plans import pipelines

    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.expr(_stated("concat('t', p_partkey)", "p_name")).alias("formal_statement"))
    return pipelines.offline_baseline(rows).select(F.col("project").alias("id"), "success", "attempt_count", "verifier_calls", "content")


#: Files of more lines than this are split in book_pipeline (the default is 2,000, which no document reaches).
BOOK_LINES = 8


@query(f"""WITH s AS (SELECT doc_id AS id, coalesce(text, '') AS text, length(coalesce(text, '')) % 11 <> 5 AS named, length(coalesce(text, '')) % 10 <> 0 AS built_at_once FROM documents),
f AS (SELECT *, {_stated("concat(CASE WHEN named THEN 't' ELSE 'other' END, id)", "text")} AS source FROM s),
d AS (SELECT *, length(source) % 7 = 3 AS bad, length(source) - length(replace(source, chr(10), '')) > {BOOK_LINES} AS split_needed FROM f)
SELECT id, ((1 + length(text) - length(replace(text, 'e', ''))) % 3 > 0)::INTEGER AS accepted_blueprints, built_at_once, true AS compiled, CASE WHEN named THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS scc, split_needed, split_needed AND length(source) % 2 = 1 AS split_accepted,
  NOT bad AS success, true AS signatures_frozen, NOT bad AS passed, 1::BIGINT AS source_coverage, CASE WHEN bad THEN 21 ELSE 1 END::BIGINT AS planner_calls, CASE WHEN bad THEN 21 * 10 ELSE 1 END::BIGINT AS executor_calls, CASE WHEN bad THEN 1 + 21 + 1 ELSE 4 END::INTEGER AS verifier_calls FROM d""")
def book_pipeline(spark, sf_dir):
    """The whole book graph over documents with offline providers, whose answers depend on the texts, and the offline verifier."""
    from veriloom.plans import pipelines

    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"), F.col("source").alias("name"))
    made = pipelines.offline_book(rows, max_lines=BOOK_LINES)
    return made.select("id", "accepted_blueprints", "built_at_once", "compiled", "scc", "split_needed", "split_accepted", "success", "signatures_frozen", "passed", "source_coverage", "planner_calls", "executor_calls", "verifier_calls")


@query(f"""WITH b AS (SELECT length({_stated("concat('t', item_id)", "text")}) % 7 = 3 AS bad FROM benchmark)
SELECT count(*) AS attempted, count(*) FILTER (NOT bad) AS solved, count(*) FILTER (bad) AS n_failed, count(*) FILTER (NOT bad)::DOUBLE / count(*) AS psr, (4 * count(*))::BIGINT AS verifier_calls,
  sum(CASE WHEN bad THEN 2 ELSE 1 END)::BIGINT AS planner_calls, sum(CASE WHEN bad THEN 4 ELSE 1 END)::BIGINT AS executor_calls, sum(CASE WHEN bad THEN 32 ELSE 8 END)::BIGINT AS tokens FROM b""")
def benchmark_pipeline(spark, sf_dir):
    """Workspaces of task files, repair loop and audit over a task list with offline providers, whose answers depend on the files, and the offline verifier."""
    from veriloom.plans import pipelines

    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("informal_statement"), F.expr(_stated("concat('t', item_id)", "text")).alias("content"))
    return pipelines.offline_benchmark(items.select("id", "informal_statement"), task_files=items.select("id", "content"))


from veriloom import registry_stores  # noqa: E402, F401  registers the queries over versions, graphs, indexes and stores
