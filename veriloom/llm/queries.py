"""The registered queries of the training-data operators and their SQL. Each query is thin: its rows come from its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import line_dedup, mil_quality, mixing, packing, pii, prefix_trie, quality_rules, secret_scan, simhash, token_store, topk, toxicity, turn_repair
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", "text")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.with_verdict(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *quality_rules.BASE, "base_failed", "kept")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    n = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *n, F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text", "lang"), model)
    return scored.select("doc_id", toxicity.held().alias("held_out"), "score", (F.col("score") >= toxicity.AT).cast("int").alias("predicted"), "toxic")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = mil_quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = mil_quality.score_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", mil_quality.held().alias("held_out"), "score", (F.col("score") >= mil_quality.AT).cast("int").alias("predicted"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_store.new_path(spark)
    manifest = token_store.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_store.read_tokens(spark, path, manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    n = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(secret_scan.KINDS[:3])]
    return found.select("doc_id", *n, F.sha2(secret_scan.joined("base"), 256).alias("base_sha256"), secret_scan.joined("spans").alias("spans"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_turns(table(spark, sf_dir, "conversations"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_line_dedup, op3_topk, op4_quality_rules, op5_pii, op6_toxicity, op7_packing, op8_mil_quality, op9_token_store, op10_mixing, op11_secret_scan, op12_turn_repair,
        op13_prefix_trie,
    )
}

ORACLE: dict[str, str] = {}


ORACLE["op2_line_dedup"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
single AS (
  SELECT doc_id, pos, line, regexp_matches(line, '[^\x20\x09-\x0D]') AS filled, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) AS one FROM split),
masked AS (
  SELECT doc_id, pos, line, filled, CASE WHEN 2 * len(list_filter(string_split(one, ' '), lambda x: regexp_matches(x, '[0-9]'))) <= len(string_split(one, ' '))
         THEN regexp_replace(one, '[^ ]*[0-9][^ ]*', '<*>', 'g') ELSE one END AS m FROM single),
tree AS (
  SELECT 0 AS round, m, tok, concat(len(tok), ' ', array_to_string(tok[1:3], ' ')) AS grp, NULL::VARCHAR AS template
  FROM (SELECT DISTINCT m, string_split(m, ' ') AS tok FROM masked WHERE filled) WHERE len(tok) >= 8
  UNION ALL (
    WITH live AS (SELECT * FROM tree WHERE template IS NULL),
    places AS (SELECT grp, unnest(tok) AS token, generate_subscripts(tok, 1) AS slot FROM live),
    counted AS (SELECT grp, slot, token, count(*) AS c FROM places GROUP BY grp, slot, token),
    per AS (SELECT grp, slot, arg_max(token, c) AS token, max(c) AS top, sum(c) AS size, sum(c * c) AS agree FROM counted GROUP BY grp, slot),
    groups AS (
      SELECT grp, any_value(size) AS size, list(CASE WHEN 2 * top > size THEN token END ORDER BY slot) AS centre,
             (list(slot ORDER BY agree DESC, slot) FILTER (top > 1 AND top < size))[1] AS telling FROM per GROUP BY grp HAVING any_value(size) > 1),
    judged AS (
      SELECT l.*, size, tok[telling] AS branch, 4 * len(list_filter(range(1, len(tok) + 1), lambda i: tok[i] IS DISTINCT FROM centre[i])) <= len(tok) AS fits
      FROM live l JOIN groups USING (grp)),
    ruled AS (SELECT *, 2 * count(*) FILTER (fits) OVER (PARTITION BY grp) > size AS won, count(*) OVER (PARTITION BY grp, branch) > 1 AS shared FROM judged)
    SELECT round + 1, m, tok, CASE WHEN NOT won AND shared THEN concat(grp, '|', branch) ELSE concat(grp, '|') END, CASE WHEN won AND fits THEN grp END
    FROM ruled WHERE won OR branch IS NOT NULL)),
learnt AS (SELECT m, concat('of ', template) AS template FROM tree WHERE template IS NOT NULL),
templates AS (SELECT t.*, len(string_split(t.m, ' ')) AS n, coalesce(l.template, '- ' || t.m) AS template FROM masked t LEFT JOIN learnt l USING (m)),
recurring AS (
  SELECT template, min(doc_id) AS first_doc FROM templates WHERE filled GROUP BY template HAVING count(DISTINCT doc_id) >= CASE WHEN any_value(n) < 8 THEN 10 ELSE 2 END),
marked AS (
  SELECT t.doc_id, t.pos, t.line, t.filled, coalesce(t.filled AND r.first_doc <> t.doc_id, false) AS dropped
  FROM templates t LEFT JOIN recurring r USING (template))
SELECT doc_id, count(*) FILTER (filled) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       CASE WHEN count(*) FILTER (dropped) > 0 AND count(*) FILTER (dropped) = count(*) FILTER (filled) THEN ''
            ELSE string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped) END AS text
FROM marked GROUP BY doc_id
"""

ORACLE["op3_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

ORACLE["op4_quality_rules"] = r"""
WITH w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS eight
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, eight) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, sum(least(8, i - before)) AS n
  FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), i - 8) AS before FROM again) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, w.text, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(w.text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
            OR 2 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > word_chars OR 4 * length(regexp_replace(text, '[^!]', '', 'g')) > n_words) AS kept
FROM b
"""

ORACLE["op10_mixing"] = r"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, ([3, 1, 2])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS weight FROM per),
levels AS (SELECT *, 2.0::DOUBLE * source_size / weight AS at_level FROM weighed),
opened AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - 2.0::DOUBLE * coalesce(sum(source_size) OVER b, 0)::DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level
  FROM levels WINDOW b AS (ORDER BY at_level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen_level AS (SELECT level FROM opened WHERE level <= at_level ORDER BY at_level, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, coalesce((SELECT level FROM chosen_level) * weight, 2.0::DOUBLE * source_size)) AS target FROM levels),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM targets),
drawn AS (
  SELECT s.*, r.source_size, r.target, floor(r.rate)::BIGINT AS whole, r.rate - floor(r.rate) AS part, ('0x' || substr(sha256('mix:' || s.doc_id::VARCHAR), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN u < part THEN 1 ELSE 0 END))::BIGINT AS taken FROM drawn
"""


def _crc32(text: str) -> str:
    """The CRC-32 of a text of ASCII characters, bit by bit."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return f"xor(list_reduce({steps}, lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, 4294967295::BIGINT), 4294967295)"


ORACLE["op12_turn_repair"] = rf"""
WITH RECURSIVE hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations),
broken AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM hit WHERE kind <> 0),
placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS ini, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM broken),
turns AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY k) || ini AS pair FROM placed),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS k, 0 AS s, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS said FROM turns
  UNION ALL
  SELECT conv_id, k, after, min(cost), arg_min(audit, (cost, audit)), arg_min(said, (cost, audit)) FROM (
    SELECT conv_id, k, cost, audit, CASE edit WHEN 'D' THEN here WHEN 'R' THEN CASE here WHEN 2 THEN 3 ELSE 2 END ELSE CASE WHEN here = 0 AND ini = 's' THEN 1 WHEN here <> 2 AND ini = 'u' THEN 2 WHEN here = 2 AND ini = 'a' THEN 3 END END AS after,
           said || CASE edit WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text] ELSE [CASE here WHEN 2 THEN 'assistant:' ELSE 'user:' END || text] END AS said
    FROM (
      SELECT w.conv_id, t.k, t.role, t.text, t.ini, edit, audit || CASE WHEN more THEN 'I' ELSE '' END || edit AS audit, CASE WHEN NOT more THEN s WHEN s = 2 THEN 3 ELSE 2 END AS here,
             said || CASE WHEN NOT more THEN [] WHEN s = 2 THEN ['assistant:'] ELSE ['user:'] END AS said,
             cost + CASE WHEN more THEN 3 ELSE 0 END + CASE edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN edit <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END AS cost
      FROM walk w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.k = w.k + 1, (VALUES ('D'), ('K'), ('R')) AS e(edit), (VALUES (true), (false)) AS i(more)
      WHERE edit = 'D' OR fault IN ('', 'truncated')))
  WHERE after IS NOT NULL GROUP BY conv_id, k, after),
ended AS (
  SELECT conv_id, cost + CASE s WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END AS cost, audit || CASE s WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS audit, said || CASE s WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE [] END AS said
  FROM walk JOIN (SELECT conv_id AS c, max(k) AS n FROM turns GROUP BY conv_id) ON c IS NOT DISTINCT FROM conv_id AND n = k),
best AS (SELECT conv_id, min(cost) AS cost, arg_min(audit, (cost, audit)) AS audit, arg_min(said, (cost, audit)) AS said FROM ended GROUP BY conv_id),
per AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN per p ON p.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLE["op13_prefix_trie"] = rf"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS k FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id AS c, conv_id - conv_id % 20 AS base, {_crc32("conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
built AS (
  SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY own, k) AS d
  FROM (SELECT c, false AS own, k, role, text FROM ids JOIN t ON t.conv_id = base AND k < h UNION ALL SELECT c, true, k, role, text FROM ids JOIN t ON t.conv_id = c AND k >= h)),
member AS (
  SELECT c, d, md5(array_to_string(list(md5(length(role) || ':' || role || text)) OVER (PARTITION BY c ORDER BY d), ',')) AS node, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM built
  UNION ALL SELECT c, 0, '', 0 FROM ids),
nodes AS (SELECT node, any_value(d) AS d, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM member GROUP BY node),
ups AS (SELECT n.node, m.node AS up, n.d - m.d AS away, n.n_convs, n.words FROM nodes n JOIN member m ON m.c = n.conv_id AND m.d <= n.d),
kids AS (SELECT up AS node, count(*) AS n FROM ups WHERE away = 1 GROUP BY up),
sums AS (
  SELECT up AS node, sum((n_convs - 1) * words)::BIGINT AS saved_tokens, count(*) FILTER (kids.n IS NULL) AS n_leaves FROM ups LEFT JOIN kids ON kids.node = ups.node GROUP BY up),
ends AS (SELECT node, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM member JOIN (SELECT c AS e, max(d) AS last FROM member GROUP BY c) ON e = c AND d = last GROUP BY node)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN sums USING (node) LEFT JOIN kids USING (node) LEFT JOIN ends USING (node) LEFT JOIN ups u ON u.node = n.node AND u.away = 1 LEFT JOIN nodes p ON p.node = u.up
"""
