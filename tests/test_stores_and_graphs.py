"""Versions, repair as a stream, import graphs, the trigram index, the answer log, JSON arrays, keyed results and source trees."""

from __future__ import annotations

import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from veriloom.operators import answers, grams, imports, providers, retrieval, verifier, versions
from veriloom.plans import pipelines, repair_stream
from veriloom.sources import json_array, keyed, storage, tree

rng = random.Random(3)


def files(spark, *rows):
    return spark.createDataFrame(list(rows), "project int, path string, content string")


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


# --- versions ---------------------------------------------------------------------------------------------------------
def test_versions_against_replay(spark, tmp_path):
    log = versions.VersionTable(spark, str(tmp_path / "v"), "project int, path string, content string, version long")
    now, past = {}, []
    for v in range(6):
        change = {(rng.randrange(3), f"F{rng.randrange(4)}"): rng.choice([None, "a", "b", "c"]) for _ in range(5)}
        assert log.commit(files(spark, *[(*k, c) for k, c in change.items()])) == v
        now = {k: c for k, c in (now | change).items() if c is not None}
        past.append(now)
        if v in (2, 4):
            assert log.compact() == v
        for w, then in enumerate(past):
            assert {(r.project, r.path): r.content for r in log.files(w).collect()} == then
        assert {(r.project, r.path): r.content for r in log.files().collect()} == now
    table = versions.intervals(log.log())
    for w, then in enumerate(past):
        assert {(r.project, r.path): r.content for r in versions.at(table, w).collect()} == then
    assert "Exchange" not in versions.at(spark.read.parquet(f"{tmp_path}/v/base-{4:012d}"), 3)._jdf.queryExecution().executedPlan().toString()
    each = spark.createDataFrame([(0, 1), (1, 4)], "project int, version long")
    assert {(r.project, r.path): r.content for r in versions.as_of(log.log(), each).collect()} == {k: c for k, c in past[1].items() if k[0] == 0} | {k: c for k, c in past[4].items() if k[0] == 1}


def test_versions_cost_what_they_change(spark, tmp_path):
    big = files(spark, *[(1, f"F{k}", f"{k} " * 2_000) for k in range(100)])
    log = versions.VersionTable(spark, str(tmp_path / "v"), "project int, path string, content string, version long")
    log.commit(big)
    first = size_of(tmp_path)
    for v in range(3):
        after = log.files().withColumn("content", F.when(F.col("path") == f"F{v}", "new").otherwise(F.col("content")))
        log.commit(versions.changes(log.files(), after, v + 1))
    assert size_of(tmp_path) - first < 0.2 * first and log.files().where("content = 'new'").count() == 3
    # a commit that breaks off leaves no version; a repeated one replaces its own
    with pytest.raises(Exception, match="broken"):
        log.commit(big.withColumn("content", F.raise_error(F.lit("broken"))))
    assert log.versions() == [0, 1, 2, 3]
    log.commit(files(spark, (1, "F9", "again")), 3)
    log.commit(files(spark, (1, "F9", "again")), 3)
    assert log.files().where("content = 'again'").count() == 1 and log.files(2).where("content = 'again'").count() == 0


# --- repair -----------------------------------------------------------------------------------------------------------
class Recorded:
    """Answers by project and by how often it was asked; a stand-in for a model, its calls counted."""

    def __init__(self, answers, stop_at=None):
        self.answers, self.calls, self.stop_at, self.batches = answers, {}, stop_at, 0

    def __call__(self, rows):
        self.batches += 1
        if self.stop_at is not None and self.batches > self.stop_at:
            raise RuntimeError("the power failed")
        out = []
        for r in rows.collect():
            k = self.calls[r.project] = self.calls.get(r.project, 0) + 1
            out.append((r.project, self.answers(r.project, k), 3))
        return rows.sparkSession.createDataFrame(out, "project int, text string, tokens int")


def patch(**content):
    return json.dumps({"files": [{"path": f"{p}.lean", "content": c} for p, c in content.items()]})


def recorded(project, k):
    """Attempts that are accepted, kept as drafts, raise, change statements, or never end."""
    two = "theorem a : True := by\n  {}\ntheorem b : True := by\n  {}\n"
    script = {
        1: [patch(A=two.format("trivial", "trivial"))],
        2: [patch(A=two.format("trivial", "sorry")), "no JSON", patch(A=two.format("trivial", "trivial"))],
        3: [patch(A="broken\n" + two.format("trivial", "sorry")), patch(A="broken\n" + two.format("trivial", "trivial"), B="-- helper\n"), patch(A=two.format("trivial", "trivial"))],  # drafts first
        4: [patch(A=two.format("trivial", "trivial").replace("True", "False"))] * 9,
        5: ['{"files": [{"path": "../x.lean", "content": ""}]}', patch(), patch(A=two.format("sorry", "sorry"), C="-- note\n")],
    }[project]
    return script[min(k, len(script)) - 1]


def repair_files(spark):
    two = "theorem a : True := by\n  sorry\ntheorem b : True := by\n  sorry\n"
    return files(spark, *[(p, "A.lean", two) for p in range(1, 6)], *[(p, "Other.lean", "def o := 1\n" * 50) for p in range(1, 6)], (6, "A.lean", "def done := 1\n"))


@pytest.fixture(scope="module")
def repaired(spark):
    plan, propose = Recorded(lambda p, k: f"plan {k}"), Recorded(recorded)
    return [rows_of(x) for x in pipelines.repair(repair_files(spark), plan, propose, verifier.OfflineVerifier(), pipelines.Budget(2, 2))], plan.calls, propose.calls


def test_repair_writes_what_it_changes(repaired):
    (done, verdicts, trace), _, calls = repaired
    content = {(p, path): c for p, path, c in done}
    assert all("sorry" not in content[p, "A.lean"] for p in (1, 2, 3)) and content[3, "B.lean"] == "-- helper\n" and (5, "C.lean") not in content
    assert {(r[0], r[1], r[2]): r[3:6] for r in trace if r[0] == 3} == {(3, 1, 1): (False, True, None), (3, 1, 2): (False, True, None), (3, 2, 1): (True, False, None)}
    assert calls == {1: 1, 2: 3, 3: 3, 4: 4, 5: 4} and len(verdicts) == 6


def test_repair_stream_is_repair(spark, tmp_path, repaired):
    plan, propose = Recorded(lambda p, k: f"plan {k}"), Recorded(recorded)
    got = repair_stream.repair_stream(repair_files(spark), plan, propose, verifier.OfflineVerifier(), f"file://{tmp_path}/run", pipelines.Budget(2, 2))
    assert [rows_of(x) for x in got] == repaired[0] and (plan.calls, propose.calls) == repaired[1:]
    # again over a finished run: the same, nothing asked
    again = repair_stream.repair_stream(repair_files(spark), None, None, verifier.OfflineVerifier(), f"file://{tmp_path}/run", pipelines.Budget(2, 2))
    assert [rows_of(x) for x in again] == repaired[0]


def test_repair_stream_goes_on_after_a_stop(spark, tmp_path, repaired):
    plan, propose = Recorded(lambda p, k: f"plan {k}"), Recorded(recorded, stop_at=2)
    run = lambda: repair_stream.repair_stream(repair_files(spark), plan, propose, verifier.OfflineVerifier(), f"file://{tmp_path}/run", pipelines.Budget(2, 2))
    with pytest.raises(Exception, match="power failed"):
        run()
    propose.stop_at = None
    assert [rows_of(x) for x in run()] == repaired[0] and propose.calls == repaired[2]  # no answered question was asked again


# --- imports ----------------------------------------------------------------------------------------------------------
def graph_files(spark, graph, project=1):
    return [(project, f"{m}.lean", "".join(f"import {x}\n" for x in to) + f"def d{m} := 1\n") for m, to in graph.items()]


def brute_levels(graph):
    graph = {m: {x for x in to if x in graph} for m, to in graph.items()}
    reach = {m: set() for m in graph}
    for _ in graph:
        reach = {m: set(to) | {y for x in to for y in reach[x]} for m, to in graph.items()}
    loops = {m for m in graph if m in reach[m]}
    held = {m for m in graph if m in loops or reach[m] & loops}
    level = lambda m: max((level(x) + 1 for x in graph[m]), default=0)
    between = {m for m in held if (m in loops or reach[m] & loops) and (m in loops or any(m in reach[x] for x in loops))}
    return {m: (None if m in held else level(m), m in between) for m in graph}


def test_import_levels_and_affected(spark):
    for _ in range(2):
        names = [f"M{k}" for k in range(14)]
        graph = {m: rng.sample([*names[:k], "Mathlib"] if rng.random() < 0.93 else names, k=min(k, rng.randrange(3))) for k, m in enumerate(names)}
        frame = files(spark, *graph_files(spark, graph), *graph_files(spark, {"M0": ["M1"], "M1": []}, 2))
        edges = imports.edges(frame)
        got = {(r.project, r.module): (r.level, r.on_cycle) for r in imports.levels(imports.modules(frame), edges).collect()}
        assert got == {(1, m): x for m, x in brute_levels(graph).items()} | {(2, "M0"): (1, False), (2, "M1"): (0, False)}
        changed = {"M3", "M5"}
        want = set(changed)
        while more := {m for m, to in graph.items() if want & set(to)} - want:
            want |= more
        found = imports.affected(edges, spark.createDataFrame([(1, m) for m in changed], "project int, module string")).collect()
        assert {r.module for r in found} == want and len(found) == len(want)
    text = '/- import A\n-/ import B\n  import C D\n-- import E\ndef s := "import F"\n'
    named = files(spark, (1, "X.lean", text), *[(1, f"{m}.lean", "") for m in "ABCDEF"], (2, "C.lean", ""))
    assert {(r.module, r.imports) for r in imports.edges(named).collect()} == {("X", "B"), ("X", "C"), ("X", "D")}
    long = {f"L{k}": [f"L{k - 1}"] if k else [] for k in range(40)}
    chain = files(spark, *graph_files(spark, long))
    assert {r.module: r.level for r in imports.levels(imports.modules(chain), imports.edges(chain)).collect()} == {f"L{k}": k for k in range(40)}


def test_build_checks_what_changed(spark, tmp_path):
    graph = {"A": [], "B": ["A"], "C": ["B"], "D": [], "E": ["F"], "F": ["E"]}
    first = imports.build(files(spark, *graph_files(spark, graph)), verifier.OfflineVerifier())
    assert {r.path: (r.exit_code, r.reused) for r in first.collect()} == {f"{m}.lean": (int(m in "EF"), False) for m in graph}
    rows = [(p, path, c + "broken\n" if path == "B.lean" else c) for p, path, c in graph_files(spark, graph)]
    counted = str(tmp_path / "calls")
    said = verifier.ProcessVerifier(("true",), file_argv=("sh", "-c", f'echo "$0" >> {counted}; test -f A.lean; ! grep broken "$0"'))
    second = imports.build(files(spark, *rows), said, first)
    assert {r.path: (r.exit_code, r.reused) for r in second.collect()} == {"A.lean": (0, True), "B.lean": (1, False), "C.lean": (0, False), "D.lean": (0, True), "E.lean": (1, False), "F.lean": (1, False)}
    assert open(counted).read().split() == ["B.lean", "C.lean"]  # lower levels first, each once


# --- search -----------------------------------------------------------------------------------------------------------
WORDS = ["alpha", "beta", "gamma", "delta", "lemma", "theorem", "𝒪mega", "x", "ab", "42"]


def expression():
    w = lambda: rng.choice(WORDS)
    part = lambda: rng.choice([w(), f"({w()}|{w()})", f"{w()}?", f"({w()})+", f"({w()})*", ".", r"\w+", r"\b", "[abc]", "[a-z]", f"(?:{w()}{w()}|{w()})", f"{w()[0]}{{2}}", "^", " ", f"(?i:{w()})", f"(?={w()})", "[^a]"])
    return "".join(part() for _ in range(rng.randint(1, 4)))


def test_regex_index_against_a_scan(spark, tmp_path):
    texts = {k: "\n".join(" ".join(rng.choice(WORDS) + rng.choice(["", "", "s", ","]) for _ in range(rng.randrange(7))) for _ in range(rng.randrange(6))) for k in range(60)}
    asked = {k: expression() for k in range(1_000)}
    asked[1_000], asked[1_001] = None, "zzzz"
    index = grams.GramIndex(spark, str(tmp_path / "index"), parts=8)
    index.write(spark.createDataFrame([(f"f{k}", t) for k, t in texts.items()] + [("null", None)], "path string, content string"))
    queries = spark.createDataFrame(list(asked.items()), "query_id int, pattern string")
    lines = retrieval.corpus_lines(spark.createDataFrame([(f"f{k}", t) for k, t in texts.items()], "path string, content string"))
    want = {tuple(r) for r in lines.join(F.broadcast(queries), F.regexp_like("text", F.col("pattern"))).select("query_id", "path", "line").collect()}
    got = [tuple(r) for r in index.search(queries).select("query_id", "path", "line").collect()]
    assert set(got) == want and len(got) == len(want)
    helped = [p for p in asked.values() if p is not None and grams.needs(p) is not None]
    assert len(helped) > 300
    # every match holds an alternative's trigrams
    for p in helped[:200]:
        for t in texts.values():
            for line in t.split("\n"):
                if re.search(p, line):
                    assert any(all(g in line for g in need) for need in grams.needs(p))
    # only folders that hold the trigrams and candidates are read
    few = index.search(spark.createDataFrame([(1, "gamma")], "query_id int, pattern string"))
    plan = few._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "FileScan" in x and "content#" in x]
    assert scans and all("PartitionFilters: [part" in x or "PartitionFilters: [isnotnull(part" in x for x in scans)
    assert {"trigrams": grams.needs("abcd.*xyz"), "either": grams.needs("(abc|xyz)1"), "no": grams.needs("ab.*cd")} == {"trigrams": [{"abc", "bcd", "xyz"}], "either": [{"abc", "bc1"}, {"xyz", "yz1"}], "no": None}


# --- answers ----------------------------------------------------------------------------------------------------------
def test_answer_log(spark, tmp_path):
    counted = str(tmp_path / "calls")

    def answer(prompt):
        with open(counted, "a") as f:
            f.write(f"{prompt}\n")
        if prompt == "bad":
            raise TimeoutError("late")
        return prompt.upper()

    log = answers.AnswerLog(spark, f"file://{tmp_path}/log")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, "bad")], "id int, q string")
    got = {r.id: (r.response.text, r.response.error) for r in log.generate(rows, providers.Rule(answer), "s", "q").collect()}
    assert got == {1: ("A", None), 2: ("B", None), 3: ("A", None), 4: ("", None), 5: (None, "TimeoutError: late")}
    assert sorted(open(counted).read().split("\n")) == ["", "", "a", "b", "bad"]  # equal questions are one call
    log.generate(rows, providers.Rule(answer), "s", "q")
    assert open(counted).read().split().count("a") == 1 and open(counted).read().split().count("bad") == 2  # failures are asked again
    log.generate(rows, providers.Rule(answer), "another system", "q")
    log.generate(rows, providers.Rule(answer, model="other"), "s", "q", schema={"type": "object"})
    assert open(counted).read().split().count("a") == 3
    assert not storage.children(spark, f"file://{tmp_path}/log/pieces") and log.answers().count() == 9


def test_a_killed_task_loses_calls_in_flight_only(spark, tmp_path):
    counted, kill = str(tmp_path / "calls"), tmp_path / "kill"
    kill.write_text("")

    def answer(prompt):
        with open(counted, "a") as f:
            f.write(f"{prompt}\n")
        if prompt == "q7" and os.path.exists(kill):
            os._exit(1)
        return prompt

    log = answers.AnswerLog(spark, f"file://{tmp_path}/log")
    rows = spark.createDataFrame([(k, f"q{k}") for k in range(12)], "id int, q string").coalesce(1)
    with pytest.raises(Exception):
        log.generate(rows, providers.Rule(answer), "s", "q", tasks=1)
    before = len(open(counted).read().split())
    assert 1 <= before <= 12
    kill.unlink()
    got = log.generate(rows, providers.Rule(answer), "s", "q", tasks=1)
    calls = open(counted).read().split()
    assert {r.response.text for r in got.collect()} == {f"q{k}" for k in range(12)} and len(calls) == 13 and calls.count("q7") == 2
    os.makedirs(tmp_path / "log" / "pieces" / "run" / "0")
    (tmp_path / "log" / "pieces" / "run" / "0" / "torn.json").write_text('{"key": "k", "te')
    assert log.answers().count() == 12


# --- JSON arrays ------------------------------------------------------------------------------------------------------
ARRAY = [{"id": 1, "s": 'a "quoted", [list] \\ {x}'}, {"id": 2, "s": "é𝒪,\\\\", "more": [[1, [2]], {"k": []}]}, {"id": 3, "s": ""}, {"id": 4, "s": None}]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 10_000])
def test_json_array_cut_anywhere(spark, size):
    texts = {"one": json.dumps(ARRAY), "indented": f"\n{json.dumps(ARRAY, indent=2, ensure_ascii=False)}\n", "empty": " [ ]", "plain": "[1,\"a,]\",null,[[]], -2.5 ]", "nothing": ""}
    rows = [(f, k, 0, t[k : k + size]) for f, t in texts.items() for k in range(0, len(t), size)]
    cut_up = spark.createDataFrame(rows, "file string, range long, k long, piece string").repartition(3)
    got = {}
    for r in json_array.array_elements(cut_up).orderBy("file", "row_pos").collect():
        got.setdefault(r.file, []).append((r.row_pos, json.loads(r.element)))
    assert got == {f: list(enumerate(json.loads(t))) for f, t in texts.items() if t and json.loads(t)}
    with pytest.raises(Exception, match="doesn't end"):
        json_array.array_elements(spark.createDataFrame([("f", 0, 0, '[1, {"a": ')], "file string, range long, k long, piece string")).collect()


def test_inventory_by_ranges_of_a_file(spark, tmp_path):
    rows = [{"id": k, "formal_statement": f"theorem t{k} : a, b := [{k}]", "tag": ["x,y", "]"] * (k % 3)} for k in range(3_000)]
    path = str(tmp_path / "all.json")
    with open(path, "w") as f:
        json.dump(rows, f)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert json_array.pieces(spark, path).select("range").distinct().count() > 5  # several tasks read it
        got = storage.read_inventory(spark, path, "id int, formal_statement string, tag array<string>").orderBy("row_pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert [(r.row_pos, r.id, r.formal_statement, r.tag) for r in got] == [(k, x["id"], x["formal_statement"], x["tag"]) for k, x in enumerate(rows)]
    with open(path, "w") as f:
        f.write('[{"id": 1}, {"id": }]')
    with pytest.raises(Exception):
        storage.read_inventory(spark, path, "id int").collect()


# --- stores -----------------------------------------------------------------------------------------------------------
def test_keyed_results(spark, tmp_path):
    rows = spark.createDataFrame([(k, "é" * k, None if k % 4 else f"lost {k}") for k in range(40)], "id int, said string, error string")
    store = keyed.write_run(rows, f"file://{tmp_path}/run", spark.range(1).selectExpr("40 AS attempted"))
    assert json.loads(store.one("results", "7")) == {"id": 7, "said": "é" * 7} and store.one("errors", "8") == "lost 8" and store.one("results", "8") is None and json.loads(store.one("metrics", "metrics")) == {"attempted": 40}
    assert {r.key: r.body for r in store.read("errors").collect()} == {str(k): f"lost {k}" for k in range(0, 40, 4)} and store.read().count() == 41
    keyed.write_run(rows.limit(3), f"file://{tmp_path}/run", spark.range(1).selectExpr("3 AS attempted"))
    assert store.read().count() == 4  # overwritten as a whole
    # a write that fails leaves what was there
    torn = rows.withColumn("said", F.when(F.col("id") == 30, F.raise_error(F.lit("killed"))).otherwise(F.col("said")))
    with pytest.raises(Exception, match="killed"):
        store.write(torn.select(F.lit("results").alias("kind"), "id", "said").toDF("kind", "key", "body"))
    assert store.read().count() == 4
    traces = spark.createDataFrame([(1, 1, "first"), (1, 2, "second\nline"), (2, 1, None)], "project int, attempt int, trace string")
    kept = keyed.write_traces(traces, f"file://{tmp_path}/traces")
    keyed.write_traces(traces.withColumn("project", F.col("project") + 10), f"file://{tmp_path}/traces")
    assert kept.one("trace", "1/2") == "second\nline" and kept.one("trace", "2/1") == "" and kept.one("trace", "11/1") == "first" and kept.read().count() == 6


def test_a_killed_task_leaves_no_partial_result(spark, tmp_path):
    store = keyed.KeyedResults(spark, f"file://{tmp_path}/run")
    store.write(spark.createDataFrame([("a", "1", "x")], "kind string, key string, body string"))

    def die(batches):
        yield next(batches)
        os._exit(1)

    rows = spark.range(20_000).selectExpr("'a' AS kind", "cast(id AS string) AS key", "'y' AS body").coalesce(1).mapInArrow(die, keyed.SHAPE)
    with pytest.raises(Exception):
        store.write(rows)
    assert rows_of(store.read()) == [("a", "1", "x")]


def test_source_tree_leaves_dependencies_alone(spark, tmp_path):
    for path, text in {"A.lean": "a", "B/C.lean": "é\r\n", "B/D.txt": "no", "B/E/F.lean": "", ".lake/x/G.lean": "lost"}.items():
        os.makedirs(os.path.dirname(tmp_path / path), exist_ok=True)
        (tmp_path / path).write_bytes(text.encode())
    os.mkfifo(tmp_path / ".lake" / "P.lean")  # whoever opens it waits for ever
    assert rows_of(tree.read_sources(spark, str(tmp_path))) == [("A.lean", "a"), ("B/C.lean", "é\r\n"), ("B/E/F.lean", "")]
    assert rows_of(tree.read_sources(spark, f"file://{tmp_path}", partition_bytes=1)) == rows_of(tree.read_sources(spark, str(tmp_path)))
    planned = tree.TreeReader(str(tmp_path), ".lean", 1).partitions()
    assert [p.files for p in planned] == [("A.lean",), ("B/C.lean",), ("B/E/F.lean",)]
    (tmp_path / "empty").mkdir()
    assert tree.read_sources(spark, str(tmp_path / "empty")).collect() == []


# --- prompts, traces, agents, workspaces ------------------------------------------------------------------------------
def test_prompts_hold_what_the_model_needs(spark):
    from veriloom.plans import prompts

    rows = spark.createDataFrame([(1, ("A.lean", 3, 2), "the goal", "lines", "", "source"), (2, None, "said", None, "old plan", None)], "project int, focus struct<path:string,offset:int,line:int>, goal string, retrieval string, prior_plan string, source string")
    got = {r.project: r.p for r in rows.select("project", prompts.plan_prompt().alias("p")).collect()}
    assert got[1] == "## Gap\nA.lean, line 2\n\n## Goal and messages\nthe goal\n\n## Lines of the library\nlines\n\n## File\nsource" and got[2] == "## Goal and messages\nsaid\n\n## Plan so far\nold plan"
    rows = spark.createDataFrame([([("A.lean", 'x "y"')], "plan", "m" * 10_001, None)], "files array<struct<path:string,content:string>>, plan string, feedback string, retrieval string")
    text = rows.select(prompts.patch_prompt().alias("p")).first().p
    assert text == "## Plan\nplan\n\n## Messages\n" + "m" * 10_000 + '\n\n## Files\n[{"path":"A.lean","content":"x \\"y\\""}]'
    rows = spark.createDataFrame([("T.lean", "theorem", 2, "f" * 6_001, "simp", "in words")], "path string, content string, attempt int, feedback string, previous string, said string")
    text = rows.select(prompts.proof_prompt("said").alias("p")).first().p
    assert all(x in text for x in ("T.lean", "theorem", "## Attempt\n2", "simp", "in words", "f" * 6_000)) and "f" * 6_001 not in text


def test_repair_and_baseline_with_providers(spark, tmp_path):
    from veriloom.plans import prompts

    def write(prompt):
        found = json.loads(prompt.split("## Files\n")[1])
        return json.dumps({"files": [{"path": f["path"], "content": f["content"].replace("sorry", "trivial")} for f in found]})

    log = answers.AnswerLog(spark, f"file://{tmp_path}/log")
    frame = files(spark, (1, "A.lean", "theorem a : True := by\n  sorry\n"))
    run = lambda: pipelines.repair(frame, prompts.planner(providers.Rule(lambda p: "plan: " + p.split("\n")[1]), log), prompts.executor(providers.Rule(write), log), verifier.OfflineVerifier(), pipelines.Budget(1, 1))
    done, _, trace = run()
    assert "trivial" in done.first().content and trace.first().accepted and trace.first().planner_tokens > 0
    asked = log.answers().count()
    assert "trivial" in run()[0].first().content and log.answers().count() == asked == 2
    tasks = spark.createDataFrame([(1, "T1.lean", "theorem t : True := by\n  sorry\n"), (2, "T2.lean", "theorem u : True := by\n  sorry\n")], "project int, path string, content string")
    prove = prompts.prover(providers.Rule(lambda p: '{"proof": "trivial", "notes": ""}' if "theorem t" in p or "## Attempt\n2" in p else "no"))
    results, _ = pipelines.baseline(tasks, prove, verifier.OfflineVerifier(), 2, traces=f"file://{tmp_path}/traces")
    assert {r.project: (r.success, r.attempt_count) for r in results.collect()} == {1: (True, 1), 2: (True, 2)}
    kept = keyed.KeyedResults(spark, f"file://{tmp_path}/traces")
    assert {r.key: json.loads(r.body)["text"] for r in kept.read("trace").collect()} == {"1/1": '{"proof": "trivial", "notes": ""}', "2/1": "no", "2/2": '{"proof": "trivial", "notes": ""}'}
    assert "## What the checker said last" not in json.loads(kept.one("trace", "2/1"))["prompt"]


def test_agents_are_told_of_the_last_round():
    class Chat:
        model, seen = "m", []

        def ask(self, messages, **more):
            self.seen.append(([m.get("content") for m in messages], more))
            call = {"id": "1", "function": {"name": "look", "arguments": "{}"}}
            return {"choices": [{"message": {"content": "text", "tool_calls": [call] if len(self.seen) < 3 else []}}]}

    chat = Chat()
    assert providers.ToolAgent(chat, {"look": lambda: "seen"}, [{"name": "look"}], rounds=2).generate("s", "p").text == "text"
    assert [providers.LAST_ROUND in said for said, _ in chat.seen] == [False, False, True] and "tools" not in chat.seen[-1][1]


def test_workspaces_of_task_files(spark):
    from veriloom.plans import stages

    tasks = spark.createDataFrame([(1,), (2,)], "id int")
    given = spark.createDataFrame([("1", "theorem one"), ("3", "theorem three")], "id string, content string")
    got = {(r.project, r.path): r.content for r in stages.workspaces(tasks, {"lakefile.lean": "-- build\n"}, task_files=given).collect()}
    assert got == {(1, "Tasks/1.lean"): "theorem one", (1, "Tasks.lean"): "import Tasks.«1»\n", (1, "lakefile.lean"): "-- build\n"}


def test_ordinal_keeps_clashing_columns(spark):
    from veriloom.operators import tasks

    rows = spark.createDataFrame([(k * 7 % 50, k, "p", k, "b") for k in range(50)], "k int, at int, part string, row int, base string")
    got = tasks.ordinal(rows.withColumn("row_pos", F.lit(9)).repartition(5), ["k"]).collect()
    assert all(r.row_pos == r.k and r.at * 7 % 50 == r.k and r.row == r.at and (r.part, r.base) == ("p", "b") for r in got) and len(got) == 50
    assert tasks.ordinal(rows.limit(0), ["k"]).collect() == []


def test_discard_leaves_other_threads_tables(spark):
    from threading import Thread

    since = storage.mark()
    mine, other = storage.cut(spark.range(2)), []
    thread = Thread(target=lambda: other.append(storage.cut(spark.range(3))))
    thread.start()
    thread.join()
    storage.discard(spark, since)
    assert other[0].count() == 3 and not storage.exists(spark, mine.inputFiles()[0])
