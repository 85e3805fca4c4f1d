"""Behaviour tests of the library's own operators, and its queries against their SQL."""

from __future__ import annotations

import os
import random
import re
import textwrap

import pytest
from pyspark.sql import functions as F

from veriloom import registry
from veriloom.functions import ids as I
from veriloom.functions import text as T
from veriloom.operators import metrics, projects, providers, replay, retrieval, signatures, tasks, verifier
from veriloom.plans import pipelines, stages
from veriloom.sources import storage


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return frame.select(column.alias("x")).first().x


def brute_mask(s):
    out, i, depth, mode = [], 0, 0, "code"
    while i < len(s):
        two, c = s[i : i + 2], s[i]
        if mode == "code" and two in ("--", "/-"):
            mode, depth, step = ("line", 0, 2) if two == "--" else ("block", 1, 2)
            out.append("  ")
        elif mode == "code":
            mode, step = ("string" if c == '"' else "code"), 1
            out.append(c)
        elif mode == "block" and two in ("/-", "-/"):
            depth += 1 if two == "/-" else -1
            mode, step = ("block" if depth else "code"), 2
            out.append("  ")
        elif mode == "string" and c == "\\" and i + 1 < len(s):
            out.append("  ")
            step = 2
        else:
            step = 1
            out.append(c if c == "\n" or (mode == "string" and c == '"') else " ")
            if (mode == "line" and c == "\n") or (mode == "string" and c == '"'):
                mode = "code"
        i += step
    return "".join(out)


def test_mask_against_a_walk(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["/-", "-/", "--", '"', "\\", "\n", "a", "𝒪", "-", "/", " "]) for _ in range(rng.randrange(40))) for _ in range(3_000)]
    texts += ["/-" * 30 + "x" + "-/" * 30 + "y", "/-" * 14 + "-/" * 13 + " z", "", "/- " + "a" * 100_000, '"' + "\\", "-" * 5_000]
    got = [r.m for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", T.mask_code(F.col("t")).alias("m")).orderBy("k").collect()]
    assert got == [brute_mask(t) for t in texts]


def test_nested_comments_and_strings_hide_all_but_one_hole(spark):
    source = '/- sorry /- axiom hidden -/ admit -/\n-- unsafe theorem\n#check "sorry"\ntheorem t : True := by sorry\n'
    assert one(spark, T.count_holes(T.mask_code(F.lit(source)))) == 1
    assert one(spark, T.escape_kinds(T.mask_code(F.lit(source)))) == ["sorry"]
    assert one(spark, T.count_holes(F.lit("sorry₁ sorryα asorry sorry"))) == 1


@pytest.mark.parametrize("source, kind", [("theorem t : True := by sorry", "sorry"), ("by admit", "admit"), ("axiom hidden : False", "axiom"), ("unsafe theorem t : True", "unsafe")])
def test_escape_kinds(spark, source, kind):
    assert one(spark, T.escape_kinds(F.lit(source))) == [kind]


def test_errors_prefix_lines(spark):
    assert one(spark, T.count_errors(F.lit("a.src:1:1: error: bad\na.src:2:2: error(kind.foo): worse\n"))) == 2
    assert one(spark, T.statement_prefix(F.lit("theorem t : True := by\n  let x : Nat := by exact 1\n  trivial\n"))) == "theorem t : True := by"
    with pytest.raises(Exception, match="boundary"):
        one(spark, T.statement_prefix(F.lit("theorem t")))
    assert one(spark, T.line_count(F.lit("a\r\nb\x0bc"))) == 3 and one(spark, T.line_count(F.lit("a\n"))) == 1 and one(spark, T.line_count(F.lit(""))) == 0
    assert one(spark, T.read_range(F.lit("a\nb\nc\n"), F.lit(2), F.lit(9))) == "2: b\n3: c"
    assert one(spark, T.trace_goal(F.lit("x\n  sorry\n"), F.lit(2))) == "x\n  trace_state\n  sorry\n" and one(spark, T.trace_goal(F.lit("x\n"), F.lit(9))) is None
    assert one(spark, T.module_name(F.lit("A/b c/1.lean"))) == "A.«b c».«1»"
    assert [one(spark, T.safe_path(F.lit(p))) for p in ("A/b.lean", "../b.lean", "/b.lean", "b.txt", "a/../b.lean")] == [True, False, False, False, False]
    assert one(spark, T.normal_content(F.lit("a \n\t\n"))) == "a\n"


@pytest.mark.parametrize("proof", ["    intro x\n      exact x\n    done", "by\n  trivial", "by", "trivial", "by\n\n    a\n      b", "  a\n\n  b  \n", "bypass", "\ta\n\t  b"])
def test_install_proof(spark, proof):
    source = "theorem t : True := by\n  sorry\n"
    p = textwrap.dedent(proof).strip()
    if p == "by" or p.startswith("by\n"):
        p = textwrap.dedent(p[2:].lstrip("\n"))
    want = "theorem t : True := by\n" + "\n".join("  " + x if x else x for x in p.splitlines()) + "\n"
    assert one(spark, T.install_proof(F.lit(source), F.lit(proof))) == want


def test_json_object(spark):
    given = {'{"a": 1}': '{"a": 1}', '```json\n{"a": "```"}\n```': '{"a": "```"}\n', " [1] ": None, "no": None, "```json": None}
    for text, want in given.items():
        assert one(spark, T.json_object(F.lit(text))) == want, text


def test_ids(spark):
    assert one(spark, I.parse_ids(F.lit("1,3-5, 10"))) == [1, 3, 4, 5, 10] and one(spark, I.parse_ids(F.lit(""))) is None and one(spark, I.parse_ids(F.lit(None).cast("string"))) is None


RESULTS = "id int, success boolean, attempt_count int, wall_seconds double, attempts array<struct<verifier_calls:int,verification:struct<success:boolean,lean_seconds:double>>>"


def test_run_metrics_and_pass_at_k(spark):
    rows = [(2, False, 2, 1.0, [(1, (False, 0.5)), (1, None)]), (1, True, 2, 2.0, [(1, (False, 0.5)), (1, (True, 0.25))])]
    results = spark.createDataFrame(rows, RESULTS)
    got = metrics.run_metrics(results).first()
    assert (got.attempted, got.solved, got.psr, got.n_failed, got.verifier_calls, got.total_attempts, got.lean_seconds_sum) == (2, 1, 0.5, 1, 4, 4, 1.25)
    assert [tuple(r) for r in metrics.failed_ids(results).collect()] == [(2, "failed")]
    assert {r.k: r.pass_at for r in metrics.pass_at_k(metrics.flat_attempts(results)).collect()} == {1: 0.0, 2: 0.5}
    empty = metrics.run_metrics(results.limit(0)).first()
    assert (empty.attempted, empty.psr, empty.n_failed) == (0, 0.0, 0)
    assert metrics.pass_at_k(metrics.flat_attempts(results.limit(0))).collect() == []
    none = spark.createDataFrame([(1, None, 0, None, [])], RESULTS)
    assert metrics.pass_at_k(metrics.flat_attempts(none)).collect() == [] and metrics.run_metrics(none).first().solved == 0


def test_pilot_shape(spark):
    rows = [(k, n) for k, n in enumerate([1, 2, 2, 2, 2, 3, 0, 0, 0, 0])]
    flat = [(k, i, i == n) for k, n in rows for i in range(1, (n or 3) + 1)]
    got = metrics.pass_at_k(spark.createDataFrame(flat, "task int, idx int, success boolean"))
    assert len(flat) == 24 and [round(r.pass_at, 2) for r in got.orderBy("k").collect()] == [0.1, 0.5, 0.6]


def test_audited_metrics(spark):
    rows = spark.createDataFrame([(1, True, None, 3, 1, 2, 100), (2, False, None, 4, 2, 3, 200)], "id int, passed boolean, error string, verifier_calls int, planner_calls int, executor_calls int, tokens int")
    got = metrics.audited_metrics(rows).first()
    assert (got.attempted, got.solved, got.psr, got.n_failed, got.verifier_calls, got.planner_calls, got.executor_calls, got.tokens) == (2, 1, 0.5, 1, 7, 3, 5, 300)
    lost = rows.unionByName(spark.createDataFrame([(9, None, "timeout", 1, 1, 1, 1)], rows.schema))
    got = metrics.subset_metrics(lost).first()
    assert (got.attempted, got.n_infrastructure, got.verifier_calls) == (2, 1, 7)
    assert sorted(map(tuple, metrics.failed_ids(lost, "passed", "error").collect())) == [(2, "failed"), (9, "infrastructure")]


def test_replay_against_a_fold(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for p in range(300):
        current, draft = (5, 5), (5, 5)
        for a in range(rng.randrange(1, 15)):
            e, h, raised = rng.randrange(7), rng.randrange(7), rng.random() < 0.2
            rows.append((p, a, e, h, raised))
            accepted = not raised and (e, h) < current
            retained = not raised and not accepted and (h, e) < draft
            if accepted:
                current, draft = (e, h), (h, e)
            elif retained:
                draft = (h, e)
            want[p, a] = (accepted, retained, *current, *draft)
    frame = spark.createDataFrame(rows, "project int, attempt int, errors int, holes int, raised boolean")
    got = replay.replay(frame, start=F.struct(F.lit(5).alias("errors"), F.lit(5).alias("holes"))).collect()
    assert {(r.project, r.attempt): (r.accepted, r.retained, r.current_errors, r.current_holes, r.draft_holes, r.draft_errors) for r in got} == want


def test_equal_objective_is_rejected(spark):
    got = replay.replay(spark.createDataFrame([(1, 1, 2, 3, False)], "project int, attempt int, errors int, holes int, raised boolean"), start=F.struct(F.lit(2).alias("errors"), F.lit(3).alias("holes"))).first()
    assert not got.accepted and not got.retained


def files(spark, *rows):
    return spark.createDataFrame(rows, "project int, path string, content string")


def test_signatures(spark):
    got = signatures.inventory(files(spark, (1, "T.lean", "namespace Outer\nsection\ntheorem t : True := by trivial\nend\nend Outer\n"), (1, "U.lean", "namespace Outer\nlemma t : X := y\nprivate def hidden := 1\ndef later : N\ndef n : N := 1\nendpoint\ndef m := 2\n")))
    assert [r.key for r in got.orderBy("path", "start").collect()] == ["Outer.t", "Outer.t#2", "Outer.n", "m"]
    a = files(spark, (1, "T.lean", "def a := 1\ndef b := 2\n"), (2, "T.lean", "def a := 1\n"), (3, "T.lean", "def a := 1\n"))
    b = files(spark, (1, "X.lean", "def b := 3\n"), (1, "Y.lean", "def a := 9\n"), (2, "T.lean", "def a := 1\ndef a := 1\n"), (3, "T.lean", "def c := 1\n"))
    same = {r.project: r.signatures_frozen for r in signatures.frozen(signatures.inventory(a), signatures.inventory(b)).collect()}
    assert same == {1: True, 2: False, 3: False}


def test_hatches_and_holes(spark):
    f = files(spark, (1, "T.lean", "\n\n  axiom x : y\n𝒪 sorry -- sorry\nadmit"))
    assert sorted((r.kind, r.line) for r in projects.escape_hatches(f).collect()) == [("admit", 5), ("axiom", 1), ("sorry", 4)]
    assert sorted((r.line, r.offset) for r in projects.holes(f).collect()) == [(4, 18), (5, 33)]


def test_versions(spark):
    base, patch = files(spark, (1, "A.lean", "a"), (2, "A.lean", "a")), files(spark, (1, "A.lean", "b"), (1, "B.lean", "c  "))
    new = projects.overlay(base, projects.checked_paths(patch))
    assert sorted(map(tuple, new.collect())) == [(1, "A.lean", "b\n"), (1, "B.lean", "c\n"), (2, "A.lean", "a")]
    yes = spark.createDataFrame([(1, False), (2, True)], "project int, accepted boolean")
    assert sorted(map(tuple, projects.choose(base, new, yes).collect())) == [(1, "A.lean", "a"), (2, "A.lean", "a")]
    assert projects.delete(base, patch).collect() == base.where("project = 2").collect()
    with pytest.raises(Exception, match="unsafe"):
        projects.checked_paths(files(spark, (1, "../x.lean", ""))).collect()


def test_tasks_resume_and_shards(spark):
    todo = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    prior = spark.createDataFrame([(2, 1, "old"), (2, 2, "new"), (9, 3, "gone")], "id int, line int, r string")
    assert [r.id for r in tasks.pending(todo, prior).orderBy("id").collect()] == [1, 3] and tasks.pending(todo, prior, force=True).count() == 3
    merged = tasks.merge(todo, prior, spark.createDataFrame([(3, "x")], "id int, r string"))
    assert sorted(map(tuple, merged.collect())) == [(2, "new"), (3, "x")]
    rows = tasks.ordinal(spark.range(100).withColumnRenamed("id", "k"), ["k"], 5)
    assert all(r.row_pos == r.k and r.shard == r.k % 3 for r in tasks.shard(rows, 3).collect())
    with pytest.raises(ValueError):
        tasks.shard(rows, 0)


def test_retrieval(spark):
    lines = retrieval.corpus_lines(spark.createDataFrame([(f"f{k:02d}", "alpha beta\nnothing\nalphabet\nlast alpha\n") for k in range(30)], "path string, content string"))
    got = retrieval.search(spark.createDataFrame([(1, "theorem alpha abc"), (2, "abc that"), (3, "zzzz9")], "query_id int, query string"), lines).collect()
    assert len(got) == 20 and {r.query_id for r in got} == {1} and {r.line for r in got} == {1, 3} and max(r.path for r in got) == "f09"


def test_normalizer(spark):
    rows = spark.createDataFrame([("n", [("prove", "it")], "/m.md", "m"), (None, None, None, "hello")], "name string, vqa_pair array<struct<q:string,a:string>>, output_merged_md_path string, content string")
    a, b = [r.document for r in stages.normalize_document(rows).collect()]
    assert a.source_path == "/m.md" and "prove" in a.text and a.original and (b.text, b.source_name) == ("hello", "unknown")
    assert stages.normalize_document(spark.createDataFrame([("x",)], "other string")).first().document.text == ""


def test_stages_with_models(spark):
    rows = stages.normalize_document(spark.createDataFrame([(1, "text"), (2, "bad")], "id int, content string"))
    model = providers.Rule(lambda p: '```json\n{"items": [{"id": "a", "kind": "lemma", "name": "n", "statement": "s", "proof": "", "dependencies": ["a", "z", "a"]}]}\n```' if p.endswith("text") else "[]")
    items = stages.model_items(rows, model).orderBy("id").collect()
    assert items[0].math_items[0].dependencies == ["a", "a"] and items[0].items_error is None and items[1].items_error == "no JSON object" and items[1].math_items == []
    atomic = stages.atomic_items(rows)
    reviewed = stages.blueprints(atomic, providers.Rule(lambda p: "plan"), providers.Rule(lambda p: '{"verdict": "incorrect", "feedback": "no"}' if "bad" in p else '{"verdict": "correct", "feedback": ""}'))
    assert {r.id: [b.accepted for b in r.blueprints] for r in reviewed.collect()} == {1: [True], 2: [False]}
    aligned = stages.align(atomic, files(spark, (1, "A.lean", "x")), providers.Rule(lambda p: '{"alignments": [{"id": "1", "matched": true, "reason": ""}, {"id": "1", "matched": true, "reason": ""}]}'))
    assert [r.statement_alignment.scc for r in aligned.collect()] == [2.0, 2.0]


def _fail(prompt):
    raise TimeoutError("late")


def test_provider_errors_are_rows(spark):
    asked = spark.createDataFrame([("p",), (None,)], "prompt string")
    assert {r.response.error for r in providers.generate(asked, providers.Rule(_fail), "s", "prompt").collect()} == {"TimeoutError: late"}
    recorded = providers.scripted(spark.createDataFrame([(1,), (2,)], "id int"), spark.createDataFrame([(1, "yes")], "id int, text string"), ["id"])
    assert {r.id: (r.response.text, r.response.error) for r in recorded.collect()} == {1: ("yes", None), 2: (None, "no answer")}


def test_repair_loop(spark):
    text = "theorem t : True := by sorry\n"
    f = files(spark, (1, "Book/T.lean", text), (2, "Book/T.lean", text), (3, "Book/T.lean", text), (4, "Book/T.lean", "def a := 1\n"))
    answer = F.when(F.col("project") == 1, '{"files":[{"path":"Book/T.lean","content":"theorem t : True := by\\n  trivial"}]}').when(F.col("project") == 2, '{"files":[{"path":"Book/T.lean","content":"theorem t : False := by\\n  trivial"}]}').otherwise("no json")
    propose = lambda rows: rows.select("project", answer.alias("text"), F.lit(5).alias("tokens"))
    done, state, trace = pipelines.repair(f, pipelines.offline_plan, propose, verifier.OfflineVerifier(), pipelines.Budget(1, 2))
    got = {r.project: r.content for r in done.collect()}
    assert "sorry" not in got[1] and got[2] == text and got[3] == text
    t = {(r.project, r.executor_attempt): (r.accepted, r.error) for r in trace.collect()}
    assert t == {(1, 1): (True, None), (2, 1): (False, "changed a frozen statement"), (2, 2): (False, "changed a frozen statement"), (3, 1): (False, "unreadable or unsafe answer"), (3, 2): (False, "unreadable or unsafe answer")}
    calls = {r.project: (r.planner_calls, r.executor_calls, r.tokens, r.tokens_dedup) for r in metrics.call_accounting(trace).collect()}
    assert calls == {1: (1, 1, 9, 9), 2: (1, 2, 18, 14), 3: (1, 2, 18, 14)}
    audited = {r.project: (r.passed, r.signatures_frozen) for r in pipelines.audit(done, signatures.inventory(f), verifier.OfflineVerifier()).collect()}
    assert audited == {1: (True, True), 2: (False, True), 3: (False, True), 4: (True, True)}


def test_compile_and_split(spark):
    f = files(spark, (1, "Book/A.lean", "broken\ndef a := 1\n"), (2, "Book/B.lean", "def b := 1\n" + "-- x\n" * 30))
    done, state, trace = pipelines.compile_statements(f, pipelines.offline_fix, verifier.OfflineVerifier())
    assert {r.exit_code for r in state.collect()} == {0} and trace.where("round = 1").first().accepted
    ask = lambda rows: rows.select("project", F.lit('{"files": [{"path": "Book/C.lean", "content": "def b := 1"}], "delete": ["Book/B.lean"]}').alias("text"), F.lit(1).alias("tokens"))
    after, split = pipelines.split_large(done, ask, verifier.OfflineVerifier(), 20)
    assert {r.project: (r.needed, r.accepted) for r in split.collect()} == {1: (False, False), 2: (True, True)}
    assert [r.path for r in after.where("project = 2").collect()] == ["Book/C.lean"]


def test_process_verifier(spark):
    got = verifier.ProcessVerifier(("sh", "-c", "echo 'x: error: no'; exit 3")).verify(files(spark, (1, "A/B.lean", "sorry\n"))).first()
    assert (got.exit_code, got.global_errors, got.holes) == (3, 1, 1)


def test_storage(spark, tmp_path):
    steps = storage.StepStorage(spark, f"file://{tmp_path}")
    assert steps.read("none", "id int").count() == 0
    rows = spark.createDataFrame([(1, "é\n"), (2, None)], "id int, t string")
    assert sorted(map(str, steps.step(rows).collect())) == sorted(map(str, rows.collect()))
    steps.write("x", rows)
    steps.write("x", rows.limit(1))
    assert steps.read("x", rows.schema).count() == 1
    (tmp_path / "bad.jsonl").write_text("{\n\n")
    with pytest.raises(Exception):
        steps.read("bad", "id int").collect()
    (tmp_path / "inv.json").write_text('[{"id": 3, "tag": ["x"]},\n {"id": 1}]')
    got = storage.read_inventory(spark, f"file://{tmp_path}/inv.json", "id int, tag array<string>")
    assert [(r.row_pos, r.id, r.tag) for r in got.orderBy("row_pos").collect()] == [(0, 3, ["x"]), (1, 1, None)]
    os.makedirs(tmp_path / "p/.lake")
    (tmp_path / "p/A.lean").write_text("a\nb\n")
    (tmp_path / "p/.lake/B.lean").write_text("b")
    assert [tuple(r) for r in storage.read_tree(spark, f"file://{tmp_path}/p").collect()] == [("A.lean", "a\nb\n")]
    storage.write_results(spark.createDataFrame([(1, 5, None), (2, None, "lost")], "id int, v int, error string"), f"file://{tmp_path}/out")
    assert sorted(os.listdir(tmp_path / "out")) == ["errors", "results"]


def test_stream(spark, tmp_path):
    from veriloom.streaming.replay import judge_stream

    spark.createDataFrame([(1, 1, 3, 0, False), (1, 2, 3, 0, False), (1, 3, 2, 9, False), (2, 1, 1, 1, True)], "project long, attempt long, errors long, holes long, raised boolean").write.parquet(f"{tmp_path}/in")
    s = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).parquet(f"{tmp_path}/in")
    q = judge_stream(s).writeStream.format("memory").queryName("judged").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted((r.project, r.attempt, r.accepted) for r in spark.table("judged").collect()) == [(1, 1, True), (1, 2, False), (1, 3, True), (2, 1, False)]


def test_queries_against_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{sf_dir}/{f}')")
    norm = lambda v: "" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)
    assert not re.search("LIMIT|TABLESAMPLE", " ".join(registry.ORACLE.values()))
    for name, sql in registry.ORACLE.items():
        frame = registry.QUERIES[name](spark, sf_dir)
        cols = sorted(frame.columns)
        got = con.execute(sql)
        names = [d[0] for d in got.description]
        assert sorted(names) == cols, name
        want = sorted(tuple(norm(r[names.index(c)]) for c in cols) for r in got.fetchall())
        assert sorted(tuple(norm(r[c]) for c in cols) for r in frame.collect()) == want, name


def test_audit_with_a_process(spark):
    clean = files(spark, (1, "Book/T.lean", "theorem t : True := by\n  trivial\n"), (2, "Book/T.lean", "theorem t : True := by\n  sorry\n"))
    frozen = signatures.inventory(clean)
    built = verifier.ProcessVerifier(("sh", "-c", "test -f Book/T.lean"))
    got = {r.project: r for r in pipelines.audit(clean, frozen, built, spark.createDataFrame([(1, "a"), (1, "b"), (1, "b")], "project int, item string")).collect()}
    assert got[1].passed and got[1].source_coverage == 2 and not got[2].passed and [(f.path, f.line, f.kind) for f in got[2].findings] == [("Book/T.lean", 2, "sorry")]
    # the file's own command sees the whole project and the question
    asked = verifier.ProcessVerifier(("true",), file_argv=("sh", "-c", 'cat "$0"; test -f Book/T.lean'))
    got = {r.project: r for r in pipelines.audit(clean, frozen, asked).collect()}
    assert got[1].passed and "#print axioms t" in got[1].axiom_output and "import Book.T" in got[1].axiom_output
    unsound = verifier.ProcessVerifier(("true",), file_argv=("sh", "-c", "echo depends on sorryAx"))
    assert not any(r.passed for r in pipelines.audit(clean, frozen, unsound).collect())


def test_goal_state_and_retrieval_reach_the_plan(spark):
    f = files(spark, (1, "Book/T.lean", "theorem longname : True := by\n  sorry\n"))
    corpus = spark.createDataFrame([("M.lean", 4, "theorem longname_aux : True"), ("M.lean", 5, "nothing")], "path string, line int, text string")
    shown = {}

    def plan(rows):
        for r in rows.collect():
            shown.setdefault("plans", []).append((r.goal, r.retrieval, r.prior_plan, r.focus.line))
        return rows.select("project", F.lit("a plan").alias("text"), F.lit(1).alias("tokens"))

    def propose(rows):
        shown.setdefault("feedback", []).append([(r.feedback, r.retrieval) for r in rows.collect()])
        return rows.select("project", F.lit("no JSON").alias("text"), F.lit(1).alias("tokens"))

    said = verifier.ProcessVerifier(("sh", "-c", "echo built"), file_argv=("sh", "-c", 'grep -n trace_state "$0"'))
    done, state, trace = pipelines.repair(f, plan, propose, said, pipelines.Budget(2, 1), corpus)
    assert [x[2:] for x in shown["plans"]] == [("", 2), ("a plan", 2)]
    assert all(x[0].strip() == "2:  trace_state" and x[1] == "M.lean:4:theorem longname_aux : True" for x in shown["plans"])
    assert state.first().verifier_calls == 4 and {r.error for r in trace.collect()} == {"unreadable or unsafe answer"}  # two builds, two goals
    empty = corpus.limit(0)
    asked = spark.createDataFrame([("q", "longname"), ("r", "a b")], "query_id string, query string")
    assert {r.retrieval for r in retrieval.shown(asked, empty, retrieval.search(asked, empty)).collect()} == {retrieval.NO_CORPUS}
    assert {r.query_id: r.retrieval for r in retrieval.shown(asked, corpus, retrieval.search(asked, corpus)).collect()} == {"q": "M.lean:4:theorem longname_aux : True", "r": ""}


def test_baseline_runner(spark):
    tasks_ = spark.createDataFrame([(k, f"T{k}.lean", f"theorem t{k} : True := by\n  sorry\n") for k in range(5)], "project int, path string, content string")
    seen = []

    def ask(rows):
        seen.append({r.project: (r.feedback, r.previous) for r in rows.collect()})
        proof = F.when(F.col("project") == F.col("attempt"), "by\n  trivial").when(F.col("project") == 4, "-- axiom\n/- sorry -/ trivial").otherwise("broken")
        return rows.select("project", F.when((F.col("project") == 2) & (F.col("attempt") == 1), "[]").otherwise(F.to_json(F.struct(proof.alias("proof")))).alias("text"))

    results, log = pipelines.baseline(tasks_, ask, verifier.OfflineVerifier(), 2)
    got = {r.project: r for r in results.collect()}
    assert [(got[k].success, got[k].attempt_count, got[k].verifier_calls) for k in range(5)] == [(False, 2, 2), (True, 1, 1), (True, 2, 1), (False, 2, 2), (False, 2, 2)]
    assert got[1].content == "theorem t1 : True := by\n  trivial\n" and got[0].content.endswith("sorry\n")  # raw text: a hatch in a comment fails too
    assert set(seen[1]) == {0, 2, 3, 4} and seen[1][0] == ("x: error: broken\n", "broken") and seen[1][2] == ("no proof in the answer", "")
    assert log.count() == 9 and pipelines.baseline(tasks_.limit(0), ask, verifier.OfflineVerifier())[0].count() == 0


def test_success_rules(spark):
    none, some = F.expr("cast(array() as array<string>)"), F.array(F.lit("sorry"))
    rows = [(0, none, 0, True, True), (0, some, 0, True, False), (0, some, 3, False, True), (0, none, 1, True, False), (1, none, 0, False, False), (None, none, 0, False, False)]
    for code, kinds, holes, reject, want in rows:
        assert one(spark, T.verified(F.lit(code).cast("int"), kinds, F.lit(holes), F.lit(reject))) is want
    for path, want in (("a/b.lean", True), ("../x", False), ("a/../b", True), ("a/../../b", False), ("/a", False), ("./a", True)):
        assert one(spark, T.inside(F.lit(path))) is want
    ids = lambda *x: spark.createDataFrame([(k,) for k in x], "id int")
    assert I.same_ids(ids(1, 2, 2), ids(2, 1)).first().same and not I.same_ids(ids(1), ids(1, 2)).first().same and not I.same_ids(ids(1, 2), ids(1)).first().same
    assert [r.id for r in tasks.by_id(spark.createDataFrame([("10",), ("9",)], "id string")).collect()] == ["9", "10"]


class _Chat(providers.ChatCompletions):
    """Answers from a list; keeps what was asked."""

    def __init__(self, *answers):
        super().__init__("http://none", "m")
        self.answers, self.asked = list(answers), []

    def post(self, body, endpoint="chat/completions"):
        import copy

        self.asked.append((endpoint, copy.deepcopy(body)))
        answer = self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer


def test_providers_with_recorded_answers(tmp_path):
    import urllib.error

    said = lambda text=None, calls=None: {"choices": [{"message": {"role": "assistant", "content": text, "tool_calls": calls}}], "usage": {"prompt_tokens": 2, "completion_tokens": 1}}
    call = lambda name, given, k="c": {"id": k, "type": "function", "function": {"name": name, "arguments": given}}
    schema = {"type": "object"}
    chat = _Chat(urllib.error.HTTPError("u", 422, "no", None, None), said("{}"))
    assert chat.generate("s", "p", schema=schema).text == "{}"
    assert "response_format" in chat.asked[0][1] and "response_format" not in chat.asked[1][1] and json_of(schema) in chat.asked[1][1]["messages"][-1]["content"]
    with pytest.raises(urllib.error.HTTPError):
        _Chat(urllib.error.HTTPError("u", 500, "no", None, None)).generate("s", "p", schema=schema)

    (tmp_path / "A.lean").write_text("one\ntheorem two\n")
    tools, described = providers.source_tools(str(tmp_path), lambda source: f"checked {source}")
    assert tools["search"]("theorem") == "A.lean:2:theorem two" and tools["read"]("A.lean", 2, 2) == "2: theorem two" and tools["check"]("x") == "checked x"
    chat = _Chat(said(calls=[call("read", '{"path": "../secret"}')]), said(calls=[call("search", '{"pattern": "two"}')]), said(calls=[call("submit_answer", '{"a": 1}')]))
    got = providers.ToolAgent(chat, tools, described).generate("s", "p", schema=schema)
    assert (got.text, got.prompt_tokens) == ('{"a": 1}', 6)
    results = [m["content"] for m in chat.asked[2][1]["messages"] if m["role"] == "tool"]
    assert results[0].startswith("PermissionError") and results[1] == "A.lean:2:theorem two"
    # the last round: a forced submission with a schema, no tools without one
    chat = _Chat(said(calls=[call("search", '{"pattern": "two"}')]), said(calls=[call("submit_answer", "{}")]))
    assert providers.ToolAgent(chat, tools, described, rounds=1).generate("s", "p", schema=schema).text == "{}"
    assert chat.asked[1][1]["tool_choice"]["function"]["name"] == "submit_answer" and len(chat.asked[1][1]["tools"]) == 1
    chat = _Chat(said(calls=[call("search", '{"pattern": "two"}')]), said("text"))
    assert providers.ToolAgent(chat, tools, described, rounds=1).generate("s", "p").text == "text" and "tools" not in chat.asked[1][1]

    out = lambda *items: {"output": list(items), "usage": {"input_tokens": 3, "output_tokens": 1}}
    asked = {"type": "function_call", "call_id": "c", "name": "search", "arguments": '{"pattern": "two"}'}
    chat = _Chat(out(asked), out({**asked, "name": "submit_answer", "arguments": "{}"}))
    got = providers.ResponsesAgent(chat, tools, described).generate("s", "p", schema=schema)
    assert (got.text, got.prompt_tokens) == ("{}", 6) and chat.asked[0][0] == "responses" and chat.asked[1][1]["store"] is False
    assert chat.asked[1][1]["input"][-1] == {"type": "function_call_output", "call_id": "c", "output": "A.lean:2:theorem two"}
    chat = _Chat(out({"type": "message", "content": [{"type": "output_text", "text": "a plan"}]}))
    assert providers.ResponsesAgent(chat, tools, described).generate("s", "p").text == "a plan"


def json_of(x):
    import json

    return json.dumps(x)


def test_operators_by_name():
    from veriloom.plans import graph

    assert graph.operator("repair") is pipelines.repair and len(graph.OPERATORS) == 12
    with pytest.raises(KeyError, match="no operator"):
        graph.operator("none")


def test_tables_are_whole_versions(spark, tmp_path):
    path = f"file://{tmp_path}/t.jsonl"
    write = lambda *x: storage.write_jsonl(spark.createDataFrame([(k,) for k in x], "a int"), path)
    read = lambda: sorted(r.a for r in storage.read_jsonl(spark, path, "a int").collect())
    assert read() == []
    write(1, 2)
    assert read() == [1, 2]
    os.makedirs(f"{tmp_path}/t.jsonl/v-lost")  # a run that died before its version was named
    with open(f"{tmp_path}/t.jsonl/v-lost/part-0.json", "w") as f:
        f.write('{"a": 99}\n')
    assert read() == [1, 2]
    write(3)
    write(4)
    assert read() == [4] and sum(x.startswith("v-") for x in os.listdir(f"{tmp_path}/t.jsonl")) == 2


def test_discard_keeps_what_a_frame_reads(spark):
    since = storage.mark()
    a = storage.cut(spark.range(3).toDF("a"))
    b = storage.cut(a.where("a > 0"))
    storage.discard(spark, since, but=b)
    assert sorted(r.a for r in b.collect()) == [1, 2] and not storage.exists(spark, a.inputFiles()[0])


def test_depth_of_comments(spark):
    flat = "".join(f"/- note {k} -/ sorry\n" for k in range(40))
    deep = "/-" * 20 + " sorry " + "-/" * 20 + " sorry"
    odd = "-/- sorry " * 15 + '"-/-" ' + "-/ " * 15 + "sorry"
    for source in (flat, deep, odd):
        assert one(spark, T.mask_code(F.lit(source))) == brute_mask(source)
    rows = [(k,) for k in range(50)]
    assert spark.createDataFrame(rows, "p int").select(T.matches(F.lit("𝒪ab sorry b sorry"), T.HOLE).alias("m")).first().m[1].offset == 12
