"""Tables that end with their step, rounds that stay small, and stores in bounded memory."""

from veriloom.plans import pipelines
from veriloom.sources import storage


def test_rounds_delete_their_tables(spark):
    rows = spark.createDataFrame([(k, "line\n" * (k % 12) + "e" * k, "s") for k in range(40)], "id int, content string, name string")
    since = storage.mark()
    made = pipelines.offline_book(rows, max_lines=8)
    left = storage._written.paths[since:]
    assert len(left) < 20  # before, each of the four attempts left its nine
    got = {r.id: r for r in made.collect()}
    assert len(got) == 40 and {r.source_coverage for r in got.values()} == {1}


def test_templates_are_read_from_tables(spark):
    """No join of an earlier round is left in the plan; odd blanks, a digit token and families of one node as before."""
    from veriloom.llm import line_dedup

    rows = [(k, f"one two three  \t alike alike alike{k % 2} alike field{chr(97 + k)} end\x0b") for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learnt = line_dedup.learn_templates(docs, line_dedup.line_paths(docs))
    assert "Join" not in learnt._jdf.queryExecution().optimizedPlan().toString()
    assert learnt.count() == 6 and learnt.select("template").distinct().count() == 1
    assert [r.n_dropped for r in line_dedup.dedup_lines(docs).orderBy("doc_id").collect()] == [0, 1, 1, 1, 1, 1]


def test_affected_through_shuffled_joins(spark, monkeypatch):
    """What every round meets isn't broadcast, so it doesn't pass through the driver."""
    from veriloom.operators import imports

    plans = []
    monkeypatch.setattr(imports, "cut", lambda rows: (plans.append(rows._jdf.queryExecution().optimizedPlan().toString()), storage.cut(rows))[1])

    edges = spark.createDataFrame([(0, f"M{k}", f"M{k // 2}") for k in range(1, 40)], "project int, module string, imports string")
    found = imports.affected(edges, spark.createDataFrame([(0, "M3")], "project int, module string"))
    assert {r.module for r in found.collect()} == {"M3", "M6", "M7", *(f"M{k}" for k in (*range(12, 16), *range(24, 32)))}
    met = [p for p in plans if "Join LeftAnti" in p]
    assert met and all("strategy=merge" in p for p in met)


def test_keyed_index_grows_batch_by_batch(tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from veriloom.sources import keyed

    batches = [pa.record_batch({"kind": ["a", "a"], "key": [f"{k}0", f"{k}1"], "body": ["é", None]}) for k in range(3)]
    said = keyed.KeyedWriter(f"file://{tmp_path}", True).write(iter(batches))
    index = pq.ParquetFile(tmp_path / "parts" / said.index)
    assert said.rows == 6 and index.num_row_groups == 3
    assert index.read().column("start").to_pylist() == [0, 3, 4, 7, 8, 11] and index.read().column("size").to_pylist() == [2, 0] * 3
