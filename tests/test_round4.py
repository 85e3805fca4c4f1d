"""Searches that shuffle a text once."""


def test_search_shuffles_a_text_once(spark, tmp_path, monkeypatch):
    """Whatever the number of expressions, a text is one row; trigrams are code points and don't reach across lines."""
    from veriloom.operators import grams

    met, matching = [], grams._matching
    monkeypatch.setattr(grams, "_matching", lambda texts: (met.append(texts.count()), matching(texts))[1])
    texts = ["abc def\nxyz", "abcx\n\U0001d538bc ab\n", "c\nde abc", "", "ab\ncd"]
    index = grams.GramIndex(spark, str(tmp_path / "index"), parts=4)
    index.write(spark.createDataFrame(list(enumerate(texts)), "path int, content string"))
    held = {(r.gram, r.path) for r in spark.read.parquet(str(tmp_path / "index/postings")).collect()}
    assert held == {(line[k : k + 3], p) for p, t in enumerate(texts) for line in t.split("\n") for k in range(len(line) - 2)}
    asked = {0: "abc", 1: "(abc|xyz)", 2: "abcx?", 3: "\U0001d538bc ", 4: "b.?$"}
    found = {(r.query_id, r.path, r.line, r.text) for r in index.search(spark.createDataFrame(list(asked.items()), "query_id int, pattern string")).collect()}
    assert found == {
        *((q, p, n, t) for q in (0, 1, 2) for p, n, t in ((0, 1, "abc def"), (1, 1, "abcx"), (2, 2, "de abc"))),
        (1, 0, 2, "xyz"), (3, 1, 2, "\U0001d538bc ab"), (4, 1, 2, "\U0001d538bc ab"), (4, 2, 2, "de abc"), (4, 4, 1, "ab"),
    }
    assert sum(met) == len(texts)


def test_texts_of_keys_are_made_by_all_cores(spark, sf_dir):
    """Before, a small table's one part made the texts of all its keys in one task."""
    from veriloom import registry, registry_stores

    cores = spark.sparkContext.defaultParallelism
    for files in (registry.sources_of(spark, sf_dir), registry.audit_projects(spark, sf_dir), registry_stores.graph_of(spark, sf_dir)):
        assert files.rdd.getNumPartitions() >= cores and files.count() == registry.table(spark, sf_dir, "part").count()
