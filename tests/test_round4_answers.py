"""The answer log writes few files."""


def test_answers_are_few_files(spark, tmp_path, monkeypatch):
    """Before, a file for each answer."""
    from veriloom.operators import answers, providers

    written = []
    monkeypatch.setattr(answers.AnswerLog, "merge", lambda log: written.extend((tmp_path / "log/pieces").rglob("[!.]*.json")))
    log = answers.AnswerLog(spark, f"file://{tmp_path}/log")
    rows = spark.range(300).selectExpr("id", "concat('q', id) q")
    got = log.generate(rows, providers.Rule(str.upper), "s", "q", tasks=2)
    assert {(r.id, r.response.text) for r in got.collect()} == {(k, f"Q{k}") for k in range(300)} and 1 <= len(written) < 50
    whole = max(written, key=lambda p: p.stat().st_size)
    (whole.parent / "torn.json").write_text(whole.read_text().splitlines()[0].replace('"key": "', '"key": "torn')[:-30])
    assert log.answers().count() == 300
