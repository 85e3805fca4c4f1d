"""Each operator against a brute-force version, on small rows that hold nulls, empty and long texts, ties, repeats and clashing columns."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from veriloom.llm import labelled as labelled_rows
from veriloom.llm import components, line_dedup, mil_quality, mixing, near_dedup, packing, pii, quality_rules, queries, simhash, token_store, tokens, topk, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component string, `rank` int"
rng = random.Random(5)
VOCABULARY = ["".join(rng.choice("abcdefghiklmnorstu") for _ in range(5)) for _ in range(300)]


def prose(n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


BASE = prose(120)
LONG = "\n".join(prose(40) for _ in range(400))
TEXTS = [
    BASE, BASE, BASE.replace("a", "ax", 1), BASE.upper(), None, "", " \n\t ", "one", "one two", "ONE  two\n", LONG, prose(60) + "\nshared line of eight words or more here 17",
    prose(30) + "\nshared line of eight words or more here 18", "é ü ß 𝒪 " * 30, "same words again " * 40, "\x0b\x0c\r", "a" * 50_000, "\n".join(["dup line"] * 5 + ["x"]),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", f"s{k % 3}" if k % 5 else None, 0, "x", 1) for k, t in enumerate(TEXTS)]
    rows += [(None, BASE, None, "s1", None, None, None), (3, TEXTS[3], "en", "s0", 0, "x", 1)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def print_of(text, n=3):
    import xxhash

    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, radius=3):
    up = list(range(len(prints)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                up[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


def test_simhash_components(docs, nothing):
    rows = simhash.simhash_components(docs).collect()
    given = docs.select("doc_id", "text").collect()
    prints = [print_of(r.text) for r in given]
    of = classes(prints)
    least = collections.defaultdict(list)
    for r, c in zip(given, of):
        if r.doc_id is not None:
            least[c].append(r.doc_id)
    want = sorted((str(r.doc_id), f"{p:016x}", min(least[c], default=None)) for r, p, c in zip(given, prints, of))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in rows) == want
    assert simhash.simhash_components(nothing).collect() == []


def test_bk_forest_and_shards_against_all_pairs(spark):
    r = np.random.default_rng(1)
    seeds = r.integers(0, 2**63, 40, dtype=np.uint64)
    fps = set(map(int, seeds))
    for s in map(int, seeds[:20]):
        for _ in range(30):
            x = s
            for b in r.integers(0, 64, r.integers(1, 6)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    a, b = simhash.bk_spanning_links(np.array(fps, dtype=np.uint64), np.array([0]), 3)
    want = classes(fps)
    assert all((fps[i] ^ fps[j]).bit_count() <= 3 for i, j in zip(a, b)) and len(a) == len(fps) - len(set(want))
    frame = spark.createDataFrame([(0, x - 2**64 if x >= 2**63 else x) for x in fps], "family int, fp long")
    for sizes in ((2_000, 1_000), (20, 1_000), (5, 8)):  # 20: shards are dealt again; 8: blocks meet pair by pair
        got = {r.node: r.component for r in components.components(simhash.fingerprint_links(frame, 3, *sizes).select("a", "b")).collect()}
        groups = collections.defaultdict(set)
        for x, c in zip(fps, want):
            groups[c].add(x - 2**64 if x >= 2**63 else x)
        for g in groups.values():
            assert {got.get(x, x) for x in g} == {min(g)}


def test_near_copies(docs, nothing, spark):
    base = [prose(200).split() for _ in range(6)]
    rows = []
    for k, w in enumerate(base):
        for j in range(8):
            v = list(w)
            for _ in range(j // 2):  # up to three changed words: similarity over 0.8
                v[rng.randrange(len(v))] = "changed"
            rows.append((100 * k + j, " ".join(v)))
        rows.append((100 * k + 50, " ".join(w[:60] + prose(140).split())))  # a third is shared: no copy
    frame = spark.createDataFrame(rows + [(None, None), (900, ""), (901, " "), (1, rows[1][1]), (902, "short text")], "doc_id long, text string").withColumn("component", F.lit(1))
    sets = {(d, t): near_dedup.shingle_set(t) for d, t in rows}
    kept = sorted(r.doc_id for r in near_dedup.drop_near_copies(frame).collect())
    assert kept == sorted([100 * k for k in range(6)] + [100 * k + 50 for k in range(6)] + [900, 902])
    for r in near_dedup.near_components(frame).where("doc_id < 600").collect():
        assert r.doc_id % 100 == 50 or any(len(a & b) >= 0.8 * len(a | b) for a in [sets[x] for x in sets if x[0] == r.doc_id] for b in [sets[x] for x in sets if x[0] == r.doc_id // 100 * 100])
    assert near_dedup.drop_near_copies(docs).columns == docs.columns
    assert near_dedup.drop_near_copies(nothing).count() == 0


def test_components_of_chains(spark, monkeypatch):
    hub = [(0, k) for k in range(1, 200)] + [(k, 500 + k % 3) for k in range(1, 100)]
    monkeypatch.setattr(components, "PLAIN", 5)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(hub, "a long, b long")).collect()}
    assert got == {k: 0 for k in (*range(200), 500, 501, 502)}
    monkeypatch.undo()
    chain = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


def test_line_dedup(docs, nothing, spark):
    got = collections.defaultdict(list)
    for r in line_dedup.dedup_lines(docs).collect():
        got[r.doc_id].append(r)
    assert got[11][0].n_dropped == 0 and got[12][0].n_dropped == 1 and "shared" not in got[12][0].text
    # the null id is the smallest: it keeps the line that 0 and 1 hold too
    assert got[0][0].text == got[1][0].text == "" and got[None][0].text == BASE
    assert got[4][0].text is None and got[5][0].text == "" and got[17][0].n_dropped == 0
    assert line_dedup.dedup_lines(nothing).count() == 0
    assert line_dedup.dedup_lines(docs).columns == [*docs.columns, "n_lines", "n_dropped"]
    clash = docs.withColumn("n_lines", F.lit("x")).withColumn("row", F.lit(1)).withColumn("drop", F.lit(1)).withColumn("doc", F.lit(1)).withColumn("pos", F.lit(1))
    again = line_dedup.dedup_lines(clash)
    assert again.columns == [*docs.columns, "row", "drop", "doc", "pos", "n_lines", "n_dropped"]
    assert sorted(map(str, again.select("doc_id", "text", "n_lines").collect())) == sorted(str(r) for rows in got.values() for r in line_dedup.dedup_lines(docs).select("doc_id", "text", "n_lines").collect())[:: len(got)]
    # a line of little but fields is no template
    tables = spark.createDataFrame([(k, f"{k} 1 2 3 4 5 6 7 8 rows") for k in range(12)], "doc_id long, text string")
    assert {r.n_dropped for r in line_dedup.dedup_lines(tables).collect()} == {0}
    # short lines need more documents
    many = spark.createDataFrame([(k, f"tiny line\n{prose(9)}") for k in range(12)], "doc_id long, text string")
    assert sorted(r.n_dropped for r in line_dedup.dedup_lines(many).collect()) == [0] + [1] * 11


def brute_measures(text):
    w = words(text)
    at = collections.defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    covered = {i + j for v in at.values() if len(v) > 1 for i in v for j in range(8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(docs, nothing):
    given = docs.select("doc_id", "text").collect()
    want = sorted((str(r.doc_id), *brute_measures(r.text)) for r in given)
    out = quality_rules.with_verdict(docs)
    assert sorted((str(r.doc_id), *(r[c] for c in quality_rules.BASE)) for r in out.collect()) == want
    for r in out.collect():
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.failed_rule is None)
    reverse = quality_rules.quality_cascade(docs, tuple(reversed(quality_rules.RULES)))
    assert sorted(map(str, out.select("doc_id", "kept").collect())) == sorted(map(str, reverse.select("doc_id", "kept").collect()))
    assert quality_rules.with_verdict(nothing).count() == 0
    clash = docs.withColumn("n_words", F.lit("x")).withColumn("kept", F.lit(7)).withColumn("w", F.lit(1)).withColumn("_h", F.lit(1)).withColumn("_measured", F.lit(1)).withColumn("row", F.lit(1))
    again = quality_rules.with_verdict(clash)
    assert sorted(map(str, again.select("doc_id", *quality_rules.BASE, "kept").collect())) == sorted(map(str, out.select("doc_id", *quality_rules.BASE, "kept").collect()))
    assert {"w", "_h", "component", "rank"} < set(again.columns) and len(set(again.columns)) == len(again.columns)


def test_cascade_order_follows_rejection_per_cost(docs):
    rule = quality_rules.Rule
    rates = [(rule("dear", None), 0.5, 1.0), (rule("idle", None), 0.0, 0.001), (rule("cheap", None), 0.3, 0.1), (rule("rare", None), 0.01, 0.1), (rule("dearer", None), 0.5, 2.0)]
    assert [r.name for r in quality_rules.cascade_order(rates)] == ["cheap", "dear", "dearer", "rare", "idle"]
    shares = {r.name: share for r, share, seconds in quality_rules.rated(docs, sample_rows=10_000) if seconds > 0}
    n = docs.count()
    rejected = {r.name: 0 for r in quality_rules.RULES}
    for row in docs.select(*[r.rejects(lambda m: quality_rules.MEASURES[m](F.coalesce("text", F.lit("")))).alias(r.name) for r in quality_rules.RULES]).collect():
        for name in rejected:
            rejected[name] += row[name]
    assert shares == {name: k / n for name, k in rejected.items()}
    # one alone, and all measures alone equal those of the single pass
    measured = quality_rules.with_measures(docs).select(*quality_rules.BASE, *[quality_rules.MEASURES[m](F.coalesce("text", F.lit(""))).alias(f"{m}_") for m in quality_rules.BASE])
    assert all(r[m] == r[f"{m}_"] for r in measured.collect() for m in quality_rules.BASE)


def test_cascade_asks_free_rules_first(docs):
    rules = quality_rules.RULES
    costs, sets = quality_rules.surveyed(docs, rules, quality_rules.BASE, sample_rows=10_000)
    free = [r.name for r, c in zip(rules, costs) if c == quality_rules.FREE]
    assert free == ["too_short", "repeats", "word_length", "symbols"] and sum(sets.values()) == docs.count()
    # of rows that pass the first rule, the second rejects none: the third comes before it, though it rejects less of all rows
    a, b, c = (quality_rules.Rule(x, None) for x in "abc")
    assert [r.name for r in quality_rules.survivors_order((a, b, c), [1.0, 1.0, 1.0], {0b011: 50, 0b001: 10, 0b100: 5, 0: 35})] == ["a", "c", "b"]
    # how often a rule is evaluated: fewer times than by what each rejects alone
    def evaluated(order):
        left, n = {0b011: 50, 0b001: 10, 0b100: 5, 0: 35}, 0
        for r in order:
            n += sum(left.values())
            left = {bits: m for bits, m in left.items() if not bits >> "abc".index(r) & 1}
        return n

    assert evaluated("acb") < evaluated("abc")
    assert quality_rules.measures_of(rules[4]) == {"n_dup_lines", "n_lines"}


def brute_spans(text):
    out = []
    luhn = lambda d: sum(x if k % 2 == 0 else 2 * x - 9 * (x > 4) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0
    digits = lambda s: re.sub("[^0-9]", "", s)
    checks = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(len(d := p.lstrip("0") or "0") <= 3 and int(d) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15),
    )
    for k, (regex, good) in enumerate(checks):
        out += [(m.start(), k, m.end()) for m in re.finditer(regex, text or "") if good(m[0])]
    return sorted(out)


PII = [
    "mail a.b@c.org, x@y, @z.com a@b@c.de e@f.g.h@i.jk", "+1 (302) 555-0134 and +44.20.7946.0958+1 222 333 4444", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 0000000255.1.1.1",
    "4111 1111 1111 1111 4111111111111112 5500-0000-0000-0004 4111  1111 1111 1111", "", None, "é𝒪 a@b.cd 𝒪 10.0.0.1", "a" * 5000 + "@" + "b." * 50 + "c", "1" * 6000 + ".1.1.1", "-@-.- %@1.2.3.4",
]


def test_pii_base_spans_against_the_patterns(spark):
    chars = "ab1.2@+- ()4é"
    texts = PII + ["".join(rng.choice(chars) for _ in range(rng.randrange(60))) for _ in range(3_000)]
    for t in texts:
        assert pii.base_spans(t or "") == brute_spans(t), t


def test_pii_patterns_find_unseen_identifiers(spark, nothing):
    rows = [(k, f"{prose(5)} please call customer +1 (302) 555-{1000 + k} today {prose(5)}", "x") for k in range(12)]
    rows += [(100, "so please call customer 302 555 7788 today ok", "x"), (101, "about 302 555 7788 sheep", "x"), (102, None, "x"), (103, "please call customer AKIA99 today", "x"), (100, "so please call customer 302 555 7788 today ok", "x")]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string, spans string"))
    got = [(r.doc_id, r.s) for r in found.select("doc_id", pii.joined("spans").alias("s")).collect()]
    assert [s for d, s in got if d == 100] == ["phone:24:36"] * 2
    assert all(s == "" for d, s in got if d in (101, 102, 103))
    assert all(s.startswith("phone:") and "," not in s for d, s in got if d < 12)
    assert pii.find_pii(nothing).count() == 0


def test_pii_bootstraps_over_chains_and_shapes(spark):
    # seeds make "dial hotline _", which finds unseen numbers, which make "_ for help", which finds more
    rows = [(k, f"dial hotline +1 (302) 555-{1000 + k} {'for help' if k % 2 else prose(2)}") for k in range(40)]
    rows += [(100 + k, f"dial hotline 302 555 {2000 + k} kindly assist") for k in range(9)]
    rows += [(200 + k, f"odd words here {prose(1)} 302 555 {3000 + k} {prose(2)}") for k in range(30)]  # no pattern: not taken
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: len(r.spans) for r in found.collect()}
    assert all(got[k] == 1 for k in (*range(40), *range(100, 109))) and not any(got[k] for k in range(200, 230))
    long = "w" * 5_000
    assert pii._patterns(f"{long} {long}x: 555", 10_004, 10_007)[0] == f"{long} {long}x _"


def test_pii_query(spark, sf_dir):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op5_pii(spark, sf_dir).collect():
        base = brute_spans(text[r.doc_id])
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == j for _, k, _ in base) for j in range(4))
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_top_k_against_all_products(spark):
    r = np.random.default_rng(3)
    rows = [(k, (r.normal(0, r.uniform(0.1, 3), 8)).tolist()) for k in range(400)]
    rows += [(400, [0.0] * 8), (401, None), (402, [1.0] * 7 + [float("nan")]), (403, [1.0] * 7 + [None]), (None, [1.0] * 8), (10, rows[20][1]), (404, rows[0][1]), (405, rows[0][1]), (0, rows[0][1])]
    frame = spark.createDataFrame([(*x, 1) for x in rows], "vec_id long, embedding array<double>, score int").repartition(3)
    valid = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for a, (i, q) in enumerate(valid):
        if i is not None and i % 10 == 0:
            scores = sorted(((-int(q @ c), j is not None, j) for b, (j, c) in enumerate(valid) if b != a))[:5]
            want += [(i, k + 1, j, -s) for k, (s, _, j) in enumerate(scores)]
    for options in ({}, {"bucket": 16, "seeds": 8, "rows_each": 40}, {"seeds": 2, "rows_each": 7}):
        got = topk.top_k(frame, F.col("vec_id") % 10 == 0, **options).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert topk.top_k(frame.where("vec_id = 20"), F.col("vec_id") % 10 == 0).count() == 0
    assert topk.top_k(frame.where("vec_id in (20, 21, 22)"), F.col("vec_id") % 10 == 0).count() == 2


TOKEN_TEXTS = ["", " ", "  a", " a  b ", "a\n b", "a \nb", "a\t b\xa0 c", "don't <|endoftext|> 'll we 'd", "é　 y \x85 z", "x​ y ​", LONG[:3000], "\n\n  x\n y", "1 22 333 !! ?? a,b , c"]


MODEL: list = []


def plain_ids(text):
    from tokenizers import Tokenizer

    if not MODEL:
        MODEL.append(Tokenizer.from_file(tokens.default_path()))
        MODEL[0].encode_special_tokens = True
    return MODEL[0].encode(text or "", add_special_tokens=False).ids


def test_tokens_equal_the_library():
    enc = tokens.Encoder(tokens.default_path())
    texts = TOKEN_TEXTS + ["".join(rng.choice(" a\n\tb.é'1 ") for _ in range(rng.randrange(30))) for _ in range(500)]
    for t, got in zip(texts + [None], enc.encode(texts + [None])):
        assert np.frombuffer(got, "<u4").tolist() == plain_ids(t), repr(t)


def test_tokens_with_little_kept(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 40)
    enc = tokens.Encoder(tokens.default_path())
    texts = [prose(30) for _ in range(20)] + [LONG[:2000]]
    for t in texts:
        assert np.frombuffer(enc.encode([t])[0], "<u4").tolist() == plain_ids(t)
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == [plain_ids(t) for t in texts]


def test_a_word_is_encoded_once_for_all_marks_and_lines(monkeypatch):
    names = [f"{a}{b}" for a in ("ouwh", "Thnd", "éti", "ströße") for b in ("er", "ing", "tion", "ly", "haz")]
    texts = [f"So {a}{mark}\n{b}{mark} {b}." for a in names for b in names for mark in ("", ",", "***", "?!")]
    enc, given = tokens.Encoder(tokens.default_path()), []
    plain = enc._ids
    monkeypatch.setattr(enc, "_ids", lambda text: given.append(text) or plain(text))
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == [plain_ids(t) for t in texts]
    # Each name after a space and after a newline, and the marks; not each of the 400 pairs with each mark.
    assert sum(map(len, given)) <= 2 * sum(len(x) + 1 for x in names) + 10


def test_tokens_of_many_chunks(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "CHUNK", 50)
    texts = [None, *TOKEN_TEXTS, None, LONG[:500], "", *TOKEN_TEXTS]
    got = list(tokens.Encoder(tokens.default_path()).stream(pa.array(["left out", *texts]).slice(1)))
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [plain_ids(t) for t in texts]


def test_packing(docs, nothing, spark):
    more = docs.unionByName(spark.createDataFrame([(1000 + k, prose(rng.randrange(0, 900)), "en", "s", 0, "", 1) for k in range(150)], DOCS))
    rows = packing.pack(more).collect()
    sequences = collections.defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    padding = total = 0
    for v in sequences.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
        total += at
        padding += 0 if at & (at - 1) == 0 else packing.CAPACITY - at
    assert padding <= 0.02 * total + 2 * packing.CAPACITY
    per = collections.defaultdict(list)
    for r in rows:
        per[r.doc_id].append(r)
    for r in more.dropDuplicates(["doc_id"]).collect():
        ids = [*plain_ids(r.text), 1]
        own = sorted(per[r.doc_id], key=lambda x: x.start)
        if r.doc_id == 3:  # there twice, a row of its own each time
            assert sorted(x.start for x in own) == sorted(2 * [x.start for x in own[::2]]) and [bytes(x.ids) for x in own[::2]] == [bytes(x.ids) for x in own[1::2]]
            own = own[::2]
        assert [x for p in own for x in np.frombuffer(p.ids, "<u4").tolist()] == ids
        assert all(p.doc_tokens == len(ids) for p in own)
    assert packing.pack(nothing).count() == 0


def test_token_files_round_trip(docs, nothing, spark):
    path = token_store.new_path(spark)
    manifest = token_store.write_tokens(docs, path, shard_bytes=3_000)
    got = token_store.read_tokens(spark, path, manifest).orderBy("start").collect()
    given = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    at = 0
    for r, d in zip(got, given, strict=True):
        ids = [*plain_ids(d.text), 2]
        assert (r.doc_id, r.start, r.n_tokens) == (d.doc_id, at, len(ids)) and np.frombuffer(r.ids, "<u4").tolist() == ids
        at += len(ids)
    first = manifest.orderBy("shard").first()
    assert token_store.read_document(path, first.shard, 0) == [*plain_ids(given[0].text), 2]
    empty = token_store.new_path(spark)
    assert token_store.read_tokens(spark, empty, token_store.write_tokens(nothing, empty)).count() == 0


def test_mixing(docs, nothing):
    got = mixing.mix_sources(docs).collect()
    size = collections.Counter()
    for r in got:
        assert r["size"] == len(words(r.text)) and r.taken == r.copies * r["size"] and r.copies <= 2
        size[r.source] += r["size"]
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(size.values())
    while open_:  # the excess goes round until no source is above its cap
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * size[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * size[s] for s in over}
        left -= sum(2.0 * size[s] for s in over)
        open_ -= over
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(docs).collect()))
    assert mixing.emit(mixing.mix_sources(docs)).count() == sum(r.copies for r in got)
    assert mixing.mix_sources(nothing).count() == 0
    clash = mixing.mix_sources(docs.withColumn("size", F.lit("x")).withColumn("row", F.lit(1)).withColumn("taken", F.lit(1)))
    assert sorted(map(str, clash.select("doc_id", "size", "taken").collect())) == sorted(str(r) for r in mixing.mix_sources(docs).select("doc_id", "size", "taken").collect())


BAD = ["vile", "rotten"]


def labelled(spark, n=400):
    rows, labels = [], []
    for k in range(n):
        w = prose(rng.randrange(5, 80)).split()
        if k % 4 == 0:
            w.insert(rng.randrange(len(w)), rng.choice(BAD))
        good = k % 3 > 0
        rows.append((k, " ".join(w) if good else " !! ".join(w).upper(), "en" if k % 2 else "fr", "a", 0))
        labels.append((k, int(good), int(k % 4 == 0)))
    rows += [(n, None, None, None, None), (n + 1, "", "en", "a", 0), (n + 2, "\n", "en", "a", 0), (7, rows[7][1], "en", "a", 0), (n + 3, LONG, "en", "a", 0)]
    labels += [(None, 1, 1), (n, None, None), (7, 1, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, toxic int"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {k: (q, t) for k, q, t in labels[:n]}


def test_toxicity_held_out(spark):
    docs, labels, truth = labelled(spark)
    model = toxicity.fit(docs, labels)
    rows = toxicity.score_toxicity(docs, model).withColumn("out", toxicity.held()).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    checked = [(r.score >= toxicity.AT) == bool(truth[r.doc_id][1]) for r in rows if r.out and r.doc_id in truth]
    assert len(checked) > 80 and np.mean(checked) > 0.97
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0
    none = toxicity.fit(docs, labels.limit(0))
    assert {r.score < 0.7 for r in toxicity.score_toxicity(docs, none).collect()} == {True}


def test_quality_held_out(spark):
    docs, labels, truth = labelled(spark)
    model = mil_quality.fit(docs, labels)
    rows = mil_quality.score_quality(docs, model).withColumn("out", mil_quality.held()).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    checked = [(r.score >= mil_quality.AT) == bool(truth[r.doc_id][0]) for r in rows if r.out and r.doc_id in truth]
    assert len(checked) > 50 and np.mean(checked) > 0.97
    assert mil_quality.score_quality(docs.limit(0), model).count() == 0
    assert len({r.score for r in mil_quality.score_quality(docs, mil_quality.fit(docs, labels.limit(0))).collect()}) == 1


def brute_logit(model, text):
    """The toxicity logit of a text, window by window."""
    w = text.split()
    x = [sum(model.emb[f] for f in toxicity.word_features(t)) for t in w] + [np.zeros(toxicity.DIM)] * max(0, max(toxicity.WIDTHS) - len(w))
    out = model.bias_out
    for j, k in enumerate(toxicity.WIDTHS):
        for f in range(toxicity.FILTERS):
            best = max(sum(float(x[at + o] @ model.conv[j][o][:, f]) for o in range(k)) for at in range(len(x) - k + 1))
            out += np.tanh(best + model.bias[j][f]) * model.out[j * toxicity.FILTERS + f]
    return out


def test_toxicity_scores_against_a_loop_over_windows():
    r = np.random.default_rng(2)
    words = toxicity.Words()
    texts = [prose(n) for n in (0, 1, 2, 3, 40, 90)] + [f"{prose(20)} {b} {prose(9)}" for b in BAD * 4]
    docs = [words.read(t) for t in texts]
    model = toxicity.train(words, docs, [0] * 6 + [1] * 8)
    model.conv = [c + r.normal(0, 0.1, c.shape).astype(np.float32) for c in model.conv]
    scorer = toxicity._Scorer(model)
    want = [brute_logit(model, t) for t in texts]
    assert list(scorer.logits([*texts, None])) == pytest.approx([*want, want[0]], abs=1e-4)
    assert list(toxicity._Scorer(model).logits(texts, chunk=7)) == pytest.approx(want, abs=1e-4)
    feats = np.array(words.features)
    for d, x in zip(docs, want):
        assert toxicity._forward(model, model.emb[feats[d]].sum(axis=1))[0] == pytest.approx(x, abs=1e-4)


def test_attention_against_a_loop():
    r = np.random.default_rng(4)
    bags = [mil_quality.encode(t) for t in (prose(300), prose(10), "", LONG[:5000])]
    model = mil_quality.train(bags, [0, 1, 1, 0], steps=5)
    for bag, got in zip(bags, model.logits(bags)):
        h = [np.tanh(x @ model.p["W"] + model.p["b"]) for x in model.normal(bag)]
        gate = [sum(np.tanh(v @ model.p["V"]) / (1 + np.exp(-v @ model.p["U"])) * model.p["w"]) for v in h]
        weight = np.exp(gate) / np.exp(gate).sum()
        assert got == pytest.approx(float(sum(a * v for a, v in zip(weight, h)) @ model.p["c"] + model.p["c0"][0]))
    # one step moves each parameter against its slope, as differences of the loss say
    y = np.array([0, 1, 1, 0], dtype=float)
    x, starts = model.normal(np.concatenate(bags)), np.cumsum([0, *map(len, bags)])[:-1]

    def loss(p):
        s = mil_quality._forward(p, x, starts)["s"]
        return float((np.logaddexp(0, s) - y * s).mean()) / 1.0

    before = mil_quality.train(bags, [0, 1, 1, 0], steps=0).p
    after = mil_quality.train(bags, [0, 1, 1, 0], steps=1, rate=1e-3, decay=0.0).p
    for name in before:
        flat = before[name].reshape(-1)
        for i in r.integers(0, flat.size, 4):
            keep = flat[i]
            flat[i] = keep + 1e-5
            up = loss(before)
            flat[i] = keep - 1e-5
            slope = (up - loss(before)) / 2e-5
            flat[i] = keep
            if abs(slope) > 1e-4:
                assert np.sign(after[name].reshape(-1)[i] - keep) == -np.sign(slope)


def test_classifier_queries(spark, tmp_path):
    docs, labels, _ = labelled(spark)
    docs.drop("score", "toxic").write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for query, mod, rest, at in ((queries.op6_toxicity, 3, 1, 0.7), (queries.op8_mil_quality, 5, 0, 0.3)):
        rows = query(spark, str(tmp_path)).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % mod == rest)
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= at)


def test_samples_of_labels(spark):
    docs, labels, _ = labelled(spark, 60)
    long = spark.createDataFrame([(500, "long " * 100_000, "en", "", 0)], docs.schema)
    both, marked = docs.unionByName(long), labels.union(spark.createDataFrame([(500, 1, 1), (501, 1, 1)], labels.schema))
    rows = labelled_rows.sample(both, marked, "toxic", 1, 1, (5, 100)).collect()
    assert {r._id for r in rows if r._y} == {*range(0, 60, 4), 500} and sum(1 - r._y for r in rows) == 5  # a long text counts as any other
    assert len(next(r.text for r in rows if r._id == 500)) == 500_000
    few = labelled_rows.sample(both, marked, "toxic", 1, 1, (100, 100), bytes_most=1).collect()
    assert sorted(r._y for r in few) == [0, 1]  # a class ends after the text that reaches the bound
    assert all(r._id % 3 >= 0 for r in labelled_rows.sample(both, marked, "toxic", 3, 1, (100, 100)).collect() if zlib.crc32(str(r._id).encode()) % 3 != 1)
    assert not [r for r in labelled_rows.sample(both, marked, "toxic", 3, 1, (100, 100)).collect() if zlib.crc32(str(r._id).encode()) % 3 == 1]


def test_hash_samples(spark):
    from veriloom.llm import common

    frame = spark.createDataFrame([(k, "x" * 100 if k else None) for k in range(2_000)], "doc_id long, text string").repartition(4)
    n = common.sampled(frame, 200, 10**9).count()
    assert 100 < n < 320 and common.sampled(frame, 200, 5_000).count() <= 51
    assert common.sampled(frame, 5_000, 10**9).count() == 2_000 and common.sampled(frame.limit(0), 10, 10).count() == 0


def test_passages_of_long_texts_in_pieces():
    text = LONG + "\n" + "x" * 100
    lut = mil_quality._classes()
    whole = mil_quality.encode(text, lut)
    assert len(whole) == -(-len(text.split()) // mil_quality.PASSAGE) and np.isfinite(whole).all()


def brute_templates(lines):
    """A template for each masked line, by the rules of line_dedup."""
    learnt, level = {}, collections.defaultdict(list)
    for w in (x.split(" ") for x in lines):
        if len(w) >= 8:
            level[len(w), *w[: line_dedup.LEAD]].append(w)
    while level:
        below = collections.defaultdict(list)
        for key, own in level.items():
            counts = [collections.Counter(column) for column in zip(*own)]
            centre = [next((t for t, n in c.items() if 2 * n > len(own)), None) for c in counts]
            fits = [line_dedup.FIELDS * sum(a != b for a, b in zip(w, centre)) <= len(w) for w in own]
            telling = [i for i, c in enumerate(counts) if 1 < max(c.values()) < len(own)]
            at = max(telling, key=lambda i: (sum(n * n for n in counts[i].values()), -i), default=None)
            for w, fit in zip(own, fits):
                if len(own) > 1 and 2 * sum(fits) > len(own):
                    if fit:
                        learnt[" ".join(w)] = (key, *centre)
                    else:
                        below[key, ""].append(w)
                elif at is not None:
                    below[key, w[at] if counts[at][w[at]] > 1 else ""].append(w)
        level = below
    return {x: learnt.get(x, x) for x in lines}


def brute_lines(rows):
    """rows: (doc_id, text); the lines that stay, by the rules of line_dedup."""

    def masked(line):
        w = words(line)
        fields = [x for x in w if re.search("[0-9]", x)]
        return " ".join("<*>" if x in fields and 2 * len(fields) <= len(w) else x for x in w)

    template = brute_templates({masked(x) for _, text in rows for x in text.split("\n") if words(x)})
    holders = collections.defaultdict(set)
    for d, text in rows:
        for x in text.split("\n"):
            if words(x):
                holders[template[masked(x)]].add(d)
    gone = {t: min(h) for t, h in holders.items() if len(h) >= (10 if len(t.split(" ") if isinstance(t, str) else t) < 8 else 2)}
    out = {}
    for d, text in rows:
        lines = text.split("\n")
        kept = [x for x in lines if not words(x) or gone.get(template[masked(x)], d) == d]
        out[d] = "" if len(kept) < len(lines) and not any(map(words, kept)) else "\n".join(kept)
    return out


def test_line_templates_by_words(spark, monkeypatch):
    from veriloom.llm import common

    names, places = ["Anna", "Bert", "Cleo", "Dora", "Emil"], ["Rome", "Oslo", "Kiel"]
    rows = [(k, f"{prose(12)}\nthis page was last edited by {names[k % 5]} in {places[k % 3]} on the web") for k in range(15)]
    rows += [(100 + k, "this page was " + prose(10)) for k in range(6)]  # the same beginning and no more
    rows += [(200 + k, "one two three " + " ".join(VOCABULARY[j] if j != 7 + k else f"odd{chr(97 + k)}" for j in range(40))) for k in range(4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_lines(rows)
    assert all(want[k] == rows[k][1].split("\n")[0] for k in range(1, 15)) and all(want[k] for k in range(100, 106)) and [want[k] == "" for k in range(200, 204)] == [False, True, True, True]
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(frame).collect()} == want
    # hot nodes and templates split: the same
    split = common.split_join
    monkeypatch.setattr(line_dedup, "split_join", lambda *a, **k: split(*a, **{**k, "few": 0, "hot": 0.2}))
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(frame).collect()} == want


@pytest.mark.parametrize("sizes, kept", [([6], 1), ([6, 6], 2), ([6] * 4, 4), ([9, 8, 7, 6, 5, 4], 6), ([5] * 20, 20)])
def test_line_templates_of_mixed_nodes(spark, sizes, kept):
    """Families of twelve tokens with three leading tokens in common and a field each; one line of each family stays."""
    rows = []
    for f, n in enumerate(sizes):
        body = [f"{chr(97 + f)}{chr(97 + k)}" for k in range(9)]
        for k in range(n):
            rows.append((len(rows), " ".join(["one", "two", "three", *body[: f % 9], f"field{chr(97 + f)}{chr(97 + k)}", *body[f % 9 + 1 :]])))
    rows += [(1000 + k, "one two three " + " ".join(f"{chr(97 + k)}{chr(97 + i)}apart" for i in range(9))) for k in range(3)]  # no family
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_lines(rows)
    assert sum(x != "" for x in got.values()) == kept + 3 and all(got[1000 + k] for k in range(3))


def test_pipeline_against_brute_force(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash_near_dedup", "mixing", "packing"]

    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = toxicity._Scorer(model)
    given = {r.doc_id: r for r in docs.collect()}
    want = {d for d, r in given.items() if model.score(next(scores.logits([r.text]))) < model.thresholds.get(r.lang, toxicity.AT)}
    clean = stages["toxicity"](spark, docs, sf_dir)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == want

    lines = stages["line_dedup"](spark, docs, sf_dir)
    got = {r.doc_id: r for r in lines.collect()}
    assert lines.columns == docs.columns and {d: r.text for d, r in got.items()} == brute_lines([(d, r.text) for d, r in given.items()])
    assert all(r.n_chars == len(r.text) for r in got.values())

    kept = {r.doc_id for r in stages["simhash_near_dedup"](spark, docs, sf_dir).collect()}
    sets = {d: near_dedup.shingle_set(r.text) for d, r in given.items()}
    similar = collections.defaultdict(set)
    for a in sets:
        for b in sets:
            if a != b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                similar[a].add(b)
    heads, seen = set(), set()
    for d in sorted(sets):
        if d not in seen:
            heads.add(d)
            todo = [d]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += similar[x]
    assert kept == heads

    mixed = collections.Counter(r.doc_id for r in stages["mixing"](spark, docs, sf_dir).collect())
    again = mixing.mix_sources(docs).collect()
    assert mixed == collections.Counter({r.doc_id: r.copies for r in again if r.copies}) and max(mixed.values()) <= 2
    taken = collections.Counter()
    for r in again:
        taken[r.source] += r.taken
        n = len(words(r.text))
        draw = int(hashlib.sha256(f"mix:{r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        rate = r.target / r.source_size
        assert r.size == n and r.copies == int(rate) + (draw < rate - int(rate))
    variance = collections.Counter()
    for r in again:
        part = r.target / r.source_size % 1
        variance[r.source] += part * (1 - part) * r.size**2
    assert all(abs(taken[r.source] - r.target) <= 4 * variance[r.source] ** 0.5 + 1 for r in again)  # four deviations of independent draws

    pieces = collections.defaultdict(list)
    for r in stages["packing"](spark, docs, sf_dir).collect():
        assert r.ids_crc32 == zlib.crc32(r.ids)
        pieces[r.doc_id].append((r.start, bytes(r.ids)))
    for d, r in given.items():
        assert np.frombuffer(b"".join(x for _, x in sorted(pieces[d])), "<u4").tolist() == [*plain_ids(r.text), 1]
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def brute_components(texts):
    sets = [near_dedup.shingle_set(t) for t in texts]
    of = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if of[i] != of[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                of = [of[j] if x == of[i] else x for x in of]
    return sorted(sorted(i for i, x in enumerate(of) if x == c) for c in set(of))


def near_groups(spark, texts):
    got = collections.defaultdict(list)
    for r in near_dedup.near_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        got[r.component].append(r.doc_id)
    return sorted(map(sorted, got.values()))


def test_near_copies_by_contiguous_edits(spark):
    r = random.Random(8)
    prose = lambda n: [r.choice(VOCABULARY) for _ in range(n)]
    texts = []
    for k in range(60):
        w = prose(r.randrange(150, 500))
        n = len(w)
        part = int(n * r.uniform(0.11, 0.19))
        at = r.randrange(n - part)
        edited = (w[:-part], w + prose(part), w[:at] + prose(part // 2) + w[at + part // 2 :], w[:at] + w[at + part :])[k % 4]
        texts += [" ".join(w), " ".join(edited)]
    want = brute_components(texts)
    assert sum(len(g) == 2 for g in want) > 45
    assert near_groups(spark, texts) == want


def test_near_copies_among_common_shingles(spark, monkeypatch):
    """Passages that most texts share, long lists in pieces, repeated rows: the same groups."""
    r = random.Random(10)
    some = lambda n: " ".join(r.choice(VOCABULARY) for _ in range(n))
    shared = some(60)
    texts = [f"{some(40)} {shared} {some(40)}" for _ in range(50)]
    texts += [t.replace(" ", " extra ", 1) for t in texts[:20]] + [f"{shared} {some(4)}" for _ in range(20)] + ["", " ", shared, shared.upper()]
    want = brute_components(texts)
    for many, often, stars in ((100_000, 40, 2), (7, 3, 0), (3, 10**9, 1)):
        monkeypatch.setattr(near_dedup, "MANY", many)
        monkeypatch.setattr(near_dedup, "OFTEN", often)
        monkeypatch.setattr(near_dedup, "STARS", stars)
        assert near_groups(spark, texts) == want
    again = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] * 2, "doc_id long, text string")
    kept = sorted(x.doc_id for x in near_dedup.drop_near_copies(again).collect())
    assert kept == sorted(g[0] for g in want)


def test_near_copies_in_dense_groups(spark):
    r = random.Random(9)
    texts = []
    for _ in range(12):
        base = [r.choice(VOCABULARY) for _ in range(300)]
        for _ in range(12):
            w = list(base)
            for at in r.sample(range(300), r.randrange(3, 7)):  # similarity from pair to pair on both sides of 0.8
                w[at] = "".join(r.choice("vwxyz") for _ in range(6))
            texts.append(" ".join(w))
    assert near_groups(spark, texts) == brute_components(texts)


def test_near_copies_of_a_template(spark, monkeypatch):
    """Texts of one template, similar to 0.74 or so, make no pairs of rows; a few near copies among them are found, in blocks of any size."""
    r = random.Random(12)
    word = lambda: "".join(r.choice("vwxyz") for _ in range(7))
    template = [r.choice(VOCABULARY) for _ in range(330)]
    texts = []
    for k in range(160):
        w = list(template)
        for at in r.sample(range(330), 11):
            w[at] = word()
        texts.append(" ".join(w))
        if k % 40 == 0:  # a near copy, and an exact one
            texts += [" ".join(w[:-3] + [word()]), " ".join(w)]
    want = brute_components(texts)
    assert sum(len(g) > 1 for g in want) >= 4
    seen = []
    compare = near_dedup.similar_pairs
    monkeypatch.setattr(near_dedup, "similar_pairs", lambda pairs, *a: seen.append(pairs.count()) or compare(pairs, *a))
    assert near_groups(spark, texts) == want
    assert max(seen) <= 10 * len(texts)  # of 13,000 pairs
    monkeypatch.setattr(near_dedup, "HOT_LIST", 4)
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", 17)
    assert near_groups(spark, texts) == want


def test_near_dedup_keeps_clashing_columns_and_null_ids(spark):
    rows = [(1, BASE, "a", 1), (2, BASE, "b", 2), (None, BASE, "c", 3), (None, "only here", "d", 4), (None, "only here", "e", 5), (3, None, "f", 6), (4, "", "g", 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _key string, kept int")
    got = sorted(((r.doc_id, r.text, r._key, r.kept) for r in near_dedup.drop_near_copies(frame).collect()), key=str)
    assert frame.columns == near_dedup.drop_near_copies(frame).columns and [g for g in got if g[0]] == [(1, BASE, "a", 1), (3, None, "f", 6)]
    assert len(got) == 3 and got[-1][1] == "only here"
