"""Secrets, turn repair and the prefix trie against brute-force versions, on small rows with nulls, empty and long texts, ties, repeats and clashing columns."""

from __future__ import annotations

import base64
import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from veriloom.llm import prefix_trie, queries, secret_scan, turn_repair

rng = random.Random(11)
SYLLABLES = ["the", "ing", "er", "tion", "on", "an", "re", "ment", "al", "ver", "lich", "heit", "que", "oi"]


def prose(n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


# --- secrets ----------------------------------------------------------------------------------------------------------
def brute_base(text):
    text, out = text or "", []
    at = 0
    while m := re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""").search(text, at):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end()))
        at = m.end()
    for kind, regex, least in ((1, r"AKIA[A-Z0-9]+", 18), (2, r"[0-9a-f]+", 16)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(regex, text) if len(m[0]) >= least]
    return sorted(out)


SECRET_DOCS = "doc_id long, text string, base string, candidates int, spans string, score double"


@pytest.fixture(scope="module")
def secret_rows():
    key = lambda n: base64.b64encode(rng.randbytes(n)).decode()
    url = lambda n: base64.urlsafe_b64encode(rng.randbytes(n)).decode().rstrip("=")
    planted = [key(33), key(48), url(45), rng.randbytes(20).hex().upper(), base64.b32encode(rng.randbytes(30)).decode().rstrip("=")]
    texts = [f"{prose(40)} {p} {prose(5)}" for p in planted]
    texts += [None, "", "token: " + "a" * 12, "Token='short'", 'API_KEY = "abcDEF123456"', "apikey==" + "x" * 15, "AKIA" + "Z" * 14, "AKIA" + "Z" * 13, "f" * 16, "f" * 15, "é𝒪 secret=" + "k" * 20 + " é " + "0123456789abcdef", "ſecret=abcdefghijklmnop toKen=abcdefghijklmnop"]
    texts += ["a" * 60_000, "ab" * 400, "=" * 50, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "token=" * 300, "\n".join(prose(50) for _ in range(300))]
    texts += [prose(300) for _ in range(120)]
    rows = [(k, t, "x", 1, "y", 0.5) for k, t in enumerate(texts)] + [(0, texts[0], None, None, None, None), (None, texts[1], None, None, None, None)]
    return planted, rows


def test_secrets(spark, secret_rows):
    planted, rows = secret_rows
    docs = spark.createDataFrame(rows, SECRET_DOCS).repartition(3)
    got = secret_scan.find_secrets(docs).collect()
    given = collections.Counter((r[0], str(brute_base(r[1]))) for r in rows)
    assert collections.Counter((r.doc_id, str([tuple(s) for s in r.base])) for r in got) == given
    text = {r[0]: r[1] for r in rows}
    more = {(r.doc_id, text[r.doc_id][s.start : s.end]) for r in got for s in r.spans if s.kind == 3}
    assert more == {*enumerate(planted), (None, planted[1])}  # every random string, no word, no regular string
    for r in got:
        assert [s for s in r.spans if s.kind < 3] == list(r.base) and r.spans == sorted(r.spans)
    assert secret_scan.find_secrets(docs.limit(0)).collect() == []


def test_battery_and_discoveries():
    g = np.random.default_rng(1)
    p = np.array([secret_scan.battery(g.integers(0, 64, 40), 64) for _ in range(3_000)])
    assert (np.abs((p < 0.05).mean(0) - 0.05) < 0.02).all()  # uniform strings fail as often as they should
    assert min(secret_scan.battery(np.arange(64), 64)) < 1e-6 and min(secret_scan.battery(np.zeros(40, int), 64)) < 1e-6
    assert [secret_scan.encoding_of(x) for x in ("0123", "ab12", "AB12", "word", "AZ2", "az9", "aZ9", "a+Z", "a-Z", "a+-", "é")] == ["decimal", "hex", "hex_upper", "lower", "base32", "base36", "base62", "base64", "base64_url", None, None]
    # e-BH by the sorted list
    for _ in range(50):
        scores = [rng.choice([None, *range(0, 120)]) for _ in range(rng.randint(1, 200))]
        e = sorted((np.exp(s / secret_scan.BINS) for s in scores if s is not None), reverse=True)
        k = max((k for k, x in enumerate(e, 1) if x >= len(scores) / (0.01 * k) * (1 - 1e-12)), default=0)
        least = secret_scan.discovery_score(list(collections.Counter(scores).items()))
        assert sum(s is not None and s >= least for s in scores) == k
    assert secret_scan.discovery_score([]) > secret_scan.BINS * secret_scan.MOST


# --- turn repair ------------------------------------------------------------------------------------------------------
def spoilt(rows):
    """rows (conv, turn, role, text) after the damage, in order."""
    space = lambda x: " " if x is None else str(x)
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def all_repairs(rows):
    """(cost, audit, repaired) of the least repair, by trying every sequence of edits."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    best = None

    def go(k, cost, audit, said):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if k == len(rows):
            if re.fullmatch("(s?(ua)+)?", "".join(s[0] for s in said)):
                best = min(x for x in (best, (cost, audit, said)) if x is not None)
        else:
            _, role, text = rows[k]
            late = 3 * (faults[k] == "truncated")
            go(k + 1, cost + 4, audit + "D", said)
            if faults[k] not in ("blank", "duplicate"):
                go(k + 1, cost + late, audit + "K", [*said, f"{role}:{text}"])
                for r in ("user", "assistant"):
                    go(k + 1, cost + 3 + late, audit + "R", [*said, f"{r}:{text}"])
        if audit.count("I") < 3:
            for r in ("user:", "assistant:"):
                go(k, cost + 3, audit + "I", [*said, r])

    go(0, 0, "", [])
    return (*best, faults)


def brute_repair(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        now = spoilt([r for r in rows if r[0] == conv])
        cost, audit, said, faults = all_repairs(now)
        turns = {t for t, _, _ in now if t is not None}
        pairs = ["".join(p) for p in itertools.pairwise(r[1][:1] for r in now)]
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


TURNS = "conv_id long, turn long, role string, text string, conv string, `row` int, cost double"
SAID = ["Yes.", "No!", "Why?", "well", "", " \n", "a. b", None, "𝒪é."]


def conversation_rows(n, most, roles=("user", "assistant", "user", "assistant", "system", "tool", None)):
    rows = []
    for c in range(n):
        first = rng.choice([0, 0, 3])
        rows += [(c, None if k == 0 and c % 7 == 3 else first + k * (1 + (k > 2 and c % 5 == 0)), rng.choice(roles), rng.choice(SAID)) for k in range(rng.randint(1, most))]
    return rows


def test_turn_repair(spark):
    rows = conversation_rows(150, 5) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "So."), (-4, 0, "system", "x."), (-4, 1, "user", "y.")]
    frame = spark.createDataFrame([(*r, "z", 1, 0.0) for r in rows], TURNS).repartition(3)
    want = brute_repair(rows)
    assert {r[0]: tuple(r[1:]) for r in turn_repair.repair_turns(frame).collect()} == want
    # conversations cut into blocks of few rows: the same
    assert {r[0]: tuple(r[1:]) for r in turn_repair.repair_turns(frame, block=3).collect()} == want
    assert any(sum(x[:6]) == 0 and x[6] == "" for x in want.values())  # one that lost all its rows
    assert turn_repair.repair_turns(frame.limit(0)).collect() == []


def test_turn_repair_of_long_conversations(spark):
    """One conversation with most rows, in many blocks and queries, against one block; equal rows of one turn."""
    rows = [(1, k, rng.choice(["user", "assistant"]), f"{k}.") for k in range(2_000)] + conversation_rows(40, 6)
    rows += [(50, 1, "user", "same.")] * 3
    frame = spark.createDataFrame([(*r, "z", 1, 0.0) for r in rows], TURNS)
    faults = turn_repair.faulty(turn_repair.damaged(frame))
    few = turn_repair.cheapest(faults, block=64).collect()
    assert sorted(map(tuple, few)) == sorted(map(tuple, turn_repair.cheapest(faults, block=100_000).collect()))
    found = {r[0]: r for r in turn_repair.repair_turns(frame, block=64).collect()}
    n = collections.Counter(zlib.crc32(f"1:{k}".encode()) % 20 for k in range(2_000))
    assert len(found[1].audit.replace("I", "")) == 2_000 - n[0] + n[3] + len(spoilt([r for r in rows[2_000:] if r[0] == 1]))
    assert found[50].duplicate in (0, 2, 3, 5)


# --- prefix trie ------------------------------------------------------------------------------------------------------
def brute_trie(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        turns[conv].append((role or "", text or ""))
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - int(np.fmod(c, 20)), [])[:h] + turns[c][h:])
    members = collections.defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    out = []
    for node, own in members.items():
        below = [x for x in members if x[: len(node)] == node]
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in below if x)
        ends = ",".join(str(c) for c in sorted(own) if len(built[c]) == len(node))
        leaves = sum(not any(len(y) == len(x) + 1 and y[:-1] == x for y in members) for x in below)
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), sum(len(y) == len(node) + 1 and y[:-1] == node for y in members), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def test_prefix_trie(spark):
    said = ["one two", "three", "", None, "a  b\tc"]
    rows = []
    for c in [*range(0, 45), *range(100, 125), -3, -20]:
        rows += [(c, None if k == 0 and c % 6 == 0 else k, rng.choice(["user", "assistant", None]), rng.choice(said)) for k in range(rng.choice([1, 1, 2, 3, 4, 5, 9]))]
    rows += [(200, k, "user", f"t{k}") for k in range(37)] + [(201, k, "user", f"t{k}") for k in range(33)] + [(None, 0, "user", "lost")]
    rows += [(c, k, "user", f"hot {k}") for c in range(300, 340) for k in range(4)]  # copies
    frame = spark.createDataFrame([(*r, "z", 1, 0.0) for r in rows], TURNS).repartition(3)
    got = sorted((tuple(r) for r in prefix_trie.prefix_trie(frame).collect()), key=str)
    assert got == brute_trie(rows)
    assert prefix_trie.prefix_trie(frame.limit(0)).collect() == []
    alone = [(21, 0, "user", "x"), (2, 0, "user", "y")]  # conversations that lend from absent ones
    assert sorted((tuple(r) for r in prefix_trie.prefix_trie(spark.createDataFrame([(*r, "z", 1, 0.0) for r in alone], TURNS)).collect()), key=str) == brute_trie(alone)


def test_digests_of_long_lists(spark):
    ids = list(range(7, 120_007))
    frame = spark.range(7, 120_007).select(F.lit(1).cast("long").alias("name"), F.col("id").alias("conv")).union(spark.createDataFrame([(2, -5), (2, 3)], "name long, conv long"))
    got = {r["name"]: r["ends_sha256"] for r in prefix_trie.digests(frame.repartition(5)).collect()}
    assert got == {1: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), 2: hashlib.sha256(b"-5,3").hexdigest()}


def test_new_queries_have_their_columns(spark, sf_dir):
    want = {"op11_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"], "op12_turn_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
            "op13_prefix_trie": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]}
    for name, columns in want.items():
        assert queries.QUERIES[name](spark, sf_dir).columns == columns
