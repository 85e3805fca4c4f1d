"""Conversation repair: a DuckDB recursive query in hash-partitioned batches advances all conversations by one turn a recursion.

A repaired conversation's role initials are `(s?(ua)+)?`. The grammar has four states: 0 nothing yet, 1 after s, 2 after u,
3 after a; 0 and 3 may end. A row is kept, given the role that the state asks for, or deleted, and a turn may be inserted before
it; the recursion keeps the least cost, and of equal costs the ASCII-least audit, for each state. Each letter of an audit
leaves one state only, and every prefix that has consumed k rows ends with the k-th row's letter, so of two audits in one state
none is the beginning of the other: the least audit of a state stays the least, whatever follows. Two insertions in
a row never pay: they cost 6 and lead to a state that allows no more than the one before.

Rows are numbered by ranges, without a task that sorts a whole conversation, and cut into blocks of BLOCK rows. A block is
solved from each state that its first conversation may be in, so a conversation of any length is many blocks' work; the few
conversations at a block's edges are put together by the same recursion over pieces. Texts take no part until the audits are
known: then a task reads a conversation's rows in order and keeps one of them and the digest's state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.operators.tasks import ordinal

from .common import BLANKS, WORD, cut, split_join

#: Rows of a block, and rows that one DuckDB query takes (whole blocks).
BLOCK, QUERY_ROWS = 512, 16_384
#: Costs of the edits, and of a truncated row that stays.
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Faults: 0 none, 1 blank, 2 duplicate, 3 truncated.
KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The state after the turn that a state asks for: user, or assistant after a user.
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}


def moves() -> list[tuple[int, str, int, int, str, int]]:
    """(state, initial, fault, state after, letters, cost) of every way to consume a row."""
    out = []
    for state in range(4):
        for before, s, paid in (("", state, 0), ("I", NEXT[state], INSERT)):
            for initial in "suao":
                for fault in range(4):
                    out.append((state, initial, fault, s, before + "D", paid + DELETE))
                    if fault in (0, 3):
                        stays = paid + (TRUNCATED if fault else 0)
                        if (s, initial) in KEEPS:
                            out.append((state, initial, fault, KEEPS[s, initial], before + "K", stays))
                        out.append((state, initial, fault, NEXT[s], before + "R", stays + RENAME))
    return out


#: One more row of every piece (piece, k, initial, fault) for each recursion. open: the piece may begin in any state.
ROWS_SQL = """
WITH RECURSIVE walk AS (
  SELECT piece, e AS entry, 0::BIGINT AS k, e AS s, 0::BIGINT AS cost, '' AS audit FROM pieces, unnest(CASE WHEN open THEN [0, 1, 2, 3] ELSE [0] END) AS u(e)
  UNION ALL
  SELECT w.piece, w.entry, r.k, m.after AS s, min(w.cost + m.cost) AS cost, arg_min(w.audit || m.letters, (w.cost + m.cost, w.audit || m.letters)) AS audit
  FROM walk w JOIN turns r ON r.piece = w.piece AND r.k = w.k + 1 JOIN moves m ON m.state = w.s AND m.initial = r.initial AND m.fault = r.fault
  GROUP BY w.piece, w.entry, r.k, m.after)
SELECT piece, list({'entry': entry, 'exit': s, 'cost': cost, 'audit': audit}) AS paths FROM walk JOIN pieces USING (piece) WHERE k = n GROUP BY piece
"""
#: The same over the pieces (conv, k, entry, exit, cost, audit) of a conversation.
PIECES_SQL = """
WITH RECURSIVE walk AS (
  SELECT DISTINCT conv, 0::BIGINT AS k, 0 AS s, 0::BIGINT AS cost, '' AS audit FROM paths
  UNION ALL
  SELECT w.conv, p.k, p.exit AS s, min(w.cost + p.cost) AS cost, arg_min(w.audit || p.audit, (w.cost + p.cost, w.audit || p.audit)) AS audit
  FROM walk w JOIN paths p ON p.conv = w.conv AND p.k = w.k + 1 AND p.entry = w.s GROUP BY w.conv, p.k, p.exit)
SELECT conv, list({'entry': 0, 'exit': s, 'cost': cost, 'audit': audit}) AS paths FROM walk JOIN (SELECT conv, max(k) AS n FROM paths GROUP BY conv) USING (conv) WHERE k = n GROUP BY conv
"""
PATHS = "array<struct<entry:int,exit:int,cost:long,audit:string>>"


def damaged(turns: DataFrame) -> DataFrame:
    """conv (the id as text, a space for null), turn, role, text after the damage that crc32 of `conv_id:turn` modulo 20 asks for; nulls become a space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = turns.select(space("conv_id").alias("conv"), "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


#: The order of a conversation's rows: by turn, nulls first; rows of one turn by these hashes of role and text, equal rows as they come.
ORDER = ["conv", "turn", "h", "h2"]


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("h", F.xxhash64("role", "text")).withColumn("h2", F.xxhash64("text", F.lit(1), "role"))


def faulty(rows: DataFrame) -> DataFrame:
    """conv, turn, row_pos (all rows in order), initial (s, u, a or o), fault of every row: the first of blank, duplicate, truncated."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    own = F.when(~F.regexp_like("text", F.lit(WORD)), 1).when(~last.isin(".", "!", "?"), 3).otherwise(0)
    initial = F.substring("role", 1, 1)
    light = _hashed(rows).select(*ORDER, F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"), own.cast("int").alias("own"))
    numbered = cut(ordinal(light, ORDER))
    again = cut(numbered.where("own <> 1").groupBy("conv", "h", "h2").agg(F.min("row_pos").alias("first"), F.count("*").alias("n")).where("n > 1"))
    both = split_join(numbered, again, ["conv", "h", "h2"], "n", how="left")
    fault = F.when(F.col("own") == 1, 1).when(F.col("row_pos") > F.col("first"), 2).otherwise(F.col("own"))
    return both.select("conv", "turn", "row_pos", "initial", fault.cast("int").alias("fault"))


def _connection():
    import duckdb

    con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB"})
    con.execute("CREATE TABLE moves (state INT, initial VARCHAR, fault INT, after INT, letters VARCHAR, cost INT)")
    con.executemany("INSERT INTO moves VALUES (?, ?, ?, ?, ?, ?)", moves())
    return con


def _illegal(initials: str) -> int:
    return sum(initials[k : k + 2] not in ("su", "ua", "au") for k in range(len(initials) - 1))


def solve_blocks(rows: DataFrame, block: int = BLOCK, query_rows: int = QUERY_ROWS) -> DataFrame:
    """conv, block, whole (no other block can hold rows of it), head and tail (first and last initials), illegal (inside), paths: of each conversation's piece in each block."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        con = _connection()
        shape = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))

        def solved(t):
            conv, at = t.column("conv").to_pylist(), t.column("block").to_numpy()
            n = len(conv)
            new = np.array([True] + [conv[k] != conv[k - 1] or at[k] != at[k - 1] for k in range(1, n)])
            piece = np.cumsum(new) - 1
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, n))
            first = np.append(True, at[start][1:] != at[start][:-1])  # of its block: may go on from the block before
            last = np.append(at[start][1:] != at[start][:-1], True)
            turns = pa.table({"piece": piece, "k": np.arange(n) - start[piece] + 1, "initial": t.column("initial"), "fault": t.column("fault")})
            pieces = pa.table({"piece": np.arange(len(start)), "n": size, "open": first})
            con.register("turns", turns)
            con.register("pieces", pieces)
            paths = dict(con.execute(ROWS_SQL).fetchall())
            con.unregister("turns")
            con.unregister("pieces")
            letters = "".join(t.column("initial").to_pylist())
            own = [letters[a : a + s] for a, s in zip(start.tolist(), size.tolist())]
            columns = [[conv[k] for k in start], at[start], ~(first | last), [x[0] for x in own], [x[-1] for x in own], [_illegal(x) for x in own], [paths[k] for k in range(len(start))]]
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.int64(), shape]
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["conv", "block", "whole", "head", "tail", "illegal", "paths"])

        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            if held.num_rows >= query_rows:
                at = held.column("block").to_numpy()
                ends = int(np.searchsorted(at, at[-1]))  # the last block may go on
                if ends:
                    yield solved(held.slice(0, ends).combine_chunks())
                    held = held.slice(ends)
        if held is not None and held.num_rows:
            yield solved(held.combine_chunks())

    dealt = rows.select("conv", F.floor(F.col("row_pos") / block).cast("long").alias("block"), "row_pos", "initial", "fault").repartition("block").sortWithinPartitions("block", "row_pos")
    return dealt.mapInArrow(run, f"conv string, block long, whole boolean, head string, tail string, illegal long, paths {PATHS}")


def join_pieces(pieces: DataFrame) -> DataFrame:
    """conv, illegal, paths (from state 0) of the conversations in solve_blocks' form that may lie in several blocks."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        con = _connection()
        shape = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))

        def solved(rows):
            k, illegal, last, table = {}, {}, {}, []
            for conv, head, tail, inside, paths in rows:
                k[conv] = k.get(conv, 0) + 1
                illegal[conv] = illegal.get(conv, 0) + inside + (_illegal(last[conv] + head) if conv in last else 0)
                last[conv] = tail
                table += [(conv, k[conv], p["entry"], p["exit"], p["cost"], p["audit"]) for p in paths]
            con.register("paths", pa.table({c: [x[i] for x in table] for i, c in enumerate(("conv", "k", "entry", "exit", "cost", "audit"))}))
            found = con.execute(PIECES_SQL).fetchall()
            con.unregister("paths")
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([illegal[x[0]] for x in found], pa.int64()), pa.array([x[1] for x in found], shape)], ["conv", "illegal", "paths"])

        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv", "head", "tail", "illegal", "paths"))):
                if len(held) >= 256 and row[0] != held[-1][0]:
                    yield solved(held)
                    held = []
                held.append(row)
        if held:
            yield solved(held)

    return pieces.repartition("conv").sortWithinPartitions("conv", "block").select("conv", "head", "tail", "illegal", "paths").mapInArrow(run, f"conv string, illegal long, paths {PATHS}")


def cheapest(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv, illegal, cost, audit of each conversation in faulty's form."""
    pieces = cut(solve_blocks(rows, block))
    solved = pieces.where("whole").select("conv", "illegal", "paths").union(join_pieces(pieces.where("NOT whole")))
    ways = solved.select("conv", "illegal", F.explode("paths").alias("p"))
    missing = F.when(F.col("p.exit") == 1, 2).when(F.col("p.exit") == 2, 1).otherwise(0)  # turns up to a state that may end
    done = F.struct((F.col("p.cost") + INSERT * missing).alias("cost"), F.concat("p.audit", F.repeat(F.lit("I"), missing)).alias("audit"))
    return ways.groupBy("conv").agg(F.first("illegal").alias("illegal"), F.min(done).alias("d")).select("conv", "illegal", "d.cost", "d.audit")


def _applied(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv, repaired_sha256: the audits applied to the rows; a task holds one conversation's audit and one batch of rows."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        conv, letters, at, state, digest, lines = None, "", 0, 0, None, 0
        done: list[tuple] = []

        def say(role: str, text: str) -> None:
            nonlocal lines
            digest.update(("\n" if lines else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            lines += 1

        def inserted() -> None:
            nonlocal at, state
            while at < len(letters) and letters[at] == "I":
                say("assistant" if state == 2 else "user", "")
                state, at = NEXT[state], at + 1

        def finish() -> None:
            if conv is not None:
                inserted()
                done.append((conv, digest.hexdigest()))

        def made():
            out = pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], pa.string()) for k in range(2)], ["conv", "repaired_sha256"])
            done.clear()
            return out

        for batch in batches:
            for who, audit, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text"))):
                if audit is not None:
                    finish()
                    conv, letters, at, state, digest, lines = who, audit, 0, 0, hashlib.sha256(), 0
                    continue
                inserted()
                letter, at = letters[at], at + 1
                if letter == "K":
                    say(role, text)
                    state = KEEPS[state, role[0]]
                elif letter == "R":
                    say("assistant" if state == 2 else "user", text)
                    state = NEXT[state]
            if len(done) >= 10_000:
                yield made()
        finish()
        if done:
            yield made()

    texts = _hashed(rows).select(*ORDER, F.lit(True).alias("is_row"), F.lit(None).cast("string").alias("audit"), "role", "text")
    heads = found.select("conv", F.lit(False).alias("is_row"), "audit")
    both = texts.unionByName(heads, allowMissingColumns=True).repartition("conv").sortWithinPartitions("conv", "is_row", *ORDER[1:])
    return both.select("conv", "audit", "role", "text").mapInArrow(run, "conv string, repaired_sha256 string")


def repair_turns(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each conv_id of turns (conv_id, turn, role, text), damaged and repaired: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Nulls in role and text are a space, null ids one conversation; null turns come first and make no gap. Rows of one turn come in
    the order of hashes of role and text, repeated rows are duplicates. A conversation without rows after the damage has zeros, an empty
    audit and the digest of nothing. Other columns are left out, so none can clash. Empty: no rows.
    """
    rows = cut(damaged(turns))
    faults = cut(faulty(rows))
    found = cut(cheapest(faults, block))
    n = lambda k: F.count_if(F.col("fault") == k)
    per = faults.groupBy("conv", "turn").agg(*[n(k).alias(f"f{k}") for k in (1, 2, 3)]).groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"), F.sum("f1").alias("blank"), F.sum("f2").alias("duplicate"), F.sum("f3").alias("truncated"),
    )
    everyone = turns.select("conv_id").distinct().withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
    out = everyone.join(per, "conv", "left").join(found, "conv", "left").join(_applied(rows, found), "conv", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
