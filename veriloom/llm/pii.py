"""Personal data: fixed kinds by pattern and check, and bootstrapped contextual extraction.

The fixed kinds' matches are the seeds. Their contexts are lexical patterns, from narrow to wide: two words before; a word
before and one after; one word before, with the marks between; the shapes of the words around and of the string itself.
Spark scores the graph of patterns and instances in turns: a pattern is as good as the share of the identifier-like strings
in its place that are instances of its kind, an unseen string as good as its patterns; what is good enough counts as an
instance in the next turn, until no score changes. Strings that patterns of high confidence surround, and whose form suits
the kind, are found too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, lookup

KINDS = ("email", "ip", "card", "phone")
#: Turns after which scores that still change are an error.
ROUNDS = 50
#: A pattern needs so many instances (of any document) and such a smoothed share.
SUPPORT = 5
CONFIDENCE = 0.8

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
#: Identifier-like strings and the kinds that their forms suit.
_FORMS = (
    (re.compile(r"(?<![\w.+-])[\w.+-]++(?:@| ?[\[(]at[\])] ?)[\w-]++(?:(?:\.| ?[\[(]dot[\])] ?)[\w-]++)*"), (0,)),
    (re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![\w:.])"), (1,)),
    (re.compile(r"(?<![\w.+-])[(0-9](?:[\x20().-]{0,2}[0-9]){6,18}(?![\w])"), (2, 3)),
)


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, by start, then kind: leftmost matches that don't overlap, for each kind; failing ones dropped."""
    out = []
    free, at = 0, text.find("@")
    while at >= 0:
        # The run of local characters before an @ since the last match: the leftmost start. Each character is looked at once.
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _DIGITS.sub("", m[0])) <= 19 and _luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGITS.sub("", m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


_BEFORE = re.compile(r"(?:([^\W\d_]+)[\W\d_]*)?([^\W\d_]+)([\W\d_]*)\Z")
_AFTER = re.compile(r"[\W\d_]*([^\W\d_]+)")
_RUNS = re.compile(r"[0-9]+|[^\W\d_]+")


def _shape(word: str) -> str:
    return "" if not word else "X" if word.isupper() else "Xx" if word[:1].isupper() else "x"


def _patterns(text: str, start: int, end: int) -> list[str]:
    """The patterns of a place, whole words however long."""
    lo = start
    for _ in range(3):  # the two words before and the marks between: a window that begins at a blank or at the text's start
        lo = max(text.rfind(" ", 0, lo), text.rfind("\n", 0, lo), -1)
        if lo < 0:
            lo = 0
            break
    m = _BEFORE.search(text[lo:start])
    second, first, marks = (m[1] or "", m[2], m[3].strip()) if m else ("", "", "")
    m = _AFTER.match(text, end)
    after = m[1] if m else ""
    out = []
    if second:
        out.append(f"{second.lower()} {first.lower()} _")
    if first and after:
        out.append(f"{first.lower()} _ {after.lower()}")
    if first:
        out.append(f"{first.lower()}{marks} _")
    form = _RUNS.sub(lambda r: ("9" if r[0][0] in "0123456789" else "a") + (str(len(r[0])) if r[0][0] in "0123456789" else ""), text[start:end])
    out.append(f"{_shape(second)} {_shape(first)}{marks} [{form}] {_shape(after)}")
    return out


def _others(text: str, base: list) -> list[tuple[int, int, int]]:
    """(start, form, end) of identifier-like strings that no base span meets."""
    if not _DIGIT.search(text) and "@" not in text and "at]" not in text and "at)" not in text:
        return []
    found = [(form, m.start(), m.end()) for form, (regex, _) in enumerate(_FORMS) for m in regex.finditer(text)]
    if not found:
        return []
    taken = bytearray(len(text))  # one look at each place, however many spans there are
    for a, _, b in base:
        taken[a:b] = b"\x01" * (b - a)
    out = []
    for form, a, b in found:
        if not any(taken[a:b]):
            out.append((a, form, b))
            taken[a:b] = b"\x01" * (b - a)
    return sorted(out)


def _scan(docs: DataFrame) -> DataFrame:
    """uid, doc_id, base (start, kind, end), seen (start, end, kind or -1, form or -1, hash, patterns)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        from xxhash import xxh64_intdigest

        uid = TaskContext.get().partitionId() << 40
        span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
        seen_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("form", pa.int32()), ("instance", pa.int64()), ("patterns", pa.list_(pa.string()))]))
        for batch in batches:
            uids, bases, seens = [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                seen = [(a, b, k, -1) for a, k, b in base] + [(a, b, -1, f) for a, f, b in _others(text, base)]
                bases.append([{"start": a, "kind": k, "end": b} for a, k, b in base])
                seens.append([{"start": a, "end": b, "kind": k, "form": f, "instance": xxh64_intdigest(text[a:b].lower().encode("utf-8", "surrogatepass")) - 2**63, "patterns": _patterns(text, a, b)} for a, b, k, f in seen])
                uids.append(uid)
                uid += 1
            yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), batch.column(0), pa.array(bases, span), pa.array(seens, seen_type)], ["uid", "doc_id", "base", "seen"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"uid long, doc_id {kind}, base array<struct<start:int,kind:int,end:int>>, seen array<struct<start:int,end:int,kind:int,form:int,instance:long,patterns:array<string>>>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def score_patterns(places: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """pattern, kind, score of the patterns that pass, from places: pattern, instance, kind (-1: unseen), form.

    A pattern's score for a kind is the sum of its instances' scores for the kind over the number of its distinct
    instances plus one; an unseen instance's score is that of its best passing pattern whose kind suits the form. Scores only
    rise from turn to turn; the turns end when none changes in its third digit.
    """
    edges = cut(places.groupBy("pattern", "instance", "kind", "form").agg(F.count("*").alias("n")))
    suits = [(f, k) for f, (_, kinds) in enumerate(_FORMS) for k in kinds]
    suit = F.array(*[F.lit(10 * f + k) for f, k in suits])
    known = edges.where("kind >= 0").select("pattern", "instance", "kind", F.lit(1.0).alias("score"))
    totals = edges.groupBy("pattern").agg(F.count("*").alias("total"))
    state = None
    for _ in range(rounds):
        per = known.groupBy("pattern", "kind").agg(F.sum("score").alias("hits")).where(F.col("hits") >= support)
        scored = per.join(totals, "pattern").select("pattern", "kind", (F.col("hits") / (F.col("total") + 1)).alias("score"))
        passing = cut(scored.where(F.col("score") >= confidence))
        before, state = state, tuple(passing.agg(F.count("*"), F.bit_xor(F.xxhash64("pattern", "kind", F.round("score", 3)))).first())
        if state == before or not state[0]:
            return passing
        grown = edges.where("kind < 0").join(passing.withColumnsRenamed({"kind": "to"}), "pattern").where(F.array_contains(suit, 10 * F.col("form") + F.col("to")))
        grown = grown.groupBy("instance", F.col("to").alias("kind")).agg(F.max("score").alias("score"))
        unseen = edges.where("kind < 0").select("pattern", "instance").join(grown, "instance").select("pattern", "instance", "kind", "score")
        known = edges.where("kind >= 0").select("pattern", "instance", "kind", F.lit(1.0).alias("score")).union(unseen)
    raise RuntimeError(f"scores still change after {rounds} turns")


def find_pii(docs: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """doc_id, base and spans: arrays of (start, kind, end), by start, then kind; a row for each row.

    spans holds base and what the patterns found, which meets no base span. Starts and ends are code points of the whole
    text. Null and empty texts: none. Repeated rows are rows of their own; an instance counts once for a pattern, however
    often it stands there. Other columns are left out. Empty: no rows.
    """
    rows = cut(_scan(docs))
    seen = rows.select("uid", F.explode("seen").alias("s")).select("uid", "s.*")
    places = seen.select("uid", "start", "end", "kind", "form", "instance", F.explode("patterns").alias("pattern"))
    best = score_patterns(places, rounds, support, confidence).withColumnsRenamed({"kind": "to"})
    best = best.groupBy("pattern").agg(F.max(F.struct("score", (-F.col("to")).alias("k"))).alias("b")).select("pattern", F.col("b.score").alias("score"), (-F.col("b.k")).alias("to"))
    suits = F.array(*[F.lit(10 * f + k) for f, (_, kinds) in enumerate(_FORMS) for k in kinds])
    found = lookup(places.where("kind < 0"), cut(best), "pattern").where(F.array_contains(suits, 10 * F.col("form") + F.col("to")))
    found = found.groupBy("uid", "start", "end").agg(F.max(F.struct("score", (-F.col("to")).alias("k"))).alias("b"))
    found = found.groupBy("uid").agg(F.collect_list(F.struct("start", (-F.col("b.k")).cast("int").alias("kind"), "end")).alias("more"))
    both = rows.select("uid", "doc_id", "base").join(found, "uid", "left")
    spans = F.sort_array(F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    return both.select("doc_id", "base", spans.alias("spans"))


def joined(spans: str):
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
