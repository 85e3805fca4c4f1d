"""Secrets: fixed kinds by pattern, and random-looking strings by a battery of randomness tests with false-discovery control.

A candidate is a run of 16 or more characters that encodings of keys use. Its encoding is the smallest of ENCODINGS that has
all its characters. Three tests ask whether it may be uniform in that encoding: chi-squared over groups of symbols, runs
above and below the middle of the alphabet, and serial correlation of neighbours. What passes all three is held against
ordinary text: the likelihood ratio of uniform symbols to the pairs of characters that the corpus has outside of candidates. Under ordinary text its mean is
at most one, at every length, so it is an e-value that grows with the length of a random string: short strings need far rarer
pairs than long ones. The e-values of all candidates of the corpus decide together (e-BH), so of what is reported at most
the share FALSE_SHARE is ordinary text, however candidates depend on each other.

Pairs are counted over all texts (at most 129 x 129 sums travel), the decision needs a count for each score (BINS * MOST at
most): no string leaves its task, and nothing is joined.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

KINDS = ("assign", "access", "hex", "random")
#: Of the strings that the tests add, this share may be ordinary text.
FALSE_SHARE = 0.01
SHORTEST = 16
#: Scores are logarithms of e-values, rounded down to 1 / BINS, MOST at most.
BINS, MOST = 8, 1_000

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{SHORTEST},}}={{0,2}}")
_DIGITS, _UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
#: Alphabets from the smallest on.
ENCODINGS = {
    "decimal": _DIGITS, "hex": _DIGITS + "abcdef", "hex_upper": _DIGITS + "ABCDEF", "lower": _LOWER, "upper": _UPPER, "base32": _UPPER + "234567", "base36": _DIGITS + _LOWER,
    "base36_upper": _DIGITS + _UPPER, "base62": _DIGITS + _UPPER + _LOWER, "base64": _UPPER + _LOWER + _DIGITS + "+/", "base64_url": _UPPER + _LOWER + _DIGITS + "-_",
}
_SETS = {name: frozenset(a) for name, a in ENCODINGS.items()}
_SYMBOLS = _DIGITS + _UPPER + _LOWER + "+/_-"
#: Characters of the pair counts: ASCII, and one for all others.
_CODES = 129


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, by start, then kind: leftmost matches that don't overlap, for each kind; failing ones dropped."""
    low, out = text.lower(), []
    if any(x in low for x in ("passw", "secret", "token", "key")):  # else the pattern needn't look at each place
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def encoding_of(body: str) -> str | None:
    """The smallest encoding with all characters of the string; none: null."""
    used = set(body)
    return next((name for name, a in _SETS.items() if used <= a), None)


def battery_level(n: int) -> float:
    """A string of n symbols fails the battery if one of its three p-values is below a third of this, the share of random strings that are lost.

    p-values of regular strings fall exponentially with the length, so the level does: 1 in 250 at 16 symbols, 1 in 60,000 at 40.
    """
    return 10 ** (-(n + 8) / 10)


def battery(values, k: int) -> tuple[float, float, float]:
    """p-values (uniformity, runs, serial correlation) of a string of symbols 0..k-1 under the hypothesis that they are uniform and independent."""
    import numpy as np

    n = len(values)
    groups = max(2, min(k, n // 5))
    edges = np.arange(k) * groups // k  # symbols to groups of nearly equal size
    expected = np.bincount(edges, minlength=groups) * (n / k)
    x = float(((np.bincount(edges[values], minlength=groups) - expected) ** 2 / expected).sum())
    d = groups - 1
    z = ((x / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d))  # Wilson and Hilferty's approximation
    uniform = math.erfc(z / math.sqrt(2)) / 2
    high = values >= k / 2
    above = int(high.sum())
    below = n - above
    if not above or not below:
        return uniform, 0.0, 0.0
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 2 * above * below / n + 1
    var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
    v = values - values.mean()
    serial = (float((v[1:] * v[:-1]).sum()) / float((v * v).sum()) + 1 / n) * math.sqrt(n)
    return uniform, math.erfc(abs(runs - mean) / math.sqrt(2 * var)), math.erfc(abs(serial) / math.sqrt(2))


def log_evidence(text: str, log_pairs) -> float | None:
    """The logarithm of a string's e-value against ordinary text; null: no encoding, or the battery rejects it. log_pairs: see pair_model."""
    import numpy as np

    body = text.rstrip("=")
    name = encoding_of(body)
    if name is None:
        return None
    codes = np.frombuffer(body.encode("ascii"), dtype=np.uint8)
    alphabet = ENCODINGS[name]
    at = np.zeros(128, dtype=np.int64)
    at[[ord(c) for c in alphabet]] = range(len(alphabet))
    if min(battery(at[codes], len(alphabet))) < battery_level(len(codes)) / 3:
        return None
    ratio = -math.log(len(alphabet)) * (len(codes) - 1) - float(log_pairs[codes[:-1], codes[1:]].sum())
    return ratio - math.log(len(ENCODINGS))  # the encoding was chosen by the string


def pair_counts(docs: DataFrame) -> DataFrame:
    """pair (129 * first + second, 128 for every character beyond ASCII), n: of all neighbouring characters of all texts, candidates read as a space."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = np.zeros(_CODES * _CODES, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                raw = text.as_py()
                if raw:
                    raw = _CANDIDATE.sub(" ", raw)
                    codes = np.minimum(np.frombuffer(raw.encode("utf-8", "surrogatepass"), dtype=np.uint8), _CODES - 1).astype(np.int64)
                    for lo in range(0, len(codes) - 1, 1 << 20):
                        part = codes[lo : lo + (1 << 20) + 1]
                        total += np.bincount(part[:-1] * _CODES + part[1:], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["pair", "n"])

    return docs.select("text").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def pair_model(counts: DataFrame):
    """log P(second | first, the string goes on), a numpy array of 128 x 128, from pair_counts: half a count more for each pair of symbols."""
    import numpy as np

    seen = np.zeros((_CODES, _CODES))
    for pair, n in counts.collect():  # 129 * 129 rows at most
        seen[pair // _CODES, pair % _CODES] = n
    symbols = [ord(c) for c in _SYMBOLS]
    out = np.zeros((128, 128))
    part = seen[np.ix_(symbols, symbols)] + 0.5
    out[np.ix_(symbols, symbols)] = np.log(part / part.sum(axis=1, keepdims=True))
    return out


def scan(docs: DataFrame, log_pairs) -> DataFrame:
    """doc_id, base (start, kind, end), candidates (start, end, score: the rounded log e-value, null if the battery rejects it) of every row."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
        candidate = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.int32())]))
        for batch in batches:
            bases, others = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                base, found = base_spans(text), []
                reach, k, ordered = -1, 0, [(a, b) for a, _, b in base]
                for m in _CANDIDATE.finditer(text):
                    while k < len(ordered) and ordered[k][0] < m.end():
                        reach, k = max(reach, ordered[k][1]), k + 1
                    if reach <= m.start():  # meets no base span
                        e = log_evidence(m[0], log_pairs)
                        found.append({"start": m.start(), "end": m.end(), "score": None if e is None else max(0, min(BINS * MOST, math.floor(BINS * e)))})
                bases.append([{"start": a, "kind": kind, "end": b} for a, kind, b in base])
                others.append(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bases, span), pa.array(others, candidate)], ["doc_id", "base", "candidates"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, base array<struct<start:int,kind:int,end:int>>, candidates array<struct<start:int,end:int,score:int>>")


def discovery_score(counts: list[tuple[int | None, int]], share: float = FALSE_SHARE) -> int:
    """The lowest score that counts as a discovery, from (score, how many candidates): e-BH over all candidates; none: above every score."""
    m = sum(n for _, n in counts)
    reached, found = 0, BINS * MOST + 1
    for score, n in sorted(((s, n) for s, n in counts if s is not None), reverse=True):
        reached += n
        if score / BINS >= math.log(m / (share * reached)):
            found = score
    return found


def find_secrets(docs: DataFrame, share: float = FALSE_SHARE) -> DataFrame:
    """doc_id, base and spans: arrays of (start, kind, end), by start, then kind; a row for each row.

    spans holds base and the random strings, which meet no base span. Starts and ends are code points of the whole text. Null
    and empty texts: none. Repeated rows are rows of their own, and each of their strings is a candidate. Other columns are left
    out, so none can clash. Empty: no rows.
    """
    rows = cut(scan(docs, pair_model(pair_counts(docs))))
    counts = rows.select(F.explode("candidates").alias("c")).groupBy("c.score").agg(F.count("*").alias("n")).collect()  # BINS * MOST + 2 rows at most
    least = discovery_score([(r["score"], r["n"]) for r in counts], share)
    more = F.transform(F.filter("candidates", lambda c: c["score"] >= least), lambda c: F.struct(c["start"].alias("start"), F.lit(len(KINDS) - 1).alias("kind"), c["end"].alias("end")))
    return rows.select("doc_id", "base", F.sort_array(F.concat("base", more)).alias("spans"))


def joined(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
