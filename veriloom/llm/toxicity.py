"""Toxicity by a convolutional text classifier.

A word is the sum of three hashed embeddings: the word, its first four and its first five letters. Filters of several
widths run over the whole text, the maximum of each over all positions goes to a logistic unit. Trained in numpy, in one
task, on a bounded sample of labelled rows; the sample's held-back part sets where the score reads 0.7, and for each
language a threshold of its own. The score knows the text alone; the language only chooses a threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .labelled import held_out, learnt, sample, threshold

BUCKETS = 2**18
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Labelled documents to learn from at most: of label 0, of label 1.
SAMPLE = (3_000, 1_500)
AT = 0.7
FOLD, OUT = 3, 1
#: Words whose projections a worker keeps at most.
KEPT = 150_000
_EDGE = ".,;:!?\"'()[]{}<>|*#$%&-_/\\"


def word_features(word: str) -> tuple[int, int, int]:
    from zlib import crc32

    w = word.lower().strip(_EDGE)
    return tuple(crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in (f"w{w}", f"4{w[:4]}", f"5{w[:5]}"))


@dataclass
class Model:
    emb: object  # BUCKETS x DIM
    conv: list  # for each width: width x DIM x FILTERS
    bias: list
    out: object
    bias_out: float
    shift: float = 0.0
    thresholds: dict = field(default_factory=dict)

    def score(self, logit: float) -> float:
        x = logit - self.shift + math.log(AT / (1 - AT))
        return 1 / (1 + math.exp(-x)) if x > -500 else 0.0


def _forward(model: Model, x):
    """x: n x DIM, n >= the largest width. (logit, pooled values, their positions)."""
    import numpy as np

    pooled, places = [], []
    for k, w, b in zip(WIDTHS, model.conv, model.bias):
        y = sum(x[j : len(x) - k + 1 + j] @ w[j] for j in range(k)) + b
        at = y.argmax(axis=0)
        places.append(at)
        pooled.append(np.tanh(y[at, np.arange(FILTERS)]))
    h = np.concatenate(pooled)
    return float(h @ model.out + model.bias_out), h, places


class Words:
    """Numbers of words as they come, and the three features of each; number 0 is padding."""

    def __init__(self):
        self.number: dict[str, int] = {"": 0}
        self.features: list[tuple[int, int, int]] = [(BUCKETS, BUCKETS, BUCKETS)]

    def read(self, text: str):
        import numpy as np

        out = np.zeros(max(len(w := text.split()), max(WIDTHS)), dtype=np.int32)
        for k, x in enumerate(w):
            i = self.number.get(x)
            if i is None:
                i = self.number[x] = len(self.features)
                self.features.append(word_features(x))
            out[k] = i
        return out


def train(words: Words, docs: list, y: list[int], updates: int = 15_000, rate: float = 0.08, seed: int = 7) -> Model:
    """AdaGrad over single documents (numbers of words) in a fixed order; a missing class gives a constant score."""
    import numpy as np

    rng = np.random.default_rng(seed)
    feats = np.array(words.features, dtype=np.int32)
    of = lambda d: np.unique(feats[np.unique(d)])
    emb = np.zeros((BUCKETS + 1, DIM), dtype=np.float32)  # the last row: padding
    # A feature of one or two documents could only learn to name them: it stays at zero, like an unseen one.
    df, hits = np.zeros(BUCKETS + 1, dtype=np.int64), np.zeros(BUCKETS + 1, dtype=np.int64)
    for d, v in zip(docs, y):
        own = of(d)
        df[own] += 1
        hits[own] += v
    common = df >= (3 if len(docs) >= 1_000 else 2)
    common[BUCKETS] = False
    feats = np.where(common[feats], feats, BUCKETS)
    used = np.flatnonzero(common)
    emb[used] = rng.normal(0, 0.02, (len(used), DIM))
    conv = [rng.normal(0, 0.3, (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS]
    model = Model(emb, conv, [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS], rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32), -1.0)
    # The first coordinate starts as the feature's shrunken log odds, and each width's first filter reads it.
    if docs and len(used):
        hits = hits[used]
        pos = max(1, sum(y))
        odds = np.log((hits + 0.5) / (pos + 1)) - np.log((df[used] - hits + 0.5) / (len(y) - sum(y) + 1))
        emb[used, 0] += 0.3 * odds * df[used] / (df[used] + 4)
        for j, w in enumerate(conv):
            w[:, :, 0] *= 0.1
            w[:, 0, 0] += 1 / len(w)
            model.out[j * FILTERS] = 1.0
    if not y or min(y) == max(y):
        model.out[:] = 0
        model.bias_out = 8.0 if y and max(y) else -8.0
        return model
    cells = {"emb": np.full(emb.shape, 1e-2, dtype=np.float32), "out": np.full(model.out.shape, 1e-2), "bias_out": 1e-2}
    conv_cells = [np.full(c.shape, 1e-2) for c in conv]
    bias_cells = [np.full(FILTERS, 1e-2) for _ in WIDTHS]
    for _ in range(max(5, min(40, updates // max(1, len(docs))))):
        for i in rng.permutation(len(docs)):
            ids = feats[docs[i]]
            x = emb[ids].sum(axis=1)
            logit, h, places = _forward(model, x)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))
            g = p - y[i]
            if abs(g) < 0.01:
                continue
            dh = g * model.out * (1 - h * h)
            go = g * h
            cells["out"] += go * go
            model.out -= (rate * go / np.sqrt(cells["out"])).astype(np.float32)
            cells["bias_out"] += g * g
            model.bias_out -= rate * g / math.sqrt(cells["bias_out"])
            hot, grads = [], []
            for j, (k, w) in enumerate(zip(WIDTHS, conv)):
                d = dh[j * FILTERS : (j + 1) * FILTERS]
                for o in range(k):
                    at = places[j] + o
                    hot.append(at)
                    grads.append(d[:, None] * w[o].T)
                gw = np.stack([(x[places[j] + o] * d[:, None]).T for o in range(k)])
                conv_cells[j] += gw * gw
                w -= (rate * gw / np.sqrt(conv_cells[j])).astype(np.float32)
                bias_cells[j] += d * d
                model.bias[j] -= (rate * d / np.sqrt(bias_cells[j])).astype(np.float32)
            hot, grads = np.concatenate(hot), np.concatenate(grads)
            rows = ids[hot].ravel()
            ge = np.repeat(grads, 3, axis=0)
            uniq, inv = np.unique(rows, return_inverse=True)
            total = np.zeros((len(uniq), DIM))
            np.add.at(total, inv, ge)
            total[uniq == BUCKETS] = 0
            cells["emb"][uniq] += total * total
            emb[uniq] -= (rate * total / np.sqrt(cells["emb"][uniq])).astype(np.float32)
    return model


class _Scorer:
    """Projections of each word on all filters, kept by word; a text then needs sums and maxima only."""

    def __init__(self, model: Model):
        import numpy as np

        self.np, self.model = np, model
        self.flat = np.concatenate([w[j] for w in model.conv for j in range(len(w))], axis=1)  # DIM x (sum of widths * FILTERS)
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = self.np.zeros((0, self.flat.shape[1]), dtype=self.np.float32)

    def _learn(self, unseen: list[str]) -> None:
        np = self.np
        feats = np.array([word_features(w) for w in unseen], dtype=np.int64).reshape(-1, 3)
        made = self.model.emb[feats].sum(axis=1) @ self.flat
        n = len(self.rows)
        if n + len(unseen) > len(self.table):
            bigger = np.zeros((max(2 * len(self.table), n + len(unseen), 4_096), self.flat.shape[1]), dtype=np.float32)
            bigger[:n] = self.table[:n]
            self.table = bigger
        self.table[n : n + len(unseen)] = made
        self.rows.update(zip(unseen, range(n, n + len(unseen))))

    def _maxima(self, words: list[str]):
        np = self.np
        rows = self.rows
        unseen = [w for w in set(words) if w not in rows]
        if unseen:
            if len(self.rows) + len(unseen) > KEPT:
                self._clear()
                unseen = list(set(words))
            self._learn(unseen)
        p = self.table[np.fromiter(map(self.rows.__getitem__, words), dtype=np.int64, count=len(words))]
        if len(p) < max(WIDTHS):  # padding projects to zero
            p = np.concatenate([p, np.zeros((max(WIDTHS) - len(p), p.shape[1]), dtype=np.float32)])
        out, col = [], 0
        for k in WIDTHS:
            y = p[: len(p) - k + 1, col : col + FILTERS]
            for j in range(1, k):
                y = y + p[j : len(p) - k + 1 + j, col + j * FILTERS : col + (j + 1) * FILTERS]
            out.append(y.max(axis=0))
            col += k * FILTERS
        return np.concatenate(out)

    def logits(self, texts, chunk: int = 100_000):
        np = self.np
        bias = np.concatenate(self.model.bias)
        for text in texts:
            words = (text or "").split()
            best = self._maxima(words[: chunk + 2])
            for lo in range(chunk, max(chunk, len(words) - 2), chunk):  # the windows that begin in each further chunk
                best = np.maximum(best, self._maxima(words[lo : lo + chunk + 2]))
            yield float(np.tanh(best + bias) @ self.model.out + self.model.bias_out)


def learn(rows: Iterator) -> Model:
    """The model from (text, label, lang); its score and thresholds are set on every fifth row."""
    words, docs, y, back = Words(), [], [], []
    for k, (text, v, lang) in enumerate(rows):
        if k % 5 == 0:
            back.append((text, v, lang))
        else:
            docs.append(words.read(text))
            y.append(v)
    model = train(words, docs, y)
    found = list(_Scorer(model).logits(t for t, _, _ in back))
    model.shift = threshold(found, [v for _, v, _ in back])
    for lang in sorted({g for _, _, g in back if g is not None}):
        own = [(x, v) for x, (_, v, g) in zip(found, back) if g == lang]
        if min(sum(v for _, v in own), sum(1 - v for _, v in own)) >= 20:
            model.thresholds[lang] = model.score((threshold(*zip(*own)) + model.shift) / 2)
    return model


def fit(docs: DataFrame, labels: DataFrame, rows: tuple[int, int] = SAMPLE) -> Model:
    """The model from labels (doc_id, toxic)."""
    return learnt(sample(docs, labels, "toxic", FOLD, OUT, rows), learn)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """docs and score (0 to 1) and toxic (whether it reaches its language's threshold, or AT).

    Null, empty and blank texts get the score of a text without words. Equal texts score alike. Columns of these names are
    replaced. Empty: no rows.
    """
    docs = docs.drop("score", "toxic")
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scorer = _Scorer(sent.value)
        for batch in batches:
            texts = (x.as_py() for x in batch.column("text"))
            yield batch.append_column("score", pa.array([sent.value.score(x) for x in scorer.logits(texts)], pa.float64()))

    out = docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType())]))
    at = F.lit(AT)
    if model.thresholds and "lang" in docs.columns:
        table = F.create_map(*[F.lit(x) for kv in model.thresholds.items() for x in kv])
        at = F.coalesce(F.element_at(table, F.col("lang")), at)
    return out.withColumn("toxic", F.col("score") >= at)


def held():
    return held_out(FOLD, OUT)
