"""Quality by attention-based multiple-instance learning.

A text is a bag of passages of PASSAGE words. Each passage is encoded from counts of its characters and words; gated
attention weighs the encodings, and the weighted sum gives the score. Encoder, gate and score are learnt together, in
numpy, in one task, from document labels of a bounded sample.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

from .labelled import held_out, learnt, sample, threshold

PASSAGE = 64
HIDDEN, GATE = 16, 8
#: Labelled documents to learn from at most: of label 0, of label 1.
SAMPLE = (2_000, 3_000)
AT = 0.3
FOLD, OUT = 5, 0
#: Character classes by byte: 0 blank, 1 newline, then as below; bytes over 127 are letters of other alphabets.
_CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",;:", b"!", b"|", b"#*$%&<>", b"=_/\\@+~^`\"'()[]{}?-")
N_CLASSES = 2 + len(_CLASSES) + 1
N_FEATURES = N_CLASSES + 6


def _classes():
    import numpy as np

    lut = np.full(256, N_CLASSES - 1, dtype=np.int64)
    lut[list(b" \t\x0b\x0c\r")] = 0
    lut[10] = 1
    for k, chars in enumerate(_CLASSES):
        lut[list(chars)] = 2 + k
    return lut


def encode(text: str, lut=None):
    """Passages x N_FEATURES; a text without words is one passage of zeros."""
    import numpy as np

    lut = _classes() if lut is None else lut
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return np.zeros((1, N_FEATURES))
    n = -(-len(words) // PASSAGE)
    counts = np.zeros((n, N_CLASSES))
    seen, at, lo = 0, 0, 0
    raw = np.frombuffer(data, dtype=np.uint8)
    last_blank = True
    for lo in range(0, len(raw), 4_000_000):  # bounded memory, whatever the length
        c = lut[raw[lo : lo + 4_000_000]]
        blank = c < 2
        starts = ~blank & np.concatenate([[last_blank], blank[:-1]])
        passage = np.maximum(seen + np.cumsum(starts) - 1, 0) // PASSAGE
        counts += np.bincount(passage * N_CLASSES + c, minlength=n * N_CLASSES).reshape(n, N_CLASSES)
        seen += int(starts.sum())
        last_blank = bool(blank[-1])
    sizes = np.full(n, PASSAGE)
    sizes[-1] = len(words) - PASSAGE * (n - 1)
    every: set = set()
    more = np.zeros((n, 6))
    for k in range(n):
        own = set(words[k * PASSAGE : (k + 1) * PASSAGE])
        new = len(own - every)
        every |= own
        more[k] = len(own) / sizes[k], new / sizes[k], sizes[k] / PASSAGE, math.log1p(n), len(every) / (k * PASSAGE + sizes[k]), k == 0
    per_word = counts[:, :2] / sizes[:, None]
    shares = counts[:, 2:] / np.maximum(1, counts[:, 2:].sum(axis=1, keepdims=True))
    letters = np.log1p(counts[:, 2:].sum(axis=1, keepdims=True) / sizes[:, None])
    more[:, 5] = letters[:, 0]
    return np.concatenate([per_word, shares, more], axis=1)


@dataclass
class Model:
    mean: object
    scale: object
    p: dict
    shift: float = 0.0

    def logits(self, bags) -> list[float]:
        import numpy as np

        if not bags:
            return []
        starts = np.cumsum([0, *map(len, bags)])[:-1]
        return _forward(self.p, self.normal(np.concatenate(bags)), starts)["s"].tolist()

    def normal(self, x):
        import numpy as np

        return np.clip((x - self.mean) / self.scale, -6, 6)

    def score(self, logit: float) -> float:
        x = logit - self.shift + math.log(AT / (1 - AT))
        return 1 / (1 + math.exp(-x)) if x > -500 else 0.0


def _forward(p, x, starts):
    import numpy as np

    sizes = np.diff(np.append(starts, len(x)))
    h = np.tanh(x @ p["W"] + p["b"])
    a1, a2 = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-h @ p["U"]))
    g = (a1 * a2) @ p["w"]
    g = np.exp(g - np.repeat(np.maximum.reduceat(g, starts), sizes))
    alpha = g / np.repeat(np.add.reduceat(g, starts), sizes)
    z = np.add.reduceat(alpha[:, None] * h, starts, axis=0)
    return {"h": h, "a1": a1, "a2": a2, "alpha": alpha, "z": z, "s": z @ p["c"] + p["c0"][0], "sizes": sizes}


def train(bags: list, y: list[int], steps: int = 400, rate: float = 0.02, decay: float = 1e-4, seed: int = 11) -> Model:
    """Adam over all bags at once; a missing class gives a constant score."""
    import numpy as np

    rng = np.random.default_rng(seed)
    x = np.concatenate(bags) if bags else np.zeros((1, N_FEATURES))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    p = {"W": rng.normal(0, 0.3, (N_FEATURES, HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, 0.3, (HIDDEN, GATE)), "U": rng.normal(0, 0.3, (HIDDEN, GATE)), "w": rng.normal(0, 0.3, GATE), "c": rng.normal(0, 0.3, HIDDEN), "c0": np.zeros(1)}
    model = Model(mean, scale, p)
    if not y or min(y) == max(y):
        p["c"][:] = 0
        p["c0"][0] = -8.0 if y and not max(y) else 8.0
        return model
    x, t = model.normal(x), np.array(y, dtype=float)
    starts = np.cumsum([0, *map(len, bags)])[:-1]
    weight = np.where(t == 1, 0.5 / t.mean(), 0.5 / (1 - t.mean())) / len(t)
    m, v = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}
    for step in range(1, steps + 1):
        f = _forward(p, x, starts)
        h, a1, a2, alpha, sizes = f["h"], f["a1"], f["a2"], f["alpha"], f["sizes"]
        ds = (1 / (1 + np.exp(-f["s"])) - t) * weight
        dz = np.repeat(ds[:, None] * p["c"], sizes, axis=0)
        da = (dz * h).sum(axis=1)
        dg = alpha * (da - np.repeat(np.add.reduceat(alpha * da, starts), sizes))
        d1, d2 = dg[:, None] * p["w"] * a2 * (1 - a1 * a1), dg[:, None] * p["w"] * a1 * a2 * (1 - a2)
        dh = (alpha[:, None] * dz + d1 @ p["V"].T + d2 @ p["U"].T) * (1 - h * h)
        grad = {"W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ d1, "U": h.T @ d2, "w": (a1 * a2).T @ dg, "c": f["z"].T @ ds, "c0": np.array([ds.sum()])}
        for k in p:
            gk = grad[k] + decay * p[k] * (k != "c0")
            m[k] = 0.9 * m[k] + 0.1 * gk
            v[k] = 0.999 * v[k] + 0.001 * gk * gk
            p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def learn(rows: Iterator) -> Model:
    """The model from (text, label, lang); every fifth row sets where the score reads AT."""
    lut, bags, y = _classes(), [], []
    for text, v, _ in rows:
        bags.append(encode(text, lut))
        y.append(v)
    back = [k % 5 == 0 for k in range(len(y))]
    model = train([b for b, k in zip(bags, back) if not k], [v for v, k in zip(y, back) if not k])
    model.shift = threshold(model.logits([b for b, k in zip(bags, back) if k]), [v for v, k in zip(y, back) if k])
    return model


def fit(docs: DataFrame, labels: DataFrame, rows: tuple[int, int] = SAMPLE) -> Model:
    """The model from labels (doc_id, quality)."""
    return learnt(sample(docs, labels, "quality", FOLD, OUT, rows), learn)


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """docs and score (0 to 1; higher: better).

    Null, empty and blank texts get the score of a text without words. Equal texts score alike. A column of this name is
    replaced. Empty: no rows.
    """
    docs = docs.drop("score")
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lut, model = _classes(), sent.value
        for batch in batches:
            scores = []
            for lo in range(0, batch.num_rows, 64):
                bags = [encode(x.as_py() or "", lut) for x in batch.column("text").slice(lo, 64)]
                scores += map(model.score, model.logits(bags))
            yield batch.append_column("score", pa.array(scores, pa.float64()))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType())]))


def held():
    return held_out(FOLD, OUT)
