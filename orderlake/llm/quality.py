"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of about 64 words. Each passage is encoded: counts of its words
and characters go through a learned layer. Gated attention, tanh times sigmoid, weighs the
passages; the weighted representation is scored. Only documents carry labels, so the attention
learns by itself which passages decide.

The model is trained on a bounded sample of labelled documents (``max_documents``, the smallest
hashes of their ids) by full-batch Adam with a fixed seed, and applied to whole texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import free_name, narrowed, pieces

PASSAGE_WORDS = 64
HIDDEN, GATE = 12, 8
_NOT_PLAIN = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:?'\"()-")
_PUNCTUATION = b".,;:?'\"()-"
_DIGITS = b"0123456789"
N_FEATURES = 14


def passages(text: str) -> list[list[str]]:
    """Words in runs of ``PASSAGE_WORDS``; a rest under a quarter of that joins the last run."""
    words = text.split()
    cuts = list(range(0, len(words), PASSAGE_WORDS))
    if len(cuts) > 1 and len(words) - cuts[-1] < PASSAGE_WORDS // 4:
        cuts.pop()
    return [words[a:b] for a, b in zip(cuts, [*cuts[1:], len(words)])]


def features(words: list[str]) -> list[float]:
    """Counts of a passage, as shares of its words or bytes."""
    n = len(words)
    joined = " ".join(words).encode("utf-8", "surrogatepass")
    size = len(joined)

    def share(chars: bytes) -> float:
        return (size - len(joined.translate(None, chars))) / size

    distinct = len(set(words))
    same = sum(map(eq, words, words[1:]))
    upper = sum(map(str.isupper, words))
    alone = sum(len(w) < 2 and not w.isalnum() for w in words)
    symbols = share(_NOT_PLAIN)
    return [
        distinct / n,
        same / n,
        upper / n,
        alone / n,
        math.sqrt(symbols),
        share(_PUNCTUATION),
        share(_DIGITS),
        math.log(size / n),
        sum(map(str.istitle, words)) / n,
        math.log(n),
        max(map(len, words)) / size,
        float(same > 0.2 * n),
        float(symbols > 0.05),
        float(upper > 0.5 * n),
    ]


def bag(text: str | None) -> np.ndarray:
    """A row of features per passage; no rows for a text without words."""
    found = [features(p) for p in passages(text or "")]
    return np.array(found, np.float32).reshape(-1, N_FEATURES)


@dataclass(frozen=True)
class Model:
    """Weights of the encoder, the gated attention and the score; ``rate`` if nothing was learnt."""

    rate: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: tuple[np.ndarray, ...] = ()

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        """Scores from 0 to 1; an empty bag has nothing to speak for it and scores 0."""
        sizes = np.array([len(b) for b in bags])
        out = np.zeros(len(bags))
        full = np.flatnonzero(sizes)
        if not self.weights or not len(full):
            out[full] = self.rate
            return out
        x = (np.concatenate([bags[i] for i in full]) - self.mean) / self.scale
        out[full] = _forward(self.weights, x.astype(np.float64), sizes[full])["score"]
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(weights: tuple[np.ndarray, ...], x: np.ndarray, sizes: np.ndarray) -> dict:
    w, b, v, u, a, c, c0 = weights
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    own = np.repeat(np.arange(len(sizes)), sizes)
    h = np.tanh(x @ w + b)
    tanh, gate = np.tanh(h @ v), _sigmoid(h @ u)
    energy = (tanh * gate) @ a
    share = np.exp(energy - np.maximum.reduceat(energy, starts)[own])
    share /= np.add.reduceat(share, starts)[own]
    z = np.add.reduceat(share[:, None] * h, starts, axis=0)
    score = _sigmoid(z @ c + c0)
    return {"h": h, "tanh": tanh, "gate": gate, "share": share, "z": z, "score": score,
            "own": own, "starts": starts}


def train(bags: list[np.ndarray], labels: list[int], steps: int = 300, seed: int = 11) -> Model:
    """Fit by Adam on the cross-entropy with a small penalty on weights."""
    used = [i for i, x in enumerate(bags) if len(x)]
    y = np.array([labels[i] for i in used], float)
    rate = float(y.mean()) if len(y) else 1.0
    if rate in (0.0, 1.0):
        return Model(rate)
    x = np.concatenate([bags[i] for i in used]).astype(np.float64)
    sizes = np.array([len(bags[i]) for i in used])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - mean) / scale
    random = np.random.default_rng(seed)
    weights = [
        random.normal(0, 0.3, (N_FEATURES, HIDDEN)), np.zeros(HIDDEN),
        random.normal(0, 0.3, (HIDDEN, GATE)), random.normal(0, 0.3, (HIDDEN, GATE)),
        random.normal(0, 0.3, GATE), random.normal(0, 0.3, HIDDEN), np.zeros(1),
    ]
    first = [np.zeros_like(p) for p in weights]
    second = [np.zeros_like(p) for p in weights]
    for step in range(1, steps + 1):
        w, b, v, u, a, c, c0 = weights
        f = _forward(tuple(weights), x, sizes)
        h, own, starts, share = f["h"], f["own"], f["starts"], f["share"]
        d_logit = (f["score"] - y) / len(y)
        d_z = d_logit[:, None] * c
        d_share = (d_z[own] * h).sum(axis=1)
        d_energy = share * (d_share - np.add.reduceat(share * d_share, starts)[own])
        d_both = d_energy[:, None] * a
        d_tanh = d_both * f["gate"] * (1 - f["tanh"] ** 2)
        d_gate = d_both * f["tanh"] * f["gate"] * (1 - f["gate"])
        d_h = share[:, None] * d_z[own] + d_tanh @ v.T + d_gate @ u.T
        d_pre = d_h * (1 - h**2)
        grads = [
            x.T @ d_pre, d_pre.sum(axis=0), h.T @ d_tanh, h.T @ d_gate,
            (f["tanh"] * f["gate"] * d_energy[:, None]).sum(axis=0), f["z"].T @ d_logit,
            np.array([d_logit.sum()]),
        ]
        for p, g, m, s in zip(weights, grads, first, second):
            g = g + 1e-4 * p
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= 0.03 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return Model(rate, mean, scale, tuple(weights))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    allowed: Column,
    *,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_documents: int = 5000,
    max_passages: int = 1024,
) -> Model:
    """Train on at most ``max_documents`` rows of ``labels`` for which ``allowed`` holds.

    ``allowed`` is an expression over the labels' id column. Rows without id or label are left
    out, and so are training documents of more than ``max_passages`` passages.
    """
    chosen = (
        labels.filter(allowed & F.col(id_column).isNotNull() & F.col(label).isNotNull())
        .select(F.col(id_column).alias("label_id"), F.col(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id", "label")
        .limit(max_documents)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            bags = [bag(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("place"),
                    batch.column("label"),
                    pa.array([len(b) for b in bags], pa.int32()),
                    pa.array([b.tobytes() for b in bags], pa.binary()),
                ],
                ["place", "label", "n", "features"],
            )

    rows = (
        narrowed(docs, doc_id=id_column, text=text)
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
        .select(F.xxhash64("doc_id", "text").alias("place"), "label", "text")
        .mapInArrow(run, "place long, label int, n int, features binary")
        .filter((F.col("n") > 0) & (F.col("n") <= max_passages))
    )
    sample = sorted(rows.collect(), key=lambda r: (r.place, r.label))
    bags = [np.frombuffer(r.features, np.float32).reshape(-1, N_FEATURES) for r in sample]
    return train(bags, [r.label for r in sample])


def score(
    docs: DataFrame, model: Model, keep: list[str] | None = None, text: str = "text"
) -> DataFrame:
    """The columns ``keep`` (all by default) and ``quality_score``, from 0 to 1, of whole texts.

    A null text counts as empty; without any word the score is 0. A column of ``docs`` named
    ``quality_score`` is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != "quality_score"]
    scored = free_name(keep, "_scored_text")
    narrow = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").alias(scored))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = batch.column(scored).to_pylist()
            scores = model.scores([bag(t) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64())], [*keep, "quality_score"]
            )

    schema = narrow.drop(scored).schema.add("quality_score", "double")
    return narrow.mapInArrow(run, schema)
