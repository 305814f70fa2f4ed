"""Toxicity by weak supervision.

Many weak voters look at a document: each mined word or word beginning is a lexicon voter that
says "toxic" or abstains, and pattern voters look at how much of the lexicon a document touches. A
generative label model estimates each voter's accuracy from the votes alone (expectation
maximisation) and the correlations between voters, so that voters who repeat each other share
their weight. A linear classifier is then trained on the posterior labels and scores whole texts.

Labels serve only to mine the lexicon, on a bounded sample of labelled documents
(``max_documents`` per label, the smallest hashes of their ids).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import narrowed, pieces, stored

_WORDS = re.compile(r"[^\W\d_]+").findall
STEMS = (4, 5, 6, 7)
MANY = 3
_CACHED_WORDS = 300_000


def word_features(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return ["=" + word, *(word[:n] for n in STEMS if len(word) >= n)]


def document_features(text: str | None) -> set[str]:
    """Features of all words, and ``+stem`` for a stem that ``MANY`` different words begin with."""
    counts = Counter(f for w in set(_WORDS((text or "").lower())) for f in word_features(w))
    return set(counts) | {"+" + f for f, n in counts.items() if n >= MANY}


class Lexicon:
    """Numbers of the known features that a text holds."""

    def __init__(self, names: list[str]):
        self.numbers = {name: i for i, name in enumerate(names)}
        self.names = names
        self.known: dict[str, tuple[int, ...]] = {}

    def _of_word(self, word: str) -> tuple[int, ...]:
        if len(self.known) >= _CACHED_WORDS:
            self.known.clear()
        found = []
        for name in word_features(word):
            for key in (name, "+" + name):
                if key in self.numbers:
                    found.append(self.numbers[key])
        self.known[word] = tuple(found)
        return self.known[word]

    def features(self, text: str | None) -> list[int]:
        found: Counter[int] = Counter()
        known = self.known
        for word in set(_WORDS((text or "").lower())):
            numbers = known.get(word)
            if numbers is None:
                numbers = self._of_word(word)
            if numbers:
                found.update(numbers)
        return sorted(i for i, n in found.items() if self.names[i][0] != "+" or n >= MANY)


# The label model


def correlations(votes: np.ndarray, posterior: np.ndarray) -> np.ndarray:
    """How much of two voters' casting the label leaves unexplained in both, 1 on the diagonal.

    What is left of a voter is whether it votes less how often it does given the label, which
    ``posterior`` holds as P(toxic) per row. Below 0.2 it counts as chance.
    """
    cast = np.abs(votes).astype(np.float64)
    toxic, clean = posterior[:, None], 1 - posterior[:, None]
    given_toxic = (cast * toxic).sum(0) / (toxic.sum() + 1e-9)
    given_clean = (cast * clean).sum(0) / (clean.sum() + 1e-9)
    left = cast - toxic * given_toxic - clean * given_clean
    left /= np.sqrt((left**2).sum(axis=0)) + 1e-9
    related = left.T @ left
    related[related < 0.2] = 0
    np.fill_diagonal(related, 1)
    return related


def label_model(
    votes: np.ndarray, rounds: int = 30, passes: int = 3
) -> tuple[np.ndarray, np.ndarray]:
    """Posterior P(toxic) per row and accuracy per voter; votes are 1, -1 or 0 (abstains).

    Expectation maximisation estimates how often each voter votes which way given the true label,
    started at the majority. A voter shares its weight with those it moves together with beyond
    what the label explains; these correlations are estimated anew in each of the ``passes``, first
    from the majority and then from the model's own posterior.
    """
    n, m = votes.shape
    majority = np.clip(0.5 + 0.4 * np.sign(votes.sum(axis=1)), 0.1, 0.9)
    cast = np.abs(votes).astype(np.float64)
    kinds = np.stack([votes == v for v in (-1, 0, 1)]).astype(np.float64)  # by vote, row, voter
    posterior = majority
    for _ in range(passes):
        share = 1 / correlations(votes, posterior).sum(axis=1)
        posterior = majority
        for _ in range(rounds):
            rate = np.clip(posterior.mean(), 0.01, 0.99)
            odds = np.full(n, np.log(rate / (1 - rate)))
            given = []
            for weight in (posterior, 1 - posterior):
                times = np.einsum("vnm,n->vm", kinds, weight) + 0.2
                given.append(times / times.sum(axis=0))
            step = np.log(given[0] / given[1]) * share
            odds += np.einsum("vnm,vm->n", kinds, step)
            posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    right = ((votes > 0) * posterior[:, None] + (votes < 0) * (1 - posterior)[:, None]).sum(0)
    return posterior, (right + 1) / (cast.sum(axis=0) + 2)


def pattern_votes(held: np.ndarray, strong: np.ndarray) -> np.ndarray:
    """Voters on how much of the lexicon a document touches.

    ``held``: documents by lexicon features; ``strong``: which of these are whole words.
    """
    total, words = held.sum(axis=1), held[:, strong].sum(axis=1)
    return np.stack(
        [
            np.where(total == 0, -1, 0),
            np.where(words == 0, -1, 0),
            np.where(total >= 2, 1, 0),
            np.where(total >= 4, 1, 0),
            np.where(total - words >= 2, 1, 0),
        ],
        axis=1,
    )


# The classifier


@dataclass(frozen=True)
class Classifier:
    """Linear weights of features; ``bias`` alone if nothing was learnt.

    ``voters`` names the lexicon voters and ``accuracies`` holds how often the label model found each
    of them right, followed by those of the pattern voters.
    """

    names: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -2.0
    voters: list[str] = field(default_factory=list)
    accuracies: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def score(self, numbers: list[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[numbers].sum() + self.bias, -30, 30))))


def _linear(x: np.ndarray, y: np.ndarray, steps: int = 800) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Adam, with a penalty on weights."""
    w, b = np.zeros(x.shape[1]), np.zeros(1)
    balance = np.where(y > 0.5, 0.5 / max(y.mean(), 1e-3), 0.5 / max(1 - y.mean(), 1e-3))
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (w, b)]
    for step in range(1, steps + 1):
        d = balance * (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y) / len(y)
        for p, g, (m, s) in zip((w, b), (x.T @ d + 1e-5 * w, np.array([d.sum()])), state):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return w, float(b[0])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    allowed: Column,
    *,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_documents: int = 3000,
    max_voters: int = 150,
    max_features: int = 1500,
) -> Classifier:
    """Mine the lexicon, fit the label model, train the classifier.

    ``allowed`` is an expression over the labels' id column; other rows, and rows without id or
    label, are never read. Without both labels there is nothing to learn and every score is low.
    At most ``max_documents`` different texts of each label are learnt from: repeated rows of
    ``docs`` count once, and among different texts of the labelled ids the smallest hashes stay. An id
    with both labels teaches both.
    """
    usable = labels.filter(allowed & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("label_id"), F.col(label).cast("int").alias("label")
    )
    sample = None
    for value in (0, 1):
        part = (
            usable.filter(F.col("label") == value)
            .orderBy(F.xxhash64("label_id"), "label_id")
            .limit(max_documents)
        )
        sample = part if sample is None else sample.unionByName(part)
    labelled = (
        narrowed(docs, doc_id=id_column, text=text)
        .join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
        .select(F.xxhash64("doc_id", "text").alias("place"), "label", "text")
        .dropDuplicates(["place", "label"])
    )
    # read by three jobs, and bounded however often an id occurs
    training = stored(
        reduce(
            DataFrame.unionByName,
            (
                labelled.filter(F.col("label") == value).orderBy("place").limit(max_documents)
                for value in (0, 1)
            ),
        ),
        "labelled_texts",
    )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            names, marks = [], []
            for value, mark in zip(
                batch.column("text").to_pylist(), batch.column("label").to_pylist()
            ):
                own = document_features(value)
                names += own
                marks += [mark] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(marks, pa.int32())], ["name", "label"]
            )

    sizes = {r.label: r.n for r in training.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return Classifier()
    counted = (
        training.select("text", "label")
        .mapInArrow(found, "name string, label int")
        .groupBy("name")
        .agg(F.sum("label").cast("double").alias("n1"), F.count("*").cast("double").alias("n"))
        .withColumn("n0", F.col("n") - F.col("n1"))
    )
    ratio = F.log((F.col("n1") + 0.3) / n1) - F.log((F.col("n0") + 0.3) / n0)
    least = max(4, n1 // 100)  # fewer may be the words of one copied text
    mined = (
        counted.withColumn("strength", ratio)
        .filter((F.col("n") >= least) & (F.abs("strength") > 1))
        .orderBy(F.desc(F.abs("strength") * F.sqrt("n")), "name")
        .limit(max_features)
        .collect()
    )
    if not mined:
        return Classifier()
    names = [r.name for r in mined]
    toxic = [i for i, r in enumerate(mined) if r.strength > 2.5 and r.n1 >= max(5, n1 // 50)]
    voters = np.array(toxic[:max_voters], int)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(names)
        for batch in pieces(batches):
            rows = [lexicon.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), pa.array(rows, pa.list_(pa.int32()))], ["place", "features"]
            )

    rows = training.select("place", "text").mapInArrow(held, "place long, features array<int>")
    rows = sorted(rows.collect(), key=lambda r: (r.place, r.features))
    x = np.zeros((len(rows), len(names)))
    for i, row in enumerate(rows):
        x[i, row.features] = 1
    if not len(voters):
        return Classifier()
    strong = np.array([names[i].startswith("=") for i in voters])
    votes = np.concatenate([x[:, voters], pattern_votes(x[:, voters], strong)], axis=1)
    posterior, accuracies = label_model(votes)
    w, b = _linear(x, posterior)
    return Classifier(names, w, b, [names[i] for i in voters], accuracies)


def score(
    docs: DataFrame, model: Classifier, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows (doc_id, score) for every row, whole texts; empty and null texts score by the bias."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.names)
        for batch in pieces(batches):
            scores = [model.score(lexicon.features(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    return narrowed(docs, doc_id=id_column, text=text).mapInArrow(
        run, f"doc_id {kind}, score double"
    )
