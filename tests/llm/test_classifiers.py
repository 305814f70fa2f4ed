"""Quality and toxicity: learning on made-up texts and on held-out rows of the given tables."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import edge_rows, sentence
from pyspark.sql import functions as F

from orderlake.llm import quality, toxicity
from orderlake.llm.common import documents, labels, remainder

SF_DIR = "/root/testdata/sf0.01"
def everything():
    return F.lit(True)



def auc(scores, truth):
    scores, truth = np.array(scores), np.array(truth)
    wins = (scores[truth == 1][:, None] > scores[truth == 0]).mean()
    return wins + 0.5 * (scores[truth == 1][:, None] == scores[truth == 0]).mean()


def junk(seed):
    r = random.Random(seed)
    words = sentence(seed, 150).split()
    return r.choice(
        [
            " ".join(w.upper() + "!!" for w in words),
            " | ".join(words),
            " ".join(w for w in words[:12] for _ in range(12)),
        ]
    )


def labelled(spark, texts, truth, column):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = spark.createDataFrame(list(enumerate(truth)), f"doc_id long, {column} int")
    return docs, marks


def test_gradient_of_the_attention_model():
    """The trained loss is lower than that of the start, and one step follows the true slope."""
    r = np.random.default_rng(1)
    bags = [r.normal(size=(r.integers(1, 6), quality.N_FEATURES)).astype(np.float32) for _ in range(80)]
    truth = [int(b[:, 0].max() > 0.8) for b in bags]

    def loss(model):
        p = np.clip(model.scores(bags), 1e-9, 1 - 1e-9)
        return -np.mean(np.where(truth, np.log(p), np.log(1 - p)))

    losses = [loss(quality.train(bags, truth, steps=n)) for n in (1, 30, 300)]
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.3


def test_quality_learns_junk(spark):
    texts = [sentence(i, 200) if i % 3 else junk(i) for i in range(240)]
    docs, marks = labelled(spark, texts, [int(i % 3 > 0) for i in range(240)], "quality")
    model = quality.fit(docs, marks, F.col("doc_id") < 160)
    rows = quality.score(docs, model).filter("doc_id >= 160").collect()
    assert auc([r.quality_score for r in rows], [r.doc_id % 3 > 0 for r in rows]) > 0.97


def test_quality_without_labels(spark, edges):
    marks = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(edges, marks, everything())
    scored = quality.score(edges, model)
    assert scored.columns == [c for c in edges.columns if c != "quality_score"] + ["quality_score"]
    scores = {r.doc_id: r.quality_score for r in scored.collect()}
    assert len(scores) and scores[1] == 1.0 and scores[4] == scores[5] == scores[6] == 0.0


def test_quality_of_edge_rows(spark, edges, nothing):
    marks = [(1, 1), (3, 1), (11, 0), (None, 1), (7, None), (20, 0), (20, 1), (999, 1)]
    marks = spark.createDataFrame(marks, "doc_id long, quality int")
    rows = quality.score(edges, quality.fit(edges, marks, everything())).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.quality_score <= 1 for r in rows)
    model = quality.fit(nothing, marks, everything())
    assert quality.score(nothing, model).count() == 0


def test_passages_hold_all_words():
    for n in (0, 1, 63, 64, 65, 79, 80, 500):
        words = sentence(n, n).split()
        assert [w for p in quality.passages(" ".join(words)) for w in p] == words


def test_label_model_weighs_voters():
    r = np.random.default_rng(4)
    truth = r.random(3000) < 0.2
    good = [np.where(truth & (r.random(3000) < 0.6), 1, 0) for _ in range(4)]
    noise = np.where(r.random(3000) < 0.1, 1, 0)
    clean = np.where(~truth & (r.random(3000) < 0.9), -1, 0)
    votes = np.stack([*good, noise, noise, noise, clean], axis=1)
    posterior, accuracy = toxicity.label_model(votes)
    assert auc(posterior, truth.astype(int)) > 0.97
    assert accuracy[:4].min() > 0.9 > accuracy[4:7].max()


def test_label_model_recovers_accuracies_and_a_correlated_pair():
    """Five voters of known accuracy, two of which repeat each other's mistakes."""
    r = np.random.default_rng(9)
    n = 6000
    truth = r.random(n) < 0.3
    rates = (0.9, 0.85, 0.8, 0.8)
    votes = [np.where(r.random(n) < rate, 1, -1) * np.where(truth, 1, -1) for rate in rates]
    # half of the time a voter abstains, so that casting can be told apart from voting
    votes = [np.where(r.random(n) < 0.5, v, 0) for v in votes]
    copy = np.where(r.random(n) < 0.9, votes[3], 0)
    posterior, accuracy = toxicity.label_model(np.stack([*votes, copy], axis=1))
    assert np.abs(accuracy[:4] - rates).max() < 0.05
    related = toxicity.correlations(np.stack([*votes, copy], axis=1), posterior)
    assert related[3, 4] > 0.8
    assert (np.triu(related[:4, :4], 1) == 0).all()


def test_toxicity_returns_its_voters_and_reads_repeated_rows_once(spark):
    texts, truth = [], []
    for i in range(200):
        words = sentence(i, 60).split()
        if i % 4 == 0:
            words[5:8] = ["vexoren", "vexorist", "grumbaung"]
        texts.append(" ".join(words))
        truth.append(int(i % 4 == 0))
    docs, marks = labelled(spark, texts, truth, "toxic")
    model = toxicity.fit(docs, marks, everything())
    assert len(model.accuracies) == len(model.voters) + 5
    assert any("vexor" in v for v in model.voters)
    again = toxicity.fit(docs.unionByName(docs.filter("doc_id = 0")), marks, everything())
    assert again.names == model.names and np.allclose(again.weights, model.weights)
    few = toxicity.fit(docs, marks, everything(), max_documents=20)
    assert few.names


def test_toxicity_learns_words_and_stems(spark):
    r = random.Random(3)
    stems = ["vexor", "grumba"]
    texts, truth = [], []
    for i in range(300):
        words, toxic = sentence(i, 80).split(), i % 4 == 0
        if toxic:
            for _ in range(4):
                bad = r.choice([*stems, "horrible"])
                words[r.randrange(80)] = bad + r.choice(["", "en", "ist", "a", "ung"])
        texts.append(" ".join(words))
        truth.append(int(toxic))
    docs, marks = labelled(spark, texts, truth, "toxic")
    model = toxicity.fit(docs, marks, F.col("doc_id") < 200)
    rows = toxicity.score(docs, model).filter("doc_id >= 200").collect()
    assert auc([r.score for r in rows], [truth[r.doc_id] for r in rows]) > 0.97
    assert model.score(toxicity.Lexicon(model.names).features("VEXORISCH vexoren vexora")) > 0.5


def test_toxicity_without_labels_and_of_edge_rows(spark, edges, nothing):
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score(edges, toxicity.fit(edges, marks, everything())).collect()
    assert len(rows) == len(edge_rows()) and all(r.score < 0.5 for r in rows)
    marks = [(1, 1), (3, 0), (11, 0), (None, 1), (7, None), (20, 0), (20, 1), (999, 1)]
    marks = spark.createDataFrame(marks, "doc_id long, toxic int")
    rows = toxicity.score(edges, toxicity.fit(edges, marks, everything())).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(nothing, toxicity.fit(nothing, marks, everything())).count() == 0


def test_lexicon_agrees_with_the_features_it_was_mined_from():
    names = ["=abc", "abcd", "+abcd", "+abcde", "wxyz"]
    for text in ("abc", "abcd abcde abcdf", "Abcdex abcdey abcdez", "wxyz wxyz", ""):
        want = [i for i, n in enumerate(names) if n in toxicity.document_features(text)]
        assert toxicity.Lexicon(names).features(text) == want


@pytest.mark.parametrize("column, divisor, held, least", [("quality", 4, 2, 0.97)])
def test_held_out_quality(spark, column, divisor, held, least):
    docs, marks = documents(spark, SF_DIR), labels(spark, SF_DIR)
    model = quality.fit(docs, marks, remainder(F.col("doc_id"), divisor) != held)
    rows = (
        quality.score(docs, model)
        .join(marks.withColumnRenamed(column, "truth"), "doc_id")
        .filter(remainder(F.col("doc_id"), divisor) == held)
        .collect()
    )
    assert auc([r.quality_score for r in rows], [r.truth for r in rows]) >= least


def test_held_out_toxicity(spark):
    """On 0.1 of the full size: the smaller tables hold six held-out toxic documents."""
    sf_dir = "/root/testdata/sf0.1"
    docs, marks = documents(spark, sf_dir), labels(spark, sf_dir)
    model = toxicity.fit(docs, marks, remainder(F.col("doc_id"), 5) != 0)
    rows = (
        toxicity.score(docs, model)
        .join(marks, "doc_id")
        .filter(remainder(F.col("doc_id"), 5) == 0)
        .collect()
    )
    assert auc([r.score for r in rows], [r.toxic for r in rows]) > 0.95
    assert np.mean([(r.score >= 0.5) == r.toxic for r in rows]) > 0.95
