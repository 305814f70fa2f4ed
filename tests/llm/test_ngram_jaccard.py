from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from conftest import SF_DIR, edge_rows, frame, sentence
from pyspark.sql import functions as F

from orderlake.llm import ngram_jaccard
from orderlake.llm.common import components, documents

COLUMNS = ["doc_id", "n_shingles", "component_id"]


def found(docs, **options):
    rows = ngram_jaccard.similar_documents(docs, **options).select(COLUMNS).collect()
    return sorted(map(tuple, rows), key=repr)


def test_components_of_links(spark):
    links = [(1, 2), (3, 2), (3, 4), (10, 11), (12, 11), (7, 6), (6, 5), (5, 1)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {n: 1 for n in range(1, 8)} | {10: 10, 11: 10, 12: 10}
    assert {r.node: r.component for r in got} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_chain(spark):
    chain = spark.range(400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.component for r in components(chain).collect()} == {0}


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80)])
def test_edge_rows(spark, unique_rows, k, percent):
    want = brute.jaccard_components([r[:2] for r in unique_rows], k, percent)
    got = found(frame(spark, unique_rows), words=k, percent=percent)
    assert got == sorted(want, key=repr)


def test_clusters_of_near_copies_with_shared_lines(spark, monkeypatch):
    """Many near copies at all distances around the threshold, all with one common line.

    With every n-gram that occurs twice counted as frequent, the order of prefixes is tried too.
    """
    monkeypatch.setattr(ngram_jaccard, "_FREQUENT", 1)
    r = random.Random(5)
    line = sentence(9, 25)
    rows = []
    for family in range(6):
        words = sentence(50 + family, 60 + 20 * family).split()
        for _ in range(25):
            own = list(words)
            for _ in range(r.randint(0, 6)):
                own[r.randrange(len(own))] = r.choice(["new", "other", "third", str(r.random())])
            rows.append((len(rows), " ".join(own) + "\n" + line, "a"))
    rows += [(1000 + i, sentence(900 + i, 4) + "\n" + line, "a") for i in range(40)]
    assert found(frame(spark, rows)) == sorted(
        brute.jaccard_components([x[:2] for x in rows]), key=repr
    )


def test_null_and_repeated_ids(edges):
    rows = found(edges)
    assert len(rows) == len(edge_rows())
    assert [x for x in rows if x[0] == 13] == [(13, 77, 13)] * 2
    assert sorted((c or -1, n) for i, n, c in rows if i is None) == [(-1, 47), (13, 77)]
    assert all(c == i for i, n, c in rows if n == 0)


def test_representatives(edges):
    kept = ngram_jaccard.representatives(edges, words=4, percent=85)
    assert kept.columns == edges.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    gone = {2, 3, 8}  # copies or near copies of 1 and 7, and a null id with the text of 13
    want = [i for i, _, _ in edge_rows() if i not in gone]
    want.remove(None)
    assert ids == sorted(want, key=repr)


def test_columns_with_names_of_ours_stay(edges):
    named = edges.withColumn("_row_key", F.lit("mine")).withColumn("_row_key_", F.lit(1))
    kept = ngram_jaccard.representatives(named)
    assert kept.columns == named.columns
    assert {(r["_row_key"], r["_row_key_"]) for r in kept.collect()} == {("mine", 1)}


def test_long_unrelated_sets_in_one_list(spark):
    """Long texts that share a passage but little else, and two near copies among them."""
    passage = sentence(70, 400)
    rows = [(i, sentence(700 + i, 6000) + " " + passage, "a") for i in range(8)]
    words = rows[3][1].split()
    words[100:120] = ["other"] * 20
    rows.append((20, " ".join(words), "b"))
    got = found(frame(spark, rows))
    assert got == sorted(brute.jaccard_components([x[:2] for x in rows]), key=repr)
    assert [c for i, _, c in got if i == 20] == [3]


def test_bitmaps_never_drop_a_link(spark):
    """The filter on bitmaps holds for all sets at the threshold, and drops nearly all others."""
    r = random.Random(8)
    rows, near = [], 0
    for i in range(300):
        n = r.choice([5, 60, 64, 65, 500, 3000])
        a = set(r.sample(range(1 << 40), n))
        cut = r.randint(0, max(1, n // 5))
        b = set(list(a)[cut:]) | set(r.sample(range(1 << 40), r.choice([0, cut])))
        x, y = (ngram_jaccard._mixed(np.array(sorted(s), np.uint64)) for s in (a, b))
        linked = 100 * len(a & b) >= 85 * len(a | b)
        near += linked
        bits = [ngram_jaccard._bitmap(np.sort(v)).tolist() for v in (x, y)]
        rows.append((i, linked, len(a), bits[0], len(b), bits[1]))
    ddl = "i int, linked boolean, pn long, pb array<long>, qn long, qb array<long>"
    df = spark.createDataFrame(rows, ddl).select(
        "linked",
        F.struct(F.col("pn").alias("n"), F.col("pb").alias("bits")).alias("p"),
        F.struct(F.col("qn").alias("n"), F.col("qb").alias("bits")).alias("q"),
    )
    close = df.withColumn("close", ngram_jaccard._close("p", "q", 85))
    assert near > 50
    assert close.filter("linked AND NOT close").count() == 0


def test_empty_table(nothing):
    assert found(nothing) == []
    assert ngram_jaccard.representatives(nothing).count() == 0


def test_given_documents(spark):
    docs = documents(spark, SF_DIR)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(docs) == sorted(brute.jaccard_components(rows), key=repr)


def test_no_work_where_nothing_is_open(spark, monkeypatch):
    """Documents far apart that share lines: one round of components, no text read again."""
    calls = []

    def counted(name):
        real = getattr(ngram_jaccard, name)
        monkeypatch.setattr(
            ngram_jaccard, name, lambda *a, **b: (calls.append(name), real(*a, **b))[1]
        )

    counted("components")
    counted("_keyed_texts")
    line = sentence(5, 12)
    texts = [f"{line} {sentence(100 + i, 40)}" for i in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == sorted(brute.jaccard_components(rows, 4, 85), key=repr)
    scans = calls.count("_keyed_texts")
    assert calls.count("components") == 1

    # one pair of near copies takes its verification, and no second round
    calls.clear()
    rows.append((20, f"{texts[0]} more"))
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == sorted(brute.jaccard_components(rows, 4, 85), key=repr)
    assert calls.count("_keyed_texts") == scans + 1
