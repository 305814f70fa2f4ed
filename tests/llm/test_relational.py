"""Language-model scores and URL filters, and every query with an SQL counterpart."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR, edge_rows

from checks.compare import TYPES, oracle_rows
from orderlake.llm import lm_score, url_filter
from orderlake.llm.oracles import ORACLES
from orderlake.llm.queries import QUERIES


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 11)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    types, found = oracle_rows(SF_DIR, ORACLES[name])
    assert {c: TYPES.get(k, k) for c, k in result.dtypes} == types
    got = Counter(map(repr, map(tuple, result.select(*types).collect())))
    assert got == Counter(map(repr, found))


def word_class(word):
    import hashlib

    return int(hashlib.md5(word.encode()).hexdigest()[:5], 16)


def brute_scores(texts, cutoff=2):
    docs = [[word_class(w) for w in brute.WORD.findall(t or "")] for t in texts]
    uni = Counter(w for d in docs for w in d)
    bi = Counter(p for d in docs for p in zip(d, d[1:]))
    total = sum(uni.values())
    out = []
    for d in docs:
        score, seen = 0.0, 0
        for u, v in zip([None, *d], d):
            if u is None:
                score += math.log(uni[v] / total)
            elif bi[u, v] >= cutoff:
                score += math.log(bi[u, v] / uni[u])
                seen += 1
            else:
                score += math.log(0.4 * uni[v] / total)
        out.append((len(d), seen, round(score / len(d), 6) if d else None))
    return out


@pytest.mark.parametrize("frequent", [1 << 17, 3])
def test_scores_of_edge_rows(edges, frequent, monkeypatch):
    """With a table of three frequent bigrams nearly all go the way of the rare ones."""
    monkeypatch.setattr(lm_score, "MAX_FREQUENT", frequent)
    rows = lm_score.backoff_scores(edges).collect()
    want = brute_scores([t for _, t, _ in edge_rows()])
    want = [(i, *w) for (i, _, _), w in zip(edge_rows(), want)]
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)


def test_no_documents(nothing):
    assert lm_score.backoff_scores(nothing).count() == 0


def d(day, month=1):
    return datetime.date(2024, month, day)


ENTRIES = [
    ("spam", "host:a.example.com", d(5), True),
    ("spam", "host:a.example.com", d(9), True),
    ("spam", "host:a.example.com", d(20), False),
    ("spam", "host:a.example.com", d(10, 3), True),
    ("adult", "domain:example.com", d(7), True),
    ("adult", "domain:example.com", d(7), False),
    ("adult", "domain:example.com", d(12), False),
    ("malware", "prefix:b.example.org/x/y", d(1), True),
    (None, "host:b.example.org", d(1), True),
    ("spam", None, d(1), True),
    ("spam", "host:b.example.org", None, True),
]
CAPTURES = [
    (1, "http://A.example.com/p?q", d(4), 0, ""),
    (2, "http://A.example.com/p?q", d(5), 1, "spam"),
    (2, "http://A.example.com/p?q", d(5), 1, "spam"),
    (3, "https://u@a.example.com.:8080/", d(8), 2, "adult,spam"),
    (4, "http://a.example.com", d(19), 1, "spam"),
    (5, "http://a.example.com", d(20), 0, ""),
    (6, "http://a.example.com", d(1, 12), 1, "spam"),
    (7, "http://example.com/", d(11), 1, "adult"),
    (8, "http://example.com/", d(12), 0, ""),
    (9, "http://b.example.org/x/y/z#f", d(1, 6), 1, "malware"),
    (10, "http://b.example.org/x/yy", d(1, 6), 0, ""),
    (11, "http://notexample.com/", d(8), 0, ""),
    (12, None, d(8), 0, ""),
    (13, "no url", d(8), 0, ""),
    (14, "http://a.example.com", None, 0, ""),
    (None, "", None, 0, ""),
    (15, "http://b.example.org/" + "x/" * 300, d(8), 0, ""),
]


def test_captures_meet_the_entries_of_their_day(spark):
    entries = spark.createDataFrame(ENTRIES, "list string, key string, dated date, active boolean")
    captures = spark.createDataFrame(
        [(*c[:3], "x", "y") for c in CAPTURES],
        "page_id long, url string, fetched date, host string, month string",
    )
    rows = url_filter.filtered_urls(captures, entries).collect()
    got = [(r.page_id, r.fetched, r.n_matches, r.lists, r.blocked) for r in rows]
    want = [(i, f, n, names, n > 0) for i, _, f, n, names in CAPTURES]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    none = entries.limit(0)
    assert {r.blocked for r in url_filter.filtered_urls(captures, none).collect()} == {False}
    assert url_filter.filtered_urls(captures.limit(0), entries).count() == 0


def test_no_python_in_the_url_filter(spark):
    plan = QUERIES["op6_url_filter"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def word_scores(texts, cutoff=2):
    """As ``brute_scores``, on the words themselves."""
    docs = [brute.WORD.findall(t or "") for t in texts]
    uni = Counter(w for d in docs for w in d)
    bi = Counter(p for d in docs for p in zip(d, d[1:]))
    total = sum(uni.values())
    out = []
    for d in docs:
        parts = [math.log(uni[d[0]] / total)] if d else []
        for u, v in zip(d, d[1:]):
            seen = bi[u, v] >= cutoff
            parts.append(math.log(bi[u, v] / uni[u] if seen else 0.4 * uni[v] / total))
        seen = sum(bi[p] >= cutoff for p in zip(d, d[1:]))
        out.append((len(d), seen, round(math.fsum(parts) / len(d), 6) if d else None))
    return out


@pytest.mark.parametrize("hot, frequent", [(1 << 17, 1 << 17), (100, 3), (0, 0)])
def test_words_of_one_class_count_apart(spark, hot, frequent, monkeypatch):
    """Also when few words and bigrams are hot, or none."""
    monkeypatch.setattr(lm_score, "MAX_WORDS", hot)
    monkeypatch.setattr(lm_score, "MAX_FREQUENT", frequent)
    classes = {}
    for i in range(10_000):
        classes.setdefault(word_class(f"n{i}"), []).append(f"n{i}")
    alike = [words[:2] for words in classes.values() if len(words) > 1]
    assert len(alike) > 20
    texts = [t for _, t, _ in edge_rows()]
    texts += [f"the {w}" for words in alike for w in words]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = lm_score.backoff_scores(docs, word_key=lm_score.word_hash).collect()
    want = [(i, *w) for i, w in enumerate(word_scores(texts))]
    assert sorted(map(tuple, rows)) == want
    assert brute_scores(texts) != word_scores(texts)


def test_rare_bigrams_travel_packed(spark, monkeypatch):
    """A shuffled row holds a bucket's positions in a run of documents; runs of any length agree."""
    monkeypatch.setattr(lm_score, "MAX_FREQUENT", 3)
    texts = [t for _, t, _ in edge_rows()] + [f"a{i % 7} b{i % 5} c a{i % 3}" for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = [(i, *w) for i, w in enumerate(word_scores(texts))]
    for run_rows, batch_words, bucket_words in ((1 << 16, 2_000_000, 1 << 19), (2, 10, 1)):
        monkeypatch.setattr(lm_score, "_RUN_ROWS", run_rows)
        monkeypatch.setattr(lm_score, "_BATCH_WORDS", batch_words)
        monkeypatch.setattr(lm_score, "_BUCKET_WORDS", bucket_words)
        scored = lm_score.backoff_scores(docs, word_key=lm_score.word_hash)
        assert sorted(map(tuple, scored.collect())) == want
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "Window" not in plan


def test_packed_positions_come_back():
    random = np.random.default_rng(3)
    row = np.sort(random.integers(1 << 40, (1 << 40) + 60_000, 5_000))
    gram = random.integers(0, 1 << lm_score._GRAM_BITS, 5_000)
    for bits in (6, 11, lm_score._GRAM_BITS):
        (batch,) = lm_score._packed([row], [gram], bits)
        table = pa.Table.from_batches([batch])
        back = [lm_score._unpacked(table.slice(i, 1), bits) for i in range(table.num_rows)]
        got = zip(*(np.concatenate(x).tolist() for x in zip(*back)))
        assert sorted(got) == sorted(zip(row.tolist(), gram.tolist()))
