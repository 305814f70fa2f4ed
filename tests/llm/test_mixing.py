from __future__ import annotations

import random
from collections import Counter, defaultdict

import brute
import pytest
from conftest import SF_DIR, edge_rows

from orderlake.llm import mixing
from orderlake.llm.common import documents


@pytest.mark.parametrize("seed", range(20))
def test_apportionment_is_by_highest_quotients(seed):
    r = random.Random(seed)
    shares = [r.choice([0, 1, 1, 3, 7.5, 1000, r.random()]) for _ in range(r.randint(1, 12))]
    seats = r.randint(0, 200)
    quotients = sorted(
        ((-s / (2 * k + 1), i) for i, s in enumerate(shares) if s for k in range(seats))
    )
    want = Counter(i for _, i in quotients[:seats])
    got = mixing.apportion(shares, seats)
    assert sum(got) == (seats if any(shares) else 0)
    # which of equal quotients wins may differ, the quotients won may not
    won = sorted(-s / (2 * k + 1) for s, n in zip(shares, got) for k in range(n))
    assert won == sorted(-shares[i] / (2 * k + 1) for i, n in want.items() for k in range(n))


def test_targets():
    assert mixing.targets([100, 100, 100], [3, 1, 2], 1.5, 2.0) == [200, 250 / 3, 500 / 3]
    assert mixing.targets([10, 1000], [3, 1], 1.5, 2.0) == [20, 1495]
    assert mixing.targets([0, 50], [3, 1], 1.5, 2.0) == [0, 75]
    assert mixing.targets([], [], 1.5, 2.0) == []


def check(rows, sources):
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        source = sources[r.doc_id]
        size[source] += r.size
        taken[source] += r.taken
        target[source] = (r.source_size, r.target)
    names = sorted((s for s in size if s is not None), key=lambda s: [*map(ord, s)])
    names += [None] if None in size else []
    weights = [(3, 1, 2)[i % 3] for i in range(len(names))]
    want = mixing.targets([size[n] for n in names], weights, 1.5, 2.0)
    for name, goal in zip(names, want):
        assert target[name] == (size[name], pytest.approx(goal))
        assert abs(taken[name] - goal) <= 16


def test_edge_rows(spark, unique_rows):
    from conftest import frame

    docs = frame(spark, unique_rows)
    rows = mixing.mix(docs, shard_words=5000).collect()
    assert {r.doc_id: r.size for r in rows} == {
        i: brute.word_count(t) for i, t, _ in unique_rows
    }
    check(rows, {i: s for i, _, s in unique_rows})


def test_repeated_rows_and_null_ids(edges):
    rows = mixing.mix(edges).collect()
    assert len(rows) == len(edge_rows())
    assert all(0 <= r.taken <= 2 * r.size for r in rows)


def test_given_documents(spark):
    docs = documents(spark, SF_DIR)
    sources = {r.doc_id: r.source for r in docs.collect()}
    first = mixing.mix(docs)
    check(first.collect(), sources)
    again = mixing.mix(docs.repartition(3))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))


def test_mixed_documents(edges):
    taken = defaultdict(int)
    for r in mixing.mix(edges).collect():
        taken[r.doc_id] += r.taken
    mixed = mixing.mixed_documents(edges)
    assert mixed.columns == edges.columns
    words = defaultdict(int)
    for r in mixed.collect():
        assert r.n_chars == len(r.text)
        words[r.doc_id] += brute.word_count(r.text)
    assert dict(words) == {i: n for i, n in taken.items() if n}


def test_empty_table(nothing):
    assert mixing.mix(nothing).count() == 0
    assert mixing.mixed_documents(nothing).count() == 0
