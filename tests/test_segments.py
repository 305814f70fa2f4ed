from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orderlake.operators import segments
from orderlake.operators.analysis import segment_profile
from orderlake.operators.segments import FEATURES, Trial

DDL = (
    "customer_id string, n_transactions bigint, total_spend double, avg_spend double, "
    "n_distinct_products bigint"
)


def blobs(spark, per_blob=40):
    """Three well separated kinds of customers."""
    rng = np.random.default_rng(7)
    data = []
    for b, (n, spend) in enumerate([(5, 100.0), (50, 5_000.0), (200, 90_000.0)]):
        for i in range(per_blob):
            total = spend * (1 + 0.05 * rng.random())
            data.append((f"C{b}{i:03d}", n + int(rng.integers(3)), total, total / n, n // 2 + b))
    return spark.createDataFrame(data, DDL)


@pytest.fixture(scope="module")
def fitted(spark):
    prepared, preprocessing = segments.prepare_features(blobs(spark))
    model, trials = segments.fit_segments(prepared, preprocessing, max_k=5)
    yield prepared, model, trials
    prepared.unpersist()


def scaled_matrix(prepared):
    """Rows of (customer_id, segment-free scaled vector) as a list and a matrix."""
    found = prepared.orderBy("customer_id").select(
        "customer_id", vector_to_array("scaled_features").alias("x")
    ).collect()
    return [r.customer_id for r in found], np.array([r.x for r in found])


def test_scaling_is_mean_zero_sample_deviation_one(fitted):
    _, x = scaled_matrix(fitted[0])
    assert np.allclose(x.mean(axis=0), 0)
    assert np.allclose(x.std(axis=0, ddof=1), 1)


def test_constant_feature_scales_to_zero(spark):
    df = blobs(spark).withColumn("n_distinct_products", F.lit(3).cast("bigint"))
    prepared, _ = segments.prepare_features(df)
    _, x = scaled_matrix(prepared)
    prepared.unpersist()
    assert (x[:, 3] == 0).all()


def test_customers_with_a_null_or_nan_feature_are_left_out(spark):
    df = blobs(spark).union(
        spark.createDataFrame(
            [("N1", 1, None, 1.0, 1), ("N2", 1, float("nan"), 1.0, 1)], DDL
        )
    )
    prepared, model = segments.prepare_features(df)
    assert prepared.count() == 120
    assert model.transform(df).count() == 120
    prepared.unpersist()


def test_missing_feature_column(spark):
    with pytest.raises(ValueError, match="avg_spend"):
        segments.prepare_features(blobs(spark).drop("avg_spend"))


def test_no_usable_customer(spark):
    with pytest.raises(ValueError):
        segments.prepare_features(blobs(spark).filter("total_spend < 0"))


def test_best_k_finds_the_blobs(fitted):
    _, _, trials = fitted
    assert [t.k for t in trials] == [2, 3, 4, 5]
    assert segments.choose_k(trials) == 3


def test_every_customer_gets_its_nearest_centre(fitted):
    prepared, model, _ = fitted
    assigned = model.assign(prepared)
    ids, x = scaled_matrix(prepared)
    centers = np.array(model.clusters.clusterCenters())
    nearest = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
    found = {r.customer_id: r.cluster for r in assigned.select("customer_id", "cluster").collect()}
    assert found == dict(zip(ids, nearest))


def test_centres_are_the_means_of_their_customers(fitted):
    prepared, model, _ = fitted
    assigned = model.assign(prepared)
    ids, x = scaled_matrix(prepared)
    label = {r.customer_id: r.cluster for r in assigned.select("customer_id", "cluster").collect()}
    labels = np.array([label[i] for i in ids])
    for cluster, center in enumerate(model.clusters.clusterCenters()):
        assert np.allclose(center, x[labels == cluster].mean(axis=0), atol=1e-6)


def test_segments_are_numbered_by_falling_spend(fitted):
    prepared, model, _ = fitted
    profile = segment_profile(model.assign(prepared))
    found = profile.collect()
    assert [r.segment for r in found] == [0, 1, 2]
    assert [r.n_customers for r in found] == [40, 40, 40]
    spends = [r.avg_total_spend for r in found]
    assert spends == sorted(spends, reverse=True)


def test_silhouette_matches_the_pairwise_definition(fitted):
    prepared, model, trials = fitted
    ids, x = scaled_matrix(prepared)
    assigned = model.assign(prepared)
    label = {r.customer_id: r.cluster for r in assigned.select("customer_id", "cluster").collect()}
    labels = np.array([label[i] for i in ids])
    d = ((x[:, None, :] - x[None]) ** 2).sum(axis=2)
    scores = []
    for i in range(len(x)):
        own = labels == labels[i]
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {labels[i]})
        scores.append((b - a) / max(a, b))
    best = next(t for t in trials if t.k == 3)
    assert math.isclose(best.score, float(np.mean(scores)), rel_tol=1e-9)


def test_same_customers_in_other_partitions_give_the_same_segments(spark, fitted, rows):
    prepared, model, trials = fitted
    other, preprocessing = segments.prepare_features(
        blobs(spark).repartition(7, F.rand(3)).union(blobs(spark).limit(0))
    )
    again, scores = segments.fit_segments(other, preprocessing, max_k=5, parallelism=1)
    assert rows(again.assign(other), "customer_id", "segment") == rows(
        model.assign(prepared), "customer_id", "segment"
    )
    assert [round(t.score, 9) for t in scores] == [round(t.score, 9) for t in trials]
    other.unpersist()


def test_saved_models_assign_the_same_segments(spark, fitted, tmp_path, rows):
    prepared, model, _ = fitted
    for _ in range(2):  # the second save overwrites
        model.save(str(tmp_path / "models"))
    loaded = segments.SegmentModel.load(str(tmp_path / "models"))
    assert rows(loaded.assign(blobs(spark)), "customer_id", "segment") == rows(
        model.assign(prepared), "customer_id", "segment"
    )


def test_cluster_centers_on_both_scales(spark, fitted):
    prepared, model, _ = fitted
    centers = segments.cluster_centers(spark, model)
    assert centers.count() == 3 * len(FEATURES)
    profile = segment_profile(model.assign(prepared))
    means = {r.segment: r.avg_total_spend for r in profile.collect()}
    for r in centers.filter("feature = 'total_spend'").collect():
        assert math.isclose(r.center, means[r.segment], rel_tol=1e-9)


def test_choice_of_k():
    assert segments.choose_k([Trial(2, 0.5, None), Trial(3, 0.7, None), Trial(4, 0.7, None)]) == 3
    assert segments.choose_k([Trial(2, -1.0, None), Trial(3, -1.0, None)]) == 3
    assert segments.choose_k([]) == 3


def test_failing_trials_fall_back_to_three(spark, fitted, monkeypatch):
    from pyspark.errors import IllegalArgumentException

    prepared, model, _ = fitted

    def broken(*args, **kwargs):
        raise IllegalArgumentException("no score")

    monkeypatch.setattr(segments, "silhouette", broken)
    again, trials = segments.fit_segments(prepared, model.preprocessing, max_k=4)
    assert [t.score for t in trials] == [-1.0] * 3
    assert len(again.clusters.clusterCenters()) == 3


def test_identical_customers_score_minus_one(spark):
    df = blobs(spark).select(
        "customer_id", *(F.lit(1).cast(t).alias(c) for c, t in blobs(spark).dtypes[1:])
    )
    prepared, _ = segments.prepare_features(df)
    trials = segments.sweep_k(prepared, max_k=3)
    prepared.unpersist()
    assert [t.score for t in trials] == [-1.0, -1.0]


def test_errors_that_are_not_about_the_data_are_raised(fitted, monkeypatch):
    from pyspark.errors import PySparkRuntimeError

    prepared, model, _ = fitted

    def lost(*args, **kwargs):
        raise PySparkRuntimeError("executor lost")

    monkeypatch.setattr(segments, "silhouette", lost)
    with pytest.raises(PySparkRuntimeError):
        segments.sweep_k(prepared, max_k=3)


def test_a_cluster_without_members_has_a_segment(spark, fitted):
    """Customers of one cluster only: the labels of the others follow from their centres."""
    prepared, model, _ = fitted
    far = model.assign(prepared).filter("segment = 2").select("customer_id", *FEATURES)
    assert {r.segment for r in model.assign(far).collect()} == {2}
    labels = segments.label_by_spend(model.preprocessing, model.clusters)
    every = spark.createDataFrame([(0,), (1,), (2,)], "cluster int")
    assert sorted(r.segment for r in labels.transform(every).collect()) == [0, 1, 2]


def test_trial_table(spark, rows):
    table = segments.trial_table(spark, [Trial(2, 0.5, None), Trial(3, 0.25, None)])
    assert rows(table) == [(2, 0.5, True), (3, 0.25, False)]
