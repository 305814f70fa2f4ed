"""Customer segments by K-Means on standardised features."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import IllegalArgumentException, PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError

from orderlake.schemas import require_columns

# The four features, the seed, the number of segments when no score is usable, the
# score of a failed trial, and the folders of stored models.
FEATURES = ("n_transactions", "total_spend", "avg_spend", "n_distinct_products")
SEED = 42
DEFAULT_K = 3
FAILED_SCORE = -1.0
KMEANS_FOLDER = "kmeans_customer_segmentation"
PREPROCESSING_FOLDER = "preprocessing_pipeline"
LABELS_FOLDER = "segment_labels"


def prepare_features(
    customers: DataFrame,
    features: Sequence[str] = FEATURES,
    customer_id: str = "customer_id",
    rows_per_partition: int = 250_000,
    partitions: int | None = None,
) -> tuple[DataFrame, PipelineModel]:
    """Customers with ``scaled_features`` (mean 0, deviation 1), and the fitted preprocessing.

    Customers with a null or NaN feature are left out. The result is cached, and laid out by
    customer id in a number of sorted partitions that depends only on the row count, because
    K-Means draws its starting centres by partition and position: the same customers then give
    the same start on any cluster. Ask ``prepared.rdd.getNumPartitions()`` for that number and pass
    it as ``partitions`` to keep the layout when customers come or go. Release the result with
    ``unpersist()``.
    """
    require_columns(customers, [customer_id, *features], "customer metrics")
    chosen = customers.select(customer_id, *features)
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip"),
        StandardScaler(
            inputCol="features", outputCol="scaled_features", withMean=True, withStd=True
        ),
    ]
    valid = chosen.dropna(subset=list(features))
    n_valid = valid.count()
    if n_valid == 0:
        raise ValueError("no customer has a value for every feature")
    laid_out = (
        valid.repartition(partitions or math.ceil(n_valid / rows_per_partition), customer_id)
        .sortWithinPartitions(customer_id)
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    model = Pipeline(stages=stages).fit(laid_out)
    prepared = model.transform(laid_out).filter(F.col("scaled_features").isNotNull())
    prepared.persist(StorageLevel.MEMORY_AND_DISK).count()
    laid_out.unpersist()
    return prepared, model


def kmeans(
    k: int,
    prediction: str = "cluster",
    seed: int = SEED,
    tol: float = 1e-4,
    max_iter: int = 20,
) -> KMeans:
    """Spark's K-Means and its defaults; ``tol=0`` goes on until no centre moves."""
    return KMeans(
        k=k,
        seed=seed,
        tol=tol,
        maxIter=max_iter,
        featuresCol="scaled_features",
        predictionCol=prediction,
    )


def silhouette(
    assigned: DataFrame, prediction: str | Sequence[str] = "cluster"
) -> float | list[float]:
    """Silhouette score on squared Euclidean distance, of one column or of several at once.

    Several columns, such as the clusters of several k, are scored in two jobs however many they are;
    a column with rows of one cluster only has no score and gives NaN.
    """
    if isinstance(prediction, str):
        return ClusteringEvaluator(
            predictionCol=prediction, featuresCol="scaled_features", metricName="silhouette"
        ).evaluate(assigned)
    return _silhouettes(assigned, list(prediction))


def _vector_size(assigned: DataFrame) -> int:
    """How many features there are, which the column says itself; else the first row does."""
    known = assigned.schema["scaled_features"].metadata.get("ml_attr", {}).get("num_attrs")
    if known is None:
        row = assigned.select("scaled_features").first()
        known = 0 if row is None else len(row[0])
    return known


def _silhouettes(assigned: DataFrame, predictions: list[str]) -> list[float]:
    """The mean squared distance of x to a cluster is |x|^2 + mean |y|^2 - 2 x . mean y.

    So the first job sums rows, features and norms per column and cluster, a row for each of which
    comes back, and the second one averages every column's score over all rows.
    """
    points = assigned.select(vector_to_array("scaled_features").alias("x"), *predictions)
    n_features = _vector_size(assigned)
    norm = sum((F.col("x")[i] * F.col("x")[i] for i in range(n_features)), F.lit(0.0))
    pairs = F.explode(
        F.array(
            *(
                F.struct(F.lit(i).alias("column"), F.col(p).alias("cluster"))
                for i, p in enumerate(predictions)
            )
        )
    )
    sums = (
        points.select("x", norm.alias("norm"), pairs.alias("own"))
        .groupBy("own")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("norm").alias("norm"),
            *(F.avg(F.col("x")[i]).alias(f"x{i}") for i in range(n_features)),
        )
        .collect()
    )
    scores = []
    for i, p in enumerate(predictions):
        clusters = [r for r in sums if r.own.column == i]
        own, others = F.lit(None).cast("double"), []
        for c in clusters:
            dot = sum((F.col("x")[f] * float(c[f"x{f}"]) for f in range(n_features)), F.lit(0.0))
            gap = norm + float(c.norm) - 2 * dot
            inside = F.col(p) == c.own.cluster
            # a cluster of one row scores zero
            scale = c.n / (c.n - 1) if c.n > 1 else None
            own = F.when(inside, gap * F.lit(scale).cast("double")).otherwise(own)
            others.append(F.when(~inside, gap))
        if len(clusters) < 2:
            scores.append(F.lit(math.nan))
            continue
        nearest = F.least(*others)
        score = (
            F.when(own < nearest, 1 - own / nearest)
            .when(own > nearest, nearest / own - 1)
            .otherwise(0.0)
        )
        scores.append(F.avg(score))
    return list(points.agg(*(s.alias(f"s{i}") for i, s in enumerate(scores))).first())


@dataclass(frozen=True)
class Trial:
    """A fitted number of segments with its score; ``model`` is None if the fit failed.

    ``failure`` says why there is no score.
    """

    k: int
    score: float
    model: KMeansModel | None
    failure: str | None = None


# What Spark raises when the data cannot be fitted or scored with a k: too few distinct rows leave
# one cluster, which has no silhouette.
_DATA_ERRORS = ("java.lang.AssertionError", "java.lang.IllegalArgumentException")


def _about_the_data(error: Exception) -> bool:
    if isinstance(error, IllegalArgumentException):
        return True
    return isinstance(error, Py4JJavaError) and (
        error.java_exception.getClass().getName() in _DATA_ERRORS
    )


def _try_k(prepared: DataFrame, k: int, seed: int) -> KMeansModel | str:
    """The fitted model, or why the data cannot be fitted."""
    try:
        return kmeans(k, seed=seed).fit(prepared)
    except (PySparkException, Py4JJavaError) as error:
        # a lost executor or too little memory must not pass for a bad k
        if not _about_the_data(error):
            raise
        return str(error)


def _scored(prepared: DataFrame, models: Mapping[int, KMeansModel]) -> list[Trial]:
    """The models with their scores, all of them in the same two jobs."""
    assigned = prepared
    for k, model in models.items():
        assigned = model.transform(assigned).withColumnRenamed("cluster", f"cluster_{k}")
    try:
        scores = silhouette(assigned, [f"cluster_{k}" for k in models])
    except (PySparkException, Py4JJavaError) as error:
        if not _about_the_data(error):
            raise
        return [Trial(k, FAILED_SCORE, None, str(error)) for k in models]
    return [
        Trial(k, FAILED_SCORE, model, "the score is not a number")
        if math.isnan(score)
        else Trial(k, score, model)
        for (k, model), score in zip(models.items(), scores)
    ]


def sweep_k(
    prepared: DataFrame, max_k: int = 10, seed: int = SEED, parallelism: int = 8
) -> list[Trial]:
    """Fit and score every k from 2 to ``max_k``; a k that fails scores -1.

    Fits are independent; ``parallelism`` of them share the cluster, which hides the driver-side
    steps of each behind the tasks of the others. All k are scored together.
    """
    spark = prepared.sparkSession

    def run(k: int) -> KMeansModel | str:
        return _try_k(prepared, k, seed)

    ks = range(2, max_k + 1)
    with ThreadPool(max(1, min(parallelism, max_k - 1))) as pool:
        fitted = dict(zip(ks, pool.map(inheritable_thread_target(spark)(run), ks, chunksize=1)))
    models = {k: m for k, m in fitted.items() if not isinstance(m, str)}
    failed = [Trial(k, FAILED_SCORE, None, m) for k, m in fitted.items() if isinstance(m, str)]
    return sorted(
        failed + (_scored(prepared, models) if models else []), key=lambda trial: trial.k
    )


def choose_k(trials: Sequence[Trial], default: int = DEFAULT_K) -> int:
    """The smallest k with the best score, or ``default`` if no trial succeeded."""
    best = max((t.score for t in trials), default=FAILED_SCORE)
    if best == FAILED_SCORE:
        return default
    return min(t.k for t in trials if t.score == best)


def train_kmeans(
    prepared: DataFrame, k: int, seed: int = SEED, tol: float = 1e-4, max_iter: int = 20
) -> KMeansModel:
    return kmeans(k, seed=seed, tol=tol, max_iter=max_iter).fit(prepared)


def fixed_point(model: KMeansModel, prepared: DataFrame) -> tuple[int, bool]:
    """How many rows lie nearer to another centre, and whether every centre is its rows' mean.

    A row is compared with all centres where it lies; what is shuffled and comes back is one row of
    sums per cluster and task.
    """
    centers = [[float(x) for x in c] for c in model.clusterCenters()]
    x = F.col("x")

    def gap(center: Sequence[float]) -> Column:
        return sum(
            ((x[i] - v) * (x[i] - v) for i, v in enumerate(center)), F.lit(0.0)
        )

    gaps = F.array(*(gap(c) for c in centers))
    apart = model.transform(prepared).select(
        "cluster", vector_to_array("scaled_features").alias("x")
    ).withColumn("gaps", gaps)
    misplaced = F.col("gaps")[F.col("cluster")] > F.array_min("gaps") + 1e-9
    sums = apart.groupBy("cluster").agg(
        F.count_if(misplaced).alias("n_misplaced"),
        *(F.avg(x[i]).alias(f"x{i}") for i in range(len(centers[0]))),
    ).collect()
    off = max(
        abs(row[f"x{i}"] - v) for row in sums for i, v in enumerate(centers[row.cluster])
    )
    return sum(row.n_misplaced for row in sums), off < 1e-6


def original_centers(preprocessing: PipelineModel, clusters: KMeansModel) -> list[list[float]]:
    """The centre of each cluster in the units of the features."""
    scaler = preprocessing.stages[-1]
    return [
        [float(c * s + m) for c, s, m in zip(center, scaler.std, scaler.mean)]
        for center in clusters.clusterCenters()
    ]


def label_by_spend(
    preprocessing: PipelineModel, clusters: KMeansModel, features: Sequence[str] = FEATURES
) -> SQLTransformer:
    """Numbers clusters by falling spend of their centres: segment 0 holds the best customers.

    Cluster numbers of K-Means carry no meaning. Every cluster gets a number, also one without
    members; equal centres go by cluster number.
    """
    place = list(features).index("total_spend")
    spend = [center[place] for center in original_centers(preprocessing, clusters)]
    order = sorted(range(len(spend)), key=lambda cluster: (-spend[cluster], cluster))
    cases = " ".join(f"WHEN {cluster} THEN {n}" for n, cluster in enumerate(order))
    return SQLTransformer(
        statement=f"SELECT *, CAST(CASE cluster {cases} END AS INT) AS segment FROM __THIS__"
    )


@dataclass(frozen=True)
class SegmentModel:
    """Everything needed to put customers into segments again."""

    preprocessing: PipelineModel
    clusters: KMeansModel
    labels: SQLTransformer

    def assign(self, customers: DataFrame) -> DataFrame:
        """Customers with ``scaled_features``, ``cluster`` and ``segment``."""
        if "scaled_features" not in customers.columns:
            customers = self.preprocessing.transform(customers)
        return self.labels.transform(self.clusters.transform(customers))

    def save(self, path: str) -> None:
        """Overwrite the three artefacts below ``path``."""
        self.clusters.write().overwrite().save(f"{path}/{KMEANS_FOLDER}")
        self.preprocessing.write().overwrite().save(f"{path}/{PREPROCESSING_FOLDER}")
        self.labels.write().overwrite().save(f"{path}/{LABELS_FOLDER}")

    @staticmethod
    def load(path: str) -> SegmentModel:
        return SegmentModel(
            PipelineModel.load(f"{path}/{PREPROCESSING_FOLDER}"),
            KMeansModel.load(f"{path}/{KMEANS_FOLDER}"),
            SQLTransformer.load(f"{path}/{LABELS_FOLDER}"),
        )


def fit_segments(
    prepared: DataFrame,
    preprocessing: PipelineModel,
    max_k: int = 8,
    seed: int = SEED,
    parallelism: int = 8,
) -> tuple[SegmentModel, list[Trial]]:
    """Choose k, keep the model already fitted for it, and number its clusters by spend."""
    trials = sweep_k(prepared, max_k, seed, parallelism)
    k = choose_k(trials)
    fitted = [t.model for t in trials if t.k == k and t.model is not None]
    clusters = fitted[0] if fitted else train_kmeans(prepared, k, seed)
    return SegmentModel(preprocessing, clusters, label_by_spend(preprocessing, clusters)), trials


def trial_table(spark: SparkSession, trials: Sequence[Trial]) -> DataFrame:
    """One row per tried k."""
    best = choose_k(trials)
    rows = [(t.k, t.score, t.k == best) for t in trials]
    return spark.createDataFrame(rows, "k int, silhouette double, chosen boolean")


def cluster_centers(
    spark: SparkSession, model: SegmentModel, features: Sequence[str] = FEATURES
) -> DataFrame:
    """Centre of each segment per feature, on the scaled and on the original scale."""
    scaled = model.clusters.clusterCenters()
    original = original_centers(model.preprocessing, model.clusters)
    rows = [
        (cluster, name, float(scaled[cluster][i]), original[cluster][i])
        for cluster in range(len(scaled))
        for i, name in enumerate(features)
    ]
    centers = spark.createDataFrame(
        rows, "cluster int, feature string, scaled_center double, center double"
    )
    return model.labels.transform(centers).select("segment", "feature", "scaled_center", "center")
