"""Session set-up and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


MB = 1 << 20
MAX_PARTITIONS = 40_000
# Without a size, shuffles start with this many partitions, which adaptive execution merges.
DEFAULT_SHUFFLED_BYTES = 4096 * 256 * MB


def shuffle_settings(shuffled_bytes: int) -> dict[str, str]:
    """Partition sizes for jobs whose largest shuffle moves about ``shuffled_bytes``.

    Shuffles start with partitions of 256 MB, at least 200 and at most 40,000 of them (beyond
    that the number of blocks, map tasks times partitions, costs more than larger partitions do);
    adaptive execution merges small ones up to the same size, which is also the size of the
    files a job writes.
    """
    target = 256 * MB
    partitions = min(max(200, -(-shuffled_bytes // target)), MAX_PARTITIONS)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.files.maxPartitionBytes": str(target),
    }


def create_session(
    app_name: str,
    *,
    warehouse_dir: str | None = None,
    hive: bool = False,
    shuffled_bytes: int | None = None,
    config: dict[str, str] | None = None,
) -> SparkSession:
    """A session; master, memory and catalog address are left to the deployment.

    ``shuffled_bytes`` sizes partitions for large inputs, see ``shuffle_settings``. Without it
    shuffles start with 4,096 partitions; steps that know their input call ``size_shuffles``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    config = {**shuffle_settings(shuffled_bytes or DEFAULT_SHUFFLED_BYTES), **(config or {})}
    if warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    for key, value in (config or {}).items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of files below the paths that exist, on any file system Spark reads."""
    total = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if system.exists(place):
            total += system.getContentSummary(place).getLength()
    return total


def size_shuffles(spark: SparkSession, *paths: str, growth: float = 4.0) -> int:
    """Size partitions for files below ``paths``, which shuffles may hold ``growth`` times over."""
    shuffled = int(growth * input_bytes(spark, *paths))
    for key, value in shuffle_settings(shuffled).items():
        spark.conf.set(key, value)
    if shuffled > MAX_PARTITIONS * 256 * MB:
        print(f"{shuffled} bytes to shuffle: {MAX_PARTITIONS} partitions of over 256 MB each")
    return shuffled


# What one task gets of the input, and what adaptive execution may merge for one task.
TASK_INPUT_BYTES = 8 * MB
TASK_SCAN_BYTES = 32 * MB
TASK_SHUFFLED_BYTES = 16 * MB


def bound_tasks(spark: SparkSession, path: str) -> int:
    """Keep tasks small however large the file or folder at ``path`` is; returns its partitions.

    A session's fixed number of shuffle partitions gives each task a share that grows with the
    input until sorts spill. Here the number grows instead: one partition for 8 MB of Parquet, at
    most ``MAX_PARTITIONS``. The session is only ever set to more and smaller tasks, and an input
    that fits its number already changes nothing.
    """
    needed = min(-(-input_bytes(spark, path) // TASK_INPUT_BYTES), MAX_PARTITIONS)
    if needed <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        return needed
    spark.conf.set("spark.sql.shuffle.partitions", str(needed))
    # a number of its own for adaptive execution would hide the one above
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if int(spark.conf.get(initial, str(needed))) < needed:
        spark.conf.set(initial, str(needed))
    for key, most in (
        ("spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_SHUFFLED_BYTES),
        ("spark.sql.files.maxPartitionBytes", TASK_SCAN_BYTES),
    ):
        if _bytes(spark, spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    return needed


def _bytes(spark: SparkSession, size: str) -> int:
    """A size as Spark's settings write it, such as ``64MB``."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    A local session without that setting uses a folder in its warehouse; a cluster must name one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            named = f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared folder, so a lost executor costs no recompute."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    Unlike ``checkpointed`` the columns can be read one by one.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
