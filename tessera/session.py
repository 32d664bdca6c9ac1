"""Session helpers: building a session, the shared checkpoint folder, and
size-checked broadcasts.

The caller owns the session.  ``build_session`` is a convenience for tests,
the bench and scripts; the operators never create or configure one.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(
    app_name: str = "tessera",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    executors: int | None = None,
    executor_cores: int | None = None,
    executor_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with adaptive execution (coalescing + skew-join splitting) on.

    ``executors`` / ``executor_cores`` / ``executor_memory`` request executor
    resources from a cluster manager; when given and ``shuffle_partitions`` is
    not, the shuffle starts at 4 partitions per requested core.  Either way it
    is a starting point only: AQE coalesces small partitions and splits skewed
    ones at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if executors:
        conf["spark.executor.instances"] = str(executors)
    if executor_cores:
        conf["spark.executor.cores"] = str(executor_cores)
    if executor_memory:
        conf["spark.executor.memory"] = executor_memory
    if not shuffle_partitions and executors:
        shuffle_partitions = executors * (executor_cores or 1) * 4
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints.

    Uses ``spark.checkpoint.dir`` from the session (on a cluster this names a
    shared folder).  Only when it is unset in local mode (tests) is a fresh
    scratch folder created and registered; on a cluster an unset folder is an
    error, since a machine-local folder would not survive a lost executor.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS or S3)")
        path = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def row_count_within(df: DataFrame, max_rows: int) -> int | None:
    """Row count of ``df`` if it is at most ``max_rows``, else ``None``.

    One aggregate over ``df``: each task sends a count, never its rows.
    """
    n = df.count()
    return n if n <= max_rows else None


def bounded_broadcast(df: DataFrame, max_rows: int, max_bytes: int = 256 << 20) -> tuple[DataFrame, bool]:
    """Mark ``df`` for broadcast only if rows and bytes are proven in bounds.

    Bytes are 8 for each value and the texts' own.  Returns the (possibly
    hinted) frame and whether the hint was applied; otherwise the frame is
    untouched and the planner shuffles it.
    """
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType.simpleString() == "string"]
    width = sum(texts, F.lit(8 * len(df.columns)))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("b")).first()
    if row["n"] <= max_rows and (row["b"] or 0) <= max_bytes:
        return F.broadcast(df), True
    return df, False


def spread(df: DataFrame) -> DataFrame:
    """Spread a CPU-heavy input over all cores when its scan cannot use them.

    A parquet file with one row group is read by one task however it is split,
    so an input of fewer files than cores is dealt out.  Only the file list is
    looked at: nothing runs while the plan is built.  Frames that are not read
    from files, and inputs of many files, are returned untouched.
    """
    if df.isStreaming:
        return df
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if 0 < len(df.inputFiles()) < want else df
