"""Session helpers: building a local session for tests, resolving the shared
checkpoint folder, and a broadcast that is only taken behind a size check."""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a dimension side may have before we stop broadcasting it explicitly and
# leave the choice to the planner (sort-merge join, or AQE's runtime switch).
BROADCAST_MAX_ROWS = 100_000


def local_session(app: str = "tidemark", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session used by tests, bench and the smoke entry.

    On a cluster the session comes from the launcher; only the settings that
    matter for correctness (ANSI, UTC) are asserted by the library itself.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Local runs have few cores and small stages: smaller coalesced
        # partitions keep all cores busy (a cluster sizes this to its executors).
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster sets it to a shared file system; only when it is unset (tests,
    local runs) do we pick a fresh scratch folder of our own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir=os.environ.get("TIDEMARK_SCRATCH", "/tmp"))
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in whatever file system the path names.
    Any other failure (permissions, connection) is raised, never taken for absence."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    if not path_exists(spark, path):
        return []
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().getName() for s in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table in the shared
    checkpoint folder and reading it back.

    Preferred over ``DataFrame.checkpoint()``: the table is columnar and
    compressed, later scans read only the columns they need and push filters,
    and a lost executor re-reads the table instead of recomputing its input.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    if getattr(_scopes, "open", None):
        _scopes.open[-1].append(path)
    return df.sparkSession.read.parquet(path)


_scopes = threading.local()


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Tables that ``materialize`` writes inside, on this thread, are removed at the end: for jobs whose results are all
    on storage by then, such as one micro-batch of a stream that runs for months."""
    stack = _scopes.__dict__.setdefault("open", [])
    stack.append([])
    try:
        yield
    finally:
        for path in stack.pop():
            remove(spark, path)


@contextlib.contextmanager
def few_listing_tasks(spark: SparkSession):
    """Folders that are opened inside are listed by a few tasks a core, many folders each, where Spark would start
    a task for every folder: a snapshot has one folder per symbol."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def guarded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only when it provably has at most ``max_rows`` rows.

    The check is one bounded job (``limit(max_rows + 1).count()``). Above the
    bound the frame is returned unchanged, so the planner shuffles both sides
    (and AQE may still switch to a broadcast at run time if it turns out small).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
