"""Session, table loading and scratch-path helpers.

Nothing here holds a session in module scope: every function takes the
``SparkSession`` it works on.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "reviewlake") -> SparkSession:
    """Local session for tests and the bench; on a cluster use the cluster's own."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # small local shuffles of text-heavy rows: keep them spread over the
        # cores instead of coalescing a few MB of pages into one CPU-bound task
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("REVIEWLAKE_DRIVER_MEMORY", "16g"))
    )
    event_dir = os.environ.get("REVIEWLAKE_EVENT_LOG_DIR")
    if event_dir:   # stage/task times without the UI: Spark's event log in a scratch folder
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None where there is none (Spark Connect raises)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - any "not available" error means no context
        return None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; column pruning and filters reach the parquet scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local-mode session (tests, bench) without
    one gets a fresh folder under /tmp; a cluster session without one is an
    error, since a machine-local folder is not shared by the executors.
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current.rstrip("/")
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        conf = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if sc is not None:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir().rstrip("/")
    return conf.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused path for a written intermediate table."""
    return f"{checkpoint_root(spark)}/reviewlake/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table into the shared scratch folder and read
    back: computed once, cut from its lineage, safe against lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
