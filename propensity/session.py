"""Session helpers: building a session for tests/bench, the shared
checkpoint folder, the source shipped to executors, and size-checked broadcast."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str | None = None, app: str = "propensity",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with AQE on, the UI off and UTC time; used by tests and the bench.

    On a cluster, deploy settings (memory, cores, checkpoint folder) come from
    spark-submit, not from here."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


MB = 1 << 20


def sizing(input_bytes: int, total_cores: int, target_partition_mb: int = 256) -> dict:
    """Partition settings for a run over ``input_bytes`` of Parquet on
    ``total_cores`` executor cores: scan splits and shuffle partitions near
    ``target_partition_mb`` (spill-free for a few GB of executor memory per
    core), never fewer than 2 tasks per core; AQE coalesces and splits skewed
    partitions at run time from there. E.g. 100 TB on 8,000 cores gives
    256 MB splits and ~400k shuffle partitions."""
    per_part = max(32, target_partition_mb) * MB
    shuffle = max(2 * total_cores, -(-int(input_bytes) // per_part))
    return {
        "spark.sql.files.maxPartitionBytes": str(per_part),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(per_part),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir``; only a local-mode session without it
    (tests) gets a fresh folder under /tmp. A cluster session without it is an
    error: a machine-local folder is not visible to other executors. What is
    written there goes when the driver's JVM ends."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            configured = None
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder every "
                "executor can reach (HDFS, S3, a shared volume)")
        configured = tempfile.mkdtemp(prefix="propensity-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    # Spark makes a folder of this application's own under the configured one
    made = sc.getCheckpointDir() or configured
    path = sc._jvm.org.apache.hadoop.fs.Path(made)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(path)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


_shipped: set[str] = set()
_shipping = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package's source (once a session), so tasks
    can import it wherever it is installed or not. Spark serves the archive
    from the driver."""
    sc = spark.sparkContext
    with _shipping:  # folds are fitted by threads
        if sc.applicationId in _shipped:
            return
        root = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(archive))
        _shipped.add(sc.applicationId)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: A task of iterative work reads about this much of the widest form its rows are kept in.
PARTITION_BYTES = 128 * MB


def partitions_needed(df: DataFrame, min_partitions: int | None, row_bytes: int) -> int | None:
    """The number of partitions to deal a kept (checkpointed or cached) table
    out to, so that none holds over ``PARTITION_BYTES`` at ``row_bytes`` a row
    and there are ``min_partitions`` (default: ``defaultParallelism``) at
    least; None if it is so already. Rows are counted by partition: one file
    of few row groups gives many partitions of which most are empty."""
    most = max(1, PARTITION_BYTES // row_bytes)
    rows, largest = (df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
                     .agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first())
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= n and largest <= most:
        return None
    return max(n, -(-rows // most))


def checkpoint_spread(df: DataFrame, min_partitions: int | None = None, row_bytes: int = 1024) -> DataFrame:
    """L1 + L2 for a table that iterative work starts from: a reliable
    checkpoint, and, only when its partitions are too few (a small input: one
    file is one partition and would run every fit on one core) or one is too
    large (see ``partitions_needed``), a round-robin repartition checkpointed
    again. Partitions are counted on the checkpointed table; asking an
    adaptive plan for them would run its shuffles. An input that is spread
    well is written once."""
    c = cut_lineage(df)
    if n := partitions_needed(c, min_partitions, row_bytes):
        c = cut_lineage(c.repartition(n))
    return c


def persist_spread(df: DataFrame, min_partitions: int | None = None, row_bytes: int = 1024) -> DataFrame:
    """The cached counterpart of ``checkpoint_spread`` (materialised here)."""
    p = df.persist()
    if n := partitions_needed(p, min_partitions, row_bytes):
        q = p.repartition(n).persist()
        q.count()
        p.unpersist()
        return q
    return p


def broadcast_if_bounded(df: DataFrame, max_rows: int, bound: int | None = None) -> DataFrame:
    """Broadcast a join side only when its row count is proven small.

    ``bound`` is an analytic upper bound known by the caller (e.g. number of
    buckets x number of classes). Without it the side is counted (cheap: the
    callers pass aggregated tables). Above ``max_rows`` the side is returned
    as is and the planner chooses a shuffle join."""
    n = bound if bound is not None else df.count()
    return F.broadcast(df) if n <= max_rows else df


BROADCAST_MAX_ROWS = 2_000_000
