"""Session helpers: building a session for tests/bench, and shared work dirs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tollgate") -> SparkSession:
    """Session for tests and the bench. On a cluster, use the cluster's own
    session; every library function only reads settings from it."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small local data: let AQE keep several tasks per stage instead of
        # coalescing every shuffle into one 1 MB partition
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only where nothing is set (local tests)
    a folder is created, since a machine-local folder is useless on a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tollgate-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (for written tables,
    staged message files, streaming checkpoints and state)."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/tollgate/{name}-{uuid.uuid4().hex[:12]}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)
    return path


def clean_work(spark: SparkSession) -> None:
    """Delete all work folders of this session; once no result is read any more."""
    base = spark.sparkContext.getCheckpointDir()
    if base:
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/tollgate")
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
