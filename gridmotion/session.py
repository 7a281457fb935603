"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "gridmotion", master: str | None = None, **conf: str) -> SparkSession:
    """Session with AQE on; master and sizing come from spark-submit on a cluster."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, else a test folder."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        context.setCheckpointDir(named)
        return named
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="gridmotion-")
    context.setCheckpointDir(folder)
    return folder


def checkpointed(df):
    """Reliable checkpoint in the shared folder; the result survives executor loss."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _remove(folder: str) -> None:
    """Delete a scratch folder through Spark's own file system layer."""
    gateway = SparkContext._gateway
    if gateway is None:
        return
    hadoop = gateway.jvm.org.apache.hadoop
    path = hadoop.fs.Path(folder)
    path.getFileSystem(hadoop.conf.Configuration()).delete(path, True)


def _remove_quietly(folder: str) -> None:
    try:
        _remove(folder)
    except Exception:  # the JVM is gone; the owner of the shared folder cleans up
        pass


def scratch_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """Fresh path in the given folder, by default the shared one; removed as the driver ends."""
    own = f"{folder or shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    atexit.register(_remove_quietly, own)
    return f"{own}/{name}"
