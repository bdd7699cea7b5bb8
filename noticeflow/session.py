"""Session construction and shared scratch locations.

Library operators never create a session; only tests, the bench and the
end-to-end runners call :func:`local_session`. On a cluster, the caller's
session is used as is and scratch data goes under the shared folder named
by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that matter for plan quality at any scale: AQE re-plans joins
# and coalesces partitions from real shuffle sizes, and splits skewed
# join partitions.
PLAN_CONFIGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "noticeflow") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("NOTICEFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
        # Local inputs are single files: spread them over the cores.
        .config("spark.noticeflow.scanPartitions", str(os.cpu_count() if cores == "*" else cores))
        # Driver-side only: skip per-call stack capture while building plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in PLAN_CONFIGS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only when none is set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a folder shared by the cluster "
                "(scratch tables and lineage cuts are written there)"
            )
        # Local runs and tests only: a private temporary folder.
        conf_dir = tempfile.mkdtemp(prefix="noticeflow-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/noticeflow-scratch/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers wherever the driver
    was started: its sources are zipped into the shared scratch folder and
    handed to the executors by Spark, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    target = sc._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "sources") + "/noticeflow_src.zip")
    fs = target.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(target, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(fs.makeQualified(target).toUri().toString())
    _SHIPPED.add(sc.applicationId)
