"""SparkSession factory and the shared scratch folder.

Production sessions are built by the cluster; these settings are what the
operators assume (UTC session zone, ANSI casts, AQE with skew handling).
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on; safe to apply on any session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows on their way to Python stand in memory three times; long texts make batches large before they make them many
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "ledgerlake") -> SparkSession:
    """Local session for tests and the bench; clusters pass their own master."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(os.environ.get("LEDGERLAKE_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.driver.memory", os.environ.get("LEDGERLAKE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application, so that operators with
    Python functions run where the package is not installed.  Code only; no data goes this way."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="ledgerlake-code-"), "ledgerlake-code")
    sc.addPyFile(shutil.make_archive(base, "zip", home, "ledgerlake"))
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir`` from the session
    (or the context's conf, or a checkpoint dir already set on the context).

    Only when none is named (local runs, tests) is a folder made under the
    local temp directory and registered as the checkpoint dir.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (no JVM context, e.g. a remote session)
        pass
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None)
        if not d and sc.getCheckpointDir():
            d = sc.getCheckpointDir().rstrip("/").rsplit("/", 1)[0]
    if not d:
        if sc is None or not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="ledgerlake-")      # one machine: any folder is shared
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d.rstrip("/") + "/rdd")
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared dir for one job's output."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
