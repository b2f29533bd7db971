"""Session construction and the shared working folder.

On a cluster the session comes from ``spark-submit``; ``get_spark`` then only
attaches to it. Locally (tests, bench) it builds a ``local[N]`` session with
settings sized for a single machine.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_LOCAL_DIR: str | None = None
_SHIPPED: set[str] = set()


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tidepool", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one.

    The settings pinned here matter for results, not only speed: a UTC session
    zone (event-time windows and epoch seconds), and AQE so shuffle partition
    counts adapt to the data at run time.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (``local``, ``local[N]``), not a cluster."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def _checkpoint_base(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``), or a local one.

    A local temporary folder is only made when the setting is absent and the
    master is local; on a cluster the setting must name shared storage that
    every executor can reach, and its absence is an error.
    """
    global _LOCAL_DIR
    base = None
    try:
        base = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf not readable
        base = None
    if not base:
        try:
            base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
        except Exception:  # pragma: no cover - Spark Connect has no SparkContext
            base = None
    if not base:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if _LOCAL_DIR is None:
            _LOCAL_DIR = tempfile.mkdtemp(prefix="tidepool-")
        base = _LOCAL_DIR
        try:
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(os.path.join(base, "rdd-checkpoints"))
        except Exception:  # pragma: no cover
            pass
    return base.rstrip("/")


def shared_dir(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A fresh path under the shared folder for query state, sinks or cut lineage."""
    base = _checkpoint_base(spark)
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{base}/tidepool/{leaf}"


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a session: keyed state and data sources run there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    to = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{root.name}.zip")
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(to)
    _SHIPPED.add(app)
