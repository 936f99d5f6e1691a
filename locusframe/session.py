"""Session helpers: where shared intermediate tables go, and the local test session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_BASES: dict[str, str] = {}


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the folder named by ``spark.checkpoint.dir``.

    Tables written there are read back by other tasks, so on a cluster the folder has to be
    reachable by every executor. Only a local session may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _LOCAL_BASES:
            _LOCAL_BASES[context.applicationId] = tempfile.mkdtemp(prefix="locusframe-")
        base = _LOCAL_BASES[context.applicationId]
    return f"{base.rstrip('/')}/locusframe/{label}-{uuid.uuid4().hex}"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "locusframe") -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Looking up the Python line of every expression takes most of a large plan's build time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
