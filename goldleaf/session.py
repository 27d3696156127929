"""Session defaults and the shared scratch folder.

The library never invents a machine-local folder on a cluster: lineage is cut
with ``DataFrame.checkpoint()`` into the folder named by ``spark.checkpoint.dir``
and round-trip tables are written below it.  Only when the setting is absent
(local tests) is a fresh temporary folder created and registered.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  Timestamps are parsed as
# TIMESTAMP_NTZ, so results never depend on the session zone; UTC is pinned
# anyway for the few zone-aware functions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Settings of the table queries and jobs, on top of the defaults.  Their rows grow inside a task
# (a narrow line item becomes an extract row with two JSON documents), so a task's share of a
# shuffle must stay small for its sorts to stay in memory; their projections are long, and the
# JVM only interprets a generated method of over 8,000 bytes; a finished write needs its shuffles no more.
TABLE_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "goldleaf", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (the UI stays off)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession, tables: bool = False) -> SparkSession:
    """Apply the defaults (with ``tables`` TABLE_CONF too) to an existing session; one that cannot be set raises."""
    for k, v in (DEFAULT_CONF | (TABLE_CONF if tables else {})).items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder, creating one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="goldleaf-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in the shared folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/goldleaf-tables/{name}-{uuid.uuid4().hex[:12]}"
    if _open_scopes():
        _open_scopes()[-1].append(path)
    return path


_SCOPES = threading.local()


def _open_scopes() -> list[list[str]]:
    return _SCOPES.__dict__.setdefault("open", [])


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables whose path this thread asks for inside are deleted at its end.

    For a job whose result is written before the end; nothing that reads them may outlive it.
    """
    paths: list[str] = []
    _open_scopes().append(paths)
    try:
        yield
    finally:
        _open_scopes().pop()
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
