"""Session construction and the shared working folder.

Intermediate tables (materialised gold, checkpoints that cut lineage) live in
the folder the cluster names in ``spark.checkpoint.dir``. A private temporary
folder is used only when that setting is absent on a local master, as in tests;
on any other master its absence is an error, since executors would each write to
a disk of their own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library should carry. AQE re-plans joins from
# measured shuffle sizes, coalesces small partitions and splits skewed ones.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # Checkpoints only bridge a build step (surrogate keys); once the table is
    # written they are unreferenced and can be deleted by the context cleaner.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "medalforge", extra: dict | None = None) -> SparkSession:
    """Local session used by tests and the bench; clusters pass their own."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "16g"))
    for key, value in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; a local session without one gets a temporary one.

    Classic sessions read (and, if needed, set) the SparkContext checkpoint
    folder; Spark Connect sessions, which have no SparkContext, read
    ``spark.checkpoint.dir`` from the session configuration.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect
        sc = None
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _one_machine(sc.master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder shared by the cluster (master {sc.master})")
        configured = tempfile.mkdtemp(prefix="medalforge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def _one_machine(master: str) -> bool:
    """Whether driver and tasks are one process (``local``, ``local[8]``), so a local disk is shared."""
    return master == "local" or master.startswith("local[")


def session_id(spark: SparkSession) -> str:
    """Identifies the running application (used to key per-session caches)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique location under the shared folder."""
    return "/".join([shared_dir(spark), "medalforge", *parts, uuid.uuid4().hex])


def broadcast_limit(spark: SparkSession) -> int:
    """Byte bound under which an explicitly broadcast side is accepted."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    text = str(raw).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
             "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if text.endswith(suffix):
            return int(float(text[: -len(suffix)]) * units[suffix])
    return int(text)


__all__ = ["build_session", "shared_dir", "scratch_path", "broadcast_limit", "session_id",
           "RECOMMENDED_CONF"]
