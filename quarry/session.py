"""Session construction and the shared scratch folder.

Defaults are chosen for correctness first (UTC session zone, ANSI on) and for
scale second: AQE re-plans joins and coalesces/splits partitions at run time
from real shuffle sizes, so no query hard-codes a broadcast or a partition
count.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark import SparkConf, SparkContext
from pyspark.errors import PySparkAttributeError
from pyspark.sql import SparkSession

# Defaults for sessions this package builds. A setting that was submitted with
# the application, or that an active session holds, wins over its default here;
# every job also works without them. The number of shuffle partitions is left
# to the cluster (tests and bench pass their own).
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on a *measured* size: no broadcast from plan estimates
    # (they can be far off after filters and joins); AQE turns a sort-merge
    # join into a broadcast join when a finished shuffle stage is under 10 MB.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MB = 1024 * 1024


def cluster_conf(total_cores: int, largest_shuffle_bytes: int) -> dict[str, str]:
    """Settings for a large cluster, derived from its size and the largest
    shuffle a job will write (e.g. the projected line-item columns).

    * Initial shuffle partitions: ~256 MB each, at least 3 waves of tasks,
      at most 100k (map-status tracking on the driver grows with maps x
      partitions); AQE then coalesces small partitions and splits skewed ones.
    * Broadcasts only on measured sizes (AQE), up to 64 MB per table.
    * Streaming state in RocksDB (off-heap, spills to local disk, checkpointed
      incrementally), so large windowed state does not live on the JVM heap.
    """
    by_size = -(-largest_shuffle_bytes // (256 * MB))
    partitions = min(max(3 * total_cores, by_size), 100_000)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MB),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.files.maxPartitionBytes": str(256 * MB),
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.session.timeZone": "UTC",
    }


def _given_settings() -> set[str]:
    """Names of the settings of the active session, or else of those that were
    submitted with the application."""
    active = SparkSession.getActiveSession()
    if active is not None:
        own = {r["key"] for r in active.sql("SET").select("key").collect()}
        sc = _context(active)
        return own | ({k for k, _ in sc.getConf().getAll()} if sc else set())
    SparkContext._ensure_initialized()  # submitted settings are known to the JVM
    return {k for k, _ in SparkConf().getAll()}


def build_session(
    master: str | None = None,
    app_name: str = "quarry",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session. ``conf`` is set as given; this package's
    defaults only fill in what neither ``conf``, the submit command nor the
    active session sets."""
    given = _given_settings()
    settings = {k: v for k, v in DEFAULT_CONF.items() if k not in given}
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session (no context)."""
    try:
        return spark.sparkContext
    except PySparkAttributeError:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` (or set on the context) is
    used as is. Only when nothing is configured -- local tests -- a fresh
    folder is created and registered, so lineage cuts and intermediate tables
    always land in a location every executor can read.
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    master = sc.master if sc else spark.conf.get("spark.master", "")
    if not configured:
        if not master.startswith("local"):
            # a machine-local folder is invisible to other executors
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a folder shared by "
                "all executors (e.g. on the cluster file system)"
            )
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    if not sc:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/quarry/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def _hadoop_path(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    fs.mkdirs(p)


def folder_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p)


def list_folder(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the folders in ``path``, hidden ones left out."""
    p, fs = _hadoop_path(spark, path)
    found = [s.getPath() for s in fs.listStatus(p) if s.isDirectory()]
    return [(f.toString(), fs.getContentSummary(f).getLength())
            for f in found if f.getName()[0] not in "_."]


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder of one file system, at once; ``target`` must not exist."""
    p, fs = _hadoop_path(spark, source)
    to, _ = _hadoop_path(spark, target)
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(p, to):
        raise OSError(f"cannot move {source} to {target}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's scratch data, if it is there."""
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Scope for scratch data: every folder that jobs make inside it is deleted
    at its end. Results are read lazily, so use them inside the scope."""
    _scopes.append([])
    try:
        yield _scopes[-1]
    finally:
        for path in _scopes.pop():
            remove_folder(spark, path)
