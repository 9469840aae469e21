"""Session defaults and lineage checkpoints.

The library never builds its own session on a cluster: it uses whatever
``SparkSession`` the caller passes in.  ``local_session`` exists for tests,
the benchmark and the smoke entry point.
"""

from __future__ import annotations

import atexit
import logging
import tempfile
import threading
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

_KEPT: list[DataFrame] = []
_KEPT_LOCK = threading.Lock()

# Conf keys read by the skew-aware join helpers (see operators/groups.py).
SKEW_MIN_ROWS = "spark.tessera.skew.minRows"
SKEW_SALTS = "spark.tessera.skew.salts"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    sc = spark.sparkContext
    sc.setLogLevel("ERROR")
    if not sc.getCheckpointDir() and not sc.getConf().get("spark.checkpoint.dir", None):
        # one local JVM (tests, bench): driver and executor share this folder
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-ckpt-"))
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's reliable checkpoint folder.

    A folder the caller has set (``setCheckpointDir``, or the cluster's
    ``spark.checkpoint.dir``) is used as it is.  The library never picks a
    machine-local folder itself: without one it raises, because a checkpoint
    that other executors cannot read is lost with the machine that wrote it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        raise RuntimeError(
            "no checkpoint folder: set spark.checkpoint.dir (a folder that the driver and all "
            "executors share) or call SparkContext.setCheckpointDir first")
    with _KEPT_LOCK:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives the
    loss of the executors that computed ``df``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, stem: str) -> str:
    """A new folder name under the shared checkpoint folder for a copy that a lazy
    result reads; removed, if it was written, when the program ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{stem}-{uuid.uuid4().hex}"
    atexit.register(remove_folder, spark, path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder wherever Spark's file systems reach it; without a running
    session nothing is done."""
    if spark.sparkContext._jsc is None:
        return
    try:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception as error:  # the session may be ending: a copy that stays harms nothing
        log.debug("%s was not removed: %s", path, error)


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    value = spark.conf.get(key, None)
    return int(value) if value not in (None, "") else default


def keep(df: DataFrame) -> DataFrame:
    """Persist an intermediate read by several branches of one query
    (memory, spilling to disk) and remember it, so ``release`` can free it
    once the query's result has been consumed."""
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    with _KEPT_LOCK:
        _KEPT.append(out)
    return out


def release() -> None:
    """Unpersist every intermediate kept so far.  Always safe: a cache is
    only an optimisation, and anything still referenced recomputes from
    its lineage (checkpointed lineage cuts are files and stay)."""
    with _KEPT_LOCK:
        kept = list(_KEPT)
        _KEPT.clear()
    for df in kept:
        df.unpersist(blocking=False)

