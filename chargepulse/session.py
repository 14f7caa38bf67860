"""Session helpers.

Nothing here hard-codes a cluster location.  Shared folders (checkpoints,
state tables) come from the session's ``spark.checkpoint.dir``; only when that
is unset (local tests) is a private temporary folder chosen and recorded in the
session so every later call agrees on it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans joins and coalesces or splits
# shuffle partitions from runtime sizes, skew-join splits hot keys, and the
# session zone pins string <-> time conversions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # streaming aggregation state off-heap in RocksDB (large key counts)
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app_name: str = "chargepulse",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (AQE then coalesces small ones); locally pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already-running session
                pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and state: ``spark.checkpoint.dir``.

    When the session has none (local tests) a fresh temporary folder is set,
    both as the conf value and as the SparkContext checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            root = jdir.get()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="chargepulse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    try:
        if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
            spark.sparkContext.setCheckpointDir(root)
    except Exception:
        pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared checkpoint root, optionally unique per call."""
    segs = [checkpoint_root(spark), *parts]
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    return "/".join(s.strip("/") if i else s for i, s in enumerate(segs))
