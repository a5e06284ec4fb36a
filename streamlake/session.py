"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators assume.  Event-time logic is written for UTC and the
# oracle compares naive timestamps, so the session zone is pinned.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # target size AQE uses to coalesce small shuffle partitions and to split
    # skewed join partitions
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # iteration rounds checkpoint into the shared folder; let the context
    # cleaner delete checkpoints no longer referenced (startup-only setting)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "streamlake",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's base settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is.
    Only when it is unset and the master is local (tests) a scratch folder is
    created; on a cluster executors could not share it, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="streamlake-ckpt-")
        os.makedirs(configured, exist_ok=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``streamlake`` importable on the executors' Python workers
    (``addPyFile`` of a zip of the package, once per SparkContext), so pandas
    UDFs and keyed folds work wherever the driver was started from."""
    import shutil
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect): ship via the client instead
        return
    token = sc.applicationId
    if token in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="streamlake-pkg-")
    archive = shutil.make_archive(os.path.join(out, "streamlake"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="streamlake")
    sc.addPyFile(archive)
    _SHIPPED.add(token)


def apply_base_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of BASE_CONF to an existing session."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes",
              "spark.sql.execution.arrow.pyspark.enabled"):
        spark.conf.set(k, BASE_CONF[k])
    ship_package(spark)


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 128 << 20,
                          minimum: int = 200) -> int:
    """Initial ``spark.sql.shuffle.partitions`` for an input size: about one
    partition per ``target_bytes`` (AQE coalesces small ones at runtime).
    E.g. 100 TB -> ~800k; then set ``spark.sql.files.maxPartitionBytes`` near
    the same target so scan tasks fit executor memory too."""
    return max(minimum, -(-input_bytes // target_bytes))
