"""Session construction and the shared scratch folder.

Everything that has to be written during a job (round trips, landed snapshots,
stream checkpoints, lineage cuts) goes below the folder the cluster names in
``spark.checkpoint.dir``. A machine-local temporary folder is only used when the
session runs in local mode *and* that setting is unset (tests, laptops).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "contrail",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters pass their own session."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if master.startswith("local") and not master.startswith("local-cluster") and "spark.checkpoint.dir" not in (extra or {}):
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="contrail-ck-", dir="/tmp")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Base folder for anything the job writes; taken from ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d is None:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        if d is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            d = tempfile.mkdtemp(prefix="contrail-ck-", dir="/tmp")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir()
    return d.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never used folder below the shared scratch folder."""
    return f"{shared_dir(spark)}/contrail/{name}/{uuid.uuid4().hex}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (for the few helpers that list files in tests)."""
    return path[5:] if path.startswith("file:") else path
