"""Session helpers: the caller owns the session; we only read its settings."""
from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_own: dict[str, str] = {}


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "metrolake") -> SparkSession:
    """Local session for tests and the benchmark (a cluster passes its own)."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local master gets ``fallback`` or one folder of its own
    under the system temp dir; on a cluster that is an error, because executors
    share no local disk. The caller's settings are not changed."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir() or fallback
    if not d and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not d:
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="metrolake-checkpoints-")
        d = _own[app]
    return d
