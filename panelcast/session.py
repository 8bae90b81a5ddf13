"""Session construction for tests, the bench and local runs.

On a cluster the session comes from the platform; panelcast never overrides
settings that are already present (checkpoint dir, shuffle partitions).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def get_spark(app: str = "panelcast", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session with AQE on and the UI off (used by tests and bench)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in _LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def session_id(spark: SparkSession) -> str:
    """Identity of the running application (memo keys for lazily built plans)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only on a local master without the setting (tests) a scratch folder is
    created and registered. On a cluster the configured shared folder is used
    as it is, and a missing setting is an error: a folder of the driver's own
    disk could not be read back from the executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote (Connect) session: configuration only
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not spark.conf.get("spark.master", "").startswith("local[") and spark.conf.get("spark.master", "") != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="panelcast-ckpt-", dir=os.environ.get("PANELCAST_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d
