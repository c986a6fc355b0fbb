"""Session settings the engine relies on.

Every public entry point calls :func:`prepare` so results do not depend on the
caller's session: timestamps are formatted in UTC and a reliable checkpoint
directory is known before any operator needs to cut lineage.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings applied when this package builds the session itself.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # no call-site capture on every expression: it dominates building a plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "blotter",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC and make sure a checkpoint dir is set."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local-mode session without one
    (tests, laptops) gets a private folder; a cluster session without a shared
    folder is an error, because a machine-local folder would not survive the
    loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session: the server owns the context
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this session")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on this cluster")
        configured = tempfile.mkdtemp(prefix="blotter-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
