"""Session construction and the checkpoint folder.

Jobs never build their own session: callers pass one in. ``build_session`` is a
convenience for scripts, tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Confs every job relies on. Only standard Spark SQL settings.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    app: str = "orderlens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local/session helper for scripts and tests (the Spark UI stays off)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(JOB_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` must name a folder every executor
    shares (HDFS, object store); it is read from the session. A machine-local
    temporary folder is used only when nothing is configured and the session
    runs in local mode (tests, the benchmark)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
        if configured:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir() or configured
        local = sc.master.startswith("local")
    else:
        if configured:
            return configured
        local = str(spark.conf.get("spark.master", "")).startswith("local")
    if not local:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a folder every executor shares"
        )
    base = os.environ.get("TMPDIR", tempfile.gettempdir())
    folder = tempfile.mkdtemp(prefix="orderlens-ckpt-", dir=base)
    if sc is not None:
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir() or folder
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
