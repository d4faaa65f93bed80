"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every campo job relies on.  AQE re-plans joins and coalesces
# partitions at runtime; the session time zone only matters for the few
# zoned conversions (the readings themselves are TIMESTAMP_NTZ).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # the statistics and advice queries generate large classes; a long-lived
    # session (dashboard, repeated reports) should not evict and recompile them
    "spark.sql.codegen.cache.maxEntries": "1000",
}


def build_session(app: str = "campo", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with campo's defaults.

    ``master`` is only set when given, so on a cluster the submit settings win.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the setting is absent (local runs, tests) a fresh folder under
    the system temp dir is created and recorded in the session, so later
    calls reuse it.  On a cluster the setting is expected to point at shared
    storage, and it is never overridden here.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; on a cluster it must name a "
                "shared folder (a machine-local temp dir does not survive "
                "executor loss)")
        d = tempfile.mkdtemp(prefix="campo-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint folder for written intermediates."""
    return os.path.join(checkpoint_dir(spark), name)
