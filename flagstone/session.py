"""Spark session defaults and the shared scratch location.

Intermediate tables (lineage cuts, round trips) go under the folder the
cluster names in ``spark.checkpoint.dir``; a machine-local temporary folder
is only used when that setting is absent *and* Spark runs in local mode
(tests, benchmarks on one machine).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the engine relies on. Adaptive execution sizes shuffle
# partitions at run time, broadcasts a side that it measures (or the planner
# estimates) to be below the broadcast threshold, and splits skewed join
# partitions, also where a later join on the same key then needs a shuffle.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}
ENGINE_CONF = {**SESSION_CONF, "spark.ui.enabled": "false"}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "flagstone", extra=None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app).config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**ENGINE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder (``spark.checkpoint.dir``).

    When unset and the master is local, a temporary folder is created and
    registered as the checkpoint directory; on a cluster an unset value is
    an error, because a machine-local folder is not visible to executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if d:
        return d
    master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    d = tempfile.mkdtemp(prefix="flagstone-")
    if sc is not None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
