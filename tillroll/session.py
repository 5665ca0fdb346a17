"""Session helpers: shared scratch folders and recommended settings.

Nothing here creates a session; callers pass theirs in.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs are designed around (AQE re-plans joins and partition
# counts from runtime sizes and splits skewed join / rebalance partitions).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    When a local session names none (tests), a folder is created and set as
    the checkpoint dir so later calls agree. On a cluster a folder of the
    driver's machine would be of no use to executors, so there the setting is
    required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - e.g. a Spark Connect session
            root = None
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:  # noqa: BLE001
            pass
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (works without a SparkContext)."""
    return spark.conf.get("spark.app.id", None) or spark.sparkContext.applicationId


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder under the shared root for one write-then-read."""
    return f"{shared_root(spark)}/tillroll/{name}-{uuid.uuid4().hex[:12]}"


#: Spark then removes a query's shuffle files when the query ends, not when the driver next happens to collect garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Within, each query's shuffle files go when it ends, so that a job of many writes holds those of the running ones only."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)


def apply_recommended(spark: SparkSession) -> SparkSession:
    for k, v in RECOMMENDED_CONF.items():
        spark.conf.set(k, v)
    return spark
