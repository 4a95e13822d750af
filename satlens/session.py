"""Session helpers.

Library functions never build their own session: they take DataFrames (or a
session passed in) so that the caller's cluster settings win.  ``get_session``
is for tests, the bench and notebooks; it only fills settings that are unset.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

# Settings that matter for every plan in this package.  AQE re-plans joins at
# runtime (broadcast only after the real size is measured), coalesces small
# shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # row_number()/rank() <= k becomes a partial top-k before the shuffle
    # (WindowGroupLimit); keep it on for the sample sizes used here.
    "spark.sql.optimizer.windowGroupLimitThreshold": "5000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # A long-lived driver runs many plans: keep little per-execution history.
    "spark.sql.ui.retainedExecutions": "20",
    "spark.ui.retainedJobs": "100",
    "spark.ui.retainedStages": "100",
    "spark.ui.retainedTasks": "10000",
}


# Spark's Bloom filters of a join's filtered side: rows of the other side that cannot match are dropped before they are shuffled.
# 16 MB of bits let pass 5 % of such rows at 20 million keys, 12 % at 30 million; beyond, more pass, with the same results.
RUNTIME_FILTERS = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "8GB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "64MB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "28000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "28000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": str(1 << 27),
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(1 << 27),
}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Jobs that start inside use ``values``; the caller's settings are back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def runtime_filters(spark: SparkSession) -> AbstractContextManager[None]:
    """Jobs that start inside use ``RUNTIME_FILTERS``."""
    return settings(spark, RUNTIME_FILTERS)


def get_session(master: str | None = None, app: str = "satlens",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is respected as is.
    Only on a local master, where one machine is all there is, an unset setting
    is filled with a scratch folder; on a cluster executors could not see it.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="satlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for materialised tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)
