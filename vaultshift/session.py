"""Session settings the plans rely on."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every run needs: UTC for the date rule, AQE for runtime re-planning (partition
# coalescing, skew splits of the cold join, broadcast of small sides measured at run time).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Constraints of the wide rule expressions are propagated through every filter, which took up to ten times the
    # run time of a query in the optimizer. Null keys are filtered where a plan needs it, not by inference.
    "spark.sql.constraintPropagation.enabled": "false",
    # spark.sql.codegen.hugeMethodLimit stays at Spark's default: capping it at the JVM's 8000-byte
    # JIT limit made the join stage fall back to per-operator code and run 1.4-1.8x slower at 1 M
    # subscribers (generated code is already split into small functions).
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


RELEASE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within it a job's shuffle files are deleted when the job ends, not when the driver's garbage collector finds
    them unused. For runs of many large jobs that execute no frame twice: a second execution shuffles again."""
    before = spark.conf.get(RELEASE_CONF, None)
    spark.conf.set(RELEASE_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE_CONF)
        else:
            spark.conf.set(RELEASE_CONF, before)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "vaultshift") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for materialised intermediates: ``spark.checkpoint.dir``. Only a local master
    (tests) may do without it and gets a temporary folder; on a cluster each executor would write to
    its own disk, so there its absence is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    else:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="vaultshift-ckpt-"))
    return sc.getCheckpointDir()
