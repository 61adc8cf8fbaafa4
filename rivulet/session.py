"""SparkSession helpers.

Everything in the library takes a ``SparkSession`` from the caller.  The helpers
here only (a) build a local session for tests and the bench, and (b) make sure
the few session settings the library relies on are in place without clobbering
what a cluster already configured.
"""

from __future__ import annotations

import gc
import os
import tempfile
import time

from pyspark.sql import SparkSession

# Settings the library needs for deterministic results.  Applied only when the
# session has not set them (a cluster's own choices win).
REQUIRED_CONF = {
    # Wall-clock semantics of the reference's TIMESTAMP WITHOUT TIME ZONE.
    "spark.sql.session.timeZone": "UTC",
}

# Settings that matter for scale; again only applied where unset.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what AQE measured to be small at runtime; otherwise the
    # planner keeps the sort-merge join.  This is the size check behind every
    # broadcast in the library: no hint forces one on an unbounded side.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Generated methods above 8000 bytecode bytes are never JIT-compiled by
    # HotSpot; above this size Spark falls back to smaller per-operator code.
    # The wide CDC projections (one typed column per table column) need it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Performance settings also applied to a caller's session, unless its launch
# configuration names them.
SESSION_PERF_CONF = ("spark.sql.codegen.hugeMethodLimit",)


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Set the required session confs where the session left them unset."""
    for key, value in REQUIRED_CONF.items():
        if key == "spark.sql.session.timeZone":
            # Always pin: results are defined in UTC wall-clock time.
            if spark.conf.get(key, None) != value:
                spark.conf.set(key, value)
            continue
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    launch = spark.sparkContext.getConf()
    for key in SESSION_PERF_CONF:
        if not launch.contains(key):
            spark.conf.set(key, SCALE_CONF[key])
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``.  Only a session on one machine
    (``local[...]``) that names none gets a scratch folder; on a cluster each
    node would write its own, and read back a part, so there it must be set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="rivulet-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def release(spark: SparkSession) -> None:
    """Have finished jobs' shuffle files removed.

    They go when the driver collects its garbage, which may be long after.  The
    first collection only finds the plan unreachable, the second one what the
    plan held; the pause lets Spark's cleaner see the first.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def local_session(cores: int | str = "*", app: str = "rivulet",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench: UI off, AQE on, UTC."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.scheduler.mode", "FAIR")  # models refreshed at a time share the cores
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("RIVULET_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # PySpark records the Python call site of every Column call (several
        # JVM round trips each) for error messages; the wide CDC plans make
        # thousands of such calls, which cost seconds per query plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**REQUIRED_CONF, **SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_conf(spark)
