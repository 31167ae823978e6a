"""Session settings and the shared work folder every job builds under."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # epoch seconds are compared as plain numbers; dates must not move with the host zone
    "spark.sql.session.timeZone": "UTC",
    # repeated keys in a payload: the last one wins
    "spark.sql.variant.allowDuplicateKeys": "true",
    # generated methods beyond the JIT limit of 8000 bytes would run interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # timers of waiting messages need it
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; sizes stay the cluster's."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str = "*", partitions: int = 8, app: str = "searchloom") -> SparkSession:
    """A session for tests and benches on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # call-site capture costs more than building an expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="searchloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the work root; runs never share one by accident."""
    return f"{work_root(spark)}/searchloom/{name}-{uuid.uuid4().hex[:12]}"


def built_once(build: Callable) -> Callable:
    """Keep what an argument-free builder of expressions returns, per Spark context.

    The wide projections take thousands of small calls into the JVM to build; the
    resulting columns name their inputs only and can be used on any frame.
    """
    kept: dict[int, object] = {}

    @functools.wraps(build)
    def wrapper():
        key = id(SparkContext._active_spark_context)
        if key not in kept:
            kept.clear()
            kept[key] = build()
        return kept[key]

    return wrapper
