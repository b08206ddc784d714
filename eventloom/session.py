"""Session settings shared by the library, the tests and the bench."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that matter on a large cluster. Partition counts are an upper bound: AQE merges
# small shuffle partitions and splits skewed join partitions at run time.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Session settings that results, and the memory of streams, depend on.
_NEEDED = ("spark.sql.session.timeZone", "spark.sql.streaming.stateStore.providerClass")


def configure(spark: SparkSession) -> SparkSession:
    """Apply to a session somebody else built what results depend on (UTC), and the state store
    that keeps the state of streams on disk and not in the executors' memory."""
    for key in _NEEDED:
        if spark.conf.get(key, None) != SCALE_CONF[key]:
            spark.conf.set(key, SCALE_CONF[key])
    return spark


def local_session(
    cpus: int = 8, memory: str = "8g", name: str = "eventloom", **conf: str
) -> SparkSession:
    """A single-JVM session for tests and the bench; ``conf`` keys use ``__`` for a dot."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    extra = {key.replace("__", "."): value for key, value in conf.items()}
    # On one machine even small shuffles should use all cores.
    small = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
    for key, value in {**SCALE_CONF, **small, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster a machine-local
    folder would be lost with its machine, so the setting is required there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="eventloom-")
    return _LOCAL_ROOTS[context.applicationId]
