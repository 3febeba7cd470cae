"""Session settings the operators expect, and the folder for written intermediates."""

import uuid

from pyspark.sql import SparkSession

# Windows, hours and days are cut in UTC. Adaptive execution sizes the shuffles and picks
# broadcast joins, and hash joins where every partition is small, from measured sizes. State
# lives in RocksDB, off the JVM heap. Of a JSON object's equal names the last counts.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply `CONF` to a running session."""
    for key, value in CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names, or else in the session's warehouse, which is shared as well."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
