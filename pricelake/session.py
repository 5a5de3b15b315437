"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that change results or plan quality; all can be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Static settings: only a session that is yet to be created can take them.
STATIC_CONF = {
    # do not record the Python call site of every column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build(master: str | None = None, app: str = "pricelake", **conf: str) -> SparkSession:
    """Create (or reuse) a session. On a cluster leave ``master`` to spark-submit.

    The number of shuffle partitions is left to the cluster's configuration, because
    it has to follow the data: adaptive execution merges small partitions, it does not
    split ordinary ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())

