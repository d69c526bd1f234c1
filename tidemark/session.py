"""Session settings that the engine relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Settings that every query is written for. Cluster sizing stays with the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session with SETTINGS; the defaults suit one machine, a cluster passes its own sizing."""
    builder = SparkSession.builder.appName("tidemark")
    if master:
        builder = builder.master(master)
    conf = SETTINGS | {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"),
        "spark.ui.enabled": "false",
    }
    for key, value in (conf | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
