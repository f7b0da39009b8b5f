"""Sessions. On a cluster the session is the caller's; these settings are for local work."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("duebook")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
    )
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
