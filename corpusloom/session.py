"""Session defaults for local runs; a cluster passes its own session in."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", name: str = "corpusloom", **conf: str) -> SparkSession:
    """A ``local[cores]`` session with adaptive execution on and UTC time."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Joins go by measured sizes. A file's size says little about the n-grams in
        # it, so the estimate made before the run never decides on a broadcast.
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
