"""Session defaults and the shared working folder."""

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def local_session(cores="*", shuffle_partitions=8, memory="8g", **conf):
    """Session for tests and the bench; a cluster passes its own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_folder():
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_folder(spark):
    """The folder every executor can reach, as the session names it in spark.checkpoint.dir.

    Only a local session that names none (a test) gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = _local_folder()
    return folder.rstrip("/")


def new_folder(spark, name):
    """A fresh sub-folder name under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
