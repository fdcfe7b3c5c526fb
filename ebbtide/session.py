"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", app: str = "ebbtide", memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the submit command sets master and sizes."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app).config("spark.driver.memory", memory)
    partitions = "8" if cpus == "*" else str(cpus)
    for key, value in {**_CONF, "spark.sql.shuffle.partitions": partitions, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> None:
    """Give the Spark context a checkpoint folder where the cluster's own setting has not done so."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by the cluster; a private one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="ebbtide-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
