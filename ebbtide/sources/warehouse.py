"""Written stage tables: read when present, built once when missing.

Events, the training table and scores feed many jobs, so each is built once per application and written
to the shared folder; a lost executor then costs a re-read, not a recomputation from the raw tables.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ebbtide.session import shared_folder


_SCHEMAS: dict = {}


def source_state(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of the tables in a folder: other files make other stage tables."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files.listStatus(path)] if files.exists(path) else []
    return repr(sorted(found))


class Warehouse:
    """Stage tables and fitted models of one set of inputs and settings; ``name`` must tell both."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        key = sha256(name.encode()).hexdigest()[:12]
        self.root = f"{shared_folder(spark)}/ebbtide/{spark.sparkContext.applicationId}/{key}"

    def model(self, name: str, fit: Callable[[], PipelineModel]) -> PipelineModel:
        """The fitted model ``name``: loaded when it was saved before, else fitted and saved."""
        path = f"{self.root}/models/{name}"
        if not self._done(f"{path}/metadata"):
            fit().write().overwrite().save(path)
        return PipelineModel.load(path)

    def _done(self, path: str) -> bool:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stage table ``name``. A table without its success marker is rebuilt from scratch."""
        path = f"{self.root}/{name}"
        if not self._done(path):
            frame = build()
            frame.write.mode("overwrite").parquet(path)
            _SCHEMAS[path] = frame.schema
        # With the schema at hand the files need not be sampled for it.
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path) if path in _SCHEMAS else self.spark.read.parquet(path)


def by_day(events: DataFrame) -> DataFrame:
    """Sort each task's events by day, so that windowed reads skip row groups and pages of every file.

    A range partitioning would prune whole files too, but it samples its input first, which would run
    the joins behind the events twice; events that arrive by day are clustered on their own.
    """
    return events.sortWithinPartitions("event_date")
