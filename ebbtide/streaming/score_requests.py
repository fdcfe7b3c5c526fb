"""A stream of scoring requests joined with the feature store, and its prediction log.

Each micro-batch of requests is joined with the store as it stands and logged under the id of the stream and the
number of the batch, so a retried batch replaces its own records and every request of a stream is logged once.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ebbtide.contracts import RANGES
from ebbtide.operators import served
from ebbtide.settings import ServingRules

MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # the default of JSON keeps milliseconds only


def log_batch(requests: DataFrame, store: DataFrame, score: Column, log_path: str, stream: str, batch: int,
              ranges: dict = RANGES, rules: ServingRules = ServingRules()) -> None:
    """Answer one micro-batch and write its records as JSON lines, in place of earlier attempts."""
    records = served.answer(requests, store, score, ranges, rules)
    records.write.mode("overwrite").option("timestampNTZFormat", MICROSECONDS).json(f"{log_path}/stream={stream}/batch={batch}")


def start(spark: SparkSession, incoming: str, store: Callable[[], DataFrame], score: Column, log_path: str, checkpoint: str,
          ranges: dict = RANGES, rules: ServingRules = ServingRules(), files_per_batch: int = 64) -> StreamingQuery:
    """Answer every request file not seen before and stop. ``store`` is asked for the table once a micro-batch."""

    def batch(requests: DataFrame, number: int) -> None:
        # A new checkpoint is a new stream: its batch numbers start again, its id does not.
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        log_batch(requests, store(), score, log_path, stream, number, ranges, rules)

    requests = spark.readStream.schema(served.REQUEST_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(incoming)
    return requests.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def prediction_log(spark: SparkSession, path: str) -> DataFrame:
    """The records of all batches; the schema is fixed, so no file is sampled for it."""
    reader = spark.read.schema(served.LOG_SCHEMA).option("timestampNTZFormat", MICROSECONDS)
    return reader.option("recursiveFileLookup", True).json(path)
