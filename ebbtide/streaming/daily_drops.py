"""Micro-batch ingestion of daily files: contract gate, cleaning, merge, log.

The stream itself only lists new files; each micro-batch reads its files as ordinary distributed scans, so
the header of every file can be checked before its rows are. A micro-batch writes to its own partition of
the event table and of the log, named after the stream and the batch. A retried micro-batch replaces what it
wrote before, and the natural-key merge ignores rows that other batches and streams brought, so every row is
stored once. Inside a batch the rows lie by month, and a merge opens only the months its own rows belong to.
"""

from __future__ import annotations

import json
import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ebbtide.contracts import EVENT_COLUMNS, EVENT_SCHEMA, RUN_LOG_SCHEMA
from ebbtide.operators.cleaning import clean_events
from ebbtide.operators.merge import in_months_of, month_of, new_events, run_record
from ebbtide.settings import CleaningRules
from ebbtide.sources import retail

# Layout of the file listing; the content column is never selected, so file bodies are not read by it.
_LISTING = "path string, modificationTime timestamp, length bigint, content binary"
_STORED = T.StructType(EVENT_SCHEMA.fields + [T.StructField("source_file", T.StringType()), T.StructField("stream", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("month", T.StringType())])


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stored_events(spark: SparkSession, path: str) -> DataFrame:
    """The event table with its lineage columns; empty when nothing was ingested yet."""
    if not _exists(spark, path):
        return spark.createDataFrame([], _STORED)
    return spark.read.schema(_STORED).option("basePath", path).parquet(path)


def run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).option("recursiveFileLookup", True).json(path)


def ingest_files(spark: SparkSession, files: list[str], events_path: str, log_path: str, batch: int, rules: CleaningRules = CleaningRules(),
                 dry_run: bool = False, stream: str = "manual") -> None:
    """Ingest one batch of files, older files first. ``files`` is bounded by the files per micro-batch.

    What is written belongs to (stream, batch): a retry replaces it, and nothing else ever does.
    """
    started = time.time()
    columns = retail.headers(spark, files)
    accepted, rejected = {}, []
    for path in files:
        try:
            retail.check_columns(columns[path])
            accepted[path] = columns[path]
        except retail.ContractError as error:
            rejected.append((path, str(error)))
    stamp = datetime.now(timezone.utc)
    run = stamp.strftime("%Y%m%dT%H%M%S%f")
    part = f"stream={stream}/batch={batch}"
    records, staging = [], f"{events_path}-staging/{part}/{run}"
    if rejected:
        refused = spark.createDataFrame(rejected, "source_file string, error string")
        records.append(_complete(refused, status="'rejected_schema'", rows_read="0L", rows_appended="0L"))
    if accepted:
        lines = retail.typed(retail.scan_files(spark, list(accepted), accepted), keep=["file_time", "source_file"])
        # Written once: the record, the day span and the merge all read the cleaned rows.
        clean_events(lines, rules, by=["file_time", "source_file"]).write.mode("overwrite").parquet(staging)
        cleaned = spark.read.parquet(staging)
        facts = run_record(lines, cleaned, ["source_file"], rules)
        if dry_run:
            records.append(_complete(facts, status="'dry_run'", rows_appended="0L"))
        else:
            months = [r.month for r in cleaned.select(month_of("event_date").alias("month")).distinct().collect()]  # bounded by the calendar
            own = F.col("stream").eqNullSafe(F.lit(stream)) & (F.col("batch") == batch)
            before = stored_events(spark, events_path).where(~own)
            appended = new_events(in_months_of(before, months), cleaned, prefer=["file_time", "source_file"])
            rows = appended.select(*EVENT_COLUMNS, "source_file", month_of("event_date").alias("month"))
            rows.hint("rebalance", F.col("month")).write.mode("overwrite").partitionBy("month").parquet(f"{events_path}/{part}")
            kept = stored_events(spark, events_path).where(own).groupBy("source_file").agg(F.count("*").alias("rows_appended"))
            total = _rows_logged(spark, log_path, part) + (kept.agg(F.sum("rows_appended")).first()[0] or 0)
            joined = facts.join(F.broadcast(kept), "source_file", "left").withColumn("rows_appended", F.coalesce("rows_appended", F.lit(0)))
            records.append(_complete(joined, status="'ok'", rows_appended="rows_appended", warehouse_rows=f"{total}L",
                                     rows_deduplicated="rows_after_cleaning - rows_appended"))
    out = records[0]
    for record in records[1:]:
        out = out.unionByName(record)
    seconds = round(time.time() - started, 3)
    out = out.withColumns({
        "run_id": F.lit(run), "ingested_at_utc": F.lit(stamp.isoformat()).cast("timestamp"), "dry_run": F.lit(dry_run), "duration_s": F.lit(seconds)})
    # Dry runs have a log of their own and leave the records of real runs alone.
    home = f"{dry_log(log_path)}/{part}/run={run}" if dry_run else f"{log_path}/{part}"
    out.select(*RUN_LOG_SCHEMA.fieldNames()).write.mode("overwrite").json(home)
    _delete(spark, staging)


def dry_log(log_path: str) -> str:
    """Where dry runs of a log are recorded."""
    return f"{log_path.rstrip('/')}-dry"


def _rows_logged(spark: SparkSession, log_path: str, part: str) -> int:
    """Rows appended by all other batches, from their records: one row per file, however large the event table is."""
    if not _exists(spark, log_path):
        return 0
    log = run_log(spark, log_path).where(~F.col("_metadata.file_path").contains(f"/{part}/"))
    return log.agg(F.sum("rows_appended")).first()[0] or 0


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _complete(facts: DataFrame, **columns: str) -> DataFrame:
    """Facts in the log layout, fields that do not apply left NULL."""
    types = {f.name: f.dataType.simpleString() for f in RUN_LOG_SCHEMA.fields}
    out = []
    for name, kind in types.items():
        source = columns.get(name) or (name if name in facts.columns else "NULL")
        out.append(f"cast({source} AS {kind}) AS {name}")
    return facts.selectExpr(*out)


def start(spark: SparkSession, incoming: str, events_path: str, log_path: str, checkpoint: str, rules: CleaningRules = CleaningRules(), files_per_batch: int = 1) -> StreamingQuery:
    """Ingest every file not seen before, oldest first, and stop."""

    def batch(listing: DataFrame, number: int) -> None:
        # At most ``files_per_batch`` names.
        names = [r.path for r in listing.collect()]
        if names:
            # A new checkpoint is a new stream: its batch numbers start again, its id does not.
            stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
            ingest_files(spark, names, events_path, log_path, number, rules, stream=stream)

    listing = (
        spark.readStream.format("binaryFile").schema(_LISTING).option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch).load(incoming).select("path"))
    return listing.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
