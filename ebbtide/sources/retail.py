"""Raw text extracts: contract check, typed scan, and the table and log sinks."""

from __future__ import annotations

import csv
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ebbtide.contracts import EVENT_COLUMNS, EVENT_SCHEMA, RUN_LOG_SCHEMA, SOURCE_COLUMNS, SOURCE_TS_PATTERN


class ContractError(ValueError):
    """A source file lacks a required column."""


def check_columns(columns: list[str]) -> list[str]:
    """Raise on missing source columns; return the additional ones, which are ignored."""
    missing = sorted(set(SOURCE_COLUMNS) - set(columns))
    if missing:
        raise ContractError(f"source columns missing: {missing}; got {sorted(columns)}")
    return sorted(set(columns) - set(SOURCE_COLUMNS))


def typed(raw: DataFrame, strict: bool = True, keep: list[str] = []) -> DataFrame:
    """Select by name, rename to canonical names and parse. ``strict`` aborts on a bad timestamp."""
    parse = F.to_timestamp_ntz if strict else lambda c, p: F.try_to_timestamp(c, p).cast("timestamp_ntz")
    pattern = F.lit(SOURCE_TS_PATTERN)
    as_type = {
        "quantity": lambda c: c.cast("double"),
        "unit_price": lambda c: c.cast("double"),
        "event_ts": lambda c: parse(c, pattern),
    }
    return raw.select(*[
        as_type.get(new, lambda c: c.cast("string"))(F.col(old)).alias(new) for old, new in SOURCE_COLUMNS.items()
    ], *keep)


def _place(path: str) -> str:
    """The path without scheme, host and escapes, as a common name for a file."""
    return unquote(urlparse(path).path if "://" in path or path.startswith("file:") else path)


def headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Column names of text files, from their first lines; a BOM is stripped, an empty file has none.

    The executors read the files; a file's first line is the first that the task with its beginning sees.
    """
    lines = spark.read.text(paths).where("_metadata.file_block_start = 0").select(F.col("_metadata.file_path").alias("path"), "value")
    found = {_place(r.path): r.line for r in lines.groupBy("path").agg(F.first("value").alias("line")).collect()}
    return {p: next(csv.reader([(found.get(_place(p)) or "").lstrip("\ufeff")]), []) for p in paths}


def scan_files(spark: SparkSession, paths: list[str], known: dict[str, list[str]] | None = None) -> DataFrame:
    """Source columns of several text files, with ``source_file`` and ``file_time``.

    Columns of a text scan are matched by position and a directory takes the header of its first file,
    so every header is checked on its own; files with the same header share one scan. ``known`` are headers
    that were read before.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    for path, columns in (known or headers(spark, paths)).items():
        check_columns(columns)
        layouts.setdefault(tuple(columns), []).append(path)
    out = None
    for columns, members in layouts.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        frame = spark.read.option("header", True).schema(schema).csv(members).select(
            *SOURCE_COLUMNS, F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_modification_time").alias("file_time"))
        out = frame if out is None else out.unionByName(frame)
    return out


def scan_file(spark: SparkSession, path: str) -> DataFrame:
    return scan_files(spark, [path]).select(*SOURCE_COLUMNS)


def files_below(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[str]:
    """Paths of the text files in a folder, in name order."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return sorted(str(f.getPath().toString()) for f in found if f.getPath().getName().endswith(suffix))


def write_extract(raw: DataFrame, path: str) -> None:
    raw.write.mode("overwrite").option("header", True).csv(path)


def write_events(events: DataFrame, path: str, mode: str = "append") -> None:
    events.select(*EVENT_COLUMNS).write.mode(mode).parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(path)


def write_by_day(events: DataFrame, path: str, start: str | None = None, end: str | None = None, last_days: int | None = None) -> None:
    """One folder per calendar day with rows. Spark splits the rows of a busy day by size over several tasks and files."""
    (day_range(events, start, end, last_days)
     .hint("rebalance", F.col("event_date"))
     .write.mode("overwrite").partitionBy("event_date").parquet(path))


def day_range(events: DataFrame, start: str | None = None, end: str | None = None, last_days: int | None = None) -> DataFrame:
    """Events between two days, or of the last n days that are present in the table."""
    out = events
    if start:
        out = out.where(F.col("event_date") >= F.lit(start).cast("date"))
    if end:
        out = out.where(F.col("event_date") <= F.lit(end).cast("date"))
    if last_days:
        days = out.select("event_date").distinct().orderBy(F.desc("event_date")).limit(last_days)
        first = days.agg(F.min("event_date"))
        out = out.where(F.col("event_date") >= first.scalar())
    return out


def append_log(records: DataFrame, path: str) -> None:
    records.write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").json(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).json(path)


def write_report(table: DataFrame, path: str, fmt: str = "json") -> None:
    """A report table as JSON lines or CSV with a header; reports are small by construction."""
    writer = table.write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.json(path)
