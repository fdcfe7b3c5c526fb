"""Folders and skew helpers that several operators use."""

from __future__ import annotations

from io import BytesIO
from pathlib import Path
from uuid import uuid4
from zipfile import ZipFile

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

import ebbtide
from ebbtide.session import shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared one."""
    return f"{shared_folder(spark)}/ebbtide-llm/{spark.sparkContext.applicationId}/{name}-{uuid4().hex[:12]}"


def store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path inside it, for a URI or an absolute path."""
    return fs.FileSystem.from_uri(path if ":" in path.split("/")[0] else f"file://{path}")


def put(spark: SparkSession, name: str, files: dict[str, bytes]) -> list[str]:
    """Write small files to a fresh shared folder; returns their URIs, for executors to fetch."""
    folder = new_folder(spark, name)
    system, path = store(folder)
    system.create_dir(path, recursive=True)
    for file, content in files.items():
        with system.open_output_stream(f"{path}/{file}", compression=None) as out:
            out.write(content)
    return [f"{folder}/{file}" for file in files]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once an application, for those that do not have it installed."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        top, packed = Path(ebbtide.__file__).parent, BytesIO()
        with ZipFile(packed, "w") as out:
            for file in sorted(top.rglob("*.py")):
                out.write(file, file.relative_to(top.parent).as_posix())
        context.addPyFile(put(spark, "code", {f"ebbtide-{uuid4().hex[:8]}.zip": packed.getvalue()})[0])
        _shipped.add(context.applicationId)


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: cuts the lineage, survives lost executors."""
    path = new_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``written``, compressed harder, with the shuffle files of the job freed as soon as the table is there."""
    spark, path = frame.sparkSession, new_folder(frame.sparkSession, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        frame.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


def drop(table: DataFrame) -> None:
    """Delete the files of a table that ``stored`` made, when all that was read from it is stored in turn."""
    files = table.inputFiles()
    if files:
        system, path = store(files[0].rsplit("/", 1)[0])
        system.delete_dir(path)


#: A key is hot when it holds more than one of so many rows; at most that many keys can be.
HOT_ONE_OF = 2000


def hot_keys(counts: DataFrame, key: str, n: str, one_of: int = HOT_ONE_OF) -> DataFrame:
    """Rows of ``counts`` (one per key) whose share of all rows makes them hot: at most ``one_of`` rows, so a safe broadcast."""
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0)).alias("t")).select("t").scalar()
    return counts.where(F.col(n) * one_of > total)


def attach(rows: DataFrame, table: DataFrame, key: str, n: str, spread: list[str]) -> DataFrame:
    """Left-join ``table`` (one row per key, ``n`` rows of the other side behind it) to ``rows`` without hot tasks.

    Hot keys are answered by a bounded broadcast; their rows get a join key of their own that matches nothing
    and spreads by the columns ``spread``. All other rows meet their key in a plain shuffle join.
    """
    kind = dict(rows.dtypes)[key]
    values = [c for c in table.columns if c not in (key, n)]
    hot = hot_keys(table, key, n).select(F.col(key).alias("__hot"), F.struct(*values).alias("__hot_values"))
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left").withColumns({
        "__is_hot": F.col("__hot").isNotNull(),
        "__key": F.when(F.col("__hot").isNull(), F.col(key)).otherwise(F.xxhash64(*spread).cast(kind)),
    })
    plain = table.select(F.col(key).alias("__plain"), F.lit(False).alias("__never_hot"), F.struct(*values).alias("__values"))
    joined = marked.join(plain, (F.col("__key") == F.col("__plain")) & (F.col("__is_hot") == F.col("__never_hot")), "left")
    found = F.coalesce("__hot_values", "__values")
    return joined.select(*rows.columns, *[found[c].alias(c) for c in values])
