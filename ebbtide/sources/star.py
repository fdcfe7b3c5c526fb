"""Retail events derived from the star-schema tables (lineitem, orders, customer, nation, part)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbtide.contracts import EVENT_COLUMNS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line with its order, customer, nation and part. Join strategy is left to Spark's size checks."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    buyers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_retailprice")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("returned", F.col("l_returnflag") == "R")
        .withColumn("signed", F.when(F.col("returned"), -F.col("l_quantity")).otherwise(F.col("l_quantity")))
    )


def canonical_events(spark: SparkSession, folder: str) -> DataFrame:
    """Clean events: one row per order line; lines flagged R are returns."""
    order = F.col("l_orderkey").cast("string")
    return _lines(spark, folder).select(
        F.when(F.col("returned"), F.concat(F.lit("C"), order)).otherwise(order).alias("invoice_no"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.col("p_name").alias("description"),
        F.col("signed").alias("quantity"),
        F.col("p_retailprice").alias("unit_price"),
        (F.col("signed") * F.col("p_retailprice")).alias("line_revenue"),
        F.col("o_orderdate").alias("event_ts"),
        F.to_date("o_orderdate").alias("event_date"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("n_name").alias("country"),
        F.col("returned").alias("is_return"),
    ).select(*EVENT_COLUMNS)


def raw_extract(spark: SparkSession, folder: str) -> DataFrame:
    """The same lines as a raw text extract with source column names and the usual defects.

    Defects are tied to keys so that they can be stated in SQL too: missing customers, ids with a
    trailing ``.0``, administrative and missing stock codes, zero and missing prices, missing
    descriptions and countries, lower-case return marks, and re-sent lines.
    """
    order, part, buyer = F.col("l_orderkey"), F.col("l_partkey"), F.col("o_custkey")
    mark = F.when(~F.col("returned"), F.lit("")).when(order % 2 == 0, F.lit("c")).otherwise(F.lit("C"))
    code = (
        F.when(part % 100 == 0, F.lit("POST")).when(part % 50 == 0, F.lit("post"))
        .when(part % 53 == 0, F.lit(None).cast("string")).otherwise(part.cast("string"))
    )
    price = F.when(part % 97 == 0, F.lit(0.0)).when(part % 89 == 0, F.lit(None).cast("double")).otherwise(F.col("p_retailprice"))
    ident = F.when(order % 7 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(buyer.cast("string"), F.when(order % 3 == 0, F.lit(".0")).otherwise(F.lit(""))))
    once = _lines(spark, folder).select(
        F.concat(mark, order.cast("string")).alias("InvoiceNo"),
        code.alias("StockCode"),
        F.when(part % 31 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("Description"),
        F.col("signed").cast("string").alias("Quantity"),
        F.date_format("o_orderdate", "M/d/yyyy H:mm").alias("InvoiceDate"),
        price.cast("string").alias("UnitPrice"),
        ident.alias("CustomerID"),
        F.when(buyer % 29 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("Country"),
        (order % 11 == 0).alias("resent"),
    )
    copies = F.when(F.col("resent"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return once.withColumn("copy", F.explode(copies)).drop("resent", "copy")
