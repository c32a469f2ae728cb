"""Views that bind the reference's data model onto the driver tables.

* ``articles``     -- documents x events: one bronze-style article per document (whole text)
* ``quotes``       -- per day and event type: last value, previous day's value -> quote rows
* ``series_daily`` -- orders summed per order date: one price series
* ``series_multi`` -- events averaged per day and event type, pivoted to one column per type

Every view reads the given tables, so its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import BINDING_INSTRUMENTS
from tidemark.operators.ordering import carried_lag
from tidemark.sources.tables import read_table, to_utc_timestamp_col

EVENT_TYPES = [e[0] for e in BINDING_INSTRUMENTS]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    return ev.withColumn("ts", to_utc_timestamp_col(F.col("ts")))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id, headline (whole document text), timestamp (event hour), source, asset_type,
    price, change_percent.  Every document stays: its event is number ``10 * doc_id`` modulo the number
    of event ids.  ``change_percent`` = 5 * (value / previous value of the same event type - 1), so both
    sides of the +-2 and +-3 thresholds occur."""
    ev = events(spark, sf_dir)
    ids = ev.agg((F.max("event_id") + 1).alias("_ids"))  # one row
    ev = carried_lag(ev, "value", ["event_type"], "event_id", "prev_value")
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"]).crossJoin(F.broadcast(ids))
    j = docs.join(ev, ev["event_id"] == F.pmod(docs["doc_id"] * 10, docs["_ids"]), "left")
    return j.select(
        F.col("doc_id").alias("row_id"),
        F.col("text").alias("headline"),
        F.date_trunc("hour", F.col("ts")).alias("timestamp"),
        F.col("source"),
        F.col("event_type").alias("asset_type"),
        F.col("value").alias("price"),
        (F.lit(5.0) * (F.try_divide(F.col("value"), F.col("prev_value")) - F.lit(1.0))).alias("change_percent"),
    )


def instruments_binding(spark: SparkSession) -> DataFrame:
    schema = "event_type string, asset string, asset_type string, priority int"
    return spark.createDataFrame(BINDING_INSTRUMENTS, schema)


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quote per (day, event type): price = last value of the day, change against the previous
    day's last value (0 on the first day), rounded to 4 like the reference's quote rows."""
    ev = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    daily = ev.groupBy("day", "event_type").agg(
        F.max_by("value", F.struct("ts", "event_id")).alias("price"))
    # (days x event types) rows: tiny after the aggregation
    prev = F.lag("price").over(Window.partitionBy("event_type").orderBy("day"))
    daily = daily.withColumn("prev_price", prev)
    change = F.coalesce(F.col("price") - F.col("prev_price"), F.lit(0.0))
    change_pct = F.coalesce(F.lit(100.0) * (F.try_divide(F.col("price"), F.col("prev_price")) - F.lit(1.0)),
                            F.lit(0.0))
    dim = F.broadcast(instruments_binding(spark))  # 5 literal rows
    q = daily.join(dim, "event_type").select(
        F.date_format("day", "yyyy-MM-dd").alias("run_id"),
        F.col("asset"), F.col("asset_type"), F.col("priority"),
        F.col("event_type").alias("symbol"),
        F.date_format("day", "yyyy-MM-dd'T'00:00:00").alias("timestamp"),
        F.lit("yahoo_finance").alias("source"),
        F.concat(F.lit("events://"), F.col("event_type")).alias("url"),
        F.col("price"), change.alias("change"), change_pct.alias("change_percent"),
    )
    return q


def series_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """timestamp (date), instrument, price = sum of order totals per order date."""
    o = read_table(spark, sf_dir, "orders", ["o_orderdate", "o_totalprice"])
    return o.groupBy(F.to_date(F.col("o_orderdate")).alias("timestamp")).agg(
        F.sum("o_totalprice").alias("price")).select(
        "timestamp", F.lit("orders").alias("instrument"), "price")


def series_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date + one average-value column per event type (explicit pivot values: no extra job)."""
    ev = events(spark, sf_dir)
    return (ev.groupBy(F.to_date("ts").alias("date"))
            .pivot("event_type", EVENT_TYPES).agg(F.avg("value")))


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form of ``series_multi``: date, instrument, price."""
    ev = events(spark, sf_dir)
    return ev.groupBy(F.to_date("ts").alias("timestamp"), F.col("event_type").alias("instrument")) \
        .agg(F.avg("value").alias("price"))


ARTICLE_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("headline", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("asset_type", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("change_percent", T.DoubleType()),
])
