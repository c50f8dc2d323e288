"""Listings: the driver tables seen as event listings, the same view in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles are what ``part`` says of a thing, dealt by place and hour over the whole table, so that events of one place and hour are alike; places are nations, dealt by ``user_id``."""
    e = table(spark, sf_dir, "events")
    part = table(spark, sf_dir, "part")
    titles = part.select(F.col("p_partkey").alias("t_id"), F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("title"))
    parts = part.agg((F.max("p_partkey") + 1).alias("parts"))
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    u, hour = F.col("user_id"), F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 3600)
    rows = e.crossJoin(F.broadcast(parts)).select(  # one row
        F.col("event_id").alias("ord"), F.concat(F.lit("src"), (u % 7).cast("string")).alias("source"), F.when(u % 3 == 0, "high").when(u % 3 == 1, "medium").otherwise("low").alias("confidence"),
        F.col("ts").alias("start_ts"), F.date_trunc("hour", "ts").alias("instant"), F.date_format("ts", "yyyy-MM-dd").alias("day"), F.timestamp_add("HOUR", (F.col("event_id") % 30).cast("int"), F.col("ts")).alias("end_ts"),
        (u % 25).cast("int").alias("place_key"), "event_type", "value", F.pmod(hour * 25 + u % 25 + (F.col("event_id") % 4 == 0).cast("int"), F.col("parts")).alias("t_id"),
    )
    named = rows.join(titles, "t_id", "left").join(F.broadcast(nation), F.col("place_key") == F.col("n_nationkey"), "left")
    return named.select("ord", "source", "confidence", "start_ts", "instant", "day", "end_ts", F.when(F.col("place_key") != 0, F.concat(F.lit("p"), F.col("place_key").cast("string"))).alias("place_id"), F.col("n_name").alias("venue"), F.col("r_name").alias("region"), "event_type", F.col("value").alias("price"), "title", F.lit(None).cast("string").alias("room"), F.array().cast("array<string>").alias("also"))


SQL = """WITH listings AS (
  SELECT e.event_id AS ord, 'src' || (e.user_id % 7) AS source, CASE e.user_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS confidence,
    e.ts AS start_ts, date_trunc('hour', e.ts) AS instant, strftime(e.ts, '%Y-%m-%d') AS day, e.ts + to_hours(CAST(e.event_id % 30 AS INTEGER)) AS end_ts,
    CASE WHEN e.user_id % 25 <> 0 THEN 'p' || (e.user_id % 25) END AS place_id, n.n_name AS venue, r.r_name AS region, e.event_type, e.value AS price, concat_ws(' ', p.p_name, p.p_type, p.p_brand) AS title
  FROM events e LEFT JOIN part p ON p.p_partkey = (epoch(date_trunc('hour', e.ts))::BIGINT // 3600 * 25 + e.user_id % 25 + (e.event_id % 4 = 0)::INTEGER) % (SELECT max(p_partkey) + 1 FROM part)
  LEFT JOIN nation n ON n.n_nationkey = e.user_id % 25 LEFT JOIN region r ON r.r_regionkey = n.n_regionkey)
"""
