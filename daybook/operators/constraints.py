"""Row constraints of canonical events: validity as columns, and the split into valid and refused rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What confidence each way of extraction may claim.
CEILING = {"ics-import": ["high"], "structured-api": ["high", "medium"], "jsonld": ["medium"], "manual": ["high", "medium"], "html-scrape": ["medium", "low"], "pdf-parse": ["medium", "low"], "pdf-llm-extract": ["low"]}


def end_after_start(start: Column, end: Column) -> Column:
    return end.isNull() | (end >= start)


def price_order(low: Column, high: Column) -> Column:
    return (F.coalesce(low, F.lit(0)) >= 0) & (high.isNull() | ((high >= 0) & (low.isNull() | (high >= low))))


def confidence_allowed(method: Column, confidence: Column) -> Column:
    return reduce(lambda acc, kv: acc | ((method == kv[0]) & confidence.isin(kv[1])), CEILING.items(), F.lit(False))


def coordinates(lat: Column, lon: Column) -> Column:
    return lat.between(-90, 90) & lon.between(-180, 180)


def place_id(c: Column) -> Column:
    return c.rlike("^[a-z0-9]+(?:-[a-z0-9]+)*$")


def split_valid(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and refused rows with the names of the checks they fail."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), name) for name, c in checks.items()]))
    marked = df.withColumn("failed", failed)
    return marked.filter(F.size("failed") == 0).drop("failed"), marked.filter(F.size("failed") > 0)


def unique_key(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def require(df: DataFrame, bad: DataFrame, message: str) -> DataFrame:
    """``df``, or an error at run time if ``bad`` has a row."""
    found = bad.limit(1).agg(F.count("*").alias("n_bad"))
    checked = df.join(F.broadcast(found), F.lit(True), "left").withColumn("ok", F.assert_true(F.col("n_bad") == 0, F.lit(message)))
    return checked.filter("ok IS NULL").select(df.columns)


def record_count_matches(envelope: DataFrame) -> DataFrame:
    """Envelopes ``recordCount, records`` whose count is wrong."""
    return envelope.filter(F.col("recordCount") != F.size("records"))
