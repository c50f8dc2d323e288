"""Deterministic artifacts: equal records give equal bytes, whatever their order, and a manifest of digests tells what changed.

An artifact is one JSON text, an envelope around the records in order of their
key. It is written as parts in order of ranges of the key, which read one after
another are that text. A manifest has a digest for each bucket of keys; buckets
depend on the key alone, so two manifests tell changed from unchanged buckets
without either's records.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from daybook.operators import constraints
from daybook.sources.shared import kept

RECORDS_A_PART, BUCKETS = 100_000, 256


def record_text(df: DataFrame) -> Column:
    """A record as one line of JSON with its fields in order of name, nulls among them."""
    return F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})


@pandas_udf(StringType())
def _indented(s: pd.Series) -> pd.Series:
    """JSON in lines indented by two, keys in order, as an item of a list in an object."""
    return s.map(lambda x: "\n".join("    " + line for line in json.dumps(json.loads(x), indent=2, ensure_ascii=False, sort_keys=True).splitlines()))


def write_artifact(records: DataFrame, key: str, path: str, source: str, watermark: str | None = None, records_a_part: int = RECORDS_A_PART) -> int:
    """Write the artifact's parts into ``path`` and give the number of records. A null or repeated key is an error."""
    held = kept(records.select(F.col(key).alias("key"), record_text(records).alias("text")), "records")
    n, n_null, last = held.agg(F.count("*"), F.count_if(F.col("key").isNull()), F.max("key")).first()
    repeated = constraints.unique_key(held, "key").head(1)
    if n_null or repeated:
        raise ValueError(f"{key} is no key: " + (f"{n_null} records have none" if n_null else f"{repeated[0][0]} stands more than once"))
    head, foot = json.dumps({"source": source, "watermark": watermark, "recordCount": n, "records": []}, indent=2, ensure_ascii=False).split("[]")
    rim = held.sparkSession.createDataFrame([(0, head + "["), (2, ("  " if n else "") + "]" + foot)], "place int, value string").select("place", F.lit(None).cast(held.schema["key"].dataType).alias("key"), "value")
    comma = F.when(F.col("key") == F.lit(last), F.lit("")).otherwise(F.lit(","))
    body = held.select(F.lit(1).alias("place"), "key", F.concat(_indented("text"), comma).alias("value"))
    parts = max(1, -(-n // records_a_part))
    ordered = rim.unionByName(body).repartitionByRange(parts, "place", "key").sortWithinPartitions("place", "key")
    ordered.select("value").write.mode("overwrite").text(path)
    return n


def manifest(records: DataFrame, key: str, bucket: Column | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n, digest``: of each bucket of keys the number of records and a digest of their own digests in order of key."""
    at = F.pmod(F.xxhash64(key), F.lit(buckets)) if bucket is None else bucket
    one = records.select(at.alias("bucket"), F.struct(F.col(key).alias("key"), F.sha2(record_text(records), 256).alias("digest")).alias("x"))
    listed = F.transform(F.array_sort(F.collect_list("x")), lambda x: x["digest"])
    return one.groupBy("bucket").agg(F.count("*").alias("n"), F.sha2(F.array_join(listed, ","), 256).alias("digest"))


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """``bucket, change, n_before, n_after`` of two manifests: added, removed, changed or unchanged."""
    a, b = before.select("bucket", F.col("n").alias("n_before"), F.col("digest").alias("was")), after.select("bucket", F.col("n").alias("n_after"), F.col("digest").alias("now"))
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") == F.col("now"), "unchanged").otherwise("changed")
    return a.join(b, "bucket", "full").select("bucket", change.alias("change"), F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after"))
