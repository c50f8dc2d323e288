"""Place resolution: exact joins on normalised aliases, then enrichment of gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import text as T


def alias_table(registry: DataFrame) -> DataFrame:
    """``kind, key, place_id`` for rows ``id, name, name_aliases, address_aliases``."""
    names = registry.select("id", F.explode(F.concat(F.array("name"), F.coalesce("name_aliases", F.array().cast("array<string>")))).alias("raw"), F.lit("name").alias("kind"))
    addresses = registry.select("id", F.explode(F.coalesce("address_aliases", F.array().cast("array<string>"))).alias("raw"), F.lit("address").alias("kind"))
    keyed = names.union(addresses).select("kind", T.venue_key(F.col("raw"), everything=True).alias("key"), F.col("id").alias("place_id"))
    return keyed.distinct()


def alias_conflicts(aliases: DataFrame) -> DataFrame:
    """Keys claimed by two places, and keys that name no venue."""
    claimed = aliases.groupBy("kind", "key").agg(F.countDistinct("place_id").alias("n_places"))
    return claimed.filter((F.col("n_places") > 1) | T.is_sentinel(F.col("key")))


def resolve(events: DataFrame, aliases: DataFrame, venue: str = "venue_raw", city: str = "city") -> DataFrame:
    """``events`` with ``place_id`` and ``outcome``: sentinel, registered, city-only or provisional.

    Name aliases come before address aliases, both by the venue's name without a
    leading city; then both again by the whole string. The alias table is small
    (a registry); the session's broadcast threshold decides how it is joined.
    """
    # one step at a time, so that no expression holds another many times over
    keyed = events.withColumn("clean_", T.clean_text(F.col(venue)))
    keyed = keyed.withColumns({"lead_": T.leading_city(F.col("clean_"), is_clean=True)["city"], "parsed_": T.venue_name(F.col("clean_"), is_clean=True)})
    keyed = keyed.withColumns({"key_name": T.venue_key(F.col("parsed_"), everything=True), "key_whole": T.venue_key(F.col(venue), everything=True), "key_city": T.venue_key(F.col(city), everything=True)})
    for kind in ("name", "address"):
        for part in ("name", "whole"):
            side = aliases.filter(F.col("kind") == kind).groupBy(F.col("key").alias(f"key_{part}")).agg(F.min("place_id").alias(f"{kind}_{part}"))
            keyed = keyed.join(side, f"key_{part}", "left")
    city_only = F.coalesce(F.col("parsed_") == F.col("lead_"), F.lit(False)) | F.coalesce(F.col("key_whole") == F.col("key_city"), F.lit(False))
    found = F.coalesce("name_name", "address_name", "name_whole", "address_whole")
    outcome = F.when(T.is_sentinel(F.col("key_whole")), "sentinel").when(found.isNotNull(), "registered").when(city_only, "city-only").otherwise("provisional")
    place = F.when(outcome == "registered", found).when(outcome == "provisional", T.provisional_id(F.col("key_name")))
    return keyed.select(*events.columns, place.alias("place_id"), outcome.alias("outcome"))


def enrich(events: DataFrame, registry: DataFrame, fields: list[str]) -> DataFrame:
    """Fill gaps of ``fields`` from the registered place of an event."""
    side = registry.select(F.col("id").alias("place_id"), *[F.col(f).alias(f"place_{f}") for f in fields])
    joined = events.join(side, "place_id", "left")
    filled = {f: F.coalesce(F.col(f), F.col(f"place_{f}")) for f in fields}
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in events.columns])


def credits(places: DataFrame, registered: DataFrame) -> DataFrame:
    """Distinct dataset credits of places ``ref, provenance``, an error if one has none registered."""
    ref = F.col("ref")
    key: Column = F.when(~ref.rlike("^https?://") & ref.contains(":"), F.substring_index(ref, ":", 1)).when(F.col("provenance") == "osm", F.lit("osm"))
    used = places.select(key.alias("dataset")).filter("dataset IS NOT NULL").distinct()
    joined = used.join(registered, "dataset", "left")
    checked = joined.withColumn("credit", F.when(F.col("credit").isNull(), F.raise_error(F.concat(F.lit("no credit for "), F.col("dataset")))).otherwise(F.col("credit")))
    return checked.orderBy("dataset")
