"""From a mapped event to a fully tagged one: place, address, type, span, facets, age, ticket link and status.

Input: the canonical columns of ``daybook.sources.mappers``; ``street, zip, geo, age, ticket_url``
and ``zone`` are taken where a source has them. The registry (``id, name, name_aliases,
address_aliases`` and, if it has them, ``street, zip, geo``) is a small dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import rules as R
from daybook.functions import text as T
from daybook.functions import timex as X
from daybook.operators import places
from daybook.sources.mappers import AGE

OPTIONAL = {"street": "string", "zip": "string", "geo": "struct<lat double, lon double>", "age": AGE, "ticket_url": "string", "zone": "string", "rrule": "string", "in_duluth": "boolean"}


def with_optional(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """``df`` with those of the wanted columns that it lacks, as nulls."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c not in df.columns})


def located(events: DataFrame, registry: DataFrame) -> DataFrame:
    """City and state by the venue's text where it states them, the place by the registry, gaps of the address from it."""
    lead = T.leading_city(F.col("venue_clean"), is_clean=True)
    read = events.withColumn("venue_clean", T.clean_text(F.coalesce("venue_raw", F.lit("")))).withColumn("lead", lead)
    read = read.withColumns({
        "in_duluth": F.when(F.col("lead").isNotNull(), F.lower("lead.city") == "duluth").otherwise(F.coalesce("in_duluth", F.lower("city") == "duluth", F.lit(False))),
        "state": F.coalesce("lead.state", "state"), "city": F.coalesce("lead.city", "city"), "venue_name": T.venue_name(F.col("venue_clean"), is_clean=True),
    })
    found = places.resolve(read, places.alias_table(registry))
    given = [c for c in ("street", "zip", "geo") if c in registry.columns]
    filled = places.enrich(found, registry, given) if given else found
    names = registry.select(F.col("id").alias("place_id"), F.col("name").alias("registered_name"))
    named = filled.join(names, "place_id", "left")
    return named.withColumn("place_name", F.coalesce("registered_name", F.when(F.col("outcome") == "provisional", F.col("venue_name")))).drop("lead", "venue_clean", "registered_name")


def heard(events: DataFrame) -> DataFrame:
    """The whole text and the phrases said in it, in title and categories, and in the title: each text is cleaned and searched once.

    Without a description title and categories are the whole text; without categories too the title is, if cleaning
    changes no more than white space that phrases take for a space.
    """
    title, categories = F.col("title"), F.col("categories")
    read = events.withColumn("hay_", T.haystack(title, F.col("description"), categories)).withColumn("said_", R.said_in(F.col("hay_")))
    short = F.col("description").isNull()
    as_it_stands = short & (F.size(categories) == 0) & ~title.rlike(T.CHANGED_BY_CLEANING)
    return read.withColumns({
        "type_said_": F.when(short, F.col("said_")).otherwise(R.said_in(T.clean_text(F.concat_ws(" ", title, F.array_join(categories, " "))))),
        "title_said_": F.when(as_it_stands, F.col("said_")).otherwise(R.said_in(title)),
    })


def facets(events: DataFrame) -> DataFrame:
    """Every facet, from what the event says and where and when it is; needs ``located``, ``heard`` and an event type."""
    hay, cats, venue, title = (F.col(c) for c in ("hay_", "cats_", "venue_", "title"))
    read = events.withColumns({
        "cats_": T.normal_categories(F.col("categories")),
        "venue_": T.clean_text(F.concat_ws(", ", *[F.nullif(F.col(c), F.lit("")) for c in ("place_name", "venue_raw", "city")])),
    })
    read = read.withColumns({"venue_said_": R.said_in(venue), "band_": R.age_band(hay)})
    said, there, titled = (F.col(c) for c in ("said_", "venue_said_", "title_said_"))
    read = read.withColumn("setting", R.setting(hay, venue, said, there))
    zone = X.safe_timezone(F.col("zone"))
    return read.withColumns({
        "audience": R.audience(hay, cats, F.col("band_"), said), "cost_tier": R.cost_tier(hay, F.coalesce("cost.kind", F.lit("unknown")), said), "registration": R.registration(hay, said),
        "geo_scope": R.geo_scope(F.col("city"), F.col("state"), F.col("setting")), "access": R.access(hay, said), "time_of_day": X.time_of_day(F.col("start_ts"), F.col("all_day"), zone),
        "weekend": X.is_weekend(F.col("start_ts"), zone), "recurring": F.coalesce("rrule", F.lit("")) != "", "alcohol": R.alcohol(hay, venue, said, there), "public_admission": R.admission(hay, cats, said),
        "home_away": R.home_away(title, F.col("event_type") == "sports", titled), "institutional_notice": R.notice(title, cats, titled), "rescheduled": R.rescheduled(title, titled),
    })


def stated_age() -> Column:
    """The source's own age, else the band in the text, else all ages where the audience says so."""
    of_band = F.struct(F.lit(False).alias("all_ages"), F.col("band_.min_age").alias("min_age"), F.col("band_.max_age").alias("max_age"))
    everyone = F.struct(F.lit(True).alias("all_ages"), F.lit(None).cast("int").alias("min_age"), F.lit(None).cast("int").alias("max_age"))
    read = F.col("band_.min_age").isNotNull() | F.col("band_.max_age").isNotNull()
    return F.coalesce(F.col("age"), F.when(read, of_band).when(F.array_contains("audience", "all-ages"), everyone))


def finalize(events: DataFrame, registry: DataFrame) -> DataFrame:
    """Fully tagged events. A type other than ``other`` stays; a moved event that is said to be confirmed becomes tentative.

    Null titles, texts and categories count as empty; an event without a start has no time of day and no weekend.
    """
    plain = with_optional(events, OPTIONAL).withColumns({"title": F.coalesce("title", F.lit("")), "categories": F.coalesce("categories", F.array().cast("array<string>"))})
    placed = located(plain, registry)
    by_rule = R.event_type(F.col("title"), F.col("categories"), F.coalesce("place_name", "venue_raw", F.lit("")), said=F.col("type_said_"))
    typed = heard(placed).withColumn("event_type", F.when(F.col("event_type") != "other", F.col("event_type")).otherwise(by_rule))
    day = lambda c: F.date_format(X.local(F.col(c), X.safe_timezone(F.col("zone"))), "yyyy-MM-dd")
    tagged = facets(typed.withColumn("multi_day", X.is_multi_day(day("start_ts"), day("end_ts"))))
    said = tagged.withColumns({
        "age": stated_age(), "ticket_url": F.coalesce(F.col("ticket_url"), T.ticket_url(F.coalesce("description", F.lit("")))),
        "status": F.when((F.col("status") == "confirmed") & F.col("rescheduled"), "tentative").otherwise(F.col("status")),
    })
    return said.drop("hay_", "cats_", "venue_", "band_", "said_", "venue_said_", "title_said_", "type_said_")
