"""From a source's rows to canonical event columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import text as T
from daybook.functions import timex as X

COLUMNS = ["native_id", "title", "description", "start_ts", "end_ts", "all_day", "venue_raw", "city", "state", "cost", "categories", "event_type", "url", "status", "verified", "rrule", "age", "in_duluth"]
AGE = "struct<all_ages boolean, min_age int, max_age int>"


def canonical(df: DataFrame, **given) -> DataFrame:
    none = F.lit(None).cast("string")
    base = {
        "native_id": none, "title": none, "description": none, "start_ts": F.lit(None).cast("timestamp"), "end_ts": F.lit(None).cast("timestamp"), "all_day": F.lit(False), "venue_raw": none,
        "city": F.lit("Duluth"), "state": F.lit("MN"), "cost": F.struct(F.lit("unknown").alias("kind"), F.lit(None).cast("double").alias("price_min"), F.lit(None).cast("double").alias("price_max")),
        "categories": F.array().cast("array<string>"), "event_type": F.lit("other"), "url": none, "status": F.lit("confirmed"), "verified": F.lit(False), "rrule": none, "age": F.lit(None).cast(AGE), "in_duluth": F.lit(None).cast("boolean"),
    } | given
    return df.select(*[base[c].alias(c) for c in COLUMNS])


def _wall(text, zone=X.ZONE):
    return X.wall_to_instant(F.try_to_timestamp(text), zone)


def legistar(df: DataFrame) -> DataFrame:
    rows = df.filter(F.col("EventDate").isNotNull() & F.col("EventBodyName").isNotNull())
    day, minutes = F.to_date(F.substring("EventDate", 1, 10)), X.clock_minutes(F.col("EventTime"))
    wall = F.timestamp_add("MINUTE", F.coalesce(minutes, F.lit(0)), day.cast("timestamp"))
    return canonical(
        rows, native_id=F.col("EventId").cast("string"), title=F.concat("EventBodyName", F.lit(" — Public Meeting")), description=F.col("EventComment"), start_ts=X.wall_to_instant(wall), all_day=minutes.isNull(),
        venue_raw=F.coalesce(T.text_or_null(F.col("EventLocation")), F.lit("See agenda")), categories=F.array(F.lit("public-meeting"), F.lit("government")), event_type=F.lit("meeting"), url=F.coalesce("EventInSiteURL", "EventAgendaFile"), verified=F.lit(True),
    )


def tribe(df: DataFrame) -> DataFrame:
    """``venue`` is VARIANT: an object, or a list for none. Descriptions are stripped, then cut to 1,500 characters."""
    part = lambda k: F.try_variant_get("venue", f"$.{k}", "string")
    city = T.text_or_null(part("city"))
    zone = X.safe_timezone(F.col("timezone")) if "timezone" in df.columns else X.ZONE
    return canonical(
        df, native_id=F.col("id").cast("string"), title=T.strip_html(F.col("title")), description=F.substring(T.strip_html(F.col("description")), 1, 1500), start_ts=_wall(F.col("start_date"), zone), end_ts=_wall(F.col("end_date"), zone),
        all_day=F.coalesce("all_day", F.lit(False)), venue_raw=F.coalesce(T.strip_html(part("venue")), F.lit("See listing")), city=F.coalesce(city, F.lit("Duluth")), cost=X.cost_of_values(F.col("cost_details.values")),
        categories=F.transform("categories", lambda c: c["name"]), url=F.col("url"), in_duluth=~F.coalesce(city, F.lit("")).rlike(T.word("superior")),
    )


def squarespace(df: DataFrame, origin: str) -> DataFrame:
    rows = df.filter(F.col("title").isNotNull() & F.col("startDate").isNotNull())
    place = F.col("location")
    superior = F.coalesce(F.concat_ws(" ", place["addressLine1"], place["addressLine2"]), F.lit("")).rlike(T.word("superior"))
    return canonical(
        rows, native_id=F.col("id"), title=T.clean_text(F.col("title")), description=T.strip_html(F.coalesce("excerpt", "body")), start_ts=F.timestamp_millis("startDate"), end_ts=F.timestamp_millis("endDate"),
        venue_raw=F.coalesce(*[T.text_or_null(place[k]) for k in ("addressTitle", "addressLine2", "addressLine1")], F.lit("See listing")), city=F.when(superior, "Superior").otherwise("Duluth"), state=F.when(superior, "WI").otherwise("MN"),
        in_duluth=~superior, url=F.concat(F.lit(origin), "fullUrl"), categories=F.concat(F.coalesce("tags", F.array().cast("array<string>")), F.coalesce("categories", F.array().cast("array<string>"))),
    )


def eventeny(df: DataFrame, venue: str) -> DataFrame:
    rows = df.filter((F.coalesce("active", F.lit("1")) != "0") & (F.coalesce("status", F.lit("active")) == "active") & (F.coalesce("access_type", F.lit("public")) == "public") & T.text_or_null(F.col("title")).isNotNull() & T.text_or_null(F.col("start_calendar")).isNotNull())
    room = T.text_or_null(F.col("location"))
    return canonical(
        rows, native_id=F.col("id"), title=T.clean_text(F.col("title")), description=F.concat_ws("\n", F.concat(F.lit("Room: "), room), T.strip_html(F.col("description"))), start_ts=_wall(F.col("start_calendar")),
        end_ts=F.when(F.coalesce("hide_end_time", F.lit("0")) != "1", _wall(F.col("end_calendar"))), venue_raw=F.lit(venue), categories=F.array_compact(F.array(T.text_or_null(F.col("track_title")), T.text_or_null(F.col("tags")))), event_type=F.lit("convention"),
    )


def json_ld(df: DataFrame) -> DataFrame:
    """``event`` is VARIANT. A date alone is local midnight, all day; other starts keep their offset."""
    get = lambda k: F.try_variant_get("event", f"$.{k}", "string")
    start, end = get("startDate"), get("endDate")
    dated = start.rlike(r"^\d{4}-\d{2}-\d{2}$")
    offers = F.coalesce(F.try_variant_get("event", "$.offers", "array<variant>"), F.array_compact(F.array(F.try_variant_get("event", "$.offers", "variant"))))
    prices = F.flatten(F.transform(offers, lambda o: F.array_compact(F.array(*[F.try_variant_get(o, f"$.{k}", "string") for k in ("price", "lowPrice", "highPrice")]))))
    rows = df.filter(get("name").isNotNull() & start.isNotNull())
    return canonical(
        rows, title=T.decode_and_strip(get("name")), description=T.decode_and_strip(get("description")), start_ts=F.when(dated, _wall(start)).otherwise(F.try_to_timestamp(start)), end_ts=F.when(F.contains(end, F.lit("T")), F.try_to_timestamp(end)),
        all_day=dated, venue_raw=F.coalesce(T.text_or_null(get("location.name")), F.lit("See listing")), city=F.coalesce(T.text_or_null(get("location.address.addressLocality")), F.lit("Duluth")), state=F.coalesce(T.text_or_null(get("location.address.addressRegion")), F.lit("MN")),
        cost=X.cost_of_values(prices), url=get("url"), status=F.when(get("eventStatus").rlike("Cancelled|Postponed"), "tentative").otherwise("confirmed"),
    )


def ics(df: DataFrame) -> DataFrame:
    """``props`` of :func:`daybook.sources.readers.ics_properties`."""
    prop = lambda k: F.try_element_at("props", F.lit(k))
    start = prop("DTSTART")
    dated = start.rlike(r"^\d{8}$")
    zone = lambda k: X.safe_timezone(prop(f"{k};TZID"))
    wall = lambda k: X.wall_to_instant(F.try_to_timestamp(prop(k), F.lit("yyyyMMdd'T'HHmmss")), zone(k))
    at = lambda k: F.when(prop(k).rlike("Z$|^[0-9]{8}$"), X.instant_of(prop(k))).otherwise(wall(k))
    rule = F.trim(F.split(prop("RRULE"), "\n")[0])
    venue = F.coalesce(T.text_or_null(T.unescape_ics(prop("LOCATION"))), F.lit("Not specified"))
    lead = T.leading_city(venue)
    status = F.upper(prop("STATUS"))
    return canonical(
        df.filter(start.isNotNull() & prop("SUMMARY").isNotNull()), native_id=prop("UID"), title=T.clean_text(T.unescape_ics(prop("SUMMARY"))), description=T.unescape_ics(prop("DESCRIPTION")), start_ts=at("DTSTART"), end_ts=at("DTEND"), all_day=dated,
        venue_raw=venue, city=F.coalesce(lead["city"], F.lit("Duluth")), state=F.coalesce(lead["state"], F.lit("MN")), categories=F.filter(F.split(F.coalesce(prop("CATEGORIES"), F.lit("")), ","), lambda c: c != ""), url=F.when(prop("URL").rlike("^https?://"), prop("URL")),
        status=F.when(status == "CANCELLED", "cancelled").when(status == "TENTATIVE", "tentative").otherwise("confirmed"), rrule=F.when(F.contains(rule, F.lit("FREQ=")), rule),
    )


def stated_age(said: Column) -> Column:
    """Of a source's own words: everyone, or from the first number on; everyone too where no number is said."""
    least = F.nullif(F.regexp_extract(said, "([0-9]+)", 1), F.lit("")).try_cast("int")
    everyone = said.rlike(T.word("all") + "|(?i)any age") | least.isNull()
    return F.when(T.text_or_null(said).isNotNull(), F.struct(everyone.alias("all_ages"), F.when(~everyone, least).alias("min_age"), F.lit(None).cast("int").alias("max_age")))


def rec1(df: DataFrame) -> DataFrame:
    """``group struct<id,name,descriptionText>, session struct<id,text,price,features array<struct<name,value>>,canceled>``: dates ``m/d/yy[yy]``, first and last are the span."""
    s = F.col("session")
    feature = lambda k: F.get(F.transform(F.filter(s["features"], lambda f: f["name"] == k), lambda f: f["value"]), 0)
    dates = F.regexp_extract_all(F.coalesce(feature("dates"), F.lit("")), F.lit(r"(\d{1,2}/\d{1,2}/(?:\d{4}|\d{2}))"), F.lit(1))
    day = lambda c: F.coalesce(F.try_to_timestamp(c, F.lit("M/d/yyyy")), F.try_to_timestamp(c, F.lit("M/d/yy")))
    first, last = day(F.get(dates, 0)), day(F.try_element_at(dates, F.lit(-1)))
    times = F.split(F.coalesce(feature("times"), F.lit("")), r"\s*[-–]\s*")
    from_, to = X.clock_minutes(F.get(times, 0)), X.clock_minutes(F.get(times, 1))
    start = F.timestamp_add("MINUTE", F.coalesce(from_, F.lit(0)), first)
    many = last > first
    end = F.when(to.isNotNull(), F.timestamp_add("MINUTE", to, last)).when(many, F.timestamp_add("MINUTE", F.coalesce(from_, F.lit(23 * 60 + 59)), last))
    price = s["price"].cast("string").try_cast("double")
    kind = F.when(price == 0, "free").when(price > 0, "paid").otherwise("unknown")
    return canonical(
        df.filter(~F.coalesce(s["canceled"], F.lit(False)) & first.isNotNull()), native_id=s["id"].cast("string"), title=T.clean_text(F.concat_ws(" — ", F.col("group.name"), F.nullif(s["text"], F.col("group.name")))), description=F.substring(T.strip_html(F.col("group.descriptionText")), 1, 800),
        start_ts=X.wall_to_instant(start), end_ts=X.wall_to_instant(end), all_day=from_.isNull(), venue_raw=F.coalesce(T.text_or_null(feature("location")), F.lit("See catalog")),
        cost=F.struct(kind.alias("kind"), F.when(kind == "paid", price).alias("price_min"), F.lit(None).cast("double").alias("price_max")), event_type=F.lit("class"), age=stated_age(feature("ageGender")),
    )


def manual(df: DataFrame, venue: str) -> DataFrame:
    wall = lambda d, t: X.wall_to_instant(F.try_to_timestamp(F.concat(d, F.lit(" "), t)))  # noqa: E731  none without a time
    all_day = F.coalesce("allDay", F.lit(False))
    return canonical(
        df, native_id=F.col("id"), title=F.col("title"), description=F.concat_ws("\n", F.concat(F.lit("Room: "), "room"), "description"), start_ts=wall(F.col("date"), F.when(all_day, F.lit("00:00")).otherwise(F.col("start"))),
        end_ts=F.when(all_day, X.wall_to_instant(F.date_add(F.to_date(F.coalesce("endDate", "date")), 1).cast("timestamp"))).otherwise(wall(F.coalesce("endDate", "date"), F.col("end"))), all_day=all_day,
        venue_raw=F.coalesce("venue", F.lit(venue)), categories=F.coalesce("categories", F.array().cast("array<string>")), event_type=F.lit("convention"),
    )


def sorted_keys(m: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(m)))


def neighborhood(df: DataFrame) -> DataFrame:
    """``attributes map<string,string>`` of a district as named columns, and all of them in ``raw`` by key."""
    at = lambda k, t="string": F.try_element_at("attributes", F.lit(k)).cast(t)
    return df.select(
        F.lower(F.regexp_replace(at("GlobalID"), "[{}]", "")).alias("id"), at("GlobalID").alias("global_id"), at("OBJECTID", "long").alias("object_id"), at("ID").alias("admin_id"), at("NAME").alias("name"),
        at("Shape__Area", "double").alias("shape_area"), at("Shape__Length", "double").alias("shape_length"), X.iso_of_millis(at("last_edited_date", "long")).alias("last_edited"), sorted_keys(F.col("attributes")).alias("raw"),
    )


def trail_condition(df: DataFrame) -> DataFrame:
    """A trail's condition record: blank street and url are null, socials by key, instants as text; other columns stay."""
    blank_null = {c: F.nullif(F.trim(F.col(c)), F.lit("")) for c in ("street", "url")}
    socials = sorted_keys(F.coalesce("socials", F.create_map().cast("map<string,string>")))
    return df.withColumns(blank_null | {"socials": socials, "weather_policy": F.col("weatherPolicy") if "weatherPolicy" in df.columns else F.lit(None).cast("string")}).drop("weatherPolicy")


# Activities of the trail record, in its order.
USES = ["hiking", "biking", "skiing", "snowshoeing", "horseback", "motorized", "accessible", "dogs"]


def trail_uses(df: DataFrame, columns: list[str]) -> DataFrame:
    """Yes/no columns as one array of structs, and the season as the seasons it stands for."""
    uses = F.array(*[F.struct(F.lit(name).alias("use"), F.coalesce(F.col(c).isin("Y", "Yes"), F.lit(False)).alias("allowed")) for name, c in zip(USES, columns, strict=False)])
    season = F.when(F.lower("season") == "both", F.array(F.lit("summer"), F.lit("winter"))).when(F.col("season").isin("None", ""), F.lit(None)).otherwise(F.array(F.lower("season")))
    return df.withColumns({"uses": uses, "seasons": season})


def overture(df: DataFrame) -> DataFrame:
    """Distinct sorted datasets; places without an address are dropped."""
    address = F.get("addresses", 0)["freeform"]
    return df.filter(F.coalesce(F.trim(address), F.lit("")) != "").select("id", F.col("names.primary").alias("name"), address.alias("address"), F.array_sort(F.array_distinct(F.transform("sources", lambda s: s["dataset"]))).alias("datasets"))


def osm(df: DataFrame) -> DataFrame:
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    return df.filter(tag("name").isNotNull()).select(F.concat_ws("/", "type", "id").alias("ref"), tag("name").alias("name"), F.coalesce("lat", "center.lat").alias("lat"), F.coalesce("lon", "center.lon").alias("lon"), F.nullif(F.concat_ws(" ", tag("addr:housenumber"), tag("addr:street")), F.lit("")).alias("address"))
