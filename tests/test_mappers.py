"""Mappers of sources whose rows come from recorded bodies."""

import datetime as dt

from pyspark.sql import functions as F

from daybook.sources import mappers

UTC = lambda *a: dt.datetime(*a)


def test_tribe_prices_venues_and_towns(spark):
    rows = [
        (1, "Vista Star&#8217;s <b>deck</b> &amp; cruise", "<p>" + "x" * 2000 + "</p>", "u", "2026-07-27 18:00:00", "2026-07-27 20:00:00", "America/Chicago", False, '{"venue":"Pier B","city":"Duluth"}', ["1", "22"]),
        (2, "B", None, "u", "2026-07-27 18:00:00", None, "UTC+0", None, "[]", ["0"]), (3, "C", "", "u", "2026-07-27 18:00:00", None, "UTC", None, '{"venue":"Hall","city":"Superior"}', None),
    ]
    df = spark.createDataFrame(rows, "id long, title string, description string, url string, start_date string, end_date string, timezone string, all_day boolean, v string, p array<string>")
    a, b, c = mappers.tribe(df.withColumns({"venue": F.parse_json("v"), "cost_details": F.struct(F.col("p").alias("values")), "categories": F.array(F.struct(F.lit("music").alias("name")))})).orderBy("native_id").collect()
    assert a.title == "Vista Star's deck & cruise" and len(a.description) == 1500 and (a.cost.kind, a.cost.price_min, a.cost.price_max) == ("paid", 1.0, 22.0) and a.in_duluth
    assert a.start_ts == UTC(2026, 7, 27, 23) and a.categories == ["music"] and a.venue_raw == "Pier B"
    assert (b.venue_raw, b.cost.kind, b.start_ts, b.all_day) == ("See listing", "free", UTC(2026, 7, 27, 23), False)
    assert (c.in_duluth, c.city, c.state, c.cost.kind, c.start_ts) == (False, "Superior", "MN", "unknown", UTC(2026, 7, 27, 18))


def test_squarespace_towns_and_dropped_rows(spark):
    at = 1785168000000
    place = "struct<addressTitle string, addressLine1 string, addressLine2 string>"
    rows = [("a", "Show &amp; Tell", at, at + 1, "/e/a", (None, "12 Tower Ave", "Superior, WI, 54880"), None, "<p>Body</p>", ["t"], ["c"]), ("b", None, at, None, "/e/b", (None, None, None), None, None, None, None), ("c", "No start", None, None, "/e/c", (None, None, None), None, None, None, None), ("d", "Bare", at, None, "/e/d", ("", " ", None), "Short", "Long", None, None)]
    df = spark.createDataFrame(rows, f"id string, title string, startDate long, endDate long, fullUrl string, location {place}, excerpt string, body string, tags array<string>, categories array<string>")
    a, d = mappers.squarespace(df, "https://x.example").orderBy("native_id").collect()
    assert (a.title, a.city, a.state, a.in_duluth, a.venue_raw, a.url, a.categories, a.description) == ("Show & Tell", "Superior", "WI", False, "Superior, WI, 54880", "https://x.example/e/a", ["t", "c"], "Body")
    assert (d.city, d.state, d.in_duluth, d.venue_raw, d.description, d.categories) == ("Duluth", "MN", True, "See listing", "Short", [])


def test_eventeny_sessions(spark):
    row = ("1", "Panel", "2026-08-15 10:00:00", "2026-08-15 11:00:00", "0", "Room 2", "<b>About</b>", "Track", "tag", "public", "active", "1")
    change = lambda **x: tuple(x.get(n, v) for n, v in zip(NAMES, row, strict=True))
    NAMES = ["id", "title", "start_calendar", "end_calendar", "hide_end_time", "location", "description", "track_title", "tags", "access_type", "status", "active"]
    rows = [row, change(id="2", hide_end_time="1", location=None), change(id="3", active="0"), change(id="4", status="draft"), change(id="5", access_type="ticketed"), change(id="6", title=" "), change(id="7", start_calendar="")]
    one, two = mappers.eventeny(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in NAMES)), "The Center").orderBy("native_id").collect()
    assert (one.start_ts, one.end_ts, one.venue_raw, one.description, one.categories, one.event_type) == (UTC(2026, 8, 15, 15), UTC(2026, 8, 15, 16), "The Center", "Room: Room 2\nAbout", ["Track", "tag"], "convention")
    assert two.end_ts is None and two.description == "About"


def test_rec1_dates_prices_and_ages(spark):
    def session(i, dates, times=None, age=None, price="10", canceled=False):
        features = [("dates", dates), ("times", times), ("ageGender", age), ("location", "Gym")]
        return (("g", "Yoga", "<p>x</p>"), (str(i), "Yoga", price, [f for f in features if f[1] is not None], canceled))

    rows = [session(1, "1/5/26", "6:00 PM - 7:00 PM", "18 and up"), session(2, "1/5/26 - 2/9/2026", "6:00 PM", "All ages", "0"), session(3, "TBD"), session(4, "1/5/26", canceled=True), session(5, "1/5/26", None, "Adults", "ask")]
    df = spark.createDataFrame(rows, "group struct<id string, name string, descriptionText string>, session struct<id string, text string, price string, features array<struct<name string, value string>>, canceled boolean>")
    one, two, five = mappers.rec1(df).orderBy("native_id").collect()
    assert (one.start_ts, one.end_ts, tuple(one.age), one.cost.kind, one.cost.price_min) == (UTC(2026, 1, 6, 0), UTC(2026, 1, 6, 1), (False, 18, None), "paid", 10.0)
    assert (two.end_ts, tuple(two.age), two.cost.kind) == (UTC(2026, 2, 10, 0), (True, None, None), "free")
    assert (tuple(five.age), five.cost.kind, five.all_day, five.venue_raw) == ((True, None, None), "unknown", True, "Gym")


def test_manual_runs_end_the_day_after(spark):
    names = "id string, title string, date string, start string, end string, endDate string, allDay boolean, room string, venue string, description string, categories array<string>"
    rows = [("a", "Con", "2026-08-15", None, None, "2026-08-16", True, None, None, None, None), ("b", "Panel", "2026-08-15", "10:00", None, None, None, "Hall A", "Other", "About", ["x"])]
    a, b = mappers.manual(spark.createDataFrame(rows, names), "The Center").orderBy("native_id").collect()
    assert (a.all_day, a.start_ts, a.end_ts, a.venue_raw) == (True, UTC(2026, 8, 15, 5), UTC(2026, 8, 17, 5), "The Center")
    assert (b.all_day, b.start_ts, b.end_ts, b.venue_raw, b.description, b.categories) == (False, UTC(2026, 8, 15, 15), None, "Other", "Room: Hall A\nAbout", ["x"])


def test_overture_places_need_an_address(spark):
    rows = [("p1", ("One",), [("1 Main",)], [("meta",), ("fsq",), ("meta",)]), ("p2", ("Two",), [(" ",)], []), ("p3", ("Three",), [], [])]
    df = spark.createDataFrame(rows, "id string, names struct<primary string>, addresses array<struct<freeform string>>, sources array<struct<dataset string>>")
    assert [tuple(r) for r in mappers.overture(df).collect()] == [("p1", "One", "1 Main", ["fsq", "meta"])]
