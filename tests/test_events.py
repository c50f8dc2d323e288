"""Rules, dedupe, filters and output on small fixtures, and the registered queries' names."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from daybook.functions import rules as R
from daybook.functions import text as T
from daybook.functions import timex as X
from daybook.operators import constraints, dedupe, diff, emit, filters, matching, places
from daybook.sources import mappers, readers


def one(spark, expression, **columns):
    row = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{k} string" for k in columns)) if columns else spark.range(1)
    return row.select(expression.alias("v")).first().v


@pytest.mark.parametrize(
    ("raw", "key"),
    [("The The Rex", "rex"), ("Café", "cafe"), ("Caf&#233;", "cafe"), ("Wussow&#8217;s", "wussows"), ("Sports &#038\; Health (G)", "sports and health"), ("X Company Inc", "x"), ("Co-op", "co op"), ("The", "the"), ("Straße Ærø", "strasse aero"), ("", "")],
)
def test_venue_key(spark, raw, key):
    assert one(spark, T.venue_key(F.col("s"), everything=True), s=raw) == key
    assert one(spark, T.venue_key(F.col("s"), everything=True), s=key) == key


@pytest.mark.parametrize(("raw", "sentinel"), [("See listing for details", True), ("Various Stages at Bayfront", False), ("TBD Skatepark", False), ("TBD", True), ("varies, see site", True), ("Location TBD", False), ("", True)])
def test_sentinel(spark, raw, sentinel):
    assert one(spark, T.is_sentinel(T.venue_key(F.col("s"))), s=raw) is sentinel


def test_entities(spark):
    assert one(spark, T.clean_text(F.col("s")), s="a &amp;#8217; b&nbsp;&#x1F600; &unknown; &amp;amp;amp;amp; x") == "a ’ b 😀 &unknown; &amp; x"


def test_cities(spark):
    got = lambda s: one(spark, T.leading_city(F.col("s")), s=s)
    assert tuple(got("Houghton, Mich., MacInnes Arena")) == ("Houghton", "MI", "MacInnes Arena")
    assert got("Bayfront, Main Stage") is None


@pytest.mark.parametrize(("hay", "low", "high"), [("Ages 3-5", 3, 5), ("ages 5 and up", 5, None), ("ages 14 & under", None, 14), ("21+ only", 21, None), ("$10+", None, None), ("in 2026+", None, None)])
def test_age_band(spark, hay, low, high):
    assert tuple(one(spark, R.age_band(F.col("s")), s=hay)) == (low, high)


def test_rules_and_their_false_positives(spark):
    hay = F.col("s")
    assert one(spark, R.cost_tier(hay, F.lit("unknown")), s="a cloud free night") == "unknown"
    assert one(spark, R.cost_tier(hay, F.lit("unknown")), s="free admission") == "free"
    assert one(spark, R.cost_tier(hay, F.lit("unknown")), s="free admission, $5 parking") == "paid"
    assert one(spark, R.audience(hay, F.array(F.lit("all ages"))), s="21+ brewery night") == ["adults-only"]
    assert one(spark, R.notice(hay, F.array(F.lit("academic calendar"))), s="HazMaTON Webinar") is False
    assert one(spark, R.home_away(hay, F.lit(True)), s="UMD at Bemidji") == "away"
    assert one(spark, R.event_type(hay, F.array(F.lit("x"), F.lit("Music")), F.lit("")), s="Board Games") == "live-music"
    assert one(spark, R.event_type(hay, F.array().cast("array<string>"), F.lit("Sacred Heart")), s="Judy Collins") == "live-music"


def test_times(spark):
    assert one(spark, X.clock_minutes(F.col("s")), s="6:00 PM") == 1080
    assert one(spark, X.clock_minutes(F.col("s")), s="12am") == 0
    assert one(spark, X.clock_minutes(F.col("s")), s="25:00") is None
    assert one(spark, X.iso_with_offset(F.to_timestamp(F.col("s"))), s="2026-07-27 23:00:00") == "2026-07-27T18:00:00-05:00"
    assert one(spark, X.cost_of_values(F.array(F.lit("1"), F.lit("22")))).asDict() == {"kind": "paid", "price_min": 1.0, "price_max": 22.0}
    assert one(spark, X.cost_of_values(F.array(F.lit("0"))))["kind"] == "free"
    assert one(spark, X.cost_of_values(F.lit(None).cast("array<string>")))["kind"] == "unknown"


EVENT = "ord long, source string, title string, confidence string, room string, place_id string, venue string, instant timestamp, day string, also array<string>"


def listed(spark, rows):
    at = lambda h: dt.datetime(2026, 5, 1, h)
    return spark.createDataFrame([(i, s, t, c, room, p, "Hall", at(h), "2026-05-01", []) for i, (s, t, c, room, p, h) in enumerate(rows)], EVENT)


def test_dedupe_merges_and_credits(spark):
    rows = [("a", "Big Fall Concert", "medium", None, "p", 1), ("b", "Big Fall Concert Tour", "high", None, "p", 1), ("a", "Big Fall Concert", "medium", None, "p", 1), ("c", "Fall Concert Big", "low", None, "p", 1)]
    got = dedupe.dedupe(listed(spark, rows)).collect()
    assert [(r.ord, r.source, r.also) for r in got] == [(1, "b", ["a", "c"])]


@pytest.mark.parametrize(
    ("rows", "left"),
    [
        ([("a", "Yoga Class One", "high", None, "p", 1), ("b", "Quilting Circle", "high", None, "p", 1)], 2),
        ([("a", "Shared Big Event", "high", "r1", "p", 1), ("b", "Shared Big Event Day", "high", "r2", "p", 1)], 2),
        ([("a", "Shared Big Event", "high", None, None, 1), ("b", "Shared Big Other", "high", None, None, 1)], 2),
        ([("a", "Hourly Tour", "high", None, "p", h) for h in range(7)], 7),
        ([("a", "Hourly Tour", "high", None, None, 1), ("b", "Hourly Tour", "low", None, None, 2)], 1),
    ],
)
def test_dedupe_refusals(spark, rows, left):
    assert dedupe.dedupe(listed(spark, rows)).count() == left


def test_filters_parse():
    f = filters.parse({"type": "Music,class, ", "weekend": "", "cost": "nonsense", "audience": ["kids"], "homeaway": "HOME"})
    assert f.lists == {"types": ["class"]} and f.flags == {"weekend": False} and f.equal == {"homeAway": "home"}
    assert len({s.file for s in filters.SAVED}) == len(filters.SAVED) == 45


def test_resolution_outcomes(spark):
    registry = spark.createDataFrame([("rex", "The Rex", ["Rex Bar"], ["600 E Superior St"])], "id string, name string, name_aliases array<string>, address_aliases array<string>")
    events = spark.createDataFrame([("rex bar", "Duluth"), ("600 E. Superior St", "Duluth"), ("TBD", "Duluth"), ("Duluth, MN", "Duluth"), ("Other Hall", "Duluth")], "venue_raw string, city string")
    got = {r.venue_raw: (r.place_id, r.outcome) for r in places.resolve(events, places.alias_table(registry)).collect()}
    assert got == {"rex bar": ("rex", "registered"), "600 E. Superior St": ("rex", "registered"), "TBD": (None, "sentinel"), "Duluth, MN": (None, "city-only"), "Other Hall": ("~other-hall", "provisional")}


def test_constraints(spark):
    df = spark.createDataFrame([("ics-import", "high"), ("ics-import", "low"), ("pdf-llm-extract", "low")], "m string, c string")
    valid, refused = constraints.split_valid(df, {"ceiling": constraints.confidence_allowed(F.col("m"), F.col("c"))})
    assert valid.count() == 2 and refused.first().failed == ["ceiling"]


def test_ics_reading_and_mapping(spark, tmp_path):
    body = "BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nUID:1\r\nSUMMARY:A long\r\n  title\\, here\r\nDTSTART:20260501T190000\r\nLOCATION:Tempe\\, AZ\\, Arena\r\nX-A:1\r\nX-A:2\r\nEND:VEVENT\r\nEND:VCALENDAR\r\n"
    (tmp_path / "a.ics").write_text(body, newline="")
    props = readers.read_ics(spark, str(tmp_path))
    assert props.first().props["X-A"] == "1" and readers.read_ics(spark, str(tmp_path), append=True).first().props["X-A"] == "1\n2"
    row = mappers.ics(props).first()
    assert (row.title, row.city, row.state, row.start_ts) == ("A long title, here", "Tempe", "AZ", dt.datetime(2026, 5, 2, 0))


def test_json_ld(spark):
    page = '<script type="application/ld+json">[{"@type":"Event","name":"Show","startDate":"2026-05-01","offers":{"lowPrice":"5","highPrice":10}},{"@type":"Place"}]</script><script type="application/ld+json">{bad</script>'
    row = mappers.json_ld(readers.json_ld_events(spark.createDataFrame([(page,)], "html string"))).first()
    assert row.title == "Show" and row.all_day and row.cost.kind == "paid" and row.cost.price_max == 10.0


def test_legistar(spark):
    df = spark.createDataFrame([(1, "City Council", "2026-07-27T00:00:00", "6:00 PM", None, "u", None, None), (2, "X", None, None, None, None, None, None)], "EventId long, EventBodyName string, EventDate string, EventTime string, EventLocation string, EventInSiteURL string, EventAgendaFile string, EventComment string")
    row = mappers.legistar(df).first()
    assert row.title == "City Council — Public Meeting" and row.start_ts == dt.datetime(2026, 7, 27, 23) and row.venue_raw == "See agenda"


def test_folding_by_octets(spark):
    line = "DESCRIPTION:" + "é" * 100
    folded = one(spark, emit.fold(F.col("s")), s=line)
    assert all(len(x.encode()) <= 75 for x in folded.split("\r\n")) and folded.replace("\r\n ", "") == line


def test_matching_and_diff(spark):
    pairs = matching.containment_pairs(spark.createDataFrame([("~x-y",), ("~y-x",), ("~x-y-z",), ("~x",)], "id string")).collect()
    assert {(r.a, r.b) for r in pairs} == {("~x-y", "~y-x"), ("~x-y", "~x-y-z"), ("~x-y-z", "~y-x")}
    a = spark.createDataFrame([(1, "x", None), (2, "y", "q")], "uid long, t string, u string")
    b = spark.createDataFrame([(1, "x", "n"), (3, "y", "q")], "uid long, t string, u string")
    assert [tuple(r) for r in diff.changed_fields(a, b, ["t", "u"]).collect()] == [(1, "u", None, "n")]


def test_venue_rules_read_whole_texts(spark, tmp_path):
    name, kind = next(iter(R.VENUE_NAMES.items()))
    spark.createDataFrame([(0, "x" * 80 + " " + name)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.id: r.facet for r in __spark_entry__.queries()["classify_venue"](spark, str(tmp_path)).collect()}
    assert got[1000] == kind


def test_registered_names():
    names, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(names) and len(names) >= 60
