"""Finalisation, session sources, tiered matching, reports and output on small fixtures."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import __spark_entry__
from daybook.functions import rules as R
from daybook.functions import text as T
from daybook.functions import timex as X
from daybook.operators import emit, finalize, matching, reports
from daybook.plans import queries
from daybook.sources import mappers, readers

REGISTRY = "id string, name string, name_aliases array<string>, address_aliases array<string>, street string, zip string"
EVENT = "native_id string, title string, description string, start_ts timestamp, end_ts timestamp, venue_raw string, categories array<string>, event_type string, status string, city string, state string"


def event(title="Quilting", description=None, venue="The Rex", categories=(), kind="other", status="confirmed", city="Duluth", state="MN", start=dt.datetime(2026, 5, 2, 0, 30), end=dt.datetime(2026, 5, 2, 3, 0)):
    return ("e", title, description, start, end, venue, list(categories), kind, status, city, state)


def finals(spark, *rows):
    registry = spark.createDataFrame([("rex", "Rex Theater", ["The Rex"], ["1 Main St"], "1 Main St", "55802")], REGISTRY)
    raw = spark.createDataFrame([(str(i), *r[1:]) for i, r in enumerate(rows)], EVENT)
    given = {c: F.col(c) for c in raw.columns}
    found = finalize.finalize(mappers.canonical(raw, **given), registry).collect()
    return sorted(found, key=lambda r: int(r.native_id))


def test_finalize_places_types_and_backfills(spark):
    rex, away, tbd, sure, moved, empty = finals(
        spark, event(description="Ages 5 and up. https://www.eventbrite.com/e/9."), event(title="UMD at Tech", categories=["Athletics"], venue="Houghton, Mich., MacInnes Arena"), event(venue="TBD", title="All ages welcome"),
        event(title="City band", kind="meeting"), event(title="Postponed: band", status="confirmed"), event(title=None, venue=None, start=None, end=None),
    )
    assert (rex.place_id, rex.place_name, rex.street, rex.zip, rex.in_duluth) == ("rex", "Rex Theater", "1 Main St", "55802", True)
    assert tuple(rex.age) == (False, 5, None) and rex.ticket_url == "https://www.eventbrite.com/e/9"
    # 00:30 UTC is the evening before in the events' zone: Friday, one day
    assert (rex.time_of_day, rex.weekend, rex.multi_day) == ("evening", False, False)
    assert (away.city, away.state, away.in_duluth, away.geo_scope, away.event_type, away.home_away) == ("Houghton", "MI", False, "distant", "sports", "away")
    assert (away.place_id, away.place_name) == ("~macinnes-arena", "MacInnes Arena")
    assert tbd.place_id is None and tuple(tbd.age) == (True, None, None)
    assert sure.event_type == "meeting" and moved.status == "tentative" and moved.event_type == "live-music"
    assert (empty.place_id, empty.weekend, empty.multi_day, empty.age) == (None, None, False, None)


def test_texts_are_searched_once(spark, monkeypatch):
    titles = ["Postponed: band vs Tech", " city\tcouncil\n at  noon ", "new\u00a0date", "new&nbsp;date", "open\u2003house", "\ufeffvs ", "no & fee", ""]
    rows = [(i, t, d, c) for i, (t, d, c) in enumerate((t, d, c) for t in titles for d in (None, "", "all ages, no\u00a0class") for c in ([], ["final exam"]))]
    df = spark.createDataFrame(rows, "i int, title string, description string, categories array<string>")
    t, c = F.col("title"), F.col("categories")
    whole, head = T.haystack(t, F.col("description"), c), T.clean_text(F.concat_ws(" ", t, F.array_join(c, " ")))
    plain = df.select("i", whole.alias("hay_"), *[R.said_in(x).alias(n) for n, x in (("said_", whole), ("type_said_", head), ("title_said_", t))])
    assert sorted(finalize.heard(df).select(plain.columns).collect()) == sorted(plain.collect())
    search, before = R.said_in, []

    # the venue's text and the whole one are searched, of which no other search may find the title
    def once(text):
        before.append(text)
        again = F.raise_error(F.lit("searched again")).cast("array<string>")
        return F.when(F.contains(text, F.lit("Postponed")), again).otherwise(search(text)) if len(before) > 2 else search(text)

    monkeypatch.setattr(R, "said_in", once)
    assert finals(spark, event(title="Postponed: band"))[0].status == "tentative"


def test_finalize_of_no_events(spark):
    assert finalize.finalize(mappers.canonical(spark.createDataFrame([], EVENT)), spark.createDataFrame([], REGISTRY)).count() == 0


def test_zones_and_rules_of_calendar_text(spark):
    body = "BEGIN:VCALENDAR\r\n" + "".join(
        f"BEGIN:VEVENT\r\nUID:{i}\r\nSUMMARY:x\r\nDTSTART{zone}:20260501T190000\r\nRRULE:{rule}\r\nEND:VEVENT\r\n" for i, (zone, rule) in enumerate([(";TZID=Europe/Paris", "FREQ=WEEKLY"), (";TZID=UTC+0", "COUNT=4"), ("", "")])
    )
    found = mappers.ics(readers.ics_properties(spark.createDataFrame([(body,)], "value string"))).orderBy("native_id").collect()
    assert [r.start_ts.hour for r in found] == [17, 0, 0] and [r.rrule for r in found] == ["FREQ=WEEKLY", None, None]
    row = spark.createDataFrame([("UTC",), ("Europe/Paris",), ("UTC+0",), (None,)], "z string")
    assert [r[0] for r in row.select(X.safe_timezone(F.col("z"))).collect()] == ["UTC", "Europe/Paris", X.ZONE, X.ZONE]


def test_sessions_of_bodies(spark):
    bodies = lambda *texts: spark.createDataFrame([(t,) for t in texts], "body string")
    item = StructType().add("id", "string").add("title", "string")
    assert [r.id for r in readers.squarespace_items(bodies('{"upcoming":[{"id":"a","title":"x"},{"id":"b"}]}', "{}", "no json"), item).collect()] == ["a", "b"]
    whole = json.dumps({"success": True, "timezone": "America/Chicago", "all_sessions": {"1": {"id": "1", "title": "t"}, "2": {"id": "2"}}, "list": []})
    assert sorted((r.id, r.timezone) for r in readers.eventeny_sessions(bodies(whole), item).collect()) == [("1", "America/Chicago"), ("2", "America/Chicago")]
    with pytest.raises(Exception, match="full"):
        readers.eventeny_sessions(bodies('{"success":false,"err_msg":"full"}'), item).collect()
    elements = readers.overpass_elements(bodies('{"elements":[{"type":"way","id":7,"center":{"lat":46.7,"lon":-92.1},"tags":{"name":"Hall"}}]}', "<html>busy</html>"))
    assert [(r.ref, r.name, r.lat) for r in mappers.osm(elements).collect()] == [("way/7", "Hall", 46.7)]
    assert readers.overpass_query({"amenity": "bar|pub"}, [(1, 2, 3, 4)]).count("(1,2,3,4)") == 1


def test_catalog_sessions_and_their_cap(spark):
    h = "0123456789abcdef0123456789abcdef"
    page = spark.createDataFrame([(f"x {'f' * 32} catalog/getItems/{h}/2",)], "html string")
    assert page.select(readers.rec1_hash(F.col("html"))).first()[0] == h
    sections = lambda ids: json.dumps({"sections": [{"name": "Youth Programs", "groups": [{"id": i, "name": "g" + i} for i in ids]}, {"name": "Rentals", "groups": [{"id": "z"}]}]})
    items = spark.createDataFrame([(0, "a", sections(["1", "2"])), (1, "b", sections(["3"])), (2, "c", "broken")], "tab_no int, tab string, body string")
    sessions = spark.createDataFrame([(t, g, json.dumps({"items": [{"id": f"s{g}"}]})) for t, g in (("a", "1"), ("a", "2"), ("b", "3"))] + [("a", "z", '{"items":[{"id":"no"}]}')], "tab string, group_id string, body string")
    got = lambda most: sorted(r.session.id for r in readers.rec1_sessions(items, sessions, StructType().add("id", "string"), most).collect())
    assert got(200) == ["s1", "s2", "s3"] and got(2) == ["s1", "s2"]


def test_pages_that_name_the_next(spark):
    def read(url):
        if url == "c":
            raise OSError("gone")
        return spark.createDataFrame([(url,)], "u string")

    following = {"a": "b", "b": "c"}.get
    assert [r.u for r in readers.follow_pages("a", read, following).collect()] == ["a", "b"]
    assert [r.u for r in readers.follow_pages("a", read, following, most=1).collect()] == ["a"]
    assert readers.follow_pages("c", read, following) is None


def test_records_of_districts_and_trails(spark):
    row = spark.createDataFrame([({"NAME": "Lakeside", "GlobalID": "{AB-1}", "OBJECTID": "5", "last_edited_date": "0"},)], "attributes map<string,string>")
    n = mappers.neighborhood(row).withColumn("raw", F.map_keys("raw")).first()
    assert (n.id, n.object_id, n.shape_area, n.last_edited, n.raw) == ("ab-1", 5, None, "1970-01-01T00:00:00.000Z", ["GlobalID", "NAME", "OBJECTID", "last_edited_date"])
    t = mappers.trail_condition(spark.createDataFrame([("k", " ", "https://x", {"b": "2", "a": "1"})], "embedKey string, street string, url string, socials map<string,string>")).withColumn("socials", F.map_keys("socials")).first()
    assert (t.street, t.url, t.weather_policy, t.socials) == (None, "https://x", None, ["a", "b"])


def brute_tiers(targets, parts, tiers, words):
    """The rule said of one target at a time, over all candidates in order of their ids."""
    out = {}
    for target, name, local in targets:
        best, score, src, n = None, 0.0, None, 0
        for tier, local_only, (s, w, north, e) in tiers:
            if score >= matching.STRONG or (local_only and not local):
                continue
            for p in sorted(parts, key=lambda p: p["candidate"]):
                if p["tier"] != tier or p["closed"]:
                    continue
                a, b = set(words[name]), set(words[p["name"]])
                initials = "".join(x[0] for x in words[p["name"]])
                short = " ".join(words[name])
                value = max(len(a & b) / len(a | b) if a | b else 0.0, 0.9 if short.isalpha() and 2 <= len(short) <= 6 and short in initials else 0.0)
                if value > score:
                    best, score, src, n = p, value, tier, 1
                elif value == score and value > 0:
                    n += 1
            if src == tier and best is not None and not (s <= best["lat"] <= north and w <= best["lon"] <= e):
                best, score, src, n = None, 0.0, None, 0
        if best is not None:
            out[target] = (best["candidate"], src, round(score, 6), n > 1)
    return out


def test_tiers_match_brute_force(spark):
    names = ["Green Steel Hall", "Green Steel", "Blue Small Box", "Box", "Blue", "Gray Stone Shed", "Large Plate", "Brass Plate", "Plate Brass", "Small Box"]
    targets = [("t0", "green steel", True), ("t1", "small box", False), ("t2", "blue", True), ("t3", "large brass plate", True), ("t4", "nothing alike", True), ("t5", "gs", True), ("t6", "box", False)]
    words = {r.name: r.t for r in spark.createDataFrame([(n,) for n in [*names, *[t[1] for t in targets]]], "name string").select("name", matching.tokens(F.col("name")).alias("t")).collect()}
    for seed in range(3):
        parts = [{"candidate": i, "name": names[(i * 7 + seed) % 10], "tier": queries.TIERS[(i + seed) % 3][0], "lat": 45.0 if (i + seed) % 4 else 60.0, "lon": -92.0, "closed": i % 6 == seed} for i in range(20)]
        frame = spark.createDataFrame([tuple(p.values()) for p in parts], "candidate long, name string, tier string, lat double, lon double, closed boolean")
        found = matching.tiered_matches(spark.createDataFrame(targets, "target string, name string, is_local boolean"), frame, queries.TIERS).collect()
        assert {r.target: (r.candidate, r.tier, round(r.score, 6), r.tied) for r in found} == brute_tiers(targets, parts, queries.TIERS, words)


def test_progress_and_pages(tmp_path):
    began = dt.datetime(2026, 1, 1)
    snap = reports.progress(str(tmp_path), "job", began, began + dt.timedelta(seconds=10), 5, 20)
    assert (snap["pct"], snap["rate_per_s"], snap["eta_s"]) == (25, 0.5, 30)
    reports.progress(str(tmp_path), "job", began, began + dt.timedelta(seconds=40), 20, 20, finished=True)
    assert json.loads((tmp_path / "job.json").read_text())["finished"] and len((tmp_path / "job.jsonl").read_text().splitlines()) == 2
    blocker = tmp_path / "file"
    blocker.write_text("")
    assert reports.progress(str(blocker), "job", began, began, 0)["done"] == 0
    page = reports.index_page([{"group": "G", "title": "A <b>", "file": "a", "n": 2}], "https://x.example")
    assert "A &lt;b&gt;" in page and "webcal://x.example/feeds/a.ics" in page
    assert reports.markdown([{"a": 1, "b": "x|y"}], ["a", "b"]).splitlines()[-1] == "| 1 | x\\|y |"
    assert "place/p1.ics" in reports.directory_page([{"place_id": "p1", "name": "Hall", "n": 0}], "")


def test_unresolved_keeps_the_last_spelling(spark):
    rows = [(0, "Bent Paddle", None, None), (1, "BENT  PADDLE", "Superior", "WI"), (2, "Room 12", None, None), (3, "Zoom webinar", None, None), (4, "Sioux Falls, SD", None, None), (5, "TBD", None, None), (6, None, None, None)]
    found = {r.key: r for r in reports.unresolved(spark.createDataFrame(rows, "ord long, venue_raw string, city string, state string")).collect()}
    assert (found["bent paddle"].raw, found["bent paddle"].n, found["bent paddle"].city, found["bent paddle"].kind) == ("BENT PADDLE", 2, "Superior", "venue")
    assert (found["room 12"].kind, found["zoom webinar"].kind, found["sioux falls"].kind, len(found)) == ("room", "virtual", "city", 4)


def test_calendar_of_all_properties(spark, tmp_path):
    row = spark.createDataFrame(
        [("u1", "A", dt.datetime(2026, 1, 2), dt.datetime(2026, 1, 3), False, "d", "l", ["x"], "confirmed", None, "FREQ=DAILY", "", (46.5, -92.0), ('The "Rex"', "a@b.example"), dt.datetime(2026, 1, 1)), ("u0", "B", dt.datetime(2026, 1, 2), None, False, "", "", [], "confirmed", None, None, "", None, ("No address", None), None)],
        "uid string, title string, start_ts timestamp, end_ts timestamp, all_day boolean, description string, location string, categories array<string>, status string, url string, rrule string, x string, geo struct<lat double, lon double>, organizer struct<name string, email string>, last_modified timestamp",
    )
    reports.single_feed(emit.vevent(row), str(tmp_path / "feed"), "All", "about", 21600)
    text = "".join((tmp_path / "feed" / f).read_text() for f in sorted(os.listdir(tmp_path / "feed")) if f.startswith("part"))
    lines = text.replace("\r\n", "\n").strip().split("\n")
    assert lines[0] == "BEGIN:VCALENDAR" and lines[-1] == "END:VCALENDAR" and lines.index("UID:u0") < lines.index("UID:u1")
    assert {"GEO:46.5;-92.0", "ORGANIZER;CN=\"The 'Rex'\":mailto:a@b.example", "LAST-MODIFIED:20260101T000000Z", "RRULE:FREQ=DAILY"} <= set(lines)
    assert sum(x.startswith("ORGANIZER") for x in lines) == 1


def test_new_queries_are_registered():
    known = __spark_entry__.queries()
    assert {"finalize_events", "filters_on_real_facets", "run_counts", "unresolved_tally", "tiered_matches", "gazetteer_what_if", "risk_ranking", "trail_uses_unpivot"} <= set(known)
