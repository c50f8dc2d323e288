"""Counts and rankings about runs, venues, proposals and types, and the pages and endpoints made of them."""

from __future__ import annotations

import datetime as dt
import json
import os
import re
from collections.abc import Mapping, Sequence
from html import escape

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import rules as R
from daybook.functions import text as T
from daybook.functions.phrases import Phrases
from daybook.operators import emit, filters

# The type that a gazetteer's category stands for; None where no one type does.
GAZETTEER_TYPE = {
    "music_venue": "live-music", "jazz_and_blues_venue": "live-music", "night_club": "live-music",
    "bar": "food-drink", "irish_pub": "food-drink", "beer_bar": "food-drink", "brewery": "food-drink", "restaurant": "food-drink", "american_restaurant": "food-drink", "coffee_shop": "food-drink", "winery": "food-drink", "hotel_bar": "food-drink",
    "performing_arts_theater": "performing-arts", "theater": "performing-arts", "movie_theater": "film", "art_gallery": "visual-arts", "art_museum": "visual-arts",
    "museum": "education", "history_museum": "education", "library": "education", "planetarium": "education", "college_university": "education",
    "stadium_arena": "sports", "sports_club": "sports", "golf_course": "sports", "ice_skating_rink": "sports", "amusement_park": "family", "zoo": "family",
    "community_services_non_profits": "community", "church_house_of_worship": "community", "religious_organization": "community", "government_building": "meeting", "farmers_market": "market",
    "park": None, "convention_center": None, "hotel": None,
}
# Names of rooms, which are no venues; 0 is any number.
ROOM = Phrases({"room": ["council chamber", "council chambers", "conference room", "meeting room", "boardroom", "board room", "room 0", "rm 0", "rm0", "rm. 0", "rm.0"]})


# runs


def run_counts(fetched: DataFrame, merged: DataFrame, failures: Sequence[tuple[str, str]]) -> DataFrame:
    """``kind, name, n``: rows of each source, all rows, rows after merging, and each source that failed."""
    per = fetched.groupBy(F.col("source").alias("name")).agg(F.count("*").alias("n")).select(F.lit("source").alias("kind"), "name", "n")
    total = fetched.agg(F.count("*").alias("n")).select(F.lit("fetched").alias("kind"), F.lit("").alias("name"), "n")
    after = merged.agg(F.count("*").alias("n")).select(F.lit("merged").alias("kind"), F.lit("").alias("name"), "n")
    failed = fetched.sparkSession.createDataFrame([("failed", name, 1) for name, _ in failures], "kind string, name string, n long")
    return per.union(total).union(after).union(failed)


def collected_counts(counts: Mapping[str, int], failures: Sequence[tuple[str, str]], merged: DataFrame) -> DataFrame:
    """As ``run_counts``, of what a run has counted while it wrote; only the merged rows are counted here."""
    spark = merged.sparkSession
    told = [("source", name, n) for name, n in counts.items()] + [("fetched", "", sum(counts.values()))] + [("failed", name, 1) for name, _ in failures]
    after = merged.agg(F.count("*").alias("n")).select(F.lit("merged").alias("kind"), F.lit("").alias("name"), "n")
    return spark.createDataFrame(told, "kind string, name string, n long").union(after)


def progress(folder: str, job: str, began: dt.datetime, now: dt.datetime, done: int, total: int | None = None, finished: bool = False, **extra) -> dict:
    """A snapshot of a job: the newest replaces ``job.json``, all are kept in ``job.jsonl``; a file that cannot be written stops nothing."""
    seconds = (now - began).total_seconds()
    rate = done / seconds if seconds > 0 else 0.0
    snapshot = {"job": job, "ts": now.isoformat(), "done": done, "total": total, "pct": round(done / total * 100) if total else None, "rate_per_s": round(rate, 3), "eta_s": round((total - done) / rate) if total and rate > 0 else None, "finished": finished} | extra
    line = json.dumps({k: v for k, v in snapshot.items() if v is not None}) + "\n"
    for name, mode in ((f"{job}.json", "w"), (f"{job}.jsonl", "a")):
        try:
            os.makedirs(folder, exist_ok=True)
            with open(os.path.join(folder, name), mode) as f:
                f.write(line)
        except OSError:  # progress is a diagnosis, not the job
            continue
    return snapshot


# endpoints


def sources(events: DataFrame) -> DataFrame:
    return events.groupBy(T.slug(F.col("source")).alias("source")).agg(F.count("*").alias("n"))


def types(events: DataFrame) -> DataFrame:
    """Every type of the vocabulary with its count, zero where none."""
    known = events.sparkSession.createDataFrame([(i, t) for i, t in enumerate(filters.VOCABULARY["types"])], "ord int, event_type string")
    return known.join(events.groupBy("event_type").agg(F.count("*").alias("n")), "event_type", "left").select("ord", "event_type", F.coalesce("n", F.lit(0)).alias("n"))


def feed(events: DataFrame, params: Mapping[str, object]) -> DataFrame:
    """The events that a request's parameters ask for; all without any."""
    return events.filter(filters.predicate(filters.parse(params)))


def index_rows(counts: DataFrame, most: int = 15) -> DataFrame:
    """What the landing page lists: saved queries in their order and the busiest venues; none without events."""
    return filters.top_per_group(counts, "By venue", most)


def index_page(rows: Sequence, base: str, title: str = "Calendars") -> str:
    """The landing page of ``group, title, file, n`` rows (as many as there are saved queries), in the order given."""
    subscribe = re.sub("^https?://", "webcal://", base)
    out: list[str] = [f"<h1>{escape(title)}</h1>"]
    for group in dict.fromkeys(r["group"] for r in rows):
        out.append(f"<h2>{escape(group)}</h2><table>")
        for r in (r for r in rows if r["group"] == group):
            name = escape(r["file"], quote=True)
            out.append(f'<tr><td>{escape(r["title"])}</td><td>{r["n"]}</td><td><a href="{subscribe}/feeds/{name}.ics">Subscribe</a> <a href="{base}/feeds/{name}.ics">.ics</a></td></tr>')
        out.append("</table>")
    return "\n".join(out)


def directory_page(rows: Sequence, base: str) -> str:
    """A line for every place (``place_id, name, n``), also those without events."""
    lines = [f'<li><a href="{base}/feeds/place/{escape(r["place_id"], quote=True)}.ics">{escape(r["name"])}</a> ({r["n"]})</li>' for r in rows]
    return "\n".join(["<ul>", *lines, "</ul>"])


def single_feed(vevents: DataFrame, path: str, name: str, about: str, ttl_seconds: int) -> None:
    """One calendar: its head, the ``ics`` of every row by ``uid``, its end, as one text file in ``path``."""
    head, end = emit.calendar(name, about, ttl_seconds, []).rstrip(emit.EOL).rsplit(emit.EOL, 1)
    rim = vevents.sparkSession.createDataFrame([(0, "", head), (2, "", end)], "part int, uid string, ics string")
    body = vevents.select(F.lit(1).alias("part"), "uid", "ics")
    rim.union(body).repartition(1).sortWithinPartitions("part", "uid").select(F.col("ics").alias("value")).write.option("lineSep", emit.EOL).mode("overwrite").text(path)


# venues that no registry knows


def unresolved(events: DataFrame) -> DataFrame:
    """``key, raw, city, state, n, kind`` of venues to look up (rows ``ord, venue_raw, city, state``), most events first.

    kind is ``venue``, or why it is none: ``virtual``, ``room``, ``city``. The spelling is the last one seen; the city
    that the text states, else the last that a row states. Blank venues and sentinels are left out.
    """
    # by spelling: what follows is worked out once for each, whatever the number of events
    spelled = events.groupBy("venue_raw", "city", "state").agg(F.count("*").alias("n"), F.max("ord").alias("ord"))
    read = spelled.withColumn("clean", T.clean_text(F.col("venue_raw"))).filter("clean IS NOT NULL")
    read = read.withColumns({"lead": T.leading_city(F.col("clean"), is_clean=True), "name": T.venue_name(F.col("clean"), is_clean=True), "said": R.said_in(F.col("clean")), "room": ROOM.found(F.col("clean"))})
    keyed = read.withColumns({"key": T.venue_key(F.col("name")), "whole_key": T.venue_key(F.col("clean")), "town": F.coalesce(F.col("lead.city"), F.col("city"), F.lit("Duluth")), "land": F.coalesce(F.col("lead.state"), F.col("state"), F.lit("MN"))})
    named = keyed.filter((F.col("key") != "") & ~T.is_sentinel(F.col("whole_key"))).withColumn("town_key", T.venue_key(F.col("town")))
    kind = F.when(R.ALL.holds(F.col("said"), "virtual"), "virtual").when(F.size("room") > 0, "room").when(F.col("key") == F.col("town_key"), "city").otherwise("venue")
    latest = F.max_by(F.struct("name", "town", "land"), "ord")
    return named.groupBy("key", kind.alias("kind")).agg(F.sum("n").alias("n"), latest.alias("last")).select("key", F.col("last.name").alias("raw"), F.col("last.town").alias("city"), F.col("last.land").alias("state"), "n", "kind")


def proposal_verdicts(proposed: DataFrame) -> DataFrame:
    """How many targets, and events of them, have each verdict (rows ``verdict, n``)."""
    return proposed.groupBy("verdict").agg(F.count("*").alias("n_targets"), F.sum("n").alias("n_events"))


def colliding_ids(proposed: DataFrame) -> DataFrame:
    """Ids that two targets or more propose (rows ``id, target, n``), with their events."""
    return proposed.groupBy("id").agg(F.countDistinct("target").alias("n_targets"), F.sum("n").alias("n_events")).filter("n_targets > 1")


def ranked(rows: DataFrame, by: str, tie: str, within: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``rank``: most first, then by ``tie``, in each group of ``within``.

    Without ``within`` the rows are a report that fits one task; they must be aggregated before.
    """
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*within).orderBy(F.desc(by), tie)))


def risk_order(merges: DataFrame) -> list[Column]:
    """Order of merges (``provisional, similarity, by_title, title``): provisional places, then the unlike, then by title."""
    likeness = F.coalesce(F.col("similarity"), F.when(F.col("by_title"), 1.0).otherwise(0.5))
    return [F.coalesce(F.col("provisional"), F.lit(False)).desc(), likeness.asc(), F.coalesce("title", F.lit("")).asc()]


def risk_ranked(merges: DataFrame) -> DataFrame:
    return merges.orderBy(*risk_order(merges))


# what would change


def gazetteer_type(category: Column) -> Column:
    known = {k: v for k, v in GAZETTEER_TYPE.items() if v}
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), category)


def what_if(decided: DataFrame, matched: DataFrame) -> DataFrame:
    """``outcome, category, n_venues, n_events`` if venues' types came from the gazetteer.

    decided: ``key, venue, n``, the events whose type only the venue decides; matched: ``key, category`` of sure
    matches. outcome: ``no match``, ``unmapped`` (by category), ``same`` or ``changed``.
    """
    now = F.coalesce(R.type_by_venue(F.col("venue")), F.lit("community"))
    met = decided.join(matched.withColumn("met", F.lit(True)), "key", "left").withColumns({"now": now, "then": gazetteer_type(F.col("category"))})
    outcome = F.when(F.col("met").isNull(), "no match").when(F.col("then").isNull(), "unmapped").when(F.col("then") == F.col("now"), "same").otherwise("changed")
    return met.groupBy(outcome.alias("outcome"), F.when(outcome == "unmapped", F.col("category")).alias("category")).agg(F.count("*").alias("n_venues"), F.sum("n").alias("n_events"))


def markdown(rows: Sequence, columns: Sequence[str]) -> str:
    """A report's rows as a Markdown table."""
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    return "\n".join(["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns), *["| " + " | ".join(cell(r[c]) for c in columns) + " |" for r in rows]])
