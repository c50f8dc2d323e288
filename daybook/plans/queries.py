"""Registered queries over the driver tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.functions import rules as R
from daybook.functions import text as T
from daybook.functions import timex as X
from daybook.operators import artifact, constraints, dedupe, diff, emit, feeds, filters, finalize, matching, places, reports
from daybook.plans import vocabulary as V
from daybook.plans.listings import SQL as LISTINGS
from daybook.plans.listings import listings, table
from daybook.sources import mappers, readers, shared

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
WS = r"[\s\x{00A0}\x{FEFF}\p{Z}]+"


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_holds(column: str, pattern: str) -> str:
    return f"regexp_matches(coalesce({column}, ''), {quoted(f'(^|[^A-Za-z0-9_])(?:{pattern})($|[^A-Za-z0-9_])')}, 'i')"


def sql_has(column: str, name: str) -> str:
    return sql_holds(column, V.pattern(V.TEXT_PHRASES[name]))


def sql_first(column: str, rows: dict[str, list[str]], other: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {sql_holds(column, V.pattern(phrases))} THEN {quoted(kind)}" for kind, phrases in rows.items()) + f" ELSE {other} END"


def sql_squeeze(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{WS}', ' ', 'g'), '^ | $', '', 'g')"


def sql_key(x: str) -> str:
    """venue_key of text without references and accents."""
    flat = f"regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(replace({x}, '&', ' and '), '\\(.*?\\)', ' ', 'g'), '[''’]', '', 'g')), '[^a-z0-9]+', ' ', 'g'), '^ | $', '', 'g')"
    bare = f"regexp_replace({flat}, '^((the|a|an) )+([a-z0-9])', '\\3')"
    return f"regexp_replace({bare}, '( (company|co|inc|llc|ltd|corp|incorporated))+$', '')"


def values(spark: SparkSession, names: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, names)


def sql_values(columns: str, rows: list[tuple]) -> str:
    one = lambda v: "NULL" if v is None else quoted(v) if isinstance(v, str) else str(v)
    return f"(VALUES {', '.join('(' + ', '.join(one(v) for v in r) + ')' for r in rows)}) AS t({columns})"


PHRASES = [
    (i, s)
    for i, s in enumerate([
        "Ages 3-5 story time", "ages 5 and up", "Ages 14 & under welcome", "21+ show, cash bar", "tickets $10+", "in 2026+ plans", "free admission", "a cloud free night", "gluten free baking", "suggested donation at the door",
        "Free and open to the public", "RSVP required", "no registration needed", "Register online", "drop-in craft", "Virtual via Zoom", "Hike on the trail, rain or shine", "ASL interpreter and wheelchair access", "sensory-friendly hour", "Seniors 55+ brunch",
        "HazMaTON Webinar", "Final exams; last day", "Postponed: concert", "UMD vs Duluth", "UMD at Bemidji", "Farmers Market", "City Council hearing", "5k race", "", "adults only, all ages", "members only", "brewery tour", "no fee", "ages 10-14 teens",
    ])
]
P = sql_values("id, hay", PHRASES)
BY_TEXT = f"(SELECT id, hay FROM {P} UNION ALL SELECT 1000 + doc_id, text FROM documents)"


def hays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases, and every document's whole text."""
    docs = table(spark, sf_dir, "documents").select((F.col("doc_id") + 1000).alias("id"), F.col("text").alias("hay"))
    return values(spark, "id long, hay string", PHRASES).union(docs)


# scans and text


@query(LISTINGS + "SELECT ord, source, confidence, instant, place_id, region, title, price FROM listings")
def scan_listings_bridge(spark, sf_dir):
    return listings(spark, sf_dir).select("ord", "source", "confidence", "instant", "place_id", "region", "title", "price")


@query("SELECT page_id, regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM pages")
def slug_source_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.slug(F.col("url")).alias("slug"))


@query("SELECT doc_id, regexp_replace(source, '[^a-z0-9]+', '-', 'g') || ':' || substr(sha1(text || '|' || lang || '|' || source), 1, 16) || '@events.example' AS uid FROM documents")
def uid_sha1(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.make_uid(F.col("source"), F.lit(""), F.col("text"), F.col("lang"), F.col("source")).alias("uid"))


_STRIP = "regexp_replace(regexp_replace(html, '<br\\s*/?>|</(?:p|div|li|h[1-6]|tr)>', ' ', 'gi'), '<[^>]*>', '', 'g')"
for _pattern, _to, _flags in (("&nbsp;|&#160;", " ", "gi"), ("&(?:#8217|#39|rsquo|apos);", "''", "g"), ("&(?:#8211|ndash);", "–", "g"), ("&(?:quot|#8220|#8221);", '"', "g"), ("&(?:lt|gt);", "", "g"), ("&(?:amp|#0?38);", "&", "gi")):
    _STRIP = f"regexp_replace({_STRIP}, '{_pattern}', '{_to}', '{_flags}')"


@query(f"SELECT page_id, md5({sql_squeeze(_STRIP)}) AS text_md5 FROM pages")
def strip_html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(T.strip_html(F.col("html")).cast("binary")).alias("text_md5"))


_ONCE = "replace(replace(replace(replace({}, '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


@query(f"SELECT page_id, md5({sql_squeeze(_ONCE.format(_ONCE.format(_ONCE.format('html'))))}) AS text_md5 FROM pages")
def decode_entities(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(T.clean_text(F.col("html")).cast("binary")).alias("text_md5"))


VENUES = [(i, s) for i, s in enumerate(["The Rex", "The The Rex", "Wussow's Concert Cafe", "Bent Paddle Brewing Co", "X Company Inc", "Co-op", "Sports & Health (G)", "The", "A An The Hall LLC", "See listing for details", "Various Stages at Bayfront", "TBD Skatepark", "TBD", "varies see website", "", "Not specified"])]


@query(f"SELECT id, {sql_key('s')} AS key FROM (SELECT id, s FROM {sql_values('id, s', VENUES)} UNION ALL SELECT 1000 + p_partkey, p_name FROM part UNION ALL SELECT 100000000 + n_nationkey, n_name FROM nation)")
def venue_key(spark, sf_dir):
    names = values(spark, "id long, s string", VENUES).union(table(spark, sf_dir, "part").select(F.col("p_partkey") + 1000, "p_name")).union(table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long") + 100000000, "n_name"))
    return names.select("id", T.venue_key(F.col("s")).alias("key"))


@query(f"SELECT id, regexp_matches({sql_key('s')}, '^(|(see listing|see catalog|see agenda|not specified|sign in to download the location|to be determined)( .*)?|(tbd|various|varies)( (for|see|check|tbd)( .*)?)?)$') AS sentinel FROM (SELECT id, s FROM {sql_values('id, s', VENUES)} UNION ALL SELECT 1000 + p_partkey, p_name FROM part)")
def sentinel_filter(spark, sf_dir):
    names = values(spark, "id long, s string", VENUES).union(table(spark, sf_dir, "part").select(F.col("p_partkey") + 1000, "p_name"))
    return names.select("id", T.is_sentinel(T.venue_key(F.col("s"))).alias("sentinel"))


CITIES = [(i, s) for i, s in enumerate(["Tempe, AZ, Desert Arena", "Duluth, MN", "Houghton, Mich., MacInnes Arena", "Superior, Wis.", "Bayfront, Main Stage", "Pier B, In", "Hall of Fame, Room 2, Floor 3", "no comma"])]
# by the first comma and what stands before the next one, given or not
_AP = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in T.AP_STATES.items())
_STATE = f"CASE WHEN upper(raw) IN ({', '.join(map(quoted, T.STATES))}) THEN upper(raw) ELSE CASE lower(raw) {_AP} END END"
_TOWN = "length(head) BETWEEN 2 AND 31 AND regexp_matches(head, '^[A-Za-z]') AND length(translate(lower(head), 'abcdefghijklmnopqrstuvwxyz .''-', '')) = 0"


def sql_city(source: str) -> str:
    """``id, city, state, rest`` of the strings ``s`` in ``source``."""
    cut = f"SELECT id, string_split(s, ',') AS c FROM {source}"
    named = f"SELECT id, c[1] AS head, regexp_replace(ltrim(c[2]), '[.]$', '') AS raw, trim(array_to_string(c[3:], ',')) AS rest FROM ({cut})"
    found = f"SELECT id, head, rest, {_STATE} AS state, {_TOWN} AS town FROM ({named})"
    return f"(SELECT id, CASE WHEN town AND state IS NOT NULL THEN trim(head) END AS city, CASE WHEN town THEN state END AS state, CASE WHEN town AND state IS NOT NULL THEN rest END AS rest FROM ({found}))"


_LINES = f"(SELECT id, s FROM {sql_values('id, s', CITIES)} UNION ALL SELECT 1000 + doc_id, text FROM documents UNION ALL SELECT 1000000000 + c_custkey, n_name || ', ' || upper(substr(n_name, 1, 2)) || ', ' || c_name FROM customer JOIN nation ON c_nationkey = n_nationkey)"


@query(f"SELECT id, city, state, rest FROM {sql_city(_LINES)}")
def leading_city_parse(spark, sf_dir):
    """Of hand-written venues, every document's text and every customer behind a nation with its first letters for a state."""
    n = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = values(spark, "id long, s string", CITIES).union(table(spark, sf_dir, "documents").select(F.col("doc_id") + 1000, "text"))
    rows = rows.union(n.select(n["c_custkey"].cast("long") + 1000000000, F.concat_ws(", ", "n_name", F.upper(F.substring("n_name", 1, 2)), "c_name")))
    c = T.leading_city(F.col("s"), is_clean=True)
    return rows.select("id", c["city"].alias("city"), c["state"].alias("state"), c["rest"].alias("rest"))


# time and money

CLOCKS = [(i, s) for i, s in enumerate(["6:00 PM", "12am", "12:30 pm", "23:59", "25:00", "7 p.m.", "noon", "0:15", "11:60 am", "8:05:30 am", "8:05:75 am", "7m", "7.", "7 PM ", "007", "7:5", "1:2:3:4", ""])]


_TIMES = f"(SELECT id, s FROM {sql_values('id, s', CLOCKS)} UNION ALL SELECT 1000 + event_id, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%I:%M %p') ELSE strftime(ts, '%H:%M:%S') END FROM events)"
_CLOCK = lambda i: f"regexp_extract(s, '^\\s*(\\d{{1,2}})(?::(\\d{{2}}))?(?::(\\d{{2}}))?\\s*([ap]m)?\\s*$', {i}, 'i')"


@query(f"SELECT id, CASE WHEN h < 24 AND m < 60 AND sec < 60 THEN h * 60 + m END AS minutes FROM (SELECT id, m, sec, CASE WHEN a = 'pm' AND h0 < 12 THEN h0 + 12 WHEN a = 'am' AND h0 = 12 THEN 0 ELSE h0 END AS h FROM (SELECT id, TRY_CAST({_CLOCK(1)} AS INTEGER) AS h0, coalesce(TRY_CAST({_CLOCK(2)} AS INTEGER), 0) AS m, coalesce(TRY_CAST({_CLOCK(3)} AS INTEGER), 0) AS sec, lower({_CLOCK(4)}) AS a FROM {_TIMES}))")
def clock_parse(spark, sf_dir):
    """Of hand-written clock times, and every event's time of day said in two ways."""
    e = table(spark, sf_dir, "events")
    said = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "hh:mm a")).otherwise(F.date_format("ts", "HH:mm:ss"))
    rows = values(spark, "id long, s string", CLOCKS).union(e.select(F.col("event_id") + 1000, said))
    return rows.select("id", X.clock_minutes(F.col("s")).alias("minutes"))


_LOCAL = "timezone('America/Chicago', timezone('UTC', ts))"


@query(f"SELECT event_id, CASE WHEN hour({_LOCAL}) >= 21 OR hour({_LOCAL}) < 5 THEN 'late-night' WHEN hour({_LOCAL}) < 12 THEN 'morning' WHEN hour({_LOCAL}) < 17 THEN 'afternoon' ELSE 'evening' END AS time_of_day, dayofweek({_LOCAL}) IN (0, 6) AS weekend FROM events")
def time_of_day_weekend(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", X.time_of_day(F.col("ts").cast("timestamp"), F.lit(False)).alias("time_of_day"), X.is_weekend(F.col("ts").cast("timestamp")).alias("weekend"))


@query(LISTINGS + "SELECT ord, CAST(start_ts AS DATE) <> CAST(end_ts AS DATE) AS multi_day FROM listings")
def multi_day(spark, sf_dir):
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return listings(spark, sf_dir).select("ord", X.is_multi_day(text(F.col("start_ts")), text(F.col("end_ts"))).alias("multi_day"))


@query("SELECT o_orderkey, strftime(timezone('UTC', timezone('America/Chicago', o_orderdate)), '%Y-%m-%d %H:%M:%S') AS instant FROM orders")
def wall_to_instant(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(X.wall_to_instant(F.col("o_orderdate").cast("timestamp")), "yyyy-MM-dd HH:mm:ss").alias("instant"))


@query("SELECT o_orderkey, CASE WHEN max(v) = 0 AND min(v) = 0 THEN 'free' ELSE 'paid' END AS kind, round(min(v), 2) AS price_min, CASE WHEN max(v) <> min(v) THEN round(max(v), 2) END AS price_max FROM (SELECT l_orderkey AS o_orderkey, l_extendedprice AS v FROM lineitem) GROUP BY 1")
def cost_minmax(spark, sf_dir):
    per = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.col("l_extendedprice").cast("string")).alias("v"))
    c = X.cost_of_values(F.col("v"))
    return per.select("o_orderkey", c["kind"].alias("kind"), F.round(c["price_min"], 2).alias("price_min"), F.round(c["price_max"], 2).alias("price_max"))


# facet and type rules over the phrases and all documents

# the words of a text; those behind the word age; numbers before a plus sign: all as lists
_AGE_WORDS = "regexp_extract_all(regexp_replace(lower(hay), '([0-9])(to|thru|through|and)([0-9 ])', '\\1 \\2 \\3', 'g'), '[a-z0-9_]+|[^\\sa-z0-9_]')"
_STATED = f"list_filter(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN w[i] IN ('age', 'ages') AND len(w[i + 1]) <= 2 THEN {{'n': TRY_CAST(w[i + 1] AS INTEGER), 'j': w[i + 2], 'm': w[i + 3]}} END), lambda x: x.n IS NOT NULL)"
_PLUSES = """list_filter(list_transform(range(1, len(p)), lambda i: CASE WHEN NOT regexp_matches(p[i + 1], '^[0-9]') AND length(regexp_extract(rtrim(p[i]), '[0-9]*$')) IN (1, 2)
  AND NOT regexp_matches(left(rtrim(p[i]), length(rtrim(p[i])) - length(regexp_extract(rtrim(p[i]), '[0-9]*$'))), '[$.–A-Za-z_-]$') THEN TRY_CAST(regexp_extract(rtrim(p[i]), '[0-9]*$') AS INTEGER) END), lambda x: x IS NOT NULL)"""
_ONE = lambda test, value: f"list_transform(list_filter(s, lambda x: {test}), lambda x: {value})[1]"
_TO = "x.j IN ('-', '–', '—', 'to', 'thru', 'through') AND length(x.m) <= 2 AND TRY_CAST(x.m AS INTEGER) IS NOT NULL"


def sql_ages(source: str) -> str:
    """The rows of ``source`` (with ``hay``) and ``lo``, ``hi``."""
    read = f"SELECT * EXCLUDE (w, p), {_STATED} AS s, {_PLUSES} AS bare FROM (SELECT *, {_AGE_WORDS} AS w, string_split(hay, '+') AS p FROM {source})"
    named = f"SELECT * EXCLUDE (s, bare), {_ONE(_TO, 'x.n')} AS r_lo, {_ONE(_TO, 'TRY_CAST(x.m AS INTEGER)')} AS r_hi, {_ONE(_AND + _UNDER, 'x.n')} AS under, coalesce({_ONE(_AND + _OVER, 'x.n')}, bare[1]) AS over FROM ({read})"
    return f"(SELECT * EXCLUDE (r_lo, r_hi, under, over), CASE WHEN r_lo IS NOT NULL THEN r_lo WHEN under IS NULL THEN over END AS lo, CASE WHEN r_lo IS NOT NULL THEN r_hi ELSE under END AS hi FROM ({named}))"


_AND, _UNDER, _OVER = "x.j IN ('and', '&') AND ", "x.m IN ('under', 'younger', 'below')", "x.m IN ('up', 'older', 'over', 'above')"


@query(f"SELECT id, lo AS min_age, hi AS max_age FROM {sql_ages(BY_TEXT)}")
def age_band(spark, sf_dir):
    b = R.age_band(F.col("hay"))
    return hays(spark, sf_dir).select("id", b["min_age"].alias("min_age"), b["max_age"].alias("max_age"))


_AUD = f"""list_distinct(list_filter([CASE WHEN lo >= 18 THEN 'adults-only' END, CASE WHEN hi <= 12 THEN 'kids' END, CASE WHEN lo <= 17 AND hi >= 13 THEN 'teen' END, CASE WHEN lo >= 55 THEN 'seniors' END,
  CASE WHEN {sql_has('hay', 'all-ages')} THEN 'all-ages' END, CASE WHEN {sql_has('hay', 'kids')} THEN 'kids' END, CASE WHEN {sql_has('hay', 'teen')} THEN 'teen' END,
  CASE WHEN {sql_has('hay', 'seniors')} OR regexp_matches(hay, '(^|[^A-Za-z0-9_])55\\s*\\+') THEN 'seniors' END], lambda x: x IS NOT NULL))"""


@query(f"SELECT id, coalesce(array_to_string(list_sort(CASE WHEN list_contains(a, 'adults-only') THEN list_filter(a, lambda x: x <> 'all-ages') ELSE a END), ','), '') AS audience FROM (SELECT id, {_AUD} AS a FROM {sql_ages(BY_TEXT)})")
def audience_facet(spark, sf_dir):
    return hays(spark, sf_dir).select("id", F.array_join(F.array_sort(R.audience(F.col("hay"), F.array().cast("array<string>"))), ",").alias("audience"))


def _facet(name: str, expression, sql: str) -> None:
    def run(spark, sf_dir):
        return hays(spark, sf_dir).select("id", expression(F.col("hay")).alias("facet"))

    run.__name__ = name
    query(f"SELECT id, {sql} AS facet FROM {BY_TEXT}")(run)


_has = lambda k: sql_has("hay", k)
_facet("cost_tier", lambda h: R.cost_tier(h, F.lit("unknown")), f"CASE WHEN {_has('donation')} THEN 'donation' WHEN regexp_matches(hay, '\\$\\s?\\d') THEN 'paid' WHEN {_has('free')} THEN 'free' ELSE 'unknown' END")
_facet("registration", R.registration, f"CASE WHEN {_has('drop-in')} THEN 'drop-in' WHEN {_has('required')} THEN 'required' WHEN {_has('open')} THEN 'open' ELSE 'unknown' END")
_facet("setting", lambda h: R.setting(h, F.lit("Bayfront")), f"CASE WHEN {_has('virtual')} THEN 'virtual' WHEN {_has('outdoor')} THEN 'outdoor' ELSE 'unknown' END")
_facet("access", lambda h: F.array_join(R.access(h), ","), "concat_ws(',', " + ", ".join(f"CASE WHEN {_has(k)} THEN '{k}' END" for k in ("wheelchair", "asl", "sensory-friendly")) + ")")
_facet("alcohol", lambda h: R.alcohol(h, F.lit("")), _has("alcohol"))
_facet("admission", lambda h: R.admission(h, F.array().cast("array<string>")), f"CASE WHEN {_has('public')} THEN 'public' WHEN {_has('restricted')} THEN 'restricted' ELSE 'unknown' END")
_facet("notice", lambda h: R.notice(h, F.array(F.lit("academic calendar"))), _has("notice"))
_facet("rescheduled", R.rescheduled, _has("rescheduled"))
_facet("home_away", lambda h: R.home_away(h, F.lit(True)), f"CASE WHEN {_has('home')} THEN 'home' WHEN {_has('away')} THEN 'away' END")
_facet("classify_vocab", R.type_by_title, sql_first("hay", V.TITLE_PHRASES))
_facet("classify_venue", R.type_by_venue, "CASE " + " ".join(f"WHEN contains(v, {quoted(k)}) THEN {quoted(t)}" for k, t in R.VENUE_NAMES.items()) + f" ELSE {sql_first('v', V.VENUE_PHRASES)} END")
ORACLES["classify_venue"] = ORACLES["classify_venue"].replace(f"FROM {BY_TEXT}", f"FROM (SELECT id, lower(hay) AS v FROM {BY_TEXT})")


# categories as publishers write them, and the type of each in the twin
CATEGORIES = [("music", "live-music"), ("art &amp; culture", None), ("Concerts ", "live-music"), ("Athletics", "sports"), ("Food & Drink", "food-drink"), ("", None), ("x", None), ("Government", "meeting"), ("classes", "class")]


@query(f"""SELECT c_custkey, coalesce(a.type, b.type) AS type FROM customer JOIN {sql_values('i, s, type', [(i, *c) for i, c in enumerate(CATEGORIES)])} ON t.i = c_custkey % 9
JOIN {sql_values('i, s, type', [(i, *c) for i, c in enumerate(CATEGORIES)]).replace(' AS t(', ' AS b(')} ON b.i = c_custkey // 9 % 9""".replace("coalesce(a.type", "coalesce(t.type"))
def classify_category(spark, sf_dir):
    """Every customer's segment, and two categories dealt by the key."""
    listed = F.array(*[F.lit(c) for c, _ in CATEGORIES])
    at = lambda c: F.get(listed, (c % 9).cast("int"))
    cats = F.array(F.col("c_mktsegment"), at(F.col("c_custkey")), at(F.floor(F.col("c_custkey") / 9)))
    return table(spark, sf_dir, "customer").select("c_custkey", R.type_by_category(cats).alias("type"))


@query(LISTINGS + f"SELECT ord, coalesce({sql_first('title', V.TITLE_PHRASES)}, {sql_first('lower(venue)', V.VENUE_PHRASES)}, 'community') AS type FROM listings")
def classify_composite(spark, sf_dir):
    return listings(spark, sf_dir).select("ord", R.event_type(F.col("title"), F.array().cast("array<string>"), F.col("venue")).alias("type"))


# towns and states as events state them, and how far they are
TOWNS = [("Duluth", "MN", "duluth"), ("Superior", "WI", "twin-ports"), ("rice lake", "WI", "twin-ports"), ("Two Harbors", "MN", "regional"), ("Ely", "ZZ", "regional"), ("Fargo", "ND", "distant"), ("Madison", "WI", "regional"), ("DULUTH ", "MN", "duluth"), ("", None, "distant"), ("Duluth Township", "MN", "twin-ports")]


@query(f"SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN 'virtual' WHEN i = 9 AND c_custkey // 10 % 2 = 0 THEN CASE r_name WHEN 'ASIA' THEN 'regional' ELSE 'distant' END ELSE scope END AS scope FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN {sql_values('i, scope', [(i, t[2]) for i, t in enumerate(TOWNS)])} ON i = c_custkey % 10")
def geo_scope(spark, sf_dir):
    """Every customer in a town dealt by the key, or in its nation in a state by its region."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    at, abroad = (F.col("c_custkey") % 10).cast("int"), (F.col("c_custkey") % 10 == 9) & (F.floor(F.col("c_custkey") / 10) % 2 == 0)
    city = F.when(abroad, F.col("n_name")).otherwise(F.get(F.array(*[F.lit(t) for t, _, _ in TOWNS]), at))
    state = F.when(abroad, F.when(F.col("r_name") == "ASIA", "MN").otherwise("ZZ")).otherwise(F.get(F.array(*[F.lit(x) for _, x, _ in TOWNS]), at))
    return c.select("c_custkey", R.geo_scope(city, state, F.when(F.col("c_custkey") % 13 == 0, "virtual").otherwise("unknown")).alias("scope"))


def faceted(spark, sf_dir) -> DataFrame:
    """Listings with the facet columns that filters read."""
    none, title = F.array().cast("array<string>"), F.col("title")
    x = listings(spark, sf_dir)
    return x.withColumns({
        "audience": F.when(F.col("ord") % 5 == 0, F.array(F.lit("kids"))).when(F.col("ord") % 5 == 1, F.array(F.lit("adults-only"), F.lit("teen"))).when(F.col("ord") % 5 == 2, F.array(F.lit("all-ages"))),
        "access": F.when(F.col("ord") % 4 == 0, F.array(F.lit("wheelchair"), F.lit("asl"))).when(F.col("ord") % 4 == 1, F.array(F.lit("asl"))).otherwise(none),
        "cost_tier": F.when(F.col("price") < 20, "free").when(F.col("price") < 30, "donation").otherwise("paid"), "registration": R.registration(title), "setting": R.setting(title, F.col("venue")),
        "geo_scope": F.when(F.col("region") == "ASIA", "duluth").when(F.col("region") == "EUROPE", "twin-ports").otherwise("distant"), "time_of_day": X.time_of_day(F.col("start_ts").cast("timestamp"), F.lit(False)),
        "public_admission": F.when(F.col("ord") % 3 == 0, "public").otherwise("unknown"), "multi_day": F.to_date("start_ts") != F.to_date("end_ts"), "in_duluth": F.col("region") == "ASIA", "weekend": X.is_weekend(F.col("start_ts").cast("timestamp")),
        "recurring": F.col("ord") % 9 == 0, "alcohol": F.col("ord") % 8 == 0, "institutional_notice": F.col("ord") % 10 == 0, "home_away": F.when(F.col("ord") % 6 == 0, "home").when(F.col("ord") % 6 == 1, "away"),
        "also": F.when(F.col("ord") % 7 == 0, F.array(F.lit("other"))).otherwise(none), "event_type": F.when(F.col("event_type") == "click", "live-music").when(F.col("event_type") == "view", "class").when(F.col("event_type") == "purchase", "sports").otherwise("community"),
    })


FACETED = LISTINGS + f""", f AS (SELECT * EXCLUDE (event_type), CASE event_type WHEN 'click' THEN 'live-music' WHEN 'view' THEN 'class' WHEN 'purchase' THEN 'sports' ELSE 'community' END AS event_type,
  CASE ord % 5 WHEN 0 THEN ['kids'] WHEN 1 THEN ['adults-only', 'teen'] WHEN 2 THEN ['all-ages'] ELSE [] END AS audience, CASE ord % 4 WHEN 0 THEN ['wheelchair', 'asl'] WHEN 1 THEN ['asl'] ELSE [] END AS access,
  CASE WHEN price < 20 THEN 'free' WHEN price < 30 THEN 'donation' ELSE 'paid' END AS cost_tier, CASE region WHEN 'ASIA' THEN 'duluth' WHEN 'EUROPE' THEN 'twin-ports' ELSE 'distant' END AS geo_scope,
  CAST(start_ts AS DATE) <> CAST(end_ts AS DATE) AS multi_day, dayofweek({_LOCAL.replace('ts)', 'start_ts)')}) IN (0, 6) AS weekend, hour({_LOCAL.replace('ts)', 'start_ts)')}) AS h, ord % 10 = 0 AS notice,
  CASE ord % 6 WHEN 0 THEN 'home' WHEN 1 THEN 'away' END AS home_away FROM listings)
"""


def _filter(name: str, params: dict, where: str, exclude: tuple = ()) -> None:
    def run(spark, sf_dir):
        f = filters.parse(params)
        f.exclude_audience = list(exclude)
        return faceted(spark, sf_dir).filter(filters.predicate(f)).select("ord", "source", "title")

    run.__name__ = name
    query(FACETED + f"SELECT ord, source, title FROM f WHERE {where}")(run)


_filter("filter_types_conf", {"type": "live-music, class, nonsense", "confidence": "high,medium"}, "event_type IN ('live-music', 'class') AND confidence IN ('high', 'medium')")
_filter("filter_source_substr", {"sources": "rc1,SRC3"}, "contains(source, 'rc1') OR contains(source, 'src3')")
_filter("filter_access_all", {"access": "wheelchair,asl"}, "list_has_all(access, ['wheelchair', 'asl'])")
_filter("filter_exclude_audience", {"cost": "free,donation"}, "cost_tier IN ('free', 'donation') AND NOT list_has_any(audience, ['adults-only'])", ("adults-only",))
_filter("filter_corroborated", {"corroborated": "true", "weekend": "yes"}, "ord % 7 = 0 AND weekend")
_filter("filter_nullsafe", {"homeAway": "home", "notices": "no", "multiDay": ""}, "home_away = 'home' AND NOT notice AND NOT multi_day")
_filter("filter_place", {"place": "p3", "audience": "kids,all-ages", "geo": "duluth,twin-ports,distant"}, "place_id = 'p3' AND list_has_any(audience, ['kids', 'all-ages'])")
_filter("filter_in_duluth", {"induluth": "1", "alcohol": "no", "recurring": "false", "admission": "public,restricted"}, "coalesce(region = 'ASIA', false) AND ord % 8 <> 0 AND ord % 9 <> 0 AND ord % 3 = 0")
_filter("filter_time", {"time": "evening,late-night", "type": "nonsense"}, "h >= 17 OR h < 5")


_REGISTRATION = "CASE " + " ".join(f"WHEN {sql_has('title', k)} THEN '{k}'" for k in ("drop-in", "required", "open")) + " ELSE 'unknown' END"
_SETTING = f"CASE WHEN {sql_has('venue', 'virtual')} OR {sql_has('title', 'virtual')} THEN 'virtual' WHEN {sql_has('title', 'outdoor')} OR {sql_has('venue', 'outdoor venue')} THEN 'outdoor' ELSE 'unknown' END"
SPECS = {
    "all": "NOT notice", "weekend": "weekend AND NOT notice", "family": "list_has_any(audience, ['all-ages', 'kids'])", "free": "cost_tier = 'free'", "live-music": "event_type = 'live-music' AND NOT notice", "class": "event_type = 'class' AND NOT notice",
    "music-no-age-limit": "event_type = 'live-music' AND NOT list_contains(audience, 'adults-only')", "accessible": "list_contains(access, 'wheelchair')", "free-family": "cost_tier = 'free' AND list_has_any(audience, ['all-ages', 'kids'])",
    "evenings": "h >= 17 AND h < 21 AND NOT notice", "late-night": "h >= 21 OR h < 5", "daytime": "h >= 5 AND h < 17 AND NOT notice", "recurring": "ord % 9 = 0", "multi-day": "multi_day", "single-day": "NOT multi_day", "duluth-proper": "geo_scope = 'duluth'",
    "twin-ports": "geo_scope IN ('duluth', 'twin-ports')", "home-games": "event_type = 'sports' AND home_away = 'home'", **{k: f"event_type = '{k}' AND NOT notice" for k in ("performing-arts", "film", "visual-arts", "meeting", "market", "festival", "sports", "food-drink", "education", "community")}, "conventions": "event_type = 'convention'",
    **{k: f"list_contains(audience, '{k}')" for k in ("kids", "teen", "adults-only", "seniors")}, **{k: f"list_contains(access, '{k}')" for k in ("asl", "sensory-friendly")},
    "drop-in": f"{_REGISTRATION} = 'drop-in'", "registration-required": f"{_REGISTRATION} = 'required'", "outdoor": f"{_SETTING} = 'outdoor'", "virtual": f"{_SETTING} = 'virtual'", "free-outdoor": f"cost_tier = 'free' AND {_SETTING} = 'outdoor'",
    "open-to-public": "ord % 3 = 0", "classes-single-day": "event_type = 'class' AND NOT multi_day", "high-confidence": "confidence = 'high'", "corroborated": "ord % 7 = 0", "notices": "notice",
}


@query(FACETED + " UNION ALL ".join(f"SELECT '{k}' AS file, count(*) AS n FROM f WHERE {w} HAVING count(*) > 0" for k, w in SPECS.items()))
def spec_counts_single_pass(spark, sf_dir):
    return filters.tag(faceted(spark, sf_dir)).groupBy("file").agg(F.count("*").alias("n"))


@query(FACETED + "SELECT cost_tier, geo_scope, source, count(*) AS n FROM f GROUP BY ALL")
def facets_group_counts(spark, sf_dir):
    return faceted(spark, sf_dir).groupBy("cost_tier", "geo_scope", "source").agg(F.count("*").alias("n"))


@query(LISTINGS + "SELECT * FROM (SELECT region, venue, n, row_number() OVER (PARTITION BY region ORDER BY n DESC, venue) AS rank FROM (SELECT region, venue, count(*) AS n FROM listings GROUP BY ALL)) WHERE rank <= 15")
def top15_per_group(spark, sf_dir):
    counts = listings(spark, sf_dir).groupBy("region", "venue").agg(F.count("*").alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy("region").orderBy(F.desc("n"), "venue"))).filter("rank <= 15")


# constraints


@query("SELECT count(*) FILTER (ok) AS n_valid, count(*) FILTER (NOT ok) AS n_refused FROM (SELECT (user_id % 3 = 0 AND user_id % 2 = 0) OR (user_id % 2 = 1 AND user_id % 3 <= 1) AS ok FROM events)")
def confidence_ceiling(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.when(F.col("user_id") % 2 == 0, "ics-import").otherwise("structured-api").alias("m"), F.when(F.col("user_id") % 3 == 0, "high").when(F.col("user_id") % 3 == 1, "medium").otherwise("low").alias("c"))
    ok = constraints.confidence_allowed(F.col("m"), F.col("c"))
    return e.agg(F.count_if(ok).alias("n_valid"), F.count_if(~ok).alias("n_refused"))


@query(LISTINGS + "SELECT count(*) FILTER (end_ts >= start_ts + INTERVAL 1 HOUR) AS n_valid, count(*) FILTER (end_ts < start_ts + INTERVAL 1 HOUR) AS n_refused FROM listings")
def end_after_start(spark, sf_dir):
    ok = constraints.end_after_start(F.col("start_ts") + F.expr("INTERVAL 1 HOUR"), F.col("end_ts"))
    return listings(spark, sf_dir).agg(F.count_if(ok).alias("n_valid"), F.count_if(~ok).alias("n_refused"))


@query("SELECT p_partkey FROM part WHERE NOT (p_retailprice >= 0 AND p_size * 40 >= p_retailprice)")
def price_order(spark, sf_dir):
    _, refused = constraints.split_valid(table(spark, sf_dir, "part"), {"price": constraints.price_order(F.col("p_retailprice"), (F.col("p_size") * 40).cast("double"))})
    return refused.select("p_partkey")


@query("SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1")
def dup_key_check(spark, sf_dir):
    return constraints.unique_key(table(spark, sf_dir, "orders"), "o_custkey")


@query("SELECT max(o_orderdate) AS watermark, count(*) AS n FROM orders")
def watermark_max(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(F.max("o_orderdate").alias("watermark"), F.count("*").alias("n"))


# places


def nation_registry(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("name"), F.array(F.concat(F.lit("The "), F.col("n_name"))).alias("name_aliases"), F.array(F.concat_ws(" ", F.lit("1"), F.col("n_name"), F.lit("Street"))).alias("address_aliases"))


def venue_events(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey") % 6
    raw = F.when(k == 0, F.col("n_name")).when(k == 1, F.concat(F.lit("1 "), F.col("n_name"), F.lit(" Street"))).when(k == 2, F.lit("TBD")).when(k == 3, F.concat(F.lit("Hall "), (F.col("c_custkey") % 11).cast("string"), F.lit(" Inc"))).when(k == 4, F.lit("Duluth, MN")).otherwise(F.concat(F.lit("the "), F.lower("n_name"), F.lit(" co")))
    return c.select("c_custkey", "n_nationkey", raw.alias("venue_raw"), F.lit("Duluth").alias("city"))


_OUT = "CASE c_custkey % 6 WHEN 2 THEN 'sentinel' WHEN 3 THEN 'provisional' WHEN 4 THEN 'city-only' ELSE 'registered' END"


@query(f"SELECT c_custkey, CASE {_OUT} WHEN 'registered' THEN 'n' || c_nationkey WHEN 'provisional' THEN '~hall-' || (c_custkey % 11) END AS place_id, {_OUT} AS outcome FROM customer JOIN nation ON c_nationkey = n_nationkey")
def resolve_name_then_address(spark, sf_dir):
    return places.resolve(venue_events(spark, sf_dir), places.alias_table(nation_registry(spark, sf_dir))).select("c_custkey", "place_id", "outcome")


@query(f"SELECT outcome, count(*) AS n FROM (SELECT {_OUT} AS outcome FROM customer) GROUP BY 1")
def resolve_fallback(spark, sf_dir):
    return places.resolve(venue_events(spark, sf_dir), places.alias_table(nation_registry(spark, sf_dir))).groupBy("outcome").agg(F.count("*").alias("n"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE coalesce(n_name, s_name) END AS street FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def enrich_coalesce(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("place_id"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).alias("street"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("street"))
    return places.enrich(s, n, ["street"]).select("s_suppkey", "street")


@query(f"SELECT key, count(DISTINCT p_partkey) AS n_places FROM (SELECT p_partkey, {sql_key('p_name')} AS key FROM part) GROUP BY 1 HAVING count(DISTINCT p_partkey) > 1")
def alias_conflicts(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.lit(None).cast("array<string>").alias("name_aliases"), F.lit(None).cast("array<string>").alias("address_aliases"))
    return places.alias_conflicts(places.alias_table(p)).select("key", "n_places")


@query("SELECT n_nationkey AS place_id, n_name AS name, count(c_custkey) AS n FROM nation LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 9000) ON c_nationkey = n_nationkey GROUP BY ALL")
def venue_directory_zero_fill(spark, sf_dir):
    counts = table(spark, sf_dir, "customer").filter("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("place_id")).agg(F.count("*").alias("n"))
    return emit.directory(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("place_id"), F.col("n_name").alias("name")), counts)


# finalisation: whole documents as events at nations' venues


def document_events(spark, sf_dir) -> DataFrame:
    """An event per document: its whole text is the title, its venue a nation said in five ways, its start an hour of 2024."""
    d = table(spark, sf_dir, "documents").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("doc_id") % 25 == F.col("n_nationkey"), "left")
    k = F.floor(F.col("doc_id") / 25) % 5
    venue = F.when(k == 0, F.col("n_name")).when(k == 1, F.concat(F.lit("Houghton, Mich., "), "n_name")).when(k == 2, "TBD").when(k == 3, F.concat(F.lit("Tavern "), (F.col("doc_id") % 11).cast("string"), F.lit(" Inc")))
    start = F.timestamp_add("HOUR", F.col("doc_id") % 8000, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    row = mappers.canonical(
        d, native_id=F.col("doc_id").cast("string"), title=F.col("text"), start_ts=start, end_ts=F.timestamp_add("HOUR", F.col("doc_id") % 5, start), venue_raw=venue,
        rrule=F.when(F.col("doc_id") % 9 == 0, "FREQ=WEEKLY"), categories=F.when(F.col("doc_id") % 10 == 0, F.array(F.lit("academic calendar"))).otherwise(F.array().cast("array<string>")), cost=F.struct(F.when(F.col("doc_id") % 6 == 0, "free").otherwise("unknown").alias("kind")),
    )
    return row


def finalized(spark, sf_dir) -> DataFrame:
    return finalize.finalize(document_events(spark, sf_dir), nation_registry(spark, sf_dir))


_HOUR = "timezone('America/Chicago', timezone('UTC', TIMESTAMP '2024-01-01' + to_hours(CAST(doc_id % 8000 AS INTEGER))))"
_ENDS = "timezone('America/Chicago', timezone('UTC', TIMESTAMP '2024-01-01' + to_hours(CAST(doc_id % 8000 + doc_id % 5 AS INTEGER))))"
_SPOT = "coalesce(spot, '')"
FINAL = f"""WITH e AS (SELECT doc_id, text AS hay, n_name, doc_id // 25 % 5 AS k, CASE doc_id // 25 % 5 WHEN 0 THEN n_name WHEN 1 THEN 'Houghton, Mich., ' || n_name WHEN 2 THEN 'TBD' WHEN 3 THEN 'Tavern ' || (doc_id % 11) || ' Inc' END AS venue FROM documents LEFT JOIN nation ON doc_id % 25 = n_nationkey),
t AS (SELECT *, CASE k WHEN 1 THEN 'Houghton' ELSE 'Duluth' END AS city, CASE k WHEN 1 THEN 'MI' ELSE 'MN' END AS state, CASE WHEN k <= 1 THEN 'n' || (doc_id % 25) WHEN k = 3 THEN '~tavern-' || (doc_id % 11) END AS place_id,
  CASE WHEN k <= 1 THEN n_name ELSE venue END AS spot FROM {sql_ages('e')}),
u AS (SELECT *, coalesce({sql_first('hay', V.TITLE_PHRASES)}, {sql_first(f'lower({_SPOT})', V.VENUE_PHRASES)}, 'community') AS event_type, CASE WHEN {_has('virtual')} THEN 'virtual' WHEN {_has('outdoor')} OR {sql_has('venue', 'outdoor venue')} THEN 'outdoor' ELSE 'unknown' END AS setting, {_AUD} AS a0 FROM t),
v AS (SELECT *, CASE WHEN list_contains(a0, 'adults-only') THEN list_filter(a0, lambda x: x <> 'all-ages') ELSE a0 END AS a1 FROM u),
final AS (SELECT doc_id, place_id, city, state, event_type, setting, lo AS min_age, hi AS max_age, coalesce(array_to_string(list_sort(a1), ','), '') AS audience, CASE WHEN lo IS NULL AND hi IS NULL AND list_contains(a1, 'all-ages') THEN true WHEN lo IS NOT NULL OR hi IS NOT NULL THEN false END AS all_ages,
  CASE WHEN doc_id % 6 = 0 THEN 'free' WHEN {_has('donation')} THEN 'donation' WHEN regexp_matches(hay, '\\$\\s?\\d') THEN 'paid' WHEN {_has('free')} THEN 'free' ELSE 'unknown' END AS cost_tier,
  CASE WHEN {_has('drop-in')} THEN 'drop-in' WHEN {_has('required')} THEN 'required' WHEN {_has('open')} THEN 'open' ELSE 'unknown' END AS registration,
  CASE WHEN setting = 'virtual' THEN 'virtual' WHEN city = 'Duluth' THEN 'duluth' ELSE 'distant' END AS geo_scope, city = 'Duluth' AS in_duluth, doc_id % 9 = 0 AS recurring,
  CASE WHEN hour({_HOUR}) >= 21 OR hour({_HOUR}) < 5 THEN 'late-night' WHEN hour({_HOUR}) < 12 THEN 'morning' WHEN hour({_HOUR}) < 17 THEN 'afternoon' ELSE 'evening' END AS time_of_day, dayofweek({_HOUR}) IN (0, 6) AS weekend, CAST({_HOUR} AS DATE) <> CAST({_ENDS} AS DATE) AS multi_day,
  {_has('alcohol')} OR coalesce({sql_has('venue', 'alcohol')}, false) AS alcohol, CASE WHEN {_has('public')} THEN 'public' WHEN {_has('restricted')} THEN 'restricted' ELSE 'unknown' END AS public_admission,
  CASE WHEN event_type <> 'sports' THEN NULL WHEN {_has('home')} THEN 'home' WHEN {_has('away')} THEN 'away' END AS home_away, CASE WHEN {_has('rescheduled')} THEN 'tentative' ELSE 'confirmed' END AS status, doc_id % 10 = 0 AND {_has('notice')} AS institutional_notice,
  concat_ws(',', {", ".join(f"CASE WHEN {_has(k)} THEN '{k}' END" for k in ("wheelchair", "asl", "sensory-friendly"))}) AS access FROM v)
"""
_FINAL_COLUMNS = "place_id city state event_type setting cost_tier registration geo_scope in_duluth recurring time_of_day weekend multi_day alcohol public_admission home_away status institutional_notice".split()


@query(FINAL + f"SELECT doc_id, {', '.join(_FINAL_COLUMNS)}, audience, min_age, max_age, all_ages FROM final")
def finalize_events(spark, sf_dir):
    x = finalized(spark, sf_dir)
    return x.select(F.col("native_id").cast("long").alias("doc_id"), *_FINAL_COLUMNS, F.array_join(F.array_sort("audience"), ",").alias("audience"), "age.min_age", "age.max_age", "age.all_ages")


# what the saved filters ask of finalised documents
_REAL = FINAL + ", real AS (SELECT * EXCLUDE (audience, access), string_split(audience, ',') AS audience, string_split(access, ',') AS access FROM final)"


def _real(where: str) -> str:
    said = {_REGISTRATION: "registration", _SETTING: "setting", "ord % 9 = 0": "recurring", "ord % 3 = 0": "public_admission = 'public'", "ord % 7 = 0": "false", "confidence = 'high'": "true", "h >= 17 AND h < 21": "time_of_day = 'evening'", "h >= 21 OR h < 5": "time_of_day = 'late-night'", "h >= 5 AND h < 17": "time_of_day IN ('morning', 'afternoon')", "notice": "institutional_notice"}
    for old, new in said.items():
        where = where.replace(old, new)
    return where


_REAL_COUNTS = " UNION ALL ".join([f"SELECT '{k}' AS file, count(*) AS n FROM real WHERE {_real(w)}" for k, w in SPECS.items()] + ["SELECT 'place/n' || n_nationkey, count(doc_id) FROM nation LEFT JOIN real ON place_id = 'n' || n_nationkey GROUP BY 1"])


def real_events(spark, sf_dir) -> DataFrame:
    return finalized(spark, sf_dir).withColumns({"uid": F.col("native_id"), "also": F.array().cast("array<string>"), "confidence": F.lit("high"), "source": F.lit("documents")})


def all_filters(spark, sf_dir) -> DataFrame:
    return feeds.filters_of(spark, filters.SAVED).union(feeds.place_filters(nation_registry(spark, sf_dir)))


@query(_REAL + _REAL_COUNTS)
def filters_on_real_facets(spark, sf_dir):
    """All saved queries and one for every place, over the derived facets of every document."""
    return feeds.member_counts(real_events(spark, sf_dir), all_filters(spark, sf_dir))


def _vevents(events: DataFrame, uid) -> DataFrame:
    rows = events.select(uid.alias("uid"), "title", "start_ts", "end_ts", F.lit(False).alias("all_day"), emit.description(F.lit(""), [("Source", F.col("source"))]).alias("description"), F.col("venue").alias("location"), F.array("event_type").alias("categories"), F.lit("confirmed").alias("status"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("rrule"), F.lit("").alias("x"))
    return emit.vevent(rows)


@query(FACETED + f"""SELECT file, title, count(*) AS n FROM ({' UNION ALL '.join(f"SELECT '{k}' AS file, title FROM f WHERE {w}" for k, w in SPECS.items())} UNION ALL SELECT 'place/' || place_id, title FROM f WHERE place_id IS NOT NULL) GROUP BY ALL""")
def feeds_in_one_job(spark, sf_dir):
    """All calendars of all events and places written in one job, read again, and their titles counted by calendar."""
    events = faceted(spark, sf_dir).withColumn("uid", F.col("ord").cast("string"))
    places_ = events.filter("place_id IS NOT NULL").select(F.col("place_id").alias("id")).distinct()
    every = feeds.filters_of(spark, filters.SAVED).union(feeds.place_filters(places_))
    path = shared.shared_path(spark, "feeds")
    feeds.write_feeds(feeds.members(events, every), _vevents(events, F.col("uid")), every.select("file", F.col("file").alias("name"), F.lit("Events").alias("about")), path, compression="gzip")
    again = readers.read_ics(spark, f"{path}/*/*", parts=True)
    name = F.url_decode(F.regexp_extract("file", "feed=([^/]*)/", 1))
    # a path is a link: its escapes are decoded once by the link and once by the folder
    return again.select(F.url_decode(name).alias("file"), T.unescape_ics(F.col("props")["SUMMARY"]).alias("title")).groupBy("file", "title").agg(F.count("*").alias("n"))


_CUSTOMER_FILTER = """(c_nationkey = 0 OR place_id = 'p' || c_nationkey) AND (c_custkey % 3 = 2 OR list_has_any(audience, CASE c_custkey % 3 WHEN 0 THEN ['kids', 'all-ages'] ELSE ['teen'] END))
 AND (c_custkey % 4 <> 0 OR list_has_all(access, ['wheelchair', 'asl'])) AND (c_custkey % 2 = 1 OR weekend = (c_custkey % 7 <> 0)) AND (c_custkey % 5 <> 0 OR NOT list_contains(audience, 'adults-only')) AND (c_custkey % 11 <> 0 OR contains(source, 'rc' || (c_custkey % 8)))"""


@query(FACETED + f"SELECT 'c' || c_custkey AS file, count(*) AS n FROM customer JOIN f ON {_CUSTOMER_FILTER} GROUP BY 1")
def predicate_index(spark, sf_dir):
    """A saved filter for every customer, over all events."""
    k = F.col("c_custkey")
    need = lambda held, *of: F.when(held, F.array(*[F.lit(x) if isinstance(x, str) else x for x in of]))
    needs = F.array_compact(F.array(
        need(F.col("c_nationkey") != 0, F.concat(F.lit("placeId=p"), F.col("c_nationkey").cast("string"))), need(k % 3 == 0, "audience=kids", "audience=all-ages"), need(k % 3 == 1, "audience=teen"), need(k % 4 == 0, "access=wheelchair"), need(k % 4 == 0, "access=asl"),
        need(k % 2 == 0, F.concat(F.lit("weekend="), (k % 7 != 0).cast("string"))), need(k % 11 == 0, F.concat(F.lit("source~rc"), (k % 8).cast("string"))),
    ))
    needs = F.when(F.size(needs) > 0, needs).otherwise(F.array(F.array(F.lit(feeds.ANY))))
    bars = F.when(k % 5 == 0, F.array(F.lit("audience=adults-only"))).otherwise(F.array().cast("array<string>"))
    saved = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), k.cast("string")).alias("file"), needs.alias("needs"), bars.alias("bars"))
    return feeds.member_counts(faceted(spark, sf_dir), saved).filter("n > 0")


ZONES = [("America/Chicago", "America/Chicago"), ("UTC+0", None), ("Europe/Paris", "Europe/Paris"), ("", None), (None, None), ("UTC", "UTC"), ("Mars/Olympus", None), ("-05:00", None), ("europe/paris", "Europe/Paris"), ("AMERICA/NEW_YORK", "America/New_York")]


@query(f"SELECT c_custkey, coalesce(named, 'America/Chicago') AS zone FROM customer JOIN {sql_values('i, said, named', [(i, *z) for i, z in enumerate(ZONES)])} ON i = c_custkey % {len(ZONES)}")
def safe_timezone(spark, sf_dir):
    """Every customer's zone, dealt by the key."""
    said = F.get(F.array(*[F.lit(z) for z, _ in ZONES]), (F.col("c_custkey") % len(ZONES)).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", X.safe_timezone(said).alias("zone"))


# reports


@query(LISTINGS + "SELECT 'source' AS kind, source AS name, count(*) AS n FROM listings GROUP BY 2 UNION ALL SELECT 'fetched', '', count(*) FROM listings UNION ALL SELECT 'merged', '', count(DISTINCT (source, day)) FROM listings UNION ALL SELECT 'failed', 'src9', 1")
def run_counts(spark, sf_dir):
    x = listings(spark, sf_dir)
    return reports.run_counts(x, x.select("source", "day").distinct(), [("src9", "no answer")])


@query("""SELECT 'source' AS kind, 'customers' AS name, count(*) AS n FROM customer UNION ALL SELECT 'source', 'suppliers', count(*) FROM supplier UNION ALL SELECT 'fetched', '', (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier)
UNION ALL SELECT 'merged', '', count(*) FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL SELECT 'failed', 'broken rows', 1 UNION ALL SELECT 'failed', 'no such column', 1""")
def collected_sources(spark, sf_dir):
    """Two sources that give rows, one that fails when it is planned, one that fails at a row, one that is not enabled."""
    read = {
        "customers": lambda s, _: table(s, sf_dir, "customer").select(F.col("c_name").alias("title"), F.col("c_nationkey").alias("place")), "suppliers": lambda s, _: table(s, sf_dir, "supplier").select(F.col("s_name").alias("title"), F.col("s_nationkey").alias("place")),
        "unplanned": lambda s, _: table(s, sf_dir, "supplier").select("no_such_column"), "broken": lambda s, _: table(s, sf_dir, "supplier").select(F.when(F.col("s_suppkey") >= 0, F.raise_error(F.lit("broken"))).cast("string").alias("title")),
    }
    sources = [{"name": n, "kind": k, "enabled": on} for n, k, on in (("customers", "customers", True), ("broken rows", "broken", True), ("suppliers", "suppliers", True), ("no such column", "unplanned", True), ("off", "customers", False))]
    run = readers.dispatch(spark, sources, read)
    return reports.collected_counts(run.counts, run.failures, run.rows.select("place").distinct())


@query(FACETED + f"SELECT ord, t AS event_type, (SELECT count(*) FROM f WHERE event_type = t) AS n FROM {sql_values('ord, t', list(enumerate(filters.VOCABULARY['types'])))}")
def types_endpoint(spark, sf_dir):
    return reports.types(faceted(spark, sf_dir))


@query(LISTINGS + "SELECT source, n, row_number() OVER (ORDER BY n DESC, source) AS rank FROM (SELECT source, count(*) AS n FROM listings GROUP BY 1)")
def sources_ranked(spark, sf_dir):
    return reports.ranked(reports.sources(listings(spark, sf_dir)), "n", "source")


@query(FACETED + "SELECT ord FROM f WHERE event_type IN ('sports', 'class') AND NOT multi_day AND contains(source, 'src1')")
def feed_endpoint(spark, sf_dir):
    return reports.feed(faceted(spark, sf_dir), {"type": "sports,class", "multiDay": "false", "source": "src1"}).select("ord")


def _venue_claims(spark, sf_dir):
    return venue_events(spark, sf_dir).withColumns({"ord": F.col("c_custkey"), "state": F.lit("MN")})


_CLAIMS = f"""(SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN n_name WHEN 1 THEN '1 ' || n_name || ' Street' WHEN 3 THEN 'Hall ' || (c_custkey % 11) || ' Inc' WHEN 4 THEN 'Duluth' ELSE 'the ' || lower(n_name) || ' co' END AS raw,
  CASE c_custkey % 6 WHEN 4 THEN 'city' ELSE 'venue' END AS kind FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 6 <> 2)"""


@query(f"""SELECT key, kind, count(*) AS n, CASE WHEN kind = 'city' THEN 'Duluth' ELSE arg_max(raw, c_custkey) END AS raw, 'Duluth' AS city, 'MN' AS state FROM (SELECT c_custkey, raw, kind, {sql_key('raw')} AS key FROM {_CLAIMS}) GROUP BY key, kind""")
def unresolved_tally(spark, sf_dir):
    return reports.unresolved(_venue_claims(spark, sf_dir)).select("key", "kind", "n", "raw", "city", "state")


def _proposals(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("target"), T.short_slug(F.col("p_name")).alias("id"), F.col("p_size").cast("long").alias("n"), matching.verdict(F.when(F.col("p_size") > 5, F.col("p_size") / 50), F.col("p_partkey") % 4 == 0).alias("verdict"))


@query("SELECT verdict, count(*) AS n_targets, sum(p_size) AS n_events FROM (SELECT p_size, CASE WHEN p_size <= 5 THEN 'none' WHEN p_size / 50.0 >= 0.5 AND p_partkey % 4 <> 0 THEN 'strong' ELSE 'weak' END AS verdict FROM part) GROUP BY 1")
def proposal_verdicts(spark, sf_dir):
    return reports.proposal_verdicts(_proposals(spark, sf_dir))


@query(f"SELECT id, count(DISTINCT p_partkey) AS n_targets, sum(p_size) AS n_events FROM (SELECT p_partkey, p_size, regexp_replace(substr(replace({sql_key('p_name')}, ' ', '-'), 1, 48), '-+$', '') AS id FROM part) GROUP BY 1 HAVING count(DISTINCT p_partkey) > 1")
def colliding_ids(spark, sf_dir):
    return reports.colliding_ids(_proposals(spark, sf_dir))


GAZETTEER_KINDS = ["brewery", "park", "stadium_arena", "church_house_of_worship", "bakery"]
_KIND = "CASE s_suppkey % 5 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(GAZETTEER_KINDS)) + " END"


@query(f"""SELECT outcome, CASE WHEN outcome = 'unmapped' THEN category END AS category, count(*) AS n_venues, sum(n) AS n_events FROM (SELECT s_nationkey AS n, category, CASE WHEN s_suppkey % 7 = 0 THEN 'no match' WHEN category IN ('park', 'bakery') THEN 'unmapped' WHEN category = 'church_house_of_worship' THEN 'same' ELSE 'changed' END AS outcome
FROM (SELECT *, {_KIND} AS category FROM supplier)) GROUP BY ALL""")
def gazetteer_what_if(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("venue"), F.col("s_nationkey").cast("long").alias("n"))
    kinds = F.get(F.array(*[F.lit(k) for k in GAZETTEER_KINDS]), F.col("key") % 5)
    return reports.what_if(s, s.filter("key % 7 != 0").select("key", kinds.alias("category")))


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, coalesce(CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 10 / 10.0 END, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0.5 END), o_orderpriority, o_orderkey) AS rank FROM orders")
def risk_ranking(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumns({"provisional": F.col("o_orderstatus") == "F", "similarity": F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey") % 10 / 10), "by_title": F.col("o_orderkey") % 2 == 0, "title": F.col("o_orderpriority")})
    return o.select("o_orderkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy(*reports.risk_order(o), "o_orderkey")).alias("rank"))


@query("""SELECT id, use, allowed, CASE lower(season) WHEN 'both' THEN 'summer,winter' WHEN 'none' THEN NULL ELSE lower(season) END AS seasons FROM (SELECT o_orderkey AS id, unnest(['hiking', 'biking']) AS use,
unnest([o_orderstatus IN ('F', 'P'), o_orderstatus IS NOT NULL AND o_orderkey % 3 <> 1]) AS allowed, ['both', 'Winter', 'summer', 'None'][1 + o_custkey % 4] AS season FROM orders)""")
def trail_uses_unpivot(spark, sf_dir):
    """Every order as a trail: its status says whether one may hike, its keys the rest."""
    said = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") == "P", "Yes").otherwise("No").alias("h"), F.when(F.col("o_orderkey") % 3 == 0, "Y").when(F.col("o_orderkey") % 3 == 2, "Yes").alias("b"),
        F.get(F.array(*[F.lit(s) for s in ("both", "Winter", "summer", "None")]), (F.col("o_custkey") % 4).cast("int")).alias("season"),
    )
    return mappers.trail_uses(said, ["h", "b"]).select("id", F.array_join("seasons", ",").alias("seasons"), F.inline("uses"))


TIERS = [("curated", True, (40.0, -95.0, 50.0, -90.0)), ("open", True, (40.0, -95.0, 50.0, -90.0)), ("geocoder", False, (-90.0, -180.0, 90.0, 180.0))]
TIER_TARGETS = [("t0", "green steel", True), ("t1", "small box", False), ("t2", "blue", True), ("t3", "large brass plate", True), ("t4", "no such thing at all", True), ("t5", "gs", False)]


@query()
def tiered_matches(spark, sf_dir):
    """Targets against all parts in three gazetteers; held against brute force in the tests."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("candidate"), F.col("p_name").alias("name"), F.get(F.array(*[F.lit(t[0]) for t in TIERS]), F.col("p_partkey") % 3).alias("tier"), (F.col("p_size") / 10 + 45).alias("lat"), F.lit(-92.0).alias("lon"), (F.col("p_partkey") % 17 == 0).alias("closed"))
    return matching.tiered_matches(values(spark, "target string, name string, is_local boolean", TIER_TARGETS), part, TIERS).withColumn("score", F.round("score", 6))


# dedupe

_TOK = lambda t: f"list_distinct(list_filter(string_split({sql_key(f"replace(strip_accents({t}), 'ß', 'ss')")}, ' '), lambda w: length(w) > 2 AND w NOT IN ({', '.join(map(quoted, T.TITLE_STOP))})))"
_JAC = lambda a, b: f"(CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b})) / CAST(len({a}) + len({b}) - len(list_intersect({a}, {b})) AS DOUBLE) END)"


@query(LISTINGS + "SELECT place_id, instant, count(*) AS n, count(DISTINCT source) AS n_sources FROM listings WHERE place_id IS NOT NULL GROUP BY ALL")
def dedupe_pass1_groups(spark, sf_dir):
    return listings(spark, sf_dir).filter("place_id IS NOT NULL").groupBy("place_id", "instant").agg(F.count("*").alias("n"), F.countDistinct("source").alias("n_sources"))


_RANK = "CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END"


@query(LISTINGS + f"SELECT place_id, instant, arg_min(ord, (4 - {_RANK}) * 1000000000000 + ord) AS ord FROM listings WHERE place_id IS NOT NULL GROUP BY ALL")
def dedupe_primary(spark, sf_dir):
    return dedupe.merge(listings(spark, sf_dir).filter("place_id IS NOT NULL"), ["place_id", "instant"]).select("place_id", "instant", "ord")


@query(LISTINGS + f""", p AS (SELECT *, row_number() OVER (PARTITION BY place_id, instant ORDER BY {_RANK} DESC, ord) AS pos, first_value(source) OVER (PARTITION BY place_id, instant ORDER BY {_RANK} DESC, ord) AS lead FROM listings WHERE place_id IS NOT NULL),
s AS (SELECT place_id, instant, source, min(pos) AS pos FROM p WHERE source <> lead GROUP BY ALL)
SELECT k.place_id, k.instant, coalesce(string_agg(s.source, ',' ORDER BY s.pos), '') AS also FROM (SELECT DISTINCT place_id, instant FROM p) k LEFT JOIN s USING (place_id, instant) GROUP BY ALL""")
def corroborators(spark, sf_dir):
    return dedupe.merge(listings(spark, sf_dir).filter("place_id IS NOT NULL"), ["place_id", "instant"]).select("place_id", "instant", F.array_join("also", ",").alias("also"))


@query(LISTINGS + f""", p AS (SELECT *, {_TOK('title')} AS tk FROM listings WHERE place_id IS NOT NULL),
fold AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY place_id, instant, source, title ORDER BY {_RANK} DESC, ord) AS f FROM p) WHERE f = 1),
sound AS (SELECT place_id, instant FROM fold GROUP BY ALL HAVING count(*) = count(DISTINCT source)),
veto AS (SELECT DISTINCT a.place_id, a.instant FROM fold a JOIN fold b ON a.place_id = b.place_id AND a.instant = b.instant AND a.ord < b.ord WHERE {_JAC('a.tk', 'b.tk')} < 0.15),
agreed AS (SELECT * FROM sound WHERE (place_id, instant) NOT IN (SELECT (place_id, instant) FROM veto))
SELECT ord FROM (SELECT place_id, instant, arg_min(ord, (4 - {_RANK}) * 1000000000000 + ord) AS ord FROM p JOIN agreed USING (place_id, instant) GROUP BY ALL)
UNION ALL SELECT ord FROM p WHERE (place_id, instant) NOT IN (SELECT (place_id, instant) FROM agreed) UNION ALL SELECT ord FROM listings WHERE place_id IS NULL""")
def dedupe_fold_refuse(spark, sf_dir):
    return dedupe.pass_one(listings(spark, sf_dir)).select("ord")


@query()
def dedupe_full(spark, sf_dir):
    return dedupe.dedupe(listings(spark, sf_dir)).select("ord", "source", "title", "place_id", "instant", F.array_join("also", ",").alias("also"))


@query(LISTINGS + ", k AS (SELECT *, day || '|' || title AS key FROM listings), s AS (SELECT key, max(n) > 1 AS series FROM (SELECT key, source, count(DISTINCT instant) AS n FROM k GROUP BY ALL) GROUP BY 1) SELECT key, CASE WHEN series THEN instant END AS split, count(*) AS n FROM k JOIN s USING (key) GROUP BY ALL")
def series_split(spark, sf_dir):
    return dedupe.split_series(listings(spark, sf_dir), F.concat_ws("|", "day", "title")).groupBy("key", "split").agg(F.count("*").alias("n"))


@query("SELECT doc_id, array_to_string(list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')[1:6], ' ') AS tokens FROM documents")
def fuzzy_key_tokens(spark, sf_dir):
    key = T.fuzzy_key(F.lit("d"), F.col("text"), F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", F.split(key, r"\|")[1].alias("tokens"))


@query(f"SELECT a.doc_id, round({_JAC('ta', 'tb')}, 6) AS similarity FROM (SELECT doc_id, {_TOK('text')} AS ta FROM documents) a JOIN (SELECT doc_id, {_TOK('text')} AS tb FROM documents) b ON a.doc_id + 1 = b.doc_id")
def title_jaccard(spark, sf_dir):
    d = shared.kept(table(spark, sf_dir, "documents").select("doc_id", T.title_tokens(F.col("text")).alias("t")), "titles")
    a, b = d.select("doc_id", F.col("t").alias("ta")), d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("t").alias("tb"))
    return a.join(b, "doc_id").select("doc_id", F.round(T.jaccard(F.col("ta"), F.col("tb")), 6).alias("similarity"))


# matching

_PTOK = lambda x: f"list_distinct(list_filter(string_split({sql_key(x)}, ' '), lambda w: w <> ''))"
TARGETS = [("t0", "green steel"), ("t1", "small box"), ("t2", "blue"), ("t3", "large brass plate"), ("t4", "no such thing at all")]
_SCORED = f"""WITH a AS (SELECT target, {_PTOK('name')} AS ta FROM {sql_values('target, name', TARGETS)}), b AS (SELECT p_partkey AS candidate, {_PTOK('p_name')} AS tb FROM part),
s AS (SELECT target, candidate, len(list_intersect(ta, tb)) / CAST(len(ta) + len(tb) - len(list_intersect(ta, tb)) AS DOUBLE) AS score FROM a, b WHERE list_has_any(ta, tb)),
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY score DESC, candidate) AS pos, max(score) OVER (PARTITION BY target) AS top FROM s)
"""


def _best(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("candidate"), F.col("p_name").alias("name"), F.lit(0).alias("tier"))
    return matching.best_matches(values(spark, "target string, name string", TARGETS), part)


@query(_SCORED + "SELECT target, candidate, round(score, 6) AS score FROM r WHERE pos = 1")
def fuzzy_match_topk(spark, sf_dir):
    return _best(spark, sf_dir).select("target", "candidate", F.round("score", 6).alias("score"))


@query(_SCORED + "SELECT target, count(*) > 1 AS tied, CASE WHEN max(score) >= 0.5 AND count(*) = 1 THEN 'strong' ELSE 'weak' END AS verdict FROM r WHERE score = top GROUP BY 1")
def match_tie_flag(spark, sf_dir):
    return _best(spark, sf_dir).select("target", "tied", matching.verdict(F.col("score"), F.col("tied")).alias("verdict"))


_NAMES = f"SELECT DISTINCT p_partkey AS id, {_PTOK("p_name || ' ' || p_type")} AS tx, {_PTOK("p_type || ' ' || p_brand || ' ' || p_name")} AS ty FROM part"


@query(f"""WITH n AS ({_NAMES}), x AS (SELECT DISTINCT list_sort(tx) AS tx FROM n), y AS (SELECT list_sort(ty) AS ty, min(id) AS candidate, count(*) AS alike FROM n GROUP BY 1),
s AS (SELECT tx, candidate, alike, {_JAC('tx', 'ty')} AS score FROM x JOIN y ON list_has_any(tx, ty)), m AS (SELECT tx, max(score) AS top FROM s GROUP BY 1),
b AS (SELECT tx, top, min(candidate) AS candidate, sum(alike) > 1 AS tied FROM s JOIN m USING (tx) WHERE score = top GROUP BY ALL)
SELECT id AS target, candidate, round(top, 6) AS score, tied FROM n JOIN b ON list_sort(n.tx) = b.tx""")
def best_names(spark, sf_dir):
    """Every part's name and type against all parts' types, brands and names, which all hold the word brand."""
    part = table(spark, sf_dir, "part")
    targets = part.select(F.col("p_partkey").alias("target"), F.concat_ws(" ", "p_name", "p_type").alias("name"))
    gazetteer = part.select(F.col("p_partkey").alias("candidate"), F.concat_ws(" ", "p_type", "p_brand", "p_name").alias("name"), F.lit(0).alias("tier"))
    return matching.best_matches(targets, gazetteer).select("target", "candidate", F.round("score", 6).alias("score"), "tied")


@query("SELECT p_partkey, contains(array_to_string(list_transform(string_split(p_name, ' '), lambda w: substr(w, 1, 1)), ''), 'gs') AS acronym FROM part")
def acronym_match(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", matching.is_acronym(F.lit("gs"), F.split("p_name", " ")).alias("acronym"))


_IDS = f"(SELECT id, list_sort({_PTOK('id')}) AS t FROM (SELECT p_name AS id FROM part UNION SELECT p_type || ' ' || p_name FROM part UNION SELECT p_type FROM part))"


@query(f"SELECT DISTINCT least(a.id, b.id) AS a, greatest(a.id, b.id) AS b FROM {_IDS} a JOIN {_IDS} b ON a.id <> b.id AND list_has_all(b.t, a.t) AND len(a.t) > 0 AND (len(a.t) >= 2 OR len(a.t) = len(b.t))")
def token_containment_pairs(spark, sf_dir):
    """Of all names of parts, of types with names, and of types alone."""
    part = table(spark, sf_dir, "part")
    ids = part.select(F.col("p_name").alias("id")).union(part.select(F.concat_ws(" ", "p_type", "p_name"))).union(part.select("p_type")).distinct()
    return matching.containment_pairs(ids)


_NORM = lambda x: f"trim(regexp_replace(lower(regexp_replace({x}, '[/-]', ' ', 'g')), '\\s+', ' ', 'g'))"
_SEGMENTS = """(SELECT s_suppkey AS left_id, CASE s_suppkey % 4 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) || ' / ' || s_name WHEN 2 THEN s_name || '/' || n_name || '/nowhere' ELSE 'the ' || s_name END AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
_WHOLES = "(SELECT 'n' || n_nationkey AS right_id, n_name AS name FROM nation UNION ALL SELECT 's' || s_suppkey, s_name FROM supplier)"


@query(f"""WITH l AS {_SEGMENTS}, r AS (SELECT right_id, {_NORM('name')} AS k FROM {_WHOLES}),
h AS (SELECT left_id, right_id, 0 AS how FROM l JOIN r ON {_NORM('l.name')} = k UNION SELECT left_id, right_id, 1 FROM (SELECT left_id, unnest(string_split(name, '/')) AS p FROM l) JOIN r ON {_NORM('p')} = k),
m AS (SELECT left_id, min(how) AS how FROM h GROUP BY 1)
SELECT l.left_id, coalesce(string_agg(DISTINCT right_id, ',' ORDER BY right_id), '') AS right_ids, CASE m.how WHEN 0 THEN 'whole' WHEN 1 THEN 'segment' ELSE 'none' END AS how FROM l LEFT JOIN m USING (left_id) LEFT JOIN h ON h.left_id = l.left_id AND h.how = m.how GROUP BY l.left_id, m.how""")
def segment_join(spark, sf_dir):
    """Suppliers and nations named whole, in parts between slashes, or otherwise, against all suppliers and nations."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    k = F.col("s_suppkey") % 4
    name = F.when(k == 0, F.col("n_name")).when(k == 1, F.concat_ws(" / ", F.lower("n_name"), "s_name")).when(k == 2, F.concat_ws("/", "s_name", "n_name", F.lit("nowhere"))).otherwise(F.concat(F.lit("the "), "s_name"))
    left = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("left_id"), name.alias("name"))
    right = n.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("right_id"), F.col("n_name").alias("name")).union(s.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")), "s_name"))
    return matching.segment_matches(left, right).select("left_id", F.coalesce(F.array_join("right_ids", ","), F.lit("")).alias("right_ids"), "how")


@query(f"SELECT key, sum(n) AS n, string_agg(p_name || '=' || n, ',' ORDER BY p_name) AS variants FROM (SELECT {sql_key('p_name')} AS key, p_name, count(*) AS n FROM part GROUP BY ALL) GROUP BY 1")
def spelling_histogram(spark, sf_dir):
    found = matching.spelling_clusters(table(spark, sf_dir, "part").select(F.col("p_name").alias("venue")))
    return found.select("key", "n", F.array_join(F.transform(F.map_entries("variants"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("variants"))


# before and after


def _sides(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("uid"), F.concat_ws("-", F.col("o_custkey").cast("string"), "o_orderpriority").alias("title"), F.col("o_orderdate").alias("instant"), "o_orderstatus", "o_totalprice", "o_custkey")
    before = o.filter("uid % 10 != 0")
    after = o.filter("uid % 10 != 1").withColumn("uid", F.when(F.col("uid") % 10 == 2, -F.col("uid")).otherwise(F.col("uid"))).withColumn("o_orderstatus", F.when(F.col("uid") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    return before, after


_SIDES = """WITH o AS (SELECT o_orderkey AS uid, o_custkey || '-' || o_orderpriority AS title, o_orderdate AS instant, o_orderstatus, o_custkey FROM orders), before AS (SELECT * FROM o WHERE uid % 10 <> 0),
after AS (SELECT CASE WHEN uid % 10 = 2 THEN -uid ELSE uid END AS uid, title, instant, CASE WHEN uid % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_custkey FROM o WHERE uid % 10 <> 1)
"""


@query(_SIDES + "SELECT 'lost' AS side, uid FROM before WHERE uid NOT IN (SELECT uid FROM after) UNION ALL SELECT 'gained', uid FROM after WHERE uid NOT IN (SELECT uid FROM before)")
def diff_lost_gained(spark, sf_dir):
    lost, gained = diff.lost_and_gained(*_sides(spark, sf_dir))
    return lost.select(F.lit("lost").alias("side"), "uid").union(gained.select(F.lit("gained"), "uid"))


@query(_SIDES + "SELECT b.uid AS old_uid, a.uid AS new_uid FROM before b JOIN after a ON a.title = b.title AND a.instant = b.instant WHERE b.uid NOT IN (SELECT uid FROM after) AND a.uid NOT IN (SELECT uid FROM before)")
def diff_renamed(spark, sf_dir):
    return diff.renamed(*diff.lost_and_gained(*_sides(spark, sf_dir))).select("old_uid", "new_uid")


@query(_SIDES + "SELECT b.uid, 'o_orderstatus' AS field, b.o_orderstatus AS old, a.o_orderstatus AS new FROM before b JOIN after a USING (uid) WHERE a.o_orderstatus IS DISTINCT FROM b.o_orderstatus")
def diff_fields(spark, sf_dir):
    return diff.changed_fields(*_sides(spark, sf_dir), ["o_orderstatus", "o_custkey"])


_MANIFEST = lambda side: f"(SELECT bucket, count(*) AS n, sha256(string_agg(d, ',' ORDER BY uid)) AS digest FROM (SELECT uid, ((uid % 64) + 64) % 64 AS bucket, sha256(to_json(struct_pack(o_custkey := o_custkey, o_orderstatus := o_orderstatus, title := title, uid := uid))::VARCHAR) AS d FROM {side}) GROUP BY 1)"


@query(_SIDES + f"SELECT bucket, CASE WHEN a.digest IS NULL THEN 'added' WHEN b.digest IS NULL THEN 'removed' WHEN a.digest = b.digest THEN 'unchanged' ELSE 'changed' END AS change, coalesce(a.n, 0) AS n_before, coalesce(b.n, 0) AS n_after FROM {_MANIFEST('before')} a FULL JOIN {_MANIFEST('after')} b USING (bucket)")
def artifact_changes(spark, sf_dir):
    """What changed between two sets of orders, by digests of buckets of their keys alone."""
    told = [artifact.manifest(side.select("uid", "title", "o_orderstatus", "o_custkey"), "uid", F.pmod("uid", F.lit(64))) for side in _sides(spark, sf_dir)]
    return artifact.changes(*told)


_CREDITS = """, e AS (SELECT *, o_custkey % 7 AS place, ['s' || (uid % 4), 's' || (o_custkey % 5)] AS sources, o_orderpriority || o_custkey AS fuzzy FROM o),
b AS (SELECT * FROM e WHERE uid % 10 <> 0), a AS (SELECT * FROM e WHERE uid % 10 <> 1), lost AS (SELECT * FROM b WHERE uid NOT IN (SELECT uid FROM a)),
m AS (SELECT l.uid AS lost_uid, k.uid AS kept_uid, 'place' AS why FROM lost l JOIN a k ON l.place = k.place AND l.instant = k.instant WHERE list_has_any(l.sources, k.sources) AND {jac} >= 0.15
  UNION ALL SELECT l.uid, k.uid, 'key' FROM lost l JOIN a k ON l.fuzzy = k.fuzzy)
SELECT lost_uid, kept_uid, why FROM (SELECT *, row_number() OVER (PARTITION BY lost_uid ORDER BY why DESC, kept_uid) AS pos FROM m) WHERE pos = 1"""


@query(_SIDES.replace("o_custkey FROM orders)", "o_custkey, o_orderpriority FROM orders)") + _CREDITS.format(jac=_JAC(_TOK("l.title"), _TOK("k.title"))))
def loss_explanations(spark, sf_dir):
    """Orders that are gone, each with the first that is left and credits a source of it at its place and time, or has its key."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("uid"), F.col("o_orderkey").alias("ord"), F.concat_ws("-", F.col("o_custkey").cast("string"), "o_orderpriority").alias("title"), F.col("o_orderdate").alias("instant"), (F.col("o_custkey") % 7).alias("place_id"),
        F.array(F.concat(F.lit("s"), (F.col("o_orderkey") % 4).cast("string")), F.concat(F.lit("s"), (F.col("o_custkey") % 5).cast("string"))).alias("sources"), F.concat("o_orderpriority", F.col("o_custkey").cast("string")).alias("fuzzy"),
    )
    lost, _ = diff.lost_and_gained(o.filter("uid % 10 != 0"), o.filter("uid % 10 != 1"))
    return diff.explanations(lost, o.filter("uid % 10 != 1")).select("lost_uid", "kept_uid", "why")


@query(LISTINGS + f""", p AS (SELECT '~' || place_id AS place_id, instant, ord, source, {_TOK('title')} AS tk FROM listings WHERE place_id IS NOT NULL),
s AS (SELECT place_id, instant, count(*) AS n, count(DISTINCT source) > 1 AS cross_source FROM p GROUP BY ALL HAVING count(*) > 1),
m AS (SELECT a.place_id, a.instant, min({_JAC('a.tk', 'b.tk')}) AS least FROM p a JOIN p b ON a.place_id = b.place_id AND a.instant = b.instant AND a.ord < b.ord GROUP BY ALL)
SELECT place_id, instant, n, cross_source, round(least, 6) AS least FROM s JOIN m USING (place_id, instant)""")
def provisional_risk_groups(spark, sf_dir):
    rows = listings(spark, sf_dir).filter("place_id IS NOT NULL").withColumn("place_id", F.concat(F.lit("~"), "place_id")).withColumnRenamed("ord", "uid")
    return diff.risk_groups(rows).select("place_id", "instant", "n", "cross_source", F.round("least", 6).alias("least"))


@query("SELECT name FROM (VALUES ('src0'), ('src1'), ('src7'), ('src9')) t(name) WHERE name NOT IN (SELECT 'src' || (user_id % 7) FROM events)")
def source_completeness(spark, sf_dir):
    declared = values(spark, "name string", [("src0",), ("src1",), ("src7",), ("src9",)])
    return declared.join(listings(spark, sf_dir).select(F.col("source").alias("name")), "name", "left_anti")


# output


@query(LISTINGS + "SELECT ord, concat_ws(chr(10), 'X-SOURCE-NAME:' || source, 'X-CONFIDENCE:' || confidence, CASE WHEN place_id IS NOT NULL THEN 'X-PLACE-ID:' || place_id END, CASE WHEN ord % 2 = 0 THEN 'X-WEEKEND:true' END) AS x FROM listings")
def vevent_xprops(spark, sf_dir):
    pairs = [("X-SOURCE-NAME", F.col("source")), ("X-CONFIDENCE", F.col("confidence")), ("X-PLACE-ID", F.col("place_id")), ("X-COST", F.lit("unknown")), ("X-WEEKEND", F.col("ord") % 2 == 0)]
    return listings(spark, sf_dir).select("ord", emit.x_properties(pairs).alias("x"))


# no line of these is long enough to be folded
@query(LISTINGS + r"""SELECT source || ':' || ord AS uid, concat_ws(chr(13) || chr(10), 'BEGIN:VEVENT', 'UID:' || source || ':' || ord, 'DTSTART:' || strftime(start_ts, '%Y%m%dT%H%M%SZ'), 'DTEND:' || strftime(end_ts, '%Y%m%dT%H%M%SZ'), 'SUMMARY:' || replace(replace(title, ';', '\;'), ',', '\,'),
  'DESCRIPTION:— Details —\nSource: ' || source, 'LOCATION:' || venue || '\, ' || region, 'CATEGORIES:' || event_type, 'STATUS:CONFIRMED', 'END:VEVENT') AS ics FROM listings""".replace("\\\\", "\\"))
def vevent_text(spark, sf_dir):
    x = listings(spark, sf_dir)
    rows = x.select(F.concat("source", F.lit(":"), F.col("ord").cast("string")).alias("uid"), "title", "start_ts", "end_ts", F.lit(False).alias("all_day"), emit.description(F.lit(""), [("Source", F.col("source"))]).alias("description"), F.concat_ws(", ", "venue", "region").alias("location"), F.array("event_type").alias("categories"), F.lit("confirmed").alias("status"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("rrule"), F.lit("").alias("x"))
    return emit.vevent(rows)
