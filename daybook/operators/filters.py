"""The query language: a query's parameters become a record of predicates, and that a column.

Saved queries are evaluated in one pass: every row is tagged with the queries it meets.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import text as T

# The words each parameter takes.
VOCABULARY = {
    "types": "live-music performing-arts film visual-arts class meeting market festival sports family food-drink education community convention other".split(),
    "confidence": "high medium low".split(),
    "audience": "all-ages kids teen students adults-only seniors".split(),
    "costTier": "free donation paid unknown".split(),
    "registration": "required drop-in open unknown".split(),
    "setting": "indoor outdoor virtual unknown".split(),
    "geoScope": "duluth twin-ports regional distant virtual".split(),
    "access": "wheelchair asl sensory-friendly".split(),
    "timeOfDay": "morning afternoon evening late-night all-day".split(),
    "publicAdmission": "public restricted unknown".split(),
    "homeAway": "home away".split(),
}
# Names under which a parameter is accepted.
NAMES = {
    "sources": ["source", "sources"], "types": ["type", "types"], "confidence": ["confidence"], "multiDay": ["multiDay", "multiday"], "inDuluth": ["inDuluth", "induluth"],
    "corroborated": ["corroborated"], "audience": ["audience"], "costTier": ["cost", "costTier", "costtier"], "registration": ["registration"], "setting": ["setting"],
    "geoScope": ["geo", "geoScope", "geoscope"], "access": ["access"], "timeOfDay": ["time", "timeOfDay", "timeofday"], "publicAdmission": ["admission", "publicAdmission", "publicadmission"],
    "weekend": ["weekend"], "recurring": ["recurring"], "alcohol": ["alcohol"], "homeAway": ["homeAway", "homeaway"], "institutionalNotice": ["institutionalNotice", "institutionalnotice", "notices"],
    "placeId": ["place", "placeId", "placeid"],
}
FLAGS = ["multiDay", "inDuluth", "corroborated", "weekend", "recurring", "alcohol", "institutionalNotice"]
ONE_OF = {"types": "event_type", "confidence": "confidence", "costTier": "cost_tier", "registration": "registration", "setting": "setting", "geoScope": "geo_scope", "timeOfDay": "time_of_day", "publicAdmission": "public_admission"}
FLAG_COLUMN = {"multiDay": "multi_day", "inDuluth": "in_duluth", "weekend": "weekend", "recurring": "recurring", "alcohol": "alcohol", "institutionalNotice": "institutional_notice"}


@dataclass
class Filter:
    lists: dict[str, list[str]] = field(default_factory=dict)
    flags: dict[str, bool] = field(default_factory=dict)
    equal: dict[str, str] = field(default_factory=dict)
    exclude_audience: list[str] = field(default_factory=list)


def parse(params: Mapping[str, object]) -> Filter:
    """Unknown words are dropped and an empty list is no filter; a flag is true for 1, true and yes only; repeated parameters are ignored."""
    out = Filter()
    for name, accepted in NAMES.items():
        raw = next((params[k] for k in accepted if isinstance(params.get(k), str)), None)
        if raw is None:
            continue
        if name in FLAGS:
            out.flags[name] = raw.strip().lower() in ("1", "true", "yes")
        elif name == "placeId":
            if raw.strip():
                out.equal[name] = raw.strip()
        elif name == "homeAway":
            if raw.strip().lower() in VOCABULARY[name]:
                out.equal[name] = raw.strip().lower()
        else:
            words = [w for w in (x.strip().lower() for x in raw.split(",")) if w]
            words = [T_slug(w) for w in words] if name == "sources" else [w for w in words if w in VOCABULARY[name]]
            if any(words):
                out.lists[name] = [w for w in words if w]
    return out


def T_slug(word: str) -> str:
    import re

    return re.sub("^-+|-+$", "", re.sub("[^a-z0-9]+", "-", word.lower()))


def predicate(f: Filter) -> Column:
    """The filter as a column; a null never excludes where a missing value is no match for the negation."""
    tests: list[Column] = []
    for name, words in f.lists.items():
        if name == "sources":
            tests.append(F.exists(F.array(*[F.lit(w) for w in words]), lambda t: F.contains(T.slug(F.col("source")), t)))
        elif name == "audience":
            tests.append(F.arrays_overlap(_array("audience"), F.array(*[F.lit(w) for w in words])))
        elif name == "access":
            tests.append(F.size(F.array_except(F.array(*[F.lit(w) for w in words]), _array("access"))) == 0)
        else:
            tests.append(F.col(ONE_OF[name]).isin(words))
    for name, value in f.flags.items():
        tests.append((F.size(_array("also")) >= 1) == F.lit(value) if name == "corroborated" else F.coalesce(F.col(FLAG_COLUMN[name]), F.lit(False)) == F.lit(value))
    for name, value in f.equal.items():
        tests.append(F.col("place_id" if name == "placeId" else "home_away").eqNullSafe(F.lit(value)))
    if f.exclude_audience:
        tests.append(~F.arrays_overlap(_array("audience"), F.array(*[F.lit(w) for w in f.exclude_audience])))
    out = F.lit(True)
    for t in tests:
        out = out & t
    return F.coalesce(out, F.lit(False))


def _array(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def feed_name(f: Filter) -> str:
    parts = [", ".join(v) for v in f.lists.values()] + [k if v else f"not {k}" for k, v in f.flags.items()] + list(f.equal.values())
    return " · ".join(["Events", *parts]) if parts else "All events"


@dataclass
class Saved:
    file: str
    title: str
    group: str
    filter: Filter


def _saved(file: str, group: str, public: bool = False, exclude: tuple[str, ...] = (), **params: str) -> Saved:
    f = parse(params)
    if public:
        f.flags["institutionalNotice"] = False
    f.exclude_audience = list(exclude)
    return Saved(file, file.replace("-", " ").capitalize(), group, f)


# The saved queries and what they ask for.
SAVED = [
    _saved("all", "Start here", public=True), _saved("weekend", "Start here", public=True, weekend="true"), _saved("family", "Start here", audience="all-ages,kids"),
    _saved("free", "Start here", cost="free"), _saved("drop-in", "Start here", registration="drop-in"), _saved("conventions", "By kind", type="convention"),
    *[_saved(t, "By kind", public=True, type=t) for t in "live-music performing-arts film visual-arts class meeting market festival sports food-drink education community".split()],
    _saved("kids", "Who it's for", audience="kids"), _saved("teen", "Who it's for", audience="teen"), _saved("adults-only", "Who it's for", audience="adults-only"), _saved("seniors", "Who it's for", audience="seniors"),
    _saved("music-no-age-limit", "Who it's for", type="live-music", exclude=("adults-only",)), _saved("accessible", "Who it's for", access="wheelchair"), _saved("asl", "Who it's for", access="asl"), _saved("sensory-friendly", "Who it's for", access="sensory-friendly"),
    _saved("free-family", "What it costs", cost="free", audience="all-ages,kids"), _saved("free-outdoor", "What it costs", cost="free", setting="outdoor"),
    _saved("open-to-public", "Getting in", admission="public"), _saved("registration-required", "Getting in", registration="required"),
    _saved("evenings", "When", public=True, time="evening"), _saved("late-night", "When", time="late-night"), _saved("daytime", "When", public=True, time="morning,afternoon"), _saved("recurring", "When", recurring="true"),
    _saved("single-day", "When", multiDay="false"), _saved("multi-day", "When", multiDay="true"), _saved("classes-single-day", "When", type="class", multiDay="false"),
    _saved("duluth-proper", "Where", geo="duluth"), _saved("twin-ports", "Where", geo="duluth,twin-ports"), _saved("outdoor", "Where", setting="outdoor"), _saved("virtual", "Where", setting="virtual"), _saved("home-games", "Where", type="sports", homeAway="home"),
    _saved("high-confidence", "Provenance", confidence="high"), _saved("corroborated", "Provenance", corroborated="true"), _saved("notices", "Provenance", notices="true"),
]


def tag(df: DataFrame, saved: list[Saved] | None = None) -> DataFrame:
    """A row per event and saved query that it meets, in one pass."""
    checks = F.array(*[F.struct(F.lit(s.file).alias("file"), predicate(s.filter).alias("met")) for s in (saved or SAVED)])
    met = F.transform(F.filter(checks, lambda x: x["met"]), lambda x: x["file"])
    return df.withColumn("file", F.explode(met))


def tag_places(df: DataFrame) -> DataFrame:
    """The saved query of every registered place, by its id."""
    return df.filter(F.col("place_id").isNotNull() & ~F.startswith(F.col("place_id"), F.lit("~"))).withColumn("file", F.concat(F.lit("place/"), F.col("place_id")))


def top_per_group(counts: DataFrame, group: str, most: int = 15) -> DataFrame:
    """Counts with the ``most`` largest of one group; other groups stay whole; zero counts are hidden."""
    from pyspark.sql import Window

    at = F.row_number().over(Window.partitionBy("group").orderBy(F.desc("n"), "ord"))
    return counts.filter("n > 0").withColumn("rank", at).filter((F.col("group") != group) | (F.col("rank") <= most))
