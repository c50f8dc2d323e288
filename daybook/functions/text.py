"""Text functions as column expressions.

White space and trimming follow the Unicode-wide sense (no-break space and byte
order mark included); word boundaries follow the ASCII sense.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

WIDE_SPACE = r"[\s ﻿\p{Z}]+"
#: What ``clean_text`` changes to more than a space, or to one that patterns do not take for white space.
CHANGED_BY_CLEANING = r"[&\x{FEFF}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

# Named character references that are decoded.
NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”"}
# Words that carry no identity at either end of a venue's name.
ARTICLES = ["the", "a", "an"]
LEGAL = ["company", "co", "inc", "llc", "ltd", "corp", "incorporated"]
# What stands in for a venue, and words that may follow a one-word stand-in.
SENTINELS = ["see listing", "see catalog", "see agenda", "not specified", "sign in to download the location", "tbd", "to be determined", "various", "varies"]
SENTINEL_NEXT = ["for", "see", "check", "tbd"]
# Postal codes, and newspaper abbreviations with the code they stand for.
STATES = "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY DC".split()
AP_STATES = {"minn": "MN", "wis": "WI", "mich": "MI", "colo": "CO", "neb": "NE", "ill": "IL", "ind": "IN", "ariz": "AZ", "ore": "OR", "wash": "WA", "penn": "PA", "fla": "FL", "calif": "CA", "tenn": "TN", "conn": "CT", "mass": "MA", "okla": "OK", "kan": "KS", "ala": "AL", "ark": "AR", "dak": "ND"}
# Parts of hosts that sell tickets.
TICKET_HOSTS = ["eventbrite", "ticketmaster", "etix.com", "showclix", "seetickets", "axs.com", "tickets.", "ticketweb", "universe.com", "brownpapertickets"]
# Title words without signal.
TITLE_STOP = ["the", "and", "for", "with", "live", "music", "night", "nights", "duluth"]


#: Separators of lists and tables that go into a plan as one constant.
_ITEM, _PAIR = "\x1f", "\x1e"


def among(c: Column, words: Iterable[str]) -> Column:
    """Whether ``c`` is one of many words: one constant of the plan instead of a literal for each."""
    return F.array_contains(F.split(F.lit(_ITEM.join(words)), _ITEM), c)


def said_for(c: Column, table: Mapping[str, str]) -> Column:
    """What stands in the table for ``c``, else null; the table is one constant of the plan."""
    return F.try_element_at(F.str_to_map(F.lit(_ITEM.join(f"{k}{_PAIR}{v}" for k, v in table.items())), F.lit(_ITEM), F.lit(_PAIR)), c)


def word(pattern: str) -> str:
    """A pattern that must not touch ASCII word characters, for ``rlike``."""
    return rf"(?i)(?<![A-Za-z0-9_])(?:{pattern})(?![A-Za-z0-9_])"


def squeeze(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, WIDE_SPACE, " "))


def unescape_ics(c: Column) -> Column:
    return F.regexp_replace(c, r"\\([;,\\])", "$1")


def decode_once(c: Column) -> Column:
    """One pass over character references: split at them, decode each, put together."""
    tokens = F.regexp_extract_all(c, F.lit(r"(?s)(&(?:#x[0-9a-fA-F]+|#[0-9]+|[a-zA-Z]+);|&|[^&]+)"), F.lit(1))

    def one(t: Column) -> Column:
        name = F.lower(F.regexp_extract(t, "^&([a-zA-Z]+);$", 1))
        digits = F.regexp_extract(t, "^&#([0-9]+);$", 1)
        hexes = F.regexp_extract(t, "^&#[xX]([0-9a-fA-F]+);$", 1)
        point = F.when(hexes != "", F.conv(hexes, 16, 10)).when(digits != "", digits).cast("decimal(20,0)")
        decoded = F.decode(F.unhex(F.lpad(F.hex(point.cast("long")), 8, "0")), "UTF-32")
        return F.coalesce(said_for(name, NAMED), F.when(point.isNotNull() & (point <= 0x10FFFF), decoded), t)

    return F.array_join(F.transform(tokens, one), "")


def decode_entities(c: Column) -> Column:
    """Up to three passes, so that doubly escaped text resolves; unknown names stay as they are. Text without ``&`` takes none."""
    passes = F.aggregate(F.sequence(F.lit(1), F.lit(3)), c, lambda text, _: decode_once(text))
    return F.when(F.contains(c, F.lit("&")), passes).otherwise(c)


def clean_text(c: Column) -> Column:
    return squeeze(decode_entities(c))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def make_uid(source: Column, native_id: Column, title: Column, start: Column, venue: Column, suffix: str = "@events.example") -> Column:
    """Source slug and native id, or a digest of title, start and venue where the id is absent or blank."""
    digest = F.substring(F.sha1(F.concat_ws("|", F.coalesce(title, F.lit("")), F.coalesce(start, F.lit("")), F.coalesce(venue, F.lit("")))), 1, 16)
    return F.concat(slug(source), F.lit(":"), F.coalesce(F.when(native_id != "", native_id), digest), F.lit(suffix))


@pandas_udf(StringType())
def _transliterate(s: pd.Series) -> pd.Series:
    other = str.maketrans({"æ": "ae", "Æ": "ae", "ø": "o", "Ø": "o", "ß": "ss"})

    def one(x):
        if x is None or x.isascii():
            return x
        return "".join(ch for ch in unicodedata.normalize("NFD", x) if not "̀" <= ch <= "ͯ").translate(other)

    return s.map(one, na_action="ignore")


LATIN_FROM = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿøÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝØ"
LATIN_TO = "aaaaaaceeeeiiiinooooouuuuyyoAAAAAACEEEEIIIINOOOOOUUUUYo"


def transliterate(c: Column, everything: bool = False) -> Column:
    """Accents dropped. Latin-1 letters stay in the JVM; ``everything`` decomposes all of Unicode by an Arrow UDF."""
    if everything:
        return _transliterate(c)
    return F.replace(F.replace(F.replace(F.translate(F.regexp_replace(c, "[̀-ͯ]", ""), LATIN_FROM, LATIN_TO), F.lit("æ"), F.lit("ae")), F.lit("Æ"), F.lit("ae")), F.lit("ß"), F.lit("ss"))


def fold_key(c: Column) -> Column:
    """Lower-case ASCII words, without articles in front and company forms behind while another word is left."""
    flat = F.regexp_replace(F.lower(F.regexp_replace(F.regexp_replace(F.replace(c, F.lit("&"), F.lit(" and ")), r"\(.*?\)", " "), "['’]", "")), "[^a-z0-9]+", " ")
    bare = F.regexp_replace(F.regexp_replace(flat, "^ | $", ""), f"^(?:(?:{'|'.join(ARTICLES)}) )+(?=[a-z0-9])", "")
    return F.regexp_replace(bare, f"(?: (?:{'|'.join(LEGAL)}))+$", "")


def venue_key(c: Column, everything: bool = False) -> Column:
    return fold_key(transliterate(clean_text(unescape_ics(c)), everything))


def is_sentinel(key: Column) -> Column:
    """Of a venue key: no venue at all."""
    many = "|".join(s for s in SENTINELS if " " in s)
    single = "|".join(s for s in SENTINELS if " " not in s)
    return (F.coalesce(key, F.lit("")) == "") | key.rlike(f"^(?:(?:{many})(?: .*)?|(?:{single})(?: (?:{'|'.join(SENTINEL_NEXT)})(?: .*)?)?)$")


def state_code(raw: Column) -> Column:
    return F.when(among(F.upper(raw), STATES), F.upper(raw)).otherwise(said_for(F.lower(raw), AP_STATES))


def leading_city(c: Column, is_clean: bool = False) -> Column:
    """struct ``city, state, rest`` of ``City, ST[, rest]``, else null."""
    parts = F.split(c if is_clean else clean_text(c), ",", 3)
    city, after, rest = F.trim(F.get(parts, 0)), F.ltrim(F.get(parts, 1)), F.get(parts, 2)
    state = state_code(F.when(F.endswith(after, F.lit(".")), F.left(after, F.length(after) - 1)).otherwise(after))
    # a name: a letter, then up to 30 letters, blanks, dots, apostrophes and hyphens
    named = F.length(F.get(parts, 0)).between(2, 31) & F.get(parts, 0).rlike("^[A-Za-z][A-Za-z .'-]+$")
    return F.when(named & state.isNotNull(), F.struct(city.alias("city"), state.alias("state"), F.trim(F.coalesce(rest, F.lit(""))).alias("rest")))


def venue_name(c: Column, is_clean: bool = False) -> Column:
    city = leading_city(c, is_clean)
    return F.when(city.isNull(), c if is_clean else clean_text(c)).otherwise(F.coalesce(F.nullif(city["rest"], F.lit("")), city["city"]))


def strip_html(c: Column) -> Column:
    # fixed values: elements that end a line, and the references that are replaced
    spaced = F.regexp_replace(c, r"(?i)<br\s*/?>|</(?:p|div|li|h[1-6]|tr)>", " ")
    bare = F.regexp_replace(spaced, "<[^>]*>", "")
    for pattern, to in (("(?i)&nbsp;|&#160;", " "), ("&(?:#8217|#39|rsquo|apos);", "'"), ("&(?:#8211|ndash);", "–"), ("&(?:quot|#8220|#8221);", '"'), ("&(?:lt|gt);", ""), ("(?i)&(?:amp|#0?38);", "&")):
        bare = F.regexp_replace(bare, pattern, to)
    return squeeze(bare)


def decode_and_strip(c: Column) -> Column:
    return squeeze(F.regexp_replace(F.regexp_replace(F.regexp_replace(decode_entities(c), r"\\[nr]", " "), r"(?i)<br\s*/?>|</(?:p|div|li)>", " "), "<[^>]*>", ""))


def text_or_null(c: Column) -> Column:
    return F.nullif(squeeze(c), F.lit(""))


def haystack(title: Column, description: Column, categories: Column) -> Column:
    return clean_text(F.concat_ws(" ", title, description, F.array_join(categories, " ")))


def normal_categories(categories: Column) -> Column:
    return F.filter(F.transform(categories, lambda x: F.lower(clean_text(x))), lambda x: x != "")


def escape_html(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def ticket_url(c: Column) -> Column:
    hosts = "|".join(h.replace(".", r"\.") for h in TICKET_HOSTS)
    found = F.regexp_extract(clean_text(c), rf"""(?i)(https?://[^\s<>"')]*(?:{hosts})[^\s<>"')]*)""", 1)
    return F.nullif(F.regexp_replace(found, r"[.,;)]+$", ""), F.lit(""))


def provisional_id(key: Column) -> Column:
    return F.concat(F.lit("~"), F.replace(key, F.lit(" "), F.lit("-")))


def short_slug(c: Column, limit: int = 48) -> Column:
    return F.regexp_replace(F.substring(F.replace(venue_key(c), F.lit(" "), F.lit("-")), 1, limit), "-+$", "")


def join_norm(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace(c, "[/-]", " ")), r"\s+", " "), "^ | $", "")


def location_parts(c: Column) -> Column:
    return F.filter(F.transform(F.split(unescape_ics(c), ","), lambda x: F.trim(x)), lambda x: x != "")


def english_list(items: Column) -> Column:
    head = F.array_join(F.slice(items, F.lit(1), F.greatest(F.size(items) - 1, F.lit(0))), ", ")
    last = F.element_at(items, -1)
    return F.when(F.size(items) == 0, "").when(F.size(items) == 1, last).when(F.size(items) == 2, F.concat(head, F.lit(" and "), last)).otherwise(F.concat(head, F.lit(", and "), last))


def title_tokens(c: Column) -> Column:
    """Distinct words of a title that carry signal."""
    return F.array_distinct(F.filter(F.split(venue_key(c), " "), lambda w: (F.length(w) > 2) & ~w.isin(TITLE_STOP)))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def fuzzy_key(day: Column, title: Column, venue: Column) -> Column:
    words = F.slice(F.filter(F.split(F.regexp_replace(F.lower(title), "[^a-z0-9]+", " "), " "), lambda w: w != ""), 1, 6)
    return F.concat_ws("|", day, F.array_join(words, " "), F.substring(F.replace(venue_key(F.coalesce(venue, F.lit(""))), F.lit(" "), F.lit("")), 1, 12))


def number_text(c: Column) -> Column:
    """A double as text, whole numbers without a fraction."""
    return F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))


def format_cost(kind: Column, low: Column, high: Column, currency: Column, note: Column) -> Column:
    money = F.concat(F.lit("$"), number_text(low), F.when(high.isNotNull() & (high != low), F.concat(F.lit("–$"), number_text(high))).otherwise(F.lit("")), F.when(currency != "USD", F.concat(F.lit(" "), currency)).otherwise(F.lit("")))
    shown = F.when(kind == "free", F.lit("Free")).when(kind == "donation", F.lit("Donation")).when((kind == "paid") & low.isNotNull(), money).when(kind == "paid", F.lit("Paid"))
    return F.concat_ws(" ", F.coalesce(shown, note), F.when(shown.isNotNull() & note.isNotNull(), F.concat(F.lit("("), note, F.lit(")"))))
