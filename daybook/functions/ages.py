"""Ages stated in text: the word age, a number, and what joins it to the next word."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words between two ages, behind an upper and behind a lower bound.
BETWEEN = ["-", "–", "—", "to", "thru", "through"]
AND = ["and", "&"]
BELOW = ["under", "younger", "below"]
ABOVE = ["up", "older", "over", "above"]
# Signs before a number with a plus that make it no age.
NO_AGE_BEFORE = ["$", ".", "-", "–", "_"]
#: Characters behind the word age that are read.
REACH = 40


def _number(word: Column) -> Column:
    return F.when(word.rlike("^[0-9]{1,2}$"), word.cast("int"))


def _statement(said: Column) -> Column:
    """struct ``low, high, under, over`` of what follows the word age."""
    # joiners may touch their numbers
    spaced = F.regexp_replace(F.lower(said), r"(?<=\d)(?=(?:to|thr[uo]|and)[\sa-z\d])|(?<=to|thru|through)(?=\d)", " ")
    words = F.regexp_extract_all(spaced, F.lit(r"([a-z0-9_]+|[^\sa-z0-9_])"), F.lit(1))
    first, joiner, then = _number(F.get(words, 0)), F.get(words, 1), F.get(words, 2)
    last = F.when(joiner.isin(BETWEEN), _number(then))
    plus = (joiner == "+") & said.rlike(r"^\d+\s*\+\w")
    return F.struct(
        F.when(last.isNotNull(), first).alias("low"), last.alias("high"), F.when(joiner.isin(AND) & then.isin(BELOW), first).alias("under"),
        F.when(plus | (joiner.isin(AND) & then.isin(ABOVE)), first).alias("over"),
    )


def _with_plus(text: Column) -> Column:
    """The first number of one or two digits before a plus sign that is no price, decimal, range or sum."""
    pieces = F.split(text, r"\+")

    def of(piece: Column, i: Column) -> Column:
        bare = F.rtrim(F.regexp_replace(piece, r"\s+$", ""))
        digits = F.regexp_extract(bare, "([0-9]*)$", 1)
        before = F.substr(bare, F.length(bare) - F.length(digits), F.lit(1))
        stands_alone = (F.length(bare) == F.length(digits)) | ~(before.isin(NO_AGE_BEFORE) | before.rlike("[A-Za-z]"))
        goes_on = F.get(pieces, i + 1).rlike("^[0-9]")
        return F.when(F.length(digits).between(1, 2) & stands_alone & ~goes_on & (i < F.size(pieces) - 1), digits.cast("int"))

    return F.when(F.contains(text, F.lit("+")), F.get(F.filter(F.transform(pieces, of), lambda x: x.isNotNull()), 0))


def band(text: Column) -> Column:
    """struct ``min_age, max_age``: a range, else an upper, else a lower bound, else a bare ``21+``."""
    text = F.coalesce(text, F.lit(""))
    after = F.regexp_extract_all(text, F.lit(rf"(?is)(?=ages?\s+(\d.{{0,{REACH}}}))(?<![a-z0-9_])"), F.lit(1))
    read = F.struct(F.transform(after, _statement).alias("said"), _with_plus(text).alias("bare"))

    def of(x: Column) -> Column:
        first = lambda name: F.get(F.filter(F.transform(x["said"], lambda s: s[name]), lambda v: v.isNotNull()), 0)
        low, high, under = first("low"), first("high"), first("under")
        return F.struct(F.when(low.isNotNull(), low).when(under.isNull(), F.coalesce(first("over"), x["bare"])).alias("min_age"), F.when(low.isNotNull(), high).otherwise(under).alias("max_age"))

    return F.get(F.transform(F.array(read), of), 0)
