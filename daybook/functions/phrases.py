"""Many phrases in one pass: a trie over all of them, walked once at each word of a text.

``found`` gives the longest phrase that begins at each word; a shorter one that
begins there too is told from it when a rule is asked, so texts are read once
however many rules there are. Phrases match without regard to the case of ASCII
letters, between ASCII word boundaries; a space in a phrase is any white space
and ``0`` any number.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = "A-Za-z0-9_"


def spellings(plural: str, plain: str) -> list[str]:
    """The phrases of two comma-separated lists, the first with and without a final s."""
    listed = lambda text: [" ".join(p.split()) for p in text.split(",") if p.strip()]
    return [x for p in listed(plural) for x in (p, p + "s")] + listed(plain)


def trie_pattern(phrases: Iterable[str]) -> str:
    """A regular expression of the phrases that shares their beginnings and prefers longer ones."""
    root: dict = {}
    for phrase in phrases:
        node = root
        for ch in phrase:
            node = node.setdefault(ch, {})
        node[""] = {}

    def written(ch: str) -> str:
        return r"\s+" if ch == " " else r"\d+" if ch == "0" else re.escape(ch)

    def of(node: dict) -> str:
        branches = [written(ch) + of(child) for ch, child in sorted(node.items()) if ch]
        if not branches:
            return ""
        if len(branches) == 1 and "" not in node:
            return branches[0]
        return f"(?:{'|'.join(branches)})" + ("?" if "" in node else "")

    return of(root)


class Phrases:
    """Rules by name, each a list of phrases."""

    def __init__(self, rules: Mapping[str, list[str]]):
        every = sorted({p for phrases in rules.values() for p in phrases})
        self.pattern = f"(?i)(?<![{WORD}])(?=({trie_pattern(every)})(?![{WORD}]))"
        # a longer phrase stands for those that end within it at a boundary
        self.standing_for = {name: [p for p in every if any(p == q or p.startswith(q) and not re.match(f"[{WORD}]", p[len(q)]) for q in phrases)] for name, phrases in rules.items()}

    def found(self, text: Column) -> Column:
        """The different phrases in the text, in their plain spelling; none for null."""
        plain = lambda x: F.lower(F.regexp_replace(F.regexp_replace(x, r"\s+", " "), r"\d+", "0"))
        return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), F.lit(1)), plain))

    def holds(self, found: Column, name: str) -> Column:
        return F.arrays_overlap(found, F.split(F.lit(",".join(self.standing_for[name])), ","))
