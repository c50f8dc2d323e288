"""Main-text extraction from HTML by a maximum-scoring subsequence.

A page becomes a row of tokens: words and tags. A word scores positive, less in
blocks that labelled pages show to be unlike an article, and below zero in
containers that they show to be boilerplate; a tag scores negative, by its name.
The weights come from the labelled pages of ``htmllabels``. One linear scan finds
the contiguous region with the largest sum; the blocks inside it whose words
score positive are the text, and those of the ``article`` or ``main`` element that holds most of it.

Character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined by two line feeds in page order. Nothing is capped, and a page
takes time in proportion to its length, however its tags are nested or its quotes left open.

Defined results: null or empty html, and pages on which no region has a positive
sum, give an empty text; markup that is cut off mid-tag is ignored; elements
that are not closed end with their parent; repeated rows get a row each; other
columns are not read.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import Counter
from collections.abc import Container, Iterator
from functools import lru_cache
from math import log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from daybook.llm.common import arrow_map

# Names of elements that HTML defines.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "button", "canvas", "iframe", "noscript", "object", "select", "svg", "video", "audio", "input"}
FORMULA = {"math", "maction", "menclose", "merror", "mfenced", "mfrac", "mi", "mmultiscripts", "mn", "mo", "mover", "mpadded", "mphantom", "mroot", "mrow", "ms", "mspace", "msqrt", "mstyle", "msub", "msubsup", "msup", "mtable", "mtd", "mtext", "mtr", "munder", "munderover", "semantics", "annotation", "annotation-xml"}
INLINE |= FORMULA
DROPPED = {"annotation", "annotation-xml", "button", "canvas", "head", "iframe", "noscript", "object", "option", "script", "select", "style", "svg", "template", "textarea", "title", "video", "audio"}
#: Inside an article these are no part of it.
BESIDE = {"aside", "footer", "form", "nav"}
RAW = ("script", "style", "textarea", "title", "iframe", "noscript", "template", "svg")

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^'\">]*+)>")
TAG_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
UNQUOTED = re.compile(r"[^'\">]*")
RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}
SKIPPED = (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<!", ">"), ("<?", ">"))
NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
#: A word's score is held between these, so that an advert inside an article does not outweigh what follows it.
LEAST_WORD, MOST_WORD = -0.3, 3.0
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Block:
    """Consecutive text with the same block-level parent; ``home`` is the article that holds it, if any."""

    __slots__ = ("features", "home", "links", "parts", "words")

    def __init__(self, features: frozenset[str], home: int | None):
        self.features, self.home, self.parts, self.links, self.words = features, home, [], 0, 0

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Where the tag's ``>`` stands, or the page's end; a quote that is never closed is none."""
    while True:
        at = UNQUOTED.match(page, at).end()
        if at == len(page) or page[at] == ">":
            return at
        at = page.find(page[at], at + 1) + 1 if at < last[page[at]] else at + 1


def pieces(page: str) -> Iterator[tuple[str, str, str]]:
    """``("text", text, "")``, ``("open", name, attributes)``, ``("close", name, "")`` and ``("raw", name, "")`` in page order, in one pass."""
    at, n = 0, len(page)
    last = {quote: page.rfind(quote) for quote in "\"'"}
    while at < n:
        start = page.find("<", at)
        if start != at:
            yield "text", page[at : start if start >= 0 else n], ""
        if start < 0:
            return
        skipped = next((end for begin, end in SKIPPED if page.startswith(begin, start)), None)
        if skipped:
            end = page.find(skipped, start + (4 if skipped == "-->" else 2))
            at = end + len(skipped) if end >= 0 else n
            continue
        m = TAG.match(page, start)
        if m:
            attributes, at = m[3], m.end()
        else:
            m = TAG_NAME.match(page, start)
            if m is None:
                yield "text", "<", ""
                at = start + 1
                continue
            end = tag_end(page, m.end(), last)
            if end == n:
                return
            attributes, at = page[m.end() : end], end + 1
        name = m[2].lower()
        if m[1]:
            yield "close", name, ""
        elif name in RAW_END and not attributes.endswith("/"):
            closed = RAW_END[name].search(page, at)
            at = closed.end() if closed else n
            yield "raw", name, ""
        else:
            yield "open", name, attributes


class Element(NamedTuple):
    """An open element, with what it adds up to with those around it."""

    name: str
    gone: bool
    features: frozenset[str]
    inside: bool
    home: int | None


def tokens(page: str, known: Container[str] | None = None) -> list[tuple[str, object]]:
    """``("tag", name)`` and ``("block", Block)``; a block stands for its words. Only ``known`` features are kept, if given."""
    out: list[tuple[str, object]] = []
    stack = [Element("", False, frozenset(), False, None)]
    open_names: Counter[str] = Counter()
    block: Block | None = None
    dropped = 0

    def pop() -> str:
        nonlocal dropped
        top = stack.pop()
        dropped -= top.gone
        open_names[top.name] -= 1
        return top.name

    for kind, name, attributes in pieces(page):
        if kind == "text":
            if dropped:
                continue
            piece = htmllib.unescape(name)
            if block is None:
                if not piece.strip():
                    continue
                block = Block(stack[-1].features, stack[-1].home)
                out.append(("block", block))
            block.parts.append(piece)
            n = len(piece.split())
            block.words += n
            if open_names["a"]:
                block.links += n
            continue
        out.append(("tag", name))
        if kind == "raw":
            continue
        if name == "br" and block is not None:
            block.parts.append(" ")
        if name not in INLINE:
            block = None
        if kind == "close":
            if open_names[name]:
                while pop() != name:
                    pass
        elif name not in VOID and not attributes.rstrip().endswith("/"):
            if name == "p" and open_names["p"]:
                while (stack[-1].name in INLINE or stack[-1].name == "p") and pop() != "p":
                    pass
            gone = name in DROPPED or (name in BESIDE and stack[-1].inside) or is_hidden(attributes)
            dropped += gone
            open_names[name] += 1
            stack.append(inner(stack[-1], name, attribute_words(attributes) if "=" in attributes else (), gone, len(out), known))
    return out


def inner(around: Element, name: str, words: tuple[str, ...], gone: bool, number: int, known: Container[str] | None) -> Element:
    """What surrounds a block in this element: names of elements, apart for those inside an article, and words of attributes."""
    own = [f".{w}" for w in words]
    if name not in INLINE:
        own.append(f"article>{name}" if around.inside else name)
    new = frozenset(x for x in own if x not in around.features and (known is None or x in known))
    article = name in ("article", "main")
    return Element(name, gone, around.features | new if new else around.features, around.inside or article, number if article else around.home)


@lru_cache(maxsize=4096)
def is_hidden(attrs: str) -> bool:
    """By the attribute hidden, aria-hidden or a style; what other attributes say does not count."""
    low = attrs.lower()
    if "hidden" not in low and "none" not in low:
        return False
    for name, *given in ATTRIBUTE.findall(low):
        value = "".join(given)
        if name == "hidden" or (name == "aria-hidden" and value.strip() == "true") or (name == "style" and NOT_SHOWN.search(value)):
            return True
    return False


@lru_cache(maxsize=4096)
def attribute_words(attrs: str) -> tuple[str, ...]:
    """Lower-case words of class, id, role and label."""
    return tuple(sorted({w.lower() for found in NAMED.findall(attrs) for w in PARTS.findall(" ".join(found))}))


def block_features(block: Block) -> set[str]:
    density = block.links / max(1, block.words)
    size = next(k for k, most in (("1", 2), ("3", 8), ("9", 20), ("21", 1 << 60)) if block.words <= most)
    return {*block.features, f"words {size}", *(["mostly links"] if density > 0.5 else [])}


class Weights:
    """Log-odds of words by their block's features, and costs of tags by name."""

    def __init__(self, bias: float, features: dict[str, float], tags: dict[str, float]):
        self.bias, self.features, self.tags = bias, features, tags

    def word(self, block: Block) -> float:
        odds = self.bias + sum(self.features.get(f, 0.0) for f in block_features(block))
        return max(LEAST_WORD, min(MOST_WORD, odds))

    def place(self, block: Block) -> float:
        """Log-odds by where the block stands alone, whatever it holds."""
        return self.bias + sum(self.features.get(f, 0.0) for f in block.features)

    def tag(self, name: str) -> float:
        return self.tags.get(name, -0.5)


def fit(pages: list[list[tuple[str, bool]]], rounds: int = 400, rate: float = 0.5, decay: float = 1e-3) -> Weights:
    """Fit to labelled pages: lists of ``(piece of html, is it article)``.

    Labels reach blocks through marks that are put around article pieces and
    are no part of the features.
    """
    rows: list[tuple[set[str], int, bool]] = []
    inner: dict[str, list[int]] = {}
    for pieces in pages:
        page = "".join(f"\x02{html}" if article else f"\x03{html}" for html, article in pieces)
        article = False
        for kind, value in tokens(page):
            if kind == "block":
                raw = "".join(value.parts)
                article = raw.rfind("\x02") > raw.rfind("\x03") if "\x02" in raw or "\x03" in raw else article
                value.parts = [raw.replace("\x02", "").replace("\x03", "")]
                value.words = len(value.text().split())
                if value.words:
                    rows.append((block_features(value), value.words, article))
            else:
                inner.setdefault(value, [1, 1])[article] += 1
    names = sorted({f for r, _, _ in rows for f in r})
    at = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for i, (features, _, _) in enumerate(rows):
        x[i, [at[f] for f in features]] = 1
    y = np.array([a for _, _, a in rows], dtype=float)
    weight = np.sqrt(np.array([n for _, n, _ in rows], dtype=float))
    weight /= weight.sum()
    w, b = np.zeros(len(names)), 0.0
    g2, b2 = np.full(len(names), 1e-8), 1e-8
    for _ in range(rounds):
        miss = (y - 1 / (1 + np.exp(-(x @ w + b)))) * weight
        g = x.T @ miss - decay * w
        g2 += g * g
        b2 += miss.sum() ** 2
        w += rate * g / np.sqrt(g2)
        b += rate * miss.sum() / np.sqrt(b2)
    tags = {name: -0.2 - max(0.0, log(out / within)) for name, (out, within) in inner.items()}
    return Weights(float(b), dict(zip(names, w.tolist(), strict=True)), tags)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest sum; empty if none is positive."""
    best, at, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, at = total, (start, i + 1)
    return at


def extract(page: str | None, weights: Weights) -> str:
    if not page:
        return ""
    found = tokens(page, weights.features)
    words = [weights.word(v) if k == "block" else 0.0 for k, v in found]
    scores = [w * v.words if k == "block" else weights.tag(v) for (k, v), w in zip(found, words, strict=True)]
    a, b = best_region(scores)
    good = [(i, v) for i, ((k, v), w) in enumerate(zip(found, words, strict=True)) if k == "block" and w > 0]
    # the article that holds most of the region is kept to its ends: a short paragraph there may not outweigh its tags
    homes: Counter[int | None] = Counter()
    for i, v in good:
        if a <= i < b:
            homes[v.home] += v.words
    home = homes.most_common(1)[0][0] if homes else None
    # in the article a list of links stays if it stands where text does
    at_home = lambda v: home is not None and v.home == home
    kept = (v.text() for i, ((k, v), w) in enumerate(zip(found, words, strict=True)) if k == "block" and ((w > 0 and (a <= i < b or at_home(v))) or (at_home(v) and weights.place(v) > 0)))
    return "\n\n".join(t for t in kept if t)


@lru_cache(maxsize=1)
def default_weights() -> Weights:
    from daybook.llm.htmllabels import labelled_pages

    return fit(labelled_pages())


def main_text(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Per page: ``page_id, url, text, n_chars``."""
    schema = StructType([StructField("page_id", LongType()), StructField("url", StringType()), StructField("text", StringType()), StructField("n_chars", LongType())])
    fitted = weights or default_weights()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [extract(p.as_py(), fitted) for p in batch.column(2)]
        return pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return arrow_map(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html"), run, schema)
