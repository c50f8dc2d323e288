"""Labelled pages from which the extraction weights are learned.

Each page is a list of pieces with a label: article or not. Pages are composed
from a rule: a site's frame around an article, with boilerplate of the kinds
below before, inside and after it.
"""

from __future__ import annotations

import random

# How sites name what is not part of an article, and what is.
BOILERPLATE = {
    "menus": ['<nav><ul>{links}</ul></nav>', '<div class="menu"><ul>{links}</ul></div>', '<div id="navigation" role="navigation"><ul>{links}</ul></div>', '<ul class="nav navbar breadcrumb">{links}</ul>', '<div class="pagination pager">{links}</div>', '<div class="toc">{links}</div>'],
    "headers": ['<header><div class="logo">{short}</div>{links}</header>', '<div id="header" class="site-header masthead topbar">{short}</div>'],
    "footers": ['<footer><p>{short}</p>{links}</footer>', '<footer>{short}</footer>', '<div id="footer" class="site-footer bottom copyright">{short}</div>', '<footer>&copy; {long}</footer>'],
    "sidebars": ['<aside><h3>{short}</h3><ul>{links}</ul></aside>', '<aside><p>{long}</p></aside>', '<div class="sidebar widget">{long}</div>', '<div class="related recommended more-stories"><h3>{short}</h3>{links}</div>', '<div id="secondary" role="complementary">{long}</div>'],
    "notices": ['<div class="cookie consent banner">{long}</div>', '<div class="notice alert warning" role="alert">{short}</div>', '<div id="gdpr" class="popup modal overlay">{long}</div>', '<div class="disclaimer">{long}</div>', '<div class="paywall subscribe-notice">{short}</div>'],
    "adverts": ['<div class="ad">{short}</div>', '<div class="ad">{long}</div>', '<div class="ads advert advertisement">{long}</div>', '<div id="sponsored" class="sponsor promo promoted">{long}</div>', '<section class="ad-slot adsbygoogle">{short}</section>'],
    "forms": ['<form><label>{short}</label><input name="q"></form>', '<form class="newsletter signup"><p>{long}</p></form>', '<div class="search login subscribe newsletter"><p>{short}</p></div>'],
    "shares": ['<div class="share social follow buttons">{links}</div>', '<ul class="social-links tags">{links}</ul>'],
    "comments": ['<section id="comments"><h2>{short}</h2><div class="comment"><p>{long}</p></div><div class="comment"><p>{long}</p></div></section>', '<div class="comments-area respond"><ol class="comment-list"><li><p>{long}</p></li><li><p>{long}</p></li></ol></div>', '<div id="disqus_thread" class="replies discussion"><p>{long}</p></div>', '<section class="comments"><article class="comment"><p>{long}</p></article><article class="comment"><p>{long}</p></article></section>', '<div class="reviews user-comments feedback"><blockquote>{long}</blockquote></div>'],
}
FRAMES = [("<article>", "</article>"), ("<main><article>", "</article></main>"), ('<div class="content">', "</div>"), ('<div id="main" class="post entry">', "</div>"), ("<main>", "</main>"), ('<section class="story body text">', "</section>"), ('<article class="post hentry"><div class="entry-content">', "</div></article>"), ("<div>", "</div>"), ('<div role="main" class="page article-body">', "</div>")]
ARTICLE = ["<p>{long}</p>", "<p>{long}</p>", "<p>{long}<br>{long}</p>", "<h2>{short}</h2>", "<ul><li>{short}</li><li>{long}</li></ul>", "<blockquote>{long}</blockquote>", "<p><b>{short}</b> {long} <a href='/x'>{word}</a> {word}</p>", "<table><tr><td>{word}</td><td>{short}</td></tr></table>", "<figure><img src='x'><figcaption>{short}</figcaption></figure>", "<pre>{short}</pre>", "<p>{short}</p>", "<div><p>{long}</p></div>"]
HEADS = ["<h1>{short}</h1>", "<header><h1>{short}</h1><p>{short}</p></header>", "<h1>{short}</h1><p>{word} {word}</p>"]


def labelled_pages(n: int = 160, seed: int = 5) -> list[list[tuple[str, bool]]]:
    rng = random.Random(seed)

    def words(a: int, b: int) -> str:
        return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(a, b)))

    def filled(template: str) -> str:
        links = "".join(f"<li><a href='/{k}'>{words(1, 2)}</a></li>" for k in range(rng.randint(3, 7)))
        out = template.replace("{links}", links)
        for slot, (a, b) in (("{word}", (1, 1)), ("{short}", (2, 9)), ("{long}", (12, 50))):
            while slot in out:
                out = out.replace(slot, words(a, b), 1)
        return out

    def clutter(kinds: list[str]) -> list[tuple[str, bool]]:
        return [(filled(rng.choice(BOILERPLATE[k])), False) for k in rng.sample(kinds, rng.randint(1, len(kinds)))]

    pages = []
    for i in range(n):
        start, end = FRAMES[i % len(FRAMES)]
        body = [(filled(rng.choice(HEADS)), True)]
        for _ in range(rng.randint(2, 10)):
            body.append((filled(rng.choice(ARTICLE)), True))
            if rng.random() < 0.15:
                body += clutter(["adverts", "shares", "forms", "sidebars", "notices"])[:1]
        before = clutter(["menus", "headers", "notices", "adverts"])
        inner_end = clutter(["shares", "sidebars", "comments", "footers"])[:2] if rng.random() < 0.3 else []
        after = clutter(["comments", "sidebars", "adverts", "forms"]) + clutter(["footers"])
        pages.append([("<html><body>", False), *before, (start, False), *body, *inner_end, (end, False), *after, ("</body></html>", False)])
    return pages
