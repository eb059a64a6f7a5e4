"""HTML extraction by line-block distribution.

Markup is stripped into lines, one per block of the page. Lines of navigation, forms, adverts,
notices and the like are left out, so that they part nothing; other lines of links count no text.
Over the lines a window of `WIDTH` slides and adds up text lengths: the sum surges where the
article begins and dives to nothing where it ends. A stretch between such points is kept, all of
its lines, if its largest sum reaches `SURGE` of the page's largest. A shorter one is kept too from
its first to its last line of a kind that a kept stretch has, elements of one name within the same
element: a short paragraph of the text is not lost behind a list of links. Lines within no element
at all have nothing in common. An `<article>` or `<main>`
does not decide: its text weighs `ARTICLE` times as much, and where one begins or ends a stretch
does so too.

A noise word in a class, id or role does not silence what wraps the page's text: an element that
holds an article, or, where no article stands elsewhere, more than half of the text. Adverts,
reader comments and cookie notices (`BESIDE`) can be longer than the text, so for these only an
article counts.

Defined results: a NULL or empty page, or one without text, gives an empty string. Broken markup
(unclosed tags, a page cut off anywhere) is read as far as it goes. Repeated rows come back as
they are; an empty table gives an empty result. Extra columns are kept; output columns replace
input columns of their names.
"""

import re
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaweave.llm.work import table

WIDTH = 3
SURGE = 0.2
"""Share of the largest window sum of the page from which a stretch is kept."""
ARTICLE = 1.5
"""How much more text weighs within an article."""
LINKED = 0.6
"""Share of link text from which a line outside an article is a menu."""

WRAPS = 0.5
"""Share of the page's text (or, for an article, of the longest one's) from which a wrapper of it
is no noise."""
TEASER = 0.1
"""Share of the page's text up to which an article is a teaser, which a wrapper can silence."""

# Element names of the HTML standard, and usual words of class names.
RAW = ["script", "style", "noscript", "template", "svg", "math", "iframe", "object", "head",
       "title", "textarea", "select", "canvas", "audio", "video"]
ASIDE = ["nav", "footer", "aside", "form", "button", "dialog", "menu", "fieldset"]
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"]
INLINE = ["a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
          "em", "font", "i", "ins", "kbd", "label", "mark", "q", "ruby", "rt", "rp", "s", "samp",
          "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
          "br", "img"]
ENDS_ITSELF = ["p", "li", "dt", "dd", "tr", "td", "th", "option", "h1", "h2", "h3", "h4", "h5",
               "h6"]
NOISE = ["ad", "ads", "adv", "advert", "adverts", "advertisement", "adbox", "banner", "promo",
         "promotion", "sponsor", "sponsored", "nav", "navbar", "navigation", "menu", "menubar",
         "breadcrumb", "breadcrumbs", "sidebar", "footer", "masthead", "comment", "comments",
         "disqus", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal",
         "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share",
         "sharing", "social", "related", "recommended", "widget", "toolbar", "pagination",
         "pager", "search", "copyright", "contentinfo", "complementary", "respond", "replies"]

BESIDE = ["ad", "ads", "adv", "advert", "adverts", "advertisement", "adbox", "promo", "promotion",
          "sponsor", "sponsored", "newsletter", "comment", "comments", "disqus", "respond",
          "replies", "cookie", "cookies", "consent", "gdpr"]
NEGATED = ["no", "non", "not", "without", "has", "have", "with", "hide"]
"""What follows in a name says what the page has beside the element."""
LAYOUT = ["free", "layout", "template"]

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b[^>]*(?:/>|>.*?(?:</(?P=raw)\s*>|(?=<body\b)|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[/!?a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_RIGHTS = re.compile(
    r"(?:©|\(c\) ?\d|copyright\s*(?:©|\(c\)|\d{4}\b)|(?:copyright\b.{0,80})?all rights reserved\W*$)",
    re.I)
_ASIDE, _VOID, _INLINE = frozenset(ASIDE), frozenset(VOID), frozenset(INLINE)
_ENDS_ITSELF, _NOISE = frozenset(ENDS_ITSELF), frozenset(NOISE)
_BESIDE, _NEGATED, _LAYOUT = frozenset(BESIDE), frozenset(NEGATED), frozenset(LAYOUT)
_NONE, _NAMED, _ALWAYS_BESIDE, _ALWAYS = range(4)


def _named(rest: str, in_article: bool) -> int:
    level = _NONE
    for found in _NAMES.finditer(rest):
        for value in " ".join(filter(None, found.groups())).lower().split():
            words = _WORD.findall(value)
            if words and words[-1] in _LAYOUT:
                continue
            for word in words:
                if word in _NEGATED:
                    break
                if word in _BESIDE:
                    return _ALWAYS_BESIDE
                if word in _NOISE or word == "header" and not in_article:
                    level = _NAMED
    return level


def _noise(name: str, rest: str, in_article: bool) -> int:
    """How far the element is noise: not, by a name, by a name of what stands beside the text, or
    whatever it holds."""
    if name in _ASIDE or name == "header" and not in_article:
        return _ALWAYS
    if "=" not in rest or name in ("body", "html", "main", "article"):
        return _NONE
    if re.search(r"\bhidden\b(?!\s*=\s*.?until)|aria-hidden\s*=\s*.?true", rest, re.I):
        return _ALWAYS
    return _named(rest, in_article)


def _silent(out: list[tuple], holders: list[tuple], articles: list[tuple]) -> list[bool]:
    """Which of the elements with noise names are noise. `holders`: the element around it, its
    level and article; `articles`: the element around it, and whether it has a noise name. Number
    0 is the page."""
    held = [0] * len(holders)
    mass = [0] * len(articles)
    for _, article, count, holder in out:
        held[holder] += count
        mass[article] += count
    for i in range(len(holders) - 1, 0, -1):
        held[holders[i][0]] += held[i]
    real = [n if i and not noise else 0 for i, (n, (_, noise)) in enumerate(
        zip(mass, articles, strict=True))]
    least = max(WRAPS * max(real), TEASER * held[0], 1)
    wraps = [False] * len(holders)
    for n, (holder, _) in zip(real, articles, strict=True):
        wraps[holder] |= n >= least
    for i in range(len(holders) - 1, 0, -1):
        wraps[holders[i][0]] |= wraps[i]
    marked = max(real) >= least
    silent = [False]
    for i, (around, level, article) in enumerate(holders[1:], 1):
        most = (level == _NAMED and held[i] > WRAPS * held[0] and (bool(article) or not marked))
        silent.append(silent[around] or not (wraps[i] or most))
    return silent


def lines(html: str) -> list[tuple[str, int, int, tuple[int, str]]]:
    """(text, number of the article it stands in or 0, characters that count, kind) per block of
    text outside of noise. The kind is the number of the element around the one with the text, and
    this one's name."""
    out: list[tuple[str, int, int, int]] = []  # and number of the holder with a noise name
    kinds: list[tuple[int, str]] = []
    stack: list[tuple[str, bool, int, int]] = []  # element, always noise, article, holder
    numbers: list[int] = []  # of the elements of the stack
    opened = 0
    holders: list[tuple[int, int, int]] = [(0, _NONE, 0)]
    articles: list[tuple[int, bool]] = [(0, False)]
    parts: list[str] = []
    linked = depth_a = 0

    def close() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        _, noise, article, holder = stack[-1] if stack else ("", False, 0, 0)
        if text and not noise:
            menu = not article and linked > LINKED * len(text)
            rights = not article and _RIGHTS.match(text)
            out.append((text, article, 0 if menu or rights else len(text), holder))
            kinds.append((numbers[-2] if len(numbers) > 1 else 0, stack[-1][0] if stack else ""))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if depth_a:
            linked += len(text)

    at = 0
    for tag in _TAG.finditer(html):
        if tag.start() > at:
            add(html[at:tag.start()])
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            add(" ")
        elif name in _INLINE and not (not tag["end"] and name == "span" and _noise(
                name, tag["rest"], False)):
            if name == "a":
                depth_a = max(0, depth_a + (-1 if tag["end"] else 1))
        else:
            close()
            depth_a = 0
            if tag["end"]:
                place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name),
                             None)
                if place is not None:
                    del stack[place:], numbers[place:]
            elif name not in _VOID and not tag["rest"].endswith("/"):
                # A block ends what cannot hold it.
                if stack and stack[-1][0] in _ENDS_ITSELF and (
                        name == stack[-1][0] or stack[-1][0] in ("p", "h1", "h2", "h3")):
                    stack.pop()
                    numbers.pop()
                _, always, article, holder = stack[-1] if stack else ("", False, 0, 0)
                if name in ("article", "main") and not article:
                    articles.append((holder, _named(tag["rest"], False) != _NONE))
                    article = len(articles) - 1
                level = _noise(name, tag["rest"], bool(article))
                if level in (_NAMED, _ALWAYS_BESIDE):
                    holders.append((holder, level, article))
                    holder = len(holders) - 1
                stack.append((name, always or level == _ALWAYS, article, holder))
                opened += 1
                numbers.append(opened)
    if at < len(html):
        add(html[at:])
    close()
    silent = _silent(out, holders, articles)
    return [(text, article, count, kind) for (text, article, count, holder), kind in zip(
        out, kinds, strict=True) if not silent[holder]]


def _sums(counts: list[float]) -> list[float]:
    half = WIDTH // 2
    return [sum(counts[max(0, i - half):i + half + 1]) for i in range(len(counts))]


def stretches(counts: list[float], marked: list[bool], kinds: list) -> list[tuple[int, int]]:
    """(first, end) of the stretches that surge: lines between points where the sums over windows
    are nothing or an article begins or ends, with a window of their own that sums up to `SURGE`
    of the largest. Of the others, the part between lines of a kind that these have (kind: element
    around, or 0 for none, and name)."""
    found, start = [], None
    for i, total in enumerate([*_sums(counts), 0]):
        if start is not None and (not total or marked[i] != marked[i - 1]):
            found.append((start, i))
            start = None
        if total and start is None:
            start = i
    peaks = [max(_sums(counts[first:end])) for first, end in found]
    enough = SURGE * max(peaks, default=0)
    surging = [bool(peak) and peak >= enough for peak in peaks]
    known = {kinds[i] for (first, end), surges in zip(found, surging, strict=True) if surges
             for i in range(first, end) if counts[i] and kinds[i][0]}
    kept = []
    for (first, end), surges in zip(found, surging, strict=True):
        alike = [i for i in range(first, end) if counts[i] and kinds[i] in known]
        if surges:
            kept.append((first, end))
        elif alike:
            kept.append((alike[0], alike[-1] + 1))
    return kept


def main_text(html: str | None) -> str:
    blocks = lines(html or "")
    counts = [count * (ARTICLE if article else 1) for _, article, count, _ in blocks]
    found = stretches(counts, [article > 0 for _, article, _, _ in blocks],
                      [kind for *_, kind in blocks])
    return "\n".join(blocks[i][0] for first, end in found for i in range(first, end) if counts[i])


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """The rows of `pages` with `text` and `n_chars`. Map-only."""
    kept = [c for c in pages.columns if c == html or c.lower() not in ("text", "n_chars")]

    def run(values: pd.Series) -> pd.Series:
        return pd.Series([main_text(v) for v in values], dtype=object)

    found = F.pandas_udf(run, "string")(F.col(f"`{html}`"))
    return pages.select(*[F.col(f"`{c}`") for c in kept], found.alias("text")).withColumn(
        "n_chars", F.length("text").cast("bigint"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).drop("html")
