"""Main text of web pages by a maximum-scoring subsequence (operator 9)."""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changewatch.llm.common import mapped, slices, text_of

# Element names by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas textarea title select button".split())
BOILERPLATE = frozenset("nav footer aside form dialog menu head".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
CONTENT = frozenset("article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words in class names and ids of elements that are not part of an article.
HINTS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs comment commentlist comments "
    "consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notices notification overlay pager pagination popup promo promotion recommended related reply replies respond share "
    "sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
#: Whole class names of elements that hold the article, whatever else they are called.
HOLDERS = frozenset("article body container content entry layout main page post text wrapper".split())

#: Pages written for this module; the main text stands between [[ and ]]. The weights are fitted on them.
LABELLED = [
    "<html><head><title>Rain</title></head><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul>"
    "</nav><div class='ad'>Buy new boots today</div><article>[[<h1>Rain in the north</h1><p>It rained for three days and the "
    "river rose.</p><p>Nobody was <b>hurt</b>.<br>More rain is due.</p>]]</article><footer>&copy; The paper</footer></body></html>",
    "<body><header><h1>Daily post</h1><a href='/a'>About</a></header><main>[[<h2>A short walk</h2><p>We left early and came "
    "back late, with a <a href='/m'>map</a> of the hills.</p><ul><li>Bread</li><li>Cheese</li></ul>]]<section class='comments'>"
    "<p>Nice walk, I went there as well</p><p>Me too</p></section></main><aside>Popular posts of this week</aside></body>",
    "<body><div id='menu'><a href='/1'>One</a> <a href='/2'>Two</a> <a href='/3'>Three</a></div><div class='text'>[[<p>The old mill "
    "stands at the end of the lane. It has not been used for years.</p><p>Children play there in summer.</p>]]</div><form>"
    "<p>Write to us about this page</p></form><div class='footer'>All rights reserved <a href='/p'>Privacy</a></div></body>",
    "<body><div class='cookie-notice'>We use cookies to make this site work</div><table><tr><td><a href='/x'>Index</a></td><td>"
    "<a href='/y'>Search</a></td></tr></table>[[<p>Notes on grafting apples. Cut the scion in winter and keep it cold.</p><p>Bind "
    "it in spring.</p><blockquote>Patience is the best tool.</blockquote>]]<ul><li><a href='/q'>Next</a></li><li><a href='/r'>"
    "Back</a></li></ul></body>",
]
EVENT = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([a-zA-Z-]+)")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: How many times the words outside all zones an element of HINTS must hold to be the page itself and not a part beside the article.
WRAPS = 4


def zone_kind(name: str, attributes: str, inside: bool) -> str:
    """"firm" or "loose" for an element of a kind that an article does not hold, else "". Loose are forms and what only a word in its class or
    id tells, as these are also given to what wraps a whole page. A header in an article is a part of it."""
    firm = name in BOILERPLATE and name != "form" or name == "header" and not inside
    if firm or name in CONTENT or name in ("html", "body"):
        return "firm" if firm else ""
    kind = "loose" if name == "form" else ""
    for key, *values, bare in ATTRIBUTE.findall(attributes):
        value, key = "".join(values), (key or bare).lower()
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return "firm"
        if key == "role" and value.lower() in ROLES and not (name == "form" and value.lower() == "form"):
            return "firm"
        if key in ("class", "id") and HOLDERS.isdisjoint(value.lower().split()):
            words = {word.lower() for word in PART.findall(value)} - ({"header"} if inside else set())
            if not HINTS.isdisjoint(words):
                kind = "loose"
    return kind


class Zone:
    """An element of a zone kind: what it holds, and in the end whether its words stay."""

    def __init__(self, name: str, kind: str, around: Zone | None) -> None:
        self.name, self.kind, self.around = name, kind, around
        self.words = 0  # outside links and zones within that do not stay
        self.holds = set()  # of CONTENT
        self.stays = False


def settle(zones: list[Zone], outside: int, content_outside: set[str]) -> None:
    """Let zones stay that wrap the page: those that hold its <main>; and, from the inside out and the largest first, loose ones with more
    words than there are around them and in others that stay there if they are forms or hold the <article>, WRAPS times as many otherwise."""
    near: dict[Zone | None, list[Zone]] = {None: []}
    seen = {None: outside}  # words of a zone and those around it, without zones within
    for zone in zones:
        seen[zone] = seen[zone.around] + zone.words
        near[zone] = []
        near[zone.around].append(zone)
    for around in [*reversed(zones), None]:  # in the order of their starts, so inner ones come first
        for zone in sorted(near[around], key=lambda zone: -zone.words):
            factor = 1 if zone.name == "form" or "article" in zone.holds and not content_outside else WRAPS
            zone.stays = ("main" in zone.holds and "main" not in content_outside
                          or zone.kind == "loose" and zone.words > factor * seen[around])
            seen[around] += zone.words * zone.stays
            if around is not None:
                around.holds |= zone.holds
                around.words += zone.words * zone.stays
    for zone in zones:
        zone.stays = zone.stays and (zone.around is None or zone.around.stays)


def events(page: str, whole: bool = False) -> list[tuple[str, str, str]]:
    """The page in order: ("text", context, text) and ("tag", name, what it does to text: "block", "space" or ""). Each character is
    looked at a bounded number of times. Contexts: "outside" where the page has an article and this is not it, else "main" in an article
    or "plain", with "-link" in links. Elements that are no part of an article are left out, with a "gap" for each of their
    tags, unless the ``whole`` page is asked for. Unclosed elements end with the element around them."""
    found: list[tuple[str, str, str, Zone | None]] = []
    stack: list[tuple[str, bool]] = []
    depths: defaultdict[str, list[int]] = defaultdict(list)  # where the open elements of a name stand in the stack
    endless: set[str] = set()  # names whose end tag does not come any more
    zones: list[Zone] = []
    zone: Zone | None = None
    content = links = at = outside = 0
    content_outside: set[str] = set()
    opened = dict.fromkeys(CONTENT, 0)

    def pop() -> None:
        nonlocal zone, content, links
        name, is_zone = stack.pop()
        depths[name].pop()
        zone = zone.around if is_zone else zone
        if name in CONTENT:
            opened[name] -= 1
        content -= name in CONTENT
        links -= name == "a"

    def close(name: str, within: tuple[str, ...] = ()) -> None:
        """End the innermost element of the name and what is open in it, if none of ``within`` is between."""
        if depths[name] and not any(depths[other] and depths[other][-1] > depths[name][-1] for other in within):
            depth = depths[name][-1]
            while len(stack) > depth:
                pop()

    def text(upto: int) -> None:
        nonlocal outside
        if upto > at and (own := page[at:upto].strip()):
            found.append(("text", ("main" if content else "plain") + "-link" * bool(links), own, zone))
            words = 0 if links else len(own.split())
            if zone is None:
                outside += words
            else:
                zone.words += words
            if content:
                (content_outside if zone is None else zone.holds).update(name for name in CONTENT if words and opened[name])
        elif upto > at:
            found.append(("text", "space", " ", zone))

    while True:
        start = page.find("<", at)
        if start < 0:
            break
        event = EVENT.match(page, start) or LOOSE.match(page, start)
        if event is None:  # a lone sign is text
            step = page.find("<", start + 1)
            text(step if step >= 0 else len(page))
            at = step if step >= 0 else len(page)
            continue
        if page[start:start + 9] == "<![CDATA[":
            text(start)
            at = event.end()
            continue
        if start > at and page[start - 1].isspace() or page[event.end():event.end() + 1].isspace():
            text(start)
            found.append(("text", "space", " ", None))
        else:
            text(start)
        at = event.end()
        if event.re is EVENT and event.group(2) is None:
            continue
        closing, name, attributes = event.group(1), event.group(2).lower(), event.group(3)
        what = "" if name in INLINE and name != "br" else "space" if name in ("br", "td", "th") else "block"
        found.append(("tag", name, what, zone))
        if closing:
            close(name)
        elif name in RAW:
            end = None if name in endless else re.compile(rf"</{re.escape(name)}[\s>/]", re.I).search(page, at)
            if end is None:
                endless.add(name)
                if name in ("script", "style", "textarea", "title", "template"):
                    at = len(page)
            else:
                stop = page.find(">", end.start())
                at = stop + 1 if stop >= 0 else len(page)
        elif name not in VOID and not attributes.endswith("/"):
            if name not in INLINE:
                close("p", ("div", "section", "article", "main", "td", "li", "blockquote"))
            if name == "body":
                close("head")
            if name in ("li", "tr", "td", "th", "dt", "dd", "option"):
                close(name, ("ul", "ol", "table", "dl", "select"))
            kind = "" if whole else zone_kind(name, attributes, bool(content))
            if kind:
                zone = Zone(name, kind, zone)
                zones.append(zone)
            depths[name].append(len(stack))
            stack.append((name, bool(kind)))
            content += name in CONTENT
            if name in CONTENT:
                opened[name] += 1
            links += name == "a"
    text(len(page))
    settle(zones, outside, content_outside)
    kept = [(kind, name, value, own is None or own.stays) for kind, name, value, own in found]
    has_content = any(stays and kind == "text" and name.startswith("main") for kind, name, _, stays in kept)
    shown = []
    for kind, name, value, stays in kept:
        if kind == "tag":
            shown.append((kind, name, value if stays or not value else "gap"))
        elif stays:
            shown.append((kind, name.replace("plain", "outside") if has_content else name, value))
    return shown


def fit(labelled: list[str]) -> dict[str, float]:
    """Log odds of each kind of word, and of each tag, to be in the main text. Tags never score above -0.01."""
    inside: Counter[str] = Counter()
    outside: Counter[str] = Counter()
    for page in labelled:
        main = False
        for kind, name, value in events(page):
            if kind == "tag":
                (inside if main else outside)["<" + name] += 1
                continue
            for word in re.findall(r"\[\[|\]\]|[^\s\[\]]+", value):
                if word in ("[[", "]]"):
                    main = word == "[["
                else:
                    (inside if main else outside)[name] += 1
    weights = {}
    for key in inside.keys() | outside.keys():
        odds = math.log((inside[key] + 0.5) / (outside[key] + 0.5))
        weights[key] = min(odds, -0.01) if key[0] == "<" else max(-4.0, min(4.0, odds))
    return weights


@lru_cache(maxsize=1)
def fitted() -> dict[str, float]:
    return fit(LABELLED)


# Contexts that the labelled pages need not show: what a context falls back to.
FALLBACK = {"main-link": "main", "outside-link": "outside", "plain-link": "plain"}


def best_region(found: list[tuple[str, str, str]], weights: dict[str, float]) -> tuple[int, int]:
    """Ends of the contiguous run of events with the largest sum, by one linear scan; (0, 0) if no sum is positive. Of equal
    sums the earliest and shortest wins."""
    best, sums, start, region = 0.0, 0.0, 0, (0, 0)
    for i, (kind, name, value) in enumerate(found):
        if kind == "tag":
            score = weights.get("<" + name, -0.01) * {"block": 1, "gap": 0}.get(value, 0.1)
        elif name == "space":
            continue
        else:
            weight = weights.get(name, weights.get(FALLBACK.get(name, ""), -1.0))
            score = weight * len(value.split())
        if sums <= 0:
            sums, start = 0.0, i
        sums += score
        if sums > best:
            best, region = sums, (start, i + 1)
    return region


def whole_articles(found: list[tuple[str, str, str]], first: int, last: int) -> tuple[int, int]:
    """The region with the rest of the articles that it begins and ends in: in an article, links and short items belong to the text,
    whatever they score."""
    def inside(at: int) -> bool:
        kind, name, _ = found[at]
        return kind == "text" and (name.startswith("main") or name == "space") or kind == "tag" and name not in CONTENT

    if any(kind == "text" and name.startswith("main") for kind, name, _ in found[first:last]):
        while last < len(found) and inside(last):
            last += 1
        while first > 0 and inside(first - 1):
            first -= 1
    return first, last


def main_text(page: str) -> str:
    """The blocks of the best region, to the ends of its article, joined by line feeds. A page that has none is looked at again with nothing
    left out."""
    found = events(page)
    first, last = whole_articles(found, *best_region(found, fitted()))
    if first == last:
        found = events(page, whole=True)
        first, last = best_region(found, fitted())
    blocks: list[list[str]] = [[]]
    for kind, name, value in found[first:last]:
        if kind == "text":
            blocks[-1].append(value)
        elif value in ("block", "gap"):
            blocks.append([])
        elif value == "space":
            blocks[-1].append(" ")
    joined = (" ".join(html.unescape("".join(block)).split()) for block in blocks)
    return "\n".join(block for block in joined if block)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """key, url, text and n_chars of every page, from the whole page. A null page is empty and has an empty text; null and
    repeated keys are kept as they are; other columns are not looked at; an empty table gives an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "html", 1 << 22):
            own = [main_text(page) for page in texts]
            yield pa.RecordBatch.from_arrays(
                [rows.column("key"), rows.column("url"), pa.array(own, pa.string()),
                 pa.array([len(text) for text in own], pa.int64())], ["key", "url", "text", "n_chars"])

    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), text_of(source).alias("html"))
    kind = rows.schema["key"].dataType.simpleString()
    return (mapped(rows, run, f"key {kind}, url string, text string, n_chars long")
            .withColumnRenamed("key", key).withColumnRenamed("url", url))
