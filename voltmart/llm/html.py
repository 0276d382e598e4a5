"""Main text of web pages by block rules in two passes: content measures first, neighbours second."""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame

from voltmart.llm.common import map_batches, pieces

#: Frequent function words of the four languages.
STOP_WORDS = frozenset(
    "a about after all also an and are as at be been but by can for from had has have he her his i if in into is it its "
    "more no not of on one or our she so some that the their them then there these they this to was we were what when "
    "which who will with would you your "
    "aber als am an auch auf aus bei bin bis das dass dem den der des die doch du durch ein eine einem einen einer es für "
    "hat ich ihr im in ist ja kann man mehr mit nach nicht noch nur oder sein sich sie sind so über um und uns unter vom "
    "von vor war was wenn wie wir wird zu zum zur "
    "au aux avec ce ces cette comme dans de des du elle en est et eux il ils je la le les leur lui mais me même ne nous on "
    "ont ou où par pas plus pour qu que qui sa sans se ses si son sont sur tu un une vous y à été être "
    "al algo ante con contra como de del desde donde el ella ellos en entre era eres es esa ese eso esta este esto fue ha "
    "hasta hay la las le lo los más me mi muy no nos o os para pero por porque que se sea ser si sin sobre son su sus "
    "también te un una uno y ya yo".split()
)
#: Elements that hold no text of the page, those of them that hold no markup either, elements whose text is
#: never the article, and block elements.
HIDDEN = frozenset("script style noscript template head svg math iframe object canvas audio video title select datalist".split())
RAW = ("script", "style", "noscript", "title", "iframe")
BOILERPLATE = frozenset("nav header footer aside form button menu dialog".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul br".split()
)
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
PARENTS = frozenset("article body div main section td".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Parts of a class, id or role name that mark what is not the article; those that do so only as the whole name
#: or beside words for page parts, as "market-share" and "related-work" may well be in the article; and such words.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comments cookie cookies "
    "disqus footer masthead nav navbar navigation newsletter pagination popup promo promos promotion sidebar sponsor sponsored "
    "sponsors toolbar widget widgets complementary contentinfo".split()
)
WEAK_MARKS = frozenset("comment menu notice notices related search share sharing social subscribe".split())
PAGE_PARTS = frozenset(
    "area articles bar block bottom box button buttons container content form group header icons inner item items left link "
    "links list main media outer page panel post posts right section site story stories title top wrap wrapper".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|[^>])*+)(?:>|\Z)", re.S)
#: One attribute after the other: a quote opens a value behind "=" only, and without its end takes the rest.
_ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?")
_NAMES = re.compile(r"[\s]+")
_PARTS = re.compile(r"[-_]+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|$)", re.I) for tag in RAW}
_SPACES = re.compile(r"\s+")

LONG, SHORT = 120, 40
STOP_HIGH, STOP_LOW, LINKS_HIGH = 0.2, 0.1, 0.34


class Block:
    __slots__ = ("parts", "linked", "boilerplate", "article", "heading", "parent")

    def __init__(self, boilerplate: bool, article: bool, heading: bool, parent: int):
        self.parts, self.linked, self.boilerplate, self.article, self.heading = [], 0, boilerplate, article, heading
        self.parent = parent  # number of the innermost element of ``PARENTS`` around it

    def text(self) -> str:
        return _SPACES.sub(" ", references.unescape("".join(self.parts))).strip()


def _marked_name(name: str) -> bool:
    parts = [p for p in _PARTS.split(name) if p]
    if not MARKS.isdisjoint(parts) or parts in (["page", "header"], ["site", "header"], ["top", "header"]):
        return True
    return not WEAK_MARKS.isdisjoint(parts) and all(p in WEAK_MARKS or p in PAGE_PARTS or p.isdigit() for p in parts)


def _marked(rest: str) -> bool:
    for name, *values in _ATTRIBUTE.findall(rest):
        value = next((v for v in values if v), "").lower()
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name in ("class", "id", "role") and any(_marked_name(n) for n in _NAMES.split(value)):
            return True
    return False


def blocks(page: str) -> list[Block]:
    """Text blocks in page order, each with what stands open around it."""
    found: list[Block] = []
    stack: list[tuple[str, bool, bool, int]] = []  # tag, boilerplate, article, parent: of the elements that are open
    current: Block | None = None
    links, at, skip = 0, 0, None
    standing: Counter = Counter()  # how many elements of a tag are open

    def pop() -> str:
        tag = stack.pop()[0]
        standing[tag] -= 1
        return tag

    def add(text: str) -> None:
        nonlocal current
        if current is None:
            _, boiler, article, parent = stack[-1] if stack else ("", False, False, 0)
            current = Block(boiler, article, any(standing[h] for h in HEADINGS), parent)
            found.append(current)
        current.parts.append(text)
        if links:
            current.linked += len(text)

    while match := _TOKEN.search(page, at):
        if match.start() > at and skip is None:
            add(page[at : match.start()])
        at = match.end()
        tag = (match["tag"] or "").lower()
        raw = tag in RAW and not match["close"] and not match["rest"].endswith("/")
        if raw:  # no tokens before the end tag, as in "i<n" of a script; without one the element takes the rest
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
        if skip is not None:
            if tag == skip and match["close"]:
                skip = None
            continue
        if not tag:
            continue
        if match["close"]:
            if standing[tag]:
                while pop() != tag:
                    pass
            if tag == "a":
                links = max(0, links - 1)
        elif tag in HIDDEN:
            skip = None if raw or match["rest"].endswith("/") else tag
            current = None if tag in BLOCKS else current
        else:
            if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == tag:
                pop()  # the end tag may be left out
            boiler, article = (stack[-1][1], stack[-1][2]) if stack else (False, False)
            if tag not in VOID:
                inside = article or tag in ("article", "main")
                # a header inside the article holds its title
                own = tag in BOILERPLATE and not (tag == "header" and article) or _marked(match["rest"])
                parent = match.start() + 1 if tag in PARENTS else stack[-1][3] if stack else 0
                stack.append((tag, boiler or own and tag not in ("html", "body", "main"), inside, parent))
                standing[tag] += 1
            if tag == "a":
                links += 1
        if tag in BLOCKS:
            current = None
    if at < len(page) and skip is None:
        add(page[at:])
    return found


def _first_pass(block: Block, text: str) -> str:
    """good, bad, near (nearly good) or short, by length, stop words and link density."""
    if block.boilerplate:
        return "bad"
    share = block.linked / max(1, sum(map(len, block.parts)))
    if share > LINKS_HIGH or "\xa9" in text and len(text) < LONG:
        return "bad"
    if block.heading or len(text) < SHORT:
        return "short"
    words = text.lower().split()
    stops = sum(w.strip(".,;:!?\"'()#*$%&|") in STOP_WORDS for w in words) / max(1, len(words))
    if stops >= STOP_HIGH:
        return "good" if len(text) >= LONG else "near"
    return "near" if stops >= STOP_LOW or block.article else "short" if len(text) < LONG else "bad"


def _foreign(block: Block, text: str) -> bool:
    share = block.linked / max(1, sum(map(len, block.parts)))
    sentence = len(text) >= LONG and text.rstrip("\"'»”)")[-1:] in (".", "!", "?", "…", "。", "！", "？", "।", "؟")
    return sentence and not block.boilerplate and share <= LINKS_HIGH and "\xa9" not in text


def main_text(page: str | None) -> str:
    """Blocks of the main text, one per line.

    First pass: a block in navigation, header, footer, form or another marked part is bad, as is one of high link density;
    long blocks with many stop words are good. Second pass: a short or nearly good block is good beside a good one of the
    same parent element, or else takes the label of the nearest decided block before and after it; where these differ a
    nearly good block and a heading before a good block are kept. Inside an article element undecided blocks are kept.
    Where no block has the stop words, as in other languages, long blocks of few links that are a sentence are good.
    """
    found = [(b, t) for b in blocks(page or "") if (t := b.text())]
    labels = [_first_pass(b, t) for b, t in found]
    if not any(x in ("good", "near") for x in labels):
        labels = ["good" if x == "bad" and _foreign(b, t) else x for (b, t), x in zip(found, labels)]
    if any(b.article and x != "bad" for (b, _), x in zip(found, labels)):
        labels = [x if b.article else "bad" for (b, _), x in zip(found, labels)]
    before, last = [], "bad"
    for (b, _), x in zip(found, labels):
        before.append(last)
        last = x if x in ("good", "bad") else last
    after, last = [], "bad"
    for x in reversed(labels):
        after.append(last)
        last = x if x in ("good", "bad") else last
    after.reverse()
    good_parents = {b.parent for (b, _), x in zip(found, labels) if x == "good"}
    keep = []
    for (block, text), label, a, b in zip(found, labels, before, after):
        if label in ("near", "short"):
            sure = block.article or block.parent in good_parents or a == b == "good"
            label = "good" if sure or label == "near" and "good" in (a, b) or block.heading and b == "good" else "bad"
        if label == "good":
            keep.append(text)
    return "\n".join(keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row per page; a null, empty or contentless page has an empty text.

    Pages are taken one by one, so repeated rows, null ids and equal urls give a row each, and an empty table gives an empty
    result. A page of any length is held by one task, whose time grows with the page's length.
    """
    rows = pages.select(
        pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
        pages[html_col].cast("string").alias("text"),
    )

    def run(batches) -> Iterator[dict]:
        for batch in pieces(batches):
            texts = [main_text(h) for h in batch.column("text").to_pylist()]
            yield {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts,
                   "n_chars": [len(t) for t in texts]}

    return map_batches(rows, run, "page_id long, url string, text string, n_chars long")
