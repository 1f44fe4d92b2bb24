"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass classifies blocks
by link density, length and stop-word density; elements that name themselves
navigation, advert, comment and so on are bad as a whole, unless they hold the
article. Where no listed language is seen, length and link density decide alone.
The second pass gives every ambiguous block the label of the nearest decided one
around it, within the article if the page marks one that the text around it does
not outweigh.

Defined results: a null page is empty; a page without main text gives the empty
text; unclosed elements end with the element around them, and scripts, styles
and comments that never end hide the rest.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

#: Common function words of the languages of the pages.
STOP_WORDS = frozenset(
    """
    a about after all also an and any are as at be because been but by can could did do for from had has have he her
    his how i if in into is it its me more my no not of on one only or other our out she so some than that the their
    them then there these they this to up was we were what when which who will with would you your
    au aux avec ce ces cette dans de des du elle elles en est et eux il ils je la le les leur lui mais ne nous ou par
    pas plus pour que qui sa se ses son sont sur te tu un une vous y
    aber als am an auch auf aus bei bin bis das dass dem den der des die ein eine einem einen einer er es für hat ich
    ihr im in ist ja mit nach nicht noch nur oder sein sich sie sind so um und uns von vor war was wenn wie wir wird zu
    zum zur
    al como con cual de del donde el ella ellos en entre era es esta este ha la las le lo los más me mi muy no nos o
    para pero por que se si sin sobre su sus también un una y ya
    """.split()
)
#: Block-level elements, elements never shown as text, page furniture.
BLOCK_TAGS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot
    th thead tr ul
    """.split()
)
RAW_TAGS = frozenset("script style textarea title xmp noscript iframe template svg math canvas object".split())
FURNITURE_TAGS = frozenset("head nav footer aside form menu select button fieldset dialog".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form".split())
FURNITURE_NAMES = frozenset(
    """
    ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies
    copyright disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices overlay
    pagination popup promo promotion related recommended replies respond share sharing sidebar signup social sponsor
    sponsored subscribe toolbar widget
    """.split()
)
#: Of these, the ones that mark a compound name by its last part; others have a second sense there (market-share).
LAST_PARTS = FURNITURE_NAMES - frozenset(
    "consent cookie cookies copyright header notice notices overlay promotion related recommended respond share sharing social".split()
)
#: First parts that say something of a layout, and last parts of things that hold what the first part names.
STATES = frozenset("has have hide is no non not show under with without".split())
HOLDERS = frozenset(
    """
    area bar block bottom box buttons column container form holder inner items left link links list message notice outer
    panel posts right section slot text thread top unit wrap wrapper
    """.split()
)
#: Names and elements that stay furniture even around an article: comments and teasers are articles too.
FIRM_NAMES = frozenset("comment comments disqus recommended related replies respond".split())
FIRM_TAGS = frozenset("head nav footer aside menu select".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())

#: A block with a larger share of its characters in links is bad.
MOST_LINKS = 0.33
#: Characters of a block that is decided by its stop words; shorter ones are ambiguous.
LEAST_LENGTH = 70
#: The same in wide characters, of scripts that write more with each of them.
LEAST_WIDE = 25
#: Share of stop words of running text, and the share below which a page is in no listed language.
LEAST_STOP_WORDS = 0.15
FOREIGN = 0.03

_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+|[^>]*)>", re.DOTALL
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[^\W\d_]+")
_WIDE = re.compile("[\u2e80-\ud7ff\uf900-\ufaff]")


@dataclass
class Block:
    text: str
    links: int
    bad: bool
    article: int
    words: int = 0
    stops: int = 0
    label: str = field(default="")


def _named(names: str, in_article: bool) -> str:
    """The furniture that a class or id names, or nothing."""
    for name in names.split():
        parts = [x.lower() for x in _NAME_PART.findall(name)]
        whole = "".join(parts)
        if whole in FURNITURE_NAMES and not (in_article and whole == "header"):
            return whole
        if len(parts) < 2 or parts[0] in STATES:
            continue
        if parts[-1] in LAST_PARTS or (parts[-1] == "header" and parts[0] in ("global", "main", "site", "top")):
            return parts[-1]
        if parts[0] in FURNITURE_NAMES and all(x in HOLDERS for x in parts[1:]):
            return parts[0]
    return ""


def _furniture(tag: str, attributes: str, in_article: bool) -> int:
    """0 for no furniture, 1 for furniture unless it holds an article, 2 for furniture in any case."""
    if tag in FURNITURE_TAGS:
        return 2 if tag in FIRM_TAGS else 1
    if tag == "header" and not in_article:
        return 1
    if tag in ("html", "body", "main") or not attributes.strip():
        return 0
    found = 0
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            found = 2
        elif name == "style" and re.search(r"display\s*:\s*none", value):
            found = 2
        elif name == "role" and value.lower() in FURNITURE_ROLES:
            found = max(found, 1)
        elif name in ("class", "id"):
            named = _named(value, in_article)
            if tag == "article":
                named = named if named in FIRM_NAMES and in_article else ""
            found = max(found, 2 if named in FIRM_NAMES else 1 if named else 0)
    return 2 if re.search(r"(?:^|\s)hidden(?:\s|/|$)", _ATTRIBUTE.sub(" ", attributes), re.IGNORECASE) else found


def _keeps(entry: tuple[str, int, int]) -> bool:
    """Whether an open element stays furniture when an article begins in it: named or hidden, not merely left open."""
    return entry[1] == 2 and entry[0] not in FIRM_TAGS


def blocks_of(page: str) -> list[Block]:
    """The blocks with text, in page order; ``article`` numbers the article a block is in, 0 for none."""
    found: list[Block] = []
    stack: list[tuple[str, int, int]] = []  # tag, furniture, article
    texts: list[str] = []
    links = articles = at = 0
    link_depth = False

    def end_block() -> None:
        nonlocal links
        text = " ".join(html.unescape("".join(texts)).split())
        if text:
            bad = any(f for _, f, _ in stack)
            found.append(Block(text, links, bad, stack[-1][2] if stack else 0))
        texts.clear()
        links = 0

    def add(part: str) -> None:
        nonlocal links
        if part:
            texts.append(part)
            if link_depth:
                links += len("".join(html.unescape(part).split()))

    while True:
        match = _MARKUP.search(page, at)
        add(page[at : match.start()] if match else page[at:])
        if not match:
            break
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        closing, attributes = match[1], match[3] or ""
        if not closing and tag in RAW_TAGS:
            if attributes.endswith("/"):
                continue
            end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        elif tag == "br":
            texts.append(" ")
        elif tag == "a":
            link_depth = not closing
        elif closing:
            if tag in BLOCK_TAGS:
                end_block()
                link_depth = False
            if any(t == tag for t, _, _ in stack):
                while stack.pop()[0] != tag:
                    pass
        elif tag in BLOCK_TAGS:
            end_block()
            link_depth = False
            if tag in ("article", "main"):
                # Furniture that was never closed ends where the article begins; what holds one is none.
                while stack and stack[-1][1] and not _keeps(stack[-1]):
                    stack.pop()
                stack = [(t, f if f == 2 else 0, a) for t, f, a in stack]
                articles += not any(a for _, _, a in stack)
            if tag in ("p", "li", "option", "dt", "dd", "tr", "td", "th") and stack and stack[-1][0] == tag:
                stack.pop()  # these close the one before
            if tag not in VOID_TAGS and not attributes.endswith("/"):
                article = articles if tag in ("article", "main") else (stack[-1][2] if stack else 0)
                stack.append((tag, _furniture(tag, attributes, bool(article)), article))
        elif tag not in VOID_TAGS and (kind := _furniture(tag, attributes, bool(stack and stack[-1][2]))):
            end_block()
            stack.append((tag, kind, stack[-1][2] if stack else 0))
    end_block()
    return found


def classify(blocks: list[Block]) -> None:
    """First pass: good, bad or ambiguous; second pass: the nearest decided label."""
    for b in blocks:
        words = _WORD.findall(b.text.lower())
        b.words, b.stops = len(words), sum(w in STOP_WORDS for w in words)
        b.bad = b.bad or b.links > MOST_LINKS * len("".join(b.text.split()))
        b.bad = b.bad or (b.text.startswith(("©", "(c)")) and len(b.text) < 200)
    shown = [b for b in blocks if not b.bad]
    foreign = sum(b.stops for b in shown) < FOREIGN * sum(b.words for b in shown)

    def runs(b: Block) -> bool:
        """Whether a block is running text by itself; where no listed language is seen, its length decides."""
        if foreign:
            return len(b.text) >= LEAST_LENGTH or len(_WIDE.findall(b.text)) >= LEAST_WIDE
        return len(b.text) >= LEAST_LENGTH and b.stops >= LEAST_STOP_WORDS * b.words

    # An article that is outweighed by running text around it is a teaser, not the main text.
    inside = sum(len(b.text) for b in shown if b.article)
    marked = inside > 0 and inside >= sum(len(b.text) for b in shown if not b.article and runs(b))
    for b in blocks:
        if b.bad or (marked and not b.article):
            b.label = "bad"
        elif runs(b):
            b.label = "good"
    # Distance to, and label of, the nearest decided block of the same region on either side.
    near: list[list[tuple[int, str]]] = [[] for _ in blocks]
    for order in (range(len(blocks)), range(len(blocks) - 1, -1, -1)):
        last: dict[int, tuple[int, str]] = {}
        for i in order:
            b = blocks[i]
            if b.label:
                last[b.article] = (i, b.label)
            elif b.article in last:
                j, label = last[b.article]
                near[i].append((abs(i - j), label))
    for b, sides in zip(blocks, near, strict=True):
        if b.label:
            continue
        # At equal distances good wins; with nothing decided around it an article is taken whole.
        if sides:
            least = min(d for d, _ in sides)
            b.label = "good" if (least, "good") in sides or (b.article and (any(x == "good" for _, x in sides))) else "bad"
        else:
            b.label = "good" if b.article or b.stops else "bad"


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    classify(blocks)
    return "\n".join(b.text for b in blocks if b.label == "good")


def extracted(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The columns of ``pages`` but the page itself, with text and n_chars; columns of these names give way."""
    kept = [f for f in pages.schema.fields if f.name not in (html_col, "text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*batch.schema.names[1:], "text", "n_chars"],
            )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "text string, n_chars long"])
    return pages.select(f"`{html_col}`", *[f"`{f.name}`" for f in kept]).mapInArrow(run, schema)
