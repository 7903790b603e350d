"""Main text of web pages by two passes of rules over their blocks.

The page is cut into blocks at block-level tags. The first pass decides what it can: blocks
inside menus, headers, footers, sidebars, notices, adverts, forms and comments, and blocks
that are mostly links, are not text; long blocks with the share of stop words of running
prose are. Short blocks, and long ones without stop words (code, tables, lists), stay open. In
the second pass each open block takes the label of the nearest decided neighbours in the same
part of the page, an article or what lies outside of one.

Stop words are known for the languages of ``STOP_WORDS``. On a page of any other language no
block is prose by them, so their density is unknown there: it decides nothing, and length and
links alone do. Characters of scripts written without spaces count double as length.

Parsing is linear in the page: tags are found by jumps to the next quote or bracket, and an
element is looked for among the open ones only if one of its name is open.
"""

import html
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.llm.common import arrow_map

#: The most frequent words of the languages, as used for stop-word density. Fixed values.
STOP_WORDS = {
    "en": "the of and to a in is it that was for on are as with his they at be this have from or had by but not what all were we when your can said there",
    "de": "der die das und in zu den ist nicht von mit sich des auf für im dem ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son aux mais elle ou cette ses",
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque esta entre cuando",
}
STOP = frozenset(word for words in STOP_WORDS.values() for word in words.split())

BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset("script style noscript template textarea select svg iframe object canvas audio video title head button".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME_TAGS = frozenset("nav footer aside form dialog menu fieldset".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
CHROME_NAMES = frozenset(
    "nav navbar navigation menu sidebar footer ad ads advert adverts advertisement banner promo sponsor sponsored cookie cookies consent notice notices "
    "alert newsletter subscribe signup login comment comments disqus reply replies respond share sharing social related recommended breadcrumb breadcrumbs "
    "popup modal overlay widget toolbar pagination pager masthead".split()
)
#: Name parts that say nothing of the content; inside an article a name of furniture holds nothing but these beside it.
NEUTRAL_NAMES = frozenset(
    "site page global main top bottom left right upper lower box bar wrapper wrap container inner outer list block area section button buttons link links "
    "post posts item items slot unit text message panel row col column group form trail article articles story stories user users reader readers visitor thread "
    "count icon icons media module region zone content holder header title label info this us js view more the our your".split()
)
HEADER_NAMES = frozenset(("header", "head", "topbar"))
MAIN_NAMES = frozenset(("articlebody",))
CLOSES_P = BLOCK_TAGS - frozenset(("html", "body", "head"))

SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.2, 0.3
LINKS = 0.33

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.DOTALL)
QUOTED = re.compile(r"""=\s*(["'])""")
WIDE = re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\u0e00-\u0e7f]")
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
WORD = re.compile(r"\w+")


@dataclass
class Block:
    """One block: its text, the characters of it inside links, and where it stands."""

    text: str
    link_chars: int
    place: str  # main, chrome or free
    part: int  # blocks of one element that was labelled share this number
    heading: bool
    label: str = ""


@dataclass
class _Open:
    tag: str
    place: str
    part: int
    dropped: bool
    inside: bool = False  # an article


def _tag_end(page: str, at: int) -> int:
    """The place of the ``>`` that ends a tag whose name ends at ``at``, or -1.

    Quotes hide it only right after an equals sign, and only if they are closed.
    """
    first = end = page.find(">", at)
    while end >= 0:
        opened = QUOTED.search(page, at, end)
        if not opened:
            return end
        at = page.find(opened.group(1), opened.end()) + 1
        if not at:
            return first
        end = page.find(">", at)
    return first


def _is_furniture(names: list[set[str]], inside: bool) -> bool:
    """Whether a class or id names page furniture; inside an article it must name nothing else besides."""
    for parts in names:
        if parts & CHROME_NAMES and (not inside or all(part in CHROME_NAMES or part in NEUTRAL_NAMES or part.isdigit() or len(part) < 2 for part in parts)):
            return True
    return False


def _names(attributes: str) -> tuple[list[set[str]], set[str], bool]:
    """The parts of each class and id, the roles, and whether the element is hidden."""
    names, roles, hidden = [], set(), False
    for match in ATTRIBUTE.finditer(attributes):
        key, value = match.group(1).lower(), (match.group(2) or "").strip("\"'")
        if key in ("class", "id"):
            names += [{part.lower() for part in NAME_PARTS.findall(name)} for name in value.split()]
        elif key in ("role", "itemprop"):
            roles.add(value.lower())
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", "").lower():
            hidden = True
    return names, roles, hidden


def blocks_of(page: str) -> list[Block]:
    """The non-empty blocks of a page in order."""
    blocks: list[Block] = []
    stack = [_Open("", "free", 0, False)]
    text: list[str] = []
    links: list[str] = []
    in_link = parts = 0
    heading = False
    tags: Counter = Counter()

    def push(entry: _Open):
        tags[entry.tag] += 1
        stack.append(entry)

    def cut(depth: int):
        while len(stack) > depth:
            tags[stack.pop().tag] -= 1

    def find(*names: str) -> int:
        """The depth of the innermost open element of these names, or 0."""
        if not any(tags[name] for name in names):
            return 0
        return next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in names)

    def close_block():
        nonlocal text, links
        words = " ".join(html.unescape("".join(text)).split())
        if words:
            linked = len(" ".join(html.unescape("".join(links)).split()))
            blocks.append(Block(words, linked, stack[-1].place, stack[-1].part, heading))
        text, links = [], []

    def say(part: str):
        if part and not stack[-1].dropped:
            text.append(part)
            if in_link:
                links.append(part)

    at = 0
    while at < len(page):
        match = TOKEN.search(page, at)
        if not match:
            say(page[at:])
            break
        say(page[at : match.start()])
        at = match.end()
        tag = (match.group(2) or "").lower()
        if tag:
            end = _tag_end(page, at)
            if end < 0:
                say(page[match.start() :])
                break
            attributes, at = page[at:end], end + 1
        else:
            if match.group().startswith("<![CDATA["):
                say(match.group()[9:].removesuffix("]]>"))
            continue
        ending = bool(match.group(1))
        if tag == "a":
            in_link = 0 if ending else 1
            continue
        if tag in RAW and not ending:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br" or tag in VOID and tag not in BLOCK_TAGS:
            say(" ")
            continue
        if tag not in BLOCK_TAGS and tag not in DROPPED:
            # inline markup: only one that is labelled as page furniture matters
            if ending:
                if len(stack) > 1 and stack[-1].tag == tag:
                    close_block()
                    cut(len(stack) - 1)
                continue
            names, roles, hidden = _names(attributes)
            if hidden or roles & CHROME_ROLES or _is_furniture(names, stack[-1].inside):
                close_block()
                parts += 1
                push(_Open(tag, "chrome", parts, stack[-1].dropped or hidden, stack[-1].inside))
            continue
        close_block()
        if ending:
            if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                heading = False
            if depth := find(tag):
                cut(depth)
                in_link = 0
            continue
        in_link = 0
        if tag == "hr":
            continue
        if tag in CLOSES_P and stack[-1].tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
            cut(len(stack) - 1)
        if tag in ("body", "article", "main"):  # an element left open before does not reach into these
            while depth := find("head", "button", "select"):
                cut(depth)
        heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        here = stack[-1]
        place, part = here.place, here.part
        names, roles, hidden = _names(attributes)
        inside = here.inside
        if tag in ("article", "main") or "main" in roles or roles & MAIN_NAMES:
            if place != "chrome" or not inside:
                parts += 1
                place, part = "main", parts
        elif tag not in ("html", "body"):
            chrome = tag in CHROME_TAGS or roles & CHROME_ROLES or _is_furniture(names, inside)
            chrome = chrome or not inside and (tag == "header" or any(parts & HEADER_NAMES for parts in names))
            if chrome or hidden:
                parts += 1
                place, part = "chrome", parts
        push(_Open(tag, place, part, here.dropped or hidden or tag in DROPPED, inside or place == "main"))
    close_block()
    return blocks


def stop_density(text: str) -> float:
    words = WORD.findall(text.lower())
    return sum(word in STOP for word in words) / len(words) if words else 0.0


def size_of(text: str) -> int:
    """Characters of a text, those of scripts without spaces twice."""
    return len(text) if text.isascii() else len(text) + len(WIDE.findall(text))


def first_pass(block: Block, known: bool = True) -> str:
    """``good``, ``bad``, or a label that is still open: ``near`` (likely good) and ``short``.

    ``known`` says whether the page is in a language with stop words.
    """
    size = size_of(block.text)
    linked = block.link_chars / len(block.text)
    if block.place == "chrome":
        return "bad"
    inside = block.place == "main"
    if linked > LINKS:
        if inside and known and stop_density(block.text) >= STOP_LOW:
            return "near"
        return "short" if inside and (block.heading or not known) else "bad"
    if size < SHORT:
        return "bad" if block.link_chars and not inside else "short"
    if not known:
        return "good" if size >= LONG else "near"
    density = stop_density(block.text)
    if density >= STOP_HIGH and size >= LONG or inside and density >= STOP_LOW:
        return "good"
    return "near" if density >= STOP_LOW else "short"


def is_known(blocks: list[Block]) -> bool:
    """Whether any block outside of page furniture has the share of stop words of running prose."""
    return any(block.place != "chrome" and size_of(block.text) >= SHORT and stop_density(block.text) >= STOP_LOW for block in blocks)


def second_pass(blocks: list[Block]) -> None:
    """Give open blocks the label of the nearest decided neighbours in their part of the page."""
    for place in ("main", "free"):
        own = [i for i, block in enumerate(blocks) if block.place == place]
        decided = [n for n, i in enumerate(own) if blocks[i].label in ("good", "bad")]
        has_text = any(blocks[i].label == "good" for i in own)
        before, labels = None, {}
        for n, i in enumerate(own):
            if blocks[i].label in ("good", "bad"):
                before = n
                continue
            later = bisect_left(decided, n)
            after = decided[later] if later < len(decided) else None
            ends = [(abs(m - n), blocks[own[m]].label) for m in (before, after) if m is not None]
            if not ends or not has_text and blocks[i].link_chars == 0:
                labels[i] = "good"  # nothing better on this part of the page
            elif len(ends) == 2 and ends[0][0] == ends[1][0] and ends[0][1] != ends[1][1]:
                labels[i] = "good" if blocks[i].label == "near" or blocks[i].heading else "bad"
            else:
                labels[i] = min(ends)[1]
        for i, label in labels.items():
            blocks[i].label = label
    if any(block.place == "main" and block.label == "good" for block in blocks):
        for block in blocks:  # an article makes everything beside it furniture
            if block.place == "free":
                block.label = "bad"


def main_text(page: str | None) -> str:
    """The text blocks of ``page``, joined by an empty line; empty for null or without any."""
    if not page:
        return ""
    blocks = blocks_of(page)
    known = is_known(blocks)
    for block in blocks:
        block.label = first_pass(block, known)
    second_pass(blocks)
    return "\n\n".join(block.text for block in blocks if block.label == "good")


def extract_main_text(pages: DataFrame, page_html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of ``page_html`` as column ``into``, and without ``page_html``.

    Null html gives an empty text. A column that is already called ``into`` is replaced.
    Repeated rows are each given their text; an empty table gives none.
    """
    kept = [field for field in pages.schema if field.name not in (page_html, into)]
    schema = ", ".join([f"`{field.name}` {field.dataType.simpleString()}" for field in kept] + [f"`{into}` string"])

    def factory():
        return lambda *columns: (*columns[:-1], [main_text(value) for value in columns[-1]])

    return arrow_map(pages.select(*(field.name for field in kept), page_html), schema, factory, rows=64)
