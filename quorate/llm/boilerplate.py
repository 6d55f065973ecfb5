"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. Pass 1 decides a block by its link density, its length and its
stop-word density; blocks inside menus, asides, footers, forms and the like (by tag) are boilerplate. Blocks that stay
ambiguous, mostly short ones, inherit in pass 2 the label of the nearest decided neighbour in the same region of the
page; without one there, an article's blocks are text, and other blocks take the nearest decided block of the page.

Names (class, id, role) are evidence only. An element is marked by a name that is a known one, or one whose parts
are all known or say nothing (site-footer, ad-box); names of a layout (has-sidebar, no-comments, share-enabled) mark
nothing. A block counts the marked elements around it, and the page's text is looked for among the blocks with the
least count that an article (or, without one, text) has: so reader comments and adverts go, and a page whose wrapper is
marked keeps its article.

Scripts that are written without blanks are measured in characters, two for a word, with stop characters of their own.
Where a page has hardly any stop word of the known languages, length and link density decide alone.

Defined results: null and empty pages give an empty text. Unclosed tags and comments end with the page; a tag cut
off at the end is dropped. After a tag whose quotes never close, quotes don't hide the end of a tag. Repeated rows are
extracted each; pages of any length are read whole, in time linear in their length; an empty table gives no rows;
other columns than those that are kept are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from quorate.llm.common import arrow_rows

#: Tags that end a block.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is never text.
RAW_TAGS = frozenset("script style noscript template iframe object svg math canvas textarea".split())
#: Elements that are boilerplate as a whole.
BOILERPLATE_TAGS = frozenset("nav footer aside form dialog menu select button head title".split())
#: Parts of class, id and role names that mark boilerplate.
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup sidebar sidebars widget widgets related recommended trending share sharing social menu "
    "navbar navigation nav breadcrumb breadcrumbs pagination pager footer copyright comment comments commentlist disqus reply replies respond "
    "responses toolbar topbar masthead search login skip toc tags contentinfo complementary".split()
)
#: Parts of names that say nothing beside those.
NEUTRAL_NAMES = frozenset(
    "site page main top bottom left right list box bar wrap wrapper container area section block inner outer item items link links form text body head header "
    "content post posts article articles the and my wp widget js c p s m col column group panel slot unit row media primary secondary global user reader".split()
)
#: Elements and names that hold the article.
ARTICLE_TAGS = frozenset(["article", "main"])
ARTICLE_NAMES = frozenset(["main"])
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Frequent function words of four languages.
STOP_WORDS = frozenset(
    "the of and to in a is that for it as was with be by on not he his but at are this have had from or an they which you were her all she there would "
    "their we him been has when who will no more if out so what up can about into than them other some could my do your one "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind "
    "noch wie einem über so zum war haben nur oder aber vor zur bis mehr durch man sein wurde "
    "le la les de des du un une et à en que qui est dans pour pas au sur ne se ce il sont par avec plus son sa ou mais comme on nous vous leur cette aux été "
    "el los las del y que en un una por con para es no se al lo como más su sus pero fue este esta entre cuando muy sin sobre también me ya hay".split()
)
#: Scripts that are written without blanks, and their frequent function characters (Japanese, Chinese).
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f"
STOP_CHARACTERS = "のはをにがとでもたてれさるな的是在了不和有我这个们中上为以会来也就说对要"
SHORT_WORDS, LONG_WORDS = 8, 20
#: Letters that count as LONG_WORDS in scripts without blanks; used for pages in other languages than the known.
LONG_CHARS = 120
#: Characters of a script without blanks that count as a word.
CHARS_A_WORD = 2
STOP_HIGH, STOP_LOW = 0.25, 0.1
#: Least share of stop words in a page's text blocks for its language to be a known one.
STOP_KNOWN = 0.07
MOST_LINKS, MANY_LINKS = 0.5, 0.25

_PIECE = re.compile(r"<!--|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+>|<")
_PLAIN_PIECE = re.compile(r"<!--|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^<>]*+)>|<[!?][^>]*+>|<")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(rf"[^\W{UNSPACED}]+")
_UNSPACED = re.compile(f"[{UNSPACED}]")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW_TAGS}


@dataclass
class Block:
    region: int
    article: bool
    by_tag: bool
    marks: int
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    text: str = ""
    good: bool | None = None


def names_of(attributes: str) -> list[str]:
    return [w for m in _NAMES.findall(attributes) for w in "".join(m).split()] if "=" in attributes else []


def marking(name: str) -> bool:
    """Whether a class, id or role says by itself that its element is boilerplate."""
    parts = _PARTS.findall(_CAMEL.sub("-", name).lower())
    return any(p in BOILERPLATE_NAMES for p in parts) and all(p in BOILERPLATE_NAMES or p in NEUTRAL_NAMES for p in parts)


def blocks_of(page: str) -> list[Block]:
    """The page's blocks with text, in order."""
    out: list[Block] = []
    #: Open elements: (tag, region, in an article, boilerplate by tag, marked elements); `opened` counts their tags.
    stack: list[tuple[str, int, bool, bool, int]] = [("", 0, False, False, 0)]
    opened: Counter[str] = Counter()
    block = Block(0, False, False, 0)
    links = regions = 0
    at, n = 0, len(page)
    pieces = _PIECE

    def end_block() -> None:
        nonlocal block
        if block.parts:
            block.text = " ".join(html.unescape("".join(block.parts)).split())
            if block.text:
                out.append(block)
        block = Block(*stack[-1][1:])

    def say(text: str) -> None:
        if text:
            block.parts.append(text)
            if links:
                block.link_chars += len(" ".join(text.split()))

    while at < n:
        m = pieces.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        if m.group() == "<!--":
            end = page.find("-->", m.end())
            at = n if end < 0 else end + 3
            continue
        if m.group(2) is None:
            if m.group() == "<":
                if re.match(r"[a-zA-Z/!?]", page[m.end() : m.end() + 1] or "/"):  # a tag that is cut off or broken
                    pieces = _PLAIN_PIECE
                    end = page.find(">", m.end())
                    at = n if end < 0 else end + 1
                    continue
                say("<")
            at = m.end()
            continue
        closing, tag, attributes = bool(m.group(1)), m.group(2).lower(), m.group(3)
        at = m.end()
        if tag in RAW_TAGS:
            if not closing and not attributes.rstrip().endswith("/"):
                end = _RAW_END[tag].search(page, at)
                at = n if end is None else end.end()
            continue
        if tag == "a":
            links = 0 if closing else 1
        if tag == "br":
            say(" ")
        names = [] if closing else names_of(attributes)
        marked = any(map(marking, names))
        if tag in BLOCK_TAGS or tag in BOILERPLATE_TAGS:
            links = 0
        elif not marked and not opened[tag]:
            continue
        if closing:
            if opened[tag]:
                while True:
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == tag:
                        break
        elif tag not in VOID_TAGS:
            if tag == "p" and stack[-1][0] == "p":  # a paragraph ends the one before it
                stack.pop()
                opened["p"] -= 1
            _, region, article, by_tag, marks = stack[-1]
            opens = not marked and (tag in ARTICLE_TAGS or any(x.lower() in ARTICLE_NAMES for x in names))
            own = tag in BOILERPLATE_TAGS or tag == "header" and not article
            marked = marked and tag not in ("html", "body") or not article and "header" in (x.lower() for x in names)
            if opens or own or marked:
                regions += 1
                region = regions
            stack.append((tag, region, article or opens, by_tag or own, marks + marked))
            opened[tag] += 1
        end_block()
    end_block()
    return out


def measure(text: str) -> tuple[float, int]:
    """(words, stop words) of a text; CHARS_A_WORD characters of a script without blanks are a word."""
    words = _WORD.findall(text.lower())
    found = sum(w in STOP_WORDS for w in words)
    unspaced = len(_UNSPACED.findall(text))
    if unspaced:
        found += sum(map(text.count, STOP_CHARACTERS))
    return len(words) + unspaced / CHARS_A_WORD, found


def known_language(blocks: list[Block]) -> bool:
    """Whether the blocks that may be text have stop words."""
    found = [measure(b.text) for b in blocks if not b.by_tag and b.link_chars < MANY_LINKS * len(b.text)]
    return sum(stops for _, stops in found) >= STOP_KNOWN * sum(words for words, _ in found)


def decide(block: Block, known: bool = True) -> bool | None:
    """Pass 1: True for text, False for boilerplate, None if neither is clear; `known`: the page has stop words."""
    if block.by_tag:
        return False
    words, stops = measure(block.text)
    density = block.link_chars / max(1, len(block.text))
    if density >= MOST_LINKS:
        return False
    if block.text.startswith("©") and words < 3 * LONG_WORDS and not block.article:
        return False
    if not known:
        return True if density < MANY_LINKS and (words >= LONG_WORDS or len(block.text) >= LONG_CHARS) else None
    stops /= max(1, words)
    if density < MANY_LINKS and words >= SHORT_WORDS and stops >= STOP_HIGH:
        return True
    if words >= LONG_WORDS:
        return True if block.article or stops >= STOP_LOW and density < MANY_LINKS else None if stops >= STOP_LOW else False
    return None


def level_of(blocks: list[Block]) -> int:
    """How many marked elements may be around a block of the text: the least that an article has, else that text has."""
    inside = [(b.marks, b.region) for b in blocks if b.article and b.good is not False]
    least = min(inside, default=(0, 0))[0]
    if inside and (least == 0 or len({region for marks, region in inside if marks == least}) == 1):
        return least  # several articles inside marked elements may be teasers: then text outside comes first
    text = [b.marks for b in blocks if b.good]
    if not text or min(text) == 0:
        return 0
    # Without decided text outside marked elements: short blocks there count if they are a text's worth together.
    return 0 if sum(measure(b.text)[0] for b in blocks if not b.marks and b.good is None) >= LONG_WORDS else min(text)


def inherit(blocks: list[Block]) -> None:
    """Pass 2: ambiguous blocks take the nearest decided label of their region, text if two are equally near."""
    n = len(blocks)

    def nearest(same: bool) -> list[bool | None]:
        found: list[tuple[int, bool] | None] = [None] * n
        for order in (range(n), range(n - 1, -1, -1)):
            last: dict[int, tuple[int, bool]] = {}
            for i in order:
                b = blocks[i]
                key = b.region if same else 0
                if b.good is not None:
                    last[key] = (i, b.good)
                elif key in last:
                    far = abs(i - last[key][0])
                    if found[i] is None or far < found[i][0] or far == found[i][0] and last[key][1]:
                        found[i] = (far, last[key][1])
        return [f[1] if f else None for f in found]

    here, anywhere = nearest(True), nearest(False)
    for b, own, other in zip(blocks, here, anywhere):
        if b.good is None:
            b.good = own if own is not None else True if b.article else bool(other)


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    known = known_language(blocks)
    for b in blocks:
        b.good = decide(b, known)
    level = level_of(blocks)
    for b in blocks:
        if b.marks > level:
            b.good = False
    inherit(blocks)
    if any(b.article and b.good for b in blocks):  # what stands outside the article isn't part of it
        blocks = [b for b in blocks if b.article]
    return "\n".join(b.text for b in blocks if b.good)


def extract_pages(pages: DataFrame, source: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns, text and n_chars of each row."""

    def extract(found: list) -> list[list]:
        texts = [main_text(x) for x in found]
        return [texts, [len(t) for t in texts]]

    return arrow_rows(pages, list(keep), source, extract, "text string, n_chars bigint", rows=250)
