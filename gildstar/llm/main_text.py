"""Main text of web pages by two-pass block rules (operator 2).

A page is cut into blocks at block-level tags.  Pass one classes each block by
stop-word density, length and link density, and by the elements it lies in
(menus, headers, footers, forms and the like are never main text).  Blocks that
are too short or too unlike prose to tell stay open; in pass two they take the
label of the nearest decided neighbour within the same article, headings that of
the next.  An article or main element is a prior only: its blocks are rejected by
the same rules, what is open in it counts as main text if nothing else tells, and
what lies outside goes if the articles hold as much prose.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    """
    the of and to in is it that was for on are as with be by at this from or an have not they but which his her you
    le la les de des du et un une est en que qui pour dans par sur au aux avec il elle ne pas se ce son sa
    der die das und ist nicht ein eine den dem von mit zu im auf für sich des als auch es werden bei aus
    el los las del y una que por con para su al lo como más pero sus se no
    """.split()
)

# Elements whose content is never text, and never main text.
_RAW = frozenset("script style noscript template svg math canvas object iframe textarea select option title".split())
_OUTSIDE = frozenset("nav header footer aside form button dialog menu head".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ARTICLE = frozenset("article main".split())
# Words in class, id or role that mark something other than the article.
_MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|newsletter|subscribe|"
    r"signup|popup|modal|overlay|nav|navbar|navigation|menu|breadcrumbs?|sidebar|widget|footer|masthead|toolbar|share|"
    r"sharing|related|recommend\w*|comments?|commentlist|disqus|replies|respond|complementary|contentinfo|"
    r"pagination)(?:$|[\s_-])",
    re.I,
)
_COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|reply|replies|teaser|related)(?:$|[\s_-])", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)(?:>|$)|([^<]+|<)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")  # what is no letter at the ends of a word

_LONG, _SHORT = 140, 60  # characters
_MISSED_STOPS = 8  # stop words that chance alone hardly leaves out: once in e^8 blocks
_MANY_STOPS, _SOME_STOPS, _MOST_LINKS, _ALL_LINKS = 0.30, 0.15, 0.5, 0.8


@dataclass
class Block:
    """A block's text, its characters inside links, and where it lies."""

    text: str
    link_chars: int
    outside: bool
    article: int  # number of the enclosing article or main element, 0 for none
    tag: str = ""  # the block element it lies in
    label: bool | None = field(default=None)


def _attributes(source: str) -> dict[str, str]:
    return {
        m[1].lower(): html.unescape(next((g for g in m.groups()[1:] if g is not None), ""))
        for m in _ATTRIBUTE.finditer(source)
    }


def _marked(name: str, attributes: dict[str, str]) -> bool:
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if _HIDDEN.search(attributes.get("style", "")):
        return True
    if name in ("html", "body"):
        return False
    marks = _COMMENTS if name in _ARTICLE else _MARKS
    return any(marks.search(attributes.get(key, "")) for key in ("class", "id", "role"))


def blocks(page: str) -> list[Block]:
    """The page's blocks in order, white space folded, empty ones left out."""
    found: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # open elements: name, outside the main text, article number
    pieces: list[tuple[str, bool]] = []
    articles = 0
    place = 0
    end = len(page)

    def close_block() -> None:
        if not pieces:
            return
        text = " ".join("".join(p for p, _ in pieces).split())
        if text:
            links = sum(len("".join(p.split())) for p, linked in pieces if linked)
            found.append(Block(text, links, bool(stack) and stack[-1][1], stack[-1][2] if stack else 0, stack[-1][0] if stack else ""))
        pieces.clear()

    links_open = 0
    while place < end:
        m = _TOKEN.match(page, place)
        place = m.end()
        if m[4] is not None:
            pieces.append((html.unescape(m[4]), links_open > 0))
            continue
        if m[2] is None:
            continue
        closing, name = bool(m[1]), m[2].lower()
        if name == "br":
            pieces.append((" ", False))
            continue
        if name == "a":
            links_open = max(0, links_open - 1) if closing else (0 if m[3].rstrip().endswith("/") else 1)
        if name in _INLINE:
            # An inline element that marks something else stands for itself, like a block.
            attributes = {} if closing or not m[3] else _attributes(m[3])
            if not closing and not _marked(name, attributes):
                continue
            if closing and not any(n == name for n, _, _ in stack[-3:]):
                continue
        if name in _RAW and not closing:
            if not m[3].rstrip().endswith("/"):
                ending = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, place)
                place = ending.end() if ending else end
            if name != "title":
                pieces.append((" ", False))
            continue
        close_block()
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                del stack[depth:]
            continue
        if name in _VOID:
            continue
        outside, article = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
        if name in ("p", "li") and stack and stack[-1][0] == name:
            stack.pop()  # an element of this kind ends where the next begins
            outside, article = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
        if name in _ARTICLE and not article:
            articles += 1
            article = articles
        inside_article_header = name == "header" and article
        outside = outside or (name in _OUTSIDE and not inside_article_header) or _marked(name, _attributes(m[3]))
        stack.append((name, outside, article))
    close_block()
    return found


def classify(found: list[Block]) -> None:
    """Pass one and two: every block gets its label, true for main text."""
    counted: dict[int, tuple[int, int]] = {}  # stop words and words of each article's sure main text
    bare: list[Block] = []  # long, mostly of lower-case words, without stop words
    for b in found:
        words = b.text.split()
        letters = max(1, sum(map(len, words)))
        plain = [_EDGES.sub("", w) for w in words]
        n_stops = sum(w.lower() in STOP_WORDS for w in plain)
        stops = n_stops / max(1, len(words))
        linked = b.link_chars / letters
        prose = b.article and len(words) > 20 and stops >= _SOME_STOPS and linked <= _ALL_LINKS
        if b.outside:
            b.label = False
        elif linked > _MOST_LINKS and not prose:
            b.label = None if b.article and b.tag in _HEADINGS else False
        elif len(b.text) >= _LONG and stops >= _SOME_STOPS or len(b.text) >= _SHORT and stops >= _MANY_STOPS:
            b.label = True
            had = counted.get(b.article, (0, 0))
            counted[b.article] = had[0] + n_stops, had[1] + len(words)
        elif len(b.text) >= _LONG and stops == 0 and 2 * sum(w.isalpha() and w.islower() for w in plain) >= len(words):
            bare.append(b)  # numbers, code and names have no stop words to miss and stay open
    within = sum(len(b.text) for b in found if b.label and b.article)
    if any(b.article and not b.outside for b in found) and within >= sum(len(b.text) for b in found if b.label and not b.article):
        for b in found:
            if not b.article:
                b.label = False
    # Stop words reject in an article only where its own text leads to expect them: it may be in a language without
    # any listed, and a paragraph may do without by chance.
    told = {b.article for b in found if b.label}
    for b in bare:
        n_stops, n_words = counted.get(b.article, (0, 1))
        if b.label is None and b.tag != "pre" and (
            not b.article or len(b.text.split()) * n_stops >= _MISSED_STOPS * n_words
        ):
            b.label = False
    _inherit(found, list(range(len(found))), lambda b: not b.article)
    for article in sorted(told - {0}):
        _inherit(
            found,
            [i for i, b in enumerate(found) if b.article == article and not b.outside],
            lambda b: True,
        )
    for b in found:
        if b.label is None:
            b.label = bool(b.article)


def _inherit(found: list[Block], among: list[int], takes: Callable[[Block], bool]) -> None:
    """Open blocks take the label of the nearest decided block ``among`` these; main text wins a tie."""
    nearest: dict[int, list[tuple[int, bool]]] = {i: [] for i in among}
    ahead: dict[int, bool | None] = {}
    for way in (among, among[::-1]):
        last = None
        for i in way:
            if found[i].label is not None:
                last = i
            elif last is not None:
                nearest[i].append((abs(i - last), not found[last].label))
                if last > i:
                    ahead[i] = found[last].label
    for i, near in nearest.items():
        if near and takes(found[i]):
            # A heading belongs to what follows.
            found[i].label = ahead[i] if found[i].tag in _HEADINGS and i in ahead else not min(near)[1]


def main_text(page: str) -> str:
    """The page's main text, one line per block."""
    found = blocks(page)
    classify(found)
    return "\n".join(b.text for b in found if b.label)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every page.

    NULL and empty html give an empty text; NULL ids and urls stay NULL; cut-off
    pages are read as far as they go; repeated rows give repeated results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) if h else "" for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.large_string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    narrow = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html")
    )
    out = narrow.mapInArrow(run, "page_id long, url string, text string, n_chars long")
    return out.withColumnsRenamed({"page_id": page_id, "url": url})
