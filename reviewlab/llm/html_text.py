"""Main-text extraction from HTML by two-pass block rules.

A page is cut into text blocks at block-level tags. The first pass labels each block by itself: blocks inside
boilerplate elements (navigation, footers, asides, forms, page headers, or elements whose class, id or role
says so) and blocks made mostly of links are bad; long blocks with enough stop words, and blocks inside the article
element, are good; long blocks without stop words are bad; short or unclear ones stay undecided. The second pass
gives each undecided block the label of its nearest decided neighbour (of two as near, the one before it). The good blocks make the text, in page order, separated by an empty line.

Rows are independent, so this is one map over the pages. Character references are decoded, white space inside a block
becomes one space. Elements whose end tag HTML lets a page omit end where HTML ends them: head at the first body
content, p at a block's start, li, dt, dd and the parts of a table at the next of their kind. Defined cases: null or
empty html gives an empty text; broken markup is read as far as it goes (open elements end with the page); very long
pages are read whole; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.common import arrow_map

LONG = 80               # characters of a block that can be judged by its stop words
STOP_HIGH = 0.12        # stop-word share of running text
STOP_LOW = 0.02
LINKS_HIGH = 0.5        # share of characters inside links

# Tag classes of HTML, words of boilerplate class names and roles, frequent function words.
BLOCK_TAGS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                       "head header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
SKIPPED_TAGS = frozenset("script style template noscript textarea select button iframe object svg canvas audio video math head title datalist".split())
HEAD_TAGS = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
ITEMS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}     # what an item's start ends, unless another list lies between
CELLS, GROUPS = {"td", "th", "caption"}, {"tbody", "thead", "tfoot"}
TABLE_PARTS = {"td": CELLS, "th": CELLS, "tr": CELLS | {"tr"}, **dict.fromkeys(GROUPS, CELLS | {"tr"} | GROUPS)}
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BAD_TAGS = frozenset("nav footer aside form menu dialog".split())
CORE_TAGS = frozenset("article main".split())
BAD_WORDS = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar sidenav menu nav navbar navigation topnav breadcrumb "
                      "breadcrumbs footer cookie cookies consent gdpr notice notices alert popup modal overlay subscribe subscription newsletter signup login comment "
                      "comments disqus reply replies respond share sharing social related recommended recommendations widget toolbar pagination pager copyright "
                      "disclaimer masthead skip".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
STOP_WORDS = frozenset("the of and to in a is that for it with as was on be by are this or an from at which not have but his they you were their has "
                       "der die das und ist in den von zu mit sich des auf für nicht ein eine als auch es an dem wird aus er hat dass sie nach bei "
                       "de la le et les des en un une du est que dans qui par pour au il sur pas plus avec ce ne se sont son ou "
                       "el los las y que es una por con para del se no su lo como más al pero sus este".split())
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_EDGE = re.compile(r"^\W+|\W+$")


class _Blocks(HTMLParser):
    """Collects [text, link characters, bad, core] per block. Open elements are counted and found by tag, so deep nesting
    costs no more than flat pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[list] = []
        self.open: list[tuple[str, bool, bool, bool]] = []      # tag, bad, core, skipped
        self.places: dict[str, list[int]] = defaultdict(list)   # where each tag stands in `open`
        self.solid: list[int] = []                              # where tags stand that a list item's search does not pass
        self.held = [0, 0, 0]                                   # open elements that are bad, core, skipped
        self.parts: list[str] = []
        self.linked = self.links = 0
        self.headed = False

    def _push(self, tag: str, *flags: bool) -> None:
        self.places[tag].append(len(self.open))
        if tag not in ("address", "div", "p"):
            self.solid.append(len(self.open))
        self.open.append((tag, *flags))
        self.held = [n + f for n, f in zip(self.held, flags)]

    def _cut(self, size: int) -> None:
        """Close all open elements but the first ``size``."""
        while len(self.open) > size:
            tag, *flags = self.open.pop()
            self.places[tag].pop()
            if tag not in ("address", "div", "p"):
                self.solid.pop()
            self.held = [n - f for n, f in zip(self.held, flags)]

    def _end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append([text, self.linked, self.held[0] > 0, self.held[1] > 0])
        self.parts, self.linked = [], 0

    def _imply_ends(self, tag: str) -> None:
        """End the open elements that the start of block ``tag`` ends."""
        if tag in ITEMS:
            if self.solid and self.open[self.solid[-1]][0] in ITEMS[tag]:
                self._cut(self.solid[-1])
        elif tag in TABLE_PARTS:
            table = max((self.places[t][-1] for t in ("table", "template") if self.places[t]), default=-1)
            inside = ((self.places[t], bisect_right(self.places[t], table)) for t in TABLE_PARTS[tag])
            self._cut(min((at[i] for at, i in inside if i < len(at)), default=len(self.open)))
        self._close("p")

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "head":
            if self.headed:
                return
            self.headed = True
        elif tag == "body" and not self.places["template"]:
            self._close("head")
        elif tag not in HEAD_TAGS and self.open and self.open[-1][0] == "head":
            self._cut(len(self.open) - 1)
        if tag in VOID_TAGS:
            if tag == "hr":
                self._end_block()
                self._close("p")
            elif tag == "br" or tag == "img":
                self.parts.append(" ")
            return
        if tag in BLOCK_TAGS:
            self._end_block()
            self._imply_ends(tag)
            self.links = 0
        if tag == "a":
            self.links += 1
            return
        if tag in BLOCK_TAGS or tag in SKIPPED_TAGS:
            have = dict(attrs)
            names = set(_SPLIT.split(f"{have.get('class') or ''} {have.get('id') or ''}".lower()))
            core = tag in CORE_TAGS or (have.get("role") or "").lower() in ("main", "article")
            bad = (tag in BAD_TAGS or (have.get("role") or "").lower() in BAD_ROLES or "hidden" in have or have.get("aria-hidden") == "true"
                   or (tag not in ("body", "html", "article", "main") and bool(names & BAD_WORDS)) or "display:none" in (have.get("style") or "").replace(" ", "")
                   or (tag == "header" or "header" in names) and not self.held[1] and tag not in ("body", "html", "article", "main"))
            self._push(tag, bool(bad), core, tag in SKIPPED_TAGS)

    def _close(self, tag: str) -> None:
        at = self.places[tag]
        if at and (tag != "p" or at[-1] == len(self.open) - 1):
            self._cut(at[-1])

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
        elif tag in BLOCK_TAGS or tag in SKIPPED_TAGS:
            if tag in BLOCK_TAGS:
                self._end_block()
            self._close(tag)

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] == "head" and data.strip():
            self._cut(len(self.open) - 1)
        if self.held[2]:
            return
        self.parts.append(data)
        if self.links:
            self.linked += len(" ".join(data.split()))


def blocks_of(html: str) -> list[list]:
    """[text, link characters, inside boilerplate, inside the article] of every block of a page."""
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser._end_block()
    return parser.blocks


def first_label(text: str, linked: int, bad: bool, core: bool) -> bool | None:
    """Pass one: True (good), False (bad) or None (undecided)."""
    if bad or linked > LINKS_HIGH * len(text):
        return False
    words = [_EDGE.sub("", w) for w in text.lower().split()]
    words = [w for w in words if w]
    share = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if core:
        return True
    if text.startswith("©") or text.lower().startswith("copyright"):
        return False
    if len(text) >= LONG:
        if share >= STOP_HIGH:
            return True
        if share < STOP_LOW:
            return False
    return None


def labels_of(blocks: list[list]) -> list[bool]:
    """Both passes."""
    labels = [first_label(*b) for b in blocks]
    before, after = [], []
    last = (None, 0)
    for i, x in enumerate(labels):
        last = (x, i) if x is not None else last
        before.append((last[0], i - last[1]))
    last = (None, 0)
    for i in range(len(labels) - 1, -1, -1):
        last = (labels[i], i) if labels[i] is not None else last
        after.append((last[0], last[1] - i))
    after.reverse()
    out = []
    for x, (left, dl), (right, dr) in zip(labels, before, after):
        if x is None:
            if left is None or right is None:
                x = right if left is None else left
                x = True if x is None else x
            else:
                x = left if dl <= dr else right
        out.append(x)
    return out


def main_text(html: str | None) -> str:
    """The page's good blocks, separated by an empty line."""
    blocks = blocks_of(html or "")
    return "\n\n".join(b[0] for b, good in zip(blocks, labels_of(blocks)) if good)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                           pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return arrow_map(rows, run, "page_id long, url string, text string, n_chars long")
