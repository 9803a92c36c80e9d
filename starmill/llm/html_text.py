"""Main text of web pages by two passes over their blocks.

First pass: each block is good or bad by where it stands, its share of linked text, its
share of stop words and its length; short blocks without clear signs stay undecided. On a
page whose stop words are of no known language, length decides without them.
Second pass: undecided blocks take the label of their nearest decided neighbour outside
of boilerplate.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.workers import map_arrow

MAX_LINK_SHARE = 0.5
LONG = 70  # characters from which a block's stop words decide
STOP_LOW, STOP_HIGH = 0.12, 0.25

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """
    the of and to in a is that it was for on are as with be by at this from or an not but have
    der die das und in zu den von mit ist des im dem nicht ein eine als auch es an auf für sie
    le la les de des et un une du en que qui est dans pour pas au sur par avec ce plus
    el los las del y que es por con para una se no su lo como más pero al
    """.split()
)
# Names of elements by their role.
BLOCKS = frozenset(
    """
    address article aside blockquote body center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section summary
    table tbody td tfoot th thead title tr ul
    """.split()
)
SKIPPED = frozenset(
    """
    applet audio button canvas datalist embed head iframe math noscript object optgroup option
    script select style svg template textarea title video
    """.split()
)
RAW = frozenset(["script", "style", "textarea", "title"])
SIDE = frozenset(["aside", "dialog", "footer", "menu", "nav"])
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
MAIN = frozenset(["article", "main"])
# Words of class, id and role names that mark boilerplate.
_SIDE_WORD = (
    r"(?:ads?|advert\w*|banner\w*|breadcrumbs?|byline|comments?|commentlist|consent|"
    r"cookies?|copyright|disclaimer|disqus|footer|gdpr|legal|masthead|menu\w*|modal|nav\w*|"
    r"newsletter|notices?|overlay|pagination|popup|promo\w*|recommend\w*|related|respond|share|"
    r"sharing|sidebar\w*|signup|social|sponsor\w*|subscribe|toolbar|widgets?|complementary|"
    r"contentinfo|search)"
)
# Words that leave a compound with one of those what it is, as 'site-footer' or 'share-bar'
# (unlike 'has-sidebar' or 'no-comments').
_PLAIN_WORD = (
    r"(?:area|articles?|bar|block|bottom|box|buttons?|container|footer|form|global|header|icons?|"
    r"inner|items?|left|links?|list|main|page|panel|posts?|primary|right|secondary|section|"
    r"site|slot|top|wrap|wrapper|\d+)"
)
# A whole name of a class, id or role.
_SIDE_NAMES = re.compile(
    rf"(?:^|\s)(?:{_PLAIN_WORD}[_-]+)*{_SIDE_WORD}(?:[_-]+(?:{_SIDE_WORD}|{_PLAIN_WORD}))*(?:$|\s)", re.IGNORECASE
)
# Texts of others, also where each of them is an article.
_OTHERS_NAMES = re.compile(r"comment|disqus|respond|related|recommend", re.IGNORECASE)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_HIDING = re.compile(r"hidden|display", re.IGNORECASE)
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)""",
    re.DOTALL,
)
_LETTERS = re.compile(r"[^\W\d_]+")


def hides(attributes: str) -> bool:
    """Whether an element's attributes hide it. A name or text that holds 'hidden' is no such
    attribute."""
    if not _HIDING.search(attributes):
        return False
    for match in _ATTRIBUTE.finditer(attributes):
        name, value = match[1].lower(), (match[2] or "").strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style" and _NOT_SHOWN.search(value):
            return True
    return False


@dataclass
class Block:
    text: str
    linked: int  # characters within links
    side: bool  # stands in boilerplate
    main: bool  # stands in the page's article
    form: bool = False  # is boilerplate for a form around it and nothing else

    def linking(self) -> bool:
        if self.linked <= MAX_LINK_SHARE * len(self.text):
            return False
        if not self.main or self.side or len(self.text) < LONG:
            return True
        # A sentence of the article stays its text, though it be a link.
        stops, words = self.stop_words()
        return stops < STOP_LOW * words

    def stop_words(self) -> tuple[int, int]:
        """Number of stop words and of words."""
        words = [w.lower() for w in _LETTERS.findall(self.text)]
        return sum(w in STOP_WORDS for w in words), len(words)

    def first_label(self, known: bool, stops: int, words: int) -> bool | None:
        """True: main text, False: boilerplate, None: undecided. ``known``: the page is in
        a language whose stop words are known."""
        if self.side or self.linking():
            return False
        share = stops / words if words else 0.0
        if len(self.text) < LONG:
            return None
        if self.main or not known or share >= STOP_HIGH:
            return True
        return None if share >= STOP_LOW else False


class _Reader:
    """Blocks of one page, in page order."""

    def __init__(self, page: str):
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0
        # Open elements: name, and how many of the counted roles they open.
        self.open: list[tuple[str, int, int, int, int, int]] = []
        self.named: list[int] = []  # per open element, 1 if a name alone makes it side
        self.places: dict[str, list[int]] = {}  # of the open elements of a name
        self.open_blocks: list[int] = []
        self.skip = self.side = self.main = self.link = self.form = 0
        self.read(page)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            form = self.form > 0 and not self.main and self.side <= 0
            self.blocks.append(Block(text, self.linked, self.side > 0 or self.form > 0, self.main > 0, form))
        self.parts, self.linked = [], 0

    def text(self, raw: str) -> None:
        if raw and not self.skip:
            plain = html.unescape(raw) if "&" in raw else raw
            self.parts.append(plain)
            if self.link:
                self.linked += len(" ".join(plain.split()))

    def start(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self.flush()
            if name != "html":
                self.close_implied(name)
        elif name == "br":
            self.parts.append("\n")
        if name in VOID:
            return
        skip = name in SKIPPED or bool(attributes and hides(attributes))
        side = name in SIDE or (name == "header" and not self.main)
        named = 0
        if attributes and not side and name not in ("html", "body", "form") and name not in MAIN:
            names = [m[1] or m[2] or m[3] or "" for m in _NAMES.finditer(attributes)]
            side = any(_SIDE_NAMES.search(n) for n in names)
            named = int(side and not any(_OTHERS_NAMES.search(n) for n in names))
        # The page's article is no boilerplate for the names of what surrounds it.
        outer = name in MAIN and not self.main
        lifted, forms = (sum(self.named), self.form) if outer else (0, 0)
        if name == "a" and self.link:
            self.end("a")
        roles = (int(skip), int(side) - lifted, int(name in MAIN), int(name == "a"), int(name == "form") - forms)
        self.places.setdefault(name, []).append(len(self.open))
        if name in BLOCKS:
            self.open_blocks.append(len(self.open))
        self.open.append((name, *roles))
        self.named.append(named)
        self.count(roles, 1)

    def count(self, roles: tuple[int, ...], sign: int) -> None:
        self.skip += sign * roles[0]
        self.side += sign * roles[1]
        self.main += sign * roles[2]
        self.link += sign * roles[3]
        self.form += sign * roles[4]

    def close_implied(self, name: str) -> None:
        """A block ends an open paragraph; list items and cells end their like."""
        like = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th")}
        ended = like.get(name, ("td", "th") if name in ("td", "th") else ())
        inner = [o[0] for o in self.open[-12:]]
        if "p" in inner:
            self.end("p")
        for other in ended:
            scope = next((n for n in reversed(inner) if n in ("ul", "ol", "dl", "table", other)), None)
            if scope == other:
                self.end(other)

    def end(self, name: str) -> None:
        if name in BLOCKS or name == "p":
            self.flush()
        places = self.places.get(name)
        if not places:
            return
        at = places[-1]
        # A stray end of inline markup does not end the blocks around it.
        if name not in BLOCKS and self.open_blocks and self.open_blocks[-1] > at:
            return
        for other, *roles in self.open[at:]:
            self.count(tuple(roles), -1)
            self.places[other].pop()
        while self.open_blocks and self.open_blocks[-1] >= at:
            self.open_blocks.pop()
        del self.open[at:]
        del self.named[at:]

    def read(self, page: str) -> None:
        at = 0
        while at < len(page):
            match = _TOKEN.search(page, at)
            if match is None:
                self.text(page[at:])
                break
            self.text(page[at : match.start()])
            at = match.end()
            name = (match[2] or match[5] or "").lower()
            if not name:
                if match[0].startswith("<![CDATA["):
                    self.text(match[0][9:].removesuffix("]]>"))
                continue
            if match[1] or match[4]:
                self.end(name)
                continue
            attributes = match[3] if match[2] else match[6]
            closed = attributes.rstrip().endswith("/") and name not in BLOCKS
            self.start(name, attributes)
            if name in RAW and not closed:
                close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                self.end(name)
                at = close.end() if close else len(page)
            elif closed and name not in VOID:
                self.end(name)
        self.flush()


def main_text(page: str | None) -> str:
    """Main text of a page, its blocks joined by blank lines; '' if there is none."""
    if not page:
        return ""
    blocks = _Reader(page).blocks
    # A form that holds most of the page's prose is how the page was built, not a form to fill in.
    prose = [(len(b.text), b.form) for b in blocks if b.form or not b.side if len(b.text) >= LONG and not b.linking()]
    if 2 * sum(n for n, form in prose if form) > sum(n for n, _ in prose):
        for block in blocks:
            block.side = block.side and not block.form
    counts = [(0, 0) if block.side or block.linking() else block.stop_words() for block in blocks]
    known = sum(s for s, _ in counts) >= STOP_LOW * sum(w for _, w in counts)
    labels = [block.first_label(known, *count) for block, count in zip(blocks, counts)]
    decided = [i for i, label in enumerate(labels) if label is not None and not blocks[i].side]
    # Boilerplate says nothing of what stands beside it, unless all else is undecided.
    decided = decided or [i for i, label in enumerate(labels) if label is not None]
    at, kept = 0, []
    for i, block in enumerate(blocks):
        label = labels[i]
        while at + 1 < len(decided) and decided[at + 1] <= i:
            at += 1
        if label is None and not decided:
            label = True
        elif label is None:
            before = decided[at] if decided[at] < i else None
            after = next((d for d in decided[at : at + 2] if d > i), None)
            label = _inherited(blocks, labels, i, before, after)
        if label:
            kept.append(block.text)
    return "\n\n".join(kept)


def _inherited(blocks: list[Block], labels: list, i: int, before: int | None, after: int | None) -> bool:
    """Label of the nearest decided block; one in the same region wins a tie, then good."""
    near = [d for d in (before, after) if d is not None and blocks[d].main == blocks[i].main]
    if not near:
        # Nothing decided within its region: text of an article stays.
        if blocks[i].main:
            return True
        near = [d for d in (before, after) if d is not None]
    closest = min(abs(d - i) for d in near)
    return any(labels[d] for d in near if abs(d - i) == closest)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for low in range(0, len(whole), 500):
            batch = whole.slice(low, 500)
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )


def extract(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars. Row by row, without a shuffle.

    Character references are decoded, white space within a block is one space, and blocks
    are joined in page order by a blank line. Menus, headers, footers, sidebars, notices,
    adverts, forms, comments, scripts and styles are left out. A null or empty page gives
    '' and 0; a page cut off anywhere is read as far as it goes. Repeated rows give
    repeated results; other columns are ignored.
    """
    rows = pages.select(
        F.col(f"`{id_column}`").cast("bigint").alias("page_id"),
        F.col(f"`{url_column}`").cast("string").alias("url"),
        F.col(f"`{html_column}`").cast("string").alias("html"),
    )
    found = map_arrow(rows, _texts, "page_id bigint, url string, text string")
    return found.select("*", F.length("text").cast("bigint").alias("n_chars"))
