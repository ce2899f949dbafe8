"""Main text of web pages from flat text blocks.

A page is cut into text blocks at block tags. A block is described by its words,
its link density, the same of the blocks before and after it, its kind (heading,
paragraph, other), where it stands on the page, and how surely the elements
around it are no content (menus, footers, forms, adverts, reader comments): a
tag or a whole class name says so, a name that only holds such a word hints at
it. A decision tree, trained on the small labelled table below, keeps or drops
each block.

Defined results: a null or empty page gives an empty text; scripts, styles and
comments are never text, also where their end is missing; a tag cut off at the
end of a page is no text; unknown or incomplete character references stay as
they are; a text of any length is read whole, once; repeated rows each give
their row; all columns of other names play no
part; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Elements of the HTML standard by role.
SILENT = "script|style|noscript|template|textarea|title|svg|iframe|object|select|head"
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ASIDE = frozenset("nav footer aside form header menu dialog button fieldset".split())
CONTENT = frozenset("article main".split())
# Words of class, id and role values that name a part without content.
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments comentarios kommentare consent "
    "cookie cookies discussion disqus feedback footer header login masthead menu modal nav navbar navigation newsletter "
    "notice notices notification pagination popup promo promoted reactions recommended related replies respond search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar widget".split()
)
# Those that also are subjects of a text: as the id of a part of an article they name its anchor.
SUBJECTS = frozenset(
    "banner cookie cookies discussion feedback header menu modal navigation notice notices notification promo reactions "
    "recommended related replies respond search share sharing social sponsor subscription tags".split()
)
# Words that may stand beside them without naming a subject.
PARTS = frozenset(
    "area articles bar block body bottom box button buttons center column container content form global group head "
    "heading icon icons inner item items left link links list main message mobile news outer page panel post posts "
    "primary reader readers right secondary section site slot stories sub text thread title top user users".split()
)

_TOKEN = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<({SILENT})\b[^>]*?(?:/>|>.*?(?:</\1\s*>|(?=<body\b)|\Z)|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_PART = re.compile(r"[a-z0-9]+")
# Parts of class names that tell how a page is laid out, not what an element is.
LAYOUT = frozenset("with without has no not non free wrap wrapper open opened closed enabled disabled layout".split())


HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p blockquote pre dd dt figcaption".split())
SURE, HINT = 1.0, 0.5


@dataclass
class Block:
    """``article`` is 1 inside an article, a half inside ``main`` alone; ``aside``
    is SURE, HINT or 0; ``kind`` is 2 for a heading, 1 for a paragraph, else 0."""

    text: str
    words: int
    links: int
    article: float
    aside: float
    kind: int


def _named(attributes: str, article: float) -> float:
    """How surely class, id or role name a part without content.

    A name begins or ends with such a word; it is sure if its other words only
    tell what kind of part it is, and no more than a hint if there is another word
    (``related-work``) or if it is an id that may be an anchor in an article. No
    part of it may be about layout; what begins with ``content`` holds the content.
    """
    most = 0.0
    for m in _NAMES.finditer(attributes):
        anchor = article == 1 and m[1].lower() == "id"
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            parts = _NAME_PART.findall(name)
            if not parts or not LAYOUT.isdisjoint(parts):
                continue
            if parts[0] in ASIDE_NAMES or parts[-1] in ASIDE_NAMES and parts[0] != "content":
                known = [p for p in parts if p in ASIDE_NAMES]
                other = any(p not in ASIDE_NAMES and p not in PARTS and not p.isdigit() for p in parts)
                hint = other or anchor and SUBJECTS.issuperset(known)
                most = max(most, HINT if hint else SURE)
    return most


def _aside(tag: str, attributes: str, article: float) -> float:
    if tag in ASIDE:
        return 0.0 if tag == "header" and article else SURE
    if "=" not in attributes or tag in HEADINGS or tag in ("body", "html", "main", "article"):
        return 0.0
    return _named(attributes, article)


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order."""
    blocks: list[Block] = []
    parts: list[str] = []  # text since the last block tag
    linked: list[str] = []
    open_parts: list[tuple[str, float, float, bool]] = []  # (tag, article, aside, aside by tag) of open elements
    article = aside = 0.0
    kind = 0
    had_article = False  # outside of what is aside
    in_link = False
    at = 0

    def flush() -> None:
        words = "".join(parts).split()
        if words:
            n_linked = len("".join(linked).split())
            blocks.append(Block(" ".join(words), len(words), n_linked, article, aside, kind))
        parts.clear()
        linked.clear()

    def say(text: str) -> None:
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if in_link:
                linked.append(text)

    for m in _TOKEN.finditer(page):
        say(page[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        closing = bool(m[2])
        if tag == "a":
            in_link = not closing
            linked.append(" ")
        elif tag == "br":
            parts.append(" ")
        if tag not in BLOCKS and tag not in ASIDE:
            continue
        if tag in BLOCKS:
            flush()
            in_link = False
            kind = 0 if closing else 2 if tag in HEADINGS else int(tag in PARAGRAPHS)
        if tag in VOID or tag in ("p", "li", "td", "th", "tr", "dt", "dd") and not m[4].strip():
            continue
        if closing:
            for i in range(len(open_parts) - 1, -1, -1):
                if open_parts[i][0] == tag:
                    del open_parts[i:]
                    break
        elif not m[4].rstrip().endswith("/"):
            here = _aside(tag, m[4], article)
            if here > aside:
                flush()
            # A form may be wrapped around a whole page; the other tags are never content.
            by_tag = tag in ASIDE and tag not in ("form", "fieldset") and here == SURE or bool(open_parts) and open_parts[-1][3]
            below = max(aside, here)
            # Names around a page's main part, or its first article, say nothing about it.
            if below and not by_tag and (tag == "main" or tag == "article" and not had_article) and not _named(m[4], 0.0):
                below = 0.0
            within = max(article, 1.0 if tag == "article" else 0.5 if tag in CONTENT else 0.0)
            had_article |= tag in CONTENT and below < SURE
            open_parts.append((tag, within, below, by_tag))
        now = open_parts[-1][1:3] if open_parts else (0.0, 0.0)
        if now != (article, aside):
            flush()
            article, aside = now
    say(page[at:])
    flush()
    return blocks


FEATURES = (
    "words", "density", "words before", "density before", "words after", "density after", "place", "kind", "aside",
)

# The labelled table: the blocks of small pages in page order. A block is its place (a: in
# an article, m: in ``main`` alone, n: on a page without either, x: beside them), its kind
# (h: heading, p: paragraph, o: other), its words, / linked words, ! or ? where it is aside
# by SURE or HINT, and + where it is main text, - where not.
LABELLED = """
xo1/1!- xo1/1!- xo2/2!- xo10!- ah9+ ap62+ ap25/5+ ap140+ ap16+ xo12/1!-
xo1/1!- xo1/1!- ah4+ ap3+ ap30/2+ ah3+ ap45+ ah2+ ap9+ ah3+ xo8!- xo3/3!-
xh3- xo4/4- xo3/3- ap55+ ap4+ ap2/2+ ap70+ xh2- xp40- xp22- xp60/4- xo3/3-
ah6/6+ ap12/6+ ap4+ ao5+ ao7/7+ ao3/3+ ao6+ ap20+ ap1+ ao9/9+ xp12- xo5-
ah1+ ap5+ ap1+ ap3+ ap7+ ao2+ ao1+ ao30+ ao1+ xo6- xo4/2- xp8- xo9-
ah12+ ao300+ ao45+ ao2+ ao120/6+ ao8+ ah2+ ao3+ ao1+ ao1/1+ ao2+
ah7+ ap80+ ah2?+ ap50?+ ap6?+ ao7?+ ap33+ ao2/2?- ao1/1?- ao4/4?- ap18+ ao30/9?+ ah3?+ ao12?+
ah5+ ap40+ ap7/7?- ap6/5?- ah3/3?- ao5/4?- ap90+ ap150!- ah2!- ap30!- ao2!- ap12+
ap2+ ah1+ ap14+ ap110!- ao4/4!- ah2!- ap6!- ah8+ ap65/30+ ap11/11+ ap28/20+
mo2/2- mo4/4- mh5+ mp9+ mp60+ mo30+ mh3+ mp5+ mo4+ mo6+ mo3+ mp18+ xo9- xp40- xo2/2-
mh7+ mp2+ mo12+ mp70/8+ mp120!- mp9!- mh2!- mp8+ mh3- mo6/6- mo5/5- mo7/7- xp12-
mh4/4+ mp45+ mo3+ mo2/2- mo1/1- mp80+ mp1+ mh2- mp4/4- mp9/8- mo8?- mp44?+ mp7?-
no2/2- no1/1- no1/1- nh4+ np12+ no6!- no2/2!-
no1/1- no1/1- no1/1- no1/1- nh6+ np60+ np8+ np33/4+ nh2+ np5+ np41+ nh2- no5/5- no6/6- no4/4- no9-
nh3+ np4+ no2+ no3+ no2+ np2+ np1+
nh8+ np30+ no5+ no9+ no4+ no7+ np16+ no2/2- no3/3- no4-
nh2+ no1+ no1+ no2+ no1+ no2+ no3+ np9+ np25+
nh1+ np1+ nh1+ np3+ nh2+ np20+ np7/3+ nh3+ no2+ no30+
no4/4- no2/2- no60+ no6+ no45/4+ no3+ no80+ no5/5- no3/3-
no2/2- no55+ no70+ no5- no2/2- no1/1-
np60+ np2+ np200+ np5+ np3/2- np12/12- np40/36- np2/2-
np5+
nh5+ np11+
no60+
no24+ no30+ no7+ no50+
no3/3- no3- no2/2- nh9+ np22+ np14+ np3+ no6?- np48?+ np5?- no40?+ no4/4?- nh2?- no9?-
nh6/6+ np70+ np9/2+ np31+ nh2- np8/8- np7/7- np28/24- nh3- no3/3- no4/4- no2-
no1/1- no3- no1/1- no2- no1/1- nh7+ no90+ no12+ no35+ nh1- no2/2- no2/2-
no12/11- no14/12- no9/9- nh3- no11/11- no10/10- no13/12- no4- no2/2-
nh2!- np40!- no3!- nh5+ np3+ np26+ no24!- np90!- nh3!- np6+ no70!- no2/2!-
no1- no2/2- no1/1- nh3+ np17+ no1+ no2+ no1+ no5+ no2+ no1+ np4+ no5!-
nh5+ np70+ nh2- no3/3- no2/2- nh3- np5/5- np90+ nh1- no1/1- no2/2-
mh3+ mp60+ mh2- mo2/2- mo4/4- mp50+ mh3- mp6/6- mo3/3- xp30-
nh2- nh6/6- np3/3- nh7/7- np2/2- nh5/5- np4/4- no2-
nh4+ np38+ nh2+ no3+ no6+ no2+ no9+ nh2+ np10+ np6+ no5/5- no2/2-
"""
_SKETCH = re.compile(r"([amnx])([hpo])(\d+)(?:/(\d+))?([!?]?)([+-])")
_PLACES = {"a": 1.0, "m": 0.5, "n": 0.0, "x": -1.0}


def labelled_rows(table: str = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """The features of the blocks in a labelled table, and whether each is main text."""
    rows, label = [], []
    for line in table.split("\n"):
        found = [m.groups() for m in _SKETCH.finditer(line)]
        sides = {"": 0.0, "?": HINT, "!": SURE}
        blocks = [
            Block("", int(words), int(links or 0), 0.0, sides[aside], "oph".index(kind))
            for _, kind, words, links, aside, _ in found
        ]
        rows += features(blocks, [_PLACES[f[0]] for f in found])
        label += [f[5] == "+" for f in found]
    return np.array(rows, dtype=float), np.array(label)


@dataclass
class Node:
    """A leaf has a ``keep``; otherwise rows below ``at`` in ``feature`` go left."""

    keep: bool | None = None
    feature: int = 0
    at: float = 0.0
    left: Node | None = None
    right: Node | None = None


def train_tree(rows: np.ndarray, label: np.ndarray, depth: int = 12) -> Node:
    """A binary tree by the Gini index; the earliest best split wins."""
    share = label.mean()
    if depth == 0 or share in (0.0, 1.0):
        return Node(keep=bool(share >= 0.5))
    best = (share * (1 - share) * len(label) - 1e-9, None, None)
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for at in (values[1:] + values[:-1]) / 2:
            below = rows[:, feature] < at
            impurity = sum(len(part) * part.mean() * (1 - part.mean()) for part in (label[below], label[~below]))
            if impurity < best[0]:
                best = (impurity, feature, at)
    _, feature, at = best
    if feature is None:
        return Node(keep=bool(share >= 0.5))
    below = rows[:, feature] < at
    return Node(
        None, feature, float(at), train_tree(rows[below], label[below], depth - 1), train_tree(rows[~below], label[~below], depth - 1)
    )


def default_tree() -> Node:
    return train_tree(*labelled_rows())


def keeps(tree: Node, row: tuple) -> bool:
    while tree.keep is None:
        tree = tree.left if row[tree.feature] < tree.at else tree.right
    return tree.keep


def _places(blocks: list[Block]) -> list[float]:
    """Where each block stands: 1 in an article, 0.5 in ``main`` before its article
    or right above one as a heading, 0 on a page without either, -1 beside them."""
    own = [b.article if b.aside < SURE else 0.0 for b in blocks]
    top = max(own, default=0.0)
    if not top:
        return own
    first = next(i for i, a in enumerate(own) if a == top)
    places = []
    for i, (block, place) in enumerate(zip(blocks, own)):
        titles = block.kind == 2 and i + 1 == first
        places.append(place if place == top else 0.5 if i < first and (place or titles) else -1.0)
    return places


def features(blocks: list[Block], places: list[float]) -> list[tuple]:
    """The features of each block; its neighbours are the nearest blocks before and
    after it that are not surely aside."""
    sizes = [(b.words, min(1.0, b.links / b.words)) for b in blocks]
    before, after = [], []
    for side, order in ((before, range(len(blocks))), (after, reversed(range(len(blocks))))):
        near = (0, 0.0)
        for i in order:
            side.append(near)
            near = sizes[i] if blocks[i].aside < SURE else near
    after.reverse()
    return [
        (*size, *last, *following, place, b.kind, b.aside)
        for size, last, following, place, b in zip(sizes, before, after, places, blocks)
    ]


def main_text(page: str, tree: Node) -> str:
    blocks = blocks_of(page)
    return "\n\n".join(b.text for b, row in zip(blocks, features(blocks, _places(blocks))) if keeps(tree, row))


def extract_pages(pages: DataFrame, tree: Node | None = None) -> DataFrame:
    """(page_id, url, text) of each row of ``pages`` (page_id, url, html)."""
    tree = tree or default_tree()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, tree) if page else "" for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    rows = pages.select("page_id", "url", "html")
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
