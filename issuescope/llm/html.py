"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

#: Paths need this share of the best path's smoothed score.
LEAST_SHARE = 0.3
#: Inside an article or main element this share is enough: even a single character reaches it, lists of links do not.
LEAST_INSIDE = 0.002
#: Elements of one path that hold this share of a page's text outside links stay, whatever their names.
MAJOR_SHARE = 0.5
#: How far a path's score is drawn to those next to it on the page.
SMOOTHING = 0.5

# Fixed values of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
_RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
#: An element of the first kind ends open ones of the second kind.
_ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "body": {"head"},
}
_ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p "
    "pre section table ul".split()
)
#: Elements and roles that are not the article, whatever they hold; forms and names only if they hold less than
#: ``MAJOR_SHARE``.
_SKIPPED = frozenset(
    "aside audio button canvas datalist dialog footer form head header iframe input math menu nav noscript object option "
    "script select style svg template textarea title video".split()
)
_SKIPPED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
_SKIPPED_NAMES = re.compile(
    r"(?:^|(?<=[\s_-]))(ads?|adverts?|advertisement|adsense|banner|breadcrumbs?|comments?|commentlist|consent|cookies?|"
    r"disqus|footer|gdpr|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|notification|"
    r"overlay|pager|pagination|popup|promo|promoted|related|replies|respond|search|share|sharing|sidebar|signup|social|"
    r"sponsor|sponsored|subscribe|toolbar|widget)(?=$|[\s_-])",
    re.IGNORECASE,
)
_ARTICLES = frozenset(("article", "main"))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.DOTALL
)
# One attribute after the other: a name, then its value if there is one.
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?")
_MARKS = re.compile(r"[.,;:!?…。，！？、；：]")


class Paths:
    """Chains of names as numbers: each is its parent's with one name more; 0 is the empty one.

    Parents have smaller numbers, so sums over subtrees and marks along a chain take one pass, and a chain of any depth costs
    as much as one of its names.
    """

    def __init__(self):
        self.parent, self.name, self.depth = [0], [None], [0]
        self._numbers: dict[tuple, int] = {}

    def child(self, parent: int, name) -> int:
        number = self._numbers.setdefault((parent, name), len(self.parent))
        if number == len(self.parent):
            self.parent.append(parent)
            self.name.append(name)
            self.depth.append(self.depth[parent] + 1)
        return number

    def shared(self, one: int, two: int) -> int:
        """How many names two chains begin with in common."""
        while one != two:
            if self.depth[one] >= self.depth[two]:
                one = self.parent[one]
            else:
                two = self.parent[two]
        return self.depth[one]

    def sums(self, own: dict[int, int]) -> list[int]:
        """Per chain what it and all that continue it hold."""
        total = [own.get(i, 0) for i in range(len(self.parent))]
        for i in range(len(total) - 1, 0, -1):
            total[self.parent[i]] += total[i]
        return total

    def below(self, marked) -> list[bool]:
        """Per chain whether it or one that it continues is marked."""
        found = [False] * len(self.parent)
        for i in range(1, len(found)):
            found[i] = found[self.parent[i]] or marked(i)
        return found


class _Open(NamedTuple):
    """An element that is open where the page is read."""

    name: str
    path: int
    kind: int
    skipped: bool
    inner: bool  # an article or main element, or in one
    heading: bool


class Text(NamedTuple):
    path: int
    raw: str
    link: bool
    block: int
    kind: int


def text_nodes(html: str, paths: Paths, kinds: Paths) -> Iterator[Text]:
    """All text nodes outside skipped elements, in page order.

    A path is made of block elements with their class names; inline ones do not count.  ``block`` changes wherever a
    block element, or a line break, starts or ends.  ``kinds`` are chains of (path, whether a form, a class or an id makes
    the element doubtful).  Text in a heading of an article is no link, as titles often link to their own page.
    """
    stack = [_Open("", 0, 0, False, False, False)]
    places: dict[str, list[int]] = {}  # where the open elements of a name stand
    links = block = at = 0

    def end_from(depth: int) -> None:
        for element in stack[depth:]:
            places[element.name].pop()
        del stack[depth:]

    end = len(html)
    while at < end:
        tag = _TAG.search(html, at)
        stop = tag.start() if tag else end
        top = stack[-1]
        if stop > at and not top.skipped:
            yield Text(top.path, html[at:stop], links > 0 and not (top.inner and top.heading), block, top.kind)
        if not tag:
            break
        at = tag.end()
        name = tag.group(2)
        if name is None:
            continue
        name = name.lower()
        if tag.group(1):
            if name == "a":
                links = max(0, links - 1)
            elif name not in _INLINE:
                block += 1
                if places.get(name):
                    end_from(places[name][-1])
                    links = 0
            continue
        if name in _RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
            at = close.end() if close else end
            block += name not in _INLINE
            continue
        if name == "a":
            links += 1
        if name in _INLINE:
            continue
        block += 1
        if name in _VOID:
            continue
        closes = _ENDS.get(name, set())
        if name in _ENDS_P:
            closes = closes | {"p"}
        while stack[-1].name in closes:
            end_from(len(stack) - 1)
        top = stack[-1]
        label, out = name, name in _SKIPPED and name != "form" and not (name == "header" and top.inner)
        doubtful = name == "form"
        if tag.group(3):
            for key, *values in _ATTRIBUTE.findall(tag.group(3)):
                value = next((v for v in values if v), "")
                key = key.lower()
                if key == "class":
                    label = f"{name}.{value.lower()}"
                if key in ("class", "id") and name not in ("html", "body", "article", "main"):
                    names = {n.lower() for n in _SKIPPED_NAMES.findall(value)}
                    doubtful = doubtful or bool(names - {"header"} if top.inner else names)
                elif key == "role":
                    out = out or value.lower() in _SKIPPED_ROLES
                elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                    out = True
        path = paths.child(top.path, label)
        places.setdefault(name, []).append(len(stack))
        stack.append(
            _Open(
                name,
                path,
                kinds.child(top.kind, (path, doubtful)),
                out or top.skipped,
                top.inner or name in _ARTICLES,
                top.heading or name in _HEADINGS,
            )
        )


def path_scores(nodes: list[Text], paths: Paths) -> dict[int, float]:
    """The fused and smoothed score of every path.

    Per path: the mean length of its texts, their mean number of punctuation marks and the share of text outside links,
    multiplied on a logarithmic scale.  In page order each score is then drawn to its neighbours' mean, weighted by how
    much of their paths they share, which lifts a title above its paragraphs and not a notice beside them.
    """
    figures: dict[int, list[float]] = {}
    order: list[int] = []
    for path, text, link, *_ in nodes:
        if not order or order[-1] != path:
            order.append(path)
        f = figures.setdefault(path, [0, 0, 0, 0])
        size = len(text)
        f[0] += 1
        f[1] += size
        f[2] += len(_MARKS.findall(text))
        f[3] += 0 if link else size
    fused = {p: np.log1p(c / n) * (0.5 + np.log1p(m / n)) * (o / c) for p, (n, c, m, o) in figures.items()}
    near: dict[int, list[tuple[float, float]]] = {}
    for one, two in zip(order, order[1:], strict=False):
        weight = paths.shared(one, two) / max(paths.depth[one], paths.depth[two], 1)
        near.setdefault(one, []).append((weight, fused[two]))
        near.setdefault(two, []).append((weight, fused[one]))
    smooth = {}
    for path, own in fused.items():
        weights = [w for w, _ in near.get(path, []) if w > 0]
        smooth[path] = own
        if weights:
            others = sum(w * s for w, s in near[path]) / sum(weights)
            pull = SMOOTHING * sum(weights) / len(weights)
            outside_links = figures[path][3] / figures[path][1]
            smooth[path] = max(own, ((1 - pull) * own + pull * others) * outside_links)
    return smooth


def _without_doubtful(found: list[Text], paths: Paths, kinds: Paths) -> list[Text]:
    """The texts outside doubtful elements that hold the minor part of the page, or that stand beside an article."""
    sizes = [len(t.raw.strip()) for t in found]
    inner = paths.below(lambda p: paths.name[p].split(".")[0] in _ARTICLES)
    own: dict[int, int] = {}
    for text, size in zip(found, sizes, strict=True):
        own[text.kind] = own.get(text.kind, 0) + (0 if text.link else size)
    held: dict[int, int] = {}
    for kind, size in enumerate(kinds.sums(own)):
        if kind and kinds.name[kind][1]:
            path = kinds.name[kind][0]
            held[path] = held.get(path, 0) + size
    outside_links = sum(own.values())
    minor = {path for path, size in held.items() if size < MAJOR_SHARE * outside_links or not outside_links}

    def gone() -> list[bool]:
        return kinds.below(lambda k: kinds.name[k][1] and kinds.name[k][0] in minor)

    # An element beside the article does not become content by holding more than it.
    out = gone()
    articles: dict[int, int] = {}
    for text, size in zip(found, sizes, strict=True):
        if size and inner[text.path] and not text.link and not out[text.kind]:
            articles[text.kind] = articles.get(text.kind, 0) + 1
    around: dict[int, int] = {}
    for kind, texts in enumerate(kinds.sums(articles)):
        if kind and kinds.name[kind][1]:
            path = kinds.name[kind][0]
            around[path] = around.get(path, 0) + texts
    everywhere = sum(articles.values())
    minor |= {path for path in held.keys() - minor if not inner[path] and around[path] < everywhere}
    out = gone()
    return [text for text in found if not out[text.kind]]


def main_text(html: str | None, least_share: float = LEAST_SHARE, least_inside: float = LEAST_INSIDE) -> str:
    """The article of a page; empty for null, for a page without text, and if all of it is boilerplate.

    Paths are content if they have ``least_share`` of the best path's score; where the best path lies in an article or main
    element, those in this element that have ``least_inside`` of it.
    """
    if not html:
        return ""
    paths, kinds = Paths(), Paths()
    found = [t._replace(raw=unescape(t.raw)) if "&" in t.raw else t for t in text_nodes(html, paths, kinds)]
    nodes: list[Text] = []
    for text in _without_doubtful(found, paths, kinds):
        if text.raw.strip():
            nodes.append(text)
        elif nodes and nodes[-1].block == text.block:  # white space between inline elements
            nodes.append(text._replace(raw=" "))
    scored = [t for t in nodes if t.raw != " "]
    if not scored:
        return ""
    scores = path_scores(scored, paths)
    highest = max(scores.values())
    content = {p for p, s in scores.items() if s >= least_share * highest and s > 0}
    amount: dict[int, int] = {}
    for text in scored:
        if text.path in content:
            amount[text.path] = amount.get(text.path, 0) + len(text.raw)
    best = max(amount, key=lambda p: amount[p]) if amount else 0
    # The outermost article or main element that holds the best path; other articles share its path.
    holder, at = 0, best
    while at:
        if paths.name[at].split(".")[0] in _ARTICLES:
            holder = at
        at = paths.parent[at]
    if holder:
        within = paths.below(lambda p: p == holder)
        content = {p for p, s in scores.items() if within[p] and s >= least_inside * highest and s > 0}
    chosen: list[str] = []
    last = None
    for text in nodes:
        if text.path in content:
            chosen.append(text.raw if text.block == last else "\n" + text.raw)
            last = text.block
    return " ".join("".join(chosen).split())


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Whole pages are read, each by itself, so nothing is shuffled.  Null, empty and all-boilerplate pages give an empty
    text; ids and urls go through as they are, null or repeated; an empty table gives an empty one.
    """
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return map_batches(source, _extract, "page_id long, url string, text string, n_chars long")
