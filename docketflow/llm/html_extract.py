"""Operator 6: main text of web pages by tag-path ratios.

A page's text nodes are grouped by the tag path of their block; inline tags belong to it.
Each path has the mean text length and punctuation of its blocks, fused into one ratio and
damped by the share of link text; the ratios are smoothed over the blocks in page order, and
a path's score is its own ratio fused with the smoothed one.  A heading counts as the block it
stands before, list items, cells and the like, short by nature, count ``LISTED`` times, and
paragraphs and headings right in the container ``NEAR`` times.

The container is the deepest element that still holds most of the page's text by these
ratios, but no part of an article or main element.  Of the paths inside it, those whose score
is at least ``THRESHOLD`` of that of the path with most text are content, and with a path all
of its nodes, short ones too.  Elements that can't be content by their name, role, class or id
take no part, unless one that only role, class or id name (or a form) holds most of the
page's free text and its title.

Defined cases: a null or empty page, or one without any content, gives the empty text;
unclosed and misnested tags end with the element that ends around them; text outside
any tag is a page of one path; nothing is cut or capped; time is linear in a page's length,
however deep or broken its tags are.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.llm import exchange as X

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^<>]*+>|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none""", re.I)
RAW = frozenset("script style textarea title noscript template iframe svg math object select".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img input br nobr".split())
#: Elements and words in role, class or id that name what is around the article.
APART = frozenset("nav footer aside form button dialog menu head".split())
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising advertorial adsense banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs "
    "sidebar aside footer contentinfo complementary cookie cookies consent gdpr notice notices notification alert popup modal newsletter subscribe subscription signup "
    "login search share sharing social comment comments disqus respond reply replies related recommended pagination pager toolbar masthead".split()
)
#: First parts of a class that say what a page has, and last ones that go with a word of the above.
STATES = frozenset("has have no not non with without is hide show enable disable".split())
PARTS = frozenset("ad ads bar block box button buttons container content form icons item items links list panel post posts articles section stories area widget wrap wrapper inner thread".split())
CLOSED_BY = {"p": frozenset("p div article section main header footer nav aside form ul ol dl table pre blockquote h1 h2 h3 h4 h5 h6 hr address figure".split()), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
HEADING = re.compile(r"h[1-6]")
PUNCTUATION = re.compile(r"[.,;:!?…、。，]")
KERNEL = np.array([0.06, 0.24, 0.40, 0.24, 0.06])
MOST, THRESHOLD, LINKS, OWN = 0.5, 0.5, 0.75, 2 / 3  # OWN: how much of a score is the path's own ratio
#: How much more a paragraph or heading right in the container counts; blocks that are short by nature, and how much more these count.
NEAR = 1.25
SHORT, LISTED = frozenset("li dt dd td th pre caption figcaption blockquote summary".split()), 3.0
NO_CONTAINER = INLINE | CLOSED_BY.keys() | SHORT | frozenset("h1 h2 h3 h4 h5 h6 ul ol dl table tbody thead tr".split())


def around(token: str) -> bool:
    """Whether a whole class or id names something around the article."""
    parts = [p for p in re.split(r"[^a-z]+", token) if p]
    if not parts or parts[0] in STATES:
        return False
    return parts[-1] in APART_WORDS or (parts[0] in APART_WORDS and all(p in APART_WORDS | PARTS for p in parts))


def apart(name: str, attributes: str, inside_article: bool) -> int:
    """0: may be content; 1: can't be by role, class or id, or is a form; 2: can't be by its name, or is hidden."""
    if name in APART or (name == "header" and not inside_article):
        return 1 if name == "form" else 2
    if not attributes or name in ("html", "body"):
        return 0
    if HIDDEN.search(attributes):
        return 2
    for kind, *values in ATTRIBUTE.findall(attributes):
        if HEADING.fullmatch(name) and kind.lower() == "id":  # made from the heading's words
            continue
        if any(map(around, "".join(values).lower().split())):
            return 1
    return 0


class Page:
    """A page's block elements (and inline ones that are apart) in page order, and its text nodes."""

    def __init__(self, html: str):
        self.parent, self.name, self.path, self.kind = [-1], [""], [0], [0]
        self.paths: dict[tuple[int, str], int] = {}
        self.last_tag = [""]
        self.texts: list[tuple[int, str, bool, int]] = []  # element, raw text, whether within a link, number of the block
        self._read(html)

    def _element(self, parent: int, name: str, kind: int) -> int:
        path = self.path[parent]
        if name not in INLINE:
            key = (path, name)
            if key not in self.paths:
                self.paths[key] = len(self.last_tag)
                self.last_tag.append(name)
            path = self.paths[key]
        self.parent.append(parent)
        self.name.append(name)
        self.path.append(path)
        self.kind.append(kind)
        return len(self.name) - 1

    def _read(self, html: str) -> None:
        # of each open tag: name, element, in a link, in an article, hidden, place of the nearest open block tag
        stack: list[tuple[str, int, bool, bool, bool, int]] = [("", 0, False, False, False, -1)]
        open_tags: dict[str, int] = {}
        block, pos = 0, 0

        def shut(depth: int) -> None:
            for tag in stack[depth:]:
                open_tags[tag[0]] -= 1
            del stack[depth:]

        def take(end: int) -> None:
            _, element, link, _, hidden, _ = stack[-1]
            if end > pos and not hidden:
                self.texts.append((element, html[pos:end], link, block))

        while (m := TAG.search(html, pos)) is not None:
            take(m.start())
            pos = m.end()
            name = (m[2] or "").lower()
            if not name:
                continue
            if name == "br":
                if not stack[-1][4]:
                    self.texts.append((stack[-1][1], " ", False, block))
                continue
            block += name not in INLINE
            if m[1]:
                if open_tags.get(name):
                    depth = len(stack) - 1
                    while stack[depth][0] != name:
                        depth -= 1
                    shut(depth)
                continue
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^<>]*>", re.I).search(html, pos)
                pos = close.end() if close else len(html)
                continue
            if name in VOID or m[3].endswith("/"):
                continue
            near = stack[-1][5]
            if name not in INLINE and near > 0 and name in CLOSED_BY.get(stack[near][0], ()):
                shut(near)
            _, element, link, article, hidden, near = stack[-1]
            if not hidden:
                kind = apart(name, m[3], article)
                hidden = kind == 2
                if kind or name not in INLINE:
                    element = self._element(element, name, kind)
            stack.append((name, element, link or name == "a", article or name in ("article", "main"), hidden, near if name in INLINE else len(stack)))
            open_tags[name] = open_tags.get(name, 0) + 1
        take(len(html))

    def within(self, own: list[float]) -> list[float]:
        """Sums over each element and all inside it."""
        out = list(own)
        for e in range(len(out) - 1, 0, -1):
            out[self.parent[e]] += out[e]
        return out

    def left_out(self) -> list[bool]:
        """Whether an element is apart, or inside one that is."""
        free = [0.0] * len(self.name)
        for element, text, link, _ in self.texts:
            free[element] += 0 if link else len(text.strip())
        free = self.within(free)
        inner = self.within([float(n in ("h1", "main")) for n in self.name])
        titles = [0] * len(self.name)  # of each element that is apart by role, class or id (0: of the page), not further in
        owner = [0] * len(self.name)
        for e in range(1, len(self.name)):
            owner[e] = e if self.kind[e] else owner[self.parent[e]]
            if self.name[e] in ("h1", "main", "article"):
                titles[owner[e]] += 1
        out = [False] * len(self.name)
        outside = titles[0]
        for e in range(1, len(self.name)):
            if out[self.parent[e]] or self.kind[e] == 2:
                out[e] = True
            elif self.kind[e]:
                out[e] = not (free[e] > MOST * free[0] and (inner[e] or not outside))
                outside += 0 if out[e] else titles[e]
        return out


def path_scores(page: Page, texts: list[tuple[int, str, bool, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each path: its score, its free text, its share of link text."""
    stats = np.zeros((len(page.last_tag), 4))  # characters, punctuation, blocks, characters in links
    order: list[int] = []  # paths of the blocks in page order
    last = None
    for element, text, link, block in texts:
        size, k = len(text.strip()), page.path[element]
        if size:
            stats[k] += (size, len(PUNCTUATION.findall(text)), last != (k, block), size * link)
            if last != (k, block):
                order.append(k)
            last = (k, block)
    size, blocks = np.maximum(1, stats[:, 0]), np.maximum(1, stats[:, 2])
    links = stats[:, 3] / size
    ratio = np.sqrt(stats[:, 0] / blocks * (1 + stats[:, 1] / blocks)) * (1 - links)
    at = np.array(order, np.int64)
    smooth = np.convolve(np.pad(ratio[at], 2, mode="edge"), KERNEL, "valid") if len(at) else np.zeros(0)
    around_it = np.bincount(at, smooth, len(ratio)) / blocks
    score = ratio**OWN * around_it ** (1 - OWN) * np.array([LISTED if t in SHORT else 1.0 for t in page.last_tag])
    heading = np.array([bool(HEADING.fullmatch(t)) for t in page.last_tag])
    follows = np.zeros(len(at))  # the score of the next block that is no heading
    for i in range(len(at) - 2, -1, -1):
        follows[i] = follows[i + 1] if heading[at[i + 1]] else score[at[i + 1]]
    lifted = np.zeros(len(ratio))
    np.maximum.at(lifted, at, follows)
    return np.where(heading, np.maximum(score, lifted), score), stats[:, 0] * (1 - links), links


def main_text(html: str | None, threshold: float = THRESHOLD) -> str:
    if not html:
        return ""
    page = Page(html)
    out = page.left_out()
    texts = [(e, unescape(t), a, b) for e, t, a, b in page.texts if not out[e]]
    score, free, links = path_scores(page, texts)
    weight = [0.0] * len(page.name)
    for element, text, link, _ in texts:
        if not link:
            weight[element] += len(text.strip()) * score[page.path[element]]
    held = page.within(weight)
    if not held[0]:
        return ""
    container, within_article = 0, False
    for e in range(1, len(page.name)):  # elements that hold most of the text lie one inside the other
        if held[e] > MOST * held[0] and page.name[e] not in NO_CONTAINER:
            if not within_article and (page.name[container] != "main" or page.name[e] == "article"):
                container, within_article = e, page.name[e] == "article"
    articles = [e for e, n in enumerate(page.name) if n == "article" and not out[e]]
    if articles and not within_article:
        container = max(articles, key=lambda e: (held[e], -e))
    inside = [False] * len(page.name)
    for e in range(container, len(page.name)):
        inside[e] = e == container or inside[page.parent[e]]
    of_paths = np.zeros(len(page.last_tag))
    for element, text, link, _ in texts:
        if inside[element] and not link:
            of_paths[page.path[element]] += len(text.strip())
    score[[k for t in ("p", "h1", "h2", "h3", "h4", "h5", "h6") if (k := page.paths.get((page.path[container], t))) is not None]] *= NEAR
    level = threshold * score[int(of_paths.argmax())]
    lines: dict[int, list[str]] = {}
    for element, text, _, block in texts:
        k = page.path[element]
        if inside[element] and (not text.strip() or score[k] >= level and links[k] <= LINKS):
            lines.setdefault(block, []).append(text)
    return "\n".join(t for parts in lines.values() if (t := " ".join("".join(parts).split())))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per page: id, the columns of ``keep``, text, n_chars; a map over the pages, without a shuffle."""
    src = pages.select(id_col, *keep, F.col(html_col).cast("string").alias("_html"))
    names = [id_col, *keep, "text", "n_chars"]
    shape = X.shape(src, [id_col, *keep], "text string, n_chars long")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                texts = [main_text(h) for h in some.column(some.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names)

    return src.mapInArrow(run, shape)


def op6_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Query over the whole of ``pages``: page_id, url, text, n_chars."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
