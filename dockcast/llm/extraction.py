"""Operator 3: main text of web pages by minimum cut.

A page is read into blocks (runs of text between block-level tags). A classifier gives every block
its costs of being called content and boilerplate; these are the capacities of its edges to the two
terminals. Blocks next to each other and blocks with one parent element are joined by smoothness
edges. The minimum cut is the labelling of least total cost; blocks on the content side are the text.

The costs are a fixed structural part (semantic elements and names of classes around the block) plus
the log odds of a logistic regression over the block's text (links, length, punctuation). It is
trained here, on the blocks of at most ``TRAIN_PAGES`` pages that stand inside semantic elements and
so carry their own label; every page is then labelled over its whole html.

Defined results: null and empty pages have an empty text; broken markup is read as far as it makes
sense (open elements end with their parent, quotes without an end at the next white space); hidden
elements count like others; very long pages take time in proportion to their length; ties between
labellings of one cost go to boilerplate; repeated rows are each extracted; other columns stay out of
it, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

TRAIN_PAGES = 500
ADJACENT, SIBLING = 0.6, 0.9  # smoothness between neighbours, and between blocks of one parent
STRUCTURE = 6.0               # cost that an element's meaning carries
TEXT_LIMIT = 2.0              # the most that the text classifier adds or takes

#: Element names by their role in HTML.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary "
                  "table tbody tfoot thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style template noscript head title textarea select button svg iframe object canvas audio video "
                   "datalist applet frameset noframes".split())
RAW = frozenset("script style textarea title noscript iframe noframes".split())
AWAY = frozenset("nav footer aside menu dialog".split())      # and most forms, see lean_of_forms
TOWARDS = frozenset("article main".split())
#: What an opening tag ends.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HOLDS = frozenset("ul ol dl table article section div main body nav aside footer header form blockquote".split())

#: Parts of class names and ids. A name with a part of ``AWAY_PARTS`` is boilerplate's wherever the part
#: stands; one of ``AWAY_ENDS`` must be the last part, or the first one before a part of ``HOLDERS``.
AWAY_PARTS = frozenset(
    "ad ads adsbygoogle adsense advert adverts advertisement advertising advertorial banner banners breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies discussion disqus footer gdpr masthead menu menus nav navbar navbox navigation newsletter notice "
    "notices pager pagination popup promo promos promotion related replies respond sharing sidebar sidebars signup social sponsor sponsored "
    "sponsors subscribe subscription toolbar usercomments widget widgets".split())
AWAY_ENDS = frozenset("alert alerts copyright legal login meta modal search share skip tag tags tagcloud".split())
AWAY_TAIL = re.compile(r"(?:comments|sidebar|footer|menu|navbar|navigation|newsletter|banner|widget)$")
HOLDERS = frozenset("area bar block body box button buttons cloud container content form icon icons inner item items left link links list panel "
                    "right section slot unit wrap wrapper".split())
#: Names of comments and of links elsewhere: an article element in there is no page's article.
REPEATED = frozenset("comment comments commentlist discussion disqus usercomments replies related promo promos".split())
PAGE_PARTS = frozenset("site page global top bottom main primary secondary".split())
TOWARDS_PARTS = frozenset("article articlebody bodytext content entry hentry main post postbody story".split())
#: Names that tell a state or a layout, a kind of post or a page builder's box, not what is inside.
STATE_FIRST = frozenset("category elementor et fl format has hide is layout no non not show status type vc with without".split())
STATE_ANY = frozenset("active below closed disabled enabled free layout open opened template with without".split())
NAME_SPLIT = re.compile(r"[-_:/.]+|(?<=[a-z])(?=[A-Z])")
OPENING = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"[\s/]*([^\s=>/]*)(\s*=\s*)?")
UNQUOTED = re.compile(r"[^\s>]*")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
RAW_ENDS = {name: re.compile(f"</{name}", re.I) for name in RAW}
LONG_WORDS = 20               # words of a block that counts as running text


def name_kind(name: str) -> str:
    """What one class, id or role says: "away", "soft" (a header), "towards" or "" (nothing)."""
    parts = [p.lower() for p in NAME_SPLIT.split(name) if p]
    if not parts or parts[0] in STATE_FIRST or any(p in STATE_ANY for p in parts):
        return ""
    if parts[0] == "tag" and len(parts) > 1 and parts[1] not in HOLDERS:
        return ""                         # a post's own tag, as tag-python
    if any(p in AWAY_PARTS or AWAY_TAIL.search(p) for p in parts):
        return "away"
    if parts[-1] in AWAY_ENDS or parts[0] in AWAY_ENDS and parts[1] in HOLDERS:
        return "away"
    if "header" in parts:
        return "away" if parts[0] in PAGE_PARTS else "soft"
    return "towards" if any(p in TOWARDS_PARTS for p in parts) or "".join(parts) in TOWARDS_PARTS else ""


def names_kind(names: list[str]) -> str:
    """What the classes, ids and roles of an element say together. A name that is nothing but a word of
    boilerplate, or two of them, decides; beside a name of content a single compound is a layout's
    (``content sidebar-right``)."""
    kinds = [(name_kind(n), n) for n in names]
    away = [n for kind, n in kinds if kind == "away"]
    towards = any(kind == "towards" for kind, _ in kinds)
    if away and (not towards or len(away) > 1 or not NAME_SPLIT.search(away[0])):
        return "away"
    if any(kind == "soft" for kind, _ in kinds):
        return "soft"
    return "towards" if towards else ""


class Block:
    __slots__ = ("text", "linked", "parent", "lean", "heading", "form")

    def __init__(self, parent: int, lean: float, heading: bool, form: int):
        self.text, self.linked, self.parent, self.lean, self.heading, self.form = "", 0, parent, lean, heading, form


class Tags:
    """The markup of a page from left to right, in time linear in its length: every search either
    moves past what it has read, or finds once that nothing more of its kind follows."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.unclosed: set[str] = set()

    def find(self, what: str, at: int) -> int:
        if what in self.unclosed:
            return -1
        k = self.page.find(what, at)
        if k < 0:
            self.unclosed.add(what)
        return k

    def next(self, at: int) -> tuple[int, int, str, bool, dict[str, str], bool] | None:
        """(start, end, name, ending, attributes, self-closing) of the next tag from ``at`` on; the
        name is empty for comments and declarations. None: the rest is text."""
        page = self.page
        while True:
            start = self.find("<", at)
            if start < 0:
                return None
            if page.startswith("<!--", start):
                end = self.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(page), "", False, {}, False
            if start > self.last:
                return None
            follows = page[start + 1:start + 2]
            if follows in ("!", "?"):
                return start, page.find(">", start) + 1, "", False, {}, False
            m = OPENING.match(page, start)
            if m:
                return self.read(start, m)
            if follows == "/":
                return start, page.find(">", start) + 1, "", False, {}, False
            at = start + 1

    def read(self, start: int, m: re.Match) -> tuple[int, int, str, bool, dict[str, str], bool]:
        page, at, found = self.page, m.end(), {}
        ending = page[start + 1] == "/"
        if page[at:at + 1] == ">":
            return start, at + 1, m[1].lower(), ending, found, False
        closing = False
        while at <= self.last:
            if page[at] == ">":
                closing = page[at - 1] == "/"
                return start, at + 1, m[1].lower(), ending, found, closing
            a = ATTRIBUTE.match(page, at)
            at = a.end()
            if not a[2]:
                if a[1]:
                    found.setdefault(a[1].lower(), "")
                elif a.end() == a.start():
                    at += 1               # a sign that starts no attribute
                continue
            quote = page[at:at + 1]
            end = self.find(quote, at + 1) if quote in ("'", '"') else -1
            if end >= 0:
                value, at = page[at + 1:end], end + 1
            else:
                v = UNQUOTED.match(page, at)
                value, at = v[0].strip("'\""), v.end()
            found.setdefault(a[1].lower(), value)
        # quotes that run past the last end of a tag: the tag ends at its first one
        return start, page.find(">", start) + 1, m[1].lower(), ending, found, False


class Elements:
    """The open elements. For each name, and for the kinds that end or hold others, the places of the
    open ones are kept, so no tag walks the whole stack."""

    def __init__(self) -> None:
        # (name, number, lean, unseen, whether a negative lean came from a name alone, form)
        self.stack: list[tuple[str, int, float, bool, bool, int]] = [("", 0, 0.0, False, False, 0)]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.holds: list[int] = [0]

    def place(self, name: str) -> int:
        at = self.places.get(name)
        return at[-1] if at else 0

    def push(self, element: tuple[str, int, float, bool, bool, int]) -> None:
        name, k = element[0], len(self.stack)
        self.stack.append(element)
        self.places.setdefault(name, []).append(k)
        if name in BLOCK:
            self.blocks.append(k)
        if name in HOLDS:
            self.holds.append(k)

    def pop_to(self, k: int) -> None:
        while len(self.stack) > k:
            name = self.stack.pop()[0]
            self.places[name].pop()
            if name in BLOCK:
                self.blocks.pop()
            if name in HOLDS:
                self.holds.pop()


def read_blocks(page: str) -> list[Block]:
    """The page's blocks in order. ``lean``: what the elements around a block say (greater: content)."""
    blocks: list[Block] = []
    # for each form the one around it, and whether it holds an article or main element
    around: list[int] = [0]
    holds_article: list[bool] = [False]
    tags, open_ = Tags(page), Elements()
    stack = open_.stack
    number = 0
    texts: list[tuple[str, bool]] = []

    def close() -> None:
        if texts:
            joined = " ".join(entities.unescape("".join(t for t, _ in texts)).split())
            if joined:
                b = Block(stack[open_.holds[-1]][1], stack[-1][2], any(s[0] in HEADINGS for s in stack[-3:]), stack[-1][5])
                b.text = joined
                b.linked = sum(len(t.strip()) for t, linked in texts if linked)
                blocks.append(b)
            texts.clear()

    at = 0
    while True:
        tag = tags.next(at)
        piece = page[at:tag[0]] if tag else page[at:]
        if piece and not stack[-1][3]:
            texts.append((piece, bool(open_.place("a"))))
        if not tag:
            break
        _, at, name, ending, attributes, closing = tag
        if not name:
            continue
        if ending:
            k = open_.place(name)
            if name in BLOCK or k and open_.blocks and open_.blocks[-1] >= k:
                close()
            if k:
                open_.pop_to(k)
            continue
        if name == "br" or name in ("td", "th"):
            texts.append((" ", False))
        if name in BLOCK:
            close()
            k = open_.place("p")
            if k > open_.holds[-1]:
                open_.pop_to(k)           # a block-level element ends an open paragraph
        for other in ENDS.get(name, ()):
            k = open_.place(other)
            if k > open_.holds[-1]:
                open_.pop_to(k)
        if name in VOID or closing and name not in BLOCK:
            continue
        if name in RAW:
            end = RAW_ENDS[name].search(page, at)
            if end is None:
                break
            at = end.start()
        number += 1
        _, _, above, unseen, by_name, form = stack[-1]
        lean = above
        names = [n for key in ("class", "id", "role") for n in attributes.get(key, "").split()] if attributes and name not in ("html", "body") else []
        kind = names_kind(names) if names else ""
        if name in TOWARDS:
            if kind != "away" and (lean >= 0 or by_name):
                lean, by_name = STRUCTURE, False
            holds_article[form] = True
        elif name == "form":
            around.append(form)
            holds_article.append(False)
            form = len(around) - 1
        elif name in AWAY:
            by_name = False
            lean = min(lean, 0.0) - STRUCTURE * (2 if lean > 0 else 1)
        elif name == "header":
            by_name = False
            lean = lean - STRUCTURE / 2 if lean > 0 else lean - STRUCTURE
        if kind == "away" and name not in TOWARDS:
            # only a box named by its layout may still hold the page's article
            named_only = (by_name or above >= 0) and name not in AWAY and name != "header"
            by_name = named_only and not any(p.lower() in REPEATED or AWAY_TAIL.search(p.lower()) and "comments" in p.lower()
                                             for n in names for p in NAME_SPLIT.split(n))
            lean = min(lean, 0.0) - STRUCTURE * (2 if above > 0 else 1)
        elif kind == "soft" and name not in TOWARDS and name != "header":
            by_name = by_name or above >= 0
            lean = lean - STRUCTURE / 2 if lean > 0 else lean - STRUCTURE
        elif kind == "towards" and lean >= 0:
            lean = max(lean, STRUCTURE)
        open_.push((name, number, lean, unseen or name in UNSEEN, by_name, form))
    close()
    lean_of_forms(blocks, around, holds_article)
    return blocks


def lean_of_forms(blocks: list[Block], around: list[int], holds_article: list[bool]) -> None:
    """A form leans away, unless it holds an article or main element or most of the page's running
    text: then it is a frame around the page, as some servers write it."""
    running = [0] * len(around)
    total = 0
    for b in blocks:
        if b.lean >= 0 and b.text.count(" ") + 1 >= LONG_WORDS:
            running[b.form] += len(b.text)
            total += len(b.text)
    held = list(holds_article)
    for f in range(len(around) - 1, 0, -1):       # a form's number is above that of the one around it
        running[around[f]] += running[f]
        held[around[f]] = held[around[f]] or held[f]
    away = [False] * len(around)
    for f in range(1, len(around)):
        away[f] = away[around[f]] or not held[f] and not 2 * running[f] > total
    for b in blocks:
        if away[b.form]:
            b.lean = min(b.lean, 0.0) - STRUCTURE * (2 if b.lean > 0 else 1)


def text_features(b: Block) -> list[float]:
    n = len(b.text)
    words = b.text.count(" ") + 1
    return [1.0, b.linked / max(n, 1), min(np.log1p(words), 6.0), float(b.text[-1] in ".!?…\"”»"),
            float(any(c in b.text for c in "©|»")), float(b.heading)]


#: Log odds of the text features before any training (constant, links, length, sentence end, signs, heading).
PRIOR = [-0.5, -2.0, 0.4, 0.5, -0.8, 0.8]


def cost(b: Block, weights: list[float]) -> float:
    """What it costs to call the block boilerplate, less what it costs to call it content."""
    odds = sum(w * x for w, x in zip(weights, text_features(b)))
    return b.lean + max(-TEXT_LIMIT, min(TEXT_LIMIT, odds))


def minimum_cut(gains: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of least cost: a node of positive gain pays it when not chosen, one of negative gain pays
    when chosen, an edge pays when its ends differ. Maximum flow along shortest augmenting paths in
    levels (Dinic); chosen are the nodes that the source still reaches."""
    n = len(gains)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for k, g in enumerate(gains):
        if g > 0:
            join(source, k, g, 0.0)
        elif g < 0:
            join(k, sink, -g, 0.0)
    for a, b, w in edges:
        join(a, b, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[k] >= 0 for k in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if room[e] <= tiny)
                a = to[path[k] ^ 1]
                del path[k:]
                continue
            while turn[a] < len(out[a]):
                e = out[a][turn[a]]
                if room[e] > tiny and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(out[a]):
                path.append(e)
                a = to[e]
            elif path:
                e = path.pop()
                a = to[e ^ 1]
                turn[a] += 1
            else:
                break


def main_text(page: str | None, weights: list[float]) -> str:
    if not page:
        return ""
    blocks = read_blocks(page)
    gains = [cost(b, weights) for b in blocks]
    edges, last = [], {}
    for k, b in enumerate(blocks):
        w = ADJACENT if k else 0.0
        j = last.get(b.parent)
        if j is not None and j == k - 1:
            w += SIBLING
        elif j is not None:
            edges.append((j, k, SIBLING))
        if w:
            edges.append((k - 1, k, w))
        last[b.parent] = k
    # where no smoothness edge joins blocks of different sign the signs are the minimum cut already
    if any((gains[a] > 0) != (gains[b] > 0) for a, b, _ in edges):
        chosen = minimum_cut(gains, edges)
    else:
        chosen = [g > 0 for g in gains]
    return "\n".join(b.text for b, c in zip(blocks, chosen) if c)


def train_weights(pages: DataFrame, html: Column, max_pages: int = TRAIN_PAGES) -> list[float]:
    """Logistic regression of "inside an article or main element" against "inside an element that is
    never content", over the text features of the blocks of at most ``max_pages`` distinct pages: those
    of the least hashes, so neither the order nor the layout of the table matters. The feature vectors
    of their blocks reach the driver, a bounded number for bounded pages."""
    def labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(text_features(b), 1.0 if b.lean > 0 else 0.0)
                    for page in batch["html"] for b in read_blocks(page or "") if b.lean]
            yield pd.DataFrame({"x": [x for x, _ in rows], "y": [y for _, y in rows]})

    hashed = pages.select(html.alias("html")).where(F.col("html").isNotNull()).withColumn("h", F.xxhash64("html"))
    least = [r.h for r in hashed.select("h").distinct().orderBy("h").limit(max_pages).collect()]
    chosen = hashed.where(F.col("h") <= F.lit(max(least, default=0))).groupBy("h").agg(F.min("html").alias("html"))
    rows = chosen.select("html").mapInPandas(labelled, "x array<double>, y double").toPandas()
    rows = rows.iloc[sorted(range(len(rows)), key=lambda k: (rows["y"].iloc[k], list(rows["x"].iloc[k])))]
    w = np.array(PRIOR)
    if rows.empty or rows["y"].nunique() < 2:
        return PRIOR
    x, y = np.stack(rows["x"].to_numpy()), rows["y"].to_numpy()
    for _ in range(25):           # Newton's method, held near the prior
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (p - y) + (w - PRIOR)
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w)), slope)
    return [float(v) for v in w]


def extract(pages: DataFrame, html: Column) -> Column:
    """A string column for ``pages``: the main text of ``html``."""
    ship(pages.sparkSession)
    weights = train_weights(pages, html)

    @F.pandas_udf("string")
    def text(page: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, weights) for p in page], dtype=object)

    return text(html)
