"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded
along the tree.

A page is read into a small DOM of its block elements (and of inline elements
that carry a class or id).  Each node is described by its subtree's size,
density, links and paragraphs, its depth, its place and share among its
siblings, and the words in its tag, class, id and role.  Boosted trees give
each node the log odds of being main text.  Decoding then picks, from the root
down, subtrees that enter the main text and subtrees inside them that leave it
again, maximising the summed log odds of the text: a node cannot be chosen
both with and without its ancestor.  Leaving costs a short block no more than
its length, and nothing where a node's own words speak against it.

Training needs no hand labels: pages that mark their article (``article`` or
``main``) label their own nodes.  The marks are hidden in one copy of the
training nodes, so that shape and wording are learnt too, and boilerplate is
repeated as if it stood inside an article.  At most ``SAMPLE`` pages are read
for it, chosen by a hash of page_id.

Some tags (``NEVER``: controls, menus, asides and the like) never hold main
text.  A form is one of them unless it wraps an article or main element or most
of the page's text: then the trees and the decoding decide, and only its labels
and controls are left out.

Defined results: null or empty html gives an empty text; so does a page without
main text.  Repeated rows give repeated results.  Without any marked page the
trees are replaced by the words in tag, class, id and role alone.
"""

from __future__ import annotations

import html as entities
import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sampled

# Bound on the pages that training reads.
SAMPLE = 600
NODES = 400  # nodes of a page, on average
TREES, DEPTH, RATE, BINS = 40, 3, 0.3, 32
# Cost of entering and of leaving the main text, in log odds times characters.
# Leaving costs LEAVE_EACH a character up to LEAVE, and nothing at a bad word.
ENTER, LEAVE, LEAVE_EACH = 20.0, 60.0, 1.0
_PAGES = 200  # pages scored in one array step

BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript object
ol option p pre section select summary svg table tbody td template tfoot th thead tr ul video audio""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
NEVER = frozenset("""script style textarea title xmp head nav form button select option iframe noscript object svg
template footer aside menu dialog video audio""".split())
# Tag: the open tags that its start closes, and the tags beyond which it does not look.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
GOOD = frozenset("article main content post entry story body text".split())
BAD = frozenset("""nav menu menubar header footer side sidebar aside ad ads advert adverts advertisement advertising promo
promotion promoted sponsor sponsored banner cookie cookies notice notices alert consent gdpr comment comments disqus reply
replies respond discussion form search login signup share sharing social related recommended widget popup modal overlay
subscribe subscription newsletter copyright breadcrumb breadcrumbs pagination pager toolbar masthead navbar""".split())
MARKS = frozenset(("article", "main"))

_TAG = re.compile(r"<(?:!--(.*?(?:--!?>|\Z))|[!?][^>]*>|(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
                  r"((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>|[^>]*>?))", re.S)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# Words that may stand beside a bad one in a name without
# changing what it says (``left-sidebar``; not ``no-sidebar``, ``advertising-history``).
BESIDE = frozenset("""site page main top bottom left right upper lower inner outer first last primary secondary global local
mobile desktop sticky fixed block area section slot unit box wrap wrapper container row col column panel bar list item items
link links button buttons icon icons group title text content body post posts entry article story view widget module the
and for""".split())
_SPACE = re.compile(r"[ \t\n\r\f\v   -     　\u0085]+")
_STOPS = re.compile(r"[.,;:!?]")


@lru_cache(maxsize=1 << 16)
def words_of(name: str) -> frozenset[str]:
    """Words of one class, id or role.  A bad word counts if all others in the name
    are bad, or say only where or what part it is (BESIDE), or are single letters."""
    words = frozenset(w.lower() for w in _WORD.findall(name))
    others = {w for w in words - BAD - BESIDE if len(w) > 1}
    return words - BAD if others else words


class Page:
    """Nodes in page order (a parent before its children) and the flow of text:
    (node, text), or (node, None) where a block begins or ends."""

    def __init__(self, html: str):
        self.tag, self.parent, self.words = ["html"], [-1], [frozenset()]
        self.links, self.controls = [0], [0]
        self.flow: list[tuple[int, str | None]] = []
        self._read(html)
        self.never = self._never()

    def _read(self, html: str) -> None:
        stack, at, link = [0], 0, 0
        flow, tags = self.flow, self.tag
        search, n = _TAG.search, len(html)
        while at < n:
            m = search(html, at)
            start = m.start() if m else n
            if start > at:
                text = entities.unescape(html[at:start])
                flow.append((stack[-1], text))
                if link:
                    self.links[stack[-1]] += len(text)
            if not m:
                break
            at = m.end()
            name = m[3]
            if not name:
                continue
            name = name.lower()
            if m[2]:
                if name == "a":
                    link = 0
                elif name == "br":
                    flow.append((stack[-1], None))
                self._close(stack, name)
                continue
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(html, at)
                after = html.find(">", end.end()) if end else -1
                at = after + 1 if after >= 0 else n
                continue
            if name in VOID:
                if name in ("br", "hr"):
                    flow.append((stack[-1], None))
                elif name == "input":
                    self.controls[stack[-1]] += 1
                continue
            attrs = m[4]
            names = _NAMES.findall(attrs) if len(attrs) > 3 else ()
            if name in BLOCKS:
                if tags[stack[-1]] == "p" and name != "p" or name == "p":
                    if "p" in (tags[k] for k in stack[-3:]):
                        self._close(stack, "p")
                if name in CLOSES:
                    closed, beyond = CLOSES[name]
                    for k in range(len(stack) - 1, 0, -1):
                        if tags[stack[k]] in beyond:
                            break
                        if tags[stack[k]] in closed:
                            del stack[k:]
                            flow.append((stack[-1], None))
                            break
                if name == "html" or name == "body" and "body" in (tags[k] for k in stack):
                    continue
                self._open(stack, name, names)
                flow.append((stack[-1], None))
            elif name == "a":
                link = 1
            elif names or name == "label":
                self._open(stack, name, names)

    def _open(self, stack: list[int], name: str, names) -> None:
        words = {name}
        for found in names:
            for name_ in "".join(found).split():
                words.update(words_of(name_))
        self.tag.append(name)
        self.parent.append(stack[-1])
        self.words.append(frozenset(words))
        self.links.append(0)
        self.controls.append(0)
        stack.append(len(self.tag) - 1)

    def _close(self, stack: list[int], name: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[k]]
            if tag == name:
                del stack[k:]
                if name in BLOCKS:
                    self.flow.append((stack[-1], None))
                return
            if tag in ("table", "td", "th") and name not in ("table", "tr", "tbody", "thead", "tfoot", "body"):
                return

    def _never(self) -> list[bool]:
        """Nodes without main text.  A form that wraps the page's article or
        most of its text is none; its tag and names don't speak against it."""
        never = [t in NEVER for t in self.tag]
        if "form" in self.tag:
            n = len(self.tag)
            text, marked, blocks = [0] * n, [t in MARKS for t in self.tag], [0] * n
            for node, part in self.flow:
                text[node] += len(part.strip()) if part else 0
            for k in range(n - 1, 0, -1):
                p = self.parent[k]
                text[p] += text[k]
                marked[p] |= marked[k]
                blocks[p] += self.tag[k] in BLOCKS or blocks[k] > 0
            wraps = [False] * n
            for k in range(1, n):
                wraps[k] = wraps[self.parent[k]]
                if self.tag[k] == "form" and (marked[k] or 2 * text[k] > text[0]):
                    wraps[k], never[k] = True, False
                    self.words[k] = self.words[k] - {"form"}
                elif wraps[k] and self.tag[k] == "label":
                    never[k] = not blocks[k]
        return never

    def describe(self) -> np.ndarray:
        """One row of FEATURES for each node; keeps the nodes' own text lengths."""
        n = len(self.tag)
        own, stops = [0] * n, [0] * n
        for node, text in self.flow:
            if text:
                own[node] += len(text)
                stops[node] += len(_STOPS.findall(text))
        self.own = own
        text, links, marks = own[:], self.links[:], stops[:]
        tags, paras, items, controls = [1] * n, [0] * n, [0] * n, self.controls[:]
        kids, kid_text = [0] * n, [0] * n
        for k in range(n - 1, 0, -1):
            p = self.parent[k]
            paras[k] += self.tag[k] == "p"
            items[k] += self.tag[k] in ("li", "td", "option")
            text[p] += text[k]
            links[p] += links[k]
            marks[p] += marks[k]
            tags[p] += tags[k]
            paras[p] += paras[k]
            items[p] += items[k]
            controls[p] += controls[k]
            kids[p] += 1
            kid_text[p] += text[k]
        depth, place, good, bad = [0] * n, [0] * n, [0] * n, [0] * n
        seen = [0] * n
        rows = []
        page = text[0] + 1
        for k in range(n):
            p = self.parent[k]
            w = self.words[k]
            own_good, own_bad = not GOOD.isdisjoint(w), not BAD.isdisjoint(w)
            if k:
                depth[k] = depth[p] + 1
                seen[p] += 1
                place[k] = seen[p]
                good[k], bad[k] = good[p] or (own_good and w.isdisjoint(("body",))), bad[p] or own_bad
            t = text[k] + 1
            rows.append((math.log(own[k] + 1), math.log(t), links[k] / t, math.log(tags[k]), t / tags[k], depth[k],
                         kids[k], place[k] / (kids[p] if k else 1), kids[p] if k else 1,
                         t / (kid_text[p] + 1) if k else 1.0, t / page, paras[k], items[k], controls[k],
                         100 * marks[k] / t, own_good, own_bad, good[k], bad[k]))
        return np.array(rows, float)

    def labels(self) -> np.ndarray | None:
        """1 for nodes of the marked article, 0 for others; None if unmarked."""
        if MARKS.isdisjoint(self.tag):
            return None
        inside = [0] * len(self.tag)
        for k in range(1, len(self.tag)):
            out = self.never[k] or not BAD.isdisjoint(self.words[k])
            inside[k] = int((inside[self.parent[k]] or self.tag[k] in MARKS) and not out)
        return np.array(inside)

    def main_text(self, odds: np.ndarray) -> str:
        """Text of the subtrees chosen by the best consistent decision."""
        n = len(self.tag)
        odds = odds.tolist()
        within = [o * t for o, t in zip(odds, self.own, strict=True)]
        without = [0.0] * n
        never = self.never
        text, leave = self.own[:], [0.0] * n
        for k in range(n - 1, 0, -1):
            p = self.parent[k]
            text[p] += text[k]
            if BAD.isdisjoint(self.words[k]):
                leave[k] = min(LEAVE, LEAVE_EACH * text[k])
            if never[k]:
                within[k] = -math.inf
            within[p] += max(within[k], -leave[k]) if within[k] > -math.inf else 0.0
            without[p] += max(without[k], within[k] - ENTER, 0.0) if not never[k] else 0.0
        chosen = [False] * n
        gone = [False] * n
        for k in range(n):
            p = self.parent[k]
            if k and (gone[p] or never[k]):
                gone[k] = True
            elif k and chosen[p]:
                chosen[k] = within[k] >= -leave[k]
                gone[k] = not chosen[k]
            else:
                chosen[k] = within[k] - ENTER > without[k]
        return joined(self.flow, chosen)


def joined(flow, chosen) -> str:
    blocks, part = [], []
    for node, text in flow:
        if text is None:
            if part:
                blocks.append("".join(part))
                part = []
        elif chosen[node]:
            part.append(text)
    blocks.append("".join(part))
    clean = (_SPACE.sub(" ", b).strip(" ") for b in blocks)
    return "\n".join(b for b in clean if b)


FEATURES = ("own text", "subtree text", "link share", "tags", "density", "depth", "children", "place", "siblings",
            "share of siblings", "share of page", "paragraphs", "items", "controls", "punctuation", "own good word",
            "own bad word", "good word above", "bad word above")
OWN_GOOD, OWN_BAD, GOOD_ABOVE, BAD_ABOVE = 15, 16, 17, 18


class Trees:
    """Boosted regression trees of fixed depth under logistic loss."""

    def __init__(self, feature: np.ndarray, limit: np.ndarray, leaf: np.ndarray, start: float):
        self.feature, self.limit, self.leaf, self.start = feature, limit, leaf, start

    def odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.limit, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            total += leaf[at - (2 ** DEPTH - 1)]
        return total


class Words:
    """Without training pages: the words of tag, class, id and role alone."""

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.where(x[:, BAD_ABOVE] > 0, -2.0, np.where(x[:, GOOD_ABOVE] > 0, 2.0, 0.5 - 2 * x[:, 2]))


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Newton boosting over quantile bins."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T, strict=True)], 1)
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(rate / (1 - rate)))
    score = np.full(len(y), start)
    inner = 2 ** DEPTH - 1
    feature, limit, leaf = (np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf),
                            np.zeros((TREES, inner + 1)))
    for tree in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(len(y), np.int64)
        for node in range(inner):
            mine = np.flatnonzero(at == node)
            best = (1e-6, 0, np.inf)
            if len(mine):
                tg, th = g[mine].sum(), h[mine].sum()
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    b = binned[mine, f]
                    lg = np.bincount(b, g[mine], len(c) + 1).cumsum()[:-1]
                    lh = np.bincount(b, h[mine], len(c) + 1).cumsum()[:-1]
                    gain = lg ** 2 / (lh + 1) + (tg - lg) ** 2 / (th - lh + 1) - tg ** 2 / (th + 1)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, float(c[k]))
            _, feature[tree, node], limit[tree, node] = best
            at[mine] = 2 * node + 1 + (x[mine, best[1]] > best[2])
        place = at - inner
        leaf[tree] = RATE * np.bincount(place, g, inner + 1) / (np.bincount(place, h, inner + 1) + 1)
        score += leaf[tree][place]
    return Trees(feature, limit, leaf, start)


def augmented(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes, the nodes without the article's marks, and boilerplate as if
    it stood in an article."""
    hidden = x.copy()
    hidden[:, [OWN_GOOD, GOOD_ABOVE]] = 0
    moved = x[(y == 0) & (x[:, BAD_ABOVE] > 0)].copy()
    moved[:, GOOD_ABOVE] = 1
    return np.concatenate([x, hidden, moved]), np.concatenate([y, y, np.zeros(len(moved))])


def pages_of(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     F.col(html_col).cast("string").alias("html"))


def train(pages: DataFrame, sample: int = SAMPLE) -> Trees | Words:
    """Fit on the nodes of at most ``sample`` pages (at most ``sample * NODES``
    nodes, first by page_id)."""
    marked = pages_of(pages).where(F.col("html").rlike("(?i)<(article|main)[ >]")).select("page_id").distinct()
    chosen = sampled(marked, sample, "page_id")

    def run(batches):
        for rb in batches:
            for page_id, html in zip(rb.column("page_id").to_pylist(), rb.column("html").to_pylist(), strict=True):
                page = Page(html or "")
                y = page.labels()
                if y is not None:
                    x = page.describe()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([page_id] * len(y)), pa.array(y, pa.int32()), pa.array(x.tolist(), pa.list_(pa.float64()))],
                        ["page_id", "label", "x"])
    got = (pages_of(pages).join(F.broadcast(chosen), "page_id").select("page_id", "html")
           .mapInArrow(run, "page_id long, label int, x array<double>").orderBy("page_id", F.xxhash64("x", "label"))
           .limit(sample * NODES).toArrow())
    y = got["label"].to_numpy()
    if len(set(y.tolist())) < 2:
        return Words()
    return boost(*augmented(np.array(got["x"].to_pylist()), y))


def extract(pages: DataFrame, model: Trees | Words) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        trees = sent.value
        for rb in batches:
            for at in range(0, rb.num_rows, _PAGES):
                part = rb.slice(at, _PAGES)
                read = [Page(h or "") for h in part.column("html").to_pylist()]
                x = [p.describe() for p in read]
                odds = np.split(trees.odds(np.concatenate(x)), np.cumsum([len(r) for r in x])[:-1])
                texts = [p.main_text(o) for p, o in zip(read, odds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return pages_of(pages).mapInArrow(run, "page_id long, url string, text string, n_chars long")
