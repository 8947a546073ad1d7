"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element and every block of text is a node with a hidden label, content or not.  Features of a
node pull its label, parent-child potentials couple the labels along the tree, and sum-product messages, up
and then down, give each block its exact marginal.  The weights are fitted on labelled pages.
"""

from __future__ import annotations

import html
import math
import random
import re
from bisect import bisect_right
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import map_text

# Element names of HTML by how they are treated.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math object select button canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q ruby rb rp rt rtc s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
SECTIONS = frozenset("article aside footer form header main nav".split())
#: An opening tag ends open elements of these names, as far up as the first of the second names.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
    "tbody": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
#: Words of class, id and role attributes that features are made of.
KEYWORDS = frozenset(
    """ad ads advert advertisement advertising adslot alert aside author banner bar body bottom box breadcrumb breadcrumbs byline card
    col column comment comments commentlist consent container content contentinfo complementary cookie cookies copyright cta date
    dialog discussion disqus entry featured feed feedback foot footer form gdpr grid head header hero inner intro item layout lead
    legal links list login logo main masthead menu message meta modal more nav navbar navigation news newsletter notice notification
    overlay page pager pagination paywall popular popup post primary privacy promo prose promoted rail recommended related replies reply
    respond review row search section share sharing sidebar side signup site skip social sponsor sponsored story subscribe subscription
    tab tags text thread title toast toolbar top topbar trending user utility wrap wrapper article widget widgets""".split()
)

SENTENCE_ENDS = frozenset(".!?:;\"'”»…")

_MARK = re.compile(r"<(?:[!?]|/?[a-zA-Z])")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_BODY = re.compile(r"(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")


@dataclass
class Tree:
    """Nodes in page order, parents first; ``text`` is None for elements."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    attrs: list[dict] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)  # characters of a text that lie in links

    def add(self, parent: int, tag: str, attrs: dict, text: str | None = None, linked: int = 0) -> int:
        for column, value in zip((self.parent, self.tag, self.attrs, self.text, self.linked), (parent, tag, attrs, text, linked), strict=True):
            column.append(value)
        return len(self.parent) - 1


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


class _Marks:
    """Tags of a page in order, in time linear in the page however broken it is."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        #: Quotes are read until a tag's quotes run to the end of the page; from then on a tag ends at the next >.
        self.quotes = True
        self.endless: set[str] = set()

    def find(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """Start, end, lower-case name ("" for comments and declarations), whether it is an end tag, and attributes."""
        page = self.page
        while m := _MARK.search(page, at):
            start = m.start()
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(page), "", False, ""
            if page[start + 1] in "!?":
                end = page.find(">", start + 2)
                return start, end + 1 if end >= 0 else len(page), "", False, ""
            if start > self.last:  # no tag can end any more
                at = start + 2
                continue
            ending = page[start + 1] == "/"
            name = _NAME.match(page, start + 1 + ending)
            end = -1
            if self.quotes:
                end = _BODY.match(page, name.end()).end()
                if page[end : end + 1] != ">":
                    self.quotes, end = False, -1
            if end < 0:
                end = page.find(">", name.end())
            if end < 0:
                at = start + 2
                continue
            return start, end + 1, name[0].lower(), ending, page[name.end() : end]
        return None

    def after_raw(self, name: str, at: int) -> int | None:
        """Where the next end tag of ``name`` ends."""
        if name in self.endless:
            return None
        m = _raw_end(name).search(self.page, at, self.last + 1)
        if not m:
            self.endless.add(name)
        return m.end() if m else None


@lru_cache(maxsize=64)
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.IGNORECASE)


def parse(page: str) -> Tree:
    """The page's block elements and texts; inline elements only mark links, what RAW elements hold is left out."""
    tree = Tree()
    stack = [tree.add(-1, "#page", {})]
    places: dict[str, list[int]] = {}  # of the open elements of a name on the stack, outermost first
    run: list[tuple[str, bool]] = []
    links = 0
    marks = _Marks(page)

    def flush() -> None:
        if run:
            whole = " ".join("".join(t for t, _ in run).split())
            if whole:
                linked = sum(len(t.strip()) for t, inside in run if inside)
                tree.add(stack[-1], "#text", {}, whole, min(linked, len(whole)))
            run.clear()

    def close_until(k: int) -> None:
        nonlocal links
        flush()
        links = 0
        for node in stack[k:]:
            places[tree.tag[node]].pop()
        del stack[k:]

    def innermost(names) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    at = 0
    while at < len(page):
        mark = marks.find(at)
        upto = mark[0] if mark else len(page)
        if upto > at:
            run.append((html.unescape(page[at:upto]), links > 0))
        if not mark:
            break
        _, at, name, ending, attrs = mark
        if not name:
            continue
        if ending:
            if name in INLINE:
                links = max(0, links - (name == "a"))
            elif k := innermost((name,)):
                close_until(k)
            elif name == "p":
                flush()
            continue
        if name in RAW and not attrs.endswith("/"):
            # raw contents end at the element's own end tag
            end = marks.after_raw(name, at)
            at = end if end is not None else (len(page) if name in ("script", "style", "textarea", "title") else at)
            run.append((" ", False))
            continue
        if name in INLINE:
            links += name == "a"
            if name == "br":
                run.append((" ", False))
            continue
        if name in CLOSES_P:
            k = innermost(("p", "td", "th", "li", "button", "table"))
            if k and tree.tag[stack[k]] == "p":
                close_until(k)
        if name in ENDS:
            ends, stops = ENDS[name]
            above = innermost(stops)
            inside = [places[n][i] for n in ends if places.get(n) for i in [bisect_right(places[n], above)] if i < len(places[n])]
            if inside:
                close_until(min(inside))
        flush()
        if name not in VOID:
            places.setdefault(name, []).append(len(stack))
            stack.append(tree.add(stack[-1], name, _attributes(attrs)))
            links = 0
    flush()
    return tree


def _bucket(n: float) -> int:
    return min(8, int(math.log2(n + 1)) // 1 if n < 255 else 8)


def node_features(tree: Tree) -> list[list[str]]:
    """Names of each node's features."""
    n = len(tree.parent)
    size, linked, blocks = [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        if tree.text[i] is not None:
            size[i], linked[i], blocks[i] = len(tree.text[i]), tree.linked[i], 1
        if i:
            p = tree.parent[i]
            size[p] += size[i]
            linked[p] += linked[i]
            blocks[p] += blocks[i]
    found = []
    near = ["page"] * n  # the closest sectioning element
    kind = "article" if "article" in tree.tag else "main" if "main" in tree.tag else "other"
    for i in range(n):
        near[i] = tree.tag[i] if tree.tag[i] in SECTIONS else near[tree.parent[i]] if i else "page"
        share = int(4 * linked[i] / size[i] + 0.5) if size[i] else -1
        if tree.text[i] is not None:
            t, tag = tree.text[i], tree.tag[tree.parent[i]]
            words = t.count(" ") + 1
            found.append(
                [
                    "text", f"text under {near[i]}", f"text under {near[i]} in {kind}", f"words {_bucket(words)}", f"linked {share}", f"words {_bucket(words) // 2} linked {share}", f"in {tag}",
                    f"{'sentence' if t[-1] in SENTENCE_ENDS else 'open'} {_bucket(words) // 2}", *(["legal"] if "©" in t or "(c)" in t.lower() else []),
                    *(["bars"] if t.count("|") + t.count("·") + t.count("»") > words / 4 else []),
                ]
            )
            continue
        attrs = tree.attrs[i]
        named = " ".join(attrs.get(k, "") for k in ("class", "id", "role", "itemprop", "aria-label"))
        keys = {w for w in (x.lower() for x in _TOKEN.findall(named)) if w in KEYWORDS}
        hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "")
        mean = size[i] / blocks[i] if blocks[i] else 0
        found.append(
            [
                "element", f"{tree.tag[i]} in {tree.tag[tree.parent[i]] if i else 'nothing'}", f"under {near[i]}", f"under {near[i]} in {kind}", f"of all {int(8 * size[i] / max(size[0], 1))}", f"tag {tree.tag[i]}", f"block {_bucket(mean)}", f"block linked {share}", f"block {_bucket(mean) // 2} linked {share}",
                *(f"key {k}" for k in sorted(keys)), *(["hidden"] if hidden else []), *(["unnamed"] if not named.strip() else []),
            ]
        )
    return found


@dataclass
class DomModel:
    """weights: pull of a feature to content; potentials: [edge kind, parent's label, child's label]."""

    weights: dict[str, float]
    potentials: np.ndarray

    def marginals(self, tree: Tree) -> list[float]:
        """Each node's probability of content, by one pass of messages up and one down."""
        n = len(tree.parent)
        up = [sum(self.weights.get(f, 0.0) for f in fs) for fs in node_features(tree)]  # log odds of what lies below
        tables = [tuple(float(x) for x in t.ravel()) for t in self.potentials]
        sent = [0.0] * n
        for i in range(n - 1, 0, -1):
            a, b, c, d = tables[tree.text[i] is not None]
            sent[i] = _log_add(c, d + up[i]) - _log_add(a, b + up[i])
            up[tree.parent[i]] += sent[i]
        odds = up[:]  # of the whole tree
        for i in range(1, n):
            a, b, c, d = tables[tree.text[i] is not None]
            above = odds[tree.parent[i]] - sent[i]
            odds[i] = up[i] + _log_add(b, d + above) - _log_add(a, c + above)
        return [1 / (1 + math.exp(-max(-60.0, min(60.0, x)))) for x in odds]


def _log_add(x: float, y: float) -> float:
    return max(x, y) + math.log1p(math.exp(-abs(x - y)))


def fit(pages: list[str], *, steps: int = 300, rate: float = 0.15, l2: float = 2e-4) -> DomModel:
    """Maximum likelihood on pages whose elements carry data-y="1" (content) or "0"; others inherit, outermost 0.

    A page without any mark is all content.
    """
    names: dict[str, int] = {}
    parent, label, kind, depth, rows, cols = [], [], [], [], [], []
    for page in pages:
        tree, base, outermost = parse(page), len(parent), int("data-y" not in page)
        for i, fs in enumerate(node_features(tree)):
            p = tree.parent[i]
            parent.append(base + p if p >= 0 else -1)
            label.append(int(tree.attrs[i].get("data-y", label[base + p] if p >= 0 else outermost)))
            depth.append(depth[base + p] + 1 if p >= 0 else 0)
            kind.append(int(tree.text[i] is not None))
            for f in fs:
                rows.append(base + i)
                cols.append(names.setdefault(f, len(names)))
    parent, label, kind, depth, rows, cols = (np.array(x) for x in (parent, label, kind, depth, rows, cols))
    levels = [np.flatnonzero(depth == d) for d in range(1, depth.max(initial=0) + 1)]
    params = np.concatenate([np.zeros(len(names)), np.tile([0.5, -0.5, -0.5, 0.5], 2)])
    first, second = np.zeros_like(params), np.zeros_like(params)
    child = np.flatnonzero(parent >= 0)
    truth = np.zeros((2, 2, 2))
    np.add.at(truth, (kind[child], label[parent[child]], label[child]), 1)
    for step in range(1, steps + 1):
        w, pot = params[: len(names)], params[len(names) :].reshape(2, 2, 2)
        up = np.bincount(rows, w[cols], len(parent))
        sent = np.zeros(len(parent))
        for at in reversed(levels):
            t = pot[kind[at]]
            sent[at] = np.logaddexp(t[:, 1, 0], t[:, 1, 1] + up[at]) - np.logaddexp(t[:, 0, 0], t[:, 0, 1] + up[at])
            up += np.bincount(parent[at], sent[at], len(parent))
        odds = up.copy()
        for at in levels:
            t, above = pot[kind[at]], odds[parent[at]] - sent[at]
            odds[at] = up[at] + np.logaddexp(t[:, 0, 1], t[:, 1, 1] + above) - np.logaddexp(t[:, 0, 0], t[:, 1, 0] + above)
        p = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
        above = (odds[parent[child]] - sent[child])[:, None, None] * np.array([[0.0, 0.0], [1.0, 1.0]])
        joint = pot[kind[child]] + above + up[child][:, None, None] * np.array([[0.0, 1.0], [0.0, 1.0]])
        joint = np.exp(joint - joint.max((1, 2), keepdims=True))
        joint /= joint.sum((1, 2), keepdims=True)
        expected = np.stack([joint[kind[child] == k].sum(0) for k in (0, 1)])
        grad = np.concatenate([np.bincount(cols, (p - label)[rows], len(names)), (expected - truth).ravel()]) / len(pages) + l2 * params
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        params -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return DomModel(dict(zip(names, params[: len(names)].tolist(), strict=True)), params[len(names) :].reshape(2, 2, 2))


class PageMaker:
    """Labelled training pages from a seed: many layouts and names around texts of random syllables."""

    SYLLABLES = "ka lo min ter va su ne ri to dal pe ron shi mu ela con pra ist ver olo".split()
    CONTENT = "article content post entry story main text prose post-content entry-content article-body story-text page-content main-content".split()
    JUNK = {
        "nav": "nav menu navbar main-menu site-nav breadcrumbs breadcrumb pagination pager tabs toolbar links".split(),
        "header": "header site-header masthead topbar page-header hero banner logo".split(),
        "footer": "footer site-footer bottom copyright legal contentinfo".split(),
        "aside": "sidebar side rail widget related recommended popular trending more promo secondary-column author-card".split(),
        "notice": "cookie cookie-notice notice alert consent gdpr privacy-banner popup modal message notification toast paywall".split(),
        "ad": "ad ads advert advertisement ad-slot sponsored sponsor promoted banner-ad promo-box".split(),
        "form": "form search login signup newsletter subscribe feedback respond".split(),
        "comments": "comments comment-list commentlist discussion replies thread disqus reader-comments".split(),
        "share": "share sharing social tags meta share-bar toolbar".split(),
    }
    TAGS = {"nav": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"], "form": ["form", "form", "div"], "comments": ["section", "div", "ol"]}

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choices(self.SYLLABLES, k=self.r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def prose(self, low: int = 1, high: int = 6) -> str:
        return " ".join(self.words(1, 18).capitalize() + self.r.choice("...!?") for _ in range(self.r.randint(low, high)))

    def paragraph(self) -> str:
        """Mostly a few sentences; some are long, some have no sentence marks at all."""
        k = self.r.random()
        return self.prose() if k < 0.8 else self.prose(8, 40) if k < 0.87 else self.words(1, 30) if k < 0.94 else self.words(60, 400)

    def link(self, text: str) -> str:
        return f'<a href="/{self.word()}">{text}</a>'

    def wrap(self, tag: str, inner: str, names: list[str], y: int | None = None) -> str:
        r = self.r.random()
        name = f' class="{self.r.choice(names)}"' if r < 0.55 else f' id="{self.r.choice(names)}"' if r < 0.75 else f' class="{self.word()}"' if r < 0.8 else ""
        if not name and tag in ("div", "ul", "ol", "section"):
            name = f' class="{self.r.choice(names)}"' if self.r.random() < 0.8 else ""
        return f"<{tag}{name}" + (f' data-y="{y}"' if y is not None else "") + f">{inner}</{tag}>"

    def entries(self, low: int, high: int) -> str:
        return "".join(f"<li>{self.link(self.words(1, 4))}</li>" for _ in range(self.r.randint(low, high)))

    def junk(self, kind: str) -> str:
        r = self.r
        tag = r.choice(self.TAGS.get(kind, ["div", "div", "section", "aside", "p"] if kind == "ad" else ["div"]))
        if kind == "nav":
            inner = self.entries(3, 9) if tag == "ul" else r.choice([f"<ul>{self.entries(3, 9)}</ul>", " ".join(self.link(self.words(1, 2)) for _ in range(r.randint(2, 8)))])
        elif kind == "header":
            inner = self.link(self.words(1, 3)) + r.choice(["", f"<p>{self.words(3, 9)}</p>", f"<h1>{self.words(1, 3)}</h1>", f"<nav><ul>{self.entries(3, 6)}</ul></nav>"])
        elif kind == "footer":
            inner = r.choice([f"&copy; {self.words(1, 3)} &middot; {self.prose(1, 2)}", f"<p>&copy; 2024 {self.words(1, 4)}.</p>", f"<p>{self.prose(1, 3)}</p><ul>{self.entries(2, 6)}</ul>", f"{self.prose(1, 2)}"])
        elif kind == "aside":
            head = f"<h{(n := r.randint(2, 4))}>{self.words(1, 3)}</h{n}>" * r.randint(0, 1)
            inner = head + r.choice([f"<ul>{self.entries(2, 8)}</ul>", f"<p>{self.prose(1, 3)}</p>", f"<p>{self.prose(2, 6)}</p>" * r.randint(1, 3), "".join(f"<div>{self.link(self.words(3, 8))}<p>{self.words(5, 14)}</p></div>" for _ in range(r.randint(1, 4)))])
        elif kind == "notice":
            inner = r.choice([f"<p>{self.prose(2, 5)}</p>", f"<p>{self.prose(1, 3)}</p><button>{self.word()}</button>", f"{self.prose(1, 2)} {self.link(self.word())}", self.prose(1, 2)])
        elif kind == "ad":
            inner = r.choice([self.prose(1, 4), f"<p>{self.prose(1, 4)}</p>", self.link(self.words(3, 9)), f"{self.words(2, 6)} {self.link(self.words(1, 3))}", self.prose(1, 3).replace(". ", ".\n")])
        elif kind == "form":
            inner = f"<label>{self.words(1, 3)}</label><input name='q'>" + r.choice(["", f"<p>{self.prose(1, 2)}</p>", f"<p>{self.prose(1, 3)}</p>", f"<h3>{self.words(2, 5)}</h3>"]) + f"<button>{self.word()}</button>"
        elif kind == "comments":
            item = r.choice(["li", "div", "article"])
            one = lambda: self.wrap(item, f"<b>{self.word()}</b> " * r.randint(0, 1) + r.choice([f"<p>{self.prose(1, 4)}</p>", f"<p>{self.prose(2, 7)}</p>", self.prose(1, 3)]), ["comment", "reply", "comment-body", "user-comment"])
            inner = f"<h3>{self.words(1, 3)}</h3>" * r.randint(0, 1) + ("".join(one() for _ in range(r.randint(1, 5))) if r.random() < 0.8 else f"<p>{self.prose(1, 6)}</p>" * r.randint(1, 3))
        else:
            inner = " ".join(self.link(self.words(1, 2)) for _ in range(r.randint(1, 5)))
        return self.wrap(tag, inner, self.JUNK[kind], 0)

    def content(self) -> str:
        r, parts = self.r, []
        for _ in range(r.choice([0, 1, 2, 4, 6, 10])):
            k = r.random()
            open_b = r.choice(["", "", "<b>", "<em>"])
            if k < 0.05:
                parts.append(f"<div>{self.paragraph()}{'<br>' + self.prose() * r.randint(0, 1)}</div>")
            elif k < 0.62:
                parts.append(f"<p>{open_b}{self.paragraph()}{'<br>' * r.randint(0, 1)}" + ("</p>" if r.random() < 0.8 else ""))
            elif k < 0.68:
                parts.append(f"<p>{self.prose(1, 3)} {self.link(self.words(1, 4))} {self.prose(1, 2)}</p>")
            elif k < 0.74:
                parts.append(f"<h{(n := r.randint(2, 4))}>{self.words(1, 7)}</h{n}>")
            elif k < 0.79:
                tag = r.choice(["ul", "ol"])
                parts.append(f"<{tag}>" + "".join(f"<li>{self.words(2, 16)}{r.choice(['', '.'])}</li>" for _ in range(r.randint(2, 6))) + f"</{tag}>")
            elif k < 0.83:
                parts.append(f"<blockquote>{r.choice([self.prose(1, 3), '<p>' + self.prose(1, 3) + '</p>'])}</blockquote>")
            elif k < 0.86:
                parts.append("<table>" + "".join(f"<tr><td>{self.words(1, 3)}<td>{self.words(1, 3)}</tr>" for _ in range(r.randint(2, 4))) + "</table>")
            elif k < 0.88:
                parts.append(f"<pre>{self.words(4, 20)}</pre>")
            elif k < 0.9:
                parts.append(f"<figure><img src='x.png'><figcaption>{self.words(3, 12)}.</figcaption></figure>")
            elif k < 0.93:
                parts.append(f"<div>{self.prose()}</div>")
            elif k < 0.96:
                parts.append(f"<p>{' | '.join(self.words(1, 1) for _ in range(r.randint(6, 40)))}</p>")
            else:
                parts.append(self.junk(r.choice(["ad", "ad", "share", "form", "form", "aside", "notice", "comments"])))
        title = f"<h1>{self.words(1, 12)}{r.choice(['', '.'])}</h1>" if r.random() < 0.85 or not parts else ""
        if title and r.random() < 0.15:
            title = f"<header>{title}</header>"
        tail = self.junk(r.choice(["comments", "share", "aside"])) if r.random() < 0.15 else ""
        return title + "".join(parts) + tail

    def page(self) -> str:
        r = self.r
        some = lambda kind, p: self.junk(kind) if r.random() < p else ""
        if r.random() < 0.05:  # a bare text without any layout, which is all content
            bare = r.choice([self.prose(2, 9), "".join(f"<p>{self.paragraph()}</p>" for _ in range(r.randint(1, 6))), f"<h1>{self.words(2, 7)}</h1>" + "".join(f"<p>{self.prose(1, 6)}</p>" for _ in range(r.randint(1, 6)))])
            return r.choice(["{}", "<div>{}</div>", "<html><body>{}</body></html>", "<html><head><title>x</title></head><body>{}</body></html>"]).format(bare)
        tag = r.choice(["article", "article", "article", "main", "div", "div", "section", "td"])
        if tag == "article" and r.random() < 0.6:
            main = f'<article data-y="1">{self.content()}</article>'
        elif tag == "td":
            menu = " ".join(self.link(self.words(1, 2)) + r.choice(["", "<br>"]) for _ in range(r.randint(2, 8)))
            main = f'<table><tr>{self.wrap("td", menu, self.JUNK["nav"], 0)}{self.wrap("td", self.content(), self.CONTENT, 1)}</tr></table>'
        elif r.random() < 0.25:  # names that say nothing
            inner = self.content()
            for _ in range(r.randint(0, 2)):
                inner = f'<div class="{self.word()}">{inner}</div>'
            main = f'<{tag} class="{self.word()}" data-y="1">{inner}</{tag}>'
        else:
            main = self.wrap(tag, self.content(), self.CONTENT, 1)
        for _ in range(r.choice([0, 0, 1, 2])):
            main = self.wrap(r.choice(["div", "main", "section"]), some("ad", 0.1) + some("aside", 0.15) + main + some("comments", 0.25) + some("aside", 0.2), ["wrap", "container", "main", "layout", "page", "row", "inner", "grid", "content", "column"])
        before = some("notice", 0.3) + some("header", 0.4) + some("nav", 0.7) + some("form", 0.12) + some("ad", 0.45) + some("notice", 0.1)
        after = some("comments", 0.2) + some("ad", 0.15) + some("aside", 0.25) + some("form", 0.15) + some("notice", 0.1) + some("footer", 0.85)
        head = f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><script>x('</p>')</script></head>" if r.random() < 0.85 else ""
        return f"{head}<body>{before}<!-- {self.word()} -->{main}{after}</body></html>"


@lru_cache(maxsize=1)
def default_model(pages: int = 1500, seed: int = 11) -> DomModel:
    """Fitted on ``PageMaker`` pages: the corpus has no labelled ones."""
    maker = PageMaker(seed)
    return fit([maker.page() for _ in range(pages)])


def main_text(page: str, model: DomModel, threshold: float = 0.5) -> str:
    """Blocks whose marginal reaches ``threshold``; a page without such blocks has no main text."""
    tree = parse(page)
    blocks = [(t, p) for t, p in zip(tree.text, model.marginals(tree), strict=True) if t is not None]
    return "\n\n".join(t for t, p in blocks if p >= threshold)


def extract(pages: DataFrame, model: DomModel | None = None, *, html_column: str = "html", threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """Add text (blocks of content joined by an empty line) and n_chars (its code points).

    A null or empty page, or one without content, gives an empty text.  White space within a block is one
    blank, line breaks too; nothing else is dropped or cut.  A very long page is read whole, in time linear in
    its length whatever it holds; blocks with equal marginals fare alike.  Repeated pages each get their row, an
    empty table stays empty; other columns are carried, those named like a new one replaced.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or default_model())

    def make():
        model = shared.value

        def run(raws: list[bytes | None]) -> list[list]:
            texts = [main_text((raw or b"").decode(), model, threshold) for raw in raws]
            return [texts, [len(t) for t in texts]]

        return run

    return map_text(pages, html_column, T.StructType.fromDDL("text string, n_chars long"), make, keep)
