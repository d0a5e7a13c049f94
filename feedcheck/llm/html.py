"""Main text of web pages by a tree-structured graphical model over the DOM."""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedcheck.llm.common import record_batches, small_batches

#: Fixed value: elements that stand in a line of text.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Fixed value: elements without content.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Fixed value: elements whose text is never shown as text of the page.
HIDDEN = set("script style head title noscript template iframe object svg canvas select option textarea button audio video".split())
#: Fixed value: a start of the key ends an open element of the values.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: An element of the key's row is not ended from within one of these.
SCOPE = {"ul", "ol", "dl", "table", "div", "section", "article", "body"}
LEAVES = set("p h1 h2 h3 h4 h5 h6 li td th dt dd blockquote pre figcaption caption address".split())

#: Pages of the sample that teaches, bytes below which a page is taken for it, and rounds of training.
SAMPLE_PAGES, SAMPLE_BYTES, ROUNDS = 200, 1 << 18, 12


@dataclass
class Node:
    tag: str
    parent: int
    names: list[str] = field(default_factory=list)
    label: int | None = None
    chars: int = 0
    linked: int = 0
    stops: int = 0


class Dom(HTMLParser):
    """Block elements of a page as a list in page order, and its pieces of text: (node, text), where
    each start or end of a block element begins a new piece. Cut-off and unbalanced pages are read as far as they go."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("#page", -1)]
        self.pieces: list[tuple[int, list[str]]] = []
        self.stack: list[tuple[str, int]] = [("#page", 0)]
        self.open_tags: dict[str, int] = {}
        self.hidden = self.links = 0
        self.fresh = True
        self.feed(html)
        self.close()
        self._sum()

    def _push(self, tag: str, node: int) -> None:
        self.stack.append((tag, node))
        self.open_tags[tag] = self.open_tags.get(tag, 0) + 1
        self.hidden += tag in HIDDEN
        self.links += tag == "a"

    def _pop(self) -> None:
        tag = self.stack.pop()[0]
        self.open_tags[tag] -= 1
        self.hidden -= tag in HIDDEN
        self.links -= tag == "a"
        self.fresh |= tag not in INLINE

    def _end(self, tags: set[str], scope: set[str]) -> None:
        """End the nearest open element of ``tags``, unless one of ``scope`` is nearer."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in tags:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i][0] in scope:
                return

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            if tag != "hr" and self.open_tags.get("p"):
                self._end({"p"}, SCOPE)
            if any(self.open_tags.get(t) for t in ENDS.get(tag, ())):
                self._end(ENDS[tag], SCOPE)
            self.fresh = True
        if tag == "body" and self.hidden:  # a head that was not ended
            while self.hidden:
                self._pop()
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        node = self.stack[-1][1]
        if tag not in INLINE:
            found = dict(attrs)
            names = [n for a in ("class", "id", "role") for n in re.split(r"[^a-z0-9]+", (found.get(a) or "").lower()) if n]
            self.nodes.append(Node(tag, node, names, int(found["data-main"]) if (found.get("data-main") or "") in ("0", "1") else None))
            node = len(self.nodes) - 1
        self._push(tag, node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack[-1][0] == tag:
            self._pop()

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.fresh = True
        if self.open_tags.get(tag):
            self._end({tag}, set())

    def handle_data(self, data):
        if self.hidden:
            return
        at = self.stack[-1][1]
        if self.fresh or not self.pieces or self.pieces[-1][0] != at:
            self.pieces.append((at, []))
            self.fresh = False
        self.pieces[-1][1].append(data)
        n = len(data.strip())
        if n:
            node = self.nodes[at]
            node.chars += n
            node.linked += n * bool(self.links)
            node.stops += len(re.findall(r"[.!?…。](?=\s|$)", data))

    def unknown_decl(self, data):
        pass

    def _sum(self) -> None:
        for node in reversed(self.nodes[1:]):
            up = self.nodes[node.parent]
            up.chars, up.linked, up.stops = up.chars + node.chars, up.linked + node.linked, up.stops + node.stops

    def blocks(self, content) -> Iterator[str]:
        """Text of each piece whose node is ``content``, white space as one space."""
        for at, parts in self.pieces:
            text = " ".join("".join(parts).split())
            if text and content(at):
                yield text


def features(node: Node) -> list[str]:
    size = node.chars
    link = node.linked / size if size else 0
    found = [f"tag {node.tag}", f"size {min(6, int(math.log2(size / 12 + 1)))}", f"links {int(link * 4)}", f"stops {min(3, node.stops)}", "any"]
    found += [f"name {n}" for n in node.names]
    if node.chars:
        found.append(f"dense {min(4, int(100 * node.stops / size))} {node.tag in LEAVES}")
    return found


def _add(a: float, b: float) -> float:
    """Logarithm of a sum of two numbers given by their logarithms."""
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


class TreeModel:
    """Labels content (1) and other (0) for each node; potentials of a node are weights of its
    features, those between parent and child depend on both labels and whether the child is a leaf-like block."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.between = [[[0.5, -0.5], [-0.5, 0.5]], [[0.5, -0.5], [-0.5, 0.5]]]

    def marginals(self, nodes: list[Node], found: list[list[str]]) -> tuple[list[float], list]:
        """Probability of content of each node, and of each pair of labels of parent and child:
        messages go up the tree and down again."""
        n = len(nodes)
        kind = [int(x.tag in LEAVES) for x in nodes]
        on = [sum(self.weights.get(f, 0.0) for f in fs) for fs in found]
        off = [0.0] * n
        up = [(0.0, 0.0)] * n
        for i in range(n - 1, 0, -1):
            b = self.between[kind[i]]
            up[i] = (_add(b[0][0] + off[i], b[0][1] + on[i]), _add(b[1][0] + off[i], b[1][1] + on[i]))
            p = nodes[i].parent
            off[p] += up[i][0]
            on[p] += up[i][1]
        full_off, full_on = off[:], on[:]
        pairs = [None] * n
        for i in range(1, n):
            p, b = nodes[i].parent, self.between[kind[i]]
            rest = (full_off[p] - up[i][0], full_on[p] - up[i][1])
            pairs[i] = [[b[x][y] + rest[x] + (off[i], on[i])[y] for y in (0, 1)] for x in (0, 1)]
            full_off[i] = off[i] + _add(b[0][0] + rest[0], b[1][0] + rest[1])
            full_on[i] = on[i] + _add(b[0][1] + rest[0], b[1][1] + rest[1])
        p1 = [1 / (1 + math.exp(max(-500.0, min(500.0, a - b)))) for a, b in zip(full_off, full_on)]
        return p1, pairs

    def train(self, pages: list[tuple[list[Node], list[int]]], rounds: int = ROUNDS, rate: float = 0.15, seed: int = 5) -> None:
        """Climb the likelihood of the labels: what is observed less what the model expects. A third of
        the features is hidden at each step, so that no single one decides."""
        rng = random.Random(seed)
        made = [[features(x) for x in nodes] for nodes, _ in pages]
        for r in range(rounds):
            step = rate / (1 + 0.2 * r)
            for k in rng.sample(range(len(pages)), len(pages)):
                nodes, labels = pages[k]
                gone = {f for fs in made[k] for f in fs if f != "any" and rng.random() < 0.33}
                found = [[f for f in fs if f not in gone] for fs in made[k]]
                p1, pairs = self.marginals(nodes, found)
                for i, fs in enumerate(found):
                    miss = labels[i] - p1[i]
                    if abs(miss) > 1e-3:
                        for f in fs:
                            self.weights[f] = self.weights.get(f, 0.0) + step * (miss - 0.002 * self.weights.get(f, 0.0))
                for i in range(1, len(nodes)):
                    b, top = self.between[int(nodes[i].tag in LEAVES)], max(map(max, pairs[i]))
                    e = [[math.exp(v - top) for v in row] for row in pairs[i]]
                    total = sum(map(sum, e))
                    for x in (0, 1):
                        for y in (0, 1):
                            b[x][y] += step * 0.1 * ((labels[nodes[i].parent] == x and labels[i] == y) - e[x][y] / total)


def page_text(model: TreeModel, html: str | None) -> str:
    """Blocks of main text, joined by line breaks; empty if there is none."""
    if not html:
        return ""
    dom = Dom(html)
    p1, _ = model.marginals(dom.nodes, [features(x) for x in dom.nodes])
    return "\n".join(dom.blocks(lambda i: p1[i] > 0.5))


def labels_of(dom: Dom, is_main) -> list[int]:
    """Labels by marked elements: a node is content if it or its nearest marked ancestor is main; one
    above them if most of its text is."""
    marks = [is_main(x) for x in dom.nodes]
    labels = [0] * len(dom.nodes)
    for i, node in enumerate(dom.nodes):
        labels[i] = marks[i] if marks[i] is not None else labels[node.parent] if node.parent >= 0 else 0
    inside = [0] * len(dom.nodes)
    for at, parts in dom.pieces:
        if labels[at]:
            inside[at] += len("".join(parts).strip())
    for i in range(len(dom.nodes) - 1, 0, -1):
        inside[dom.nodes[i].parent] += inside[i]
    return [int(l or (m is None and x.chars > 0 and 2 * s > x.chars)) for l, m, x, s in zip(labels, marks, dom.nodes, inside)]


#: Labelled layouts: what holds the text, and what surrounds it.
MAIN = ["article", "main", 'section class="content"', 'div id="content"', 'div class="post-body"', 'div class="entry article-text"', 'div class="story"', "div"]
LISTS = ["nav", 'div class="menu"', 'ul class="nav navbar"', 'div class="breadcrumb"', 'div role="navigation"', 'aside class="sidebar"', 'div class="related links"', 'div id="sidebar"', 'div class="share social"', 'div class="tags"']
LINES = ["header", 'div id="header"', 'div class="banner top"', "footer", 'div class="footer copyright"', 'div class="cookie notice"', 'div class="notice alert"', 'div class="ad"', 'div class="advert sponsored"', 'div class="promo newsletter"', "aside", "form", 'form class="search subscribe"', 'div role="banner"', 'div role="contentinfo"', 'div class="popup modal consent"']
TALK = ["section", "div", "ol"]
TALK_NAMES = ["comments", "comment-list", "replies discussion", "reader responses comment"]


def layouts(n: int = 240, seed: int = 17) -> list[str]:
    """Labelled pages: every layout drawn from the lists above, filled with invented words."""
    rng = random.Random(seed)

    def words(k):
        return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(k))

    def sentences(k):
        return " ".join(words(rng.randint(4, 16)).capitalize() + rng.choice("...?!") for _ in range(k))

    def links(tag):
        kind = rng.choice(["ul", "p"])
        item = "<li><a href='/x'>%s</a></li>" if kind == "ul" else "<a href='/x'>%s</a> "
        return f"<{tag}><{kind}>" + "".join(item % words(rng.randint(1, 4)) for _ in range(rng.randint(2, 9))) + f"</{kind}></{tag.split()[0]}>"

    def line(tag):
        inner = rng.choice(["%s", "<p>%s</p>", "<div>%s</div>", "<p>%s <a href='/y'>" + words(2) + "</a></p>"]) % rng.choice([words(rng.randint(2, 9)), sentences(1), sentences(2), "&copy; 2020 " + sentences(1)])
        return f"<{tag}>{inner}" + ("<input name=q>" if tag.startswith("form") else "") + f"</{tag.split()[0]}>"

    def talk():
        tag, name = rng.choice(TALK), rng.choice(TALK_NAMES)
        item = rng.choice(["<div class='comment'><b>%s</b><p>%s</p></div>", "<li class='comment reply'>%s <p>%s</p></li>"])
        return f"<{tag} {rng.choice(['id', 'class'])}='{name}' data-main='0'><h3>{words(2)}</h3>" + "".join(item % (words(1), sentences(rng.randint(1, 4))) for _ in range(rng.randint(1, 5))) + f"</{tag}>"

    def noise(k):
        return "".join(rng.choice([lambda: links(rng.choice(LISTS)), lambda: line(rng.choice(LINES))])() for _ in range(k))

    pages = []
    for _ in range(n):
        main = rng.choice(MAIN)
        blocks = [f"<h1>{words(rng.randint(3, 9))}</h1>"] if rng.random() < 0.8 else []
        for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 12])):
            text = sentences(rng.choice([1, 1, 2, 4, 8]))
            if rng.random() < 0.15:
                text = words(rng.randint(1, 12))
            if rng.random() < 0.2:
                text = f"{text} <a href='/z'>{words(2)}</a> {sentences(1)}"
            blocks.append(rng.choice(["<p>%s</p>"] * 7 + ["<h2>%s</h2>", "<blockquote>%s</blockquote>", "<ul><li>%s</li></ul>", "<pre>%s</pre>", "<p><b>%s<br><p></p>", "<div>%s</div>", "<table><tr><td>%s</td></tr></table>"]) % text)
        inner = [f"<div class='ad' data-main='0'>{sentences(1)}</div>"] if rng.random() < 0.15 else []
        at = rng.randint(0, len(blocks))
        body = f"<{main} data-main='1'>" + "".join(blocks[:at] + inner + blocks[at:]) + f"</{main.split()[0]}>"
        page = noise(rng.randint(1, 4)) + body + (talk() if rng.random() < 0.4 else "") + noise(rng.randint(0, 3))
        if rng.random() < 0.4:
            page = f"<div class='{rng.choice(['wrapper', 'container', 'page', 'row'])}'>{page}</div>"
        pages.append(f"<html><head><title>{words(4)}</title></head><body>{page}</body></html>")
    return pages


def fit(pages: DataFrame | None = None, sample_pages: int = SAMPLE_PAGES, sample_bytes: int = SAMPLE_BYTES) -> TreeModel:
    """Train on the labelled layouts and on about ``sample_pages`` of ``pages`` (``html``) that state
    themselves where their article is: those with an ``article`` or ``main`` element, chosen by a hash
    among those of less than ``sample_bytes``, as the driver holds them."""
    known: list[tuple[list[Node], list[int]]] = []
    for html in layouts():
        dom = Dom(html)
        known.append((dom.nodes, labels_of(dom, lambda x: x.label)))
    if pages is not None:
        marked = pages.select("html").filter(F.col("html").rlike(r"(?i)<(article|main)[\s>]") & (F.octet_length("html") < sample_bytes))
        n = marked.count()
        if n:
            chosen = marked.filter(F.pmod(F.xxhash64("html"), F.lit(1 << 20)) < min(1 << 20, -(-(sample_pages << 20) // n)))
            for r in chosen.orderBy(F.xxhash64("html"), "html").limit(sample_pages).collect():
                dom = Dom(r.html)
                known.append((dom.nodes, labels_of(dom, lambda x: {"article": 1, "main": 1, "nav": 0, "aside": 0, "footer": 0, "form": 0}.get(x.tag))))
    model = TreeModel()
    model.train(known)
    return model


_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def main_texts(pages: DataFrame, model: TreeModel) -> DataFrame:
    """One row per row of ``pages`` (``page_id``, ``url``, ``html``): page_id, url, text, n_chars (code points).

    The whole page is read; nothing is shuffled, and the model travels with the task. A null or
    empty page, or one without main text, has the empty text. Character references are
    decoded, white space within a block is one space, blocks are joined by a line break.
    Repeated rows, null ids and other columns do no harm; an empty table gives no rows.
    """
    small_batches(pages.sparkSession)

    def rows(batches):
        for batch in batches:
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                text = page_text(model, html)
                yield page_id, url, text, len(text)

    read = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.col("html"))
    return read.mapInArrow(lambda b: record_batches(rows(b), _TEXTS, 256), "page_id long, url string, text string, n_chars long")
