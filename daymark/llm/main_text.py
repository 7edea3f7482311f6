"""Main text of web pages by a tree-structured graphical model.

Every element of a page is a variable, content or not. Its own potential is a logistic
model of what the element is and holds; an edge potential ties it to its parent, by
the kind of element. Sum-product messages passed up and down the tree
give the exact marginals, and text belongs to the article where its element's
marginal exceeds one half. Both potentials are learned from labelled pages.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from daymark.llm.batches import extend, received, send
from daymark.llm.dom import INLINE, Node, blocks, parse

_GROUPS = {
    **dict.fromkeys(("article", "main"), "article"),
    **dict.fromkeys(("nav", "menu"), "nav"),
    **dict.fromkeys(("header", "footer", "aside", "form", "body", "head", "section", "div", "p", "a", "li", "button", "address"), None),
    **dict.fromkeys(("h1", "h2", "h3", "h4", "h5", "h6"), "heading"),
    **dict.fromkeys(("ul", "ol", "dl"), "list"),
    **dict.fromkeys(("table", "thead", "tbody", "tr", "caption"), "table"),
    **dict.fromkeys(("td", "th"), "cell"),  # of a table, or of a page laid out as one
    **dict.fromkeys(("blockquote", "pre", "figure", "figcaption", "dd", "dt"), "quote"),
    **dict.fromkeys(("input", "select", "option", "fieldset", "legend", "textarea", "dialog"), "form"),
    **dict.fromkeys(("script", "style", "title", "link", "meta", "template", "noscript", "iframe", "svg"), "head"),
}
# What class names, ids and roles say.
GOOD = frozenset("article content post entry main story body text prose page blogpost articlebody maincontent".split())
BAD = frozenset(
    "nav navbar menu navigation header masthead footer sidebar aside widget ad ads advert advertisement sponsor sponsored promo "
    "banner cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login form search share "
    "social comment comments reply replies disqus respond related recommended breadcrumb breadcrumbs pager pagination "
    "copyright complementary contentinfo toolbar tags meta teaser".split()
)
_NAME = re.compile(r"[A-Za-z][a-z]+|[A-Z]+|[a-z]+")


def group(tag: str) -> str:
    if tag in _GROUPS:
        return _GROUPS[tag] or tag
    return "inline" if tag in INLINE else "other"


def relation(nodes: list[Node], node: Node) -> str:
    """What an edge potential depends on: the kind of element, and whether it lies in the body itself."""
    top = node.parent >= 0 and nodes[node.parent].tag in ("body", "html", "#root")
    return f"top {group(node.tag)}" if top else group(node.tag)


def _names(node: Node) -> set[str]:
    stated = " ".join(node.attributes.get(k, "") for k in ("class", "id", "role"))
    return {x.lower() for x in _NAME.findall(stated)} if stated.strip() else set()


def describe(nodes: list[Node], pieces: list[tuple[int, str | None]]) -> list[list[str]]:
    """What the model sees of every node."""
    n = len(nodes)
    own, size, linked, stops, paragraphs = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    for node, text in pieces:
        if text:
            own[node] += len(text.strip())
            stops[node] += text.count(". ") + text.count("。") + (text.rstrip()[-1:] in ".!?…")
    for k in range(n - 1, 0, -1):
        size[k] += own[k]
        if nodes[k].tag == "a":
            linked[k] = size[k]
        up = nodes[k].parent
        paragraphs[up] += paragraphs[k] + (nodes[k].tag == "p")
        for total in (size, linked, stops):
            total[up] += total[k]
    out = []
    for k, node in enumerate(nodes):
        kind, names = group(node.tag), _names(node)
        seen = ["one", f"is {kind}"]
        bad, good = not names.isdisjoint(BAD), not names.isdisjoint(GOOD)
        seen += ["named bad"] * bad + ["named good"] * (good and not bad)
        if "hidden" in node.attributes or "display:none" in node.attributes.get("style", "").replace(" ", ""):
            seen.append("hidden")
        if kind == "inline":  # goes with what it stands in
            out.append(seen)
            continue
        density = linked[k] / size[k] if size[k] else 0.0
        # A paragraph that is a link says little about the article around it.
        about = "p links" if kind == "p" else "links"
        seen.append("no text" if not size[k] else f"{about} {min(3, int(4 * density))}")
        if kind in ("div", "section", "cell"):
            seen += [f"{kind} size {min(5, len(str(size[k])))}", f"{kind} stops {min(3, stops[k])}"]
            seen.append(f"{kind} paragraphs {min(3, paragraphs[k])}")
        out.append(seen)
    return out


class Potentials:
    """Learned: a weight per feature, and how a kind of element agrees with its parent."""

    def __init__(self, weights: dict[str, float], edges: dict[str, list[float]]):
        self.weights, self.edges = weights, edges

    def marginals(self, nodes: list[Node], seen: list[list[str]]) -> list[float]:
        """The probability of content of every node, by messages up and down the tree.

        Potentials and messages are ratios of content to not content.
        """
        weight, even = self.weights, [1.0, 1.0, 1.0, 1.0]
        n = len(nodes)
        local = [1.0] * n
        for k in range(n):
            total = sum(weight.get(f, 0.0) for f in seen[k])
            local[k] = np.e ** max(-12.0, min(12.0, total))
        edge = [self.edges.get(relation(nodes, node), even) for node in nodes]
        belief, up = local[:], [1.0] * n
        for k in range(n - 1, 0, -1):
            # edge: (parent, child) = (0,0), (0,1), (1,0), (1,1)
            e, b = edge[k], belief[k]
            up[k] = (e[2] + e[3] * b) / (e[0] + e[1] * b)
            belief[nodes[k].parent] = min(1e30, max(1e-30, belief[nodes[k].parent] * up[k]))
        for k in range(1, n):
            e = edge[k]
            parent = belief[nodes[k].parent] / up[k]
            down = (e[1] + e[3] * parent) / (e[0] + e[2] * parent)
            belief[k] = min(1e30, max(1e-30, belief[k] * down))
        return [b / (1 + b) for b in belief]


def train(pages: list[str], ridge: float = 0.5, pull: float = 2.0) -> Potentials:
    """Potentials from pages whose elements carry data-main="1" (content below) or "0" (none)."""
    rows, labels, ties = [], [], {}
    for page in pages:
        nodes, pieces = parse(page)
        label = [False] * len(nodes)
        for k, node in enumerate(nodes[1:], 1):
            stated = node.attributes.get("data-main")
            label[k] = stated == "1" if stated else label[node.parent]
            # Counts of (parent, child) labels by relation.
            counts = ties.setdefault(relation(nodes, node), np.zeros((2, 2)))
            counts[int(label[node.parent]), int(label[k])] += 1
        rows += describe(nodes, pieces)
        labels += label
    names = sorted({f for r in rows for f in r})
    place = {f: k for k, f in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for k, r in enumerate(rows):
        x[k, [place[f] for f in r]] = 1
    y, beta = np.array(labels, float), np.zeros(len(names))
    small = ridge * np.eye(len(names))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + small, x.T @ (y - p) - small @ beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    edges = {}
    for kind, counts in ties.items():
        # How much more often two labels meet than by chance, drawn towards chance by `pull` pairs.
        chance = np.outer(counts.sum(axis=1) + 0.5, counts.sum(axis=0) + 0.5) / (counts.sum() + 1)
        edges[kind] = ((counts + pull * chance / chance.sum()) / (chance * (1 + pull / chance.sum()))).ravel().tolist()
    return Potentials(dict(zip(names, beta.tolist())), edges)


SOUP = 140


@cache
def labelled_pages() -> tuple[str, ...]:
    """Labelled pages made by rule: each way to mark up an article, among each kind of surroundings."""
    rng = np.random.default_rng(11)

    def words(n: int) -> str:
        return " ".join("".join(rng.choice(list("aeionrstl"), rng.integers(2, 9))) for _ in range(n))

    def sentences(n: int) -> str:
        return " ".join(words(int(rng.integers(5, 16))).capitalize() + "." for _ in range(n))

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{words(1)}">{words(int(rng.integers(1, 4)))}</a></li>' for _ in range(n)) + "</ul>"

    hosts = (
        ("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div id="main-content">', "</div>"),
        ('<div class="post-body">', "</div>"), ('<section class="entry">', "</section>"), ("<div>", "</div>"), ("<main><article>", "</article></main>"),
        ("", ""), ("", ""),
    )
    extras = (
        lambda: f"<header><h2>{words(3)}</h2><p>{words(6)}</p></header>",
        lambda: f'<div class="header"><a href="/">{words(2)}</a></div>',
        lambda: f"<aside><h3>{words(2)}</h3>{links(4)}</aside>",
        lambda: f'<div class="sidebar"><p>{sentences(1)}</p>{links(3)}</div>',
        lambda: f'<div class="ad">{sentences(2)}</div>',
        lambda: f'<div class="ad-banner"><p>{sentences(3)}</p></div>',
        lambda: f'<div class="cookie-notice"><p>{sentences(2)}</p><button>{words(1)}</button></div>',
        lambda: f'<div class="newsletter"><form><p>{sentences(1)}</p><input name="e"><button>{words(1)}</button></form></div>',
        lambda: f"<form><label>{words(2)}</label><input><select><option>{words(1)}</option></select></form>",
        lambda: f'<section class="comments"><h3>{words(1)}</h3><div class="comment"><p>{sentences(3)}</p></div><div class="comment"><b>{words(1)}</b><p>{sentences(2)}</p></div></section>',
        lambda: f'<div id="comments"><ol><li><p>{sentences(2)}</p></li><li><p>{sentences(3)}</p></li></ol></div>',
        lambda: f'<div class="related"><h3>{words(2)}</h3>{links(3)}</div>',
        lambda: f'<div class="share">{links(3)}</div>',
    )

    def plain(n: int) -> str:
        """A paragraph of any look: sentences, a few words, a list on one line, capitals."""
        look = int(rng.integers(0, 8))
        if look < 4:
            return sentences(n)
        if look == 4:
            return words(int(rng.integers(1, 4)))
        if look == 5:
            return str(rng.choice([" | ", " - ", ", ", "%%% "])).join(words(1) for _ in range(4 * n))
        return words(8 * n).upper() + "!" if look == 6 else words(12 * n)

    def article(rich: bool) -> str:
        parts = [f"<h1>{words(6)}</h1>"]
        for _ in range(int(rng.integers(2, 18))):
            kind = int(rng.integers(0, 9)) if rich else 0
            parts.append(
                {
                    4: lambda: f"<h2>{words(4)}</h2>",
                    5: lambda: f"<ul><li>{sentences(1)}</li><li>{sentences(1)}</li></ul>",
                    6: lambda: f"<blockquote><p>{sentences(2)}</p></blockquote>",
                    7: lambda: f"<table><tr><th>{words(1)}</th><td>{words(2)}</td></tr></table>",
                    8: lambda: f"<figure><figcaption>{words(5)}</figcaption></figure>",
                    3: lambda: f"<p><b>{words(3)}</b> {sentences(3)} <a href=/x>{words(2)}</a> {sentences(1)}</p>",
                }.get(kind, lambda: f"<p>{plain(int(rng.integers(1, 7)))}</p>")()
            )
        return "".join(parts)

    def soup(k: int) -> str:
        """An article of paragraphs that are links, of divs, of lines in one div, or under its own header."""
        text = lambda: sentences(int(rng.integers(1, 6)))
        several = range(int(rng.integers(2, 9)))
        heading = f"<h1>{words(5)}</h1>"
        return (
            lambda: heading + "".join(f"<p>{text()}</p>" if rng.random() < 0.7 else f"<p><a href=/{words(1)}>{words(4)}</a></p>" for _ in several),
            lambda: "".join(f"<div>{text()}</div>" for _ in several),
            lambda: "".join(f"<div><div>{text()}</div><div>{text()}</div></div>" for _ in several),
            lambda: "<br><br>".join(text() for _ in several),
            lambda: f"<header>{heading}<p>{words(6)}</p></header>" + "".join(f"<p>{text()}</p>" for _ in several),
        )[k % 5]()

    def page(k: int) -> str:
        inside, menu = soup(k), links(int(rng.integers(3, 7)))
        edge = extras[int(rng.integers(0, len(extras)))]()
        host = ("<div>{}</div>", "<div><div>{}</div></div>", "<article>{}</article>", '<div class="content">{}</div>', "<main>{}</main>")[k // 5 % 5]
        body = f"<nav>{menu}</nav>" + host.replace(">", ' data-main="1">', 1).format(inside) + edge
        if k % 7 == 6:  # laid out as a table
            body = f'<table><tr><td data-main="0">{menu}</td><td data-main="1">{inside}</td></tr></table>'
        return f"<html><body>{body}<footer>&copy; {words(3)}</footer></body></html>"

    pages = []
    for k in range(180):
        before, after = hosts[k % len(hosts)]
        around = [f'<div data-main="0">{extras[int(e)]()}</div>' if rng.random() < 0.2 else extras[int(e)]() for e in rng.permutation(len(extras))[: k % 6]]
        cut = int(rng.integers(0, len(around) + 1))
        host = before.replace(">", ' data-main="1">', 1)
        inside = article(k % 3 > 0)
        if not host:  # the parts lie in the body itself
            inside = re.sub(r"<(h1|h2|p|ul|blockquote|table|figure)>(?=(?:(?!</\1>).)*</\1>)", r'<\1 data-main="1">', inside)
        elif k % 4 == 3:  # a box within the article that is not part of it
            box = extras[int(rng.integers(4, len(extras)))]()
            inside += re.sub(r"<(\w+)", r'<\1 data-main="0"', box, count=1)
        pages.append(
            f"<html><head><title>{words(5)}</title><style>p{{}}</style></head><body><nav>{links(int(rng.integers(2, 8)))}</nav>"
            + "".join(around[:cut]) + host + inside + after + "".join(around[cut:])
            + f"<footer>&copy; {words(3)} <p>{sentences(2)}</p></footer></body></html>"
        )
    return (*pages, *(page(k) for k in range(SOUP)))


def extract(html: str | None, potentials: Potentials) -> str:
    """The article of one page; empty if nothing of it is content."""
    if not html:
        return ""
    nodes, pieces = parse(html)
    if len(nodes) == 1:  # text without any markup
        return blocks(pieces, [True])
    marginals = potentials.marginals(nodes, describe(nodes, pieces))
    return blocks(pieces, [m > 0.5 for m in marginals])


def main_text(pages: DataFrame, labelled: tuple[str, ...] | None = None, keep: list[str] | None = None) -> DataFrame:
    """`row` (the `keep` columns of pages) and `text` of every page (column html).

    Null and empty pages, and pages without content, have an empty text; a page without
    a single element is its own text. Pages cut off
    inside a tag lose that tag only. Repeated rows are read one by one; empty tables
    give no rows. `labelled` are training pages as `train` takes them.
    """
    learned = train(list(labelled or labelled_pages()))
    shared = send(pages.sparkSession, learned)  # some hundred numbers

    def start() -> Callable:
        potentials = received(shared)

        def compute(rows: pa.StructArray):
            return [pa.array([extract(h.as_py(), potentials) for h in rows.field("html")], pa.string())]

        return compute

    kept = list(pages.columns if keep is None else keep)
    return extend(pages.select(*dict.fromkeys([*kept, "html"])), start, "text string", kept)


def text_report(pages: DataFrame) -> DataFrame:
    found = main_text(pages, keep=["page_id", "url"])
    return found.selectExpr("row.page_id", "row.url", "text", "cast(length(text) as long) AS n_chars")
