"""HTML extraction: boosted trees over DOM nodes, and a decoding that keeps the tree consistent.

A page becomes a tree of block elements whose leaves are runs of text. Each node gets features: its tag,
the families its attribute tokens belong to (menu, advert, comment, ...), the same for its ancestors, its
depth, its place among its siblings and what they hold, and its subtree's text, link and tag density. Trees
give each node the probability of holding article text. The decoding picks, of all choices in which a kept
node has a kept parent, the most probable one: a node is either dropped with all below it, or kept with the
best choice for each child. So no text is kept inside a dropped menu, and none is lost to a contradiction.

There are no labels for pages, so the trees learn from composed pages: text blocks of a bounded sample of
pages, set into varied layouts (articles, menus, headers, footers, sidebars, notices, adverts, forms,
comments; with telling, neutral and missing attributes), where the place of each block says what it is.

Extraction is one pass over the pages without a shuffle; the model's size is bounded by its parameters.

Defined results: null and empty pages, and pages without an article, give an empty text; unclosed and stray
tags are taken as browsers take them in the usual cases; very long pages are read whole; repeated rows are
extracted each; a null page_id stays null; an empty table gives no rows; input columns travel in a struct,
so their names cannot clash.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safetylake.llm import boosting
from safetylake.llm.common import boxed, hash_sample

SAMPLE = 200  # pages whose text the composed pages are made of, about as many
SAMPLE_PIECES, PIECE = 40, 600  # pieces of one sampled page, chosen by a hash among all of it, and their characters
COMPOSED = 400  # composed pages the trees are fitted on

# Fixed values of HTML: elements without content, with raw text, that are blocks, and implied ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg select".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul button option label".split()
)
ENDS_P = BLOCKS - {"body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "button", "option", "label", "legend"}
SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

GROUPS = [
    "h1 h2 h3 h4 h5 h6", "p blockquote pre", "li dd dt", "ul ol dl menu", "table tbody thead tfoot tr td th", "nav", "header",
    "footer", "aside", "form fieldset label button option legend", "article", "main", "section div center", "figure figcaption",
]
GROUP_OF = {tag: i for i, tags in enumerate(GROUPS) for tag in tags.split()}
# Families of attribute tokens: parts of class, id and role values.
FAMILIES = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs pagination pager toc tabs",
    "advert": "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner adsense dfp outbrain taboola",
    "comment": "comment comments commentlist disqus reply replies respond discussion reviews guestbook",
    "side": "sidebar side aside widget widgets related recommended recommendations popular trending more teaser secondary complementary",
    "notice": "cookie cookies consent notice gdpr popup modal overlay alert dialog newsletter subscribe subscription paywall privacy",
    "form": "form login signin signup register search contact feedback poll",
    "frame": "header footer masthead foot head topbar bottom copyright contentinfo legal logo",
    "social": "share sharing social follow tags byline author meta",
    "content": "article content post entry story main text body page articlebody maincontent",
}
FAMILY_OF = {token: i for i, tokens in enumerate(FAMILIES.values()) for token in tokens.split()}
CONTENT = list(FAMILIES).index("content")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>", re.S
)
_ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("tag", "parent", "children", "families", "text", "links", "tags", "depth", "label")

    def __init__(self, tag: str, parent: Node | None, families: frozenset[int] = frozenset()):
        self.tag, self.parent, self.families = tag, parent, families
        self.children: list[Node] = []
        self.text = ""
        self.links = 0  # characters inside links
        self.tags = 0  # elements below, inline ones too
        self.depth = parent.depth + 1 if parent else 0
        self.label = 0
        if parent:
            parent.children.append(self)


def families_of(attributes: str) -> frozenset[int]:
    found = set()
    for m in _ATTRIBUTE.finditer(attributes):
        for part in _PART.findall(m[1] or m[2] or m[3] or ""):
            place = FAMILY_OF.get(part.lower())
            if place is not None:
                found.add(place)
    return frozenset(found)


def build(page: str) -> Node:
    """The tree of block elements; leaves have the tag ``#text``."""
    root = Node("#root", None)
    open_: list[tuple[str, Node | None]] = []  # (tag, its node, or None for inline elements)
    block = root
    run: list[str] = []
    run_links = 0
    in_links = 0

    def end_run() -> None:
        nonlocal run, run_links
        text = " ".join(entities.unescape("".join(run)).split()) if run else ""
        if text:
            leaf = Node("#text", block)
            leaf.text, leaf.links = text, min(run_links, len(text))
        run, run_links = [], 0

    def close(depth: int) -> None:
        nonlocal block, in_links
        for tag, node in reversed(open_[depth:]):
            if node is not None:
                end_run()
                block = node.parent
            elif tag == "a":
                in_links -= 1
        del open_[depth:]

    def close_last(tag: str, within: tuple[str, ...]) -> None:
        for i in range(len(open_) - 1, -1, -1):
            if open_[i][0] == tag:
                return close(i)
            if open_[i][0] in within:
                return None
        return None

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else len(page)
        if stop > at:
            piece = page[at:stop]
            run.append(piece)
            run_links += len(piece) if in_links else 0
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == tag:
                    close(i)
                    break
            continue
        block.tags += 1
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            run.append(" ")
            continue
        if tag in VOID:
            run.append(" ")
            if tag == "hr":
                end_run()
            continue
        if tag in ENDS_P:
            close_last("p", ("table", "td", "th", "button"))
        if tag in SAME:
            close_last(tag, SAME[tag])
            if tag in ("dt", "dd"):
                close_last("dd" if tag == "dt" else "dt", SAME[tag])
        if tag == "body":
            close_last("head", ())
        if m[3].endswith("/"):
            continue
        if tag in BLOCKS:
            end_run()
            block = Node(tag, block, families_of(m[3]))
            open_.append((tag, block))
        else:
            open_.append((tag, None))
            in_links += tag == "a"
    end_run()
    return root


def walk(root: Node) -> list[Node]:
    """All nodes, parents before children, leaves in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(reversed(node.children))
    return out


N_GROUPS, N_FAMILIES = len(GROUPS), len(FAMILIES)


def node_features(nodes: list[Node]) -> np.ndarray:
    """A row of features for each node of a page, in the order of walk()."""
    place = {id(n): i for i, n in enumerate(nodes)}
    size = len(nodes)
    chars, links, tags, leaves, words, stops, blocks = (np.zeros(size) for _ in range(7))
    for i in range(size - 1, -1, -1):
        n = nodes[i]
        if n.tag == "#text":
            chars[i], links[i], leaves[i] = len(n.text), n.links, 1
            words[i] = n.text.count(" ") + 1
            stops[i] = n.text.count(". ") + n.text.count(", ") + (n.text[-1] in ".!?")
        tags[i] += n.tags
        blocks[i] += n.tag in ("p", "h1", "h2", "h3", "blockquote")
        if n.parent is not None:
            up = place[id(n.parent)]
            for total in (chars, links, tags, leaves, words, stops, blocks):
                total[up] += total[i]
    everything = max(1.0, chars[0])
    groups = np.full(size, -1)
    above = np.zeros((size, N_GROUPS + N_FAMILIES))  # 1 / distance to the nearest such ancestor or self
    index, siblings, alike = np.zeros(size), np.zeros(size), np.zeros(size)
    for i, n in enumerate(nodes):
        groups[i] = GROUP_OF.get(n.tag, -1)
        if n.parent is not None:
            above[i] = above[place[id(n.parent)]] * (1.0 if n.tag == "#text" else 0.8)
        if groups[i] >= 0:
            above[i, groups[i]] = 1
        for f in n.families:
            above[i, N_GROUPS + f] = 1
        if n.children:
            count: dict[str, int] = {}
            for j, c in enumerate(n.children):
                k = place[id(c)]
                index[k], siblings[k] = j / len(n.children), len(n.children)
                count[c.tag] = count.get(c.tag, 0) + 1
            for c in n.children:
                alike[place[id(c)]] = count[c.tag] / len(n.children)
    up = np.array([place[id(n.parent)] if n.parent is not None else 0 for n in nodes])
    own = np.stack(
        [
            np.array([n.tag == "#text" for n in nodes], dtype=float), np.array([n.depth for n in nodes], dtype=float), index,
            np.log1p(siblings), alike, np.log1p(chars), chars / everything, links / np.maximum(chars, 1),
            chars / (tags + 1), words / np.maximum(leaves, 1), stops / np.maximum(words, 1), np.log1p(leaves), blocks / (leaves + 1),
        ],
        axis=1,
    )
    return np.hstack([own, own[up][:, 5:], above])


def decode(nodes: list[Node], probability: np.ndarray) -> list[Node]:
    """The kept leaves of the most probable choice in which every kept node has a kept parent."""
    place = {id(n): i for i, n in enumerate(nodes)}
    p = np.clip(probability, 1e-6, 1 - 1e-6)
    keep, drop = np.log(p), np.log(1 - p)
    for i in range(len(nodes) - 1, 0, -1):
        up = place[id(nodes[i].parent)]
        keep[up] += max(keep[i], drop[i])
        drop[up] += drop[i]
    kept = np.zeros(len(nodes), dtype=bool)
    out = []
    for i, n in enumerate(nodes):
        kept[i] = keep[i] > drop[i] and (i == 0 or kept[place[id(n.parent)]])
        if kept[i] and n.tag == "#text":
            out.append(n)
    return out


# --- composed pages ------------------------------------------------------------------------------------

MARK = "\u0001"  # stands before article text in composed pages


def compose(draw: random.Random, texts: list[str]) -> str:
    """A page in a random layout; article text is marked."""

    def text(most: int | None = None) -> str:
        words = draw.choice(texts).split()
        words = words[: draw.randint(1, most)] if most else words
        return entities.escape(" ".join(words), quote=False)

    def named(tag: str, family: str, inner: str, sure: float = 0.8) -> str:
        """An element whose attributes tell its family, or say nothing."""
        token = draw.choice(FAMILIES[family].split())
        value = draw.choice([token, f"{token}-box", f"c1 {token}", f"site_{token}", token.capitalize(), f"{token}{draw.randint(1, 9)}"])
        kind = draw.choice(["class", "class", "id"])
        attribute = f' {kind}="{value}"' if draw.random() < sure else draw.choice(["", ' class="box"', ' id="x1"', ' style="a:b"'])
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{text(3)}</a></li>' for i in range(n)) + "</ul>"

    def paragraphs(n: int, tag: str = "p", most: int | None = None) -> str:
        return "".join(f"<{tag}>{text(most)}</{tag}>" for _ in range(n))

    def boilerplate(where: str) -> str:
        kind = draw.choice(
            ["menu", "advert", "side", "notice", "form", "social"] + (["comment", "frame"] if where == "page" else ["advert", "social"])
        )
        if kind == "menu":
            return draw.choice([f"<nav>{links(draw.randint(2, 8))}</nav>", named("div", "menu", links(draw.randint(2, 8))), named("nav", "menu", "".join(f"<a href='#'>{text(2)}</a> " for _ in range(4)))])
        if kind == "advert":
            return named(draw.choice(["div", "div", "aside", "section", "p"]), "advert", draw.choice([text(), text(12), f'<a href="/x">{text(8)}</a>']), 1.0)
        if kind == "side":
            return draw.choice([f"<aside>{paragraphs(draw.randint(1, 3))}</aside>", named("div", "side", paragraphs(draw.randint(1, 3)), 1.0), named("aside", "side", f"<h3>{text(4)}</h3>" + links(draw.randint(2, 6)))])
        if kind == "notice":
            return named(draw.choice(["div", "section", "dialog", "aside", "p"]), "notice", draw.choice([f"<p>{text()}</p><button>{text(2)}</button>", text(20)]), 1.0)
        if kind == "form":
            inner = f"<label>{text(3)}</label><input name='q'><button>{text(2)}</button>"
            return draw.choice([f"<form>{inner}</form>", f"<form>{paragraphs(1, most=12)}{inner}</form>", named("div", "form", f"<form>{inner}</form>")])
        if kind == "social":
            return named(draw.choice(["div", "ul", "p"]), "social", "".join(f"<a href='#'>{text(2)}</a> " for _ in range(draw.randint(2, 5))), 1.0)
        if kind == "comment":
            item = lambda: named(draw.choice(["div", "li", "article"]), "comment", paragraphs(draw.randint(1, 2)))
            return named(draw.choice(["section", "div", "ol"]), "comment", f"<h3>{text(3)}</h3>" + "".join(item() for _ in range(draw.randint(1, 4))), 1.0)
        return named("div", "frame", draw.choice([paragraphs(1), text(15), links(3)]), 1.0)

    def content() -> str:
        out = [f"<h1>{MARK}{text(10)}</h1>"] if draw.random() < 0.8 else []
        for _ in range(draw.choice([1, 1, 2, 3, 5, 8, 12])):
            short = draw.choice([None, None, None, 1, 2, 6])
            kind = draw.random()
            body = MARK + text(short)
            if kind < 0.62:
                out.append(draw.choice([f"<p>{body}</p>", f"<p>{body}", f"<p><b>{body}<br>", f"<p><i>{body}</i> <a href='#'>{text(2)}</a></p>"]))
            elif kind < 0.72:
                out.append(f"<h{draw.randint(2, 4)}>{MARK}{text(6)}</h2>" if draw.random() < 0.1 else f"<h2>{MARK}{text(6)}</h2>")
            elif kind < 0.78:
                out.append(f"<blockquote>{body}</blockquote>" if draw.random() < 0.5 else f"<blockquote><p>{body}</p></blockquote>")
            elif kind < 0.85:
                out.append("<ul>" + "".join(f"<li>{MARK}{text(draw.choice([None, 5]))}</li>" for _ in range(draw.randint(1, 5))) + "</ul>")
            elif kind < 0.9:
                out.append("<table>" + "".join(f"<tr><td>{MARK}{text(2)}</td><td>{MARK}{text(3)}</td></tr>" for _ in range(draw.randint(1, 4))) + "</table>")
            elif kind < 0.94:
                out.append(f"<div>{body}</div>")
            else:
                out.append(boilerplate("article"))
        inner = "".join(out)
        if draw.random() < 0.3:
            inner = named("div", "content", inner)
        wrap = draw.random()
        if wrap < 0.5:
            return f"<article>{inner}</article>"
        if wrap < 0.65:
            return f"<main>{inner}</main>"
        if wrap < 0.75:
            return f"<main><article>{inner}</article>{boilerplate('page') if draw.random() < 0.4 else ''}</main>"
        return named(draw.choice(["div", "section"]), "content", inner, 0.9)

    parts = [boilerplate("page") for _ in range(draw.randint(0, 2))] + [content()] + [boilerplate("page") for _ in range(draw.randint(0, 3))]
    if draw.random() < 0.6:
        inner = draw.choice([f"<a href='/'>{text(3)}</a>", f"<p>{text(6)}</p>", f"<h1>{text(4)}</h1>{links(4)}", links(5)])
        parts.insert(0, draw.choice([f"<header>{inner}</header>", f"<nav>{links(draw.randint(2, 8))}</nav>", f"<header><nav>{links(5)}</nav></header>"]))
    if draw.random() < 0.7:
        parts.append(draw.choice([f"<footer>&copy; {text(8)}", f"<footer>&copy; {text()}</footer>", f"<footer><p>{text(9)}</p>{links(3)}</footer>"]))
    body = "".join(parts)
    if draw.random() < 0.3:
        body = f"<div>{body}</div>"
    return f"<!DOCTYPE html><html><head><title>{text(6)}</title><style>p{{}}</style></head><body>{body}" + draw.choice(["</body></html>", ""])


def learn(texts: list[str], composed: int = COMPOSED, seed: int = 11) -> boosting.Trees:
    """Trees for the nodes of composed pages."""
    draw = random.Random(seed)
    texts = texts or ["One line of text, as plain as it may be."]
    x, y = [], []
    for _ in range(composed):
        nodes = walk(build(compose(draw, texts)))
        for n in reversed(nodes):
            if n.tag == "#text" and MARK in n.text:
                n.label, n.text = 1, n.text.replace(MARK, "")
            if n.label and n.parent is not None:
                n.parent.label = 1
        nodes = [n for n in nodes if n.tag != "#text" or n.text]
        for n in nodes:
            n.children = [c for c in n.children if c.tag != "#text" or c.text]
        x.append(node_features(nodes))
        y.append(np.array([n.label for n in nodes], dtype=float))
    return boosting.fit_trees(np.vstack(x), np.concatenate(y), rounds=80, depth=4, rate=0.2)


def extract_many(pages: list[str], trees: boosting.Trees) -> list[str]:
    """Main texts of pages; the trees run once over the nodes of all of them."""
    trees_of = [walk(build(p)) if p else [] for p in pages]
    rows = [node_features(nodes) for nodes in trees_of if len(nodes) > 1]
    p = trees.probability(np.vstack(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for nodes in trees_of:
        if len(nodes) > 1:
            kept = decode(nodes, p[at : at + len(nodes)])
            at += len(nodes)
            out.append("\n".join(n.text for n in kept))
        else:
            out.append("")
    return out


def sample_texts(pages: DataFrame, sample: int = SAMPLE) -> list[str]:
    """Text blocks of a bounded sample of pages, as the executors cut them."""

    def pieces(page: str) -> list[str]:
        blocks = {n.text for n in walk(build(page)) if n.tag == "#text"}
        cut = {b[i : i + PIECE] for b in blocks for i in range(0, len(b), PIECE)}
        return sorted(cut, key=lambda t: (zlib.crc32(t.encode("utf-8", "replace")), t))[:SAMPLE_PIECES]

    @F.pandas_udf("array<string>")
    def blocks(found: pd.Series) -> pd.Series:
        return found.map(pieces)

    some = pages.select("page_id", F.col("html")).where("html is not null and page_id is not null")
    picked = hash_sample(some, "page_id", sample, some.count()).groupBy("page_id").agg(F.min("html").alias("html"))  # one page of an id
    picked = picked.select(F.explode(blocks("html")).alias("t")).distinct()
    return sorted(r["t"] for r in picked.collect())


def extracted(pages: DataFrame, trees: boosting.Trees | None = None) -> DataFrame:
    """row (struct of the input columns) and text."""
    pages.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    model = trees or learn(sample_texts(pages))

    @F.pandas_udf("string")
    def main_text(found: pd.Series) -> pd.Series:
        return pd.Series(extract_many(found.tolist(), model), dtype=object)

    page: Column = F.coalesce(F.col("row.html"), F.lit(""))
    return boxed(pages).withColumn("text", main_text(page))


def op2_extraction(pages: DataFrame) -> DataFrame:
    found = extracted(pages.select("page_id", "url", "html"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))
