"""Main text of web pages by wrapper induction.

Pages of a host share a template. Every page's tree of blocks is aligned with
the tree of one seed page of its host by simple tree matching; per seed node
the pages are counted in which it is matched and in which its text is the
same. Nodes that stay the same on nearly all pages are template, the others
are slots, and the slot region that holds most of the varying text is the
host's content. Pages of equal content (the text of the marked article or main,
else of the page) have one vote together; the seed's own content has none, nor
has a page that shares half of its own or of the seed's marked text with the
seed, so copies never make an article's text template. A page is then aligned
once more and its text read from its
content region (where the page marks articles or mains the smallest region
that holds them all and their heading, else the host's, else the part that
holds most of its own text), without template nodes and without elements whose
tag, role, class or id says menu, header, footer, sidebar, notice, advert, form
or comments; ids of headings, text blocks and sections of an article say
nothing, since they are often made from a heading's words, nor do classes of an
article's headings and text blocks or single parts of its hyphenated classes.
What a page hides by an attribute is read like any other text.

The counts are sums per (host, node), so a host with a third of all pages is
never in one task; pages are merged by (host, content). The seeds are a written table that Spark broadcasts only
below its size threshold.

Defined results: null or empty html gives an empty text; pages with a null or
odd url share the empty host; repeated pages are read each; copies of the seed
are no evidence for a template; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches, worker_cache, written


@dataclass(frozen=True)
class WrapperSettings:
    min_pages: int = 5  # pages, besides the seed, that show a template node
    same_share: float = 0.9  # of the pages that match the node
    host_share: float = 0.5  # of all the host's distinct contents, that show a template node
    copy_share: float = 0.5  # of the marked text, from which a page is a copy of the seed's and has no vote
    region_share: float = 0.6  # of the varying text, down to which the content region is followed


# Element names of HTML by what they mean here.
RAW = "script style noscript template iframe textarea title svg select canvas audio video".split()
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section "
    "summary table caption colgroup tbody td tfoot th thead tr ul".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
    "tfoot": {"tr", "td", "th", "thead", "tbody"},
}
CLOSED_BY = frozenset("ul ol dl table".split())  # an implied end goes no further up than these
# Elements whose ids are names of their own text.
NAMED_TEXT = frozenset(
    "h1 h2 h3 h4 h5 h6 hgroup p li dt dd td th tr blockquote pre figure figcaption caption summary legend".split()
)
# Tags, roles and class or id words of what is no main text.
DROP_TAGS = frozenset("nav footer aside form menu dialog button fieldset search".split())
DROP_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar "
    "sidenav menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar comment comments commentlist "
    "reply replies discussion disqus cookie cookies consent gdpr notice notices notification notifications alert "
    "popup modal overlay newsletter subscribe subscription signup login register social share sharing related "
    "recommended recommendations widget toolbar pagination pager copyright disclaimer".split()
)

# Parts of class names that only say what an element is built as.
PARTS = frozenset(
    "area bar block bottom box button buttons col column container content global inline inner item items left link links list "
    "main outer panel primary right row secondary section slot top unit wrap wrapper".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg(?=[\s/])(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>]).*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*(?:>|\Z)",  # a broken tag
    re.S | re.I,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[a-z0-9]+")
_HEADING = re.compile(r"h[1-6]\Z")
_SPACE = re.compile(r"\s+")
# Weights of matching, in tenths: equal leaves, unequal leaves of a label, an element for itself.
EQUAL, UNEQUAL, ELEMENT = 30, 1, 10


class Node:
    """A block element, or a run of text inside one (tag "#text")."""

    __slots__ = ("tag", "label", "children", "drop", "text", "size", "number", "form", "full", "by")

    def __init__(self, tag: str, label: str = "", drop: bool = False, text: str = ""):
        self.tag, self.label, self.drop, self.text = tag, label or tag, drop, text
        self.children: list[Node] = []
        self.size, self.number = 0, -1
        self.by = ""  # of an element dropped for other than its tag: "comments" or "other"
        self.form, self.full = -1, 0  # match: equal for equal subtrees; the weight of one matched with itself


def _class_words(name: str, tag: str, in_text: bool) -> set[str]:
    """The words of a class attribute that may tell what an element is. Inside
    an article text blocks and headings say nothing, and of a hyphenated class
    every part must fit: share-buttons does, share-price does not."""
    if not in_text:
        return set(_WORDS.findall(name))
    if tag in NAMED_TEXT:
        return set()
    parts = [_WORDS.findall(token) for token in name.split()]
    return {w for p in parts if all(w in DROP_WORDS or w in PARTS for w in p) for w in p}


def _element(tag: str, attrs: str, in_text: bool = False) -> Node:
    """``in_text``: inside an article or main element."""
    label, drop, by = tag, tag in DROP_TAGS, ""
    if attrs and not attrs.isspace():
        found = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)}
        name = found.get("class", "").lower()
        label = f"{tag}.{' '.join(name.split())}" if name else tag
        drop = drop or found.get("role", "").lower() in DROP_ROLES
        if tag not in ("html", "body", "main", "article") or "comment" in name:
            words = _class_words(name, tag, in_text)
            own = _WORDS.findall(found.get("id", "").lower())
            if tag == "section" and in_text:
                words.update(COMMENT_WORDS.intersection(own))
            elif tag not in NAMED_TEXT:
                words.update(own)
            if not DROP_WORDS.isdisjoint(words):
                drop, by = True, "" if COMMENT_WORDS.isdisjoint(words) else "comments"
        if drop and tag not in DROP_TAGS:
            by = by or "other"
        else:
            by = ""
        if found.get("role", "").lower() == "main":
            tag = "main"
    node = Node(tag, label, drop)
    node.by = by
    return node


def parse(html: str | None) -> Node:
    """The tree of block elements; inline elements only leave their text."""
    root = Node("html")
    stack, run = [root], []

    def flush():
        if run:
            text = _SPACE.sub(" ", unescape("".join(run))).strip()
            run.clear()
            if text:
                stack[-1].children.append(Node("#text", text=text))

    at = 0
    html = html or ""
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            run.append(html[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["raw"]:
                run.append(" ")
            continue
        tag = tag.lower()
        if tag not in BLOCKS:
            if tag == "br":
                run.append(" ")
            continue
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag or stack[k].label.partition(".")[0] == tag:
                    flush()
                    del stack[k:]
                    break
            continue
        flush()
        if tag in ("html", "body"):
            continue
        if stack[-1].tag == "p":
            stack.pop()
        closes = CLOSES.get(tag)
        if closes:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in closes:
                    del stack[k:]
                    break
                if stack[k].tag in CLOSED_BY:
                    break
        in_text = bool(m["attrs"]) and any(n.tag in ("article", "main") for n in stack)
        node = _element(tag, m["attrs"], in_text)
        stack[-1].children.append(node)
        if tag not in VOID:
            stack.append(node)
    if at < len(html):
        run.append(html[at:])
    flush()
    _measure(root)
    return root


def _measure(root: Node) -> None:
    """Numbers the nodes from the top and sets each node's text size. A
    container dropped for other than its tag is spared where it holds a main
    element, or an article larger than all that stand in no such container
    (one of comments only where there is no such article)."""
    order, stack = [], [(root, False, None)]
    boxes: dict[int, Node | None] = {}  # article or main -> the dropped element it stands in
    outer: dict[int, Node | None] = {}  # and that one's own
    while stack:
        node, in_text, box = stack.pop()
        node.number = len(order)
        order.append(node)
        if node.tag == "header" and not in_text:
            node.drop, node.by = True, node.by or "other"
        in_text = in_text or node.tag in ("article", "main")
        if node.tag in ("article", "main") and not node.drop:
            boxes[node.number] = box
        if node.drop:
            outer[node.number], box = box, node
        stack += [(c, in_text, box) for c in reversed(node.children)]
    _sizes(order)
    free = [order[n].size for n, box in boxes.items() if box is None]
    spared = False
    for n, box in boxes.items():
        needs = order[n].tag == "article"
        while box is not None:
            least = max(free, default=-1) if box.by == "other" else (-1 if not free else math.inf)
            if box.by and (not needs or order[n].size > least):
                box.drop, spared = False, True
            box = outer[box.number]
    if spared:
        _sizes(order)


def _sizes(order: list[Node]) -> None:
    for node in reversed(order):
        node.size = len(node.text)
        for c in node.children:
            node.size += 0 if c.drop else c.size


def match(a: Node, b: Node) -> dict[int, int]:
    """Simple tree matching: number of a node of ``a`` -> number of its
    partner in ``b``. Children keep their order; equal texts weigh more.

    The alignment is of the greatest weight at every length and depth. Equal
    first and last children are partners in one such alignment, so only what
    is between them is aligned by dynamic programming."""
    forms: dict[tuple, int] = {}
    deepest = 0
    for root in (a, b):
        order, depths = nodes_of(root), {}
        for node in order:
            depth = depths.pop(node.number, 0)
            deepest = max(deepest, depth)
            for c in node.children:
                depths[c.number] = depth + 1
        for node in reversed(order):
            node.form = forms.setdefault((node.label, node.text, *[c.form for c in node.children]), len(forms))
            node.full = EQUAL
            if node.children:
                node.full = ELEMENT
                for c in node.children:
                    node.full += c.full
    known: dict[tuple[int, int], int] = {}

    def weigh(x: Node, y: Node) -> int:
        """Of two nodes of one label."""
        if x.form == y.form:
            return x.full
        if not x.children and not y.children:
            return UNEQUAL
        w = known.get((x.form, y.form))
        if w is None:
            w = known[x.form, y.form] = ELEMENT + align(x.children, y.children, None)
        return w

    def align(xs, ys, pairs: list | None) -> int:
        """The weight of the best alignment; its pairs are added to ``pairs``."""
        total, lo, n, m = 0, 0, len(xs), len(ys)
        while lo < n and lo < m and xs[lo].form == ys[lo].form:
            total += xs[lo].full
            if pairs is not None:
                pairs.append((xs[lo], ys[lo]))
            lo += 1
        while n > lo and m > lo and xs[n - 1].form == ys[m - 1].form:
            n, m = n - 1, m - 1
            total += xs[n].full
            if pairs is not None:
                pairs.append((xs[n], ys[m]))
        if n == lo or m == lo:
            return total
        return total + (_short if m - lo < 50 else _long)(xs[lo:n], ys[lo:m], pairs)

    def _walk_back(xs, ys, rows, first, i, j, pairs) -> tuple[int, int]:
        """Adds the pairs of ``rows`` (those from number ``first``) up to row i, column j."""
        while i > first and j:
            here, above = rows[i - first], rows[i - first - 1]
            if here[j] == above[j]:
                i -= 1
            elif here[j] == here[j - 1]:
                j -= 1
            else:
                pairs.append((xs[i - 1], ys[j - 1]))
                i, j = i - 1, j - 1
        return i, j

    def _short(xs, ys, pairs) -> int:
        rows = [[0] * (len(ys) + 1)]
        for x in xs:
            above, row, label, last = rows[-1], [0], x.label, 0
            for j, y in enumerate(ys):
                best = above[j + 1]
                if last > best:
                    best = last
                if label == y.label:
                    w = above[j] + weigh(x, y)
                    if w > best:
                        best = w
                row.append(best)
                last = best
            rows.append(row)
        if pairs is not None:
            _walk_back(xs, ys, rows, 0, len(xs), len(ys), pairs)
        return rows[-1][-1]

    def _long(xs, ys, pairs) -> int:
        """As _short, a row at a time; only every so-manyth row is kept and
        those between are made again on the way back."""
        kinds = np.array([_kind(y) for y in ys])
        ids = np.array([y.form for y in ys])
        places: dict[str, list[int]] = {}
        for j, y in enumerate(ys):
            places.setdefault(y.label, []).append(j)
        at = {label: np.array(js) for label, js in places.items()}
        mixed = {label: [j for j in js if kinds[j] == 2] for label, js in places.items()}

        def below(above, x):
            js = at.get(x.label)
            if js is None:
                return above
            gain, kind = np.zeros(len(ys), dtype=np.int64), _kind(x)
            if kind == 2:
                for j in places[x.label]:
                    gain[j] = weigh(x, ys[j])
            else:
                # a leaf, or an element of one text, weighs with another of its kind by equality alone
                equal, alike = (EQUAL, UNEQUAL) if kind == 0 else (ELEMENT + EQUAL, ELEMENT + UNEQUAL)
                gain[js] = np.where(ids[js] == x.form, equal, np.where(kinds[js] == kind, alike, ELEMENT))
                for j in mixed[x.label]:
                    gain[j] = weigh(x, ys[j])
            row = np.zeros_like(above)
            np.maximum.accumulate(np.maximum(above[1:], above[:-1] + gain), out=row[1:])
            return row

        step = max(1, math.isqrt(len(xs)))
        row = np.zeros(len(ys) + 1, dtype=np.int64)
        kept = []
        for i, x in enumerate(xs):
            if pairs is not None and i % step == 0:
                kept.append(row)
            row = below(row, x)
        total = int(row[-1])
        if pairs is not None:
            i, j = len(xs), len(ys)
            while i and j:
                first = (i - 1) // step * step
                rows = [kept[first // step]]
                for x in xs[first:i]:
                    rows.append(below(rows[-1], x))
                i, j = _walk_back(xs, ys, rows, first, i, j, pairs)
        return total

    before = sys.getrecursionlimit()
    sys.setrecursionlimit(max(before, 5 * deepest + 1000))
    try:
        out, todo = {}, [(a, b)] if a.label == b.label else []
        while todo:
            x, y = todo.pop()
            out[x.number] = y.number
            if x.form == y.form:
                todo += zip(x.children, y.children)
            elif x.children and y.children:
                align(x.children, y.children, todo)
    finally:
        sys.setrecursionlimit(before)
    return out


def _kind(node: Node) -> int:
    """0: a leaf; 1: an element of one text; 2: another element."""
    if not node.children:
        return 0
    return 1 if len(node.children) == 1 and node.children[0].tag == "#text" else 2


def nodes_of(root: Node) -> list[Node]:
    """All nodes, by number."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += reversed(node.children)
    return out


def region(root: Node, share: float, size) -> Node:
    """Down from the root, as long as one child that holds blocks itself has
    ``share`` of the size."""
    node = root
    while True:
        inner = [c for c in node.children if not c.drop and any(g.tag != "#text" for g in c.children)]
        best = max(inner, key=size, default=None)
        if best is None or size(best) < share * max(1, size(node)):
            return node
        node = best


def marked_root(root: Node) -> Node | None:
    """The smallest region that holds the page's articles and their heading,
    or of a main without articles all of it. Marks that only the page itself
    holds together are read alone, as the children of a node of their own."""
    articles, mains, heads, titled = [], [], [], False  # articles and heads with the main they stand in
    above: dict[int, Node] = {}
    stack = [(root, None, False)]
    while stack:
        node, in_main, in_article = stack.pop()
        if node.drop:
            continue
        if node.tag == "article" and not in_article:
            articles.append((node, in_main))
            in_article = True
        elif node.tag == "main" and in_main is None and not in_article:
            mains.append(node)
            in_main = node
        elif node.tag == "h1":
            titled = titled or in_article
            if not in_article:
                heads.append((node, in_main))
        for c in reversed(node.children):
            above[c.number] = node
            stack.append((c, in_main, in_article))
    if not articles and not mains:
        return None
    marks = [n for n, main in articles if main is None]
    for main in mains:
        inside = [n for n, m in articles if m is main]
        inside += [n for n, m in heads if m is main] if inside else [main]
        marks.append(_common(root, inside, above))
    top = _common(root, marks, above)
    for head, _ in heads[:1] if not mains and not titled else []:
        wider = _common(root, [head, *marks], above)
        # a title beside the articles; one elsewhere on the page may be the site's
        if wider.number >= 0 or above[head.number] is root:
            top = wider
    return top


def _common(root: Node, marks: list[Node], above: dict[int, Node]) -> Node:
    """The least node that holds all of ``marks``; if that is the root, a node
    of their own."""
    if len(marks) == 1:
        return marks[0]
    held: dict[int, int] = {}
    for mark in marks:
        node = mark
        while node is not None:
            held[node.number] = held.get(node.number, 0) + 1
            node = above.get(node.number)
    node = marks[0]
    while held[node.number] < len(marks):
        node = above[node.number]
    if node is not root:
        return node
    own = Node("main")
    own.children = sorted(marks, key=lambda n: n.number)
    own.size = sum(n.size for n in own.children)
    return own


def content_root(root: Node, partners: dict[int, int], seed_region: int | None, settings: WrapperSettings) -> Node:
    """Where the page's main text lies."""
    marked = marked_root(root)
    if marked is not None:
        return marked
    if seed_region is not None:
        of_host = [n for n in nodes_of(root) if partners.get(n.number) == seed_region and not n.drop]
        if of_host:
            return of_host[0]
    return region(root, settings.region_share, lambda n: n.size)


def read_blocks(top: Node, template: dict[int, str], partners: dict[int, int]) -> str:
    """The texts below ``top`` in page order, without dropped elements and
    texts that equal the template's in their place; of a header inside an
    article headings and paragraphs, not loose lines. ``template`` is node number -> text."""
    out, stack = [], [(top, False)]
    while stack:
        node, in_header = stack.pop()
        if node.drop and node is not top:
            continue
        partner = partners.get(node.number)
        if partner in template and template[partner] == node.text:
            continue  # another text in a template's place is a slot
        if node.text and not in_header:
            out.append(node.text)
        in_header = (in_header or node.tag == "header") and not (node.tag == "p" or _HEADING.match(node.tag))
        stack += [(c, in_header) for c in reversed(node.children)]
    return "\n".join(out)


def host_column(url: str = "url"):
    """Scheme, port and a leading www. don't make another host."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/:?#]+)", 1), F.lit("")))


def seed_pages(pages: DataFrame) -> DataFrame:
    """(host, seed): one page per host, by the smallest hash of its page_id.
    Only (hash, page_id) is aggregated; the pages themselves are fetched by a
    written table of one row per host, broadcast below Spark's threshold."""
    keyed = pages.where("length(html) > 0 and page_id is not null").select("host", "page_id", F.xxhash64("page_id").alias("h"))
    first = keyed.groupBy("host").agg(F.min(F.struct("h", "page_id")).alias("s")).select("host", "s.page_id")
    first = written(first, "seed-ids")
    found = pages.join(first, ["host", "page_id"], "left_semi").where("length(html) > 0")
    return found.groupBy("host").agg(F.min("html").alias("seed"))  # repeated rows of the page


def _seed_tree(html: str) -> Node:
    trees = worker_cache("html_seeds", dict)
    if html not in trees:
        if len(trees) > 200:
            trees.clear()
        trees[html] = parse(html)
    return trees[html]


def content_key(root: Node, marked: Node | None) -> int:
    """Hash of the marked text, of a page without marks of its whole text."""
    from xxhash import xxh64_intdigest

    if marked is not None:
        text = read_blocks(marked, {}, {})
    else:
        text = "\n".join(n.text for n in nodes_of(root) if n.text)
    return xxh64_intdigest(text.encode("utf-8", "replace"), 7) - (1 << 63)


def _seed_facts(seed: str) -> tuple:
    """Tree, texts, content key, and of the marked part the nodes and size."""
    tree = _seed_tree(seed)
    marked = marked_root(tree)
    inside = {n.number for n in nodes_of(marked)} if marked is not None else set()
    return tree, [n.text for n in nodes_of(tree)], content_key(tree, marked), inside, marked.size if inside else 0


_PAGE = -1  # the node number under which node_counts counts the voting pages


def node_counts(pages: DataFrame, seeds: DataFrame, settings: WrapperSettings) -> DataFrame:
    """(host, node, matched, same, varying): per text of the seed the distinct
    contents that match it, those with the same text, and the characters that
    differ; ``matched`` of node -1 is the number of the host's contents."""

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        facts: dict[str, tuple] = {}
        for pdf in batches:
            rows = []
            for host, html, seed in zip(pdf["host"], pdf["html"], pdf["seed"]):
                if html == seed:
                    continue
                if seed not in facts:
                    if len(facts) > 200:
                        facts.clear()
                    facts[seed] = _seed_facts(seed)
                tree, texts, seed_content, inside, inside_size = facts[seed]
                root = parse(html)
                marked = marked_root(root)
                content = content_key(root, marked)
                if content == seed_content:
                    continue
                page = nodes_of(root)
                nodes, differs, shared = [_PAGE], [0], 0
                for mine, other in match(root, tree).items():
                    if not texts[other]:
                        continue  # an element; only texts are constant or vary
                    same = page[mine].text == texts[other]
                    nodes.append(other)
                    differs.append(0 if same else len(page[mine].text))
                    if same and other in inside:
                        shared += len(texts[other])
                own = (root if marked is None else marked).size
                if inside and shared and shared >= settings.copy_share * min(own, inside_size):
                    continue
                rows.append((host, content, nodes, differs))
            yield pd.DataFrame(rows, columns=["host", "content", "nodes", "differs"])

    joined = pages.where("length(html) > 0").join(seeds, "host").select("host", "html", "seed")
    votes = joined.mapInPandas(vote, "host string, content long, nodes array<int>, differs array<int>")
    each = votes.groupBy("host", "content").agg(F.min(F.struct("nodes", "differs")).alias("v"))
    texts = each.select("host", F.explode(F.arrays_zip("v.nodes", "v.differs")).alias("t"))
    differs = F.col("t.differs").cast("long")
    return texts.groupBy("host", F.col("t.nodes").alias("node")).agg(
        F.count("*").alias("matched"), F.count_if(differs == 0).alias("same"), F.sum(differs).alias("varying")
    )


def wrappers(pages: DataFrame, settings: WrapperSettings) -> DataFrame:
    """(host, seed, template, varying): the seed page, the numbers of its text
    nodes that are template, and the varying characters of the others. One
    row per host, as large as its seed."""
    seeds = written(seed_pages(pages), "seeds")
    counts = node_counts(pages, seeds, settings)
    own = F.col("node") != _PAGE
    constant = own & (F.col("matched") >= settings.min_pages) & (F.col("same") >= settings.same_share * F.col("matched"))
    by_host = counts.groupBy("host").agg(
        F.collect_list(F.when(constant, F.struct("node", "same"))).alias("constant"),
        F.collect_list(F.when(own & (F.col("varying") > 0), F.struct("node", "varying"))).alias("varying"),
        F.max(F.when(~own, F.col("matched"))).alias("contents"),
    )
    common = F.filter("constant", lambda c: c["same"] >= settings.host_share * F.col("contents"))
    by_host = by_host.select("host", F.transform(common, lambda c: c["node"]).alias("template"), "varying")
    return written(seeds.join(by_host, "host", "left"), "wrappers")


def _host_region(tree: Node, varying, settings: WrapperSettings) -> int | None:
    """The seed's node whose slots hold most of the varying text."""
    if varying is None or not len(varying):
        return None
    own = {int(v["node"]): int(v["varying"]) for v in varying}
    total: dict[int, int] = {}
    for node in reversed(nodes_of(tree)):
        total[node.number] = own.get(node.number, 0) + sum(total[c.number] for c in node.children if not c.drop)
    found = region(tree, settings.region_share, lambda n: total[n.number])
    return found.number if found is not tree else None


def extract(pages: DataFrame, settings: WrapperSettings = WrapperSettings()) -> DataFrame:
    """page_id, url and text of every page."""
    text_batches(pages.sparkSession)
    hosted = pages.select("page_id", "url", "html", host_column().alias("host"))
    known = wrappers(hosted, settings)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        learnt: dict[str, tuple] = {}
        for pdf in batches:
            texts = []
            for html, host, seed, template, varying in zip(*[pdf[c] for c in ("html", "host", "seed", "template", "varying")]):
                if not html:
                    texts.append("")
                    continue
                if host not in learnt:
                    if len(learnt) > 200:
                        learnt.clear()
                    tree = _seed_tree(seed) if seed else None
                    texts_of = [n.text for n in nodes_of(tree)] if tree else []
                    fixed = {} if template is None else {int(t): texts_of[int(t)] for t in template}
                    learnt[host] = tree, fixed, _host_region(tree, varying, settings) if tree else None
                tree, fixed, place = learnt[host]
                page = parse(html)
                # only templates and unmarked pages need the seed's alignment
                needed = tree and (fixed or place is not None and marked_root(page) is None)
                partners = match(page, tree) if needed else {}
                texts.append(read_blocks(content_root(page, partners, place, settings), fixed, partners))
            yield pdf[["page_id", "url"]].assign(text=texts)

    joined = hosted.join(known, "host", "left")
    return joined.mapInPandas(read, "page_id long, url string, text string")


def page_texts(pages: DataFrame, settings: WrapperSettings = WrapperSettings()) -> DataFrame:
    found = extract(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), settings)
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
