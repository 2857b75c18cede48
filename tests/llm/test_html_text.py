"""HTML extraction: hand-made pages, planted wrappers and the given pages."""

import random
import re
from html import unescape

from pyspark.sql import functions as F

from wavecohort.llm import html_text as H

PAGES = "page_id long, url string, html string"


def text_of(html):
    page = H.parse(html)
    return H.read_blocks(H.content_root(page, {}, None, H.WrapperSettings()), set(), {})


def test_blocks_references_and_white_space():
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
    <nav>menu</nav><article><h1>A &amp; B</h1><p>one<br>two&nbsp;  three <b>four</b>
    five<p>six &lt;x&gt; &#233;<script>var a="</p>";</script> seven<!-- no <p>no</p> --></p>
    <ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article><footer>f</footer></body></html>"""
    assert text_of(html) == "A & B\none two three four five\nsix <x> é seven\na\nb\nc\nd"


def test_dropped_parts():
    html = """<body class="has-sidebar"><header><h1>Site</h1></header><div class="sidebar">s</div><main><div class="ad">x</div>
    <article class="post with-sidebar"><header><h1>Title</h1><span>by me</span></header><p>body</p>
    <form>f</form><aside>a</aside><div class="cookie-notice">n</div><div id="comments"><article class="comment">c</article></div>
    <p>end</p><footer>tags</footer></article></main><div role="navigation">r</div><p hidden>h</p></body>"""
    assert text_of(html) == "Title\nbody\nend"


def test_pages_without_marks_use_the_largest_region():
    html = "<body><div><a href=x>m1</a></div><div><p>" + "long text " * 20 + "</p><p>more</p></div><div>c</div></body>"
    assert text_of(html) == ("long text " * 20).strip() + "\nmore"


def test_all_parts_of_the_main_text_are_read():
    for html, want in [
        ("<main><h1>T</h1><p>lead</p><article><p>a</p></article><article><p>b</p></article></main>", "T\nlead\na\nb"),
        ("<div>x</div><article><p>a long one</p></article><article><p>b</p></article><div>y</div>", "a long one\nb"),
        ("<main><header><h1>T</h1><span>by</span></header><article><p>a</p></article></main>", "T\na"),
        ("<div><div><h1>T</h1></div><article><p>a</p></article></div><div>junk</div>", "T\na"),
        ("<div><h1>Site</h1></div><article><h1>T</h1><p>a</p></article>", "T\na"),
        ("<article><p>a</p></article><div class=related><article><p>b</p></article></div>", "a"),
        ("<article><p>a</p></article><div id=comments><article><p>a long comment</p></article></div>", "a"),
        ("<article><p>t</p></article><div class=has-sidebar><article><p>the page</p></article></div>", "t\nthe page"),
        ("<main><p>a</p></main><article><p>b</p></article>", "a\nb"),
        ("<main><h1>T</h1><p>lead</p><article><p>a</p></article></main><article><p>b</p></article>", "T\nlead\na\nb"),
        ("<div hidden><main><p>a</p></main></div>", "a"),
    ]:
        assert text_of(html) == want, html


def test_names_of_headings_and_sections_are_no_drop_words():
    html = """<article><h2 id="related-work">r</h2><section id="discussion"><p>d</p></section><h2 id="notifications">n</h2>
    <p id="copyright">c</p><section id="comments"><p>x</p></section><div id="newsletter">y</div><section class="related">z</section>
    </article>"""
    assert text_of(html) == "r\nd\nn\nc"


def test_a_self_closed_svg_ends_at_its_own_tag():
    assert text_of('<p>a</p><svg width="1"/><p>b</p>') == "a\nb"
    assert text_of('<p>a<svg/>b</p><svg class="x" d="1/>2" /><p>c</p>') == "ab\nc"
    assert text_of('<p>a</p><svg width="1"><path d="m"/><text>no</text></svg><p>b</p>') == "a\nb"


def test_broken_html():
    for html, want in [
        ("", ""), (None, ""), ("plain &am", "plain &am"), ("<p>a<p>b", "a\nb"), ("a < b", "a < b"),
        ("<article><p>x</p><a href=\"/y", "x"), ("<script>never closed <p>a", ""), ("</div></p><p>a</b></p>", "a"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<p title=\"x>a</p><p>b</p>", "a\nb"),
    ]:
        assert text_of(html) == want, html


def test_simple_tree_matching_keeps_order_and_equal_texts():
    a = H.parse("<div><h2>same</h2><p>x</p><p>fix</p></div>")
    b = H.parse("<div><p>new</p><h2>same</h2><p>fix</p><p>y</p></div>")
    pairs = H.match(a, b)
    named = {(H.nodes_of(a)[i].text, H.nodes_of(b)[j].text) for i, j in pairs.items()}
    assert ("same", "same") in named and ("fix", "fix") in named
    long = "<div>" + "".join(f"<p>{i}</p>" for i in range(400)) + "</div>"
    assert len(H.match(H.parse(long), H.parse(long))) == len(H.nodes_of(H.parse(long)))


def texts_met(a, b):
    a, b = H.parse(a), H.parse(b)
    mine, other = H.nodes_of(a), H.nodes_of(b)
    return {(mine[i].text, other[j].text) for i, j in H.match(a, b).items() if mine[i].text}


def test_long_and_deep_pages_are_aligned_like_short_ones():
    def page(name, n, end="<p>fixed end</p>"):
        return "<div><p>start</p>" + "".join(f"<p>{name} {k}</p>" for k in range(n)) + f"<h2>{name}</h2>{end}<ul><li>{name}<p>x</p></ul></div>"

    for n, m in ((20, 30), (150, 260), (700, 180), (180, 700)):
        met = texts_met(page("a", n), page("b", m))
        assert {("start", "start"), ("fixed end", "fixed end")} <= met, (n, m)
        assert len({x for x, _ in met if x.startswith("a ")}) == min(n, m)
    deep = "<div>" * 2500 + "<p>{}</p><p>fixed</p><p>{}</p>" + "</div>" * 2500
    assert ("fixed", "fixed") in texts_met(deep.format("a", "b"), deep.format("c", "d"))


def plain_weight(x, y):
    """Simple tree matching as it is defined, without any shortcut."""
    if x.label != y.label:
        return 0
    if not x.children and not y.children:
        return H.EQUAL if x.text == y.text else H.UNEQUAL
    rows = [[0] * (len(y.children) + 1) for _ in range(len(x.children) + 1)]
    for i, c in enumerate(x.children):
        for j, d in enumerate(y.children):
            rows[i + 1][j + 1] = max(rows[i][j + 1], rows[i + 1][j], rows[i][j] + plain_weight(c, d))
    return H.ELEMENT + rows[-1][-1]


def test_alignment_has_the_greatest_weight():
    draw = random.Random(3)

    def tree(size, depth=0):
        parts = []
        for _ in range(draw.randint(0, size)):
            tag = draw.choice(["div", "p", "ul", "hr", "h2"])
            inner = tree(4, depth + 1) if tag in ("div", "ul") and depth < 3 else draw.choice("abcde ")
            parts.append("<hr>" if tag == "hr" else f"<{tag}>{inner}</{tag}>")
        return "".join(parts)

    for size in [8] * 60 + [130] * 8:
        a, b = H.parse(tree(size)), H.parse(tree(size))
        mine, other = H.nodes_of(a), H.nodes_of(b)
        got, above = 0, {c.number: n.number for t in (mine, other) for n in t for c in n.children if t is mine}
        met = H.match(a, b)
        for i, j in met.items():
            x, y = mine[i], other[j]
            assert x.label == y.label and (i == 0 or y in other[met[above[i]]].children)
            leaves = not x.children and not y.children
            got += (H.EQUAL if x.text == y.text else H.UNEQUAL) if leaves else H.ELEMENT
        assert got == plain_weight(a, b)
        for n in mine:
            partners = [met[c.number] for c in n.children if c.number in met]
            assert partners == sorted(partners)


def templated(n, host="h.example"):
    """Pages of a host without any telling tag or class: a template around a
    varying title and varying paragraphs."""
    rows = []
    for i in range(n):
        body = "".join(f"<p>Story {i} paragraph {k} says {i * k}.</p>" for k in range(2 + i % 4))
        html = (
            "<body><div><p>Home</p><p>All stories</p></div>"
            f"<div><h2>Read this</h2><p>Title {i}</p>{body}<p>Printed by the press</p></div>"
            "<div><p>Imprint of the house, with a line that is rather long</p></div></body>"
        )
        want = "\n".join([f"Title {i}", *re.findall(r"Story[^<]*", body)])
        rows.append((i, f"http://{host}/{i}", html, want))
    return rows


def test_template_is_induced_per_host(spark):
    rows = templated(12)
    pages = spark.createDataFrame([r[:3] for r in rows], PAGES)
    got = {r.page_id: r.text for r in H.page_texts(pages).collect()}
    assert got == {r[0]: r[3] for r in rows}


def test_copies_are_no_template(spark):
    html = "<body><article><p>same</p><p>text</p></article></body>"
    pages = spark.createDataFrame([(i, "http://a/x", html) for i in range(9)], PAGES)
    assert {r.text for r in H.page_texts(pages).collect()} == {"same\ntext"}


def shared_article(i, mark):
    """A page around one long article, with its own menu and advert."""
    body = "".join(f"<p>Long paragraph {k} of the shared article.</p>" for k in range(40))
    return f"<body><nav>menu {i}</nav><div class=ad>ad {i}</div><{mark}>{body}</{mark}></body>"


def seeded(spark, pages, host="h.example"):
    """Rows of PAGES whose first page is the host's seed."""
    ids = [r.id for r in spark.range(len(pages)).orderBy(F.xxhash64("id")).collect()]
    return [(i, f"http://{host}/{i}", html) for i, html in zip(ids, pages)]


def test_near_copies_of_the_seed_are_no_template(spark):
    want = "\n".join(f"Long paragraph {k} of the shared article." for k in range(40))
    for mark, others in (("article", 40), ("article", 0), ("main", 40), ("div", 40)):
        pages = [shared_article(i, mark) for i in range(7)]
        for i in range(others):
            own = "".join(f"<p>Page {i} says {k * i}.</p>" for k in range(3 + i % 8))
            pages.append(f"<body><nav>menu {i}</nav><div class=ad>ad {i}</div><{mark}>{own}</{mark}></body>")
        rows = seeded(spark, pages)
        got = {r.page_id: r.text for r in H.page_texts(spark.createDataFrame(rows, PAGES)).collect()}
        assert [got[r[0]] for r in rows[:7]] == [want] * 7, (mark, others)


def test_edited_copies_of_the_seed_are_no_template(spark):
    pages = [shared_article(i, "article").replace("</article>", f"<p>Edition {i}</p></article>") for i in range(9)]
    rows = seeded(spark, pages)
    got = {r.page_id: r.text for r in H.page_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[r[0]].count("Long paragraph") == 40 and got[r[0]].endswith(f"Edition {i}") for i, r in enumerate(rows))


def test_a_text_in_the_place_of_a_template_stays(spark):
    pages, want = [], []
    for i in range(60):
        body = [f"Page {i} says {k * i}." for k in range(3)]
        last = f"The real end of page {i}." if i in (20, 40) else "All rights belong to the house."
        pages.append("<body><article>" + "".join(f"<p>{b}</p>" for b in [*body, last]) + "</article></body>")
        want.append("\n".join([*body, last] if i in (20, 40) else body))
    rows = seeded(spark, pages)
    got = {r.page_id: r.text for r in H.page_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert [got[r[0]] for r in rows] == want


def test_null_and_empty_pages(spark):
    rows = [(1, None, "<p>a</p>"), (2, "nonsense", None), (3, "http://a/", ""), (None, "http://a/", "<p>b</p>"), (1, None, "<p>a</p>")]
    got = H.page_texts(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "b", 1), (1, "a", 1), (1, "a", 1), (2, "", 0), (3, "", 0)]
    assert H.page_texts(spark.createDataFrame([], PAGES)).count() == 0


def test_given_pages(spark, sf):
    """Against a plain reading of these pages' article, which their layout
    permits: one article of a heading and paragraphs."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r.text for r in H.page_texts(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", r.html, re.S)[1]
        blocks = [unescape(re.sub(r"<[^>]*>?", "", b)) for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(" ".join(b.split()) for b in blocks if b.strip())
        assert got[r.page_id] == want


def test_article_text_is_not_dropped_by_parts_of_names():
    page = """<body><nav>n</nav><article><header><h1>T</h1><span>by me</span><p>A lead.</p></header>
    <p class="share-price">Up 3.</p><div class="social-history"><p>Old.</p></div><h2 class="related">Kin</h2>
    <p class="notice">Seen.</p><div hidden><p>Later.</p></div><p aria-hidden="true">Alt.</p><p style="display: none">Off.</p>
    <div class="share-buttons">s</div><div class="ad">a</div><div class="box ad-slot">b</div><div class="comment-list">c</div>
    <p>End.</p></article><div class="share-price">x</div></body>"""
    assert text_of(page) == "T\nA lead.\nUp 3.\nOld.\nKin\nSeen.\nLater.\nAlt.\nOff.\nEnd."
