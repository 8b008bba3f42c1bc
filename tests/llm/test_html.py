import random
import time

import pytest

from sequoir.llm import htmltext as H

TREE = H.train()


def main(html):
    return H.main_text(html, TREE)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body>
<header><h1>Site</h1><nav><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul></nav></header><!-- note <p>no</p> -->
<div class="cookie-notice">We use cookies here to make this site work well for you and all</div><div class="ad">Buy this now, it is cheap and it is good</div>
<main><article><header><h1>The title</h1></header><p>First paragraph with <b>bold</b> text &amp; <a href=x>a link</a>.<br>Next&nbsp;line<p>Short.</p>
<aside>More on this</aside><div class="share-buttons"><a>Share</a></div><form><label>Name</label><input></form><ul><li>one<li>two</ul><blockquote>Quoted  words</blockquote>
<section id="comments"><h2>Comments</h2><p>I liked this article very much, it was long and had many words in it, thank you.</p></section></article></main>
<div id="sidebar"><p>Other things that you could read about on this site today.</p></div><footer>&copy; me</footer></body></html>"""


def test_article():
    assert main(PAGE) == "The title\n\nFirst paragraph with bold text & a link. Next line\n\nShort.\n\none\n\ntwo\n\nQuoted words"


def test_page_without_an_article():
    page = '<div id="nav"><a href=1>a</a> <a href=2>b</a></div><div class="content"><h2>Head</h2><p>A paragraph of a page that has no article element but is long enough.</p><p>End.</p></div><div class="footer">rights</div>'
    assert main(page) == "Head\n\nA paragraph of a page that has no article element but is long enough.\n\nEnd."


@pytest.mark.parametrize("html", [None, "", "   ", "<p></p>", "<script>x", "<!-- x", "<nav>menu here</nav>", "<p", "</", "<style>a</style>"])
def test_nothing(html):
    assert main(html) == ""


def test_references_and_space():
    assert main("<article><p> a\n\t b &lt;c&gt; &#233; &eacute &am &unknown; </p>\r\n<p>&nbsp;</p></article>") == "a b <c> é é &am &unknown;"


def test_unclosed_tags():
    assert main("<article><h1>T</h1><p><b>one<br><p>two</article><footer>f") == "T\n\none\n\ntwo"
    assert main('<article><p>x<a href="never ends>y</p></article><p>z') != ""


@pytest.mark.parametrize("piece", ["<a ", "<a<", '<a "', "<div>", "<script>", "<!--", "</", "&amp", "<p>x", "<article>", "</div>"])
def test_time_is_linear(piece):
    began = time.time()
    main(piece * 100_000)
    assert time.time() - began < 6


def test_articles_are_whole_whatever_their_blocks():
    r = random.Random(4)
    for _ in range(200):
        parts = [" ".join(f"w{r.randint(0, 99)}" for _ in range(r.choice([1, 2, 3, 8, 30, 200]))) for _ in range(r.randint(1, 9))]
        page = "<nav><a>m</a></nav><article>" + "".join(f"<p>{p}</p>" for p in parts) + "</article><footer>" + parts[0] + "</footer>"
        assert main(page) == "\n\n".join(parts)


def test_layout_classes_name_nothing():
    assert main('<div class="page has-sidebar no-comments"><article><p>Kept.</p></article></div>') == "Kept."
    assert main('<div class="sidebar"><article><p>Gone.</p></article></div><article><p>Kept.</p></article>') == "Kept."


def test_tree_learns_its_table():
    rows = H.labelled()
    assert sum(H.classify(TREE, r[:-1]) == bool(r[-1]) for r in rows) / len(rows) > 0.99


def test_rows(spark):
    data = [(1, "u", PAGE, "x", 3), (1, "u", PAGE, "x", 3), (2, None, None, None, None), (None, "v", "<article>" + "<p>long text</p>" * 50_000 + "</article>", None, None)]
    schema = "page_id long, url string, html string, text string, n_chars long"
    found = H.extract(spark.createDataFrame(data, schema)).collect()
    assert len(found) == 4 and all(r.n_chars == len(r.text) for r in found)
    assert {r.page_id: r.text for r in found}[2] == ""
    assert max(r.n_chars for r in found) == 50_000 * 11 - 2
    assert H.extract(spark.createDataFrame([], schema)).count() == 0


def slow_blocks(html):
    """Text blocks of a page's article by the standard library's parser: what is in article, and in no chrome or named boilerplate."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.now, self.stack, self.skip = [], [], [], 0

        def end(self):
            text = " ".join("".join(self.now).split())
            if text and any(n == "article" for n, _ in self.stack) and not any(bad for _, bad in self.stack):
                self.out.append(text)
            self.now = []

        def handle_starttag(self, name, attrs):
            if name in ("script", "style", "title"):
                self.skip += 1
                return
            if name in ("p", "h1", "h2", "h3", "li", "div", "article", "nav", "footer", "aside", "section", "form", "header", "ul", "body", "html", "head"):
                self.end()
            if name in ("br", "img", "input"):
                self.now.append(" ")
            if name in ("div", "article", "nav", "footer", "aside", "section", "form", "header", "ul"):
                names = " ".join(v or "" for k, v in attrs if k in ("class", "id")).split()
                self.stack.append((name, name in ("nav", "footer", "aside", "form") or any(x in ("ad", "comments", "cookie", "notice", "sidebar", "share") for x in names)))

        def handle_endtag(self, name):
            if name in ("script", "style", "title"):
                self.skip -= 1
                return
            if name in ("p", "h1", "h2", "h3", "li", "div", "article", "nav", "footer", "aside", "section", "form", "header", "ul", "body", "html", "head"):
                self.end()
            if any(n == name for n, _ in self.stack):
                while self.stack.pop()[0] != name:
                    pass

        def handle_data(self, data):
            if not self.skip:
                self.now.append(data)

    reader = Reader()
    reader.feed(html or "")
    reader.close()
    reader.end()
    return reader.out


def test_every_page_against_a_slow_version(spark, small):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    found = {r.page_id: r.text for r in H.extract(spark.read.parquet(f"{small}/pages.parquet")).collect()}
    assert found == {k: "\n\n".join(slow_blocks(html)) for k, html in pages.items()}


def test_share_that_text_decides(spark, small):
    """Link density is asked of every block, and with the neighbours' it settles a fifth of them or more without the place."""
    rows = [row for r in spark.read.parquet(f"{small}/pages.parquet").collect() for row in H.features(H.blocks(r.html))]
    paths = [H.path(TREE, row) for row in rows]
    text = H.FEATURES[: H.TEXT_FEATURES]
    assert all(p[0] in text for p in paths)
    assert sum(all(x in text for x in p) for p in paths) / len(paths) > 0.2


LONG = "This is a paragraph with quite a few words that tells of something at some length, as an author would. "
#: Pages without articles and telling names; lines are blocks: + main text or not, then the markup.
VARIED = [
    """- <table><tr><td><a href=1>Start</a></td><td><a href=2>News</a></td><td><a href=3>About us</a></td></tr></table>
+ <div><h1>What happened on the river</h1>
+ <p>{L}{L}</p>
+ <p>{L}<a href=x>a source</a></p>
+ <p>{L}{L}{L}</p></div>
- <div><a href=1>Older entry</a> <a href=2>Newer entry</a></div>
- <div><a href=1>Terms of use</a></div>""",
    """- <ul><li><a href=1>One</a></li>
- <li><a href=2>Two</a></li>
- <li><a href=3>Three things</a></li></ul>
+ <div class=x1><div class=x2>{L}{L}</div>
+ <div class=x2>{L}</div>
+ <div class=x2>{L}{L}{L}{L}</div></div>
- <div class=x3><a href=4>You may like this one too</a></div>
- <div class=x3><a href=5>And this one as well</a></div>
- <div class=x4>(c) 2024 Somebody</div>""",
    """- <div><a href=/><div>Logo and name</div></a></div>
- <div><a href=/a><div>Section one</div></a></div>
- <div><a href=/b><div>Section two</div></a></div>
+ <h2>A heading of some words</h2>
+ <p>{L}</p>
+ <p>{L}{L}</p>
+ <h3>Another</h3>
+ <p>{L}{L}</p>
+ <p>A short line.</p>
+ <p>{L}{L}{L}</p>
- <p><a href=z>Imprint</a> <a href=y>Contact</a> <a href=q>Help</a></p>""",
]


def test_accuracy_on_pages_that_name_nothing():
    right = n = 0
    for lines in VARIED:
        lines = [x.split(" ", 1) for x in lines.replace("{L}", LONG).splitlines()]
        page = H.blocks("\n".join(x for _, x in lines))
        want = [label == "+" for label, x in lines for _ in range(len(H.blocks(x)))]
        got = [H.classify(TREE, row) for row in H.features(page)]
        assert len(want) == len(got)
        right, n = right + sum(a == b for a, b in zip(want, got, strict=True)), n + len(got)
    assert right / n >= 0.9


def held_out_page(r):
    """A page of a random layout that names nothing: link lists, prose with headings, more link lists, small print."""
    words = lambda n: " ".join(r.choice(LONG.split()) for _ in range(n))
    wrap = r.choice(["<p>%s</p>", "<div>%s</div>", "<div class=z9>%s</div>", "<section><p>%s</p></section>"])
    link = r.choice(["<li><a href=x>%s</a></li>", "<td><a href=x>%s</a></td>", "<div><a href=x>%s</a></div>", "<a href=x><div>%s</div></a>"])
    lines = [("-", link % words(r.randint(1, 4))) for _ in range(r.randint(3, 9))]
    lines.append(("+", f"<h{(k := r.randint(1, 2))}>{words(r.randint(3, 9))}</h{k}>"))
    for _ in range(r.randint(4, 10)):
        if r.random() < 0.2:
            lines.append(("+", f"<h3>{words(r.randint(2, 6))}</h3>"))
        lines.append(("+", wrap % (words(r.randint(25, 150)) + (f" <a href=y>{words(2)}</a>" if r.random() < 0.3 else ""))))
    lines += [("-", link % words(r.randint(2, 12))) for _ in range(r.randint(2, 7))]
    if r.random() < 0.5:
        lines.append(("-", wrap % f"(c) {words(r.randint(2, 5))}"))
    return lines


def test_accuracy_on_held_out_pages_of_many_layouts():
    right = n = 0
    for seed in range(60):
        lines = held_out_page(random.Random(seed))
        page = H.blocks("\n".join(x for _, x in lines))
        assert len(page) == len(lines)
        got = [H.classify(TREE, row) for row in H.features(page)]
        right, n = right + sum(g == (label == "+") for g, (label, _) in zip(got, lines, strict=True)), n + len(lines)
    assert n > 800 and right / n >= 0.93, right / n


def test_links_that_hold_blocks_count():
    assert [b.links for b in H.blocks("<div><a href=1><div>all of it</div></a></div><p>not this <a>but</a> here<p>and <a href=x>open<p>not here")] == [1.0, 0.25, 0.5, 0.0]
