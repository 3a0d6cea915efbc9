import random
import re
import time

import pytest

from millrace.llm.html_text import extract, main_text


@pytest.mark.parametrize("html, text", [
    (None, ""),
    ("", ""),
    ("<article><h1>T &amp; U</h1><p>a  b\n c<p>d</article><footer>f</footer>", "T & U\na b c\nd"),
    ("<nav>n</nav><article><p>x<script>if (a < b) {}</script><style>p{}</style> y<!-- <p>no --></p></article>", "x y"),
    ("<article><p>a<form><input value=1><label>no</label></form></p><aside>no</aside><p>b</p></article>", "a\nb"),
    ("<article><header><h1>T</h1></header><p>a</p><section id='comments'><p>no</p></section></article>", "T\na"),
    ("<div class='cookie-notice'>no</div><article><p>1 &lt; 2 &#x41;&nbsp;B</p></article><article class='comment'>no</article>", "1 < 2 A B"),
    ("<article><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></article>", "x\ny\n1\n2"),
    ("<article><p>cut &am", "cut &am"),
    ("<article><p>cut <b", "cut"),
    ("<article><p>a < b</p></article>", "a < b"),
])
def test_marked_article(html, text):
    assert main_text(html) == text


def test_surge_and_dive():
    prose = ["word " * 40, "short.", "more " * 50]
    links = "".join(f"<li><a href='/{i}'>link number {i}</a></li>" for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><h2>Title</h2>" + "".join(f"<p>{p}</p>" for p in prose) + f"<ul>{links}</ul></body>"
    assert main_text(page) == "\n".join(["Title", *(p.strip() for p in prose)])


def test_table(spark):
    rows = [(1, "u", "<article>a</article>", "x"), (2, None, None, "y"), (2, None, None, "y"), (None, "v", "<article>" + "é" * 300_000 + "</article>", "z")]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, text string")
    got = sorted(tuple(r) for r in extract(df).select("n_chars", "url").collect() if r["url"]), extract(df).count()
    assert got == ([(1, "u"), (300_000, "v")], 4)
    assert extract(df.limit(0)).count() == 0


def links(n, name="other"):
    return "<ul>" + "".join(f"<li><a href='/{i}'>{name} {i}</a></li>" for i in range(n)) + "</ul>"


def test_link_lists_in_a_marked_article():
    a, b = "word " * 40, "more " * 30
    page = f"<article><h1><a href='/p'>Title</a></h1><p>{a}</p><p>short.</p>{links(8)}<p>{b}</p><p>by <a href='/x'>X</a></p>{links(8)}<div>Buy now</div>{links(8)}</article>"
    listed = [f"other {i}" for i in range(8)]
    assert main_text(page) == "\n".join(["Title", a.strip(), "short.", *listed, b.strip(), "by X", *listed, "Buy now", *listed])
    assert main_text(f"<article>{links(8)}<p>{a}</p></article>") == a.strip()
    assert main_text(f"<article>{links(2)}</article>") == "other 0\nother 1"


def test_lines_that_are_only_a_link_do_not_split():
    a, b, c = "word " * 500, "more " * 400, "last " * 60
    page = f"<body>{links(9)}<p>{a}</p><h3><a href='/x'>only a link</a></h3><p>{b}</p>{links(3)}<p>{c}</p>{links(9)}</body>"
    assert main_text(page) == "\n".join([a.strip(), "only a link", b.strip(), "other 0", "other 1", "other 2", c.strip()])
    assert main_text(f"<body><p>{a}</p>{links(9)}<p>{b}</p>{links(9)}<p>note</p></body>") == "\n".join([a.strip(), b.strip(), "note"])
    assert main_text(f"<body><p>{a}</p>{links(9)}<div>imprint</div><div><p>elsewhere</p></div></body>") == a.strip()


@pytest.mark.parametrize("wrapper", ["class='content-sidebar-wrap'", "class='layout sidebar-right'", "class='post category-legal'", "class='single-post comments-open'", "class='tag-search'", "id='social'", "class='widget promo'"])
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<main>{}</main>", "{}"])
def test_wrappers_are_not_set_aside(wrapper, inner):
    text = "word " * 60
    body = inner.format(f"<p>{text}</p><div class='cookie-notice'>no</div><aside>no</aside>")
    page = f"<nav>no</nav><div {wrapper}>{body}</div><section id='comments'><p>{'no ' * 500}</p></section><footer>no</footer>"
    assert main_text(page) == text.strip()
    assert main_text(f"<form>{page}</form>") == text.strip()


def test_cards_do_not_keep_what_holds_them():
    page = f"<div><p>{'word ' * 60}</p></div><aside class='related'><article><p>a card</p></article></aside>"
    assert main_text(page) == ("word " * 60).strip()


def test_quotes_in_unquoted_values():
    assert main_text("<article><p data-x=don't>One two.</p><p class=a'b title=\"x>y\">It's the end &amp; so on.</p></article>") == "One two.\nIt's the end & so on."
    assert main_text("<article><p a=b=\"c>One</p><p ' \">two</p></article>") == "One\ntwo"
    assert main_text("<article><p data-x='class=ad' data-y=\"id='nav'\">kept</p><p CLASS = ad>gone</p></article>") == "kept"


def test_references_and_closing_paragraph():
    body = "<p>" + "word " * 50 + "</p><ol>" + "".join(f"<li><a href='/{i}'>Reference {i}</a></li>" for i in range(6)) + "</ol><p>Closing remark.</p>"
    assert main_text(f"<article>{body}</article>") == "\n".join([("word " * 50).strip(), *[f"Reference {i}" for i in range(6)], "Closing remark."])


@pytest.mark.parametrize("page", [
    "<div class=ad>" * 20_000 + "x", "<span>" * 20_000 + "</b>" * 20_000, "<p><span>" * 20_000, "<span>" * 20_000 + "<hr>" * 20_000,
    "<table><tr><td>" * 7_000 + "</b>" * 20_000, "<b><table>" + "<span>" * 20_000 + "</b>" * 20_000, "<ul><li>" * 10_000 + "text", "<article>" * 20_000 + "x",
    "<a href=x>" * 20_000 + "<li>" * 20_000, "<!--" * 20_000, "<p a='" * 20_000, "</p>" * 20_000, "<form><div class=promo>" * 10_000 + "text " * 20,
])
def test_time_grows_with_the_page(page):
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 3


def generated(seed):
    """A page with clutter of every kind around and inside an article whose blocks are known."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9)))
    words = lambda n: " ".join(word() for _ in range(n))
    clutter = [
        lambda: f"<nav><ul>{''.join(f'<li><a href=#>{word()}</a>' for _ in range(6))}</ul></nav>", lambda: f"<aside class='sidebar'><p>{words(40)}</p></aside>",
        lambda: f"<div class=\"ad-box\"><p>{words(20)}</p></div>", lambda: f"<form action=x><label>{word()}</label><input name=q><button>{word()}</button></form>",
        lambda: f"<script>if (a < b) {{ x = '<p>{words(9)}</p>' }}</script>", lambda: f"<style>p > a {{}}</style><!-- <p>{words(5)}</p> -->",
        lambda: f"<div id=cookie-notice>{words(15)}</div>", lambda: f"<section class=\"comments\"><h3>{word()}</h3><p>{words(60)}</p></section>",
    ]
    outside = [lambda: f"<header><h2>{words(3)}</h2></header>", lambda: f"<footer><p>{words(12)}</p></footer>"]
    blocks, parts = [], []
    for _ in range(r.randint(3, 12)):
        kind = r.randrange(6)
        text = words(r.randint(1, 60))
        if kind == 0:
            parts.append(f"<h2>{text}</h2>")
        elif kind == 1:
            items = [words(r.randint(1, 9)) for _ in range(r.randint(1, 9))]
            parts.append(f"<ul>{''.join(f'<li>{x}' + ('</li>' if r.random() < 0.5 else '') for x in items)}</ul>")
            blocks += items
            continue
        elif kind == 2:
            parts.append(f"<blockquote>\n  <p>{text.replace(' ', chr(10), 1)}\n</blockquote>")
        elif kind == 3:
            linked = f"<a href='/x?a=1&amp;b=2'>{word()}</a>"
            parts.append(f"<p>{text} {linked} &amp; <em>{word()}</em>")
            blocks.append(re.sub("<[^>]*>", "", parts[-1][3:]).replace("&amp;", "&"))
            continue
        else:
            parts.append(f"<p data-n=it's>{text}" + ("</p>" if r.random() < 0.7 else ""))
        blocks.append(text)
        if r.random() < 0.4:
            parts.append(r.choice(clutter)())
    lead = "<p>" + words(40) + "</p>"
    blocks.insert(0, lead[3:-4])
    around = [r.choice(clutter + outside)() for _ in range(8)]
    inner = lead + "".join(parts)
    tag = r.choice(["article", "main"])
    return f"<html><head><title>{words(4)}</title></head><body>{''.join(around[:4])}<div class='wrap'><{tag}>{inner}</{tag}></div>{''.join(around[4:])}</body></html>", blocks


def test_generated_pages_give_their_article():
    for seed in range(300):
        page, blocks = generated(seed)
        assert main_text(page).split("\n") == blocks, (seed, page)
