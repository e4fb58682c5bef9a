"""Main text of pages."""

import html
import re

from patchloom.llm.html_text import extracted, main_text

LONG = " ".join(["Words of the article go on for a good while here."] * 6)


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


def test_article_without_its_surroundings():
    text = main_text(page(
        "<nav><ul><li><a href='/a'>Menu</a></li></ul></nav><header><h1>Site</h1></header><div class='ad'>Buy</div>"
        f"<article><header><h1>Title</h1></header><p>First <b>bold</b>,\n text &amp; more.</p><p>{LONG}<br>After</p>"
        "<form><input><label>Mail</label></form><script>var x='<p>';</script><aside>Side</aside>"
        "<div class='share-buttons'><a>Share</a></div></article>"
        "<div id='comments'><p>Nice one, says a reader.</p></div><div class='cookie-notice'>We use cookies.</div><footer>&copy; me</footer>"))
    assert text == f"Title First bold, text & more. {LONG} After"


def test_pages_without_an_article_element():
    links = "".join(f"<li><a href='/{i}'>Link number {i}</a></li>" for i in range(12))
    text = main_text(page(f"<div><ul>{links}</ul></div><div class='has-sidebar'><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></div><div>{links}</div>"))
    assert text == f"Title {LONG} {LONG}"


def test_an_article_in_parts_is_whole():
    links = "".join(f"<li><a href='/{i}'>Link number {i}</a></li>" for i in range(12))
    parts = [[f"Paragraph {i} of part {k}. {LONG}" for i in range(10)] for k in range(3)]
    blocks = ["".join(f"<p>{p}</p>" for p in part) for part in parts]
    whole = " ".join(p for part in parts for p in part)
    assert main_text(page(f"<div><ul>{links}</ul></div><div class='content'>{''.join(f'<section>{b}</section>' for b in blocks)}</div><div>{links}</div>")) == whole
    nested = f"<div>{blocks[0]}</div><div><div>{blocks[1]}</div><div>{blocks[2]}</div></div>"
    assert main_text(page(f"<ul>{links}</ul>{nested}<div>Small print</div>")) == whole


def test_names_do_not_cut_what_carries_the_page():
    aside = "<div class='sidebar'><p>Other things</p></div><div class='comments'><article class='comment'>Nice</article></div>"
    inner = f"<div class='entry-header'><h1>Title</h1></div><p>{LONG}</p><p>{LONG}</p>"
    for name in ("class='content-sidebar-wrap'", "id='main-sidebar-layout'", "class='search social'"):
        assert main_text(page(f"<div {name}><article>{inner}</article>{aside}</div>")) == f"Title {LONG} {LONG}", name
        assert main_text(page(f"<div {name}><div><p>{LONG}</p><p>{LONG}</p></div>{aside}</div>")) == f"{LONG} {LONG}", name
    assert main_text(page(f"<div class='page-header'>Site</div><article><p>{LONG}</p></article><div class='comments'><p>{LONG} {LONG}</p></div>")) == LONG


def test_a_short_article_beside_the_text_loses():
    teaser = "<article class='teaser'><h2>Other story</h2><p>Two words of it.</p></article>"
    story = f"<div><h1>Title</h1><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>"
    assert main_text(page(teaser + story)) == f"Title {LONG} {LONG} {LONG}"
    plain = teaser.replace(" class='teaser'", "")
    assert f"Title {LONG} {LONG} {LONG}" in main_text(page(plain + story))


def test_several_articles_are_all_there():
    first, second = (f"<article><h2>Part {i}</h2><p>{LONG}</p></article>" for i in (1, 2))
    whole = f"Part 1 {LONG} Part 2 {LONG}"
    menu = "<div><a href='/'>Home</a> <a href='/a'>About</a></div><div>Small print</div>"
    assert main_text(page(menu + first + second)) == main_text(page(f"<main>{first}{second}</main>" + menu)) == whole


def test_links_inside_the_content_stay():
    link = "<p><a href='/r'>Read the full report here</a></p>"
    sources = "<h2>Sources</h2><ul><li><a href='/1'>Source one</a></li><li><a href='/2'>Source two</a></li></ul>"
    whole = f"{LONG} Read the full report here {LONG} Sources Source one Source two"
    for tag in ("article", "div", "main"):
        assert main_text(page(f"<ul><li><a href='/'>Home</a><li><a href='/b'>B</a></ul><{tag}><p>{LONG}</p>{link}<p>{LONG}</p>{sources}</{tag}>")) == whole, tag
    # without any container, lists of links are menus unless a heading stands over them
    assert main_text(page(f"<ul><li><a href='/'>Home</a><li><a href='/b'>B</a></ul><p>{LONG}</p>{link}<p>{LONG}</p>{sources}")) == whole


def test_loose_names_do_not_cut_parts_of_the_content():
    parts = ["<section class='discussion'><p>What follows from it.</p></section>", "<p class='legal'>The law says so.</p>", "<p class='notice'>Mind this.</p>",
             "<div class='widget'>A part of the text.</div>", "<div class='form'>The form it took.</div>"]
    for tag in ("article", "div"):
        for part in parts:
            inner = re.sub("<[^>]*>", "", part)
            assert main_text(page(f"<{tag}><p>{LONG}</p>{part}<p>{LONG}</p></{tag}>")) == f"{LONG} {inner} {LONG}", part
    widget = "<div class='widget'><ul><li><a href='/1'>One</a></li><li><a href='/2'>Two</a></li></ul></div>"
    shares = "<div class='share'>Share this</div><div class='comments'><p>First!</p></div><div class='ad'>Buy</div><form>Mail</form>"
    assert main_text(page(f"<article><p>{LONG}</p>{widget}{shares}</article><p class='notice'>Cookies</p>")) == LONG


def test_densities_equal_a_plain_version():
    import math
    import random

    from patchloom.llm import html_text

    rng = random.Random(9)

    def made(depth):
        tag = rng.choice(["div", "a", "b", "section"]) if depth else "body"
        inner = [made(depth + 1) if depth < 4 and rng.random() < 0.5 else "w" * rng.randrange(1, 60) for _ in range(rng.randrange(1, 5))]
        return tag, inner

    def source(n):
        return n if isinstance(n, str) else f"<{n[0]}>" + "".join(map(source, n[1])) + f"</{n[0]}>"

    def counts(n, linked=False):
        if isinstance(n, str):
            return len(n), 0, len(n) if linked else 0, 0
        linked = linked or n[0] == "a"
        inner = [counts(x, linked) for x in n[1]]
        kids = [x for x in n[1] if not isinstance(x, str)]
        return (sum(i[0] for i in inner), sum(i[1] for i in inner) + len(kids), sum(i[2] for i in inner),
                sum(i[3] for i in inner) + sum(k[0] == "a" for k in kids))

    def density(n, share, linked):
        c, t, lc, lt = counts(n, linked)
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        return c / max(t, 1) * max(math.log(c * max(t, 1) / (max(lc, 1) * max(lt, 1))), 0) / base

    def walk(n, linked=False):
        yield n, linked
        for x in n[1]:
            if not isinstance(x, str):
                yield from walk(x, linked or n[0] == "a")

    def unnested(n, inside=False):
        return all(unnested(x, inside or n[0] == "a") for x in n[1] if not isinstance(x, str)) and not (inside and n[0] == "a")

    tried = 0
    while tried < 60:
        want = made(0)
        if not unnested(want):
            continue
        tried += 1
        root = html_text.tree(source(want))
        nodes = html_text._measure(root)
        body = next(n for n in nodes if n.tag == "body")
        html_text._score(list(html_text._within(body)), body)
        c = counts(want)
        share = c[2] / c[0]
        plain = [(n[0], density(n, share, linked)) for n, linked in walk(want)]
        assert [(n.tag, n.density) for n in html_text._within(body)] == [(t, d) for t, d in plain]
        assert body.sum == sum(density(x, share, False) for x in want[1] if not isinstance(x, str))


def test_broken_markup():
    assert main_text("<p>One<p>Two <b>three<br><p>four</article> 1 < 2") == "One Two three four 1 < 2"
    assert main_text("<article><p>a<!-- <p>no --> b <![CDATA[x]]> c<?php ?> d") == "a b c d"
    assert main_text("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table><script>never ends") == "one two a b c"
    assert main_text("<article><a title='x > y'>in</a><textarea>no</textarea>side") == "inside"
    assert main_text("plain text &eacute;&#233;&nbsp;x") == "plain text éé x"
    assert main_text(None) == main_text("") == main_text("<nav>x</nav>") == ""
    assert main_text("<div>" * 20_000 + "deep") == "deep"
    assert main_text("<article>" + "x<b>" * 20_000).startswith("xxx")


def test_hostile_text_takes_linear_time():
    for bit in ("<", "<a", "<!--", "</p", "<a '", "&", "<p>", "<script>"):
        main_text(bit * 50_000)


def test_driver_pages(spark, sf_dir):
    rows = extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"), ["page_id", "html"]).collect()
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", r.row.html, re.S)[1]
        inner = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", inner))
        assert r.text == " ".join(html.unescape(inner).split()) and r.n_chars == len(r.text)
    assert rows


def test_rows(spark):
    df = spark.createDataFrame([(1, page("<article>a</article>"), "x"), (2, None, "y"), (None, "", None), (1, page("<article>a</article>"), "x")],
                               "page_id long, html string, text string")
    assert [(r.row.page_id, r.text, r.n_chars) for r in extracted(df, ["page_id", "text"]).collect()] == [(1, "a", 1), (2, "", 0), (None, "", 0), (1, "a", 1)]
    assert extracted(df.limit(0), ["page_id"]).count() == 0
