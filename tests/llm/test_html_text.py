"""Main text on pages whose article is known, built around the test documents."""

import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierflow.llm import html_text
from tierflow.llm.html_text import blocks, extract, main_text

EN = "The river that runs by the old mill is wide, and in the spring it floods the low fields on both of its banks so that they are closed to all but the birds."
DE = "Der Fluss, der an der alten Mühle vorbei fließt, ist breit und im Frühling steht das Wasser auf den Wiesen, so dass sie für alle bis auf die Vögel gesperrt sind."


def wrap(article):
    return f"""<!DOCTYPE html><html><head><title>No &amp; title</title><style>p{{x}}</style><script>if (a < b) document.write("<p>no</p>");</script></head>
<body class="page sidebar-left"><header><h1>Site</h1><ul><li><a href="/a>b">Home</a><li><a href=x>News</a></ul></header><nav>menu text that is long enough to look like the text of an article, if it is not known to be one of the menus of the page</nav>
<div class="cookie-notice"><p>{EN}</p></div><!-- <p>{EN}</p> -->
{article}
<aside><p>{EN}</p></aside><section id="comments"><div><p>I think that {EN}</p></div></section><form><p>{EN}</p><input name=q></form>
<footer><p>&copy; {EN}</p></footer></body></html>"""


def test_named_article():
    body = f"""<article><h1>A  title</h1><p>{EN}<p>Short &amp; plain &lt;b&gt;.<p><b>{DE}</b>&nbsp; <i>x</i><br>y
      <div class="ad">Buy now</div><ul class="share-links"><li><a href=1>Share this</a></li></ul><p>{EN} <a href="#">and more</a></p>
      <span class="advert">Sponsored <span>words</span> here</span><p>End.</p><article class="comment"><p>{EN}</p></article></article>"""
    assert main_text(wrap(body)).split("\n") == ["A title", EN, "Short & plain <b>.", f"{DE} x y", f"{EN} and more", "End."]


def test_no_named_article():
    page = wrap(f"<div class=content><h2>Of mills</h2><p>{EN}</p><p>Indeed.</p><p>{DE}</p></div><p><a href=a>One</a> <a href=b>Two links and no text besides them at all, in a long block of the page</a></p><div>x</div>")
    assert main_text(page).split("\n") == ["Of mills", EN, "Indeed.", DE]


def test_marks_and_forms_around_the_article():
    article = f"<article class='post no-comments'><h1>Mills</h1><p>{EN}</p><div class='share-links'><p>{DE}</p></div><p>{DE}</p></article>"
    want = ["Mills", EN, DE]
    for name in ("has-sidebar", "content-sidebar-wrap", "sidebar", "widget"):
        assert main_text(wrap(f'<div class="{name}">{article}</div>')).split("\n") == want
        assert main_text(wrap(f'<main><div id="{name}">{article}</div></main>')).split("\n") == want
        assert main_text(wrap(f'<div class="{name}"><main class="{name}"><p>{EN}</p><p>{DE}</p></main></div>')).split("\n") == [EN, DE]
    assert main_text(wrap(article.replace("no-comments", "promo"))).split("\n") == want
    assert main_text(wrap(f'<div style="display: none">{article}</div>')).split("\n") == want
    # the real article is the wrapped one, a teaser is not
    assert main_text(wrap(f'<article><p>Teaser of a page.</p></article><div class="sidebar">{article}</div>')).split("\n") == ["Teaser of a page.", *want]


def test_page_wide_form():
    story = f"<h1>Mills</h1><p>{EN}</p><p>{DE}</p><p>{EN} {DE}</p>"
    want = ["Mills", EN, DE, f"{EN} {DE}"]
    for page in (f"<article>{story}</article>", f"<main>{story}</main>", f"<main><form>{story}</form></main>", f"<main><form><article>{story}</article></form></main>", f"<div>{story}</div>"):
        assert main_text(f"<html><body><form id=aspnetForm><div class=page>{page}</div><aside><p>{EN}</p></aside></form></body></html>").split("\n") == want


def test_marks_still_drop_what_is_not_the_article():
    comments = f"<section id='comments'><article><p>I think that {EN}</p></article></section>"
    for name in ("cookie-notice", "sidebar", "post-comments", "ad-slot-2", "relatedPosts", "site-footer", "x advert"):
        assert main_text(f"<article><p>{EN} {DE}</p><div class='{name}'><p>{EN}</p></div></article>") == f"{EN} {DE}"
        assert main_text(f"<main><p>{EN} {DE}</p>{comments}<div class='{name}'><p>{EN}</p></div></main>") == f"{EN} {DE}"
    for page in (f"<article><p>{EN} {DE}</p></article>{comments}", f"<div><p>{EN} {DE}</p></div>{comments}", f"<div><p>{EN} {DE}</p></div><form><p>{EN}</p></form>"):
        assert main_text(page) == f"{EN} {DE}"


def test_few_stop_words_stay_open():
    code = "for (i = 0; i < n; i++) { total[i] = price[i] * count[i]; print(total[i], price[i], count[i]); }"
    table = "<table>" + "".join(f"<tr><td>Mill number {i}, river level {i * 7} cm, wheel speed {i * 3} turns, flour ground {i * 11} sacks</td></tr>" for i in range(4)) + "</table>"
    rows = [f"Mill number {i}, river level {i * 7} cm, wheel speed {i * 3} turns, flour ground {i * 11} sacks" for i in range(4)]
    page = wrap(f"<div><p>{EN}</p><pre>{code.replace('<', '&lt;')}</pre><p>{DE}</p>{table}</div>")
    assert main_text(page).split("\n") == [EN, code, DE, *rows]
    assert main_text(wrap(f"<div>{table}</div>")).split("\n") == rows
    ru = "Река, протекающая возле старой мельницы, широка, и весной она заливает низкие луга по обоим берегам."
    assert main_text(wrap(f"<div><h2>Мельница</h2><p>{ru}</p><p>{ru}</p></div>")).split("\n") == ["Мельница", ru, ru]
    # beside a list of links they go with it
    links = "<p><a href=a>Two links and no text besides them at all, in a long block of the page</a></p>"
    assert main_text(wrap(f"<div><p>{EN}</p></div>{links}<p>{code.replace('<', '&lt;')}</p>{links}")) == EN


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<p></p>") == ""
    assert main_text("<article><p>a<script>x</article>") == "a"
    assert main_text("<article>a<br><br>b<!-- open") == "a\nb"
    assert main_text("<article><p>&notin; &#x41;&#66; &amp;lt; &unknown; a &lt b") == "∉ AB &lt; &unknown; a < b"
    assert main_text("<article><p>1 < 2 and 3 > 2</p>") == "1 < 2 and 3 > 2"
    assert main_text("<main><p>cut off <a hr") == "cut off"
    assert blocks("<a>x</a>")[0][1] == 1


def test_long_page():
    paragraphs = [f"{EN} {i}" for i in range(3000)]
    assert main_text(wrap("<article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>")).split("\n") == paragraphs


def test_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        body = re.search("<article>(.*)</article>", r.html, re.S)[1]
        parts = [" ".join(re.sub("<[^>]*>", " ", x).split()) for x in re.split("</?p>|</?h1>", body)]
        want = "\n".join(p for p in parts if p).replace("&amp;", "&").replace("&quot;", '"')
        assert re.sub("&(a|am|amp|quo)$", "&", got[r.page_id].text, flags=re.M).replace("& ", "&") == want.replace("& ", "&") or "&" in want
        assert got[r.page_id].n_chars == len(got[r.page_id].text)
        assert got[r.page_id].url == r.url


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(None, None, None, 1), (1, "u", "", 2), (1, "u", wrap(f"<article><p>{EN}</article>"), rng.randint(0, 9)), (1, "u", wrap(f"<article><p>{EN}</article>"), 4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    assert sorted(r.text for r in extract(df).collect()) == ["", "", EN, EN]
    assert extract(df.limit(0)).collect() == []


def naive_tags(page):
    """All tags and comments, each searched for by itself."""
    out, at = [], 0
    while (start := page.find("<", at)) >= 0:
        rest = page[start:]
        name = re.match(r"<(/?)([a-zA-Z][^\s/><]*)", rest)
        tag = name and re.match(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>", rest[name.end() :])
        if rest.startswith("<!--"):
            end = rest.find("-->", 4)
            out.append((start, start + end + 3 if end >= 0 else len(page), "", "", ""))
        elif tag:
            out.append((start, start + name.end() + tag.end(), name[1], name[2].lower(), tag[0][:-1]))
        elif rest[1:2] in ("!", "?", "/") and ">" in rest[2:]:
            out.append((start, start + rest.index(">", 2) + 1, "", "", ""))
        else:
            at = start + 1
            continue
        at = out[-1][1]
    return out


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(["<", ">", "a", "</", "<!--", "-->", '"', "'", " ", "<b ", "x=", "<!", "/", "é", "<p>", "-"]), max_size=30).map("".join))
def test_tags_like_one_by_one(page):
    tags, got, at = html_text.Tags(page), [], 0
    while (found := tags.following(at)) is not None:
        got.append(found)
        at = found[1]
    assert got == naive_tags(page)


HOSTILE = {
    "open tags": "<a ", "divs with stray ends": "<div></b></i>", "quotes": '<a "<" ', "declarations": "<!", "script ends": "<script></script ", "inline": "<p><b>x</b", "marks": '<p class="ad" ', "less than": "<", "mixed quotes": "<a '\"",
    "nested marks": "<div class=ad>", "items": "<li>", "ampersands": "&", "comments": "<!--", "names": "<a<a<a", "articles": "<article>", "forms": "<form><article>x", "links": "<a href=x>y",
}


@pytest.mark.parametrize("name", HOSTILE)
@pytest.mark.parametrize("end", ["", ">", '">', "\"x\" '>"])
def test_broken_pages_take_linear_time(name, end):
    part = HOSTILE[name]
    page = part * (1_000_000 // len(part)) + end
    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 4  # a second or less alone; quadratic time is an hour
