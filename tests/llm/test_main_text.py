import itertools
import random
import time

import pytest

from starloom.llm import main_text as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="page-sidebar">
<header><a href="/">Home</a><p>The name of the site</p></header><nav><ul><li><a href=x>One</a></ul></nav>
<div id="cookie-notice"><p>We use cookies to improve this page. Accept them now please.</p></div>
<div class="wrapper"><div class="content"><h2>Heading &eacute;</h2>
<p>First paragraph of the   text, with <b>some</b> words<br>and a break. It goes on &amp; on.</p>
<div class="ad-slot">Buy now! Cheap things for all people.</div><p>Short one.</p>
<ul><li>Item one of the list in the text.<li>Item two</ul><script>var t = "</p>";</script>
<form><label>Name</label><input><textarea>hello</textarea><button>Send</button></form></div></div>
<section id="comments"><div class="comment"><p>I liked this text very much. Thanks for all of it.</p></div></section>
<aside><p>Related reading of all sorts. Long text in the aside that goes on.</p></aside>
<footer>&copy; 2020 Someone. All rights reserved.</footer></body></html>"""


def test_page():
    assert H.main_text(PAGE).split("\n\n") == [
        "Heading é", "First paragraph of the text, with some words and a break. It goes on & on.",
        "Short one.", "Item one of the list in the text.", "Item two"]


@pytest.mark.parametrize("page,text", [
    ("", ""), ("plain text of no markup at all, but a sentence.", "plain text of no markup at all, but a sentence."),
    ("<article><h1>A title</h1><p><b>One two.<br><p>Three four.</article>", "A title\n\nOne two.\n\nThree four."),
    ("<article><p>a &lt;b&gt; &#233; &nbsp; c.</p></article>", "a <b> é c."),
    ("<article><p>Text before a < sign and 3<4 in it.</p></article>", "Text before a < sign and 3<4 in it."),
    ("<article><p>x is here.</p><!-- <p>not this</p> --><p>y is here.</p></article>", "x is here.\n\ny is here."),
    ("<nav>Only a menu here</nav>", ""), ("<script>never closed <p>text</p>", ""),
    ("<main><p hidden>Not shown to anyone.</p><p style='display: none'>Nor this.</p><p>Shown here.</p></main>", "Shown here."),
    ("<article><table><tr><td>a</td><td>b</td></tr></table><p>Text of it all.</p></article>", "a b\n\nText of it all."),
])
def test_small_pages(page, text):
    assert H.main_text(page) == text


@pytest.mark.parametrize("attributes", [
    'data-title="The hidden truth"', "title='hidden gems'", 'data-hidden="false"', "x-hidden",
    'data-class="the sidebar"', 'data-id="comments"', 'title="class=sidebar"', "title=a=hidden",
    'data-style="display:none"', 'alt = "x" title="a role=navigation b"', "title='a>b hidden'"])
def test_names_of_attributes_count_as_a_whole(attributes):
    page = f"<main><p {attributes}>A whole sentence stands here.</p></main>"
    assert H.main_text(page) == "A whole sentence stands here."


@pytest.mark.parametrize("attributes", [
    "hidden", "HIDDEN=''", "hidden=hidden", "a=b hidden", 'a="b"hidden', "a/hidden", "/hidden",
    'aria-hidden="true"', "title='x' class = 'sidebar'", "id=comments", "style='display : none'"])
def test_attributes_that_set_aside(attributes):
    assert H.main_text(f"<main><p {attributes}>Not this sentence.</p></main>") == ""


@pytest.mark.parametrize("part", [
    '<svg class="icon"/>', "<math/>", "<svg><path d='x'/><title/></svg>", "<div><object data=x></div>",
    "<div><canvas></div>", "<div><video src=x><p>Not shown.</div>", "<div><audio></div>",
    "<div><select><option>Not shown.</div>", "<div><template><p>Not shown.</p></div>"])
def test_elements_without_end_tag_end_with_their_parent(part):
    page = f"<article><p>One sentence is here.</p>{part}<p>Another one is here.</p></article>"
    assert H.main_text(page) == "One sentence is here.\n\nAnother one is here."


@pytest.mark.parametrize("part", [
    "<video><p>Not shown.</p></video>", "<svg><svg><text>No</text></svg><text>No</text></svg>",
    "<object><table><tr><td>No<tr><td>No</table><hr></object>", "<svg><title>No</title><g/></svg>"])
def test_hidden_content_does_not_cut_the_text_around(part):
    assert H.main_text(f"<article><p>One part {part}of a sentence.</p></article>") == (
        "One part of a sentence.")


def cost(labels, scores, edges):
    return sum(abs(s) for s, x in zip(scores, labels) if x != (s > 0)) + sum(
        w for i, j, w in edges if labels[i] != labels[j])


def test_minimum_cut_against_all_labellings():
    rng = random.Random(3)
    for _ in range(150):
        n = rng.randint(1, 9)
        scores = [rng.choice([0.0, rng.uniform(-2, 2)]) for _ in range(n)]
        edges = [(i, j, rng.uniform(0, 1.5)) for i, j in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        found = H.minimum_cut(scores, edges)
        best = min(cost(x, scores, edges) for x in itertools.product([False, True], repeat=n))
        assert cost(found, scores, edges) == pytest.approx(best)


@pytest.mark.parametrize("part", [
    '<td "', "<!--", "<a href='", "<b>", "<div>", "<p>a b<div>", "<li>a", "</script", "<script>", "&amp", "<"])
def test_hostile_pages_take_linear_time(part):
    start = time.perf_counter()
    H.main_text(part * (1_000_000 // len(part)))
    assert time.perf_counter() - start < 20


def test_columns(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE), (2, "v", None), (None, None, ""), (4, "w", PAGE), (4, "w", PAGE)],
        "page_id long, url string, html string").selectExpr("*", "1 AS text")
    rows = H.extract(pages).collect()
    assert [r["text"] for r in rows if r["html"] == PAGE] == [H.main_text(PAGE)] * 3
    assert [r["text"] for r in rows if r["html"] != PAGE] == ["", ""]
    assert H.extract(pages.limit(0)).count() == 0
