import html
import re

import pytest

from ferrite.llm.common import table
from ferrite.llm.html import extracted, main_text, op9_html_density

MENU = "<ul class='menu'><li><a href=/a>Alpha</a></li><li><a href=/b>Beta</a></li></ul>"
BODY = "".join(f"<p>Sentence number {i} of the story that we want to keep, with <b>some</b> words more.</p>" for i in range(5))
STORY = " ".join(f"Sentence number {i} of the story that we want to keep, with some words more." for i in range(5))


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain  text\n here", "plain text here"), ("<p>a<p>b", "a b"), ("<div>" * 3000 + "x", "x"),
    (f"<html><body><header><h1>Site</h1></header>{MENU}<article><h1>Title</h1>{BODY}</article><footer>&copy; me</footer></body></html>", f"Title {STORY}"),
    (f"<body>{MENU}<div id=content>{BODY}</div><div class='cookie-notice'>We use cookies, a good many of them, on this site.</div>", STORY),
    (f"<article>{BODY}<form><p>Your name</p><input></form><section id=comments><p>First!</p></section></article><aside>More</aside>", STORY),
    (f"<main><script>var t='<p>no</p>';</script><style>p{{}}</style>{BODY}<nav>{MENU}</nav></main>", STORY),
    ("<article><p>A &amp; B &lt;C&gt; &#233;&nbsp;x<br>y</article>", "A & B <C> \u00e9 x y"),
    ("<article><p><b>open<br><p>next</p></article><footer>x</footer>", "open next"),
])
def test_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page, text", [
    (f"<div class='content-sidebar-wrap'><main>{BODY}</main></div>", STORY),
    (f"<body><div class='layout has-sidebar'>{MENU}<div>{BODY}</div><div class=sidebar><p>See also</p></div></div>", STORY),
    (f"<body><div class='single-post no-comments'>{BODY}</div><div id=comments><p>First!</p></div>", STORY),
    (f"<body><form id='aspnetForm'>{MENU}<div>{BODY}</div><form><p>Your name</p></form></form>", STORY),
    (f"<body><form id='aspnetForm'><article>{BODY}</article></form><form><p>Your name</p></form>", STORY),
    (f"<article>{BODY}<h2 id='Related_work'>Work</h2><section id='search-algorithms'><p>Trees.</p></section></article>", f"{STORY} Work Trees."),
    (f"<body><article>{BODY}</article><div class=comments>{'<p>A comment of some length on the story.</p>' * 20}</div>", STORY),
    (f"<body><article>{BODY}</article><div class=related><a href=/a>{'Another story ' * 90}</a></div>", STORY),
])
def test_marked_elements_go_only_if_their_text_agrees(page, text):
    assert main_text(page) == text


SHORT = "<p>Short story that we want.</p>"
NOTICE = "".join(f"<p>We and our {i} partners store cookies on your device, and you may say what you think of it here.</p>" for i in range(6))
COMMENTS = [f"<p>Comment {i}: a long and thoughtful remark on the story above, with thanks to its author.</p>" for i in range(10)]


@pytest.mark.parametrize("page, text", [
    (f"<body><article>{SHORT}</article><div class=cookie-banner>{NOTICE}</div>", "Short story that we want."),
    (f"<body><div>{SHORT}</div><div class=cookie-banner>{NOTICE}</div>", "Short story that we want."),
    (f"<article>{BODY}<div class=comments>{''.join(COMMENTS[:3])}</div></article>", STORY),
    (f"<article>{BODY}<section id=comments>{''.join(COMMENTS)}</section></article>", STORY),
    (f"<article>{SHORT}</article><ol class=commentlist>{''.join(f'<li><article class=comment>{c}</article>' for c in COMMENTS)}</ol>", "Short story that we want."),
    (f"<article>{SHORT}</article>{''.join(f'<article class=comment>{c}</article>' for c in COMMENTS)}", "Short story that we want."),
    (f"<main>{BODY}<div class='post-comments'>{''.join(COMMENTS)}</div></main>", STORY),
    (f"<body><div>{BODY}</div><div id=comments>{''.join(COMMENTS)}</div>", STORY),
    (f"<article>{SHORT}<form class=newsletter>{NOTICE}</form></article>", "Short story that we want."),
    (f"<article>{SHORT}<form>{NOTICE}</form></article>", "Short story that we want."),
    (f"<article>{SHORT}</article><div class='related-posts'><article>{NOTICE}</article></div>", "Short story that we want."),
    (f"<div role=banner>{NOTICE}</div><div><h1>T</h1>{SHORT}</div><div class='sidebar-widget'>{NOTICE}</div>", "T Short story that we want."),
    (f"<article class='post category-social has-sidebar'>{BODY}</article>", STORY),
    (f"<article><div class='has-sidebar'>{BODY}</div></article>", STORY),
    (f"<body><div class=widget>{BODY}</div>", STORY),  # nothing else remains
    (f"<body><div class='layout has-sidebar'><div>{BODY}</div><div class=sidebar>{NOTICE}</div></div><p>Imprint", STORY),
])
def test_what_is_marked_goes_whatever_its_size(page, text):
    assert main_text(page) == text


PARTS = ["".join(f"<p>Part {k}, sentence {i}, {'and so on, ' * (1 + k)}to its end.</p>" for i in range(6)) for k in range(3)]
SAID = [re.sub("<[^>]*>", " ", p) for p in PARTS]


def _said(*parts):
    return " ".join(" ".join(parts).split())


@pytest.mark.parametrize("page, text", [
    (f"<body>{MENU}<main><article>{PARTS[2]}</article><article>{PARTS[0]}</article></main>", _said(SAID[2], SAID[0])),
    (f"<main>{''.join(f'<article>{p}</article>' for p in PARTS)}</main><footer>x</footer>", _said(*SAID)),
    (f"<body>{MENU}<div><article>{PARTS[1]}</article><article>{PARTS[1]}</article></div>", _said(SAID[1], SAID[1])),
    (f"<body>{MENU}<article>{PARTS[0]}</article><div>{PARTS[2]}</div><p><a href=/a>More</a></p>", _said(SAID[0], SAID[2])),
    (f"<body>{MENU}<div>{PARTS[0]}</div><div>{PARTS[0]}</div><div><a href=/a>More</a> <a href=/b>Less</a></div>", _said(SAID[0], SAID[0])),
    (f"<body><div><div>{PARTS[1]}</div></div><ul><li><a href=/a>Alpha</a></li><li><a href=/b>Beta</a></li></ul>", _said(SAID[1])),
])
def test_several_dense_parts_with_and_without_article_tags(page, text):
    assert main_text(page) == text


def test_given_pages(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in table(spark, sf, "pages").collect()}
    got = op9_html_density(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        inside = pages[r.page_id].split("<article>")[1].split("</article>")[0].split("<footer>")[0]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>?", lambda m: "" if m[0] in ("<b>", "</b>") else " ", inside)).split())
        assert r.n_chars == len(r.text)


def test_nulls_clashes_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, None, "t"), (2, "u", "", "t"), (2, "u", "<p>x", "t")], "page_id long, url string, html string, Text string")
    assert sorted((r.page_id, r.text, r.n_chars) for r in extracted(df).collect()) == [(1, "", 0), (2, "", 0), (2, "x", 1)]
    assert extracted(df.filter("false")).count() == 0
