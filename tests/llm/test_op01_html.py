from html import escape

import pytest

from codefacts.llm import op01_html as H

PARA = ["The council met on Monday, and it approved the plan; nobody objected.",
        "Later, the mayor said: \"We are glad, truly.\" Others, however, were not so sure about it.",
        "Costs will rise by 4%, officials said. Work begins in May, weather permitting."]
ARTICLE = "".join(f"<p>{escape(p)}</p>" for p in PARA)
WANT = "\n".join(PARA)

NOISE = {
    "nav": "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>",
    "header": "<header><div>The Daily Post, all news, every day.</div></header>",
    "footer": "<footer>&copy; 2020 The Post, Inc. All rights reserved.</footer>",
    "aside": "<aside><p>Most read: ten things, some of which you know.</p></aside>",
    "ad": '<div class="ad">Buy now, save more, today only!</div>',
    "cookie": '<div id="cookie-notice"><p>We use cookies, as you know. Accept them, please.</p></div>',
    "form": "<form><label>Name</label><input><button>Send, please</button></form>",
    "script": "<script>var a = '<p>Not text, at all.</p>';</script><style>p { a: b; }</style>",
    "comment": "<!-- <p>Commented out, of course.</p> -->",
    "comments": '<section id="comments"><div class="comment"><p>First! I read this, and I liked it.</p></div></section>',
    "share": '<ul class="share-buttons"><li><a href=x>Tweet</a></li></ul>',
}


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", '<div class="content">%s</div>',
                                  "<div><div>%s</div></div>", "<table><tr><td>%s</td></tr></table>"])
@pytest.mark.parametrize("noise", sorted(NOISE))
def test_article_without_noise(wrap, noise):
    html = f"<!DOCTYPE html><html><head><title>T, t.</title></head><body>{NOISE[noise]}{wrap % ARTICLE}{NOISE[noise]}</body></html>"
    assert H.main_text(html) == WANT


def test_everything_at_once():
    body = "".join(NOISE.values()) + "<div class=content>" + ARTICLE + NOISE["ad"] + "</div>" + "".join(NOISE.values())
    assert H.main_text(f"<html><body>{body}</body></html>") == WANT


def test_noise_inside_the_article():
    assert H.main_text(f"<body><article>{ARTICLE}{NOISE['comments']}{NOISE['share']}{NOISE['form']}</article>") == WANT


def test_unlabelled_link_lists_lose_by_their_ratio():
    links = "".join(f"<div><a href={i}>Story number {i}</a></div>" for i in range(30))
    assert H.main_text(f"<body><div>{links}</div><div>{ARTICLE}</div><div>{links}</div></body>") == WANT


def test_headings_lists_and_inline_markup():
    html = "<article><h1>Big &amp; <i>bold</i></h1><p>One,<br>two\n\t three&nbsp;four.<ul><li>a, b<li>c &#233;</ul><p>end."
    assert H.main_text(html) == "Big & bold\nOne, two three four.\na, b\nc é\nend."


LONG = [f"{p} And so it went on, day after day, said witness {i}, until the end." for i in range(20) for p in PARA]
BODY = "".join(f"<p>{escape(p)}</p>" for p in LONG)


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", "<div id=x>%s</div>"])
def test_selected_blocks_outside_a_nested_body_stay(wrap):
    def page(inner):
        return H.main_text(f"<body>{NOISE['nav']}{wrap % inner}{NOISE['footer']}</body>").split("\n")
    lead, closing = PARA[0], PARA[1]
    head = f"<h1>Title</h1><p>{lead}</p>"
    assert page(f"{head}<div class=body>{BODY}</div><p>{escape(closing)}</p>") == ["Title", lead, *LONG, closing]
    short = "".join(f"<p>{escape(p)}</p>" for p in LONG[:3])
    assert page(f"<section class=a>{BODY}</section><section class=b><h2>More</h2>{short}</section>") == [*LONG, "More", *LONG[:3]]
    for tag, item in (("ul", "li"), ("blockquote", "p")):
        items = "".join(f"<{item}>{escape(p)}</{item}>" for p in LONG)
        assert page(f"{head}<{tag}>{items}</{tag}><p>{escape(closing)}</p>") == ["Title", lead, *LONG, closing]
    rows = "".join(f"<tr><td>{escape(p)}</td></tr>" for p in LONG)
    assert page(f"{head}<table>{rows}</table><p>{escape(closing)}</p>") == ["Title", lead, *LONG, closing]


def test_article_and_main_do_not_bypass_the_ratios():
    body = f"<div class=text>{BODY}</div>"
    teasers = "".join(f"<article><h3>Card {i}</h3><div>More of it.</div></article>" for i in range(6))
    assert H.main_text(f"<body>{body}<div class=cards>{teasers}</div></body>") == "\n".join(LONG)
    assert H.main_text(f"<body>{teasers}{body}</body>") == "\n".join(LONG)
    for side in ("<main><p>A side note.</p></main>", "<article><p>A side note.</p></article>", "<div role=main>Note</div>"):
        assert H.main_text(f"<body>{side}<div><div class=text>{BODY}</div></div></body>") == "\n".join(LONG)
    # blocks of an article have to pass the threshold too
    meta = "".join(f"<div class=meta>x{i}</div>" for i in range(4))
    assert H.main_text(f"<body><article><h1>Title</h1>{BODY}{meta}</article></body>") == "\n".join(["Title", *LONG])
    # and those outside are not lost for being outside
    assert H.main_text(f"<body><article>{BODY}</article><div>{BODY}</div></body>") == "\n".join([*LONG, *LONG])


@pytest.mark.parametrize("names", ["content has-sidebar", "page has-sidebar", "container right-sidebar",
                                   "wrapper no-sidebar", "layout with-sidebar site-main", "sharp-text", "comments",
                                   "hasSidebar", "skip widget"])
@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<div>%s</div>", "<main>%s</main>"])
def test_names_of_layout_wrappers_drop_nothing(names, wrap):
    inner = wrap % ARTICLE
    for attr in ("class", "id"):
        assert H.main_text(f'<body>{NOISE["nav"]}<div {attr}="{names}">{inner}</div></body>') == WANT
        assert H.main_text(f'<body><div {attr}="{names}">{inner}{NOISE["comments"]}{NOISE["ad"]}{NOISE["share"]}</div></body>') == WANT
    if names != "comments":
        other = "<div class=x>Some other words, not many.</div>"
        assert WANT in H.main_text(f'<body><div class="{names}">{inner}</div>{other}</body>')


def test_many_comments_and_largest_article():
    talk = f"<div id=comments>{BODY}</div>"
    assert H.main_text(f"<body><div>{ARTICLE}</div>{talk}</body>") == WANT
    assert H.main_text(f'<body><div class="right-sidebar"><article>{ARTICLE}</article></div>{talk}</body>') == WANT
    assert H.main_text(f"<body>{talk}</body>") == "\n".join(LONG)


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("   ", ""), ("<html><body></body></html>", ""), ("<script>x", ""), ("plain, text", "plain, text"),
    ("<article><p>Cut off, here &am", "Cut off, here &am"), ("<article><p>Cut off, tag <a hre", "Cut off, tag"),
    ("</p></div><article>a, b.</article></i>", "a, b."), ("a < b, and b > c.", "a < b, and b > c."),
    ("<p title='>'>x, y.</p>", "x, y."), ("<article><p>&lt;p&gt; stays, &amp;amp; too.</p>", "<p> stays, &amp; too."),
])
def test_odd_pages(html, text):
    assert H.main_text(html) == text


def test_very_long_and_deep_pages():
    assert H.main_text("<article>" + "<p>word, word.</p>" * 30_000 + "</article>").count("\n") == 29_999
    assert H.main_text("<div>" * 30_000 + "deep, text." + "</div>" * 30_000) == "deep, text."
    assert H.main_text("<p " + "a='" * 20_000) == ""
    assert H.main_text("<" * 50_000 + "!--" * 20_000) .startswith("<")


def test_path_scores_by_hand():
    blocks = [("a, b. c", 1, 1, "p", 0, True), ("x" * 10, 2, 1, "p", 10, True), ("link", 3, 2, "li", 4, True)]
    import math
    want = math.log1p(17 / 2) * math.log1p(1 + 2 / 2) * (1 - 10 / 17)
    assert H.path_scores(blocks) == {1: pytest.approx(want), 2: 0}
    assert H.smoothed([0, 4, 0]) == [1, 2, 1]


def test_query_on_frames(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", 3), (1, "u", f"<article>{ARTICLE}</article>", 3),
            (None, None, None, 1), (4, "v", "😀 <p>é</p>", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(map(tuple, H.extract(df).collect()), key=str)
    assert got == sorted([(1, "u", WANT, len(WANT))] * 2 + [(None, None, "", 0), (4, "v", "😀\né", 3)], key=str)
    assert H.extract(df.limit(0)).count() == 0


STORY = [f"Paragraph {i} of the story says, in some detail, what happened there; and why it matters to us." for i in range(4)]
TALE = "".join(f"<p>{p}</p>" for p in STORY)
COMMENT = "<div class=c><b>Ann {i}</b><p>I do not agree, and here is why: it was, as we all know, quite different ({i}).</p></div>"


@pytest.mark.parametrize("n", [10, 50, 400])
@pytest.mark.parametrize("where", ["<section class=comments>", "<div id=comments>"])
@pytest.mark.parametrize("inside", [True, False])
def test_reader_comments_have_no_say(n, where, inside):
    talk = where + "".join(COMMENT.format(i=i) for i in range(n)) + f"</{where[1:].split()[0]}>"
    page = f"<body><article>{TALE}{talk}</article></body>" if inside else f"<body><article>{TALE}</article>{talk}</body>"
    assert H.main_text(page) == "\n".join(STORY)
    assert H.main_text(page.replace("article>", "div>")) == "\n".join(STORY)


def test_comments_that_are_articles():
    talk = "".join(f"<article class=comment><p>Reply {i}: no, not at all; you are wrong, I think.</p></article>" for i in range(30))
    assert H.main_text(f"<article>{TALE}</article>{talk}") == "\n".join(STORY)


def test_form_around_the_page_and_form_beside_it():
    search = "<form action=/s><input name=q><p>Search, all of it.</p></form>"
    assert H.main_text(f"<form id=aspnet><nav><a href=/>Home</a></nav><article>{TALE}</article></form>") == "\n".join(STORY)
    assert H.main_text(f"<form><div>{TALE}</div></form>") == "\n".join(STORY)
    assert H.main_text(f"{search}<div>{TALE}</div>{search}") == "\n".join(STORY)


def test_unclosed_elements_beside_the_article():
    for tag in ("nav", "aside", "footer"):
        assert H.main_text(f"<{tag}><ul><li><a href=/>Home</a></ul><article>{TALE}</article>") == "\n".join(STORY)
    assert H.main_text(f"<nav><p>Home, and away.</p></nav><article>{TALE}</article>") == "\n".join(STORY)


def test_paragraphs_and_items_that_are_links_stay():
    link = "<p><a href=/x>The full report, with all tables.</a></p>"
    got = H.main_text(f"<article><p>{STORY[0]}</p>{link}<p>{STORY[1]}</p></article>")
    assert got == "\n".join([STORY[0], "The full report, with all tables.", STORY[1]])
    items = "<ul><li>One point, made here at some length.</li><li><a href=/y>Another point, elsewhere.</a></li></ul>"
    assert "Another point, elsewhere." in H.main_text(f"<article>{TALE}{items}</article>")
