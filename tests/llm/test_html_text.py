from __future__ import annotations

import re
from html import unescape

from case_tables import SF

from candor.llm.html_text import main_text, page_texts

PAGE = """<!doctype html><html><head><title>Name | Site</title><style>p{}</style></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href=/>Home</a><li><a href=/x>More</a></ul></nav>
<div id="cookie-notice">We use cookies, and say so; at length. Accept?</div>
<div class="%s"><h1>Title &amp; more</h1><p>First&nbsp;paragraph, with <b>bo</b>ld words.<p>Second   one:
it has a break<br>here, and more.<script>var a = "</p>";</script></p>
<ul><li>item one<li>item two</ul><!-- hidden, not text. --><aside>Aside, with text. More of it.</aside>
<form><p>Subscribe, now. Please.</p><input></form></div>
<div class="sidebar"><p>Popular, this week. Read it, all.</p></div><div class="ad-box">Buy, now. Cheap, good.</div>
<section id=comments><article class="comment"><p>I agree, fully. Well said, sir.</p></article></section>
<footer>&copy; Site, all rights. Contact, us.</footer>"""
TEXT = "Title & more First paragraph, with bold words. Second one: it has a break here, and more. item one item two"


def test_marked_and_unmarked_articles():
    assert main_text(PAGE % "content has-sidebar") == TEXT
    named = PAGE.replace('<div class="%s">', "<article>").replace("</form></div>", "</form></article>")
    assert main_text(named) == TEXT


def test_given_pages_equal_their_articles(spark):
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", r.html, re.S)[1]
        want = unescape(re.sub("<[^>]*>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", body)))
        assert main_text(r.html) == " ".join(want.split())


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("  \n ") == ""
    assert main_text("only text") == "only text"
    assert main_text("<p>a<p>b") == "a b"
    assert main_text("<script>x") == "" and main_text("<!-- a") == "" and main_text("<nav>a</nav>") == ""
    assert main_text("a < b &lt;p&gt; &#x41;&unknown; </nope>") == "a < b <p> A&unknown;"
    assert main_text("<div>" * 30_000 + "deep, text.") == "deep, text."
    long = "word, " * 200_000
    assert main_text(f"<p>{long}</p>") == long.strip()
    assert main_text("<p>\U0001f600 \U0001f600.</p>") == "\U0001f600 \U0001f600."


def test_rows(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (1, "u", "<p>\U0001f600 b", "y"), (None, "u", "<p>a", None)],
                               "page_id long, url string, html string, text string")
    rows = {(r.page_id, r.url, r.text, r.n_chars) for r in page_texts(df).collect()}
    assert rows == {(1, None, "", 0), (1, "u", "\U0001f600 b", 3), (None, "u", "a", 1)}
    assert page_texts(df.limit(0)).collect() == []


def test_one_long_block_does_not_hide_the_paragraphs():
    def words(n, word="some"):
        return (f"{word} words here, and more of them. " * (n // 30 + 1))[:n].strip()

    def body(inner):
        return f"<body><nav><a href=/>Home</a></nav><div><div>{inner}</div></div></body>"

    many = "".join(f"<p>{words(200, f'p{i}')}</p>" for i in range(12))
    for short, long in ((many, f"<blockquote><p>{words(3000)}</p></blockquote>"), (many, f"<pre>{words(20_000)}</pre>"),
                        ("".join(f"<p>{words(150, f'q{i}')}</p>" for i in range(10)),
                         f"<section><p>{words(1500)}</p></section>" * 30), (many, f"<div>{words(1_000_000)}</div>")):
        for html in (body(short + long), body(long + short)):
            got = main_text(html)
            assert all(f"{t} words here" in got for t in re.findall(r"<p>([pq]\d+) ", short))
            assert len(got) > len(re.sub("<[^>]*>", "", short + long)) - 5


def test_all_selected_text_is_in_the_element_around_it():
    near = "<p>A paragraph, long enough to count; with stops, too. It goes on, and on, for a while.</p>"
    html = f"<body><div><div>{near * 30}</div><section><p>The last part, that stands apart; it has stops, and text enough, too. "
    assert main_text(html + "It goes on, and on, for a while.</p></section></div>").endswith("and on, for a while.")
    assert "The last part" in main_text(html + "It goes on, and on, for a while.</p></section></div>")


def test_ratios_choose_the_blocks_of_articles_too():
    paras = [f"Paragraph {i} is text, with commas, and stops. It goes on for a while; so it has a ratio. " * 3 for i in range(6)]
    text = "".join(f"<p>{p}</p>" for p in paras)
    want = " ".join(["A title", *(p.strip() for p in paras)])
    extra = ("<h2>More stories</h2><ul><li><a href=/1>One story</a><li><a href=/2>Another story</a></ul>",
             "<div><a href=/s>Next: a story, with stops. And more.</a></div>", "<div>Share this page</div>",
             "<section><h3>Readers say</h3><div><p>Nice one!</p></div><div><p>Well said.</p></div><div><p>I agree.</p></div></section>")
    for tag in ("article", "main"):
        for after in extra:
            assert main_text(f"<body><{tag}><h1>A title</h1>{text}{after}</{tag}></body>") == want
        teaser = "<article><h2>Other</h2><p>A short teaser, read on.</p></article>"
        assert main_text(f"<body><{tag}><h1>A title</h1>{text}</{tag}>{teaser}</body>") == want
        assert main_text(f"<body>{teaser}<{tag}><h1>A title</h1>{text}</{tag}></body>") == want
    assert main_text(f"<main><h1>A title</h1><div>By me</div><article>{text}</article>{teaser}</main>") == want
    # An article that holds the lesser part of the selected text is no border.
    assert paras[5].strip() in main_text(f"<body>{teaser}<div>{text}</div></body>")
    both = main_text(f"<body><article>{text}</article><article>{text}</article></body>")
    assert both == " ".join(p.strip() for p in paras + paras)


PARAS = "".join(f"<p>Paragraph {i} is text, with commas, and stops. It goes on for a while; so it has a ratio.</p>" for i in range(4))
PLAIN = " ".join(re.findall("<p>(.*?)</p>", PARAS))


def test_a_mark_is_no_sentence():
    assert main_text(f'<article class="post social-science"><h1>A title</h1>{PARAS}</article>') == f"A title {PLAIN}"
    nav = '<div class="sidebar"><a href=/>One</a><p>Popular, this week. Read it, all.</p></div>'
    for name in ("layout sidebar-right", "promo", "post sponsored"):
        assert main_text(f'<body><div class="{name}"><h1>A title</h1>{nav}{PARAS}</div></body>') == f"A title {PLAIN}"
        assert main_text(f'<body><div class="{name}">{nav}{PARAS}</div></body>') == PLAIN
    extra = "It was said, by many, that the work before this one had faults; they are named here, one by one."
    for part in (f'<section id="related-work"><h2>Related work</h2><p>{extra}</p></section>',
                 f'<div class="notice-period"><h2>Related work</h2><p>{extra}</p></div>',
                 f'<h2>Related work</h2><p id="replies-to-critics">{extra}</p>',
                 '<h2>Related work</h2><p id="replies-to-critics">The critics were wrong, he said.</p>'):
        want = " ".join(re.sub("<[^>]*>", " ", part).split())
        for tag in ("main", "div", "article"):
            assert main_text(f"<body><{tag}><h1>A title</h1>{PARAS}{part}</{tag}></body>") == f"A title {PLAIN} {want}"


def test_marked_parts_go():
    one = "I agree with all of it, fully. Well said, and in good time; more of this, please."
    comments = "".join(f'<article class="comment"><p>{one}</p></article>' for _ in range(30))
    for part in (f'<section id="comments">{comments}</section>', f'<div class="commentList">{comments}</div>',
                 f'<div class="post-comments">{comments}</div>', f"{comments}",
                 f'<div class="cookie-notice">We use cookies, and say so; at length. {one} Accept?</div>',
                 f'<div id="newsletter-signup-hero"><p>{one}</p></div>', f'<div class="ad-300x250"><p>{one}</p></div>',
                 '<div class="related-stories-extra"><ul><li><a href=/1>One story, told at length</a></ul></div>',
                 '<p class="promo-teaser">Buy now</p>', '<div class="social-icons-strip">Like, follow</div>'):
        for tag in ("main", "div", "article"):
            assert main_text(f"<body><{tag}><h1>A title</h1>{PARAS}{part}</{tag}></body>") == f"A title {PLAIN}", part
            assert main_text(f"<body><{tag}><h1>A title</h1>{PARAS}</{tag}>{part}</body>") == f"A title {PLAIN}", part
    assert main_text('<body><div id="cookie-notice">We use cookies, and say so; at length. Accept?</div></body>') == ""
    assert main_text('<div class="sidebar">' * 30_000 + f"<h1>A title</h1>{PARAS}") == f"A title {PLAIN}"
