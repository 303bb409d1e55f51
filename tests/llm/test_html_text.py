import random
import pytest

from tidemark.llm.html_text import extract_main_text, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href=/a>Home</a></li><li>About</li></ul></nav><!-- x --><div class="ad">Buy now buy now buy now.</div>
<article><h1>Head &amp; line</h1><p><b>Bold  first&nbsp;line.<br><p>A long
 paragraph of text that goes on and on, with <i>inline</i> words.</p><p>Short.</p><div class="share">Share it</div>
<section class="comments"><p>First! great article, love it, thanks a lot.</p></section></article>
<aside>More here</aside><footer>&copy; us</footer>"""


def test_article():
    assert main_text(PAGE) == "Head & line\n\nBold first line.\n\nA long paragraph of text that goes on and on, with inline words.\n\nShort."


@pytest.mark.parametrize("html", [None, "", "<", "<div", "<p></p>", "<script>x", "&#xD800;<b>"])
def test_odd_pages(html):
    assert "script" not in main_text(html)


def test_without_article():
    long = "Words of the main text that are long enough to count as content here. " * 3
    html = f"<body><div id=top><a>x</a><a>y</a></div><div class=story><h2>Title</h2><p>{long}</p><p>ok</p><p>{long}</p></div><div><form><p>{long}</p></form></div></body>"
    assert main_text(html) == f"Title\n\n{long.strip()}\n\nok\n\n{long.strip()}"
    assert main_text("just words, no tags") == "just words, no tags"
    assert main_text("<article class=post><header><h1>T</h1><p>by me</p></header><p>Body text.</p></article>") == "T\n\nBody text."


def test_operator(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "<p>é漢\U0001f600</p>" + "<p>x</p>" * 3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text")
    got = extract_main_text(df, ["page_id", "url"]).collect()
    assert len(got) == 4 and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got}[None].startswith("é漢\U0001f600\n\nx")
    assert extract_main_text(df.limit(0), ["page_id", "url"]).collect() == []


LONG = ("Words of the main text that are long enough to count as content here. " * 3).strip()


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<body><article><h2>A</h2><p>{LONG}</p></article><article><h2>B</h2><p>{LONG} {LONG}</p></article></body>", ["A", LONG, "B", f"{LONG} {LONG}"]),
        (f"<body><div><h1>Headline</h1><p>Lead. {LONG}</p></div><div>" + f"<p>{LONG}</p>" * 12 + "</div><div><a>x</a> <a>y</a></div></body>", ["Headline", f"Lead. {LONG}", *[LONG] * 12]),
        (f"<body><h1>Title</h1><p>By me</p><article><p>{LONG}</p></article></body>", ["Title", "By me", LONG]),
        (f"<body><article><p>{LONG}</p><ul><li><a>More one</a></li><li><a>More two</a></li><li><a>More three</a></li><li><a>More four</a></li></ul><p>{LONG}</p><p><a>Source</a></p></article></body>", [LONG, LONG, "Source"]),
        (f'<body><article class="post related"><p>{LONG}</p><section class="comments"><article class="comment"><p>{LONG}</p></article></section></article></body>', [LONG]),
        (f'<body><div class="login page"><p>{LONG}</p><p>{LONG}</p></div><div class=promo><p>Buy now.</p></div></body>', [LONG, LONG]),
        (f"<body><main><h1>M</h1><p>{LONG}</p><article><p>{LONG}</p></article></main></body>", ["M", LONG, LONG]),
    ],
)
def test_regions_and_clusters(html, want):
    assert main_text(html) == "\n\n".join(want)


def test_deep_and_odd_markup(spark):
    deep = "<div>" * 20_000 + "<p>" + "A long paragraph of text that counts as content here. " * 4 + "</p>" + "</div>" * 20_000
    odd = "<article><p>" + "Words of the article before it. " * 5 + "</p><![foo[ bar ]]><!weird><p>" + "And words of the article after it. " * 5 + "</p></article>"
    stray = "</b></i></q>" * 20_000 + "<p>" + "Text after very many stray end tags stays. " * 4
    rows = [(1, deep), (2, odd), (3, stray), (4, "<![CDATA[" * 500), (5, "<" * 1000), (6, "<!--")]
    df = spark.createDataFrame(rows, "page_id long, html string")
    got = {r.page_id: r.text for r in extract_main_text(df, ["page_id"]).collect()}
    assert got[1] == ("A long paragraph of text that counts as content here. " * 4).strip()
    assert got[2] == ("Words of the article before it. " * 5).strip() + "\n\n" + ("And words of the article after it. " * 5).strip()
    assert got[3] == ("Text after very many stray end tags stays. " * 4).strip()
    assert len(got) == 6


def test_names_within_an_article():
    para = lambda c, t: f"<p class='{c}'>{t * 4}</p>"
    html = "<article>" + para("share-price", "The price of the share rose again today. ") + para("search-results-study", "The study of results goes on and on. ") + "<div class='site-comments'>" + para("x", "I agree with all of this, says a reader. ") + "</div>" + para("ad", "Buy this now and save a lot of money. ") + "</article>"
    assert main_text(html) == ("The price of the share rose again today. " * 4).strip() + "\n\n" + ("The study of results goes on and on. " * 4).strip()


def test_random_pages_against_what_was_planted():
    rnd = random.Random(3)
    sentence = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(n)).capitalize() + "."
    for _ in range(60):
        title, paragraphs = sentence(6), [sentence(rnd.randint(1, 60)) for _ in range(rnd.randint(1, 12))]
        main = f"<h1>{title}</h1>" + "".join(f"<p>{'<b>' + p + '</b>' if rnd.random() < 0.2 else p}{'</p>' if rnd.random() < 0.8 else ''}" for p in paragraphs)
        links = "".join(f"<li><a href='/x'>{sentence(1)}</a></li>" for _ in range(rnd.randint(3, 20)))
        around = [f"<nav><ul>{links}</ul></nav>", f"<div class='ad'>{sentence(8)}</div>", f"<header><p>{sentence(5)}</p></header>", f"<aside><p>{sentence(30)}</p></aside>", f"<form><p>{sentence(9)}</p></form>"]
        rnd.shuffle(around)
        cut = rnd.randint(0, len(around))
        html = f"<html><head><title>{title}</title><style>p{{}}</style></head><body>{''.join(around[:cut])}<article>{main}</article><div id='comments'><p>{sentence(40)}</p></div>{''.join(around[cut:])}<footer><p>{sentence(20)}</p></footer></body></html>"
        assert main_text(html) == "\n\n".join([title, *paragraphs])


PARA = ("The body of the article has sentences like this one, with commas, and goes on for a while. " * 3).strip()


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<body><form id='aspnetForm' role='form'><input type=hidden><nav><a>Home</a></nav><div><h1>T</h1><p>{PARA}</p><p>{PARA}</p></div><label>Name</label></form></body>", ["T", PARA, PARA]),
        (f"<body><form><article><h1>T</h1><p>{PARA}</p></article><div class=ad><p>{PARA}</p></div></form><form><p>Mail us.</p></form></body>", ["T", PARA]),
        (f"<article><p>{PARA}</p><div class='ad-hoc-networks'><p>{PARA}</p></div><section id='widget-theory'><p>{PARA}</p><p>Short.</p></section><div class='tasting-menu'><p>{PARA}</p></div></article>", [PARA, PARA, PARA, "Short.", PARA]),
        (f"<article><p>{PARA}</p><form><p>Write to us and win.</p><button>Send</button></form><div class='dinner-menu'><a>Soup</a><a>Fish</a></div><div class='cookie-consent-banner'><p>{PARA}</p></div><div class='my-ad-slot-300x250'><p>Buy.</p></div><p>{PARA}</p></article>", [PARA, PARA]),
        (f"<article><p>{PARA}</p><div class='reader-comments-zone7'><p>{PARA}</p></div><div class='fb-comments-plugin'><p>{PARA}</p></div><div id='promo_box'><p>{PARA}</p></div></article>", [PARA]),
        (f"<article><form><p>{PARA}</p><p>{PARA}</p></form><p>End.</p></article>", [PARA, PARA, "End."]),
    ],
)
def test_forms_and_names_go_only_where_the_text_agrees(html, want):
    assert main_text(html) == "\n\n".join(want)


def test_ratios_smoothing_and_clusters_equal_a_plain_version():
    import math

    import numpy as np

    from tidemark.llm.html_text import SHARE, SIGMA, content, parsed

    rnd = random.Random(9)
    for _ in range(40):
        blocks = ["".join(rnd.choice(("<b>", "</b>", "<i>x</i>", "word ", "some more words ", "<a href=q>link</a> ")) for _ in range(rnd.randint(1, 30))) for _ in range(rnd.randint(1, 25))]
        lines = parsed("<div>" + "".join(f"<p>{b}</p>" for b in blocks) + "</div>").lines
        if not lines:
            continue
        ratios = [len(text) / tags for text, tags, _, _ in lines]
        reach = int(3 * SIGMA)
        weights = [math.exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(-reach, reach + 1)]
        smooth = [sum(w / sum(weights) * ratios[i + k] for k, w in zip(range(-reach, reach + 1), weights) if 0 <= i + k < len(ratios)) for i in range(len(ratios))]
        threshold = SHARE * sum(smooth) / len(smooth)
        good, own = content(np.array(ratios))
        for i, r in enumerate(ratios):
            if min(abs(r - threshold), abs(smooth[i] - threshold)) > 1e-9:
                assert own[i] == (r >= threshold) and good[i] == (r >= threshold or smooth[i] >= threshold)


def test_tags_of_a_line_are_counted():
    from tidemark.llm.html_text import parsed

    assert [(t, n) for t, n, _, _ in parsed("<div><p>one <b>two</b></p><p>three</p></div>").lines] == [("one two", 6), ("three", 3)]


def test_time_is_near_the_length():
    import time

    began = time.time()
    assert main_text("<span>" * 100_000 + "<p>a</p>" * 100_000).count("a") == 100_000
    assert time.time() - began < 60
