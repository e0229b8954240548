from __future__ import annotations

import random
import re
import time
from html import unescape
from itertools import product

import pytest

from freshhaul.llm.html_extract import extracted, main_text, minimum_cut

PARAGRAPH = "A paragraph of the story with enough words in it to be read as what the page is about. It ends here."


def test_the_cut_is_minimal():
    rng = random.Random(6)
    for _ in range(300):
        n = rng.randrange(1, 8)
        odds = [rng.randrange(-9, 10) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.randrange(6)) for _ in range(rng.randrange(10))]
        edges = [(a, b, c) for a, b, c in edges if a != b]

        def cost(side):
            wrong = sum(x if x > 0 and not s else -x if x < 0 and s else 0 for x, s in zip(odds, side))
            return wrong + sum(c for a, b, c in edges if side[a] != side[b])

        best = min(map(cost, product([False, True], repeat=n)))
        assert cost(minimum_cut(odds, edges)) == best


def test_pages_of_the_table(spark, sf_dir):
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = re.search("<article>(.*)</article>", r.html, re.DOTALL)[1].replace("<br>", " ")
        blocks = [
            " ".join(unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)
        ]
        assert main_text(r.html) == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize(
    "noise",
    [
        '<div class="sidebar"><p>Popular stories that you may have missed this week, and more.</p></div>',
        '<section id="comments"><article class="comment"><p>What a story, I read all of it.</p></article></section>',
        '<div id="cookie-notice">We use cookies to make this page work. Please accept them all.</div>',
        "<form><label>Mail</label><input><button>Send it now.</button></form>",
        "<aside><p>Advert for something that nobody ever needs. Buy it today, it is cheap.</p></aside>",
        "<script>if (a < b) { document.write('<p>no</p>') }</script><style>p { color: red }</style>",
        "<!-- <p>hidden remark that is long enough to be read as a sentence of the story.</p> -->",
        '<div style="display: none">Text that nobody sees although it is part of the page itself.</div>',
    ],
)
def test_noise_between_paragraphs(noise):
    for wrap in ("<article>{}</article>", '<div class="post-content">{}</div>', "<main>{}</main>"):
        body = f"<h1>The title</h1><p>{PARAGRAPH}</p>{noise}<p>Short.</p><p>{PARAGRAPH}</p>"
        page = f"<html><body><nav><a href=x>Home</a></nav>{wrap.format(body)}<footer>&copy; us</footer></body></html>"
        assert main_text(page) == "\n".join(["The title", PARAGRAPH, "Short.", PARAGRAPH])


def test_text_of_blocks():
    page = "<main><p>One &amp; two&nbsp;&#8212;\n three<br>four <b>five</b>six</p><p>1 < 2 is true.<p>Open <i>end"
    assert main_text(page) == "One & two — three four fivesix\n1 < 2 is true.\nOpen end"


def test_broken_and_long_pages():
    for page in ("", "<", "<p", "<!--", "<script>", "</div></p>", "<div>" * 2000, "<a href='x", "&#xfffffff;"):
        assert isinstance(main_text(page), str)
    long = "<article>" + f"<p>{PARAGRAPH}</p><div class=ad>Buy.</div>" * 3000
    assert main_text(long) == "\n".join([PARAGRAPH] * 3000)


def test_odd_rows(spark):
    pages = spark.createDataFrame(
        [(1, None), (2, ""), (3, f"<main><p>{PARAGRAPH}</p></main>"), (3, f"<main><p>{PARAGRAPH}</p></main>")],
        "page_id long, html string",
    ).selectExpr("*", "'x' AS text")
    got = [(r.page_id, r.main) for r in pages.withColumn("main", extracted()).collect()]
    assert got == [(1, ""), (2, ""), (3, PARAGRAPH), (3, PARAGRAPH)]
    assert pages.filter("page_id < 0").select(extracted()).count() == 0


@pytest.mark.parametrize(
    "link",
    [
        '<a href="/hidden-valley">Here</a>', '<a title="The hidden valley" href=/x>Here</a>',
        '<a data-hidden="false">Here</a>', '<a href="/read?id=comment">Here</a>',
        "<a href=/x?class=sidebar>Here</a>", '<a class="share" href=x>Here</a>', '<label>Here</label>',
    ],
)
def test_attributes_by_exact_names(link):
    first = f"{link} is a paragraph of the story that starts with a link and goes on. It ends here."
    page = f"<article><p>{PARAGRAPH}</p><p>{first}</p><p>{PARAGRAPH}</p></article>"
    assert main_text(page) == "\n".join([PARAGRAPH, re.sub("<[^>]*>", "", first), PARAGRAPH])
    box = link.split(">")[0].replace("<a", "<div", 1)
    if "data-hidden" in box or "valley" in box:
        assert main_text(f"<main>{box}><p>{PARAGRAPH}</p></div></main>") == PARAGRAPH


@pytest.mark.parametrize("mark", ["hidden", 'HIDDEN=""', "data-x='a b' hidden", "aria-hidden=true", "style='display:none'"])
def test_hidden_elements_stay_out(mark):
    page = f"<article><p>{PARAGRAPH}</p><div {mark}><p>{PARAGRAPH} Not seen.</p></div><p>{PARAGRAPH}</p></article>"
    assert main_text(page) == f"{PARAGRAPH}\n{PARAGRAPH}"


@pytest.mark.parametrize(
    "wrap",
    [
        '<div class="row has-sidebar"><article>{}</article>{}</div>', '<main class="no-sidebar">{}</main>{}',
        "<form action=x><div>{}</div>{}</form>", '<div class="sidebar-left">{}{}</div>',
        '<main class="sidebar-left">{}{}</main>', '<form><main>{}</main>{}</form>',
        '<div class="modal-page"><article>{}</article></div>{}',
    ],
)
def test_wrappers_with_bad_words_keep_the_article(wrap):
    aside = '<div class="sidebar"><p>Popular stories of the week.</p></div>'
    body = f"<h1>The title</h1><p>{PARAGRAPH}</p><p>Short.</p>" + f"<p>{PARAGRAPH}</p>" * 4
    page = f"<html><body><nav><a href=x>Home</a></nav>{wrap.format(body, aside)}<footer>us</footer></body></html>"
    assert main_text(page) == "\n".join(["The title", PARAGRAPH, "Short."] + [PARAGRAPH] * 4)


def test_long_comments_below_a_short_article_stay_out():
    comments = "".join(f'<div class="comment"><p>{PARAGRAPH} Said reader {i}.</p></div>' for i in range(6))
    page = f'<article><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></article><div id="comments">{comments}</div>'
    assert main_text(page) == f"{PARAGRAPH}\n{PARAGRAPH}"
    page = f'<article><p>{PARAGRAPH}</p></article><div class="related"><article><p>{PARAGRAPH[:60]}</p></article></div>'
    assert main_text(page) == PARAGRAPH


def test_a_slash_of_a_value_closes_nothing():
    story = "<article><p>" + "This is what the story tells. " * 20 + "</p></article>"
    plain = main_text(f"<body>{story}</body>")
    for menu in (
        "<nav data-u=/a/><p>Menu of one, two and three.</p></nav>",
        "<div class=sidebar data-u=/a/><p>Side by side.</p></div>",
        "<nav><svg><path d='x'/><a href=/x/>Up</a></svg><a href=/x/>Home is here</a></nav>",
    ):
        assert main_text(f"<body>{menu}{story}{menu}</body>") == plain
    assert main_text(f"<body><div/>{story}</body>") == plain


def test_open_tags_take_proportional_time():
    start = time.perf_counter()
    main_text("<div><p>x" * 8_000)
    main_text("<div>" * 5_000 + "<li></li>" * 5_000 + "</i>" * 5_000 + "<b>" * 2_000 + "<div>x</div>" * 5_000)
    assert time.perf_counter() - start < 10
