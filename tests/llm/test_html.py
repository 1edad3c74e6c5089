import html as entities
import re
import time

import pytest
from llm.helpers import SF_DIR, read

from tidemark.llm import html
from tidemark.llm.registry import QUERIES


def plain_article(page):
    """The article element by regular expressions, for the test pages' own markup."""
    m = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
    if not m:
        return ""
    parts = re.sub(r"</?(?:p|h1)\b[^>]*>", "\0", m[1])
    parts = [re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]*>", " ", p) if "<br" in p else re.sub(r"<[^>]*>", "", p))).strip() for p in parts.split("\0")]
    return "\n".join(p for p in parts if p)


LONG = "This sentence stands in the article and is long enough to count as text, is it not? " * 3


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p>a &amp; b&nbsp;c\n d</p>" + f"<p>{LONG}</p>", "a & b c d\n" + LONG.strip()),
        (f"<nav><a href=x>Home</a></nav><p>{LONG}</p><footer>Copyright</footer>", LONG.strip()),
        (f"<article><p>{LONG}<p>Short.</p><aside>Ad</aside><script>var t='</p>';</script><p>End</article><p>{LONG}</p>", f"{LONG.strip()}\nShort.\nEnd"),
        (f"<div class='cookie-notice'><p>{LONG}</p></div><main><h1>Title</h1><p>{LONG}</p><section id=comments><p>{LONG}</p></section></main>", f"Title\n{LONG.strip()}"),
        (f"<article><header><h1>Title</h1></header><p>{LONG}</p><form><p>{LONG}</p></form>", f"Title\n{LONG.strip()}"),
        (f"<ARTICLE><P>{LONG}<!-- <p>no</p> --><BR>x</P><div class=\"sidebar\">{LONG}", f"{LONG.strip()} x"),
        (f"<body class='has-sidebar comments-open'><article class='post comments-closed'><p>{LONG}</p></article><article class='comment'><p>{LONG}</p></article>", LONG.strip()),
        ("<p>3 < 4 and <b>bold", "3 < 4 and bold"),
        ("&amp", "&"),
    ],
)
def test_pages(page, text):
    assert html.main_text(page) == text


def test_rows(spark):
    rows = [(1, None, "x"), (2, f"<p>{LONG}</p>", "y"), (2, f"<p>{LONG}</p>", "y"), (None, "", None), (3, "<p>" + "word " * 200_000 + "</p>", "z")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html.extract_main_text(pages)
    assert got.columns == ["page_id", "html", "text", "n_chars"]
    assert sorted(r.n_chars for r in got.collect()) == [0, 0, len(LONG) - 1, len(LONG) - 1, 999_999]
    assert html.extract_main_text(pages.limit(0)).count() == 0


def test_query_equals_article(spark):
    want = {p: plain_article(h) for p, h in read("pages", "page_id, html")}
    got = QUERIES["op5_html_main_text"](spark, SF_DIR).collect()
    assert {r.page_id: r.text for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize(
    "wrapper",
    ['div class="content-sidebar-wrap"', 'div id="page" class="has-sidebar"', 'div class="main no-comments"', 'section class="social-page"', "span class=header-page"],
)
@pytest.mark.parametrize("body", ["<article><h1>Title</h1><p>{0}</p></article>", "<main><h1>Title</h1><p>{0}</p></main>", "<h1>Title</h1><p>{0}</p>"])
def test_named_wrappers_of_the_page(wrapper, body):
    tag = wrapper.split()[0]
    page = f"<body><{wrapper}><div class=sidebar><p>{LONG[:84]}</p></div>{body.format(LONG)}<div id=comments><article><p>Nice, {LONG}</p></article></div></{tag}></body>"
    assert html.main_text(page) == f"Title\n{LONG.strip()}"


def test_named_parts_beside_an_article():
    many = f"<p>{LONG}</p>" * 5
    page = f"<article><h1>Title</h1><p>{LONG}</p></article>"
    assert html.main_text(f'{page}<div class="comments-area">{many}</div>') == f"Title\n{LONG.strip()}"
    assert html.main_text(f'{page}<div class="related"><article><p>{LONG[:84]}</p></article></div>') == f"Title\n{LONG.strip()}"
    assert html.main_text(f"{page}<div hidden>{many}</div>") == f"Title\n{LONG.strip()}"
    assert html.main_text(f'<article><p>Teaser.</p></article><div class="promo-page">{many}</div>').endswith("\n".join([LONG.strip()] * 5))


P, LINKS = f"<p>{LONG}</p>", "<p><a href=x>A link alone</a></p>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<ul><li><a href=x>Home</a></li></ul><div>{P}{LINKS}{P}</div>", [LONG, "A link alone", LONG]),
        (f"<div>{P * 8}{LINKS * 3}<p>The end.</p></div><footer>Imprint</footer>", [LONG] * 8 + ["A link alone"] * 3 + ["The end."]),
        (f"<div>{P * 2}</div><nav><p>a</p><p>b</p><p>c</p></nav><p>Imprint</p>", [LONG] * 2),
        ("<article><a href=x>Teaser</a></article>" * 3 + f"<div>{P * 4}<p>The end.</p></div>", [LONG] * 4 + ["The end."]),
        (f"<div>{P * 4}</div>" + "<article><h3>Next</h3><p>A teaser.</p></article>" * 6, [LONG] * 4 + ["Next", "A teaser."] * 6),
        (f"<div>{P * 4}<article><p>A quoted post.</p></article><p>The end.</p></div>", [LONG] * 4 + ["A quoted post.", "The end."]),
        (f"<p>Before</p><article><h1>Title</h1>{P * 3}{LINKS}<p>The end.</p></article>{P}", ["Title"] + [LONG] * 3 + ["A link alone", "The end."]),
        (f"<article>{LINKS}</article>", ["A link alone"]),
    ],
)
def test_window_sums_choose_with_and_without_articles(page, text):
    assert html.main_text(page).split("\n") == [t.strip() for t in text]


LEAD = "<h1>Title</h1><p>By A. Author</p><p>3 May 2024</p><p>4 minutes</p>"
LEAD_TEXT = ["Title", "By A. Author", "3 May 2024", "4 minutes"]


@pytest.mark.parametrize("box", ["article", "main", "div", "section", "body"])
def test_lines_before_the_surge(box):
    many = P * 12
    assert html.main_text(f"<ul><li><a href=x>Home</a></li></ul><{box}>{LEAD}{many}</{box}>").split("\n") == LEAD_TEXT + [LONG.strip()] * 12
    share = "<div class=share-buttons><p>Share this</p></div>"
    assert html.main_text(f"<div>Skip</div><{box}><div><h1>Title</h1></div>{share}<p>By A. Author</p>{many}</{box}>").split("\n")[-13:] == ["By A. Author"] + [LONG.strip()] * 12


def test_headings_in_a_box_of_their_own_lead_to_the_surge():
    page = f"<p><a href=x>Home</a></p><div><div><h1>Title</h1></div><p>By A. Author</p><p>3 May</p><p>x</p>{P * 12}</div>"
    assert html.main_text(page).split("\n") == ["Title", "By A. Author", "3 May", "x"] + [LONG.strip()] * 12


@pytest.mark.parametrize("name", ['div class="social-science"', 'p class="share-price"', 'section id="notice-of-meeting"', 'div class="form-of-government"', 'div class="comments-closed"', 'div class="adHoc"'])
@pytest.mark.parametrize("box", ["article", "div"])
def test_parts_of_a_name_do_not_count(name, box):
    page = f"<{box}><h1>Title</h1>{P}<{name}>{LONG}</{name.split()[0]}>{P}</{box}>"
    assert html.main_text(page).split("\n") == ["Title"] + [LONG.strip()] * 3


@pytest.mark.parametrize("name", ["cookie-notice", "related-posts", "comments-area", "siteFooter", "ad-300x250", "share_buttons", "main-nav", "x newsletter-signup"])
def test_whole_names_count(name):
    assert html.main_text(f'<article>{P}<div class="{name}"><p>{LONG}</p></div>{P}</article>').split("\n") == [LONG.strip()] * 2


REMARK = "I think that this is a good remark, and I have read the whole of it, which took a while. " * 2


@pytest.mark.parametrize("tag", ["div", "section", "article", "li"])
@pytest.mark.parametrize("by", ["<p><b>Anna B</b> 3 May 2024</p>", "<p>Anna B</p><p>2 hours ago</p>", "<p>Anna B</p>"])
@pytest.mark.parametrize("core", ["<article>{0}</article>{1}", "<main>{0}</main>{1}", "<div>{0}</div>{1}", "<article>{0}{1}</article>"])
def test_comments_by_their_shape(tag, by, core):
    one = f"<{tag}>{by}<p>{REMARK}</p></{tag}>"
    box = "ul" if tag == "li" else "section"
    page = "<body>" + core.format(f"<h1>Title</h1>{P * 6}", f"<{box}>{one * 4}</{box}>") + "</body>"
    kept = html.main_text(page).split("\n")
    if by == "<p>Anna B</p>" and core in ("<div>{0}</div>{1}", "<article>{0}{1}</article>"):
        return  # a name alone tells a comment only after the article
    assert kept == ["Title"] + [LONG.strip()] * 6


def test_sections_and_time_lines_are_no_comments():
    sections = "".join(f"<section><h2>Part {i} of 2024</h2>{P}</section>" for i in range(4))
    assert html.main_text(f"<article>{sections}</article>").count(LONG.strip()) == 4
    events = "".join(f"<div><p>12:0{i} Reporter</p>{P}</div>" for i in range(5))
    assert html.main_text(f"<article><h1>Live</h1>{events}</article>").count(LONG.strip()) == 5
    plain = "".join(f"<div><p>Anna {i}</p>{P}</div>" for i in range(5))
    assert html.main_text(f"<article>{plain}</article>").count(LONG.strip()) == 5


@pytest.mark.parametrize("piece", ["<div></b>", "<div><section></section></ul>", "<li>x", "<span></a>", f"<div><p>Anna 2024</p><p>{LONG}</p>", "<p>x</p><div hidden>y</div>"])
def test_time_is_linear(piece):
    def seconds(n):
        page, begin = piece * n, time.process_time()
        html.main_text(page)
        return time.process_time() - begin

    assert seconds(16_000) < 0.5 + 20 * seconds(2_000)
