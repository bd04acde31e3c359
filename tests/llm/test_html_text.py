import html
import re

import pytest

from trowel.llm import html_text
from trowel.llm.queries import QUERIES


def test_the_tree_learns_its_table():
    x, y = html_text.labelled_table()
    assert len(y) < 200 and ((html_text.judge(html_text.block_tree(), x) >= 0.5) == y).all()


def article(page):
    """What the generated pages hold between the article tags, block by block."""
    inside = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inside)]
    return "\n".join(b for b in blocks if b)


def test_query_gives_the_articles(spark):
    folder = "/root/testdata/sf0.01"
    pages = {(r.page_id, r.url): r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = QUERIES["op5_html_extraction"](spark, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == article(pages[r.page_id, r.url]) and r.n_chars == len(r.text)


PROSE = "This is a long enough line of running text, as one would find it in any article about rivers and their bridges."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<!-- open", ""), ("<script>var a = '</p>' </script>", ""),
    (f"{PROSE}", PROSE), (f"<p>{PROSE}<p>{PROSE}", f"{PROSE}\n{PROSE}"),
    ("<article><h1>A &amp; B &lt;c&gt; &#233;&nbsp;x</h1><p>One <b>bold</b>\n\t<a href='/x'>link</a> here</p></article>",
     "A & B <c> é x\nOne bold link here"),
    ('<article><p class="x>broken</p><p>two</p></article>', "broken\ntwo"),
    ("<article><p title='a > b'>kept</p><style>p{}</style><form><p>no</p></form></article><p>out</p>", "kept"),
    (f"<main><p>In</p><section class='comments'><p>{PROSE}</p></section></main>", "In"),
    (f"<nav>{PROSE}</nav><div id='cookie-banner'>{PROSE}</div><aside>{PROSE}</aside>", ""),
    (f"<article><p>a<p>b<div style='display:none'>{PROSE}</div></article><footer>{PROSE}", "a\nb"),
])
def test_markup(page, text):
    assert html_text.main_text(page) == text


def test_very_long_and_odd_rows(spark):
    long = "<article>" + f"<p>{PROSE}</p>" * 3000 + "<b>" * 3000
    df = spark.createDataFrame([(1, "u", long, "x"), (2, None, None, "y"), (2, None, None, "y"), (None, "u", "<" * 50_000, "z")],
                               "page_id bigint, url string, html string, text string")
    out = html_text.extract_text(df)
    assert sorted(out.columns) == sorted(df.columns) and out.count() == 4
    got = {r.page_id: r.text for r in out.collect()}
    assert got[1] == "\n".join([PROSE] * 3000) and got[2] == ""
    assert html_text.extract_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("opened", [
    '<article class="overflow-hidden">', '<main class="md:hidden">', '<main title="the hidden cost">',
    "<article data-state='{\"hidden\": true}'>", '<article aria-hidden = "false">', '<article hidden="until-found">',
    '<main title="display: none">', '<main style="--display:none; display:none; display:block">'])
def test_values_that_speak_of_hidden_do_not_hide(opened):
    end = "</article>" if "<article" in opened else "</main>"
    page = f'{opened}<p>{PROSE}</p><p>In <a href="/hidden-valley">the valley</a> it rained.</p><p><a href=/hidden>So</a> it did.</p>{end}'
    assert html_text.main_text(page) == f"{PROSE}\nIn the valley it rained.\nSo it did."


@pytest.mark.parametrize("attribute", [
    "hidden", "HIDDEN", 'hidden=""', "hidden='hidden'", "hidden=hidden", 'class="x" hidden', 'class="x"hidden',
    'style="display:none"', "style='color:red; DISPLAY : NONE !important'", "style=display:none"])
def test_hidden_elements_give_no_text(attribute):
    assert html_text.main_text(f"<article><p>{PROSE}</p><div {attribute}>{PROSE}</div></article>") == PROSE


SIDE = "<div class='sidebar'><p>Buy two pairs of boots and get the third one free.</p></div>"


@pytest.mark.parametrize("before, after", [
    ("<div class='has-sidebar'>", "</div>"), ("<div id='with-nav'><div class='content'>", "</div></div>"),
    ("<main class='no-sidebar'>", "</main>"), ("<article class='single-post comments-open'>", "</article>"),
    ("<div class='has-sidebar'>", f"{SIDE}</div>"), ("<div class='has-sidebar'><article>", f"</article>{SIDE}</div>"),
    (f"<div class='has-sidebar'>{SIDE}<div class='story'>", "</div></div><footer>Imprint</footer>"),
    ("<nav><a href='/'>Home</a></nav><div class='single-post comments-open'>",
     f"<section id='comments'><p>{PROSE}</p></section></div>")])
def test_wrappers_with_hints_keep_the_text(before, after):
    inner = f"<p>{PROSE}</p><p>{PROSE}</p><p>Short.</p><p>{PROSE}</p>"
    assert html_text.main_text(before + inner + after) == "\n".join([PROSE, PROSE, "Short.", PROSE])


@pytest.mark.parametrize("name", ["comments", "related", "sidebar"])
def test_hinted_parts_of_half_a_page_still_go(name):
    text = f"<div><p>{PROSE}</p><p>{PROSE}</p></div>"
    assert html_text.main_text(f"{text}<div class='{name}'><p>{PROSE}</p><p>{PROSE}</p></div>") == f"{PROSE}\n{PROSE}"


def test_a_wrapper_is_told_by_its_place_and_share():
    hinted = lambda page: [(b.text, round(b.hinted, 2)) for b in html_text.blocks(page)]
    assert hinted("<div class='has-sidebar'><p>a b c</p><div class='sidebar'>d</div></div>e") == [
        ("a b c", 0.2), ("d", 0.8), ("e", 0)]
    assert hinted("<main><p>a</p><div class='comments'>b c d</div></main>") == [("a", 0), ("b c d", 1)]
    assert hinted("<main><h1>a</h1><div class='no-sidebar'>b <span class='share'>c</span> d</div>e") == [
        ("a", 0), ("b c d", 0.4), ("e", 0)]


@pytest.mark.parametrize("tag", ["svg", "select", "object", "canvas", "audio", "video", "math", "noscript", "template"])
def test_elements_without_an_end_tag_end_with_the_one_around(tag):
    text = f"{PROSE}\n{PROSE}"
    article = f"<article><p>{PROSE}</p><p>{PROSE}</p></article>"
    assert html_text.main_text(f"<div><{tag}>x</div>{article}") == text
    assert html_text.main_text(f"<body><{tag}><b>x</b>{article}") == text
    assert html_text.main_text(f"<{tag}>x{article}<div><{tag}>y</{tag}></div>") == text
    assert html_text.main_text(f"<article><p>{PROSE}<{tag}>x</p><p>{PROSE}</p></article>") == text
    assert html_text.main_text(f"<div><{tag}>x<script>'</{tag}>'</script></div>{article}") == text


@pytest.mark.parametrize("tag", ["svg", "select", "object", "noscript", "template"])
def test_elements_with_an_end_tag_give_no_text(tag):
    inner = f"<p>{PROSE}</p><{tag}><p>x</p></div><{tag}/></{tag}>"
    if tag == "object":  # nested ones
        inner = f"<{tag}><{tag}><p>x</p></{tag}><p>{PROSE}</p></{tag}><p>{PROSE}</p>"
    assert html_text.main_text(f"<article><div>{inner}</div></article>") == PROSE


@pytest.mark.parametrize("tag", ["script", "style", "title", "textarea", "iframe"])
def test_raw_text_without_an_end_tag_goes_on_to_the_end(tag):
    assert html_text.main_text(f"<article><p>{PROSE}</p><div><{tag}>x</div><p>{PROSE}</p></article>") == PROSE


@pytest.mark.parametrize("inner", [
    f'<p class="share-price">{PROSE}</p>', f'<section class="social-history"><p>{PROSE}</p></section>',
    f'<p>{PROSE}</p><h2 id="search-and-rescue">Search and rescue</h2>', f'<p>{PROSE}</p><h2 id="the-menu">The menu</h2>',
    f'<div class="header"><h1>One title</h1></div><p>{PROSE}</p>', f'<div id="login-shell-history"><p>{PROSE}</p></div>',
    f'<p aria-label="Share price">{PROSE}</p>'])
def test_names_that_only_hold_such_a_word_keep_their_text(inner):
    want = "\n".join(" ".join(re.sub("<[^>]*>", "", x).split()) for x in re.split("(?<=</p>)|(?=<p)|(?=<h2)", inner) if re.sub("<[^>]*>", "", x))
    assert html_text.main_text(f"<article><p>{PROSE}</p>{inner}<p>{PROSE}</p></article>") == f"{PROSE}\n{want}\n{PROSE}"


@pytest.mark.parametrize("name", ["header", "site-header", "adslot", "ad-slot", "cookieBanner", "main_menu", "comment-12",
                                  "share-buttons", "related-posts", "widget_text", "google-ads"])
def test_names_of_parts_beside_the_text_go(name):
    text = f"<div><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></div>"
    assert html_text.main_text(f'<div class="{name}"><p>Buy two pairs of boots and get the third one free until Sunday.</p></div>{text}') == "\n".join([PROSE] * 3)


@pytest.mark.parametrize("page", [
    "<form id='aspnetForm'><nav><a href='/'>Home</a></nav><article>{}</article><footer>Imprint</footer></form>",
    "<form method=post><input type=hidden name=state><main>{}</main></form>",
    "<body><form><div><a href='/'>Home</a></div><h1></h1><div>{}</div><label>Name</label><input></form>",
    "<form>{}</form>", "<article>{}<form><p>Write to us, we read it all and answer within two days or three.</p></form></article>",
    "<form action=/s><label>Search</label><input><button>Go</button></form><div>{}</div>"])
def test_forms_around_a_page_and_in_it(page):
    assert html_text.main_text(page.format(f"<p>{PROSE}</p><p>{PROSE}</p>")) == f"{PROSE}\n{PROSE}"


def test_lists_of_links_in_a_text_and_around_it():
    links = "<ul><li><a href='/1'>A map of 1640</a><li><a href='/2'>The tax rolls</a><li><a href='/3'>Letters of a miller</a></ul>"
    for around in ("<ul><li><a href='/'>Home</a><li><a href='/n'>News</a></ul>",
                   "<p><a href='/1'>What the tax rolls of the old valley tell about its mills</a></p>"):
        page = f"<body>{around}<div><p>{PROSE}</p>{links}<p>{PROSE}</p></div>{around}</body>"
        assert html_text.main_text(page) == f"{PROSE}\nA map of 1640\nThe tax rolls\nLetters of a miller\n{PROSE}"
    page = f"<body><ul><li><a href='/'>Home</a><li><a href='/n'>News</a></ul><div><p>{PROSE}</p>{links}<p>{PROSE}</p></div>{links}</body>"
    assert html_text.main_text(page) == f"{PROSE}\nA map of 1640\nThe tax rolls\nLetters of a miller\n{PROSE}"


@pytest.mark.parametrize("markup", ["<b>{}</i>", "<head>", "<div>{}</p>", "</i>", "<svg>", "<form>", "<h1 class='a b-c'>", "<!-", "<a '"])
def test_a_megabyte_of_unmatched_tags(markup):
    import time
    began = time.time()
    one = markup.replace("{}", "")
    html_text.main_text(f"<article><p>{PROSE}</p>{one * (1_000_000 // len(one))}")
    assert time.time() - began < 20
