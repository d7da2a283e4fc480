"""Main text of pages by hand-made expectations."""

import time

import pytest

from issuescope.llm.html import extract_pages, main_text

ARTICLE = "<p>First part, which is long enough; it has marks. And more of it.</p><p>Second &amp; last, with <b>bo</b>ld<br>text.</p>"
TEXT = "First part, which is long enough; it has marks. And more of it. Second & last, with bold text."


@pytest.mark.parametrize(
    "html, expected",
    [
        (None, ""),
        ("", ""),
        ("plain words, and &lt;marks&gt;.", "plain words, and <marks>."),
        (f"<body><nav><ul><li><a href=/>Home</a></ul></nav><article><h1>Title</h1>{ARTICLE}</article><footer>&copy; x.</footer>", f"Title {TEXT}"),
        (f"<div class=sidebar><p>Long, long text; here. And there.</p></div><div>{ARTICLE}</div><div id='comments'><p>me, too. Yes!</p></div>", TEXT),
        (f"<header>Site, name.</header><main><header><h2>Head</h2></header>{ARTICLE}<aside>By the way, no.</aside></main>", f"Head {TEXT}"),
        (f"<script>var a='<p>x, y.</p>';</script><style>p{{a:b}}</style><article>{ARTICLE}<form>Name, please: <input></form></article>", TEXT),
        (f"<!-- <article>{ARTICLE}</article> --><article>{ARTICLE}", TEXT),
        (f"<article><p><b>{ARTICLE}</article>", TEXT),
        (f"<div role=dialog>We use cookies, ok? Yes, we do.</div><article>{ARTICLE}</article>", TEXT),
        (f"<article>{ARTICLE}</article><foo <bar", TEXT),
        ("<article><p>one\n\t two&nbsp;three</p><p>  </p><p>four</p></article>", "one two three four"),
        ("<nav>only menus, here. And there.</nav>", ""),
        ("<article>a<span>b</span> <i>c</i><div>d</div>e</article>", "ab c d e"),
    ],
)
def test_main_text(html, expected):
    assert main_text(html) == expected


def test_paths_decide_without_an_article_element():
    links = "".join(f"<li><a href=/{i}>Entry {i}</a></li>" for i in range(30))
    html = f"<body><ul>{links}</ul><div><div>{ARTICLE}</div></div><table><tr><td>1<td>2</table>"
    assert main_text(html) == TEXT


def test_long_and_deep_pages():
    assert main_text("<article>" + "<p>word, word. " * 100_000).count("word") == 200_000
    assert main_text("<div>" * 20_000 + "deep, deep.") == "deep, deep."
    assert main_text("<" * 50_000) == "<" * 50_000
    assert main_text("<p a='" * 5_000) == ""


def test_rows(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", 1), (1, "u", f"<article>{ARTICLE}</article>", 1), (None, None, None, 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted((tuple(r) for r in extract_pages(df).collect()), key=repr)
    assert got == [(1, "u", TEXT, len(TEXT)), (1, "u", TEXT, len(TEXT)), (None, None, "", 0)]
    assert extract_pages(df.limit(0)).collect() == []


@pytest.mark.parametrize(
    "attributes",
    [
        'style="overflow:hidden"', "data-title='Hidden gems'", 'data-id="search-7"', "title='class=sidebar'", "data-hidden",
        "style='a:b' data-role=dialog aria-label='id=menu hidden'", "x-hidden=1 data-class=footer", 'alt="a > b hidden"',
    ],
)
def test_values_and_other_names_are_no_attributes(attributes):
    assert main_text(f"<body {attributes}><div {attributes}>{ARTICLE}</div></body>") == TEXT


def test_hidden_elements_go_however_written():
    for attributes in ("hidden", "HIDDEN=''", "aria-hidden = 'true'", "class='x'hidden", "role=\"dialog\""):
        assert main_text(f"<div {attributes}>Not this, no.</div><div>{ARTICLE}</div>") == TEXT


@pytest.mark.parametrize(
    "html, expected",
    [
        *[
            (f"<div class='{name}'><div class=sidebar>Aside, no.</div><div>{ARTICLE}</div></div>", TEXT)
            for name in ("content-sidebar-wrap", "no-sidebar", "modal-open", "social-policy")
        ],
        ("<body>" + "".join(f"<div class=elementor-widget><p>Part {i}, of it.</p></div>" for i in range(4)),
         " ".join(f"Part {i}, of it." for i in range(4))),
        (f"<article><header class=entry-header><h1>Title</h1></header>{ARTICLE}</article>", f"Title {TEXT}"),
        (f"<body><form id=aspnetForm><div>{ARTICLE}</div><div class=footer>End, here.</div></form></body>", TEXT),
    ],
)
def test_names_and_forms_do_not_remove_most_of_a_page(html, expected):
    assert main_text(html) == expected


def test_a_long_notice_beside_a_short_article_goes():
    assert main_text(f"<div class=ad>{ARTICLE}</div><article><h1>Title, short.</h1></article>") == "Title, short."


@pytest.mark.parametrize("depth", [205, 220, 3_000])
def test_an_article_is_seen_at_any_depth(depth):
    inside = "<div>" * depth + ARTICLE + "</div>" * depth
    html = "<section>" * 300 + f"<article>{inside}</article>" + "<p>Beside it, not of it. No.</p>" + "</section>" * 300
    assert main_text(html) == TEXT


def test_closing_tags_end_their_own_element_at_any_depth():
    html = "<ul>" * 2_000 + "<nav>" + "<b><div>" * 1_000 + "menu, here." + "</nav>" + f"<div>{ARTICLE}</div>"
    assert main_text(html) == TEXT


def test_work_grows_with_the_page_however_deep():
    begin = time.perf_counter()
    parts = "".join(f"<div class='c{i}'>a{i}, b.<form id=menu{i}>Search, go.</form>" for i in range(20_000))
    assert main_text(parts + "</div>" * 20_000 + "</section>" * 20_000).count("b.") == 20_000
    assert time.perf_counter() - begin < 20


def test_lists_of_links_in_an_article_go_and_titles_with_links_stay():
    links = "".join(f"<li><a href=/{i}>Entry, {i}.</a></li>" for i in range(30))
    html = f"<article><h1><a href=/>Title</a></h1>{ARTICLE}<ul class=more>{links}</ul><p>1</p><table><tr><td>2</table></article>"
    assert main_text(html) == f"Title {TEXT} 1 2"
    entries = " ".join(f"Entry, {i}." for i in range(30))
    assert main_text(html, least_inside=-1) == f"Title {TEXT} 1 2"  # a score of 0 is never content
    mixed = html.replace("<li><a", "<li>A little text, then <a")
    assert entries.split()[0] in main_text(mixed)


def test_thresholds_decide():
    html = f"<div>{ARTICLE}</div><table><tr><td>12</td></tr></table>"
    assert main_text(html) == TEXT
    assert main_text(html, least_share=0.01) == f"{TEXT} 12"
    html = f"<article>{ARTICLE}<div><dl><dt>12</dl></div></article>"
    assert main_text(html) == f"{TEXT} 12"
    assert main_text(html, least_inside=0.95) == TEXT
