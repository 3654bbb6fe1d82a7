from itertools import combinations

from hypothesis import given
from hypothesis import strategies as st

from wardflow.llm import html

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body class="comment">
<header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></ul></nav><div class="side-bar ad">Buy</div><p>Loose line
<article><header><h1>Tom &amp; Jerry&nbsp;&#233;</h1></header><p><b>First   a &lt; b<br>second<p title="a > b">Third <!-- no --> line</p>
<aside>Aside</aside><div id="comments"><p>Reader</div><form>Form<input value=x></form><p>Last</article><footer>&copy; us</footer></body></html>"""


def test_blocks_of_the_article():
    assert html.main_text(PAGE, []) == "Tom & Jerry é\nFirst a < b second\nThird line\nLast"


@given(st.lists(st.integers(0, 3), max_size=9), st.lists(st.integers(0, 3), max_size=9))
def test_common_lines_are_longest(a, b):
    found = html.common_lines(a, b)
    picked = [a[i] for i in found]
    rest = iter(b)
    assert found == sorted(set(found)) and all(x in rest for x in picked)
    longer = combinations(range(len(a)), len(found) + 1)
    assert not any(_inside([a[i] for i in pick], b) for pick in longer)


def _inside(x, b):
    rest = iter(b)
    return all(y in rest for y in x)


def test_shared_lines_go_where_markup_says_nothing(spark):
    def page(url, own):
        return f"<body><div>Welcome</div><div>Menu</div><p>{own} &amp; more</p><div>Imprint</div></body>"

    rows = [(i, f"http://h.example/a/{i}?q=1", page("", f"Own {i}")) for i in range(40)]
    rows += [(100, "http://other.example/a/1", page("", "Alone")), (101, None, None), (102, "x", ""), (103, "http://h.example/a/2", rows[2][2]), (103, "http://h.example/a/2", rows[2][2])]
    frame = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, version string").repartition(3)
    got = {r.page_id: r for r in html.extract(spark, frame).collect()}
    assert html.extract(spark, frame).count() == len(rows)
    assert all(got[i].text == f"Own {i} & more" for i in range(40)) and got[103].text == "Own 2 & more"
    assert got[100].text == "Welcome\nMenu\nAlone & more\nImprint"
    assert got[101].text == got[102].text == "" and got[101].n_chars == 0 and got[101].url is None
    assert got[5].n_chars == len(got[5].text)


def test_no_pages(spark):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert html.extract(spark, frame).count() == 0


def test_wrappers_yield_to_the_article_in_them():
    for wrapper in ('<div class="layout with-sidebar">', '<div id="search-app">', '<div class="page comments-open"><section>'):
        for main in ("article", "main"):
            page = f"<body><nav>Menu</nav>{wrapper}<p>Side</p><{main}><p>Text</p><div class='ad'>Buy</div></{main}></div><footer>Us</footer>"
            assert html.main_text(page, []) == "Text"
    # A page with an article of its own keeps readers' comments out, though they are articles too.
    page = "<article><p>Text</p></article><div class='comments'><article><p>Reader</p></article></div>"
    assert html.main_text(page, []) == "Text"
    assert html.main_text("<aside><article>Other</article></aside><article class='ad'>Buy</article>", []) == ""


def test_marks_in_an_article_are_whole_names():
    page = '<article><p class="share-price">Price</p><div class="alert">Mind</div><div class="share">Share</div><p class="has-comments">Text</p></article>'
    assert html.main_text(page, []) == "Price\nMind\nText"


def test_long_equal_tables():
    a = [1] * 20_000 + [2, 3] + [1] * 20_000
    b = [1] * 20_000 + [4] + [1] * 20_000
    assert html.common_lines(a, b) == [*range(20_000), *range(20_002, 40_002)]


def test_copies_on_a_host_keep_their_text(spark):
    page = "<body><div>Menu</div><p>{}</p><div>Imprint</div></body>"
    rows = [(i, f"http://h.example/a/{i:03}", page.format("Same")) for i in range(50)] + [(60, "http://h.example/a/777", page.format("Other"))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract(spark, frame).collect()}
    assert set(got[i] for i in range(50)) == {"Same"} and got[60] == "Other"
    alone = {r.text for r in html.extract(spark, frame.where("page_id < 50")).collect()}
    assert alone == {"Menu\nSame\nImprint"}
