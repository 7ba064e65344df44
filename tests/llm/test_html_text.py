import random

import pytest

from lakeloom.llm.html_text import ARTICLE, ELSEWHERE, MAIN, common_subsequence, extract_text, page_lines


def texts(html, level=None):
    return [t for t, at in page_lines(html) if level is None or at == level]


def test_regions():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>x";</script></head>
    <body class="home"><header><h1>Site</h1></header><nav><ul><li><a href="/">Menu<li>More</ul></nav>
    <!-- ad --><div class="ad-box">Buy</div><div id="cookie-notice">Cookies</div><p>Before</p>
    <main><p>Lead<article><header><h2>Ti&shy;tle</h2></header><p><b>One  &amp; <i>t</i>wo<br>three<p hidden>no</p>
    <p>A&nbsp;b &lt;c&gt; &#233;<aside>Side</aside><form>Name <input></form>
    <ul><li>x<li>y</ul><table><tr><td>1<td>2</table><section class="comments">Nice!</section>
    <div role="complementary">z</div><img alt="a>b"><pre>q
      r</pre></article><p>After main</main><aside>Links</aside><footer>&copy;</footer>"""
    assert texts(page, ARTICLE) == ["Ti­tle", "One & two three", "A b <c> é", "x", "y", "1 2", "q r"]
    assert texts(page, MAIN) == ["Lead", "After main"]
    assert texts(page, ELSEWHERE) == ["Before"]


@pytest.mark.parametrize("page,want", [
    ("", []), ("just text", ["just text"]), ("<p>a<p>b", ["a", "b"]), ("a<", ["a<"]), ("1 < 2 > 0", ["1 < 2 > 0"]),
    ("<div", []), ("<!-- open <p>x", []), ("<script>never ends <p>", []), ("</div></p>x</b>", ["x"]),
    ("<article><b>a<div>b</article>c", ["a", "b", "c"]), ("x<SCRIPT>y</ScRiPt >z", ["xz"]),
    ("<p title='a>b'>c</p>", ["c"]), ("<![CDATA[x]]>y", ["y"]), ("<br/>a<br/>b", ["a b"]), ("<p/>a", ["a"]),
])
def test_odd_markup(page, want):
    assert texts(page) == want


def length(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(1500):
        k = rng.choice([2, 3, 8])
        a, b = ([rng.randrange(k) for _ in range(rng.randrange(12))] for _ in range(2))
        for bits in (1 << 28, 6):
            found, rest = common_subsequence(a, b, bits), iter(b)
            assert len(found) == length(a, b) and found == sorted(set(found))
            assert all(any(y == a[i] for y in rest) for i in found)


def ran(spark, rows):
    pages = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, row int, texts int")
    return {r.page_id: (r.text, r.n_chars, r.n_deleted) for r in extract_text(pages.repartition(4)).collect()}


def test_lines_shared_with_the_nearest_page(spark):
    def page(own, *more):
        return "<body>" + "".join(f"<p>{t}</p>" for t in ("Welcome", own, *more, "All rights"))

    rows = [
        (1, "http://H/a/1", page("one")), (2, "https://h/a/2?x=/b", page("two", "Only near b")),
        (3, "http://h/b/1", page("three", "Only near b", "third")), (4, "http://h/b/2", page("four", "third")),
        (5, "http://other/a/1", page("alone")), (6, None, page("six")), (7, "http://h/z", None), (8, "http://h/zz", ""),
        (9, "http://m/1", "<main><p>Kept</p><p>Same</p></main>"), (10, "http://m/2", "<p>Top</p><article>Same</article>"),
    ]
    got = ran(spark, rows)
    assert got[1] == ("one", 3, 2) and got[2] == ("two\n\nOnly near b", 16, 2)
    assert got[3] == ("three\n\nOnly near b", 18, 3) and got[4] == ("four", 4, 3)
    assert got[5] == ("Welcome\n\nalone\n\nAll rights", 26, 0) and got[6][0].startswith("Welcome")
    assert got[7] == got[8] == ("", 0, 0)
    assert got[9] == ("Kept\n\nSame", 10, 0) and got[10] == ("Same", 4, 0)


def test_neighbours_across_partitions(spark):
    """A host that spans all ranges: every page but those without a neighbour loses the lines that all share."""
    rows = [(i, f"http://h/{i:04d}", f"<p>menu</p><p>own {i}</p>") for i in range(300)]
    assert ran(spark, rows) == {i: (f"own {i}", len(f"own {i}"), 1) for i in range(300)}


def test_empty_and_repeated(spark):
    assert extract_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
    rows = [(None, "u", "<article>a</article>"), (3, "http://h/1", "<article>b</article>")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(r.text for r in extract_text(pages).collect()) == ["a", "a", "b", "b"]


def test_a_long_page(spark):
    """A near copy keeps what it shares; only that its lines are no article's tells it from the other page."""
    html = "".join(f"<p>line {i % 5000}</p>" for i in range(30_000))
    rows = [(1, "http://h/1", f"<article>{html}</article>"), (2, "http://h/2", html.replace("line 77<", "other<"))]
    got = ran(spark, rows)
    assert got[1][0].count("\n\n") == got[2][0].count("\n\n") == 29_999
    assert got[2][0].count("other") == 6 and got[2][2] == 0


def lines_of(*own):
    return "".join(f"<p>{t}</p>" for t in ("Welcome", *own, "All rights"))


def test_copies_keep_their_text(spark):
    """Pages whose neighbour is a copy of them, as by scheme, query or repeated rows; the site's lines still go."""
    rows = [
        (1, "http://h/a", lines_of("one", "two")), (2, "https://h/a", lines_of("one", "two")),
        (3, "http://h/a?x=1", lines_of("one", "two")), (4, "http://h/b", lines_of("three")), (5, "http://h/c", lines_of("four")),
        (6, "http://pair/a", lines_of("five")), (7, "http://pair/b", lines_of("five")), (8, "http://pair/b", lines_of("five")),
        (9, "http://mixed/a", "<p>x</p><p>y</p>"), (10, "http://mixed/b", "<article><p>x</p><p>y</p></article>"),
    ]
    got = ran(spark, rows)
    assert got[1] == got[2] == got[3] == ("one\n\ntwo", 8, 2)
    assert got[4] == ("three", 5, 2) and got[5] == ("four", 4, 2)
    assert got[6] == got[7] == got[8] == ("Welcome\n\nfive\n\nAll rights", 25, 0)
    assert got[9] == got[10] == ("x\n\ny", 4, 0)


def test_near_copies_keep_what_they_share(spark):
    body = [f"line {i}" for i in range(8)]
    rows = [
        (1, "http://h/a", lines_of(*body, "day 1")), (2, "http://h/a?d=2", lines_of(*body, "day 2")),
        (3, "http://h/a?d=3", lines_of(*body, "day 3")), (4, "http://h/b", lines_of("three")), (5, "http://h/c", lines_of("four")),
        (6, "http://pair/a", "".join(f"<p>{t}</p>" for t in body)), (7, "http://pair/b", "".join(f"<p>{t}</p>" for t in body[1:])),
    ]
    got = ran(spark, rows)
    for day in (1, 2, 3):
        assert got[day][0] == "\n\n".join([*body, f"day {day}"]) and got[day][2] == 2
    assert got[6][0] == "\n\n".join(body) and got[7][0] == "\n\n".join(body[1:])


def test_a_line_on_many_pages(spark):
    """A host of copies, each page twice: the line that all share goes, each page's own stays."""
    rows = [(i, f"http://h/{i // 2:04d}", f"<p>menu</p><p>own {i // 2}</p>") for i in range(200)]
    assert ran(spark, rows) == {i: (f"own {i // 2}", len(f"own {i // 2}"), 1) for i in range(200)}


@pytest.mark.parametrize("page,want", [
    ("<article class='post no-comments'>a</article>", ["a"]), ("<div id='page' class='site no-sidebar'>a</div>", ["a"]),
    ("<div class='content with-banner'>a</div>", ["a"]), ("<div class='share-price'>a</div>", ["a"]),
    ("<section class='related-work'>a</section>", ["a"]), ("<article class='comments'>a</article>", ["a"]),
    ("<div class='sidebar-right'>x<main><p>a</p></main>y</div>", ["a"]), ("<div class='post-has-sidebar'>a</div>", ["a"]),
    ("<div class='ad'>x</div><p class='ad-box'>x</p><div id='top_ad'>x</div>a", ["a"]),
    ("<div class='sidebar'>x</div><ul class='share-buttons'><li>x</ul><p id='comment-7'>x</p>a", ["a"]),
    ("<div class='responses'>x</div><div id='disqus_thread'>x</div><div class='top-bar'>x</div><p class='copyright'>x</p>a", ["a"]),
    ("<article><p class='notice'>a</p><p class='menu'>b</p><div class='comment'>c</div></article>", ["a", "b", "c"]),
    ("<article>a<ol class='comment-list'><li>x</ol><div class='notice-box'>x</div><div class='share'>b</div></article>", ["a", "b"]),
    ("<article>a<div class='ad'>x</div><p class='ad'>x</p><section class='comments'><p>x</section><div id='disqus_thread'>x</div></article>", ["a"]),
    ("<main>a<div class='comments'><article>x</article></div></main>", ["a"]), ("<nav><main>x</main></nav>a", ["a"]),
])
def test_names_of_layout_and_state(page, want):
    assert texts(page) == want


def test_main_around_an_article(spark):
    """What stands in main beside an article stays, unless it is the site's."""
    rows = [(1, "http://h/1", "<main><h1>T</h1><p>lede</p><article>related teaser</article></main>")]
    rows += [
        (10 + n, f"http://site/{n}", f"<p>menu</p><main><p>Our app</p><p>lede {n}</p><article><p>text {n}</p><p class='notice'>{note}</p></article></main>")
        for n, note in enumerate(["Terms of use", "Terms of use", "Terms of use", "The law of 1901"])
    ]
    got = ran(spark, rows)
    assert got[1] == ("T\n\nlede\n\nrelated teaser", 23, 0)
    for n in range(3):
        assert got[10 + n] == (f"lede {n}\n\ntext {n}", 14, 2), n
    assert got[13] == ("lede 3\n\ntext 3\n\nThe law of 1901", 31, 1)


def test_near_copies_under_many_paths(spark):
    body = "".join(f"<p>line {i}</p>" for i in range(8))
    rows = [(n, f"http://h/{'abcdefgh'[n]}/x", body + f"<p>own {n}</p>") for n in range(4)]
    rows += [(10 + n, f"http://k/{n}", f"<p>menu</p>{body}<p>own {n}</p>") for n in range(4)]
    rows += [(20 + n, f"http://k/z{n}", f"<p>menu</p><p>one {n}</p><p>two {n}</p>") for n in range(4)]
    got = ran(spark, rows)
    want = [f"line {i}" for i in range(8)]
    for n in range(4):
        assert got[n] == ("\n\n".join([*want, f"own {n}"]), len("\n\n".join([*want, f"own {n}"])), 0)
        assert got[10 + n][0] == "\n\n".join([*want, f"own {n}"]) and got[10 + n][2] == 1
        assert got[20 + n][0] == f"one {n}\n\ntwo {n}" and got[20 + n][2] == 1


@pytest.mark.parametrize("piece", ["<b>{}</i>", "<font>{}<p>x", "<div>{}</span>", "<li>{}<p>", "<article>{}</main>"])
def test_time_is_linear_in_open_elements(piece):
    import time

    def seconds(n):
        first, second = piece.split("{}")
        html = first * n + second * n
        start = time.perf_counter()
        page_lines(html)
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(100_000) < 60 * max(seconds(5_000), 0.02)


def test_clashing_columns(spark):
    schema = "page_id long, url string, html string, `loose.x` int, host string, path string, at long, bare string"
    rows = [(n, f"http://h/{n}", f"<p>menu</p><p>own {n}</p>", 1, "h", "p", 3, "b") for n in range(4)]
    got = extract_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id, r.text) for r in got) == [(n, f"own {n}") for n in range(4)]
