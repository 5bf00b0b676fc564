"""Main text by structure and by the nearest page of the host."""

import itertools
import random
import time

import pytest
from helpers import SMALL
from hypothesis import given, settings, strategies as st

from riskloom.llm import html


def text_of(page):
    main, rest = html.blocks(page)
    return "\n".join(main or rest)


@pytest.mark.parametrize("page, want", [
    ("<article><h1>A &amp; B</h1><p>one\n  two<br>three</article><footer>x</footer>", "A & B\none two\nthree"),
    ("<nav><li>m</nav><main><p>a<p>b <b>c</main><div class='ad'>d</div>", "a\nb c"),
    ("<article><p>a</p><div class='share-box'>s</div><form>f<input></form><p>b&#233;&nbsp;c</p></article>", "a\nbé c"),
    ("<article><header><h1>T</h1></header>x<script>var a='</p>';</script><style>p{}</style><!-- <p>no</p> --></article>", "T\nx"),
    ("<article>a<section id='comments'><p>c</section><aside>z</aside></article>", "a"),
    ("<p>x</p><div hidden>y</div><p style='display: none'>z</p>", "x"),
    ("<article><p title='a>b'>q</p></article>", "q"),
    ("<article><ul><li>1<li>2</ul><table><tr><td>3<td>4</table></article>", "1\n2\n3\n4"),
    ("<article><p>cut off", "cut off"),
    ("<article><p>Hello <b>big</b> world</p></article>", "Hello big world"),
    ("<article><p>See <a href=x>this link</a>, then go <em>on</em>.</p><p>n<sup>2</sup><span> x</span></article>", "See this link, then go on.\nn2 x"),
    ("<article>a<b>b<div>c</div>d</b>e</article>", "ab\nc\nde"),
    ("<article><p>a <span hidden>x</span> b</article>", "a b"),
    ("<article>a<div id='reader-comments'><p>c</div><ol class='post-comments'><li>d</ol><p class='reply-box-7'>e</p></article>", "a"),
    ("<div class='post with-comments'><article class='comments-open'>a</article></div>", "a"),
    ("", ""), ("plain & text", "plain & text"), ("<<<>>> a < b", "<<<>>> a < b"), ("<script>never closed", ""),
])
def test_blocks(page, want):
    assert text_of(page) == want


@pytest.mark.parametrize("page, want", [
    ("<div class='layout has-sidebar'><article><p>a</article><div class='sidebar'>s</div></div>", "a"),
    ("<div class='no-sidebar'><p>a</div>", "a"),
    ("<body><div class='page with-banner'><main>a</main></div>", "a"),
    ("<table><tr><td class='content menu-left'><p>a</table>", "a"),
    ("<div class='banner'>b<article>a</article>c</div>", "a"),
    ("<header>h<main>a</main></header>", "a"),
    ("<article><div class='article-header'>t</div><p class='notice-of-results'>r</p></article>", "t\nr"),
    ("<article>a</article><div class='comments'><article>c</article></div><nav><article>n</article></nav>", "a"),
    ("<article>a<div class='promo'><article>c</article></div></article><div id='site-header'>h</div>", "a"),
    ("<div class='site-header'>h</div><div class='ad-slot-3'>d</div><p>a", "a"),
])
def test_wrappers_of_an_article_stay(page, want):
    assert text_of(page) == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/=\"' apdivscrt!-&;", max_size=200))
def test_any_markup_is_read(page):
    text_of(page)


def longest(one, two):
    for n in range(len(one), -1, -1):
        for places in itertools.combinations(range(len(one)), n):
            other = iter(two)
            if all(one[i] in other for i in places):
                return n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=8), st.lists(st.integers(0, 3), max_size=8))
def test_common_lines_are_longest(one, two):
    places = html.common(one, two)
    assert places == sorted(set(places)) and len(places) == longest(one, two)
    other = iter(two)
    assert all(one[i] in other for i in places)


def test_equal_lines_by_the_thousands_are_aligned_in_seconds():
    rng = random.Random(4)
    begun = time.monotonic()
    assert html.common([7] * 100_000, [7] * 99_000) == [*range(99_000)]
    one, two = ([rng.randint(0, 3) for _ in range(n)] for n in (20_000, 21_000))
    places = html.common([1, *one, 2], [0, *two, 3])
    other = iter([0, *two, 3])
    assert all([1, *one, 2][i] in other for i in places) and len(places) > 12_000
    assert time.monotonic() - begun < 60


def wide(i, own, k=40):
    return "".join(f"<div>Frame {j}</div>" for j in range(k)) + "".join(f"<p>{own} {j}</p>" for j in range(5)) + "<div>End</div>"


@pytest.mark.parametrize("parts", [1, 4, 60])
def test_large_frames_and_runs_of_copies(spark, parts):
    """Forty blocks of frame beside five own ones; pages in runs of one to thirty copies, longer than some partitions."""
    rows, want, at = [], {}, 0
    for group in range(12):
        for _ in range((1, 30, 2, 7)[group % 4]):
            rows.append((at, f"http://one.host/{at:04d}", wide(at, f"Own words of {group}")))
            want[at] = "\n".join(f"Own words of {group} {j}" for j in range(5))
            at += 1
    rows += [(900 + i, f"http://two.host/{i}", "<p>same on all</p>") for i in range(5)]
    want.update({900 + i: "same on all" for i in range(5)})
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
        assert {r.page_id: r.text for r in html.extract(df).collect()} == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def frame(i, body):
    return f"<div>Site of things</div><div><p>{body}</div><div>About us</div><p>All rights reserved"


def test_frames_of_a_site_go_by_differencing(spark):
    rows = [(i, f"http://A.b/{i // 10}/{i:03d}?x={i}", frame(i, f"Own text {i}")) for i in range(60)]
    rows += [(100, "http://z.z/1", "<p>alone</p>"), (101, None, None), (102, "http://c.c/1", frame(0, "same")), (103, "http://c.c/2", frame(0, "same")),
             (None, "http://y.y/", "<article>n</article>"), (100, "http://z.y/1", "<p>again</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'k' AS row", "'k' AS lines", "1 AS open").repartition(5)
    got = html.extract(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    texts = {}
    for r in got:
        texts.setdefault(r.page_id, []).append(r.text)
    assert all(texts[i] == [f"Own text {i}"] for i in range(60))
    assert sorted(texts[100]) == ["again", "alone"] and texts[101] == [""] and texts[None] == ["n"]
    assert texts[102] == texts[103] == ["Site of things\nsame\nAbout us\nAll rights reserved"]  # copies tell nothing
    assert html.extract(df.limit(0)).collect() == []


def test_one_hot_host_over_many_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    rows = [(i, f"http://hot.host/{i:04d}", frame(i, f"Words of {i}")) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(9)
    assert {r.text for r in html.extract(df).collect()} == {f"Words of {i}" for i in range(300)}
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_given_pages_keep_their_article(spark):
    df = spark.read.parquet(f"{SMALL}/pages.parquet")
    for r, page in zip(*(sorted(x.collect(), key=lambda r: r.page_id) for x in (html.extract(df), df))):
        article = page.html.split("<article>")[1].split("</article>")[0]
        for tag in ("p", "b", "h1", "br"):
            article = article.replace(f"<{tag}>", " ").replace(f"</{tag}>", " ")
        import html as library

        assert r.text.split() == library.unescape(article).split()


def test_marked_pages_are_differenced_and_checked(spark):
    """A teaser inside the article goes where neighbours share it; shared text of the article itself stays."""
    def page(i):
        return (f"<article><h1>Title {i}</h1><p>Licensed to all.</p><p class='subscribe-teaser'>Get our letter</p>"
                f"<p class='notice-of-results'>Result {i}</p></article>")

    rows = [(i, f"http://m.m/{i:02d}", page(i)) for i in range(8)] + [(90, "http://n.n/1", page(90))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    texts = {r.page_id: r.text for r in html.extract(df).collect()}
    assert all(texts[i] == f"Title {i}\nLicensed to all.\nResult {i}" for i in range(8))
    assert texts[90] == "Title 90\nLicensed to all.\nGet our letter\nResult 90"


def test_every_page_with_blocks_meets_its_neighbours(spark):
    seen = [(0, "h", "1", True, [], [1, 2]), (1, "h", "2", False, [], [1, 3]), (2, "h", "3", True, [0], [4]), (3, "h", "4", False, [], [])]
    df = spark.createDataFrame(seen, "row long, host string, path string, marked boolean, doubts array<int>, hashes array<long>")
    got = {r.row: (r.before, r.after) for r in html._neighbours(df).collect()}
    assert got == {0: (None, [1, 3]), 1: ([1, 2], [4]), 2: ([1, 3], [])}
