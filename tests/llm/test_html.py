import pytest

from ledgerlens.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy</div><div id="cookie-notice">Cookies</div>
<article><header><h1>Head &amp; line</h1></header><p><b>Bold x<br><p>One&nbsp; two
three</p><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><section class="comments"><p>Nice!</p></section><form>go</form></article>
<aside>Side</aside><footer>&copy; foot</footer></body></html>"""


def test_article_only():
    assert H.main_text(PAGE) == "Head & line Bold x One two three a b c d"


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a b"), ("<b>a</b>b <i>c</i>", "ab c"), ("a < b &lt; c &#233;", "a < b < c é"),
    ("<main><p>m</main><p>out", "m"), ("<p>x<script>if (a<b) {}</script>y", "xy"), ("<script>never closed <p>x", ""), ("<!-- open <p>x", ""),
    ("</div></p>ok<br/>then", "ok then"), ("<div style='overflow:hidden'>seen</div><div hidden>told</div>", "seen told"), ("<a href='x>y'>t</a", "t"),
    ("<div role=navigation>n</div><div class='Main_Menu'>m</div>text", "text"), ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep")])
def test_small_pages(page, text):
    assert H.main_text(page) == text


@pytest.mark.parametrize("page,text", [
    ("<div class='layout has-sidebar'><article><p>a</article></div>", "a"), ("<div class='no-sidebar'><p>x</div>", "x"), ("<div class='content with-comments'><main>m</main></div>", "m"),
    ("<div class='sidebar'><div><article>a</article></div></div><div class='sidebar'>s</div>", "a"), ("<form><div role=search><main>m</main></div></form>", "m"),
    ("<article><h2 id='related-work'>R</h2><section id='search'><h3 class='login'>L</h3><p>p</section><div id='notification-settings'>n</div><p class='social-science'>s</p></article>", "R L p n s"),
    ("<main><h1>H</h1><p>lead</p><article>a</article><div class='share-buttons'>b</div></main>", "H lead a"), ("<main>1</main><p>o</p><div role='main'>2</div><article>3</article>", "1 2 3"),
    ("<article>a<section class='comments'><article>c</article></section></article><div id='comments'><article class='comment-body'>d</article></div>", "a"),
    ("<div class='site-footer'>f</div><div id='cookie-notice'>c</div><div class='ad-slot'>d</div>t", "t")])
def test_furniture_is_named_as_a_whole(page, text):
    assert H.main_text(page) == text


MB = 1_000_000


@pytest.mark.parametrize("page", [
    "<a " * (MB // 3), "<a \"" * (MB // 4), "<a '\">" * (MB // 6) + "<p>x", "<a \"'" * (MB // 5) + ">", "<a b='" + "<p>c " * (MB // 5), "<p>x</p>" * 1000 + "<a \"" + "<i>y</i>" * (MB // 8),
    "<div>" * (MB // 10) + "</b>" * (MB // 8), "<i>" * (MB // 6) + "<hr>" * (MB // 8), "<p><button>" + "<i>" * (MB // 6) + "<hr>" * (MB // 8), "<li><ul>" + "<b>" * (MB // 6) + "<li>" * (MB // 8),
    "<div>" * (MB // 10) + "t" + "</div>" * (MB // 12), "<!-- " * (MB // 5), "<!x " * (MB // 4), "</" * (MB // 2), "<" * MB, "&amp" * (MB // 4), "<script>" * (MB // 8), "<td>" * (MB // 4), "<body>" * (MB // 6)])
def test_a_megabyte_of_bad_markup_takes_linear_time(page):
    import time
    t0 = time.process_time()
    H.main_text(page, {1})
    assert time.process_time() - t0 < 20


@pytest.mark.parametrize("page,text", [
    ("<p>a<a title=\"never closed>b</a><p>c", "ab c"), ("<p>x <a y <b>z", "x z"), ("a <b", "a <b"), ("<p>1 < 2 <!-- c --> 3", "1 < 2 3"), ("<p title='a>b'>t", "t"),
    ("<a b=\"x>y<!-- gone -->z", "y z".replace(" ", "")), ("</ p>q", "q"), ("<p>l<ul><li>a<p>b<li>c</ul>d", "l a b c d"), ("<table><tr><td>1<td>2<tr><td>3</table>4", "1 2 3 4")])
def test_odd_markup(page, text):
    assert H.main_text(page) == text


def test_template_counts_equal_brute_force(spark):
    from collections import Counter, defaultdict
    rows = [(i, f"https://h{i % 3}.example/{i}", f"<div><p>Own {i}</p><div>All</div><ul><li>Item {i % 2}</ul><section>Part {i % 4}</section></div>", "z") for i in range(40)]
    rows += [(100 + i, "https://h0.example/again", rows[0][2], "z") for i in range(5)]
    pages = defaultdict(set)
    for _, url, html, _ in rows:
        pages[url.split("/")[2]].add(html)
    want = set()
    for host, htmls in pages.items():
        n, value = Counter(), {}
        for h in htmls:
            own = H.subtrees(h)
            n.update(own.keys())
            value.update(own)
        want |= {(host, x) for x, c in n.items() if c >= H.MIN_PAGES and (c >= H.MIN_SHARE * len(htmls) or not value[x] and c >= H.MANY_PAGES)}
    assert {tuple(r) for r in H.site_templates(frame(spark, rows)).collect()} == want and want


def site(n):
    return [(i, f"https://H.example/{i}", f"<div><div><em>Our shop</em></div><p>Story {i} told.</p><p>Same line.</p><div><p>All about us</p></div></div>", "z") for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string")


def test_recurring_subtrees_go_per_host(spark):
    rows = site(6) + [(100 + i, "https://h.example/copy", "<div><p>Copied page</p></div>", "z") for i in range(9)]
    rows += [(200, "https://other.example/", "<div><em>Our shop</em></div><p>Other", "z"), (201, None, "<p>no host", "z"), (202, None, None, "z"), (203, "h", "", "z")]
    got = {r["page_id"]: r["text"] for r in H.extract(frame(spark, rows)).collect()}
    assert got[3] == "Story 3 told."            # what recurs on all pages of the host is its template
    assert got[100] == "Copied page"            # copies of one page are one page
    assert got[200] == "Our shop Other" and got[201] == "no host" and got[202] == "" and got[203] == ""
    assert H.extract(frame(spark, [])).count() == 0


def test_rotating_blocks_of_a_large_host_go(spark):
    rows = [(i, f"https://big.example/{i}", f"<div><p>Story {i} told.</p><div><b>Advert {i % 20}</b></div><table><tr><td>Row {i}<td>{i % 20}</table></div>", "z") for i in range(600)]
    rows += [(1000 + i, f"/r{i}", f"<p>Page {i}</p><div>Offer {i % 30}</div>", "z") for i in range(600)]  # without a host
    for most in (100_000, 0):
        got = {r["page_id"]: r["text"] for r in H.extract(frame(spark, rows), broadcast_rows=most).collect()}
        assert len(got) == len(rows) and all(got[i] == f"Story {i} told. Row {i} {i % 20}" for i in range(600))
        assert all(got[1000 + i] == f"Page {i}" for i in range(600))


def test_common_paragraphs_of_articles_stay(spark):
    rows = [(i, "https://a.example/x", f"<div class='box'><p>Shop</p></div><article><h1>N{i}</h1><div><span>promo text</span></div><p>Same passage.</p></article>", "z") for i in range(8)]
    assert {r["text"] for r in H.extract(frame(spark, rows)).collect()} == {f"N{i} Same passage." for i in range(8)}


def test_real_pages_keep_the_whole_article(spark):
    import html
    import re
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    have = {r["page_id"]: (r["text"], r["n_chars"]) for r in H.extract(rows).collect()}
    for r in rows.collect():
        body = re.search(r"<article>(.*)</article>", r["html"] or "", re.S)
        want = " ".join(html.unescape(re.sub(r"</?(?:p|h1|br)>", "\n", body[1]).replace("<b>", "").replace("</b>", "")).split()) if body else ""
        assert have[r["page_id"]] == (want, len(want))
