import tracemalloc

import pytest

from sluicebox.llm import html


@pytest.mark.parametrize("page,text", [
    ("<article><h1>T</h1><p><b>one<br>two<p>three &amp; f&ouml;ur&#33;</article><footer>no</footer>", "T\n\none two\n\nthree & föur!"),
    ("<nav><ul><li>menu</ul></nav><main><p>a <i>b</i>c</p><aside>no</aside><p>  d\n e </p></main><div class='cookie-notice'>no</div>", "a bc\n\nd e"),
    ("<body><header>site</header><article><header><h1>T</h1></header><p>x</p><form>f<input></form><section class='comments'><p>c</p></section></article>", "T\n\nx"),
    ("<div id=sidebar>no</div><div class='post-content'><p>yes</p><div class='ad slot'>no</div></div><div>outside</div>", "yes"),
    ("<p>only text</p><script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> -->", "only text"),
    ("<article>1 < 2 and <b>3 > 2</b></article>", "1 < 2 and 3 > 2"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\n\nc"),
    ("<article><p title=\"a>b\">x</p><img alt='y'><p>open", "x\n\nopen"),
    ("<article><script>never closed <p>no", ""), ("", ""), (None, ""), ("plain", "plain"), ("<", "<"), ("<article></article>", ""),
    ("<div role=navigation>n</div><div role=main>m</div>", "m"),
    ("<article>&am &amp &a &nbsp;x</article>", "&am & &a x"),
])
def test_main_text(page, text):
    assert html.main_text(page) == text


def page(n, extra=""):
    return (
        f"<html><head><title>t{n}</title></head><body><div><a href='/{n}'>home</a><a>news</a></div><div><p>Menu of the site</p></div>"
        f"<div><h1>Title {n}</h1><p>Text {n} of <b>article</b> {n}.</p>{extra}<p>All rights reserved by us</p></div></body></html>"
    )


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, template int")


def test_template_texts_are_left_out(spark):
    rows = [(n, f"https://Site.example/{n}?a", page(n, "<p>more</p>" * (n % 3))) for n in range(30)]
    rows += [(100, "https://other.example/", "<p>All rights reserved by us</p><p>own</p>"), (101, None, None), (None, "x", page(7)), (1, rows[1][1], rows[1][2])]
    found = html.extract_text(frame(spark, rows), min_pages=5, fixed_text_pages=20).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r for r in found}
    for n in range(30):
        assert by_id[n].text == "\n\n".join([f"Title {n}", f"Text {n} of article {n}.", *["more"] * (n % 3)])
        assert by_id[n].n_chars == len(by_id[n].text)
    assert by_id[100].text == "All rights reserved by us\n\nown" and by_id[101].text == ""


def test_few_pages_keep_their_texts(spark):
    rows = [(n, "http://a/", f"<article><p>same</p><p>own {n}</p></article>") for n in range(4)]
    assert sorted(r.text for r in html.extract_text(frame(spark, rows)).collect()) == [f"same\n\nown {n}" for n in range(4)]
    assert html.extract_text(frame(spark, [])).collect() == []


def test_classes_out_of_order_are_not_valid():
    nodes = [n for n in html.parse("<div><i>a</i></div><p>b</p>")]
    order = [n.token for n in nodes if n.kind != "text"]
    assert html.template_tokens(nodes, [{"tokens": order}]) == set(order)
    assert html.template_tokens(nodes, [{"tokens": order[::-1]}]) == set()
    assert html.template_tokens(nodes, [{"tokens": [*order, 12345]}]) == set()


def test_hosts():
    assert html.host_of("https://u:p@A.b:80/x") == "a.b" and html.host_of("nothing") == html.host_of(None) == ""


def article(n, heading, paragraphs, extra=""):
    return (
        f"<html><body><div><a href='/'>home</a><p>Menu of the site</p></div><article><h1>{heading}</h1>{extra}"
        + "".join(f"<p>{p}</p>" for p in paragraphs) + f"</article><div><p>All rights reserved</p><i>{n}</i></div></body></html>"
    )


@pytest.mark.parametrize("marked", [True, False])
@pytest.mark.parametrize("dated", [True, False])
def test_texts_of_copied_pages_are_kept(spark, marked, dated):
    own = [[f"Paragraph {k} of the article {n}" for k in range(6)] for n in range(60)]
    copied = [f"Copied paragraph {k} that stands on thirty pages" for k in range(40)]
    date = lambda n: f"<p>Copy of day {n}</p>" if dated else ""
    rows = [(n, f"http://a/{n}", article("-", f"Heading {n}", own[n])) for n in range(60)]
    rows += [(n, f"http://a/{n}", article("-", "Copied", copied, date(n))) for n in range(60, 90)]
    if not marked:
        rows = [(n, url, page.replace("article>", "section>")) for n, url, page in rows]
    found = {r.page_id: r.text for r in html.extract_text(frame(spark, rows)).collect()}
    for n in range(60):
        assert found[n] == "\n\n".join([f"Heading {n}", *own[n]])
    for n in range(60, 90):
        assert found[n] == "\n\n".join(["Copied", *[f"Copy of day {n}"] * dated, *copied])


@pytest.mark.parametrize("page,text", [
    ("<div class='layout sidebar-right'><article><p>the text</article><div>x</div></div><div class=sidebar>no</div>", "the text"),
    ("<main class='has-sidebar'><p>the text</p><div class='share'>no</div></main>", "the text"),
    ("<article class='post share-enabled'><p>the text</article>", "the text"),
    ("<div class='has-comments'><div class='banner-top'><main><p>the text</main></div></div>", "the text"),
    ("<main><p>the main text of the page</p><article class=card><p>card</article></main>", "the main text of the page\n\ncard"),
    ("<div class=content><p>the text of the page</p><article><p>card</article></div>", "the text of the page\n\ncard"),
    ("<article><p>the text of the page</article><div class=comments><article><p>comment</article></div>", "the text of the page"),
    ("<div class='post'><p>the text of the page</p></div><div class=related><article><p>card</article></div>", "the text of the page"),
    ("<div class=menu-open><article><p>first</article><article><p>second</article></div>", "first\n\nsecond"),
    ("<div><p>an unmarked text</p></div><div class=comments><article><p>reply</article></div>", "an unmarked text\n\nreply"),
    ("<main><p>crumbs</p><article><p>the text of the page</article></main>", "the text of the page"),
])
def test_names_drop_no_article(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("page", ["<div class='a'>" * 20_000 + "x", "<article>t" * 20_000, "<div class='ad'>t<article>u" * 10_000],
                         ids=["divs", "articles", "named"])
def test_deeply_nested_pages_stay_small(page):
    """A few hundred kB of nested tags: what is kept of an element does not grow with its depth."""
    tracemalloc.start()
    nodes = html.parse(page)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(nodes) > 20_000 and peak < 100_000_000
    assert isinstance(html.main_text(page, None), str)
