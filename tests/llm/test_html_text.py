import html
import re

import pytest

from holdfast.llm import html_text as ht

ARTICLE = "<h1>Title</h1><p>First &amp; <b>bo</b>ld\n text.<br>More<p>Second &lt;p&gt;<ul><li>x<li>y</ul>"
EXPECTED = "Title\nFirst & bold text. More\nSecond <p>\nx\ny"
JUNK = (
    "<nav><a href=/>Home</a></nav><header>Head</header><aside>Side of the page</aside>"
    "<div class='ad-slot'>Buy</div><div id=cookie-notice>Cookies</div><form><p>Mail</p><button>Go</button></form>"
    "<div class=comments><p>A long comment of a reader, much longer than the article itself could ever be.</p></div>"
    "<script>var x='<p>no</p>'</script><style>p{}</style><!-- <p>none</p> --><footer>&copy; Foot</footer>"
)


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("plain  text &amp;\n more", "plain text & more"),
        ("<p>a<p>b", "a\nb"),
        (f"<html><body>{JUNK}<article>{ARTICLE}{JUNK}</article>{JUNK}</body></html>", EXPECTED),
        (f"<body>{JUNK}<div class='has-sidebar content'><div class=post-1>{ARTICLE}</div></div>{JUNK}", EXPECTED),
        (f"<body><article>{ARTICLE}", EXPECTED),
        ("<article><p>a</b></i>b</article></div></div>", "ab"),
        ("<article><p>a<b>b<p>c</b>d</article>", "ab\ncd"),
        ("<article><p><a href=x>all link</a></p></article>", "all link"),
        ("<div hidden>no</div><p>yes</p>", "yes"),
        ("<article><p>a</p><div class=post-comments><p>no</p></div><section itemprop=comment>no</section></article>", "a"),
        ("<article class=ad-story><p>a</p><span class=adBadge>Ad</span><ul id=main-menu><li>no</ul>b</article>", "a\nb"),
        ("<article>&#x41;&nbsp;&eacute;&bogus; &lt</article>", "A \u00e9&bogus; <"),
        ("<<p>x</p", "<\nx"),
    ],
)
def test_main_text(html, text):
    assert ht.main_text(html, None)[0] == text


PROSE = "We compare the yields of all four sites with those of the year before. " * 4
LINKS = "".join(f"<li><a href=/{i}>Another story, number {i}</a></li>" for i in range(9))


@pytest.mark.parametrize(
    "inside, text",
    [
        ("<h2 id=related-work>Related work</h2><p>a</p><h3 id=search>Search</h3><p>b</p>", "Related work\na\nSearch\nb"),
        ("<h2 id='login-form'>Login</h2><p>a</p>", "Login\na"),
        (f"<section id=discussion><h2>Discussion</h2><p>{PROSE}</p></section>", f"Discussion\n{PROSE.strip()}"),
        ("<p>First</p><section id=navigation><h2>Navigation</h2><p>By the stars.</p></section>", "First\nNavigation\nBy the stars."),
        ("<p>Mass is <math><mi>m</mi><mo>=</mo><mn>2</mn></math>.</p>", "Mass is m=2."),
        (f"<p>{PROSE}</p><div class=related><h3>Related</h3><ul>{LINKS}</ul></div>", PROSE.strip()),
        (f"<p>{PROSE}</p><div class=share>Share this</div><div class=notice>Closed today.</div>", PROSE.strip()),
        (f"<p>{PROSE}</p><section id=comments><h2>Comments</h2><p>{PROSE * 3}</p></section>", PROSE.strip()),
        (f"<div class='widget Blog'><p>{PROSE}</p><div class='widget'><ul>{LINKS}</ul></div></div>", PROSE.strip()),
    ],
)
def test_ambiguous_names(inside, text):
    assert ht.main_text(f"<body><article>{inside}</article></body>", None)[0] == text


@pytest.mark.parametrize("times", [4, 400])
@pytest.mark.parametrize(
    "page, text",
    [
        ("<div class=post><h1>Title</h1><div class=body><p>{0}</p></div></div>", "Title\n{0}"),
        ("<h1>Title</h1><div class=post><p>{0}</p></div>", "Title\n{0}"),
        ("<div class=wrap><div class=lead>A lead.</div><div class=body><p>{0}</p></div><div class=end>An end.</div></div>", "A lead.\n{0}\nAn end."),
        ("<article><h1>Title</h1><div><div><div><div><div><p>{0}</p></div></div></div></div></div></article>", "Title\n{0}"),
        ("<div class=wrap><div class=body><p>{0}</p></div><ul>{1}</ul></div>", "{0}"),
    ],
)
def test_text_beside_the_best_container(page, text, times):
    prose = (PROSE * times).strip()
    found, _ = ht.main_text(f"<html><body>{page.format(prose, LINKS)}</body></html>", None)
    assert found == text.format(prose)


def test_a_page_of_another_layout_keeps_its_article(spark):
    usual = f"<body><div class=post><p>{PROSE}</p></div><div class=box><p>short</p></div></body>"
    other = f"<body><div class=post><p>Hint</p></div><div class=story><p>{PROSE * 9}</p></div></body>"
    pages = [(i, "http://a.org/x", usual) for i in range(4)] + [(9, "http://a.org/y", other)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in ht.extract_pages(df).collect()}
    assert found[0] == PROSE.strip() and found[9] == (PROSE * 9).strip()


def test_blog_inside_a_widget():
    page = f"<body><div class=column><div class='widget Blog' id=Blog1><h3>Post</h3><p>{PROSE}</p></div></div></body>"
    assert ht.main_text(page, None)[0] == f"Post\n{PROSE.strip()}"


def test_the_hosts_path_decides(spark):
    """One page's largest container is not the article; the host's other pages outvote it."""
    usual = "<body><div class='text-7'><p>{0}</p></div><div class=box><p>{1}</p></div></body>"
    pages = [(i, "http://a.org/x", usual.format("long article " * 20, "short")) for i in range(4)]
    pages += [(9, "http://A.org/y", usual.format("brief", "long box " * 20))]
    pages += [(10, "http://b.org/y", usual.format("brief", "long box " * 20)), (11, None, None), (12, "http://a.org", "<p>loose</p>")]
    df = spark.createDataFrame([(*p, "h") for p in pages], "page_id long, url string, html string, host string")
    found = {r["page_id"]: r for r in ht.extract_pages(df).collect()}
    assert found[9]["text"] == "brief" and found[10]["text"] == ("long box " * 20).strip()
    assert found[0]["path"].endswith("/div.text-#")
    assert found[11]["text"] == "" and found[12]["text"] == "loose"
    assert all(r["n_chars"] == len(r["text"]) for r in found.values()) and len(found) == len(pages)
    assert ht.extract_pages(df.limit(0)).count() == 0


def test_pages_of_the_test_table(spark):
    rows = ht.query(spark, "/root/testdata/sf0.001").collect()
    assert {r["path"] for r in rows} == {"/body/article"}
    assert all(r["text"] and "track(" not in r["text"] for r in rows)
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()


@pytest.mark.parametrize("tag", ["div", "b", "font", "p"])
def test_very_deep_page(tag):
    html = f"<body>{f'<{tag}>' * 30_000}deep{f'</{tag}>' * 20_000}</i> end"
    assert ht.main_text(html, None)[0].replace("\n", " ").replace("  ", " ") == "deep end"


def test_very_long_page():
    html = "<body><article>" + "<p>word &amp; word</p>" * 20_000 + "<a title='unclosed>" * 50
    assert ht.main_text(html, None)[0].startswith("word & word\nword & word")


WHOLE = f"<h1>Title</h1><p>{PROSE * 3}</p><p>{PROSE * 2}</p>"
WHOLE_TEXT = f"Title\n{(PROSE * 3).strip()}\n{(PROSE * 2).strip()}"
NOISE = f"<div class=sidebar><h3>Side</h3><p>{PROSE}</p></div><ul class=menu>{LINKS}</ul><div class=footer>Imprint</div>"


@pytest.mark.parametrize(
    "page",
    [
        "<div id='page' class='right-sidebar'>{0}{1}</div>",
        "<div class='menu-closed'>{0}{1}</div>",
        "<form id=aspnetForm><div>{0}</div>{1}</form>",
        "<form><div class='header'>Shop</div><article>{0}</article></form>{1}",
        "<div class='layout-sidebar'><div class=content>{0}</div>{1}</div>",
        "<div class='page-with-banner'><main>{0}</main></div>{1}",
        "<div class='banner main'>{0}</div>",
        "<div id='newsletter'><article>{0}</article></div>{1}",
        "{1}<div class='nav-open' id=main>{0}</div>",
        "<section class='toolbar-page'><div>{0}</div></section>{1}",
        "<article><header><h1>Title</h1></header>{2}</article>{1}",
        "<header><h1>Site</h1></header><article>{0}</article>{1}",
        "<div class=story>{0}</div><div class='cookie-consent'><p>We use cookies.</p></div>",
        "<div class='story social-studies'>{0}</div>{1}",
        "<div class=modal-open><div class=story>{0}<div class=share>Share this</div></div></div>{1}",
        "<article>{0}</article><section id=comments><article><p>Reader one says much. {0}</p></article></section>",
        "<div class=wrap><div class=story>{0}</div><div class=promo><p>Buy one</p></div></div>",
        "<div class=wrap><div class=story>{0}</div><div class='ad-slot top'><p>Buy two</p></div></div>",
        "<main>{0}</main><div role=complementary><p>Elsewhere</p></div><div role=contentinfo>c</div>",
        "<table><tr class=header><td>{0}</td></tr></table>",
    ],
)
def test_no_page_is_lost_by_a_name(page):
    body = page.format(WHOLE, NOISE, WHOLE.replace("<h1>Title</h1>", ""))
    assert ht.main_text(f"<html><body>{body}</body></html>", None)[0] == WHOLE_TEXT


@pytest.mark.parametrize(
    "inside, text",
    [
        (f"<div class='social-studies'><p>{PROSE}</p></div>", PROSE.strip()),
        (f"<div class='recommended-dosage'><h3>Dosage</h3><p>{PROSE}</p></div>", f"Dosage\n{PROSE.strip()}"),
        ("<p class='menu-price'>Soup: 4 francs.</p>", "Soup: 4 francs."),
        ("<p>It was 79 <span class='ad'>AD</span> when it broke out.</p>", "It was 79 AD when it broke out."),
        ("<p><span class='ad'>AD</span> 79 was the year.</p>", "AD 79 was the year."),
        ("<pre>x = 1 <span class='hljs-comment'># one</span>\ny</pre>", "x = 1 # one y"),
        ("<table><tr class='header'><th>Year</th><th class=menu>Dish</th></tr><tr><td>1</td><td>2</td></tr></table>", "Year\nDish\n1\n2"),
        ("<p>a</p><p class=ad>Buy</p><p class=advertisement>Sell</p>", "a"),
        ("<header><p>By a writer</p><h1>Title</h1></header><p>a</p>", "Title\na"),
        ("<p>a</p><!-- oops <p>lost?", "a"),
        ("<p>a</p><!-- one --><p>b</p><!-- two > <p>c</p>", "a\nb"),
        ("<p>a</p><script>var s = '<!-- '</script><p>b</p>", "a\nb"),
        ("<p>a <![CDATA[ kept? ]]> b</p>", "a b"),
        ("<p>a</p><div aria-hidden=true>no</div><p hidden>no</p>", "a"),
    ],
)
def test_names_that_say_little(inside, text):
    assert ht.main_text(f"<body><article><p>{PROSE * 4}</p>{inside}</article></body>", None)[0] == f"{(PROSE * 4).strip()}\n{text}"


@pytest.mark.parametrize("depth", [10, 70, 3_000])
def test_depth_changes_nothing(depth):
    """An article beside teasers, at any depth."""
    teasers = f"<div class=teasers><ul>{LINKS * 3}</ul></div>"
    page = f"<body>{'<div>' * depth}<div class=story>{WHOLE}</div>{teasers}{'</div>' * depth}</body>"
    assert ht.main_text(page, None)[0] == WHOLE_TEXT


def test_deep_pages_vote(spark):
    page = f"<body>{'<div>' * 2_000}<div class=story>{WHOLE}</div>{'</div>' * 2_000}</body>"
    df = spark.createDataFrame([(i, "http://a.org/", page) for i in range(3)], "page_id long, url string, html string")
    assert {r["text"] for r in ht.extract_pages(df).collect()} == {WHOLE_TEXT}


def plain_article(page):
    """What stands in the only article of a page, taken apart by expressions instead of a parser."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    inner = re.sub(r"<(script|style)\b.*?</\1>|<!--.*?-->", "", inner, flags=re.S)
    blocks = re.split(r"</?(?:p|h[1-6]|div|ul|ol|li|table|tr|td|th|blockquote|section|pre)\b[^>]*>", inner)
    texts = [html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br\b[^>]*>", " ", b))) for b in blocks]
    return "\n".join(filter(None, (" ".join(t.split()) for t in texts)))


def test_test_table_against_a_plain_extraction(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = {r["page_id"]: r["text"] for r in ht.query(spark, folder).collect()}
    assert found == {page_id: plain_article(page) for page_id, page in pages.items()}


@pytest.mark.parametrize(
    "url, host", [(None, ""), ("", ""), ("a.org/x", ""), ("http://A.org", "a.org"), ("x://y://z/", "y:"),
                  ("http://A.ÉX:80?q=/", "a.Éx:80"), ("s://h\n.org/p", "h\n.org"), ("://#f", "")]
)
def test_hosts(spark, url, host):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(ht.host_of(df["url"])).first()[0] == host
