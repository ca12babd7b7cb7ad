
from pyspark.sql import functions as F

from titlemill.functions import html
from titlemill.functions.feed import feed_categories, looks_like_feed

LONG = "This sentence is long enough to be kept as a paragraph."
OTHER = "Another sentence that also has more than forty characters."


def test_unescape(evaluate):
    cases = {
        "a &amp; b": "a & b",
        "&amp;lt;": "&lt;",
        "&#1090;&#x442;": "тт",
        "&hellip;&nbsp;": "… ",
        "&unknown; &amp &": "&unknown; &amp &",
        "&#55296;&#x10FFFF;": "�\U0010ffff",
        "plain": "plain",
        "&#0;": "�",
    }
    assert evaluate(html.unescape, list(cases)) == list(cases.values())


def test_title(evaluate):
    cases = {
        "<html><title> A &amp; B\n</title>": "A & B",
        "<TITLE lang='x'>T</TITLE><title>U</title>": "T",
        "<!-- <title>no</title> --><title>yes</title>": "yes",
        "<p>none</p>": "",
    }
    assert evaluate(html.page_title, list(cases)) == list(cases.values())


def test_meta(evaluate):
    cases = {
        '<meta property="og:title" content=" One ">': "One",
        "<meta content='It&#39;s' property='og:title'/>": "It's",
        '<meta property=og:title content=bare>': "bare",
        '<meta property="og:title"><meta property="og:title" content="second">': "",
        '<meta name="og:title" content="name">': "",
        '<meta property="og:title" content="a > b">': "a > b",
        '<!--<meta property="og:title" content="x">-->': "",
        '<meta data-property="og:title" content="no"><meta property="og:title" content="yes">': "yes",
    }
    got = evaluate(lambda c: html.meta_content(c, "property", "og:title"), list(cases))
    assert got == list(cases.values())


def test_organisation_markup(evaluate):
    def block(text):
        return f'<script type="application/ld+json">{text}</script>'

    org = '{"@type":"Organization","name":"N","description":"D","url":"U"}'
    cases = {
        block(org): ("N", "D", "U"),
        block("[" + org + ', {"@type":"WebSite","name":"later"}]'): ("N", "D", "U"),
        block("{bad json") + block(org): ("N", "D", "U"),
        block('{"@type":"MyOrganizationX","name":"sub"}'): ("sub", None, None),
        block('{"@type":["Thing","WebSite"],"name":"listed"}'): ("listed", None, None),
        block('{"@type":["MyWebSite"],"name":"no"}'): None,
        block('{"@type":"Person","name":"no"}') + block(org): ("N", "D", "U"),
        block('{"@graph":[' + org + "]}"): None,
        block('"text"'): None,
        f'<script type="text/javascript">{org}</script>': None,
        f"<script async type='application/ld+json' id=x>\n{org}\n</script>": ("N", "D", "U"),
        "": None,
    }
    got = evaluate(html.organisation_markup, list(cases))
    assert [g and (g["name"], g["description"], g["url"]) for g in got] == list(cases.values())


def test_body_text(evaluate):
    cases = {
        f"<p>{LONG}</p><p>short</p><p>{OTHER}</p>": f"{LONG} {OTHER}",
        f"<p>{OTHER}</p><main><p>{LONG}</p></main>": LONG,
        f"<article><p>{OTHER}</p></article><main><p>short</p></main>": OTHER,
        f"<article><p>{LONG}<b> bold </b>&amp; more</article><p>{OTHER}": f"{LONG} bold & more",
        f'<div class="x content y"><div><p>{LONG}</p></div><p>{OTHER}</p></div><p>{LONG}</p>': (
            f"{LONG} {OTHER}"
        ),
        f'<div class="contents"><p>{LONG}</p></div>': LONG,
        f'<div id="content"><div></div><p>{OTHER}</p></div><p>{LONG}</p>': OTHER,
        f'<div role="main"><p>{OTHER}</p></div><p>{LONG}</p>': OTHER,
        f"<section><p>{OTHER}</p></section><p>{LONG}</p>": OTHER,
        f"<article><p>{LONG}</p></article><p>x</p><article><p>{OTHER}</p></article>": (
            f"{LONG} {OTHER}"
        ),
        f"<script>var t='<p>{OTHER}</p>'</script><p>{LONG}</p>": LONG,
        f"<!-- <p>{OTHER}</p> --><p>{LONG}</p>": LONG,
        f"<p>{LONG}<br>{OTHER}<p>tail": f"{LONG} {OTHER}",
        f"<p>{'a' * 20}  {'b' * 19}</p><p>{'a' * 20}<i></i>{'b' * 21}</p>": (
            f"{'a' * 20}  {'b' * 19} {'a' * 20} {'b' * 21}"
        ),
        f"<p>{'a' * 20}</p><p>{'a' * 20}<i>{'b' * 20}</i></p>": "",
        f"<p>{LONG}<div>{OTHER}</div>": LONG,
        f"<pre><p>{LONG}</pre><param>{OTHER}": f"{LONG}",
        "": "",
    }
    got = evaluate(html.body_text, list(cases))
    for page, want, have in zip(cases, cases.values(), got):
        assert have == want, page


def test_body_text_is_cut(evaluate):
    page = "".join(f"<p>{'word ' * 100}</p>" for _ in range(20))
    assert len(evaluate(html.body_text, [page])[0]) == 3000


def test_body_text_of_a_large_page(spark):
    page = "<article>" + "".join(f"<div><p>{LONG}</p></div>" for _ in range(5000)) + "</article>"
    got = spark.createDataFrame([(page,)], "x string").select(html.body_text(F.col("x"))).first()[0]
    assert len(got) == 3000


def test_feed_categories_run_in_the_jvm(spark):
    df = spark.createDataFrame([("<rss/>",)], "x string").select(feed_categories(F.col("x")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_feed_categories(spark, evaluate):
    cases = {
        "<rss><channel><item><category> B </category><category>A</category></item>"
        "<item><category>A</category><category/></item></channel></rss>": ["A", "B"],
        '<feed xmlns="http://www.w3.org/2005/Atom"><entry><category term="t"/><category/></entry>'
        "</feed>": ["", "t"],
        "<feed><entry><category term='t'/></entry></feed>": [],
        "<rss><item><category>A</category>": [],
        "<rss/> tail": [],
        "not xml": [],
        "<rss>" + "".join(f"<item><category>c{i:02}</category></item>" for i in range(20)) + "</rss>": [
            f"c{i:02}" for i in range(15)
        ],
        None: None,
    }
    assert evaluate(feed_categories, list(cases)) == list(cases.values())
    more = {
        "<rss><item><category>A</category></item></rss>\n  \t": ["A"],
        "<rss><item><category>A</category></item></rss><rss/>": [],
        "<rss><item><category>A</category></item></rss> x": [],
        "<?xml version='1.0'?>\n<!-- c --><rss><channel><item><category>A &amp; B</category></item></channel></rss>": ["A & B"],
        "<rss><item><category>A</item></category></rss>": [],
        "<rss><item><category domain='x'>D</category></item></rss>": ["D"],
        "<rss><item><category><![CDATA[C]]></category></item></rss>": ["C"],
        '<feed xmlns="http://www.w3.org/2005/Atom"><entry><category term="t"/></entry></feed> x': [],
        "": [],
        "<rss>": [],
    }
    assert evaluate(feed_categories, list(more)) == list(more.values())
    marks = {"<?xml version='1.0'?><rss/>": True, " " * 296 + "<?xml": False, "<html>": False}
    assert evaluate(looks_like_feed, list(marks)) == list(marks.values())


def test_linked_data_inside_comments_is_passed_over(evaluate):
    block = lambda name: f'<script type="application/ld+json">{{"@type": "Organization", "name": "{name}"}}</script>'
    cases = {f"<!-- {block('no')} -->{block('yes')}": "yes", block("a <!-- b --> c"): "a <!-- b --> c", f"<!--{block('no')}-->": None}
    assert evaluate(lambda page: html.organisation_markup(page)["name"], list(cases)) == list(cases.values())


def _plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_a_feed_is_parsed_once(spark):
    df = spark.createDataFrame([("<rss/>",)], "x string")
    assert _plan(df.select(feed_categories(F.col("x")).alias("y"))).count("from_xml(") == 1


def test_feed_categories_are_trimmed_as_by_the_pattern(evaluate):
    values = [" A", "A ", "\tB\n", "C\u0085", "C \u0085", "\u00a0D", "", "  ", "A"]
    feed = "<rss><channel>%s</channel></rss>" % "".join(
        f"<item><category>{v}</category></item>" for v in values
    )
    assert evaluate(feed_categories, [feed]) == [["A", "B", "C\u0085", "\u00a0D"]]


def test_a_segment_is_taken_apart_once(spark):
    df = spark.createDataFrame([("<p>x</p>",)], "x string")
    assert _plan(df.select(html.body_text(F.col("x")).alias("y"))).count(html._TAG) == 2


def test_patterns_run_only_where_a_tag_may_match(evaluate):
    for upper in (False, True):
        case = (lambda text: text.upper()) if upper else (lambda text: text)
        page = case("<title>t</title><style>s</style><p>" + LONG + "</p>")
        assert evaluate(html.page_title, [page, "t", None]) == [case("t"), "", None]
        assert evaluate(html.body_text, [page, "t", None]) == [case(LONG), "", ""]
        assert evaluate(html.visible, [page, "t", None])[1:] == ["t", None]
        assert "s</" not in evaluate(html.visible, [page])[0].lower()


def test_tags_without_a_container_do_not_move_the_walk(evaluate):
    page = (
        f'<ul><li></ul><div><div class="content"><div></div><span></span></li><p>{LONG}</p></div>'
        f"<p>{OTHER}</p></div>"
    )
    assert evaluate(html.body_text, [page]) == [LONG]
