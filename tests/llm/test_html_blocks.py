import pytest

from sheaf.llm import html_blocks as H


@pytest.fixture(scope="module")
def tree():
    return H.Tree(*H.labelled_table())


def test_tree_fits_its_table():
    x, y = H.labelled_table()
    assert 60 < len(y) < 250 and (H.Tree(x, y).predict(x) == y).all()


CASES = [
    (None, ""), ("", ""), ("<p>", ""), ("<", ""), ("<div" * 40, ""),
    # page furniture by tag, class, id and role
    ("<nav><a>Home</a></nav><article><h1>T &amp; U</h1><p>One\n two&nbsp;three.<p>x</article><footer>f</footer>",
     "T & U\nOne two three.\nx"),
    ('<body class="has-sidebar"><div id="cookie-banner"><p>We use cookies to make this long text better for all of you, '
     'dear readers of our pages.</p></div><div class="post-content"><h2>Title</h2><p>First &eacute; text.<br>second</p></div>'
     '<div class="sidebar-content"><p>Popular things with a long text that goes on and on and on and on</p></div>',
     "Title\nFirst é text. second"),
    ('<main><p>Body text.</p><div role="search"><p>Search</p></div><form><p>Your name</p></form><p>End.</p></main>',
     "Body text.\nEnd."),
    ('<article><p>Text.</p><section class="comments"><article><p>A comment that is long enough to look like main '
     'text to any word count</p></article></section></article>', "Text."),
    ("<article><header><h1>T</h1></header><p>Hi<aside>Pull quote</aside><p>there</article>", "T\nHi\nthere"),
    # what shows no text, truncated and unclosed markup
    ('<script>var t="</p><article>";</script><style>p{}</style><article><p>a<!-- b --><script>x</script>c</p><p>d',
     "ac\nd"),
    ("<article><p>a<p><b>b<p>c</article><p>after", "a\nb\nc"),
    ("<article><p>cut &am", "cut &am"), ("<article><p>x < y & z &lt; &#65;&#x42; &nosuch;</p>", "x < y & z < AB &nosuch;"),
    # a self-closed svg is an empty element; a script cannot be self-closed
    ('<article><p>One<svg class="icon" width="1"/> two</p><svg/><p>three</p><svg viewBox="0 0 1 1"><text>x</text></svg>'
     '<p>four<SVG id="a" /></article>', "One two\nthree\nfour"),
    ("<article><p>One</p><script src=x /><p>var</p></script><p>two</article>", "One\ntwo"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one\ntwo\na\nb"),
]


CASES += [
    # as browsers read it: quotes in unquoted values, quotes without an equals sign, empty comments
    ("<article><p title=it's>One</p><p class=a'b data-x=\"c>d\">two</p><p 'odd>three</p></article>", "One\ntwo\nthree"),
    ("<article><p>One<!-->two<!--->three<!-- > -- -->four<!-- a --!>five</article>", "Onetwothreefourfive"),
    ('<article><p title = "a>b" x=1/2>One<br/>two</p></article>', "One two"),
    # however deep a block lies in inline markup
    ("<article><p><b><i><u><em><strong>One<div>two</div></strong></em></u></i></b></article>", "One\ntwo"),
]

_LINE = "The harbour office said that the ferry would run again from Monday, once the pier had been mended and tested."
HELD_OUT = [
    # plain pages that are not in the labelled table: neighbours and links decide
    (f"<div><p>{_LINE}<p>He said no.<p>{_LINE}</div>", f"{_LINE}\nHe said no.\n{_LINE}"),
    (f"<p>{_LINE}<p>{_LINE}<ul><li><a>Seven plain facts about the old ferry and its crew</a><li><a>What the pier has cost the "
     f"town in ten years</a></ul>", f"{_LINE}\n{_LINE}"),
    (f"<ul><li><a>Start</a><li><a>Harbour</a></ul><div><p>{_LINE}<p>{_LINE}</div><p><a>Imprint</a>", f"{_LINE}\n{_LINE}"),
]


@pytest.mark.parametrize("page,text", HELD_OUT)
def test_held_out_plain_pages(tree, page, text):
    assert H.extract(page, tree) == text


def test_tree_splits_on_links_and_neighbours(tree):
    used = {H.FEATURES[f] for f, *_ in tree.nodes if f >= 0}
    assert "links" in used and used & {"words_before", "links_before", "words_after", "links_after"}


@pytest.mark.parametrize("page,text", CASES)
def test_cases(tree, page, text):
    assert H.extract(page, tree) == text


def test_deep_and_long_pages(tree):
    page = "<article>" + "<div>" * 3000 + "<p>deep</p>" + "</div>" * 3000 + "<p>" + "word " * 100_000 + "</article>"
    got = H.extract(page, tree).split("\n")
    assert got[0] == "deep" and got[1].count(" ") == 99_999


def test_plain_pages_use_words_and_links(tree):
    long = "This is a paragraph of running text with enough words in it to look like the main text of a page. " * 2
    page = f"<p><a>Home</a> <a>News</a><p>{long}<p>{long}<p><a>Terms</a> <a>Privacy</a>"
    assert H.extract(page, tree) == "\n".join([long.strip()] * 2)


def test_query_over_odd_rows(spark):
    df = spark.createDataFrame([(1, "u", "<article><p>é 漢 😀</p></article>"), (1, "u", "<article><p>é 漢 😀</p></article>"),
                                (None, None, None), (2, "v", "")], "page_id long, url string, html string")
    df = df.selectExpr("*", "1 AS text", "2 AS n_chars")
    got = H.main_text(df).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, "u", "é 漢 😀", 5)] * 2 + [(None, None, "", 0), (2, "v", "", 0)],
                                                       key=repr)
    assert H.main_text(df.limit(0)).collect() == []


def test_generated_pages(spark):
    """Every sf0.01 page: the blocks of its article element, by a plain split."""
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in H.main_text(pages).collect()}
    for r in pages.collect():
        inner = r.html.split("<article>", 1)[1].split("</article>", 1)[0] if r.html and "<article>" in r.html else ""
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*(>|$)", "", p.replace("<br>", " ")))).strip()
                 for p in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id] == "\n".join(p for p in parts if p)
