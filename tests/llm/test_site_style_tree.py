import math
import re
from collections import Counter, defaultdict

import pytest

from propensity.llm import page_blocks as B
from propensity.llm import site_style_tree as S
from propensity.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, text int, site string, page int"


def texts(df):
    return {r["page_id"]: r["text"] for r in df.collect()}


def table(spark, pages):
    return spark.createDataFrame([(i, u, h, 1, "s", 2) for i, u, h in pages], SCHEMA)


def text_of(html):
    return S.main_text(html, b"x", set())


def test_whole_table_gives_the_articles(spark):
    """The given pages mark their article: its heading and paragraphs, found here with patterns alone."""
    import html
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got = {r["page_id"]: r for r in QUERIES["op12_html_extraction"](spark, SMALL).collect()}
    assert len(got) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*)</article>", p["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "br" in b else "", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", article.replace("<br>", "\0br").replace("\0br", " "))]
        assert got[p["page_id"]]["text"] == "\n".join(b for b in blocks if b)
        assert got[p["page_id"]]["url"] == p["url"] and got[p["page_id"]]["n_chars"] == len(got[p["page_id"]]["text"])


def site(n, host="plain.example.org"):
    """Pages without any tag, class or role that says what is what: only the tree can tell."""
    out = []
    for i in range(n):
        own = "".join(f"<div>Paragraph {i}-{j} tells something of its own, {i * 31 + j}.</div>" for j in range(2 + i % 3))
        out.append((i, f"https://{host}/{i}?a=b", f"<html><body><div><div>Our Site</div><div>Start</div></div><section><h2>Title {i}</h2>"
                    f"{own}</section><table><tr><td>Imprint</td><td>All rights kept</td></tr></table></body></html>"))
    return out


def own_text(i):
    return "\n".join([f"Title {i}", *[f"Paragraph {i}-{j} tells something of its own, {i * 31 + j}." for j in range(2 + i % 3)]])


def test_unmarked_furniture_goes_by_the_tree(spark):
    df = table(spark, site(12))
    assert texts(S.extract(df)) == {i: own_text(i) for i in range(12)}
    off = texts(S.extract(df, threshold=0.0))                # without the tree's verdict it stays
    assert all(t.startswith("Our Site\nStart\n") and t.endswith("Imprint\nAll rights kept") for t in off.values())


def test_a_few_pages_say_nothing_of_a_site(spark):
    got = texts(S.extract(table(spark, site(S.LEAST_PAGES - 1))))
    assert all("Our Site" in t for t in got.values())


def test_equal_pages_are_not_emptied(spark):
    page = "<p>The only text of this site.</p><p>It is on every page.</p>"
    got = texts(S.extract(table(spark, [(i, "http://copies.example.org/", page) for i in range(9)])))
    assert set(got.values()) == {"The only text of this site.\nIt is on every page."} and len(got) == 9


def test_a_passage_on_many_pages_of_a_site_stays(spark):
    shared = "A passage that half of the pages share."
    pages = [(i, "http://a.example.org/", f"<article><h1>T{i}</h1><p>Own words {i}.</p>{f'<p>{shared}</p>' if i % 2 else ''}</article>")
             for i in range(40)]
    got = texts(S.extract(table(spark, pages)))
    assert got == {i: f"T{i}\nOwn words {i}." + (f"\n{shared}" if i % 2 else "") for i in range(40)}


def test_importance_equals_brute_force(spark):
    """Entropies and composites of the merged tree, recomputed in plain Python from nested pages."""
    pages = site(9)
    got = {r["key"]: r for r in ((r.asDict() | {"key": bytes(r["key"]), "parent": bytes(r["parent"] or b"")})
                                 for r in S.style_tree(table(spark, pages)).collect())}
    entries = Counter(e for _, _, h in pages for e in B.tree(h, b"plain.example.org")[0])
    present, styles, said, parent = {}, defaultdict(dict), defaultdict(Counter), {}
    for (key, up, depth, kind, item, style), n in entries.items():
        if kind == 0:
            present[key], parent[key] = n, up
        elif kind == 1:
            styles[key][style] = n
        else:
            said[key][item] += n
    children = defaultdict(list)
    for key, up in parent.items():
        children[up].append(key)

    def importance(key):
        m = present[key]
        if said[key]:
            total = sum(said[key].values())
            value = sum(c * (1 - math.log(c, m)) for c in said[key].values()) / total
            return value, value
        total = sum(styles[key].values())
        look = -sum(c / total * math.log(c / total, m) for c in styles[key].values())
        below = {s: [importance(k) for k in children[s]] for s in styles[key]}
        inner = sum(c / total * sum(v for v, _ in below[s]) / len(below[s]) for s, c in styles[key].items())
        g = S.STYLE_WEIGHT ** len(styles[key])
        value = (1 - g) * look + g * inner
        return value, max(value, *[b for vs in below.values() for _, b in vs])

    assert set(got) == set(present)
    for key, row in got.items():
        value, best = importance(key)
        assert row["importance"] == pytest.approx(value, abs=1e-9) and row["noise"] == (best < S.THRESHOLD)
        assert row["pages"] == present[key] and row["parent"] == parent[key]


FURNITURE = ['<nav><a href="/">Menu</a></nav>', "<header>Top <b>bar</b></header>", "<footer>Foot</footer>", "<aside>Side</aside>",
             '<div class="left-sidebar">Side</div>', '<div id="cookieNotice">We use cookies</div>', '<div class="ad">Buy</div>',
             "<form><label>Name</label><input value=x><button>Send</button></form>", "<script>var a='</p>x';</script>",
             "<style>p{}</style>", '<section class="comments"><article><p>I like it</p></article></section>',
             '<div role="navigation">x</div>', "<noscript>No</noscript>", "<!-- <p>gone</p> -->", "<svg><text>v</text></svg>"]


@pytest.mark.parametrize("extra", FURNITURE)
def test_furniture_goes_wherever_it_stands(extra):
    body = "<h1>Head</h1><p>One.</p>{}<p>Two.</p>"
    want = "Head\nOne.\nTwo."
    assert text_of(f"<body>{body.format(extra)}</body>") == want
    inner = "" if "<header" in extra else extra               # an article's own header stays
    assert text_of(f"<body>{extra}<article>{body.format(inner)}</article>{extra}</body>") == want
    assert text_of(f"<body>{extra}<main><p>x</p>{inner}</main>") == "x"


CASES = [
    ("", ""), (None, ""), ("  \n ", ""), ("just text &amp; more", "just text & more"), ("a < b and c<d", "a < b and c"),
    ("<p>a<p>b<li>c<li>d", "a\nb\nc\nd"), ("<p>x &lt;b&gt; &#233;&nbsp;y&copy &am</p>", "x <b> é y© &am"),
    ("<p>one<br>two<b> th</b>ree</p>", "one two three"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"), ("</p></div>x</span>", "x"), ("<p title='a>b'>x</p><p", "x"),
    ('<p>x<span class="ad">buy</span> y</p>', "x y"), ("<title>T</title><body>x", "x"), ("<script>if(a<b)", ""),
    ("<head><meta x><title>t</title><p>x</p>", "x"), ("<html><head><link></head>x", "x"),
    ("<article><header><h1>T</h1></header><p>x</p><footer>f</footer></article>", "T\nx"),
    ("<article><p>x</p><article><p>a reader's comment</p></article></article><p>beside</p>", "x"),
    ('<div class="with-sidebar"><p>x</p></div>', "x"), ('<div class="layout sidebar"><article>x</article></div>', "x"),
    ("<main><p>a</p><article>b</article></main>", "b"), ("<dl><dt>a<dd>b<dt>c</dl>", "a\nb\nc"), ("<pre>a\n  b</pre>", "a b"),
    ("<P>A</P><SCRIPT>x</SCRIPT><P>B", "A\nB"), ("<p>a</p><hr>b", "a\nb"),
]


@pytest.mark.parametrize("html, want", CASES)
def test_markup(html, want):
    assert text_of(html) == want


def test_deep_long_and_broken_pages():
    assert text_of("<div>" * 20_000 + "x") == "x"
    assert text_of("<li><div>" * 5_000 + "x") == "x"
    assert len(text_of("<p>word " * 100_000)) == 5 * 100_000 - 1
    assert text_of('<p class="a' * 3_000) == "" and text_of("<" * 50_000).startswith("<")


def test_nulls_repeats_odd_urls_and_empty_tables(spark):
    pages = [(1, None, "<p>a</p>"), (None, "http://x.org", None), (3, "", ""), (3, "not a url", "<p>b</p>"), (3, "not a url", "<p>b</p>"),
             *[(10 + i, None, "<p>same</p><p>everywhere</p>") for i in range(8)]]
    rows = S.extract(table(spark, pages)).collect()
    assert sorted([(r["page_id"] or -1, r["url"], r["text"], r["n_chars"]) for r in rows], key=str) == sorted(
        [(1, None, "a", 1), (-1, "http://x.org", "", 0), (3, "", "", 0), (3, "not a url", "b", 1), (3, "not a url", "b", 1),
         *[(10 + i, None, "same\neverywhere", 15) for i in range(8)]], key=str)
    empty = S.extract(table(spark, []))
    assert empty.collect() == [] and empty.columns == ["page_id", "url", "text", "n_chars"]
