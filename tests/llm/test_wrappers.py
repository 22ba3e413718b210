import random
import time

from pyspark.sql import functions as F

from llm_helpers import SF
from report_lake.llm import wrappers as X

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>no</p>";</script></head><body>
<div class="top-menu"><ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul></div>
<header><h1>Site name</h1></header><aside><p>side</p></aside>
<div id="cookie-notice">We use cookies</div>
<main><h1>Title &amp; more</h1><p>First <b>bold</b>&nbsp;text<br>goes on &#8212; here.<p>Second
 para<!-- <p>hidden</p> --></p><ul><li>item one<li>item two</ul><form><p>mail</p><input></form>
<div class="ad">Buy!</div>{extra}</main>
<section class="comments"><article><p>First comment</p></article></section>
<footer>&copy; 2020</footer></body>"""
TEXT = "Title & more\nFirst bold text goes on — here.\nSecond para\nitem one\nitem two"


def texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return {r["page_id"]: r["text"] for r in X.extract(df).collect()}


def test_parse_blocks_and_references():
    items, found = X.parse(PAGE.replace("{extra}", ""))
    assert "no" not in found and "hidden" not in " ".join(found) and "T" not in found
    assert found[found.index("Title & more") + 1] == "First bold text goes on — here."
    for broken in ("", "<", "<p", "<p><b>x", "</p></div>y", "<script>never closed <p>x</p>", "<a title='>'>z</a>", "a < b & c", "<!-- open", "<p class=\"x>y</p>"):
        X.parse(broken)
    assert X.parse("a < b &amp; c")[1] == ["a < b & c"]


def test_repeats_optionals_and_slots():
    a, b = (X.bare(X.fold(X.parse(h)[0])) for h in ("<div><p>x</p><p>y</p><h2>same</h2></div>", "<div><p>z</p><em>i</em><h2>same</h2><hr><table><tr><td>1</td></tr></table></div>"))
    w = X.align(a, b)
    kinds = [x[0] if x[0] != "e" else x[1] for x in w[0][2]]
    assert kinds[0] == "+" and "h2" in kinds and "?" in kinds
    h2 = next(x for x in w[0][2] if x[1] == "h2")
    assert h2[2][0][1] is not None  # the same on both
    p = w[0][2][0][1][0]
    assert p[2][0][1] is None  # differs: a slot
    assert X.align(w, w) and X.align([], a)[0][0] == "?"


def test_main_regions(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.replace("{extra}", f"<p>extra {i}</p>" if i % 2 else "")) for i in range(6)]
    got = texts(spark, rows)
    assert got == {i: TEXT + (f"\nextra {i}" if i % 2 else "") for i in range(6)}
    same = texts(spark, [(i, "http://b.example/", PAGE.replace("{extra}", "")) for i in range(5)])
    assert set(same.values()) == {TEXT}  # copies: what never varies still is the article


def test_without_main_region_the_wrapper_decides(spark):
    page = "<body><div><a href=1>Home</a> <a href=2>News</a></div><div><p>Story {0} begins here and goes on.</p><p>More of {0}.</p></div><div>All rights reserved</div></body>"
    got = texts(spark, [(i, "https://c.example/x", page.format(f"n{i}")) for i in range(5)])
    assert got == {i: f"Story n{i} begins here and goes on.\nMore of n{i}." for i in range(5)}


def test_mixed_sections_on_one_host(spark):
    """Sections that hold other content than the wrapper's group keep their texts, with a main region and without."""
    for host, box in (("m.example", "article"), ("n.example", "div")):
        bodies = [["h2", "p", "p", "h2", "pre", "pre"], ["h2", "p", "p", "h2", "p", "p"], ["h2", "ul", "p", "h2", "ul", "p"], ["h2", "pre", "h2", "p", "p", "ul"]]
        rows, want = [], {}
        for i, kinds in enumerate(bodies):
            said = [f"{k} number {n} of page {i}" for n, k in enumerate(kinds)]
            inner = "".join(f"<{k}><li>{t}</li></{k}>" if k == "ul" else f"<{k}>{t}</{k}>" for k, t in zip(kinds, said))
            rows.append((i, f"http://{host}/{i}", f"<body><nav><a href=x>Home</a></nav><{box}>{inner}</{box}><footer>end</footer></body>"))
            want[i] = "\n".join(said)
        assert texts(spark, rows) == want
        assert texts(spark, rows[:2]) == {i: want[i] for i in (0, 1)}


def test_blocks_the_wrapper_does_not_know():
    page = X.fold(X.parse("<div><p>a</p><blockquote>new</blockquote></div><nav><p>menu</p></nav><section><a href=x>link</a></section>")[0])
    wrapper = X.judge(X.bare(X.fold(X.parse("<div><p>b</p></div>")[0])))
    assert X.kept_blocks(page, wrapper) == {0, 1}


def test_main_region_is_the_pages_own(spark):
    plain = "<body><div><a href=1>Home</a> <a href=2>News</a></div><div><p>Story {0} goes on.</p></div><div>All rights reserved</div></body>"
    marked = "<body class='has-sidebar'><div>outside {0}</div><article class='post comments-open'><p>Told {0}.</p></article></body>"
    rows = [(i, "http://o.example/x", (marked if i % 2 else plain).format(i)) for i in range(8)]
    assert texts(spark, rows) == {i: f"Told {i}." if i % 2 else f"Story {i} goes on." for i in range(8)}
    lost = [(i, None if i < 3 else "no url", h) for i, h in enumerate(["<article>one</article>", "<p>two</p>", "<p>same</p>", "<p>same</p>", "<p>same</p>", "<p>same</p>"])]
    assert texts(spark, lost) == {0: "one", 1: "two", 2: "same", 3: "same", 4: "same", 5: "same"}


def test_pages_table(spark):
    """On the given pages the article element holds the main text."""
    import html
    import re

    df = spark.read.parquet(f"{SF}/pages.parquet")
    want = {}
    for r in df.collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
        want[r["page_id"]] = "\n".join(b for b in blocks if b)
    assert {r["page_id"]: r["text"] for r in X.extract(df).collect()} == want
    assert {r["page_id"]: r["text"] for r in X.extract(df, broadcast_bytes=0).collect()} == want


def test_edges(spark):
    rows = [(1, None, None), (2, "http://d.example", None), (3, None, "<p>only text</p>"), (3, None, "<p>only text</p>"), (None, "not a url", ""), (5, "http://d.example", "<article>" + "<p>word</p>" * 20000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("h")).withColumn("text", F.lit("t")).withColumn("wrapper", F.lit(1))
    got = [(r["page_id"], r["text"]) for r in X.extract(df).collect()]
    assert len(got) == 6 and all(t is not None for _, t in got)
    by = dict(got)
    assert by[1] == by[2] == by[None] == "" and by[3] == "only text" and by[5] == "\n".join(["word"] * 20000)
    assert X.extract(df.limit(0)).count() == 0


def test_nesting_of_any_depth(spark):
    deep = "<html><body><nav><p>menu</p></nav><article>" + "<div>" * 100_000 + "<p>bottom</p><div class='ad'>Buy</div>" + "</div>" * 100_000 + "<p>after</p></article></body></html>"
    shallow = "<html><body><nav><p>menu</p></nav><article><p>one</p></article></body></html>"
    rows = [(1, "http://a.example/1", deep), (2, "http://a.example/2", shallow), (3, None, "<div>" * 3000 + "<nav>x</nav><p>plain</p>")]
    assert texts(spark, rows) == {1: "bottom\nafter", 2: "one", 3: "plain"}


def test_pages_without_body_or_end_of_head(spark):
    rows = [
        (1, None, "<html><head><title>t</title><meta charset=utf-8><p>Hello"),
        (2, None, "<head><script>x</script><noscript><p>no</p></noscript>Loose text"),
        (3, None, "<html><head><title>t</title></head><p>Between<body><p>inside"),
    ]
    assert texts(spark, rows) == {1: "Hello", 2: "Loose text", 3: "Between\ninside"}


def test_parts_of_an_article_with_words_of_regions(spark):
    page = "<body><div class='header'>site</div><div class='legal'>terms</div><article><div class='section-header'><h2>Part</h2></div><div class='legal'>law</div><div class='side-note'>aside</div><div class='share-buttons'>share</div><footer>foot</footer></article></body>"
    assert texts(spark, [(1, None, page), (2, "http://h.example/", page)]) == {1: "Part\nlaw\naside", 2: "Part\nlaw\naside"}


def test_long_mixed_sequences_are_aligned_in_bounded_time():
    kinds = ["<p>{}</p>", "<h2>{}</h2>", "<ul><li>{}</li><li>y</li></ul>", "<blockquote>{}</blockquote>", "<pre>{}</pre>", "<table><tr><td>{}</td></tr></table>"]
    pick = random.Random(5)
    pages = ["<article>" + "".join(pick.choice(kinds).format(f"w{i}") for i in range(20_000)) + "</article>" for _ in range(2)]
    parsed = [X.parse(p) for p in pages]
    trees = [X.fold(items) for items, _ in parsed]
    started = time.monotonic()
    wrapper = X.fold(X.align(*(X.bare(t) for t in trees)))
    judged = X.judge(wrapper, True)
    for tree, (_, found) in zip(trees, parsed):
        assert X.kept_blocks(tree, judged) == set(range(len(found)))
    assert time.monotonic() - started < 60


def test_looking_ahead_joins_like_items_and_loses_none(monkeypatch):
    monkeypatch.setattr(X, "MAX_CELLS", 0)
    pick = random.Random(7)
    for _ in range(200):
        a, b = ([["e", pick.choice("pqrs"), [["T", pick.randrange(3), 1, 4, 0]]] for _ in range(pick.randrange(9))] for _ in range(2))
        pairs = []
        X.align(a, b, pairs)
        order = [(next(i for i, y in enumerate(a) if y is p), next(i for i, y in enumerate(b) if y is q)) for p, q in pairs]
        assert all(X.alike(p, q) for p, q in pairs) and order == sorted(order) and len({i for i, _ in order}) == len({j for _, j in order}) == len(order)
        assert len(X.align(a, b)) == len(a) + len(b) - len(pairs)
