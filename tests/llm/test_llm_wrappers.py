"""Wrappers and main texts of hand-made pages."""

import json
import random
import time

import cases
from pyspark.sql import functions as F

from momentloom.llm import wrappers

PAGE = """<!doctype html><html><head><title>t</title><style>p{}</style><script>var a="</p><article>";</script></head>
<body class="page home-12"><header>Site <b>name</b></header><nav><ul><li><a href="/a">A</a></li><li>B</li></ul></nav>
<div class="ad">Buy</div><!-- <article>no</article> -->
<article id="post-7"><h1>Head&amp;line</h1><p>One <b>bold</b>
  &eacute; text.<p>Two<br>lines</p><aside>side</aside><ul><li>x<li>y</ul><table><tr><td>1<td>2</table>
<form>Name <input name=q></form><div class="notice">Note</div><div class='comments'><p>First!</p></div></article>
<div id="sidebar">links</div><footer>&copy; all</footer></body></html>"""
TEXT = "Head&line\nOne bold é text.\nTwo lines\nx\ny\n1 2"


def wrapper(*pages):
    items = None
    for p in pages:
        items = wrappers.expression(p) if items is None else wrappers.merged(items, wrappers.expression(p))
    return json.dumps([len(pages), items])


def test_article_without_the_rest():
    assert wrappers.extract(PAGE, wrapper(PAGE)) == TEXT
    assert wrappers.extract(PAGE[: PAGE.index("<footer>")].replace("</article>", ""), wrapper(PAGE)) == TEXT


def test_other_containers_and_none():
    assert wrappers.extract("<main><p>m</p></main><p>o</p>", wrapper("<main><p>m</p></main>")) == "m"
    assert wrappers.extract('<div class="post entry"><p>m</p></div><p>o</p>', wrapper("<p>o</p>")) == "m"
    pages = [f"<body><p>Welcome</p><div>Text {i}</div><p>Bye</p></body>" for i in range(4)]
    assert [wrappers.extract(p, wrapper(*pages)) for p in pages] == [f"Text {i}" for i in range(4)]
    assert wrappers.extract(pages[0], wrapper(*pages[:2])) == "Welcome\nText 0\nBye"


def test_mismatches_become_options_repeats_and_slots():
    a, b = "<ul><li>1</li><li>2</li></ul><p>x</p>", "<ul><li>3</li></ul><h2>n</h2><p>x</p>"
    assert json.loads(wrapper(a, b))[1] == [["ul", 1, False, [["li", 1, True, [["#", 1, False, None]]]]], ["h2", 0, False, [["#", 1, False, "n"]]], ["p", 1, False, [["#", 1, False, "x"]]]]
    pairs = "<dl><dt>a</dt><dd>1</dd><dt>b</dt><dd>2</dd></dl>"
    assert wrappers.expression(pairs)[0][3] == [["()", 1, True, [["dt", 1, False, [["#", 1, False, None]]], ["dd", 1, False, [["#", 1, False, None]]]]]]


def accepts(place, page):
    """Whether the places of a wrapper cover a page's."""
    return all(x[0] == "#" or x[0] in place.below and accepts(place.below[x[0]], x[3]) for x in wrappers._flat(page))


def test_wrappers_cover_their_pages_and_stay_small():
    rng = random.Random(6)

    def page(depth=0):
        return "".join(f"<{t}>{page(depth + 1) if depth < 3 and rng.random() < 0.5 else rng.choice('abc')}</{t}>" for t in rng.choices(["div", "section", "h2", "p"], k=rng.randint(1, 5)))

    pages = [page() for _ in range(300)]
    text = wrapper(*pages)
    assert len(text) < 60_000  # four kinds of element on four levels, however many pages
    assert all(accepts(wrappers._places(text), wrappers.expression(p)) for p in pages)


def test_broken_and_deep_pages():
    for page in ("<", "<<>>", "<p", "</p>", "<p a='", "<script>", "<!-- x", "&amp", "<a b=\"c>d", "<div>" * 5000 + "x", "a < b", "<b>" * 3000):
        wrappers.extract(page, wrapper(page))
    assert wrappers.extract("<div>" * 5000 + "x", wrapper("<div>")) == "x"
    assert wrappers.extract("a &lt; b &#x41;", wrapper("x")) == "a < b A"


def test_nesting_of_any_depth_keeps_its_elements():
    for n in (10, 60, 61, 500, 5000):
        page = "<div><article>" + "<div>" * n + "<p>a</p><nav>menu</nav><p>b</p>" + "</div>" * n + "<p>rest</p></article><p>out</p></div>"
        assert wrappers.extract(page, wrapper(page)) == "a\nb\nrest"
        assert wrappers.extract(page, wrapper(page, page.replace("rest", "r"), "<p>x</p>")) == "a\nb\nrest"


def texts_of(spark, pages, url="http://h.com/{}"):
    """The main texts of pages, all of one host, through the wrapper that the tables give."""
    df = spark.createDataFrame([(i, url.format(i), p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    found = wrappers.with_wrappers(df.withColumn("_host", wrappers.host_of(F.col("url"))), wrappers.infer(df, "url", "html"), "_host", "_w")
    return [r["t"] for r in found.select("page_id", wrappers.main_text(F.col("html"), F.col("_w")).alias("t")).orderBy("page_id").collect()]


def test_copies_are_one_page(spark):
    one = "<body><h1>Head</h1><p>Only text</p></body>"
    assert texts_of(spark, [one] * 5) == ["Head\nOnly text"] * 5
    marked = [one.replace("<body>", f"<body><nav>menu {i}</nav><!-- {i} -->") for i in range(5)]
    assert texts_of(spark, marked) == ["Head\nOnly text"] * 5  # copies but for menus and markup
    pages = [f"<body><h1>Site</h1><p>Text {i}</p></body>" for i in range(3)]
    assert texts_of(spark, pages[:2] * 3) == ["Site\nText 0", "Site\nText 1"] * 3
    assert texts_of(spark, pages * 2) == ["Text 0", "Text 1", "Text 2"] * 2
    assert texts_of(spark, pages, "http://h.com/same") == ["Site\nText 0", "Site\nText 1", "Site\nText 2"]
    dated = [f"<body><article><h1>Head</h1><p>Only text</p></article><p>Read at {i}</p></body>" for i in range(5)]
    assert texts_of(spark, dated) == ["Head\nOnly text"] * 5


def test_text_of_optional_elements_stays():
    pages = [f"<body><h1>Site</h1><p>Text {i}</p></body>" for i in range(4)] + ["<body><h1>Site</h1><p>Text 4</p><h2>Seen once</h2></body>"]
    assert wrappers.extract(pages[4], wrapper(*pages)) == "Text 4\nSeen once"


def test_wrapper_decides_on_pages_with_containers(spark):
    # The box named "content" is the same on all pages, so it is not the article; what an article repeats is part of it.
    page = lambda i, more="": f'<body><div class="content"><p>About us</p></div><div class="x1"><h1>Head {i}</h1><p>Text {i}</p>{more}</div></body>'
    assert texts_of(spark, [page(i) for i in range(4)]) == [f"Head {i}\nText {i}" for i in range(4)]
    page = lambda i, more="": f"<body><article><h1>Head {i}</h1><p>Text {i}</p>{more}<div>Read <b>more</b> here</div></article><p>Out {i}</p></body>"
    found = texts_of(spark, [page(0), page(1), page(2, "<h2>Only here</h2>")])
    assert found == [f"Head {i}\nText {i}\n{more}Read more here" for i, more in ((0, ""), (1, ""), (2, "Only here\n"))]
    assert texts_of(spark, [page(0), page(1)] * 3) == ["Head 0\nText 0\nRead more here", "Head 1\nText 1\nRead more here"] * 3


def test_captions_and_replacement_texts_stay():
    page = "<article><p>a</p><figure><img src=x><figcaption>The <i>caption</i></figcaption></figure><object data=y><p>Instead</p></object><button>Go</button><p>b</p></article>"
    assert wrappers.extract(page, wrapper(page)) == "a\nThe caption\nInstead\nb"


def test_tables_of_every_kind(spark):
    rows = [(1, "http://h.com/a", PAGE), (1, "http://h.com/a", PAGE), (2, "http://h.com/b", None), (3, None, PAGE), (4, "odd", ""), (None, "http://User@H.com:80/c", PAGE), (5, "http://h.com/d", "<article>" + "<p>word</p>" * 30_000)]
    df = cases.crowded(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_host", wrappers.host_of(F.col("url")))).drop("host", "wrapper")
    found = wrappers.infer(df, "url", "html")
    assert sorted(r["host"] for r in found.collect()) == ["", "h.com"]
    out = wrappers.with_wrappers(df, found, "_host", "_w").select("page_id", wrappers.main_text(F.col("html"), F.col("_w")).alias("t")).collect()
    assert sorted((r["t"] for r in out if r["page_id"] != 5)) == sorted([TEXT] * 4 + ["", ""])
    assert next(r["t"] for r in out if r["page_id"] == 5) == "\n".join(["word"] * 30_000)
    assert wrappers.infer(df.limit(0), "url", "html").collect() == []


def text_of(page):
    return wrappers.extract(page, wrapper(page))


def test_cells_hold_articles_and_adverts():
    assert text_of('<table><tr><td class="content">Some article text</td><td class="sidebar">links</td></tr></table>') == "Some article text"
    assert text_of('<article><table><tr><td>Kept</td><td class="advert">Buy now</td></tr></table></article>') == "Kept"
    assert text_of('<table><tr><td class="content">a <b>b</b><p>c</p>d</td><td>out</td></tr></table>') == "a b\nc\nd"


def test_headings_that_all_pages_repeat_stay(spark):
    for opened, closed in (("<article>", "</article>"), ('<div class="post-content">', "</div>"), ('<div class="zone">', "</div>")):
        pages = [f"<body><div>Site</div>{opened}<h1>Head {i}</h1><h2>Summary</h2><p>Text {i}</p>{closed}<p>Bye</p></body>" for i in range(4)]
        assert texts_of(spark, pages[:3]) == [f"Head {i}\nSummary\nText {i}" for i in range(3)]
    pages = [f"<body><article><h2>Summary</h2><p>Text {i}</p></article></body>" for i in range(3)]
    assert texts_of(spark, pages) == [f"Summary\nText {i}" for i in range(3)] and texts_of(spark, pages[:2]) == [f"Summary\nText {i}" for i in range(2)]


def test_elements_closed_in_themselves_or_not_at_all():
    for odd in ('<svg class="i"/>', "<svg>", "<button>", "<select>", "<noscript>", "<template>"):
        assert text_of(f"<article><p>First</p>{odd}<p>Second</p></article>") == "First\nSecond"
    for tag in wrappers.HIDDEN:
        assert text_of(f"<article><p>First <{tag}>x <i>y</i></{tag}> one</p><p>Second</p></article>") == "First one\nSecond"
    assert text_of("<article><svg><svg><p>x</p></svg><p>x</p></svg><p>a</p><button><p>b</p><button>x</button></article>") == "a\nb"
    assert text_of("<article><p>a</p><script>var x = '<svg>';</script><p>b</p><!-- <svg> --><p>c</p></article>") == "a\nb\nc"


def test_one_word_of_a_class_removes_no_headline_or_paragraph():
    assert text_of('<article><div class="post-header"><h1>Head</h1></div><p class="share price">One</p><p class="advert">Buy</p><h1 class="banner">Two</h1></article>') == "Head\nOne\nTwo"
    assert text_of('<article><p>a</p><div class="post-footer">x</div><div class="article-comments"><p>x</p></div></article>') == "a"


def test_teasers_do_not_beat_the_article(spark):
    for name in ("promoted", "teaser"):
        page = lambda i: f'<body><article class="{name}"><p>Offer {i}</p></article><div class="post-content"><h1>Head {i}</h1><p>{"A long text. " * 5}{i}</p></div></body>'
        assert texts_of(spark, [page(i) for i in range(4)]) == [f"Head {i}\n{'A long text. ' * 5}{i}" for i in range(4)]


def test_rules_part_blocks():
    assert text_of("<article>one<hr>two<br>three<hr/><p>four<hr>five</article>") == "one\ntwo three\nfour\nfive"


def folded_plainly(keys):
    """The shape of folded items by comparing slices, for any size of unit."""
    size, items = 1, [(k, False) for k in keys]
    while 2 * size <= len(items):
        names, out, i = [k for k, _ in items], [], 0
        while i < len(items):
            j = i + size
            while len(names[i : i + size]) == size and names[j : j + size] == names[i : i + size]:
                j += size
            if j == i + size or i + size > len(items):
                out.append(items[i])
                i += 1
            else:
                out += [(names[i], True)] if size == 1 else [(("()", *names[i : i + size]), True)]
                i = j
        size = 1 if len(out) < len(items) and size > 1 else size + 1
        items = out
    return items


def test_folding_finds_what_comparing_slices_finds(monkeypatch):
    monkeypatch.setattr(wrappers, "REPEATS", 1000)
    rng = random.Random(4)
    for _ in range(500):
        keys = [rng.choice("abc") for _ in range(rng.randint(0, 24))] * rng.randint(1, 2)
        items = wrappers._folded([[k, 1, False, []] for k in keys])
        assert [(wrappers._key(x), x[2]) for x in items] == folded_plainly(keys)


def test_twenty_thousand_siblings_take_seconds():
    names = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(20_000)]
    begin = time.perf_counter()
    different = ["".join(f'<div class="{n}{x}">t</div>' for n in names) for x in ("", "x")]
    items = [wrappers.expression(p) for p in different]
    assert len(items[0]) == 20_000 and len(wrappers.merged(*items)[0][3]) == 40_000
    mixed = "".join(f"<{random.Random(i).choice(['p', 'h2', 'div', 'ul'])}>t" for i in range(20_000))
    wrappers.expression(mixed)
    assert time.perf_counter() - begin < 15
    page = "<article>" + different[0] + "</article>"
    assert text_of(page) == "\n".join("t" * 20_000)
