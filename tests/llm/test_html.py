import random
import re
import tracemalloc

import pytest

from tasteforge.llm import html as html_module
from tasteforge.llm.html import align, blocks_of, common_paths, content_paths, extract_text, fold_repeats, host_of, page_wrapper, pattern


def page(body, title="T", extra=""):
    return (
        f'<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style><script>var t="</p>";go("<article>no</article>");</script></head>'
        f'<body><nav><ul><li><a href="/a>b">Home</a></li><li><a>News</a></li></ul></nav><!-- ad <p>x</p> --><div class="ad">Buy {title}!</div>{extra}'
        f'<article>{body}</article><footer>&copy; 2024 &middot; {title}</footer></body></html>'
    )


PAGES = [
    ("http://A.example/1", page("<h1>One &amp;amp; two</h1><p>First <b>bold</b>er\n text.<br>Line<p>Second &#233;&nbsp;x"), "One &amp; two First bolder text. Line Second é x"),
    ("http://a.example/2?q", page("<header><h1>Head</h1></header><p>Body</p><div class='comments'><p>Reader says</p></div><aside>Side</aside>"), "Head Body"),
    ("https://a.example/3", page("<h1>Cut</h1><p>No end tags<ul><li>a<li>b</ul>")[:-40], "Cut No end tags a b"),
    ("https://a.example/4", page("<p>x</p><form><p>Mail</p><button>Go</button></form><p>y</p>", extra="<header>Site</header>"), "x y"),
    ("https://b.example/1", "<body><div id='top'>Menu</div><div><p>Story one goes here.</p></div><p>Same end</p></body>", "Story one goes here."),
    ("https://b.example/2", "<body><div id='top'>Menu</div><div><p>Another story.</p></div><p>Same end</p></body>", "Another story."),
    ("https://c.example/", None, ""),
    ("https://c.example/2", "", ""),
    (None, "plain < text & more", "plain < text & more"),
    ("no host", "<p>plain too</p>", "plain too"),
    ("https://d.example/", "<main><p>" + "long words " * 50_000 + "</p></main>", ("long words " * 50_000).strip()),
]


def test_pages(spark):
    rows = [(i, u, h, "old", i) for i, (u, h, _) in enumerate(PAGES)] + [(0, PAGES[0][0], PAGES[0][1], "old", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host int")
    got = extract_text(df)
    assert got.columns == ["page_id", "url", "host", "text"]
    found = got.collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.text == PAGES[row.page_id][2], row.page_id
    assert extract_text(df.limit(0)).count() == 0


def test_pages_of_another_template_on_a_host_with_articles(spark):
    other = "<body><nav>Menu</nav><div class='post-nav'><h1>Notes {0}</h1><p>Plain page {0}.</p></div><p>Same end</p></body>"
    rows = [("https://m.example/1", page("<p>One</p>"), "One"), ("https://m.example/2", page("<p>Two</p>"), "Two")]
    rows += [(f"https://m.example/{i}", other.format(i), f"Notes {i} Plain page {i}.") for i in (3, 4)]
    rows += [(None, page("<p>Three</p>"), "Three"), ("no host", "<div><p>No article here</p></div>", "No article here")]
    rows += [("https://n.example/1", "<div class='content-type'><p>Kept a</p></div>", "Kept a"), ("https://n.example/2", "<section><p>Once</p></section>", "Once")]
    rows += [("https://n.example/3", "<div class='content-type'><p>Kept b</p></div>", "Kept b")]
    rows += [("https://n.example/4", "<main class='with-sidebar'><p>Wide</p></main>", "Wide")]
    df = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(rows)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in extract_text(df).collect()} == {i: t for i, (_, _, t) in enumerate(rows)}


def test_texts_with_the_same_long_beginning_are_no_constant(spark):
    lead = "The same lead stands before every text. " * 8
    rows = [(i, f"https://l.example/{i}", f"<body><h1>Head {i}</h1><div><p>{lead}Only here {i}.</p></div><p>Same end</p></body>") for i in range(3)]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Head {i} {lead}Only here {i}." for i in range(3)}


def test_alignment_finds_optional_and_repeated_groups():
    wrappers = [page_wrapper([(p, t, False) for p, t in stream]) for stream in (
        [("h", "A"), ("q", "fixed"), ("s", "1"), ("p", "x"), ("s", "2"), ("p", "y")],
        [("h", "B"), ("q", "fixed"), ("n", "note"), ("s", "3"), ("p", "z")],
    )]
    assert pattern(wrappers[0]) == "(h) (q) (s #text)+ (p #text)+"
    both = align(*wrappers)
    assert pattern(both) == "(h #text) (q) (n)? (s #text)+ (p #text)+"
    assert pattern(align(both, both)) == pattern(both)


def test_folding_keeps_statistics():
    items = fold_repeats([["p", 1, False, 3, 0, "a", [7]], ["p", 1, False, 4, 4, "a", [7]], ["p", 1, False, 5, 0, "b", [7]]])
    assert items == [["p", 1, True, 12, 4, None, [7]]]


def test_paths_and_implied_ends():
    paths = [p for p, _, _ in blocks_of("<div class='b a' id=x12><p>1<p>2<ul><li>3<ul><li>4</ul><li>5</ul><table><tr><td>6<td>7<tr><td>8</table></div>9")]
    base = "div[class=a b;id=x0]"
    assert paths == [f"{base}/p", f"{base}/p", f"{base}/ul/li", f"{base}/ul/li/ul/li", f"{base}/ul/li"] + [f"{base}/table/tr/td"] * 3 + [""]


def test_links_and_constants_are_no_article():
    pages = [f"<div><a>Home</a> <a>Shop</a></div><div><p>Text {i} of the page</p></div><h3>Always</h3>" for i in range(3)]
    total = page_wrapper(blocks_of(pages[0]))
    for html in pages[1:]:
        total = align(total, page_wrapper(blocks_of(html)))
    assert content_paths(total) == ["div/p"]


def texts(spark, bodies, host="w"):
    rows = [(i, f"https://{host}.example/{i}", b) for i, b in enumerate(bodies)]
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(got, key=lambda r: r.page_id)]


def test_the_wrapper_decides_inside_articles(spark):
    named = ("<main><div class='cookie-banner'>We use cookies. Accept</div><p>Story {0} begins here and goes on.</p><div class='comment-list'>"
             "Reader {0} says hi</div><div class='sidebar-widget'>Most read</div><div class='site-footer'>Imprint</div></main>")  # fmt: skip
    assert texts(spark, [named.format(i) for i in range(5)]) == [f"Story {i} begins here and goes on." for i in range(5)]
    plain = re.sub("class='([a-z]{3})[a-z-]*'", r"class='x\1'", named).replace("Reader {0} says hi", "Say hi")
    assert texts(spark, [plain.format(i) for i in range(5)]) == [f"Story {i} begins here and goes on." for i in range(5)]
    assert texts(spark, [plain.format(7)] * 5)[0].startswith("We use cookies. Accept Story 7 begins")  # copies: nothing tells them apart


def test_copies_headings_and_odd_names_stay(spark):
    body = "<article class='has-sidebar'><h2>Method</h2><div class='ad-free'><p>{0}</p></div><section class='q'><h3>More</h3><i>Same for all</i></section></article>"
    got = texts(spark, [body.format(f"A long account of experiment {i}, told in full.") for i in range(4)])
    assert got == [f"Method A long account of experiment {i}, told in full." for i in range(4)]
    near = "<article><h1>One title</h1><p>" + "The whole story, the same on all pages. " * 4 + "</p><i>{0} views</i></article>"
    assert all(t.startswith("One title The whole story") for t in texts(spark, [near.format(i) for i in range(6)]))
    once = ["<article><p>Text {0}.</p></article>".format(i) for i in range(4)] + ["<article><p>Text 9.</p><table><tr><td>A table</table></article>"] * 6
    assert texts(spark, once)[-1] == "Text 9. A table"


def test_alignment_of_long_streams_is_bounded_and_common():
    rng = random.Random(2)
    for size in (0, 1, 30, 300):
        a, b = ([rng.choice("abcdefgh") + str(rng.randrange(20)) for _ in range(size)] for _ in range(2))
        whole = common_paths(a, b)
        html_module.CELLS, cells = 40, html_module.CELLS
        cut = common_paths(a, b)
        html_module.CELLS = cells
        for pairs in (whole, cut):
            assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(cut) <= len(whole) and 2 * len(cut) >= len(whole)
    pages = [page_wrapper([(f"div[class={rng.choice('xyz')}]/p{rng.randrange(40_000)}", "t", False) for _ in range(50_000)]) for _ in range(2)]
    tracemalloc.start()
    both = align(*pages)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert both[0] == 2 and max(len(p[1]) for p in pages) <= len(both[1]) <= sum(len(p[1]) for p in pages)
    assert peak < 200 << 20


def longest(a, b):
    """The length of a longest common subsequence, row by row."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_long_streams_are_aligned_whole():
    rng = random.Random(5)
    for names in (4, 60, 900):
        a, b = ([f"p{rng.randrange(names)}" for _ in range(1100)] for _ in range(2))
        pairs = common_paths(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) == longest(a, b)
    # The same names in both, but no n-th one at a place of the other's: nothing to hold on to but the sequence itself.
    a, b = [f"p{i}" for i in range(1500)], [f"p{i}" for _ in range(2) for i in reversed(range(1500))]
    b += a
    assert [i for i, _ in common_paths(a, b)] == list(range(1500))
    assert common_paths([], a) == common_paths(a, []) == []


def test_names_made_by_builds_are_one_name():
    assert blocks_of("<div class='card_x8f3Qz css-1q2w3e col-md6'>a</div>")[0][0] == "div[class=card_~ col-md0 css-~]"


@pytest.mark.parametrize("url, host", [("http://A.B/c", "a.b"), ("x://h?q", "h"), ("//h/", ""), ("a://b://c", "b:"), ("ü://É.x#f", "É.x"), ("\nhttp://n/", "n")])
def test_host(spark, url, host):
    assert spark.createDataFrame([(url,)], "url string").select(host_of("url")).first()[0] == host
