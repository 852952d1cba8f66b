import itertools
import random

from snapflow.llm.html_extract import extract, label, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><a href=/>Site</a><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></header>
<div id="cookie-notice">We use cookies. <button>OK</button></div>
<div class="layout"><main><article class="post"><header><h1>The &amp; title</h1></header>
<p>A long paragraph of the article,
   with <b>many</b> words &#8212; so many that it counts.<p>Short.
<div class="ad-box"><p>Buy now! The best offer of the whole year, only today.</p></div>
<ul><li>item one</li><li>item <a href=x>two</a></li></ul>
<script>var t = "</p><p>not this";</script><table><tr><td>cell a<td>cell b</table>
</article><section class="comments"><h2>Comments</h2>
<article class="comment"><p>Great article, I liked it and will read it again and again.</p></article>
</section></main><aside><h3>Related</h3><ul><li><a href=/a>Another story</a></ul></aside></div>
<form><label>Mail</label><p>Subscribe to our newsletter about everything</p></form>
<p style="display:none">hidden</p><footer>&copy; 2020 Example</footer></body></html>"""


def test_article_without_the_rest():
    assert main_text(PAGE).split("\n") == [
        "The & title",
        "A long paragraph of the article, with many words — so many that it counts.",
        "Short.",
        "item one",
        "item two",
        "cell a",
        "cell b",
    ]


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<nav>Home</nav>") == ""
    assert main_text("plain text") == "plain text"
    assert main_text("<p>a < b &lt; c<br>d<p>e<!-- x <p> --><!-- open") == "a < b < c d\ne"
    assert main_text('<p>all that is <a href="x>open') == "all that is open"
    assert main_text("<p>" + "word " * 30_000) == ("word " * 30_000).strip()
    assert main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert main_text("<p>same</p>" * 500) == "\n".join(["same"] * 500)


def cost(labels, scores, ties):
    return sum(max(0, -s) if x else max(0, s) for x, s in zip(labels, scores)) + sum(
        w for i, j, w in ties if labels[i] != labels[j]
    )


def test_the_cut_is_the_cheapest_labelling():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 9)
        scores = [rng.uniform(-2, 2) for _ in range(n)]
        ties = [(i - 1, i, rng.uniform(0, 2)) for i in range(1, n)]
        ties += [(rng.randrange(n), rng.randrange(n), rng.uniform(0, 1)) for _ in range(n)]
        ties = [t for t in ties if t[0] != t[1]]
        best = min(cost(x, scores, ties) for x in itertools.product([False, True], repeat=n))
        assert abs(cost(label(scores, ties), scores, ties) - best) < 1e-4


def test_rows(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "y"), (None, "u", "", "z"), (1, "u", PAGE, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(pages).collect()
    assert sorted((str(r["page_id"]), r["n_chars"]) for r in got) == sorted(
        (str(k), len(main_text(h))) for k, _, h, _ in rows
    )
    assert extract(pages.limit(0)).collect() == []
