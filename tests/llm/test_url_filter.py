from snapflow.llm.queries import LLM_ORACLE, URL_RULES
from snapflow.llm.url_filter import aliases, rule_table, url_filter

PAGES = [
    (1, "http://www.Example.com/en/1#top", None),
    (2, "http://shop.example.com/en/1", ""),
    (3, "http://example.com/fr/", ""),
    (4, "http://example.com", ""),
    (5, "HTTP://X.net/es/a?b", ""),
    (6, "http://x.net/es", ""),
    (7, None, ""),
    (8, "no host", ""),
    (9, "a://b://net/es/", ""),
    # Aliases of a blocked page, over two steps, and by a fragment.
    (10, "http://a.org/1", '<link rel="canonical" href="http://b.org/x#y">'),
    (11, "http://c.org/1", '<META http-equiv=refresh content="0; url=http://b.org/x">'),
    (12, "http://b.org/x#z", '<link href=http://x.net/fr/1 rel=canonical>'),
    # An allow outweighs a block.
    (13, "http://d.org/1", '<link rel="canonical" href="http://q.com/">'),
    (14, "http://d.org/2", '<link rel="canonical" href="http://d.org/1"><link rel=canonical href="http://net/es/">'),
    # A rule of one's own stands first; a relative link; null and repeated rows.
    (15, "http://e.net/es/1", '<link rel="canonical" href="http://q.com/">'),
    (16, "http://f.org/a/b", '<link rel="canonical" href="../c">'),
    (17, "http://f.org/c", '<link rel="canonical" href="http://net/fr/">'),
    (None, "http://f.org/c", None),
    (17, "http://f.org/c", '<link rel="canonical" href="http://net/fr/">'),
    (18, "http://[bad", '<link rel="canonical" href="http://[x">'),
]
EXPECTED = {
    1: ("www.example.com/en/", "allow"),
    2: ("example.com/en/", "block"),
    3: ("com/", "allow"),
    4: (None, "allow"),
    5: ("net/es/", "block"),
    6: (None, "allow"),
    7: (None, "allow"),
    8: (None, "allow"),
    9: (None, "allow"),
    10: (None, "block"),
    11: (None, "block"),
    12: (None, "block"),
    13: (None, "allow"),
    14: (None, "allow"),
    15: ("net/es/", "block"),
    16: (None, "block"),
    17: (None, "block"),
    None: (None, "block"),
    18: (None, "allow"),
}


def frame(spark):
    rows = [(*p, "x") for p in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string")


def test_verdicts(spark):
    got = url_filter(frame(spark), rule_table(spark, URL_RULES)).collect()
    assert len(got) == len(PAGES)
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in got} == EXPECTED
    by_id = {r["page_id"]: (r["host"], r["path"]) for r in got}
    assert by_id[1] == ("www.example.com", "/en/1")
    assert by_id[4] == ("example.com", "") and by_id[7] == by_id[8] == ("", "")
    assert by_id[9] == ("b:", "//net/es/") and by_id[5] == ("x.net", "/es/a")


def test_more_links_no_rules_no_rows(spark):
    rules = rule_table(spark, URL_RULES)
    links = spark.createDataFrame([("http://x.net/es", "http://y.net/es/"), (None, "a")], "url string, target string")
    got = {r["page_id"]: r["verdict"] for r in url_filter(frame(spark), rules, links).collect()}
    assert got[6] == "block"
    none = url_filter(frame(spark), rule_table(spark, URL_RULES).limit(0)).collect()
    assert {r["verdict"] for r in none} == {"allow"}
    assert url_filter(frame(spark).limit(0), rules).collect() == []


def test_aliases():
    assert aliases("http://a/b", '<link rel="x canonical" href="//c/d?a&amp;b">') == ["http://c/d?a&b"]
    assert aliases("http://a/b", '<meta http-equiv="refresh" content="5">') == []
    assert aliases(None, "<link rel=canonical href=x>") == aliases("u", None) == []


def test_sql_hears_the_same_of_absolute_links(spark):
    import duckdb

    rows = [p for p in PAGES if p[0] not in (11, 16)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    db = duckdb.connect()
    db.register("pages", pages.toPandas())
    expected = db.execute(LLM_ORACLE["op4_url_filter"]).fetchall()
    got = url_filter(pages, rule_table(spark, URL_RULES)).collect()
    key = str
    assert sorted(map(key, map(tuple, got))) == sorted(
        key((None if r[0] != r[0] else r[0] and int(r[0]), *r[1:])) for r in expected
    )
