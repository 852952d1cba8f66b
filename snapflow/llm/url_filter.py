"""URL filters with redirect equivalence.

Rules decide on the urls that they fit. Redirects and canonical links make urls aliases of
one another: connected components over these edges carry the decisions to aliases that no
rule fits, where one explicit allow outweighs all blocks.
"""

from __future__ import annotations

import re
from html import unescape
from urllib.parse import urljoin

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.llm.common import columns_of, map_slices
from snapflow.llm.components import components
from snapflow.sources.tables import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

_TAG = re.compile(r"<(link|meta)\b((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""([a-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_REFRESH = re.compile(r"^\s*[\d.]*\s*[;,]?\s*url\s*=\s*[\"']?(.*?)[\"']?\s*$", re.IGNORECASE | re.DOTALL)
_HINT = re.compile(r"canonical|refresh", re.IGNORECASE)


def aliases(url: str | None, html: str | None) -> list[str]:
    """Targets of a page's canonical links and refresh redirects, as whole urls."""
    if not url or not html or not _HINT.search(html):
        return []
    found = []
    for name, rest in _TAG.findall(html):
        values = {k.lower(): unescape("".join(v)) for k, *v in _ATTRIBUTE.findall(rest)}
        target = None
        if name.lower() == "link" and "canonical" in values.get("rel", "").lower().split():
            target = values.get("href")
        elif name.lower() == "meta" and values.get("http-equiv", "").lower() == "refresh":
            match = _REFRESH.match(values.get("content", ""))
            target = match and match.group(1)
        if target:
            try:
                found.append(urljoin(url, target.strip()))
            except ValueError:  # not a url
                continue
    return found


def host_and_path(url) -> tuple:
    """Host in lower case (A-Z) and path; both empty for null or without `://`."""
    host = F.translate(F.regexp_extract(url, _PARTS, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def node(url):
    """A url without its fragment: the node of the page in the graph of aliases."""
    return F.regexp_extract(url, r"(?s)^([^#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules like ("block", "example.com/en/"), as rows: rule, verdict, host, path."""
    rows = []
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        rows.append((rule, verdict, host.translate(str.maketrans(UPPER, LOWER)), slash + path))
    return spark.createDataFrame(rows, "rule string, verdict string, host string, path string")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """`urls` with host, path, rule and verdict of the longest rule that fits `url`.

    Distinct hosts and paths are matched once. Each meets the rules under the ends of its
    host, so a large table of rules is a join and no loop. Rules of equal length: the one
    with the longer host, then an allow.
    """
    host, path = host_and_path(F.col("url"))
    urls = urls.withColumns({"host": host, "path": path})
    labels = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    parts = F.slice(F.split("host", r"\."), -F.least(F.lit(labels), F.size(F.split("host", r"\."))), labels)
    ends = F.transform(
        F.sequence(F.lit(1), F.size("parts")),
        lambda i: F.array_join(F.slice("parts", i, F.size("parts")), "."),
    )
    if labels == 0:
        return urls.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")})
    spots = urls.select("host", "path").distinct().withColumn("parts", parts)
    spots = spots.select("host", "path", F.explode(ends).alias("end"))
    known = rules.select(
        "rule", "verdict", F.col("host").alias("end"), F.col("path").alias("rule_path")
    )
    fits = spots.join(known, "end").filter(F.col("path").startswith(F.col("rule_path")))
    rank = F.struct(F.length("rule"), F.length("end"), F.col("verdict") == "allow", "rule", "verdict")
    best = fits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        *urls.columns, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict")
    )


def url_filter(
    pages: DataFrame,
    rules: DataFrame,
    links: DataFrame | None = None,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Verdict per page: `key`, host, path, rule (or null) and verdict.

    A rule that fits the url decides. Otherwise the url's aliases do, over canonical links
    and refresh redirects in `html` and further pairs of urls in `links` (url, target): an
    allow rule on any of them allows, else a block rule blocks; without either the url is
    allowed. Urls that differ in their fragment are one. Null urls and those without a
    host fit no rule and have no aliases. Rows that repeat each have a result. Other
    columns of `pages` are not read.
    """
    kind = pages.schema[key].dataType.simpleString()
    page_rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"))

    def make():
        def act(urls, texts):
            pairs = [(u, t) for u, h in zip(urls, texts) for t in aliases(u, h)]
            return columns_of(pairs, 2)

        return act

    edges = map_slices(pages.select(url, html), "url string, target string", make)
    if links is not None:
        edges = edges.unionByName(links.select("url", "target"))
    edges = edges.select(node(F.col("url")).alias("a"), node(F.col("target")).alias("b"))
    roots = components(edges.filter("a != '' and b != ''"))
    told = match_rules(roots.withColumnRenamed("node", "url"), rules)
    verdicts = told.groupBy("root").agg(
        F.when(F.max(F.col("verdict") == "allow"), "allow")
        .when(F.max(F.col("verdict") == "block"), "block")
        .alias("heard")
    )
    by_node = settle(roots.join(verdicts.filter("heard is not null"), "root"), "alias-verdicts")
    judged = match_rules(page_rows, rules).withColumn("node", node(F.col("url")))
    judged = judged.join(by_node.select("node", "heard"), "node", "left")
    return judged.select(
        F.col("id").cast(kind).alias(key),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", "heard", F.lit("allow")).alias("verdict"),
    )
