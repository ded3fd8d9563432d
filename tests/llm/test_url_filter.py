"""URL rules against trying every rule on every URL."""

import re

import duckdb
import pytest

from captide.llm import oracles, queries, url_filter

URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "https://Example.COM",
    "https://example.com/",
    "https://example.com/en/",
    "https://example.com/en/x?y#z",
    "https://example.com/EN/x",
    "https://a.example.com/en/1",
    "https://www.example.com/en/1",
    "https://b.www.example.com/en/1",
    "https://notexample.com/en/1",
    "http://x.net/es/a",
    "http://net/fr/",
    "http://x.net/fr",
    "http://x.net/free",
    "http://casino.example.org/a",
    "http://casinos.example.org/a",
    "http://example.org/a/Casino/",
    "http://spam-farm.example.org?com/",
    "http://example.org/?casino",
    "http://example.org://x",
    "ftp://x.y://example.com/en/",
    "://com/",
    "http://a.net\n/es/",
    "http://日本.net/es/ü",
    "http://x.org/com/" + "a" * 50000 + "/pills",
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS + URLS[4:9])], "page_id long, url string, host string")


def by_hand(url):
    tail = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", tail)[0]
    path = re.match(r"[^?#]*", tail[len(host) :])[0]
    host = "".join(c.lower() if c < "\x80" else c for c in host)
    best = (0, None, None)
    for verdict, site in queries.SITE_RULES:
        h, p = site.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = max(best, (len(site), site, verdict))
    if best[1]:
        return host, path, best[1], best[2]
    hit = any(re.search(pattern, host + path) for _, pattern, _ in queries.PATTERN_RULES)
    return host, path, None, "block" if hit else "allow"


def test_every_rule_on_every_url(spark, pages):
    rules = [url_filter.site_rule(*r) for r in queries.SITE_RULES] + [url_filter.pattern_rule(*r) for r in queries.PATTERN_RULES]
    got = url_filter.judge_urls(pages, url_filter.rule_table(spark, rules)).collect()
    assert len(got) == pages.count() and got[0].host == "clash"
    for row in got:
        j = row.judged
        assert (j.host, j.path, j.rule, j.verdict) == by_hand(row.url), row.url
    db = duckdb.connect()
    db.register("pages", pages.toPandas())
    sql = sorted(db.execute(oracles.url_sql(queries.SITE_RULES, queries.PATTERN_RULES)).fetchall(), key=repr)
    assert sorted(((r.page_id, r.judged.host, r.judged.path, r.judged.rule, r.judged.verdict) for r in got), key=repr) == sql
    assert url_filter.judge_urls(pages.limit(0), url_filter.rule_table(spark, rules)).collect() == []


def test_rules_are_filed_under_the_rarest_literal(spark, pages):
    rules = url_filter.rule_table(spark, [url_filter.site_rule("block", "www.example.com/en/"), url_filter.pattern_rule("block", "^x", [])])
    urls = url_filter.located(pages).withColumn("tokens", url_filter.tokens_of(url_filter.F.concat("host", "path")))
    filed = {r.rule: r.token for r in url_filter.rule_index(urls, rules).collect()}
    assert filed == {"www.example.com/en/": "www", "^x": ""}
