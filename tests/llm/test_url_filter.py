from helpers import DATA, same_as_sql

from docketflow.llm.url_filter import OP4_SQL, RULES, filter_urls, op4_url_filter, rules_table


def test_query_matches_sql(spark):
    same_as_sql(op4_url_filter(spark, f"{DATA}/sf0.01"), OP4_SQL, f"{DATA}/sf0.01")


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut : min([rest.find(c, cut) for c in "?#" if rest.find(c, cut) >= 0] or [len(rest)])]
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, None, "allow")
    return host, path, best[1], best[2]


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.com/en/x", "https://www.example.com/en/1?q=/fr/", "http://a.www.example.com/en/", "http://example.com", "http://example.com/",
    "http://badexample.com/en/", "http://x.net/es/1", "http://net/fr/", "http://net/FR/", "http://x.net?/es/", "http://x.net#/fr/", "ftp://É.net/es/", "http://com/", "http://a..com/", "x://y://z.com/", "http://x.net:80/es/", "//x.com/", "http://x.com/en/\nnew",
]


def test_edges_match_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS + URLS)], "page_id long, url string, rule string")
    got = {r.id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages, rules_table(spark)).collect()}
    assert [got[i] for i in range(2 * len(URLS))] == [brute(u) for u in URLS + URLS]


def test_empty_pages_and_rules(spark):
    pages = spark.createDataFrame([(1, "http://x.com/")], "page_id long, url string")
    none = rules_table(spark).where("false")
    assert [(r.rule, r.verdict) for r in filter_urls(pages, none).collect()] == [(None, "allow")]
    assert filter_urls(pages.where("false"), rules_table(spark)).count() == 0
