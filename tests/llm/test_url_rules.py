import random

import pytest

from postrank.llm import url_rules
from postrank.llm.queries import ORACLES, QUERIES, URL_RULES
from tests.llm.conftest import SF_DIR, needs_tables


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    cut = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:cut]


def verdict(url, rules):
    host, path = parts(url)
    fits = [
        (len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "http://a.net/x", "http://anet/x", "https://EXAMPLE.net/en/1?x#y",
    "https://example.net/en", "https://example.net/fr/", "http://x.example.com/de/a", "http://x.example.com/DE/a", "ftp://org/fr/",
    "http://a.b.c.org/fr/x", "http://a.b.c.org?fr/", "http://org#/fr/", "http://../", "http://.net/", "http://net./", "x://y://net/",
    "http://example.com:80/de/", "http://É.net/\n/x", "HTTP://A..NET//", "http://" + "a." * 300 + "net/" + "p/" * 3000,
]


def run(spark, rows, rules):
    pages = spark.createDataFrame([(i, u, "x", "y", "z") for i, u in rows], "page_id long, url string, host string, rule string, html string")
    return sorted(map(tuple, url_rules.judge(pages, url_rules.make_rules(spark, rules)).collect()), key=str)


def want(rows, rules):
    return sorted(((i, *verdict(u, rules)) for i, u in rows), key=str)


def test_edges(spark):
    rows = list(enumerate(URLS)) + [(3, URLS[6]), (None, URLS[5]), (None, None)]
    assert run(spark, rows, URL_RULES) == want(rows, URL_RULES)
    assert run(spark, [], URL_RULES) == []


@pytest.mark.parametrize("seed", range(3))
def test_random_rules(spark, seed):
    rng = random.Random(seed)
    host = lambda: ".".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))
    path = lambda: "/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 5)))
    rules = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(60)]
    rows = [(i, f"http://{host()}{path()}{rng.choice(['', '?q', '#f'])}") for i in range(300)]
    assert run(spark, rows, rules) == want(rows, rules)


def test_no_rules_and_empty_paths(spark):
    rows = list(enumerate(URLS))
    assert run(spark, rows, []) == want(rows, [])
    rules = [("net", "", "block"), ("net", "", "allow"), ("org", "/f", "block")]
    assert run(spark, rows, rules) == want(rows, rules)


def test_shuffled_join_gives_the_same(spark):
    rows = list(enumerate(URLS)) * 20
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert run(spark, rows, URL_RULES) == want(rows, URL_RULES)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_edges_in_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    db.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR)")
    db.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(URLS)))
    got = db.execute(f"SELECT page_id, host, path, rule, verdict FROM ({ORACLES['op6_url_rules']})").fetchall()
    assert sorted(got, key=str) == want(list(enumerate(URLS)), URL_RULES)


@needs_tables
def test_query_on_given_tables(spark, given):
    rows = [(r.page_id, r.url) for r in given("pages").collect()]
    got = sorted(map(tuple, QUERIES["op6_url_rules"](spark, SF_DIR).collect()), key=str)
    assert got == want(rows, URL_RULES)
