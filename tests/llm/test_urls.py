"""URL rules and revisits against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from govlake.llm import ordered, revisits, url_rules

URLS = ["http://a.example.org/es/x?q#f", "https://EXAMPLE.org/en/12", "http://example.org/en/2", "http://org/", "http://x.org",
        "http://shop.fr.com/fr/1", "http://com/de/2", "http://decom/de/2", "no scheme", "", None, "://", "http://",
        "ftp://u@h.org:80/es/", "http://b.example.org/es", "http://a.org?x=://b.com/de/", "http://ü.org/es/\n/"]
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("a.example.org", "/es/x", "allow"),
         ("Example.ORG", "/en/12", "allow"), ("org", "/es", "block"), ("net", "", "block"), ("", "/", "block")]


def plain(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = ""
    for c in rest:
        if c in "/?#":
            break
        host += c
    path = ""
    for c in rest[len(host):]:
        if c in "?#":
            break
        path += c
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, v in rules:
        h = h.lower()
        if h and (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (0, 0), (len(h), len(p))) if best is None or (len(h), len(p)) > best[:2] else best
            if best[:2] == (len(h), len(p)):
                best = (len(h), len(p), h + p, v)
    return host, path, best[2] if best else None, best[3] if best else default


@pytest.mark.parametrize("default", ["allow", "block"])
def test_rules(spark, default):
    rnd = random.Random(4)
    urls = URLS + [f"http://{rnd.choice(['', 'www.', 'a.', 'a.b.'])}{rnd.choice(['example.org', 'x.com', 'y.net', 'org'])}"
                   f"{rnd.choice(['', '/', '/es/', '/en/1', '/en/12', '/de/', '/fr/q'])}{rnd.choice(['', '?a', '#b'])}"
                   for _ in range(300)]
    pages = spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(urls)] + [(0, urls[0], "h", "x"), (None, None, None, "x")],
                                  "page_id long, url string, html string, rule string")
    got = url_rules.verdicts(pages, url_rules.rule_table(spark, RULES), default).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        url = None if r.page_id is None else urls[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == plain(url, RULES, default), url


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert url_rules.verdicts(pages, none, "block").collect()[0].verdict == "block"
    assert url_rules.verdicts(pages.limit(0), url_rules.rule_table(spark, RULES)).collect() == []


def test_last_before(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("aab") if i % 3 else "a", rnd.randint(0, 200), i, rnd.choice([None, i])) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, t long, n long, v long")
    for strictly in (False, True):
        got = {r.n: r.x for r in ordered.last_before(df, ["k", "t", "n"], F.col("v"), "x", strictly).collect()}
        last = None
        for k, t, n, v in sorted(rows, key=lambda r: r[:3]):
            before, last = last, last if v is None else v
            assert got[n] == (before if strictly else last)


def record(i, kind, url, at, status=200, digest=None, headers=None, truncated=False):
    return (i, kind, url, at, status, truncated, digest, headers)


def test_revisits(spark):
    rows = [
        record(1, "response", "http://www.A.org/x/?b=2&a=1&utm_source=q", 10, digest="d1", headers={"etag": '"1"', "date": "old", "content-type": "t"}),
        record(2, "response", "http://a.org/x?a=1&b=2", 20, 404, "bad"),
        record(3, "response", "http://a.org/x?a=1&b=2", 21, 200, "cut", truncated=True),
        record(4, "revisit", "https://a.org:443/x?a=1&b=2#f", 30, 304, "d1", {"date": "new", "content-type": "not taken"}),
        record(5, "revisit", "http://a.org/x?a=1&b=2", 30, 304, None, {"etag": 'W/"1"'}),
        record(6, "revisit", "http://a.org/x?a=1&b=2", 30, 304, "other", None),
        record(7, "revisit", "http://a.org/x?a=1&b=2", 30, 304, None, None),
        record(8, "revisit", "http://a.org/x?a=1&b=2", 10, 304, "d1", None),
        record(9, "revisit", None, 30, 304, "d1", None), record(10, "revisit", "http://a.org/x", None, 304, "d1", None),
        record(11, "revisit", "http://b.org/", 30, 304, "d1", None), record(4, "revisit", "https://a.org:443/x?a=1&b=2#f", 30, 304, "d1", {"date": "new", "content-type": "not taken"}),
        record(12, "request", "http://b.org/", 1, 200, "d1", None),
    ]
    kind = ("record_id long, warc_type string, url string, captured_at long, status int, truncated boolean, "
            "digest string, headers map<string,string>")
    got = revisits.resolve(spark.createDataFrame(rows, kind)).collect()
    assert sorted(r.record_id for r in got) == [4, 4, 5, 6, 7, 8, 9, 10, 11]
    by = {r.record_id: r for r in got}
    assert (by[4].outcome, by[4].refers_to, by[4].payload_digest) == ("resolved", 1, "d1")
    assert by[4].headers == 'content-type: t\ndate: new\netag: "1"'
    assert by[5].outcome == "resolved" and by[5].headers == 'content-type: t\ndate: old\netag: W/"1"'
    assert [by[i].outcome for i in (6, 7)] == ["validators differ", "no validator"]
    assert {by[i].outcome for i in (8, 9, 10, 11)} == {"no earlier response"}
    assert by[6].payload_digest is None and by[6].headers is None


def test_captures_of_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "http://a.org", "x"), (2, "", "")], "page_id long, url string, html string")
    assert revisits.resolve(revisits.captures(pages)).count() >= 4
    assert revisits.resolve(revisits.captures(pages.limit(0))).collect() == []
