from __future__ import annotations

import random

import pytest
from case_tables import SF
from pyspark.sql import functions as F

from candor.llm.url_filter import LISTED_HOSTS, RULES, BloomCascade, url_verdicts


def slow(url, hosts=LISTED_HOSTS):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(r), r, v) for v, rs in RULES.items() for r in rs
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[len(r.split("/")[0]):])]
    listed = any(host == h or host.endswith("." + h) for h in hosts)
    rule, verdict = (max(fits)[1:]) if fits else (None, "block" if listed else "allow")
    return host, path, rule, verdict, listed


URLS = [None, "", "no-scheme.net/x", "http://", "http://net/", "http://a.NET/", "http://a.net", "http://a.net?x/", "http://xnet/",
        "https://Example.NET/en/1?x#y", "https://example.net/en", "https://www.example.net/EN/1", "http://a.example.com/de/",
        "http://badexample.com/de/x", "http://example.com/de/x", "http://x.org/fr/", "http://org/fr/a", "http://x.org/french",
        "http://m.casino-win.example.org/q", "http://casino-win.example.org/fr/q", "http://x-casino-win.example.org/",
        "http://a://b.net/", "ftp://é.net/ü?", "http://a.net/\n/x", "http://" + "a." * 3000 + "net/" + "x" * 5000]


def test_verdicts_against_plain_rules(spark):
    rows = list(enumerate(URLS)) + [(0, URLS[4]), (None, URLS[9])]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in rows], "page_id long, url string, rule string, verdict string")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.listed) for r in url_verdicts(df).collect()), key=str)
    assert got == sorted(((i, *slow(u)) for i, u in rows), key=str)


def test_hosts_from_a_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    urls = [r.url for r in pages.select("url").collect()]
    hosts = sorted({slow(u)[0] for u in urls} - {""})[::3] + ["com", "nowhere.example.com", "a.b.c.d.e.f"]
    table = spark.createDataFrame([(h, 1) for h in hosts + hosts[:5]] + [(None, 1)], "key string, url int")
    got = sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict, r.listed) for r in url_verdicts(pages, hosts=table).collect())
    want = [(r.page_id, *slow(r.url, hosts)) for r in pages.select("page_id", "url").collect()]
    assert got == sorted((i, h, p, r or "", v, x) for i, h, p, r, v, x in want)
    assert {r[5] for r in got} == {True, False}
    assert not any(r.listed for r in url_verdicts(pages, hosts=table.limit(0)).collect())


def test_no_rows_no_rules(spark):
    df = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert url_verdicts(df.limit(0)).collect() == []
    assert [r.verdict for r in url_verdicts(df, {}, ()).collect()] == ["allow"]
    with pytest.raises(ValueError):
        url_verdicts(df, {"block": ("net/",), "allow": ("net/",)})


@pytest.mark.parametrize("share", [0.0, 0.01, 0.5, 1.0])
def test_cascade_is_exact_over_its_universe(spark, share):
    pick = random.Random(1)
    keys = [f"host{i}.net/" for i in range(3000)]
    listed = [k for k in keys if pick.random() < share]
    universe = spark.createDataFrame([(k,) for k in keys + keys[:50]], "key string")
    cascade = BloomCascade(universe, listed)
    hits = {r.key for r in universe.where(cascade.contains(F.col("key"))).collect()}
    assert hits == set(listed)
