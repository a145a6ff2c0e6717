import random

import pytest
from pyspark.sql import functions as F

from rankloom.llm import warc

SCHEMA = "record_id long, url string, ts long, kind string, headers map<string,string>, part string, late string, canonical string"


def captures(spark, rows):
    return spark.createDataFrame([(*r, "p", "l", "c") for r in rows], SCHEMA)


def brute(rows, canonical):
    full = sorted((t, i, u, h or {}) for i, u, t, k, h in rows if k == "response" and canonical[u] is not None)
    out = []
    for i, u, t, k, h in rows:
        url, own = canonical[u], h or {}
        earlier = [f for f in full if canonical[f[2]] == url and f[0] <= t]
        target, headers = None, own
        if url is None:
            outcome = "no url"
        elif k == "response":
            outcome, target = "full", i
        elif k != "revisit":
            outcome = "other"
        elif not earlier:
            outcome = "no earlier response"
        else:
            _, record, _, theirs = earlier[-1]
            tags = [x.get("etag") for x in (own, theirs)]
            dates = [x.get("last-modified") for x in (own, theirs)]
            if None not in tags:
                valid = tags[0].removeprefix("W/") == tags[1].removeprefix("W/")
            else:
                valid = None in dates or dates[0] == dates[1]
            outcome = "resolved" if valid else "validator mismatch"
            if valid:
                target = record
                headers = theirs | {n: v for n, v in own.items() if n in warc.PERMITTED}
        out.append((i, url, t, k, target, outcome, sorted(headers.items())))
    return sorted(map(str, out))


def test_resolution_by_brute_force(spark):
    draw = random.Random(3)
    urls = ["http://A.com/x?b=1&a=2#f", "https://www.a.com:443/x?a=2&b=1&utm_source=z", "http://b.org", "http://b.org/", "c.net/y", None, ""]
    rows = []
    for i in range(400):
        headers = {n: draw.choice(v) for n, v in {"etag": ['"1"', 'W/"1"', '"2"'], "last-modified": ["d1", "d2"], "date": [f"t{i}"],
                   "content-type": ["text/html"], "server": [f"s{i}"]}.items() if draw.random() < 0.7}
        url = urls[0] if draw.random() < 0.4 else draw.choice(urls)
        rows.append((i, url, draw.randint(0, 60), draw.choice(["response", "revisit", "revisit", "request", None]), draw.choice([headers, headers, None])))
    rows.append(rows[5])
    spark_urls = spark.createDataFrame([(u,) for u in urls], "u string").select("u", warc.canonical_url(F.col("u")).alias("c"))
    canonical = {r["u"]: r["c"] for r in spark_urls.collect()}
    out = warc.resolve_revisits(captures(spark, rows)).collect()
    got = sorted(str((r["record_id"], r["canonical"], r["ts"], r["kind"], r["resolved_id"], r["outcome"], sorted(r["headers"].items()))) for r in out)
    assert got == brute(rows, canonical)


@pytest.mark.parametrize(
    "url,want",
    [
        ("http://A.com/x?b=1&a=2#f", "a.com/x?a=2&b=1"),
        ("https://www.a.com:443/x?a=2&b=1&utm_source=z", "a.com/x?a=2&b=1"),
        ("http://b.org", "b.org/"),
        ("http://b.org?", "b.org/"),
        ("http://b.org/P?q=A#x#y", "b.org/P?q=A"),
        ("", "/"),
        (None, None),
    ],
)
def test_canonical_urls(spark, url, want):
    row = spark.createDataFrame([(url,)], "u string").select(warc.canonical_url(F.col("u")).alias("c")).first()
    assert row["c"] == want


def test_hot_url_over_many_partitions(spark):
    """One URL holds nearly all rows; its only response stands in the first partition."""
    rows = [(0, "http://hot.com/", 0, "response", {"etag": '"1"'})]
    rows += [(i, "http://hot.com/", i, "revisit", {"date": str(i)}) for i in range(1, 4000)] + [(9999, "http://z.com/", 1, "revisit", None)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        out = warc.resolve_revisits(captures(spark, rows)).groupBy("resolved_id", "outcome").count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted((r["outcome"], r["count"]) for r in out) == [("full", 1), ("no earlier response", 1), ("resolved", 3999)]


def test_empty_table(spark):
    assert warc.resolve_revisits(captures(spark, [])).count() == 0


def test_page_captures_with_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (2, "", "", "x"), (None, "http://a.com", "h", "x"), (3, "http://a.com", "h", "x")],
                                  "page_id long, url string, html string, ts string")
    out = warc.resolve_revisits(warc.page_captures(pages)).collect()
    assert {r["outcome"] for r in out} >= {"full", "no url"}
