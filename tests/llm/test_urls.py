"""URL rules and host reputation."""

import pytest
from pyspark.sql import functions as F

from acctrisk.llm import urls

RULES = [
    urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"), urls.Rule("allow", "com", "/fr/"),
]
PAGES = "page_id long, url string, item long, host string, verdict string, n long"


def judged(frame, *pages, labels=(), **more):
    rows = frame(PAGES, *[(p, u, i, "clash", "clash", 7) for p, u, i in pages])
    known = frame("item long, good int", *labels)
    return urls.judge(rows, known, RULES, **more).collect()


@pytest.mark.parametrize("url,host,path,rule", [
    ("HTTP://A.Example.ORG/es/1?x#y", "a.example.org", "/es/1", "example.org/es/"),
    ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1"),
    ("http://example.org/en/2", "example.org", "/en/2", "org/"),
    ("http://badexample.org/es/", "badexample.org", "/es/", "org/"),
    ("http://x.com/fr/", "x.com", "/fr/", "com/fr/"),
    ("http://xcom/fr/", "xcom", "/fr/", None),
    ("http://org", "org", "", None), ("http://org?/es/", "org", "", None),
    ("no scheme.org/", "", "", None), (None, "", "", None), ("", "", "", None), ("://", "", "", None),
    ("x://ÄB.net/ä\nb#c", "Äb.net", "/ä\nb", None),
])
def test_parts_and_longest_rule(frame, url, host, path, rule):
    row = judged(frame, (1, url, None))[0]
    assert (row.host, row.path, row.rule) == (host, path, rule)


def test_reputation_shrinks_to_the_levels_above(frame):
    counts = [("a.bad.net", 400, 20), ("b.bad.net", 2, 1), ("new.bad.net", 0, 0),
              ("a.good.net", 400, 390), ("b.good.net", 2, 1), ("new.good.net", 0, 0),
              ("alone.com", 0, 0)]
    rows = {r.host: r for r in urls.reputation(
        frame("host string, n long, k long", *counts)).collect()}
    assert rows["a.bad.net"].good_upper < 0.15 and rows["a.good.net"].good > 0.9
    assert rows["b.bad.net"].good < rows["b.good.net"].good
    assert rows["new.bad.net"].good < rows["new.good.net"].good
    assert all(r.good < r.good_upper for r in rows.values())
    assert len(rows) == len(counts)


def test_verdict_by_method(frame):
    pages = [(i, f"http://bad.net/{i}", i) for i in range(60)]
    pages += [(100 + i, f"http://good.net/{i}", 100 + i) for i in range(60)]
    pages += [(300, "http://unseen.io/", None), (301, None, 5), (302, "http://bad.net/x", None)]
    labels = [(i, 0) for i in range(60)] + [(100 + i, 1) for i in range(60)] + [
        (None, 1), (3, None), (9999, 0)]
    got = {r.page_id: r.verdict for r in judged(frame, *pages, labels=labels)}
    assert {got[i] for i in range(60)} == {"block"} == {got[302]}
    assert {got[100 + i] for i in range(60)} == {"allow"} == {got[300]}


def test_repeated_null_and_no_rows(frame):
    rows = judged(frame, *[(1, "http://a.net/", None)] * 3, (None, "http://a.net/", 1),
                  labels=[(1, 1), (1, 0)])
    assert len(rows) == 4 and len({(r.verdict, r.good_upper) for r in rows}) == 1
    assert judged(frame) == []


@pytest.mark.parametrize("host,domain,suffix", [
    ("a.b.example.net:8080", "example.net", "net"), ("example.net", "example.net", "net"),
    ("a.shop.co.uk", "shop.co.uk", "co.uk"), ("shop.co.uk:1", "shop.co.uk", "co.uk"),
    ("co.uk", "co.uk", "co.uk"), ("a.xco.uk", "xco.uk", "uk"),
    ("1.2.3.4", "1.2.3.4", ""), ("1.2.3.4:80", "1.2.3.4", ""), ("[::1]:80", "[::1]", ""),
    ("x.2.3.4", "3.4", "4"), ("local", "local", "local"), ("", "", ""),
])
def test_registered_domain_and_suffix(frame, host, domain, suffix):
    levels = urls._levels(F.col("host"))
    assert tuple(frame("host string", (host,)).select(*levels).first()) == (domain, suffix)


def test_unlike_domains_of_one_listed_suffix(frame):
    counts = [(f"{h}.{d}.co.uk", 300, k) for d, k in (("bad", 20), ("good", 290)) for h in "ab"]
    counts += [(f"new.{d}.co.uk", 0, 0) for d in ("bad", "good")]
    rows = {r.host: r.good for r in urls.reputation(
        frame("host string, n long, k long", *counts)).collect()}
    assert rows["new.bad.co.uk"] < 0.3 < 0.7 < rows["new.good.co.uk"]


def test_outcomes_where_many_hosts_share_an_item_or_have_none(spark):
    """A third of the pages with one item, a third without any, on a host each."""
    pages = spark.range(9000).select(
        F.concat(F.lit("h"), F.col("id") % 4500).alias("host"),
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id")).alias("item"))
    labels = spark.range(9000).where("id % 2 = 1").select(
        F.col("id").alias("item"), (F.col("id") % 4 == 1).cast("int").alias("good"))
    labels = labels.union(labels.where("item = 1"))  # item 1 is labelled twice
    want = {}
    for i in range(9000):
        item = 1 if i % 3 == 0 else i if i % 3 == 1 else None
        times = 0 if item is None or item % 2 == 0 else 2 if item == 1 else 1
        n, k = want.get(f"h{i % 4500}", (0, 0))
        want[f"h{i % 4500}"] = (n + times, k + times * (times > 0 and item % 4 == 1))
    found = urls.outcomes_by_host(pages, labels).collect()
    assert {r.host: (r.n, r.k) for r in found} == want and len(found) == len(want)


def test_a_hot_item_is_dealt_over_partitions(spark):
    """No task of the join with the labels gets more than a small share of a hot item's rows."""
    hosts = spark.range(20_000).select(
        F.concat(F.lit("h"), "id").alias("host"), F.lit(1).cast("long").alias("item"))
    labels = spark.createDataFrame([(1, 1, 1)], "item long, n long, k long")
    with_settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16",
                     "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in with_settings}
    for k, v in with_settings.items():
        spark.conf.set(k, v)
    try:
        parts = urls.salted_join(hosts, labels, ["item"], "host").groupBy(
            F.spark_partition_id().alias("p")).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in parts) == 20_000
    assert max(r["count"] for r in parts) < 6_000
