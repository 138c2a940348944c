import math
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from equiscope.llm import urls
from equiscope.llm.urls import RULES, Rule, deciding_rule, host_and_path, judge, levels, reputation

URLS = [
    None, "", "no scheme", "://x/y", "http://", "http://A.B.ÉÄ/Path?q#f", "http://h", "http://h?x://y/z", "http://h#a/b", "a://b://c/d",
    "http://example.org/es/", "http://example.org/es", "http://sub.example.org/en/1?x", "http://myexample.org/es/x", "http://org",
    "http://x.com/fr/1", "http://x.com/de/", "http://com/fr/", "http://u@h:80/p\nq", "HTTP://EXAMPLE.COM/DE/", "http://x.co.uk/", "http://1.2.3.4:8/",
]


def plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:end]


def test_host_path_and_rules(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    host, path = host_and_path(F.col("url"))
    out = df.select("url", host.alias("h"), path.alias("p")).withColumn("r", deciding_rule(F.col("h"), F.col("p"), RULES)).collect()
    for r in out:
        h, p = plain_split(r.url)
        assert (r.h, r.p) == (h, p), r.url
        fit = [x for x in RULES if (h == x.host or h.endswith("." + x.host)) and p.startswith(x.path)]
        best = max(fit, key=lambda x: len(x.text), default=None)
        assert (r.r and r.r.rule) == (best and best.text) and (r.r is None or r.r.allow == best.allow)


def test_levels(spark):
    df = spark.createDataFrame([(h,) for h in ("a.b.example.com", "example.com", "com", "", "x.y.co.uk", "co.uk", "10.0.0.1:80", "h:81")], "h string")
    suffix, domain = levels(F.col("h"))
    got = [tuple(r) for r in df.select(suffix, domain).collect()]
    assert got == [("com", "example.com"), ("com", "example.com"), ("com", "com"), ("", ""), ("co.uk", "y.co.uk"), ("co.uk", "co.uk"),
                   ("", "10.0.0.1"), ("h", "h")]


def test_shrinkage_against_plain_version(spark):
    rows = [("a.x.com", i < 8) for i in range(10)] + [("b.x.com", False)] * 30 + [("y.com", True)] + [("z.org", i % 3 == 0) for i in range(9)]
    got = {k: {r[0]: r for r in v.collect()} for k, v in reputation(spark.createDataFrame(rows, "host string, bad boolean")).items()}
    n, k = defaultdict(int), defaultdict(int)
    for h, bad in rows:
        for key in (("host", h), ("domain", ".".join(h.split(".")[-2:]) + "/" + h.split(".")[-1]), ("suffix", h.split(".")[-1]), ("corpus", 0)):
            n[key] += 1
            k[key] += bad
    means = {("corpus", 0): (k["corpus", 0] + 1) / (n["corpus", 0] + 2)}
    up = {"host": lambda h: ("domain", ".".join(h.split(".")[-2:]) + "/" + h.split(".")[-1]), "domain": lambda d: ("suffix", d.split("/")[-1]), "suffix": lambda s: ("corpus", 0)}
    for level in ("suffix", "domain", "host"):
        nodes = [x for x in n if x[0] == level]
        over = sum((k[x] - n[x] * means[up[level](x[1])]) ** 2 - n[x] * means[up[level](x[1])] * (1 - means[up[level](x[1])]) for x in nodes)
        room = sum(n[x] * (n[x] - 1) * means[up[level](x[1])] * (1 - means[up[level](x[1])]) for x in nodes)
        rho = min(max(over / room, 1 / 1001), 1 / 2)
        for x in nodes:
            s, m = 1 / rho - 1, means[up[level](x[1])]
            means[x] = (s * m + k[x]) / (s + n[x])
            assert math.isclose(got[level][x[1]]["mean"], means[x], rel_tol=1e-9)
    assert got["host"]["a.x.com"]["mean"] > got["host"]["b.x.com"]["mean"]


def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cols = ["page_id", "host", "path", "rule", "verdict", "n_labelled", "bad_bound"]
    expected = con.execute(f"SELECT {', '.join(cols)} FROM ({urls.ORACLE_SQL}) ORDER BY page_id").fetchall()
    assert [tuple(r) for r in urls.op1_url_filter(spark, sf).select(*cols).orderBy("page_id").collect()] == expected


def test_verdicts_and_odd_tables(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(None, "http://bad.net/x"), (1, "http://bad.net/x")], "page_id long, url string")
    pages = pages.withColumns({"host": F.lit("x"), "row": F.lit(1), "domain": F.lit(2), "n": F.lit(3), "verdict": F.lit(4)})
    outcomes = spark.createDataFrame([("bad.net", True)] * 40 + [("good.net", False)] * 200 + [("bad.net", None)], "host string, bad boolean")
    out = judge(pages, outcomes, [Rule("bad.net", "/ok", True)]).collect()
    assert len(out) == len(URLS) + 2
    assert {r.verdict for r in out if r.host == "bad.net"} == {"block"} and {r.n_labelled for r in out if r.host == "bad.net"} == {40}
    assert {r.verdict for r in judge(pages, outcomes.limit(0), []).collect()} == {"allow"}
    assert judge(pages.limit(0), outcomes, RULES).count() == 0


def test_all_digit_hosts_do_not_repeat_pages(spark, tmp_path):
    """The host 3.4 has no suffix, x.3.4 has one: both are called 3.4 without it."""
    pages = [(i, u, "") for i, u in enumerate(["http://3.4/", "http://x.3.4/", "http://y.3.4/a", "http://3.4/b"])]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    labels = [(i, i % 2, 0) for i in range(4)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = urls.op1_url_filter(spark, str(tmp_path))
    assert sorted(r.page_id for r in got.collect()) == [0, 1, 2, 3]
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    assert sorted(map(str, con.execute(urls.ORACLE_SQL).fetchall())) == sorted(str(tuple(r)) for r in got.collect())
