import random

import duckdb
from pyspark.sql import functions as F

from equiscope.llm import revisits
from equiscope.llm.revisits import KEPT_FROM_RESPONSE, canonical, op6_revisits, resolve

SCHEMA = "record_id long, url string, ts long, status int, headers map<string,string>, digest string"


def test_canonical_urls(spark):
    cases = {
        "http://WWW.Example.com:80/a/?utm_source=x&b=2&a=1#f": "example.com/a?a=1&b=2", "https://example.com/a?a=1&b=2": "example.com/a?a=1&b=2",
        "http://example.com": "example.com", "http://example.com/": "example.com", "http://www2.h:443?q": "h?q", "http://h:8080/P": "h:8080/P",
        "no scheme": None, None: None, "": None,
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r[0]: r[1] for r in df.select("u", canonical(F.col("u"))).collect()} == cases


def plain(rows):
    out = {}
    for i, url, ts, status, headers, digest in rows:
        if status != 304:
            continue
        earlier = [r for r in rows if r[3] == 200 and r[1] == url and url and None not in (ts, r[2]) and r[2] < ts]
        found = max(earlier, key=lambda r: (r[2], r[0]), default=None)
        h = headers or {}
        if not found:
            out[i] = ("no_earlier_response", None, h, digest)
            continue
        f = found[4] or {}
        weak = lambda t: t.removeprefix("W/")
        if "etag" in h and "etag" in f:
            ok = weak(h["etag"]) == weak(f["etag"])
        elif "last-modified" in h and "last-modified" in f:
            ok = h["last-modified"] == f["last-modified"]
        elif digest and found[5]:
            ok = digest == found[5]
        else:
            out[i] = ("no_validator", None, h, digest)
            continue
        new = {k: v for k, v in h.items() if k not in KEPT_FROM_RESPONSE}
        out[i] = ("resolved", found[0], f | new, found[5] or digest) if ok else ("mismatch", None, h, digest)
    return out


def test_against_brute_force(spark):
    r = random.Random(1)
    rows = []
    for i in range(400):
        headers = {k: f"{k}{r.randrange(2)}" for k in ("last-modified", "content-length", "date", "server") if r.random() < 0.5}
        if r.random() < 0.5:
            headers["etag"] = r.choice(["", "W/"]) + f'"{r.randrange(2)}"'
        url = r.choice(["http://hot/"] * 3 + ["http://a/x", "http://b/", None])
        ts = r.choice([None] + [r.randrange(0, 5 * 86400)] * 10 + [1000, 86400, 86399])
        rows.append((i, url, ts, r.choice([200, 304, 304, 404]), r.choice([headers, headers, None]), r.choice([None, "d1", "d2"])))
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"day": F.lit(1), "here": F.lit(2), "response": F.lit(3)})
    got = {x.record_id: (x.outcome, x.refers_to, x.headers, x.digest) for x in resolve(df).collect()}
    assert got == plain(rows)
    assert len({v[0] for v in got.values()}) == 4
    assert resolve(df.limit(0)).count() == 0


def test_repeated_revisits_stay(spark):
    rows = [(1, "http://a/", 5, 200, {"etag": "x"}, "d"), (2, "http://a/", 9, 304, {"etag": "x"}, None), (2, "http://a/", 9, 304, {"etag": "x"}, None)]
    assert [r.refers_to for r in resolve(spark.createDataFrame(rows, SCHEMA)).collect()] == [1, 1]


def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    cols = ["record_id", "url_key", "refers_to", "outcome", "headers", "digest"]
    expected = con.execute(f"SELECT {', '.join(cols)} FROM ({revisits.ORACLE_SQL}) ORDER BY 1").fetchall()
    assert [tuple(r) for r in op6_revisits(spark, sf).select(*cols).orderBy("record_id").collect()] == expected


def test_urls_with_line_breaks_stay_apart(spark):
    urls = ["http://a.com/x\ny", "http://b.com/p\nq", "http://a.com/x", "http://A.com/x\ny#f\ng", "http://a.com/x?k\n=1&b\n", "http://a.com/\n"]
    keys = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").coalesce(1).select(canonical(F.col("u"))).collect()]
    assert keys == ["a.com/x\ny", "b.com/p\nq", "a.com/x", "a.com/x\ny", "a.com/x?b\n&k\n=1", "a.com/\n"]
