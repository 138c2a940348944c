"""Resolving "not modified" revisit records of a web archive.

A revisit (status 304) has no body: it stands for the latest full response of
the same canonical url that was captured strictly before it.  It is resolved if
its validators agree with that response: entity tags by weak comparison; without
a tag on both sides, equal Last-Modified; without those, equal payload digests.
The headers of a resolved record are the response's, replaced by the revisit's
where the protocol permits it: fields that describe the body or the connection
(``KEPT_FROM_RESPONSE``) stay as they were.

The as-of join works on time points.  All captures of a url in one second are
first aggregated to one point, and points are looked up within (url, day), at
most 86,400 of them; what a day inherits comes from a second window over the
days of a url.  No window sees all captures of a url, however popular.  The
revisits then join the points, and the answers their responses, by plain
equi-joins whose skew Spark splits.

Defined results: captures with a null time or url take no part as responses and
are returned as revisits with outcome ``no_earlier_response``; of several
responses in one second the largest record id counts; repeated revisits are
resolved one by one; null headers are empty; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from equiscope.llm.rows import read

DAY = 86_400

# Header fields that a 304 response does not replace.
KEPT_FROM_RESPONSE = [
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
]


def canonical(url: Column) -> Column:
    """Key of a url: no scheme, lower-case host without ``www.`` and default
    port, no fragment, no closing slash, query without ``utm_`` parameters
    and in order; null without ``://``."""
    rest = F.regexp_replace(F.regexp_extract(url, r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://(.*)\z", 1), r"(?s)#.*\z", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, "^[^/?]*", 0)), r"^www[0-9]*\.", ""), r":(80|443)\z", "")
    tail = F.regexp_extract(rest, r"(?s)^[^/?]*(.*)\z", 1)
    path = F.regexp_replace(F.regexp_extract(tail, r"^[^?]*", 0), r"/+\z", "")
    query = F.regexp_extract(tail, r"(?s)\?(.*)\z", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.startswith(p, F.lit("utm_"))))
    joined = F.array_join(kept, "&")
    return F.when(url.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), F.concat(host, path, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise("")))


def latest_earlier(captures: DataFrame) -> DataFrame:
    """(url_key, ts, response): for every second with a capture of a url, the
    record id of the latest full response strictly before it."""
    points = (
        captures.filter("url_key is not null and ts is not null").groupBy("url_key", "ts")
        .agg(F.max(F.when(F.col("status") == 200, F.col("record_id"))).alias("here"))
        .withColumn("day", F.floor(F.col("ts") / DAY))
    )
    within = Window.partitionBy("url_key", "day").orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    found = points.withColumn("today", F.last("here", ignorenulls=True).over(within))
    last = F.max_by("here", F.when(F.col("here").isNotNull(), F.col("ts")))
    days = points.groupBy("url_key", "day").agg(last.alias("last"))
    before = Window.partitionBy("url_key").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select("url_key", "day", F.last("last", ignorenulls=True).over(before).alias("carried"))
    return found.join(carried, ["url_key", "day"]).select("url_key", "ts", F.coalesce("today", "carried").alias("response"))


def _tag(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve(captures: DataFrame) -> DataFrame:
    """(record_id, url, ts, status, headers map<string,string>, digest) ->
    a row per revisit: record_id, url_key, refers_to, outcome, headers, digest.

    Header names are lower case."""
    empty = F.create_map().cast("map<string,string>")
    all_ = captures.select("record_id", "ts", "status", "digest", canonical(F.col("url")).alias("url_key"),
                           F.coalesce("headers", empty).alias("headers"))
    revisits = all_.filter("status = 304")
    asked = revisits.join(latest_earlier(all_.drop("headers", "digest")), ["url_key", "ts"], "left")
    full = all_.filter("status = 200").select(
        F.col("record_id").alias("response"), F.col("headers").alias("r_headers"), F.col("digest").alias("r_digest")
    )
    both = asked.join(full.dropDuplicates(["response"]), "response", "left")
    etag, r_etag = F.col("headers")["etag"], F.col("r_headers")["etag"]
    date, r_date = F.col("headers")["last-modified"], F.col("r_headers")["last-modified"]
    checks = [(_tag(etag), _tag(r_etag)), (date, r_date), (F.col("digest"), F.col("r_digest"))]
    outcome = F.lit("no_validator")
    for a, b in reversed(checks):
        outcome = F.when(a.isNotNull() & b.isNotNull(), F.when(a == b, "resolved").otherwise("mismatch")).otherwise(outcome)
    outcome = F.when(F.col("response").isNull(), "no_earlier_response").otherwise(outcome)
    permitted = F.map_filter("headers", lambda k, v: ~k.isin(KEPT_FROM_RESPONSE))
    old = F.map_filter("r_headers", lambda k, v: ~F.map_contains_key(permitted, k))
    merged = F.when(F.col("outcome") == "resolved", F.map_concat(old, permitted)).otherwise(F.col("headers"))
    return both.withColumn("outcome", outcome).select(
        "record_id", "url_key", F.when(F.col("outcome") == "resolved", F.col("response")).alias("refers_to"), "outcome",
        merged.alias("headers"), F.when(F.col("outcome") == "resolved", F.coalesce("r_digest", "digest")).otherwise(F.col("digest")).alias("digest"),
    )


def header_lines(headers: Column) -> Column:
    lines = F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.array_join(F.array_sort(lines), "\n")


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl of ``pages``: each page is a full response, and its url is asked
    again later, with the validators that a server of its kind sends back: the
    same tag, a weak one, a tag of changed content, the date alone, or none."""
    p = pages.filter("page_id is not null").select(
        "page_id", "url", F.md5(F.coalesce("html", F.lit(""))).alias("digest"),
        (F.lit(1_700_000_000) + F.pmod(F.col("page_id") * 7919, F.lit(30 * DAY))).alias("ts"),
        F.octet_length(F.coalesce("html", F.lit(""))).cast("string").alias("size"),
        F.pmod("page_id", F.lit(5)).alias("kind"),
    )
    tag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))
    modified = F.concat(F.lit("day "), F.pmod("page_id", F.lit(28)).cast("string"))

    def headers(**values: Column) -> Column:
        pairs = F.array(*[F.struct(F.lit(k.replace("_", "-")).alias("k"), v.cast("string").alias("v")) for k, v in values.items()])
        return F.map_from_entries(F.filter(pairs, lambda e: e["v"].isNotNull()))

    first = p.select(
        (F.col("page_id") * 2).alias("record_id"), "url", "ts", F.lit(200).alias("status"),
        headers(cache_control=F.lit("max-age=60"), content_length=F.col("size"), content_type=F.lit("text/html"), etag=tag,
                last_modified=modified).alias("headers"),
        "digest",
    )
    kind = F.col("kind")
    again = p.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url", (F.col("ts") + 3600 * (1 + kind * 20)).alias("ts"), F.lit(304).alias("status"),
        headers(
            cache_control=F.lit("max-age=600"), content_length=F.lit("0"),
            date=(F.col("ts") + 3600 * (1 + kind * 20)),
            etag=F.when(kind == 0, tag).when(kind == 1, F.concat(F.lit("W/"), tag)).when(kind == 2, F.lit('"changed"')),
            last_modified=F.when(kind == 3, modified),
        ).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return first.unionByName(again)


def op6_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve(captures_of(read(spark, sf_dir, "pages")))
    return found.select("record_id", "url_key", "refers_to", "outcome", header_lines(F.col("headers")).alias("headers"), "digest")


ORACLE_SQL = rf"""
WITH rest AS (SELECT page_id, url, regexp_replace(regexp_extract(url, '(?s)^[A-Za-z][A-Za-z0-9+.-]*://(.*)\z', 1), '(?s)#.*\z', '') AS rest,
    md5(coalesce(html, '')) AS digest, 1700000000 + (page_id * 7919) % {30 * DAY} AS ts,
    strlen(coalesce(html, ''))::VARCHAR AS size, page_id % 5 AS kind FROM pages WHERE page_id IS NOT NULL),
cut AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '^www[0-9]*\.', ''), ':(80|443)\z', '') AS host,
    regexp_extract(rest, '(?s)^[^/?]*(.*)\z', 1) AS tail FROM rest),
parts AS (SELECT *, regexp_replace(regexp_extract(tail, '^[^?]*'), '/+\z', '') AS path, array_to_string(list_sort(list_filter(
    string_split(regexp_extract(tail, '(?s)\?(.*)\z', 1), '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_'))), '&') AS query FROM cut),
p AS (SELECT *, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS url_key,
    '"' || substr(digest, 1, 16) || '"' AS tag, 'day ' || (page_id % 28) AS modified, ts + 3600 * (1 + kind * 20) AS again,
    CASE kind WHEN 0 THEN '"' || substr(digest, 1, 16) || '"' WHEN 1 THEN 'W/"' || substr(digest, 1, 16) || '"' WHEN 2 THEN '"changed"' END AS asked_tag,
    CASE kind WHEN 3 THEN 'day ' || (page_id % 28) END AS asked_date FROM parts),
full_ AS (SELECT url_key, ts, max(page_id) AS page_id FROM p GROUP BY ALL),
found AS (SELECT a.*, f.page_id AS r FROM p a ASOF LEFT JOIN full_ f ON a.url_key = f.url_key AND a.again > f.ts),
checked AS (SELECT a.*, r.digest AS r_digest, r.size AS r_size, r.tag AS r_tag, r.modified AS r_modified,
    CASE WHEN r IS NULL THEN 'no_earlier_response'
        WHEN a.asked_tag IS NOT NULL THEN CASE WHEN regexp_replace(a.asked_tag, '^W/', '') = r.tag THEN 'resolved' ELSE 'mismatch' END
        WHEN a.asked_date IS NOT NULL THEN CASE WHEN a.asked_date = r.modified THEN 'resolved' ELSE 'mismatch' END
        ELSE 'no_validator' END AS outcome
    FROM found a LEFT JOIN p r ON a.r = r.page_id)
SELECT page_id * 2 + 1 AS record_id, url_key, CASE WHEN outcome = 'resolved' THEN r * 2 END AS refers_to, outcome,
    CASE WHEN outcome = 'resolved' THEN 'cache-control: max-age=600' || chr(10) || 'content-length: ' || r_size || chr(10)
        || 'content-type: text/html' || chr(10) || 'date: ' || again || chr(10) || 'etag: ' || coalesce(asked_tag, r_tag) || chr(10)
        || 'last-modified: ' || coalesce(asked_date, r_modified)
    ELSE 'cache-control: max-age=600' || chr(10) || 'content-length: 0' || chr(10) || 'date: ' || again
        || coalesce(chr(10) || 'etag: ' || asked_tag, '') || coalesce(chr(10) || 'last-modified: ' || asked_date, '') END AS headers,
    CASE WHEN outcome = 'resolved' THEN r_digest END AS digest
FROM checked
"""
