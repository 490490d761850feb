"""Resolution of not-modified revisit records.

A revisit record says that a server answered "not modified": it has headers
but no body. It is joined to the latest earlier full response of the same
canonical URL. If the validators agree (entity tags, else modification dates),
the revisit gets that response's status and body, and its headers with the
revisit's own put over them, except those that describe the body or the
connection. Otherwise the record stays unresolved, with the reason.

The as-of join runs on narrow rows (key, time, id) in two levels: inside time
buckets whose limits are quantiles of all record times, and across the buckets
of a URL. A URL that holds a third of all records is spread over the buckets.
Bodies move once, by record id.

Defined results: a null URL or time has no earlier response; of responses
at one time the one with the largest id is the latest; a response at the
revisit's own time is not earlier; repeated rows (equal record_id) count once
as responses and are resolved each as revisits; a null header map is empty;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.session import table_path

BUCKETS = 256
#: Headers that a not-modified answer may not change in a stored response.
NOT_MERGED = [
    "connection",
    "content-encoding",
    "content-length",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
]


def canonical_url(url: Column) -> Column:
    """Host in lower case without www or default port; no scheme, fragment, tracking parameter or last slash; parameters sorted."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?@]*@)?([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www[0-9]*\.", "")
    path = F.regexp_extract(bare, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?]*([^?]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, r"/index\.html?$", ""), r"/+$", "")
    params = F.filter(
        F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"),
        lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)"),
    )
    query = F.array_join(F.array_sort(params), "&")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit(""))))


def as_of(records: DataFrame) -> DataFrame:
    """``records`` (key, ts, record_id, full) to the revisits' (record_id, key, ts, refers_to)."""
    usable = records.where("key is not null and ts is not null")
    limits = usable.agg(F.percentile_approx("ts", [i / BUCKETS for i in range(1, BUCKETS)], 10_000).alias("limits")).first()["limits"] or []
    bucket = F.size(F.filter(F.lit(limits).cast("array<bigint>"), lambda x: x < F.col("ts"))) if limits else F.lit(0)
    events = usable.withColumn("bucket", bucket).withColumn("mark", F.when(F.col("full"), F.struct("ts", "record_id")))
    ends = events.groupBy("key", "bucket").agg(F.max("mark").alias("end"))
    before = W.partitionBy("key").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    ends = ends.select("key", "bucket", F.last("end", ignorenulls=True).over(before).alias("carried"))
    inside = W.partitionBy("key", "bucket").orderBy("ts", "full", "record_id").rowsBetween(W.unboundedPreceding, -1)
    found = events.withColumn("near", F.last("mark", ignorenulls=True).over(inside)).where("not full").join(ends, ["key", "bucket"])
    return found.select("record_id", "key", "ts", F.coalesce("near", "carried")["record_id"].alias("refers_to"))


def _opaque(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def validators_agree(revisit: Column, stored: Column) -> Column:
    """Entity tags by weak comparison if the revisit has one, else modification dates, else none on either side."""
    tag, date = revisit["etag"], revisit["last-modified"]
    return F.coalesce(
        F.when(tag.isNotNull(), _opaque(tag) == _opaque(stored["etag"]))
        .when(date.isNotNull(), date == stored["last-modified"])
        .otherwise(stored["etag"].isNull() & stored["last-modified"].isNull()),
        F.lit(False),
    )


def merged_headers(revisit: Column, stored: Column) -> Column:
    """The stored headers with the revisit's permitted ones over them."""
    own = F.map_filter(revisit, lambda k, _: ~k.isin(NOT_MERGED))
    return F.map_concat(F.map_filter(stored, lambda k, _: ~F.array_contains(F.map_keys(own), k)), own)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` (record_id, type, url, ts, status, headers, body) to its revisits, resolved.

    ``type`` is ``response`` or ``revisit``; header names are in lower case.
    Returns record_id, key, ts, refers_to, verdict (resolved, no_response or
    validator_mismatch), and status, headers, body (null unless resolved).
    """
    empty = F.create_map().cast("map<string,string>")
    records = records.select("record_id", "type", canonical_url(F.col("url")).alias("key"), "ts", "status", F.coalesce("headers", empty).alias("headers"), "body")
    full = (F.col("type") == "response") & (F.col("status") == 200)
    revisits = records.where("type = 'revisit'").select("record_id", "key", "ts", "headers")
    stored = records.where(full).select(F.col("record_id").alias("refers_to"), "status", F.col("headers").alias("stored"), "body").dropDuplicates(["refers_to"])
    narrow = records.where(full | (F.col("type") == "revisit")).select("key", "ts", "record_id", full.alias("full"))
    referred = as_of(narrow).select("record_id", "key", "ts", "refers_to").distinct()
    same = [revisits[c].eqNullSafe(referred[c]) for c in ("record_id", "key", "ts")]
    named = revisits.join(referred, same, "left").select(revisits["record_id"], revisits["key"], revisits["ts"], "headers", "refers_to")
    # revisits without an earlier response are spread over the join, not sent to one task
    spread = F.when(F.col("refers_to").isNull(), F.pmod(F.xxhash64("record_id"), F.lit(1 << 20))).otherwise(F.lit(0).cast("long"))
    joined = named.withColumn("spread", spread).join(stored.withColumn("spread", F.lit(0).cast("long")), ["refers_to", "spread"], "left")
    agree = validators_agree(F.col("headers"), F.col("stored"))
    verdict = F.when(F.col("stored").isNull(), "no_response").when(agree, "resolved").otherwise("validator_mismatch")
    good = F.col("verdict") == "resolved"
    return joined.withColumn("verdict", verdict).select(
        "record_id",
        "key",
        "ts",
        "refers_to",
        "verdict",
        F.when(good, F.col("status")).alias("status"),
        F.when(good, merged_headers(F.col("headers"), F.col("stored"))).alias("headers"),
        F.when(good, F.col("body")).alias("body"),
    )


def records_of_pages(pages: DataFrame) -> DataFrame:
    """A crawl made of ``pages``: every page as a response, some again changed, and revisits of all.

    A page's records carry ids 8 * page_id + 0..7 and times around its own:
    0 response; 1 changed response (each third page); 2, 3 revisits with the
    first entity tag before and after the change; 4 a revisit with only a
    date; 5 a revisit before the response (each fifth page).
    """
    base = F.lit(1_700_000_000) + F.col("page_id") % 1000 * 3600
    tag, date = F.concat(F.lit('"p'), F.col("page_id").cast("string"), F.lit('"')), F.concat(F.lit("day "), (F.col("page_id") % 28).cast("string"))
    size = F.length("html").cast("string")

    def record(n: int, kind: str, after: int, headers: Column, url: Column, body: Column, when: Column) -> Column:
        fields = {
            "n": F.lit(n),
            "type": F.lit(kind),
            "url": url,
            "ts": base + after,
            "status": F.lit(200 if kind == "response" else 304),
            "headers": headers,
            "body": body,
        }
        return F.when(when, F.struct(*[v.alias(k) for k, v in fields.items()]))

    def response(tag: Column, size: Column) -> Column:
        pairs = {"content-type": F.lit("text/html"), "content-length": size, "etag": tag, "last-modified": date, "date": F.lit("first"), "cache-control": F.lit("max-age=60")}
        return F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v)])

    def revisit(n: int, **validator: Column) -> Column:
        pairs = {"date": F.lit(f"again {n}"), "cache-control": F.lit("max-age=600"), "expires": F.lit("later"), "content-length": F.lit("0"), "content-encoding": F.lit("identity")}
        pairs |= {k.replace("_", "-"): v for k, v in validator.items()}
        return F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v)])

    url, none, always = F.col("url"), F.lit(None).cast("string"), F.lit(True)
    changed = F.concat(F.col("html"), F.lit("<!-- changed -->"))
    all_records = F.array(
        record(0, "response", 0, response(tag, size), url, F.col("html"), always),
        record(1, "response", 5000, response(F.concat(F.lit("W/"), F.lit('"q'), F.col("page_id").cast("string"), F.lit('"')), size), url, changed, F.col("page_id") % 3 == 0),
        record(2, "revisit", 1000, revisit(2, etag=F.concat(F.lit("W/"), tag)), F.concat(url, F.lit("#part")), none, always),
        record(3, "revisit", 6000, revisit(3, etag=tag), url, none, always),
        record(4, "revisit", 7000, revisit(4, last_modified=date), url, none, always),
        record(5, "revisit", -1000, revisit(5, etag=tag), url, none, F.col("page_id") % 5 == 0),
    )
    each = pages.select("page_id", F.explode(F.filter(all_records, lambda r: r.isNotNull())).alias("r"))
    return each.select((F.col("page_id") * 8 + F.col("r.n")).alias("record_id"), "r.type", "r.url", "r.ts", "r.status", "r.headers", "r.body")


def op2_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(table_path(sf_dir, "pages"))
    found = resolve_revisits(records_of_pages(pages))
    lines = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.select(
        "record_id",
        F.col("key").alias("url_key"),
        "ts",
        "refers_to",
        "verdict",
        F.col("status").cast("long").alias("status"),
        F.array_join(F.array_sort(lines), "\n").alias("headers"),
        F.sha2("body", 256).alias("body_sha256"),
    )


ORACLE = r"""
WITH b AS (
  SELECT page_id, html, url, regexp_replace(trim(url), '#.*$', '') AS bare,
         1700000000 + page_id % 1000 * 3600 AS base, '"p' || page_id || '"' AS tag, 'day ' || (page_id % 28) AS day
  FROM pages
), h AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?@]*@)?([^/?]*)', 1)), ':(80|443)$', ''), '^www[0-9]*\.', '') AS host,
         regexp_replace(regexp_replace(regexp_extract(bare, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?]*([^?]*)', 1), '/index\.html?$', ''), '/+$', '') AS path,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))), '&') AS query
  FROM b
), k AS (
  SELECT *, CASE WHEN host <> '' THEN host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS key FROM h
), r AS (
  SELECT page_id * 8 AS id, key, base AS ts, tag AS etag, day, html AS body, length(html) AS size FROM k
  UNION ALL
  SELECT page_id * 8 + 1, key, base + 5000, '"q' || page_id || '"', day, html || '<!-- changed -->', length(html) FROM k WHERE page_id % 3 = 0
), v AS (
  SELECT page_id * 8 + 2 AS id, key, base + 1000 AS ts, 2 AS n, tag AS etag, day FROM k
  UNION ALL SELECT page_id * 8 + 3, key, base + 6000, 3, tag, day FROM k
  UNION ALL SELECT page_id * 8 + 4, key, base + 7000, 4, NULL, day FROM k
  UNION ALL SELECT page_id * 8 + 5, key, base - 1000, 5, tag, day FROM k WHERE page_id % 5 = 0
), j AS (
  SELECT v.*, r.id AS ref, r.etag AS retag, r.day AS rday, r.body, r.size,
         row_number() OVER (PARTITION BY v.id ORDER BY r.ts DESC, r.id DESC) AS nth
  FROM v LEFT JOIN r ON r.key = v.key AND r.ts < v.ts
), d AS (
  SELECT *, CASE WHEN ref IS NULL THEN 'no_response'
                 WHEN CASE WHEN etag IS NOT NULL THEN etag = retag ELSE day = rday END THEN 'resolved'
                 ELSE 'validator_mismatch' END AS verdict
  FROM j WHERE nth = 1
)
SELECT CAST(id AS BIGINT) AS record_id, key AS url_key, CAST(ts AS BIGINT) AS ts, CAST(ref AS BIGINT) AS refers_to, verdict,
       CASE WHEN verdict = 'resolved' THEN CAST(200 AS BIGINT) END AS status,
       CASE WHEN verdict = 'resolved' THEN array_to_string(list_sort([
         'cache-control: max-age=600', 'content-length: ' || size, 'content-type: text/html', 'date: again ' || n, 'expires: later',
         'etag: ' || CASE WHEN n = 2 THEN 'W/' || etag WHEN n = 4 THEN CASE WHEN ref % 8 = 1 THEN 'W/' || retag ELSE retag END ELSE etag END,
         'last-modified: ' || CASE WHEN n = 4 THEN day ELSE rday END]), chr(10)) END AS headers,
       CASE WHEN verdict = 'resolved' THEN sha256(body) END AS body_sha256
FROM d
"""
