"""Resolution of not-modified WARC revisits.

A revisit record with status 304 says that a page had not changed. It is resolved by an
as-of join: the latest full response (status 200) of the same canonical URL that was
captured strictly earlier. The revisit's validators must fit that response: its ETag by
weak comparison, without one its Last-Modified, without either only a response that has
none. A resolved revisit gets the response's headers, updated with its own but for
those that describe the body or the connection.

The as-of join is a window in three levels: within (URL, minute), over the minutes of a
(URL, day) and over the days of a URL, each of the latter two with one row a step, so that
a URL that holds a third of the log is spread over tasks. Records without a URL or a time
match nothing and stay out of it. Payloads are not shuffled; the result names the response
and its payload's digest.

Edge cases: of responses captured at the same time the largest record id counts; a
null or unparsable URL, date or status makes a record that matches nothing (a revisit
is then ``no_earlier``); repeated header fields are joined by a comma; repeated records
count as separate ones with equal results; an empty table gives no rows.

Only DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import stored

# Fields of a 304 that never replace stored ones (about the body or the
# connection), and tracking parameters that do not name a page.
NOT_UPDATED = (
    "connection content-encoding content-length content-range content-type keep-alive "
    "proxy-authenticate proxy-authentication-info proxy-authorization proxy-connection te trailer transfer-encoding upgrade"
).split()
TRACKING = "utm_[a-z]+|gclid|fbclid|ref"


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, https for http, no ``www.``, default port, fragment,
    tracking parameter, final slash; parameters sorted."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?@]*@)?([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    params = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(f"^({TRACKING})(=|$)"))
    tail = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(params), "&"))).otherwise("")
    return F.when(host != "", F.concat(F.lit("https://"), host, path, tail))


def _lines(block: str) -> Column:
    """The header lines of a block, by one search of the whole block: a test of each line
    by a pattern costs several times as much."""
    return F.regexp_extract_all(F.replace(F.col(block), F.lit("\r\n"), F.lit("\n")), F.lit(r"(?md)^[^:\s]+:[^\n]*"), F.lit(0))


def _names(lines: str) -> Column:
    return F.transform(lines, lambda x: F.lower(F.substring_index(x, ":", 1)))


def _values(lines: str) -> Column:
    return F.transform(lines, lambda x: F.trim(F.substr(x, F.instr(x, ":") + 1)))


def _fields(names: str, values: str) -> Column:
    """Names and values as a map; values of repeated names are joined by commas."""
    different = F.array_distinct(names)
    pairs = F.arrays_zip(F.col(names).alias("k"), F.col(values).alias("v"))
    joined = F.transform(different, lambda n: F.array_join(F.transform(F.filter(pairs, lambda p: p["k"] == n), lambda p: p["v"]), ", "))
    return F.when(F.size(different) == F.size(names), F.map_from_arrays(names, values)).otherwise(F.map_from_arrays(different, joined))


def parse_records(raw: DataFrame, record_col: str = "record") -> DataFrame:
    """WARC records (WARC fields, HTTP head and payload in one text) as rows: record_id,
    warc_type, url, captured, status, headers, payload_sha1."""
    rows = raw.select(F.split(F.col(record_col), "\r\n\r\n", 3).alias("parts"))
    rows = rows.select(*[F.coalesce(F.get("parts", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(("warc", "http", "payload"))])
    rows = rows.select(_lines("warc").alias("wl"), _lines("http").alias("hl"), "http", F.sha1("payload").alias("payload_sha1"))
    rows = rows.select(
        _names("wl").alias("wn"), _values("wl").alias("wv"), _names("hl").alias("hn"), _values("hl").alias("hv"), "http", "payload_sha1"
    )
    w, headers = _fields("wn", "wv").alias("w"), _fields("hn", "hv").alias("headers")
    rows = rows.select(w, headers, "http", "payload_sha1")
    return rows.select(
        F.col("w")["warc-record-id"].alias("record_id"),
        F.lower(F.col("w")["warc-type"]).alias("warc_type"),
        F.col("w")["warc-target-uri"].alias("url"),
        F.try_to_timestamp(F.col("w")["warc-date"]).alias("captured"),
        F.expr("try_cast(regexp_extract(http, '^HTTP/[0-9.]+ ([0-9]{3})', 1) AS int)").alias("status"),
        "headers",
        "payload_sha1",
    )


def _weak(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def merged_headers(stored: Column, update: Column) -> Column:
    """Stored fields, updated by the permitted fields of the 304. Fields that the 304's
    Connection field names are not permitted either."""
    listed = F.transform(F.split(F.lower(F.coalesce(update["connection"], F.lit(""))), ","), lambda x: F.trim(x))
    allowed = F.map_filter(update, lambda k, v: ~k.isin(*NOT_UPDATED) & ~F.array_contains(listed, k))
    rest = F.map_filter(stored, lambda k, v: ~F.map_contains_key(allowed, k))
    return F.map_concat(rest, allowed)


def resolve(records: DataFrame) -> DataFrame:
    """One row per not-modified revisit: record_id, url (canonical), captured, status
    (resolved, mismatch, no_validator, no_earlier), response_id, headers, payload_sha1;
    the last three null unless resolved."""
    rows = records.select("record_id", "warc_type", canonical_url(F.col("url")).alias("url"), "captured", "status", "headers", "payload_sha1")
    full = (F.col("warc_type") == "response") & (F.col("status") == 200)
    revisit = (F.col("warc_type") == "revisit") & (F.col("status") == 304)
    rows = rows.withColumn("full", F.coalesce(full, F.lit(False))).filter(F.col("full") | F.coalesce(revisit, F.lit(False)))
    response = F.struct("captured", "record_id", "headers", "payload_sha1")
    # parsed once for the uses below; no payloads
    rows = stored(rows.withColumn("response", F.when(F.col("full"), response)))
    timed = F.col("url").isNotNull() & F.col("captured").isNotNull()
    none = rows.filter(~timed & ~F.col("full")).withColumn("response", F.lit(None).cast(rows.schema["response"].dataType))
    placed = rows.filter(timed).withColumn("day", F.to_date("captured")).withColumn("minute", F.date_trunc("minute", "captured"))

    def up_to(order: list[str], *keys: str) -> Window:
        return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)

    # revisits come before responses of the same time, so that only earlier ones precede
    inside = F.last("response", ignorenulls=True).over(up_to(["captured", "full", "record_id"], "url", "minute"))
    near = placed.withColumn("near", inside).filter(~F.col("full"))
    latest = F.max_by("latest", F.struct("latest.captured", "latest.record_id")).alias("latest")
    responses = placed.filter("full").select("url", "day", "minute", F.col("response").alias("latest"))
    # a step without a response is there for its revisits
    steps = responses.groupBy("url", "day", "minute").agg(latest)
    asked = near.select("url", "day", "minute").distinct()
    minutes = asked.join(steps, ["url", "day", "minute"], "full")
    mid = minutes.withColumn("mid", F.last("latest", ignorenulls=True).over(up_to(["minute"], "url", "day"))).drop("latest")
    days = minutes.groupBy("url", "day").agg(F.max_by("latest", F.when(F.col("latest").isNotNull(), F.col("minute"))).alias("latest"))
    days = days.withColumn("far", F.last("latest", ignorenulls=True).over(up_to(["day"], "url"))).drop("latest")
    found = near.join(mid, ["url", "day", "minute"]).join(days, ["url", "day"])
    found = found.withColumn("response", F.coalesce("near", "mid", "far")).select(*rows.columns)
    return _judged(found.unionByName(none))


def _judged(found: DataFrame) -> DataFrame:
    own, kept = F.col("headers"), F.col("response")["headers"]
    by_tag = _weak(own["etag"]).eqNullSafe(_weak(kept["etag"]))
    by_date = own["last-modified"].eqNullSafe(kept["last-modified"])
    status = (
        F.when(F.col("response").isNull(), "no_earlier")
        .when(own["etag"].isNotNull(), F.when(by_tag, "resolved").otherwise("mismatch"))
        .when(own["last-modified"].isNotNull(), F.when(by_date, "resolved").otherwise("mismatch"))
        .when(kept["etag"].isNull() & kept["last-modified"].isNull(), "resolved")
        .otherwise("no_validator")
    )
    rows = found.withColumn("outcome", status)
    good = F.col("outcome") == "resolved"
    return rows.select(
        "record_id", "url", "captured", F.col("outcome").alias("status"),
        F.when(good, F.col("response")["record_id"]).alias("response_id"),
        F.when(good, merged_headers(kept, own)).alias("headers"),
        F.when(good, F.col("response")["payload_sha1"]).alias("payload_sha1"),
    )
