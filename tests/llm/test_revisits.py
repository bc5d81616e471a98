import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens.llm import queries
from orderlens.llm import revisits as rv

SCHEMA = "record_id string, warc_type string, url string, captured timestamp, status int, headers map<string,string>, payload_sha1 string"


def at(day, minute=0):
    return dt.datetime(2024, 1, day, 0, minute)


def full(i, url, when, **headers):
    return (i, "response", url, when, 200, {k.replace("_", "-"): v for k, v in headers.items()}, "sha-" + i)


def again(i, url, when, **headers):
    return (i, "revisit", url, when, 304, {k.replace("_", "-"): v for k, v in headers.items()}, "none")


U = "http://www.Example.com:80/a/?utm_source=x&b=2&a=1#top"
V = "https://example.com/a?a=1&b=2"
ROWS = [
    full("r1", U, at(1), etag='"1"', content_type="text/html", content_length="9", cache_control="old", x_own="kept"),
    full("r2", V, at(3), etag='"2"', last_modified="Mon"),
    full("r3", V, at(3), etag='"3"'),
    again("v0", V, at(1), etag='"1"'),  # at the same time, not earlier
    again("v1", V, at(2), etag='W/"1"', cache_control="new", content_length="0", content_type="x", connection="X-Drop", x_drop="1", date="d"),
    again("v2", V, at(3, 1), etag='"2"'),  # the latest is r3
    again("v3", V, at(9), etag='"3"'),  # days later
    again("v3", V, at(9), etag='"3"'),  # repeated
    again("v4", "https://other.org/", at(9), etag='"3"'),
    again("v5", None, at(9), etag='"3"'),
    again("v6", V, None, etag='"3"'),
    again(None, V, at(9), etag='"no"'),
    full("r4", "https://b.org", at(1), last_modified="Tue"),
    again("v7", "https://b.org/", at(2), last_modified="Tue"),
    again("v8", "https://b.org/", at(2), last_modified="Wed"),
    again("v9", "https://b.org/", at(2)),
    full("r5", "https://c.org", at(1)),
    again("va", "https://c.org", at(2)),
    full("r6", None, at(1)), full("r7", V, None), ("x", "response", V, at(8), 404, {}, "s"), ("y", "request", V, at(8), None, None, None),
]


def test_resolution(frame):
    got = sorted(((r.record_id or "", r.status, r.response_id) for r in rv.resolve(frame(ROWS, SCHEMA + "")).collect()))
    assert got == [
        ("", "mismatch", None), ("v0", "no_earlier", None), ("v1", "resolved", "r1"), ("v2", "mismatch", None), ("v3", "resolved", "r3"),
        ("v3", "resolved", "r3"), ("v4", "no_earlier", None), ("v5", "no_earlier", None), ("v6", "no_earlier", None), ("v7", "resolved", "r4"),
        ("v8", "mismatch", None), ("v9", "no_validator", None), ("va", "resolved", "r5"),
    ]


def test_merged_headers(frame):
    row = [r for r in rv.resolve(frame(ROWS, SCHEMA)).collect() if r.record_id == "v1"][0]
    assert row.headers == {"etag": 'W/"1"', "cache-control": "new", "content-type": "text/html", "content-length": "9", "x-own": "kept", "date": "d"}
    assert row.payload_sha1 == "sha-r1" and row.url == V


@pytest.mark.parametrize(
    "url, want",
    [(U, V), ("HTTPS://user@Host.Org:443/", "https://host.org"), ("ftp://h/x//", "https://h/x"), ("no url", None), (None, None), ("http://h?gclid=1", "https://h")],
)
def test_canonical_url(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(rv.canonical_url(F.col("u"))).first()[0] == want


def test_parse_records(spark):
    raw = "WARC/1.1\r\nWARC-Type: Response\r\nWARC-Record-ID: i\r\nWARC-Target-URI: http://h/a:b\r\nWARC-Date: 2024-01-02T03:04:05Z\r\n\r\n" \
        "HTTP/1.1 200 OK\r\nA: 1\r\na:  2\r\nbroken\r\n\r\nbody\r\n\r\nmore"
    rows = spark.createDataFrame([(raw,), ("",), (None,), ("junk",)], "record string")
    got = rv.parse_records(rows).collect()
    first = got[0]
    assert (first.warc_type, first.url, first.status, first.headers) == ("response", "http://h/a:b", 200, {"a": "1, 2"})
    assert first.captured == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert all(r.status is None and r.headers == {} for r in got[1:])
    assert rv.resolve(rv.parse_records(rows)).collect() == []


def test_log_of_pages_equals_brute_force(spark, sf):
    """The registered query against a search over all earlier captures."""
    records = rv.parse_records(queries.page_log(spark.read.parquet(f"{sf}/pages.parquet"))).withColumn("url", rv.canonical_url(F.col("url"))).collect()
    fulls = [r for r in records if r.warc_type == "response"]
    got = {r.record_id: r for r in queries.op5_revisits(spark, sf).collect()}
    for v in (r for r in records if r.warc_type == "revisit"):
        earlier = [r for r in fulls if r.url == v.url and r.captured < v.captured]
        last = max(earlier, key=lambda r: (r.captured, r.record_id), default=None)
        g = got[v.record_id]
        if g.status == "resolved":
            assert g.response_id == last.record_id and g.payload_sha1 == last.payload_sha1
        elif g.status == "no_earlier":
            assert last is None
        tag = (v.headers.get("etag") or "").removeprefix("W/")
        if last is not None and tag:
            assert (g.status == "resolved") == (tag == last.headers.get("etag"))


def test_plan_is_native_and_empty_log(spark, frame):
    import re

    plan = rv.resolve(frame(ROWS, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Cartesian|NestedLoop", plan)
    assert rv.resolve(spark.createDataFrame([], SCHEMA)).collect() == []


def test_the_log_of_the_query_holds_every_case(spark, sf):
    from orderlens.llm import queries

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    log = rv.parse_records(queries.page_log(pages))
    full = log.filter("warc_type = 'response'")
    assert full.groupBy(rv.canonical_url(full["url"])).count().agg({"count": "max"}).first()[0] > 4  # a site that many share
    out = {r["status"]: r["count"] for r in rv.resolve(log).groupBy("status").count().collect()}
    assert set(out) == {"resolved", "mismatch", "no_earlier", "no_validator"} and min(out.values()) > 3
    late = log.filter("record_id LIKE 'page1-%' OR record_id LIKE 'page2-%'").alias("a").join(
        log.filter("warc_type = 'revisit'").alias("b"), "url").selectExpr("sign(datediff(a.captured, b.captured)) s").distinct().collect()
    assert {r["s"] for r in late} == {-1, 0, 1}


def test_a_hot_url_within_a_minute_and_over_days(spark, frame):
    """The latest earlier response, whichever level of the search has it."""
    import random

    rng = random.Random(3)
    rows = []
    for i in range(600):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.choice([0, 0, 0, 1, 9]), seconds=rng.choice([0, 5, 50, 61, 300, 80_000]))
        kind = rng.choice(["response", "revisit"])
        rows.append((f"r{i:04}", kind, "https://hot.org/", at if rng.random() < 0.95 else None, 200 if kind == "response" else 304, {"etag": '"x"'}, f"s{i}"))
    df = frame(rows, "record_id string, warc_type string, url string, captured timestamp_ntz, status int, headers map<string,string>, payload_sha1 string")
    got = {r["record_id"]: r["response_id"] for r in rv.resolve(df).collect()}
    responses = [(r[3], r[0]) for r in rows if r[1] == "response" and r[3]]
    for r in rows:
        if r[1] == "revisit":
            earlier = [x for x in responses if r[3] and x[0] < r[3]]
            assert got[r[0]] == (max(earlier)[1] if earlier else None)


def test_the_log_is_made_by_compiled_code(spark, sf):
    """A lambda around the records would interpret all that makes them; dates and digests
    that several records hold are made once."""
    plan = queries.page_log(spark.read.parquet(f"{sf}/pages.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan
    assert plan.count("md5(") == 4 and plan.count("EEE, dd MMM yyyy") == 4  # three contents and the root; three captures and the request


def test_odd_header_lines_by_plain_python(spark):
    import random
    import re

    rng = random.Random(5)
    pieces = ["a", "B", ":", " ", "\r", "\n", "\r\n", "\t", "\u00e9", "\u0085", "\u2028", "x: y", "\u03a3: 1"]
    heads = ["".join(rng.choice(pieces) for _ in range(30)) for _ in range(300)] + ["", "A: 1\r\na:  2 \r\n b: x\nc:d:e\n:v\nE:\nF:   \ng:a\rb\r\r\nH: \t x \t"]
    heads = [h for h in heads if "\r\n\r\n" not in f"-\r\n\r\n{h}\r\n\r\n"[4:-4]]
    got = rv.parse_records(spark.createDataFrame([(f"-\r\n\r\n{h}\r\n\r\nbody",) for h in heads], "record string").coalesce(1)).collect()
    for head, row in zip(heads, got):
        want = {}
        for x in re.split("\r?\n", head):
            if re.match(r"[^: \t\n\x0b\f\r]+:", x):
                name, value = x.split(":", 1)
                want.setdefault(name.lower(), []).append(value.strip(" "))
        assert row.headers == {k: ", ".join(v) for k, v in want.items()}, repr(head)
