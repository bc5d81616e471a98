"""Registered queries of the operators: thin wrappers with production parameters.

Each applies one operator to its whole table and derives the returned columns from
the operator's own results.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm import (
    bloom_lm,
    byte_bpe,
    chat,
    collocations,
    decontaminate,
    html_layout,
    kneser_ney,
    lang_id,
    line_dedup,
    periodic_runs,
    quality_rules,
    revisits,
    simhash,
)
from orderlens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    held_out = lang_id.held_out(F.col("doc_id"))
    model = lang_id.learn(docs.filter(~held_out))
    out = lang_id.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op2_html_text(spark: SparkSession, d: str) -> DataFrame:
    return html_layout.extract(table(spark, d, "pages")).select("page_id", "text")


def op3_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Per document: its lines with words, how many are removed and which."""
    out = line_dedup.removed_lines(table(spark, d, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def op4_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return byte_bpe.round_trip(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def page_log(pages: DataFrame) -> DataFrame:
    """A crawl log as WARC records (column ``record``) from the pages, growing with them.

    A page's URL is captured at minute ``page_id``, or then and four days or a week later,
    or only eight days later, or not at all; contents differ. It is asked for again after a
    week: after the last capture, before it, or at the time of one. The root of its site, which many pages share, is captured in the same minute (its
    content changes by the day) and asked for again a week later. Validators come from
    contents and times; some captures lack one, some requests send a stale or a weak one.

    Times, dates and tags that several records hold are columns first: made once, and the
    code that Spark makes of the records stays small enough to be compiled."""
    pid, start, again = F.col("pid"), F.col("start"), F.col("again")

    def line(name: str, value: Column, when: Column | None = None) -> Column:
        text = F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
        return text if when is None else F.when(when, text).otherwise("")

    def http_date(c: Column) -> Column:
        return F.date_format(c, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")

    def warc_date(c: Column) -> Column:
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def tag(body: Column) -> Column:
        return F.concat(F.lit('"'), F.substring(F.md5(body.cast("binary")), 1, 16), F.lit('"'))

    bare = pages.select(F.coalesce("page_id", F.lit(0)).alias("pid"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    first = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.expr("INTERVAL '1' MINUTE") * pid
    host = F.regexp_extract("url", "^[a-z]+://([^/]*)", 1)
    timed = bare.select("*", first.alias("start"), host.alias("host")).select("*", (start + F.expr("INTERVAL 7 DAYS")).alias("again"))
    one, two, after = (pid % 4 == k for k in (1, 2, 3))
    second = F.when(pid % 3 == 0, again).otherwise(start + F.expr("INTERVAL 4 DAYS"))
    at = [start, second, start + F.expr("INTERVAL 8 DAYS")]
    taken = [one | two, two, after]  # whether there is a first, a second, a late capture
    # the content that the page has when it is asked for again, or in some cases the first
    changed = two & (pid % 3 != 0) & (pid % 5 != 4)
    bodies = [F.concat("html", F.lit(f"<!-- {k} -->")) for k in range(3)]
    root = F.concat(F.lit("site "), F.col("host"), F.lit(" of day "), F.expr("pid div 1440").cast("string"))
    dated = timed.select(
        "*", F.lpad(pid.cast("string"), 12, "0").alias("number"), root.alias("root"),
        F.concat(F.lit("https://"), F.col("host"), F.lit("/")).alias("site"),
        *[(warc_date(t) if k == 0 else F.when(taken[k], warc_date(t))).alias(f"warc{k}") for k, t in enumerate(at)],
        *[(http_date(t) if k == 0 else F.when(taken[k], http_date(t))).alias(f"http{k}") for k, t in enumerate(at)],
        *[(tag(body) if k == 0 else F.when(taken[k], tag(body))).alias(f"tag{k}") for k, body in enumerate(bodies)],
        warc_date(again).alias("warc_again"), http_date(again).alias("http_again"),
    ).select("*", tag(F.col("root")).alias("tag_root"))

    def warc(kind: str, name: str, url: str, at: str) -> Column:
        return F.concat(
            F.lit("WARC/1.1\r\n"), line("WARC-Type", F.lit(kind)), line("WARC-Record-ID", F.concat(F.lit(name + "-"), F.col("number"))),
            line("WARC-Target-URI", F.col(url)), line("WARC-Date", F.col(at)), F.lit("\r\n"),
        )

    def full(name: str, url: str, k: int, body: Column, own: str) -> Column:
        return F.concat(
            warc("response", name, url, f"warc{k}"), F.lit("HTTP/1.1 200 OK\r\n"), line("Content-Type", F.lit("text/html")),
            line("Content-Length", F.octet_length(body).cast("string")), line("ETag", F.col(own), pid % 7 != 3),
            line("Last-Modified", F.col(f"http{k}"), pid % 11 != 5), line("Cache-Control", F.lit("max-age=60")), F.lit("\r\n"), body,
        )

    def revisit(name: str, url: str, sent: Column, with_tag: Column) -> Column:
        return F.concat(
            warc("revisit", name, url, "warc_again"), F.lit("HTTP/1.1 304 Not Modified\r\n"), line("ETag", sent, with_tag),
            line("Last-Modified", F.col("http0"), pid % 5 == 1), line("Cache-Control", F.concat(F.lit("max-age="), pid.cast("string"))),
            line("Content-Length", F.lit("0")), line("Date", F.col("http_again")), F.lit("\r\n"),
        )

    own = [full(f"page{k}", "url", k, body, f"tag{k}") for k, body in enumerate(bodies)]
    latest = F.when(changed, F.col("tag1")).otherwise(F.col("tag0"))
    sent = F.when(pid % 5 == 0, F.concat(F.lit('"stale-'), F.substring(latest, 2, 17))).otherwise(F.concat(F.lit("W/"), latest))
    records = F.array(
        *[F.when(made, record) for made, record in zip(taken, own)], revisit("page", "url", sent, (pid % 7 != 3) & (pid % 5 != 1)),
        full("site", "site", 0, F.col("root"), "tag_root"), revisit("site", "site", F.col("tag_root"), pid % 2 == 0),
    )
    # no lambda drops the missing ones: it would interpret all that makes the records
    return dated.select(F.explode(records).alias("record")).filter(F.col("record").isNotNull())


def op5_revisits(spark: SparkSession, d: str) -> DataFrame:
    """Per revisit of the crawl log made from the pages: its outcome, the response that it
    stands for and the merged headers, one "name: value" per line in order of names."""
    out = revisits.resolve(revisits.parse_records(page_log(table(spark, d, "pages"))))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return out.select("record_id", "url", "status", "response_id", F.array_join(lines, "\n").alias("headers"), "payload_sha1")


def op6_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    out = quality_rules.score(table(spark, d, "documents").select("doc_id", "text", "lang"))
    return out.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op7_decontamination(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    out = decontaminate.scan(docs, table(spark, d, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents"))


def op9_chat(spark: SparkSession, d: str) -> DataFrame:
    return chat.render_maximal(table(spark, d, "conversations"))


def op10_kneser_ney(spark: SparkSession, d: str) -> DataFrame:
    """Trusted text: documents labelled good and not toxic."""
    out = kneser_ney.judge(table(spark, d, "documents"), table(spark, d, "labels"), F.expr("quality = 1 AND toxic = 0"))
    return out.select("doc_id", "lang", "perplexity", "threshold", "kept")


def op11_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(table(spark, d, "documents").select("text", "lang"))


@F.arrow_udf(T.StringType())
def _looped(texts: pa.Array, h: pa.Array) -> pa.Array:
    """Texts whose number h ends in 0 with a loop from some word on; others as they are."""
    chosen = pc.fill_null(pc.equal(pc.subtract(h, pc.multiply(pc.divide(h, 10), 10)), 0), False)
    new = []
    for text, number in zip(texts.filter(chosen).to_pylist(), h.filter(chosen).to_pylist()):
        words = (text or "").encode().split()
        if words:
            g, n = number // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words[a:] = [words[a + i % p] for i in range(n - a)]
        new.append(b" ".join(words).decode())
    return pc.replace_with_mask(texts, chosen, pa.array(new, texts.type))


def op12_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    """Per document: its runs, the strongest of them, and digests of the runs and of the
    text without repeated turns. A tenth of the texts get a loop first."""
    docs = table(spark, d, "documents")
    looped = _looped(F.col("text"), F.crc32(F.col("doc_id").cast("string")))
    out = periodic_runs.periodic_runs(docs.select("doc_id", looped.alias("text")))
    best = periodic_runs.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = out.select("doc_id", "runs", "collapsed", best.alias("best"))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_lm_scores(spark: SparkSession, d: str) -> DataFrame:
    """Per document: log10 probabilities under exact unigrams and under the filter's model."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    docs = table(spark, d, "documents").select("doc_id", "text", held_out.alias("held_out"))
    return bloom_lm.score(docs, ~F.col("held_out"), keep_text=False)


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    import corpus_pipeline  # noqa: PLC0415 - beside the package, not in it

    return corpus_pipeline.run(spark, d)


def queries() -> dict[str, Query]:
    named = (
        op1_language_id, op2_html_text, op3_line_dedup, op4_byte_bpe, op5_revisits, op6_quality_rules, op7_decontamination,
        op8_simhash, op9_chat, op10_kneser_ney, op11_collocations, op12_periodic_runs, op13_lm_scores, pipeline,
    )
    return {f.__name__: f for f in named}
