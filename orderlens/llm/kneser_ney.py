"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

Tokens are the bytes of the text, n-grams are of ``ORDER`` bytes (a number of 8 * ORDER
bits, exact), texts start with bytes that no text holds. The model is trained on all
trusted texts, nothing is sampled:

1. ``train``: tasks count their n-grams, Spark sums them; the lower orders' continuation
   counts and the contexts' totals are aggregations of that table. Discounts come from
   the numbers of n-grams seen once to four times.
2. ``log_probabilities``: the n-grams of all documents, each once, are joined with the
   count tables order by order (keys hash-sharded by Spark) and get their interpolated
   probability.
3. ``perplexities``: that table is cut into shards of about ``SHARD_ROWS`` rows, which are
   broadcast one by one; a worker looks the n-grams of a block of texts up in shard after
   shard and holds one at a time. Texts are read once. A document's log perplexity is the
   mean over its bytes. (Joining each document's n-grams with the table instead would
   shuffle some 400 n-grams a kilobyte of text, many times the input.)
4. ``judge``: documents are kept up to a quantile of the trusted documents' perplexities
   in the same language (languages with fewer than ``MIN_TRUSTED`` trusted documents use
   that of all). Quantiles are taken from a histogram in steps of ``STEP``.

Edge cases: null and empty texts have no n-grams, their perplexity is null and they are
not kept; without trusted text every perplexity is uniform (256) and thresholds are null,
which keep everything that has text; null languages are one group; ids are only passed
through and compared with the labels (a null id is never trusted); repeated rows get
equal results; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions.membership import may_be_in
from orderlens.llm import textscan as ts
from orderlens.llm.common import as_text, quoted, ship_package, stored

ORDER = 5
QUANTILE = 0.995
#: Allowance above the quantile in nats per byte, and how much more a text of one byte
#: gets (it falls with the root of the length, as the spread of a mean does).
SLACK = 0.10
SHORT_SLACK = 2.0
MIN_TRUSTED = 50
STEP = 0.001
SHARD_ROWS = 1_000_000
#: Bytes of text that are looked up together.
BLOCK_BYTES = 4 << 20
#: Bits of the bitmap of trusted ids (8 MB).
ID_BITS = 26
#: n-grams that a training task holds before it passes them on.
HELD = 4_000_000

_START = 0xFF


def _ngrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of a slice, and the byte's row."""
    size = np.diff(bounds)
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(data)) - np.repeat(bounds[:-1], size)
    code = data.astype(np.int64)
    for back in range(1, ORDER):
        before = np.full(len(data), _START, dtype=np.int64)
        inside = at >= back
        before[inside] = data[np.flatnonzero(inside) - back]
        code |= before << (8 * back)
    return code, row


def _merge(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    every, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(every)
    every = every[order]
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
    return every[first], (np.add.reduceat(n[order], first) if len(first) else n[:0])


_COUNT = T.StructType([T.StructField("gram", T.LongType()), T.StructField("c", T.LongType())])


def ngram_counts(texts: DataFrame) -> DataFrame:
    """(gram, c) of the column ``text``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, held = [], [], 0
        for batch in batches:
            for _, data, bounds in ts.slices(batch.column(0)):
                found = np.sort(_ngrams(data, bounds)[0])
                first = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.zeros(0, np.int64)
                codes.append(found[first])
                counts.append(np.diff(np.append(first, len(found))))
                held += len(first)
                if held > HELD:
                    merged = _merge(codes, counts)
                    codes, counts, held = [merged[0]], [merged[1]], len(merged[0])
                    if held > HELD // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged], names=_COUNT.names)
                        codes, counts, held = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _merge(codes, counts)], names=_COUNT.names)

    return texts.select("text").mapInArrow(count, _COUNT).groupBy("gram").agg(F.sum("c").alias("c"))


class Model:
    """Count tables by order: n-grams (gram, c) and contexts (context, total, n1, n2, n3),
    and the discounts of each order."""

    def __init__(self, grams: dict[int, DataFrame], contexts: dict[int, DataFrame], discounts: dict[int, tuple[float, float, float]]) -> None:
        self.grams, self.contexts, self.discounts = grams, contexts, discounts


def discounts_of(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more, from the numbers of
    n-grams seen once to four times (halves where there are too few to tell)."""
    if min(n) <= 0:
        return 0.5, 0.5, 0.5
    y = n[0] / (n[0] + 2 * n[1])
    found = [k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3)]
    return tuple(min(max(d, 0.0), k + 1.0) for k, d in enumerate(found))


def train(trusted: DataFrame) -> Model:
    """The model of the column ``text``."""
    grams = {ORDER: stored(ngram_counts(trusted))}
    for k in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1))
        grams[k] = stored(grams[k + 1].groupBy(shorter.alias("gram")).agg(F.count("*").alias("c")))
    contexts, discounts = {}, {}
    for k, table in grams.items():
        contexts[k] = stored(
            table.groupBy(F.shiftright("gram", 8).alias("context")).agg(
                F.sum("c").alias("total"), F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2"),
                F.count_if(F.col("c") > 2).alias("n3"),
            )
        )
        seen = table.agg(*[F.count_if(F.col("c") == i) for i in (1, 2, 3, 4)]).first()
        discounts[k] = discounts_of(list(seen))
    return Model(grams, contexts, discounts)


def log_probabilities(grams: DataFrame, model: Model) -> DataFrame:
    """(gram, logp) of the n-grams of ``grams``: natural logarithms."""
    rows = grams.select("gram").withColumn("p", F.lit(1 / 256))
    for k in range(1, ORDER + 1):
        d1, d2, d3 = (F.lit(d) for d in model.discounts[k])
        rows = rows.withColumn("g", F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1))).withColumn("h", F.shiftright("g", 8))
        seen = model.grams[k].select(F.col("gram").alias("g"), "c")
        about = model.contexts[k].select(F.col("context").alias("h"), "total", "n1", "n2", "n3")
        rows = rows.join(seen, "g", "left").join(about, "h", "left")
        count = F.coalesce("c", F.lit(0))
        discount = F.when(count == 0, F.lit(0.0)).when(count == 1, d1).when(count == 2, d2).otherwise(d3)
        rest = (d1 * F.col("n1") + d2 * F.col("n2") + d3 * F.col("n3")) / F.col("total")
        mixed = (count - discount) / F.col("total") + rest * F.col("p")
        rows = rows.select("gram", F.when(F.col("total").isNull(), F.col("p")).otherwise(mixed).alias("p"))
    return rows.select("gram", F.log("p").alias("logp"))


def _shards(logs: DataFrame) -> list[Broadcast]:
    """The table of log-probabilities in broadcast parts (sorted n-grams, values) of about
    ``SHARD_ROWS`` rows, by the n-gram modulo their number (an odd one); read and broadcast
    one after another."""
    spark = logs.sparkSession
    rows = logs.count()
    shards = 1 if rows <= SHARD_ROWS else -(-rows // SHARD_ROWS) | 1
    parts = []
    for s in range(shards):
        part = logs.filter(F.pmod("gram", F.lit(shards)) == s).toArrow()
        order = np.argsort(part["gram"].to_numpy())
        parts.append(spark.sparkContext.broadcast((part["gram"].to_numpy()[order], part["logp"].to_numpy()[order])))
    return parts


def _looked_up(grams: np.ndarray, shards: list[Broadcast]) -> np.ndarray:
    """Values of n-grams, 0 for those not in the table. One shard is in memory at a time."""
    out = np.zeros(len(grams))
    of = grams % len(shards)
    for s, shard in enumerate(shards):
        codes, values = shard.value
        mine = np.flatnonzero(of == s) if len(shards) > 1 else np.arange(len(grams))
        if len(codes) and len(mine):
            place = np.minimum(np.searchsorted(codes, grams[mine]), len(codes) - 1)
            out[mine] = np.where(codes[place] == grams[mine], values[place], 0.0)
        if len(shards) > 1:
            del codes, values
            vars(shard).pop("_value", None)  # read again from the worker's file for the next block
    return out


def perplexities(texts: DataFrame, logs: DataFrame) -> DataFrame:
    """``texts`` with ``nats``: minus the mean log-probability of the bytes of ``text``,
    null where there are none. Texts are read once, whatever the number of shards."""
    shards = _shards(logs)

    @F.arrow_udf(T.DoubleType())
    def total(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts))
        for start, data, bounds in ts.slices(texts, BLOCK_BYTES):
            grams, row = _ngrams(data, bounds)
            if not len(grams):
                continue
            different, which = np.unique(grams, return_inverse=True)
            found = _looked_up(different, shards)
            out[start : start + len(bounds) - 1] = np.bincount(row, weights=found[which], minlength=len(bounds) - 1)
        return pa.array(out)

    size = F.octet_length("text")
    scored = texts.withColumn("__sum", total(F.col("text")))
    return scored.withColumn("nats", F.when(size > 0, -F.col("__sum") / size)).drop("__sum")


def thresholds(scored: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(lang, limit): nats at the quantile of the trusted documents of a language."""
    bars = scored.filter("trusted AND nats IS NOT NULL").groupBy("lang", F.ceil(F.col("nats") / STEP).alias("bar")).agg(F.count("*").alias("n"))

    def at_quantile(bars: DataFrame, keys: list[str]) -> DataFrame:
        whole = Window.partitionBy(*keys)
        running = whole.orderBy("bar").rowsBetween(Window.unboundedPreceding, 0)
        rows = bars.select(*keys, "bar", F.sum("n").over(running).alias("upto"), F.sum("n").over(whole).alias("all"))
        rows = rows.filter(F.col("upto") >= F.col("all") * quantile)
        return rows.groupBy(*keys).agg((F.min("bar") * STEP).alias("limit"), F.first("all").alias("all"))

    return at_quantile(bars, ["lang"]).filter(F.col("all") >= MIN_TRUSTED).select("lang", "limit")


def _everywhere(scored: DataFrame, quantile: float) -> float | None:
    """The same quantile over all languages."""
    bars = scored.filter("trusted AND nats IS NOT NULL").groupBy(F.ceil(F.col("nats") / STEP).alias("bar")).agg(F.count("*").alias("n"))
    running = Window.orderBy("bar").rowsBetween(Window.unboundedPreceding, 0)
    # one row per step of the histogram: a few thousand, whatever the input
    rows = bars.select("bar", F.sum("n").over(running).alias("upto"), F.sum("n").over(Window.partitionBy()).alias("all"))
    found = rows.filter(F.col("upto") >= F.col("all") * quantile).agg(F.min("bar")).first()[0]
    return None if found is None else found * STEP


def judge(
    docs: DataFrame, labels: DataFrame, trusted: Column, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", label_id: str = "doc_id", quantile: float = QUANTILE,
) -> DataFrame:
    """(id_col, lang, perplexity, threshold, kept) per row of ``docs``. ``trusted`` is a
    condition on ``labels``; texts of those ids train the model."""
    ship_package(docs.sparkSession)
    good = labels.filter(trusted).select(quoted(label_id).alias("id")).filter("id IS NOT NULL").distinct()
    rows = docs.select(quoted(id_col).alias("id"), quoted(lang_col).cast("string").alias("lang"), as_text(quoted(text_col)).alias("text"))
    # labels grow with the documents: they are not broadcast at any size; a bitmap of them keeps most other texts out of the shuffle
    some = may_be_in(rows, F.xxhash64(F.col("id").cast("string")), good.select(F.xxhash64(F.col("id").cast("string")).alias("h")), "h", ID_BITS)
    model = train(some.join(good.hint("merge"), "id", "left_semi"))
    logs = stored(log_probabilities(ngram_counts(rows).select("gram"), model))
    scored = perplexities(rows.withColumn("size", F.octet_length("text")), logs).select("id", "lang", "size", "nats")
    marked = scored.join(good.withColumn("t", F.lit(True)), "id", "left")
    scored = stored(marked.select("id", "lang", "size", "nats", F.coalesce("t", F.lit(False)).alias("trusted")))
    limits = thresholds(scored, quantile).select(F.col("lang").alias("of"), "limit")
    joined = scored.join(F.broadcast(limits) if limits.count() <= 1000 else limits, F.col("lang").eqNullSafe(F.col("of")), "left")
    limit = F.coalesce("limit", F.lit(_everywhere(scored, quantile)).cast("double"))
    limit = limit + SLACK + SHORT_SLACK / F.sqrt(F.greatest("size", F.lit(1)))
    return joined.select(
        F.col("id").alias(id_col), "lang", F.exp("nats").alias("perplexity"), F.exp(limit).alias("threshold"),
        (F.col("nats").isNotNull() & F.coalesce(F.col("nats") <= limit, F.lit(True))).alias("kept"), "trusted",
    )
