"""Benchmark decontamination by word windows.

Texts are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
A benchmark item of 13 words or more gives every run of 13 consecutive words as a
window; a shorter one that has words is one window. The set of windows is broadcast
(in the closure of the scanning function) as word hashes and window hashes. Each
document is scanned once: only runs of words that all occur in the benchmark are
hashed, and every hit is verified byte by byte against the window.

The broadcast has a fixed bound: the benchmark is cut into blocks of at most
``BLOCK_CHARS`` characters by a hash of its rows. One block is the usual case; with
more, every block is read, scans the documents and stores its hits on its own, and the
hits are merged. Neither the driver nor a worker holds two blocks at once.

Edge cases: a null text (document or item) has no words and is never contaminated;
an item with a null id still marks words but is not counted; repeated items count
once per id; equal documents get equal rows; an empty benchmark or an empty table of
documents is fine; input columns named like a result are replaced by it.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm import textscan as ts
from orderlens.llm.common import as_text, quoted, ship_package, stored, with_results

WINDOW = 13
#: A document is contaminated if at least one word in ``MAX_SHARE`` is hit.
MAX_SHARE = 20
BLOCK_CHARS = 2_000_000

_HITS = T.ArrayType(T.StructType([T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())]))
_ARROW_HITS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
_SCAN_TYPE = T.StructType(
    [T.StructField("n_words", T.LongType()), T.StructField("hits", _HITS), T.StructField("items", T.ArrayType(T.StringType()))]
)


class Windows:
    """The windows of one benchmark block, ready for scanning."""

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW) -> None:
        owners: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        for item_id, text in items:
            words = _words(text)
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                owners[tuple(words[i : i + size])].update([item_id] if item_id is not None else [])
        self.owners = {b" ".join(k): tuple(sorted(v)) for k, v in owners.items()}
        vocabulary = sorted({w for k in owners for w in k})
        self.words = np.unique(_hash_list(vocabulary))
        self.filter = np.zeros(1 << 16, dtype=bool)
        self.filter[(self.words & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.by_size: dict[int, np.ndarray] = {}
        for size in sorted({len(k) for k in owners}):
            rows = [k for k in owners if len(k) == size]
            hashes = _hash_list([w for k in rows for w in k]).reshape(len(rows), size)
            self.by_size[size] = np.unique(_combine([hashes[:, i] for i in range(size)]))

    def scan(self, texts: pa.Array) -> pa.Array:
        n_words, hits, items = [], [], []
        for _, data, bounds in ts.slices(texts):
            lower = ts.lower_table()[data]
            starts, ends = ts.spans(lower, bounds, ts.ascii_word_table())
            first = np.searchsorted(starts, bounds[:-1])
            count = np.diff(np.append(first, len(starts)))
            found = self._found(lower, starts, ends, first, count)
            n_words.append(count)
            for row in range(len(bounds) - 1):
                at = found.get(row, ())
                hits.append(merged([(i - int(first[row]), i - int(first[row]) + size) for i, size, _ in at]))
                items.append(sorted({x for _, _, key in at for x in self.owners[key]}))
        pairs = pa.array([[{"s": s, "e": e} for s, e in h] for h in hits], _ARROW_HITS)
        counts = pa.array(np.concatenate(n_words) if n_words else [], pa.int64())
        return pa.StructArray.from_arrays([counts, pairs, pa.array(items, pa.list_(pa.string()))], ["n_words", "hits", "items"])

    def _found(self, lower, starts, ends, first, count) -> dict[int, list[tuple[int, int, bytes]]]:
        """Verified hits by row: (first word, size, window)."""
        out: dict[int, list] = defaultdict(list)
        if not len(starts) or not len(self.words):
            return out
        h = ts.word_hashes(lower, starts, ends)
        known = self.filter[(h & np.uint64(0xFFFF)).astype(np.int64)]
        at = np.flatnonzero(known)
        place = np.minimum(np.searchsorted(self.words, h[at]), len(self.words) - 1)
        known[at] = self.words[place] == h[at]
        row = np.repeat(np.arange(len(first)), count)
        unknown = np.concatenate([[0], np.cumsum(~known)])
        for size, windows in self.by_size.items():
            if len(h) < size:
                continue
            begin = np.flatnonzero((unknown[size:] == unknown[:-size]) & (row[size - 1 :] == row[: len(row) - size + 1]))
            if len(begin):
                sums = _combine([h[begin + k] for k in range(size)])
                place = np.minimum(np.searchsorted(windows, sums), len(windows) - 1)
                for i in begin[windows[place] == sums].tolist():
                    key = b" ".join(lower[s:e].tobytes() for s, e in zip(starts[i : i + size], ends[i : i + size]))
                    if key in self.owners:
                        out[int(row[i])].append((i, size, key))
        return out


def _words(text: str) -> list[bytes]:
    data, bounds = ts.utf8(pa.array([text or ""], pa.string()))
    lower = ts.lower_table()[data]
    return [lower[s:e].tobytes() for s, e in zip(*ts.spans(lower, bounds, ts.ascii_word_table()))]


def _hash_list(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    ends = np.cumsum([len(w) for w in words])
    return ts.word_hashes(np.frombuffer(b"".join(words), np.uint8), np.append(0, ends[:-1]), ends)


def _combine(columns: list[np.ndarray]) -> np.ndarray:
    with np.errstate(over="ignore"):
        total = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            total = total * np.uint64(0x100000001B3) + c
    return total


def merged(ranges) -> list[tuple[int, int]]:
    """Disjoint sorted ranges that cover the same numbers."""
    out: list[list[int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _scanner(windows: Windows):
    @F.arrow_udf(_SCAN_TYPE)
    def scan(texts: pa.Array) -> pa.Array:
        return windows.scan(texts)

    return scan


@F.arrow_udf(_HITS)
def _merge_hits(hits: pa.Array) -> pa.Array:
    rows = [[{"s": s, "e": e} for s, e in merged((x["s"], x["e"]) for x in row or [])] for row in hits.to_pylist()]
    return pa.array(rows, _ARROW_HITS)


@F.arrow_udf(T.StringType())
def _without_hits(texts: pa.Array, hits: pa.Array) -> pa.Array:
    """The texts without the bytes from the first to the last word of each hit range."""
    out = []
    for text, ranges in zip(texts.to_pylist(), hits.to_pylist()):
        if text and ranges:
            data, bounds = ts.utf8(pa.array([text], pa.string()))
            starts, ends = ts.spans(ts.lower_table()[data], bounds, ts.ascii_word_table())
            keep, last = [], 0
            for r in ranges:
                keep.append(data[last : starts[r["s"]]].tobytes())
                last = ends[r["e"] - 1]
            text = b"".join([*keep, data[last:].tobytes()]).decode()
        out.append(text)
    return pa.array(out, pa.string())


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> list[DataFrame]:
    """The benchmark's different rows (id, text) in blocks of bounded size."""
    rows = benchmark.select(quoted(id_col).cast("string").alias("id"), as_text(quoted(text_col)).alias("text")).distinct()
    total = rows.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    n = -(-total // block_chars) or 1
    return [rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b) for b in range(n)]


def _windows(block: DataFrame) -> Windows:
    return Windows([(r["id"], r["text"]) for r in block.collect()])


def scan(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (disjoint ranges of hit words), ``items``
    (sorted ids of items with a window in the text), ``n_hit``, ``n_items``,
    ``items_sha256`` and ``contaminated``."""
    ship_package(docs.sparkSession)
    parts = blocks(benchmark, item_col, item_text, block_chars)
    text = quoted(text_col).cast("string")
    if len(parts) == 1:
        found = docs.select("*", _scanner(_windows(parts[0]))(text).alias("__scan"))
    else:
        # documents are matched again by their text's hashes: equal texts have equal hits
        keys = [F.xxhash64(text).alias("__a"), F.sha1(as_text(text)).alias("__b")]
        every = None
        for part in parts:
            scanned = docs.select(*keys, _scanner(_windows(part))(text).alias("__scan"))
            hits = stored(scanned.filter(F.size("__scan.hits") > 0).distinct())
            every = hits if every is None else every.unionByName(hits)
        some = every.groupBy("__a", "__b").agg(
            F.flatten(F.collect_list("__scan.hits")).alias("__hits"), F.flatten(F.collect_list("__scan.items")).alias("__items")
        ).select("__a", "__b", _merge_hits("__hits").alias("__hits"), F.array_sort(F.array_distinct("__items")).alias("__items"))
        base = docs.select("*", *keys, _scanner(Windows([]))(text)["n_words"].alias("__n"))
        none = F.from_json(F.lit("[]"), "array<struct<s:int,e:int>>")
        found = base.join(some, ["__a", "__b"], "left").select(
            *[quoted(c) for c in docs.columns],
            F.struct(F.col("__n").alias("n_words"), F.coalesce("__hits", none).alias("hits"),
                     F.coalesce("__items", F.array().cast("array<string>")).alias("items")).alias("__scan"),
        )
    return with_results(found, _results(F.col("__scan"))).drop("__scan")


def _results(s: Column) -> dict[str, Column]:
    n_hit = F.aggregate(s["hits"], F.lit(0).cast("long"), lambda t, x: t + x["e"] - x["s"])
    return {
        "n_words": s["n_words"],
        "n_hit": n_hit,
        "n_items": F.size(s["items"]).cast("long"),
        "items_sha256": F.sha2(F.concat_ws(",", s["items"]), 256),
        "contaminated": (n_hit > 0) & (MAX_SHARE * n_hit >= s["n_words"]),
        "hits": s["hits"],
        "items": s["items"],
    }


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", text_col: str = "text") -> DataFrame:
    """``docs`` without contaminated rows (``mode="documents"``), or with the hit
    passages of contaminated rows cut out of the text (``mode="spans"``)."""
    if mode not in ("documents", "spans"):
        raise ValueError(f"mode is documents or spans, not {mode}")
    whole = docs.select("*", F.struct("*").alias("__doc"))
    found = scan(whole, benchmark, text_col)
    if mode == "documents":
        return found.filter(~F.col("contaminated")).select("__doc.*")
    text = F.col("__doc").getField(text_col)
    cut = F.when(F.col("contaminated"), _without_hits(text, F.col("hits"))).otherwise(text)
    return found.select(*[(cut if c == text_col else F.col("__doc").getField(c)).alias(c) for c in docs.columns])
