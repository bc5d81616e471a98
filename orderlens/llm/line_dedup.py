"""Line dedup by an exact set-similarity join on the words of lines.

A line is a \\n-split part of a text; its tokens are the different words
(``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased). A line is removed if an earlier line of the
corpus has a Jaccard similarity of ``THRESHOLD`` or more with it. "Earlier" goes by
document id (null last), line number and, for rows that share both, a hash. Lines
without a word never match; they go only if no line with a word is left.

Steps, each a Spark job over the whole table:

1. ``token_counts``: words counted in ``SKETCH`` hash buckets. The buckets' counts give
   one global order of tokens, rare ones first. The table of counts is broadcast; its
   size is fixed.
2. ``distinct_lines``: lines with the same words collapse into the earliest one, by a
   128-bit hash. What remains carries its prefix: the rarest tokens, as many as any
   partner must share one of.
3. ``candidates``: prefix entries meet by token; they travel in blocks, by a hash of it. Length, positional and bitmap filters
   (128 bits of token parity bound the symmetric difference) drop pairs that cannot
   reach the threshold. A line needs one earlier partner only, so each entry gives at
   most ``PARTNERS`` candidates and says if there may be more. Tokens with many entries
   are cut into chunks, every pair of chunks is a group.
4. ``verified``: the tokens of candidate lines are read again from the texts (Bloom
   filters of fixed size select texts and lines) and the Jaccard similarity is computed, first
   with each line's closest candidate, then with the others of lines still open. Lines
   with cut candidate lists and no verified partner meet all their candidates.
5. ``removed_lines`` gives the decisions, ``dedup_lines`` rebuilds the texts.

Words are compared by 64-bit hashes (polynomial ones up to 64 bytes, XXH64 beyond). Edge
cases: null texts stay null and empty ones empty; ids may be of any type that sorts (they
are compared as they sort), null or repeated; rows with the same id and the same text are one
document (both keep the same lines), but rows without an id are documents of their own,
numbered in a stored table (of copies among them, one keeps its lines); very long lines
and texts are one row each; an empty table gives an empty table; extra columns stay, those
named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions.membership import may_be_in
from orderlens.llm import textscan as ts
from orderlens.llm.common import as_text, packed, partitions_for, ship_package, stored

#: Jaccard similarity as a fraction.
THRESHOLD = (4, 5)
SKETCH_BITS = 16
PARTNERS = 8
GROUP_LIMIT = 20_000
BLOOM_BITS = 26
#: Entries that a task holds until it deals them out, and the most in a block.
HELD = 400_000
BLOCK = 256
#: Entries that candidates are looked for in at once (whole buckets).
AT_ONCE = 200_000

_MASK = np.int32((1 << SKETCH_BITS) - 1)
_NONE = np.iinfo(np.int64).max


def _need(n):
    """Smallest size of a set that can reach the threshold with a set of size n."""
    num, den = THRESHOLD
    return -(-num * n // den)


def _overlap(total):
    """Common tokens that two sets of together ``total`` tokens must have."""
    num, den = THRESHOLD
    return -(-num * total // (num + den))


def _lines(data: np.ndarray, bounds: np.ndarray):
    """Word hashes of a slice, the first word of each line with words, the line's row
    and its number in the row."""
    lower = ts.lower_table()[data]
    starts, ends = ts.spans(lower, bounds, ts.spaces_table())
    hashes = ts.word_hashes(lower, starts, ends)
    row = ts.rows_of(starts, bounds)
    breaks = np.flatnonzero(data == 10)
    before = np.repeat(np.arange(len(breaks) + 1), np.diff(np.concatenate([[0], np.searchsorted(starts, breaks), [len(starts)]])))
    number = before - np.searchsorted(breaks, bounds[:-1])[row]
    change = np.ones(len(starts), dtype=bool)
    if len(starts):
        change[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1])
    first = np.flatnonzero(change)
    return hashes, first, row[first], number[first]


def _line_keys(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64 bits that lines with the same words (in any order) share."""
    if not len(first):
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        return np.add.reduceat(hashes, first).view(np.int64)


def _distinct_tokens(hashes: np.ndarray, line: np.ndarray, rarity: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different tokens of each line, by rarity (0 to 127) and hash. One sort of numbers
    that hold line, rarity and the hash's upper bits; should two hashes of a line agree in
    those, or lines be too many, a sort by all columns."""
    if rarity is None:
        rarity = np.zeros(len(hashes), dtype=np.uint64)
    packed = (line.astype(np.uint64) << np.uint64(47)) | (rarity << np.uint64(40)) | (hashes >> np.uint64(24))
    order = np.argsort(packed)
    h, g, p = hashes[order], line[order], packed[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    if (len(g) and line[-1] >= 1 << 17) or (new[1:] & (p[1:] == p[:-1])).any():
        order = np.lexsort((hashes, rarity, line))
        h, g = hashes[order], line[order]
        new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    return h[new], g[new]


_COUNTS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])


def _summed(counts: DataFrame) -> np.ndarray:
    """The table of bucket counts: 2**SKETCH_BITS numbers, whatever the input."""
    out = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    found = counts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def _count_batch(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])


def token_counts(texts: DataFrame) -> np.ndarray:
    """Words of column ``text`` by hash bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            for _, data, bounds in ts.slices(batch.column(0)):
                hashes, *_ = _lines(data, bounds)
                total += np.bincount((hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total))
        yield _count_batch(total)

    return _summed(texts.select("text").mapInArrow(count, _COUNTS))


_LINE = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("id", "h")]
    + [T.StructField("line", T.IntegerType()), T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
       T.StructField("n", T.IntegerType()), T.StructField("b1", T.LongType()), T.StructField("b2", T.LongType()),
       T.StructField("prefix", T.ArrayType(T.IntegerType()))]
)


def distinct_lines(texts: DataFrame, counts: np.ndarray) -> DataFrame:
    """The earliest line of every set of words: id, h, line, k1, k2, n, b1, b2, prefix."""
    # three steps for each doubling of a count: a fixed order of the buckets
    levels = np.minimum(np.log2(counts + 1.0) * 3, 127).astype(np.uint64)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hs = batch.column(0), batch.column(1)
            for start, data, bounds in ts.slices(batch.column(2)):
                hashes, first, row, number = _lines(data, bounds)
                if not len(first):
                    continue
                k1 = _line_keys(hashes, first)
                k2 = _line_keys(ts.mix(hashes ^ np.uint64(0xD6E8FEB86659FD93)), first)
                line = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(hashes))))
                rarity = levels[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                tokens, line = _distinct_tokens(hashes, line, rarity)
                n = np.bincount(line, minlength=len(first))
                begin = np.cumsum(n) - n
                one, upper = np.uint64(1) << (tokens & np.uint64(63)), (tokens & np.uint64(64)) != 0
                b1, b2 = (np.bitwise_xor.reduceat(np.where(upper == u, one, np.uint64(0)), begin).view(np.int64) for u in (False, True))
                size = n - _need(n) + 1
                inside = np.arange(len(tokens)) - np.repeat(begin, n) < np.repeat(size, n)
                keys = (tokens[inside] >> np.uint64(16)).astype(np.uint32).view(np.int32)
                prefix = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(keys))
                at = pa.array(row + start)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), hs.take(at), pa.array(number.astype(np.int32)), pa.array(k1), pa.array(k2),
                     pa.array(n.astype(np.int32)), pa.array(b1), pa.array(b2), prefix],
                    names=_LINE.names,
                )

    every = texts.select("id", "h", "text").mapInArrow(lines, _LINE)
    order = F.struct(F.coalesce("id", F.lit(_NONE)), F.col("id").isNull(), "line", "h", "id")
    place = F.min(order).alias("o")
    same = every.groupBy("k1", "k2").agg(place, *[F.first(c).alias(c) for c in ("n", "b1", "b2", "prefix")])
    return same.select(F.col("o.id").alias("id"), F.col("o.h").alias("h"), F.col("o.line").alias("line"), "k1", "k2", "n", "b1", "b2", "prefix")


_ENTRY = T.StructType(
    [T.StructField("key", T.LongType()), T.StructField("k1", T.LongType()), T.StructField("oid", T.LongType()),
     T.StructField("line", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("pos", T.IntegerType()),
     T.StructField("b1", T.LongType()), T.StructField("b2", T.LongType())]
)


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of a list column, the row of each and its place in the row."""
    col = batch.column(batch.schema.get_field_index(name))
    sizes = np.diff(col.offsets.to_numpy())
    row = np.repeat(np.arange(len(col)), sizes)
    return col.flatten().to_numpy(), row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def token_chunks(lines: DataFrame) -> np.ndarray:
    """Number of chunks of the entries of every token bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            keys, _, _ = _flat(batch, "prefix")
            total += np.bincount(keys & _MASK, minlength=len(total))
        yield _count_batch(total)

    in_bucket = _summed(lines.select("prefix").mapInArrow(count, _COUNTS))
    # a bucket far above the average holds a hot token; its chunks have about half of
    # the limit
    limit = int(max(GROUP_LIMIT, 8 * in_bucket.mean()))
    return np.where(in_bucket > limit, -(-in_bucket * 2 // limit), 1).astype(np.int32)


def _entries(batch: pa.RecordBatch, chunks: np.ndarray, tokens: np.ndarray | None = None) -> list[np.ndarray]:
    """The columns of ``_ENTRY``: a row per line and prefix token; more for tokens with many
    lines, which go to every pair of chunks that holds theirs."""
    keys, row, pos = _flat(batch, "prefix")
    if tokens is not None:
        wanted = _in_bloom(tokens, keys.view(np.uint32))
        keys, row, pos = keys[wanted], row[wanted], pos[wanted]
    cols = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names) if n != "prefix"}
    c = chunks[keys & _MASK]
    at = np.repeat(np.arange(len(keys)), c)
    other = np.arange(len(at)) - np.repeat(np.cumsum(c) - c, c)
    mine = (ts.mix(cols["k1"].view(np.uint64))[row] % c.astype(np.uint64)).astype(np.int64)[at]
    pair = np.minimum(mine, other) * c[at] + np.maximum(mine, other)
    key = (keys[at].astype(np.int64) << 32) + pair
    rows = row[at]
    return [key, cols["k1"][rows], cols["oid"][rows], cols["line"][rows], cols["n"][rows], pos[at].astype(np.int32), cols["b1"][rows], cols["b2"][rows]]


def _with_prefix(lines: DataFrame) -> DataFrame:
    return lines.select("k1", F.coalesce("id", F.lit(_NONE)).alias("oid"), "line", "n", "b1", "b2", "prefix")


def prefix_entries(lines: DataFrame, chunks: np.ndarray, tokens: np.ndarray | None = None) -> DataFrame:
    """The entries of lines. ``tokens``: a bit table (``_bloom``) that selects tokens, and
    perhaps some others."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _entries(batch, chunks, tokens)], names=_ENTRY.names)

    return _with_prefix(lines).mapInArrow(entries, _ENTRY)


_BLOCK = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("entries", T.BinaryType())])
#: An entry in a block.
_PACKED = np.dtype([(f.name, "<i8" if isinstance(f.dataType, T.LongType) else "<i4") for f in _ENTRY.fields])


def entry_blocks(lines: DataFrame, chunks: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, entries): the entries of lines in blocks of at most ``BLOCK``, by a hash of
    their key. An entry of its own would cost Spark a row in the exchange, the sort and
    the way to Python."""

    def blocks(cols: list[np.ndarray]) -> pa.RecordBatch:
        bucket = (ts.mix(cols[0].view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket)
        bucket = bucket[order]
        entries = np.empty(len(order), _PACKED)
        for name, col in zip(_PACKED.names, cols):
            entries[name] = col[order]
        begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        place = np.arange(len(bucket)) - np.repeat(begin, np.diff(np.append(begin, len(bucket))))
        first = np.flatnonzero(place % BLOCK == 0)
        offsets = pa.py_buffer(np.append(first, len(bucket)).astype(np.int64) * _PACKED.itemsize)
        cells = pa.Array.from_buffers(pa.large_binary(), len(first), [None, offsets, pa.py_buffer(entries)])
        return pa.RecordBatch.from_arrays([pa.array(bucket[first]), cells.cast(pa.binary())], names=_BLOCK.names)

    def packed_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            cols = _entries(batch, chunks)
            # a batch with very frequent tokens has many entries
            for at in range(0, len(cols[0]), HELD):
                held.append([c[at : at + HELD] for c in cols])
                size += len(held[-1][0])
                if size >= HELD:
                    yield blocks([np.concatenate(c) for c in zip(*held)])
                    held, size = [], 0
        if size:
            yield blocks([np.concatenate(c) for c in zip(*held)])
        ts.release_memory()

    return _with_prefix(lines).mapInArrow(packed_entries, _BLOCK)


_PAIR = T.StructType(
    [T.StructField("y", T.LongType()), T.StructField("x", T.LongType()), T.StructField("far", T.IntegerType()), T.StructField("more", T.BooleanType())]
)


def _partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (later y, earlier x) within the groups of entries with one key, from
    blocks sorted by bucket."""

    def pairs(entries: np.ndarray) -> Iterator[pa.RecordBatch]:
        key = entries["key"]
        order = np.argsort(key)
        key = key[order]
        same = np.append(key[1:] == key[:-1], False)
        shared = same | np.append(False, same[:-1])  # an entry of its own has no partner
        order, key = order[shared], key[shared]
        if not len(key):
            return
        group = np.cumsum(np.append(False, key[1:] != key[:-1]))
        # by length within a group: partners of i stand right after it
        by_length = np.argsort((group << 32) + entries["n"][order])
        order, group = order[by_length], group[by_length].astype(np.int32)
        k1, oid, line, n, pos, b1, b2 = (entries[c][order] for c in ("k1", "oid", "line", "n", "pos", "b1", "b2"))
        rest, b1, b2 = n - pos, b1.view(np.uint64), b2.view(np.uint64)
        longest = n * THRESHOLD[1] // THRESHOLD[0]
        found = np.zeros(len(n), dtype=np.int32)
        # the shorter line of a pair has its first common token within a shorter prefix
        active, step = np.flatnonzero(rest >= _overlap(2 * n)), 1
        while True:
            active = active[active < len(n) - step]
            active = active[(group[active + step] == group[active]) & (n[active + step] <= longest[active])]
            if not len(active):
                return
            i, j = active, active + step
            step += 1
            total = n[i] + n[j]
            need = _overlap(total)
            at = np.flatnonzero(np.minimum(rest[i], rest[j]) >= need)
            i, j, slack = i[at], j[at], (total - 2 * need)[at]
            far = np.bitwise_count(b1[i] ^ b1[j]).astype(np.int64) + np.bitwise_count(b2[i] ^ b2[j])
            at = np.flatnonzero((far <= slack) & (k1[i] != k1[j]))
            if not len(at):
                continue
            i, j, far = i[at], j[at], far[at]
            later = (oid[i] > oid[j]) | ((oid[i] == oid[j]) & ((line[i] > line[j]) | ((line[i] == line[j]) & (k1[i] > k1[j]))))
            y, x = np.where(later, i, j), np.where(later, j, i)
            open_ = found[y] < PARTNERS
            y, x, far = y[open_], x[open_], far[open_]
            np.add.at(found, y, 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[y]), pa.array(k1[x]), pa.array(far.astype(np.int32)), pa.array(found[y] >= PARTNERS)], names=_PAIR.names
            )

    held: list[np.ndarray] = []
    size, last = 0, None
    for batch in batches:
        for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1)):
            if bucket != last and size >= AT_ONCE:
                yield from pairs(np.concatenate(held))
                held, size = [], 0
            last = bucket
            held.append(np.frombuffer(block.as_buffer(), _PACKED))
            size += len(held[-1])
    if held:
        yield from pairs(np.concatenate(held))
    ts.release_memory()


def candidates(lines: DataFrame, chunks: np.ndarray) -> DataFrame:
    """(y, x, far, more): candidate partners x of lines y, a bound of their distance, and
    whether y's list may have been cut."""
    parts = partitions_for(lines.sparkSession, lines.count() * 10, 4_000_000)
    # buckets of some 100,000 entries, many a task
    placed = entry_blocks(lines, chunks, parts * 32).repartition(parts, "bucket").sortWithinPartitions("bucket")
    return placed.mapInArrow(_partners, _PAIR).groupBy("y", "x").agg(F.min("far").alias("far"), F.max("more").alias("more"))


def all_candidates(lines: DataFrame, chunks: np.ndarray, only: DataFrame) -> DataFrame:
    """Every candidate pair whose later line is in ``only`` (column y). The other side
    are the entries of those lines' tokens."""
    these = stored(lines.join(only.select(F.col("y").alias("k1")), "k1", "left_semi").select(*lines.columns))
    tokens = _bloom(these.select(F.explode("prefix").alias("t")).select(F.col("t").bitwiseAND(F.lit(0xFFFFFFFF)).alias("k1")).distinct())
    y = prefix_entries(these, chunks)
    x = prefix_entries(lines, chunks, tokens)
    y = y.select("key", *[F.col(c).alias("y_" + c) for c in _ENTRY.names[1:]])
    x = x.select("key", *[F.col(c).alias("x_" + c) for c in _ENTRY.names[1:]])
    num, den = THRESHOLD
    need = F.expr(f"ceil({num} * (x_n + y_n) / {num + den})")
    far = F.expr("bit_count(x_b1 ^ y_b1) + bit_count(x_b2 ^ y_b2)")
    return (
        y.join(x, "key")
        .filter(F.expr("struct(x_oid, x_line, x_k1) < struct(y_oid, y_line, y_k1)"))
        .filter(F.expr(f"{den} * least(x_n, y_n) >= {num} * greatest(x_n, y_n)"))
        .filter(F.least(F.expr("x_n - x_pos"), F.expr("y_n - y_pos")) >= need)
        .filter(far <= F.expr("x_n + y_n") - 2 * need)
        .groupBy(F.col("y_k1").alias("y"), F.col("x_k1").alias("x"))
        .agg(F.min(far).alias("far"))
    )


def _bloom(keys: DataFrame) -> np.ndarray:
    """Bit table of the long column ``k1``, of 2**BLOOM_BITS bits."""
    size, per = 1 << BLOOM_BITS, 32768
    place = F.pmod("k1", F.lit(size))
    rows = keys.groupBy(F.floor(place / per).alias("b")).agg(F.bitmap_construct_agg((place % per)).alias("m")).toArrow()
    out = np.zeros(size // 8, dtype=np.uint8)
    for b, m in zip(rows["b"].to_pylist(), rows["m"].to_pylist()):
        out[b * per // 8 : (b + 1) * per // 8] = np.frombuffer(m, dtype=np.uint8)
    return out


def _in_bloom(bloom: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = (keys & keys.dtype.type((1 << BLOOM_BITS) - 1)).astype(np.int64)
    return (bloom[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


_TOKENS = T.StructType([T.StructField("k1", T.LongType()), T.StructField("tokens", T.ArrayType(T.LongType()))])


def line_tokens(texts: DataFrame, lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """(k1, tokens) of the wanted lines (column k1) and perhaps others, each once. Texts
    without the earliest place of a wanted line are passed over."""
    bloom = _bloom(wanted)
    places = wanted.join(lines.select("k1", "h"), "k1").select(F.col("h").alias("place")).distinct()
    # the others are passed over before they go to a Python worker
    chosen = may_be_in(texts.select("h", "text"), F.col("h"), places, "place", BLOOM_BITS)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, bounds in ts.slices(batch.column(0)):
                hashes, first, _, _ = _lines(data, bounds)
                k1 = _line_keys(hashes, first)
                hit = _in_bloom(bloom, k1.view(np.uint64))
                hit[np.setdiff1d(np.arange(len(k1)), np.unique(k1, return_index=True)[1])] = False
                if not hit.any():
                    continue
                size = np.diff(np.append(first, len(hashes)))
                line = np.repeat(np.arange(len(first)), size)
                of = np.repeat(hit, size)
                tokens, line = _distinct_tokens(hashes[of], line[of])
                n = np.bincount(line, minlength=len(first))[hit]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(tokens.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(k1[hit]), lists], names=_TOKENS.names)

    return chosen.select("text").mapInArrow(find, _TOKENS).groupBy("k1").agg(F.first("tokens").alias("tokens"))


def verified(texts: DataFrame, lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """(y): lines with a partner whose Jaccard similarity reaches the threshold."""
    wanted = stored(pairs.select(F.explode(F.array("y", "x")).alias("k1")).distinct())
    tokens = stored(line_tokens(texts, lines, wanted))
    num, den = THRESHOLD

    def similar(some: DataFrame) -> DataFrame:
        both = some.join(tokens.select(F.col("k1").alias("x"), F.col("tokens").alias("tx")), "x")
        both = both.join(tokens.select(F.col("k1").alias("y"), F.col("tokens").alias("ty")), "y")
        common, total = F.size(F.array_intersect("tx", "ty")), F.size("tx") + F.size("ty")
        return both.filter((num + den) * common >= num * total).select("y").distinct()

    closest = pairs.groupBy("y").agg(F.min(F.struct("far", "x")).alias("c")).select("y", "c.x")
    first = stored(similar(closest))
    others = pairs.select("y", "x").join(first, "y", "left_anti")
    return stored(first.union(similar(others)))


_RESULT = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())]
)


@F.arrow_udf(_RESULT)
def _rebuilt(texts: pa.Array, kept: pa.Array) -> pa.Array:
    out, n_lines, n_removed = [], [], []
    for value, numbers in zip(texts, kept):
        text, stay = value.as_py(), set(numbers.as_py() or ())
        lines = (text or "").split("\n")
        worded = [i for i, x in enumerate(lines) if x.strip(" \t\x0b\x0c\r")]
        gone = set(worded).difference(stay)
        if gone:
            text = "\n".join(x for i, x in enumerate(lines) if i not in gone) if stay else ""
        out.append(text)
        n_lines.append(len(worded))
        n_removed.append(len(gone))
    ts.release_memory()
    return pa.StructArray.from_arrays(
        [pa.array(out, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())], names=_RESULT.names
    )


def kept_lines(texts: DataFrame) -> DataFrame:
    """(id, h, kept): the numbers of the lines that stay, by document id and text hash
    (the row's number in place of the hash where there is no id), for the columns id, h
    and text."""
    lines = stored(distinct_lines(texts, token_counts(texts)))
    chunks = token_chunks(lines)
    pairs = stored(candidates(lines, chunks))
    gone = verified(texts, lines, pairs)
    open_lines = stored(pairs.filter("more").select("y").distinct().join(gone, "y", "left_anti"))
    if not open_lines.isEmpty():
        gone = gone.union(verified(texts, lines, stored(all_candidates(lines, chunks, open_lines))))
    stay = lines.select("id", "h", "line", "k1").join(gone.select(F.col("y").alias("k1")), "k1", "left_anti")
    return stay.groupBy("id", "h").agg(F.collect_list("line").alias("kept"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with a number for their id (in the ids' order) and a hash for their text. Ids
    that are no whole numbers are numbered by a sorted table of the different ones."""
    text = F.col("row").getField(text_col).cast("string")
    own = F.col("row").getField(id_col)
    kind = docs.schema[id_col].dataType

    def keyed(rows: DataFrame, number: Column, h: Column) -> DataFrame:
        return rows.select("row", number.alias("id"), h.alias("h"), text.alias("text"))

    rows = packed(docs)
    by_text = F.xxhash64(as_text(text))
    number = own.cast("long")
    with_id = rows.filter(own.isNotNull())
    if not isinstance(kind, T.IntegralType):
        names = with_id.select(own.alias("name")).distinct().orderBy("name")
        names = stored(names.select("name", F.monotonically_increasing_id().alias("number")))
        with_id, number = with_id.join(names, own == F.col("name")), F.col("number")
    without = rows.filter(own.isNull())
    if without.isEmpty():
        return keyed(with_id, number, by_text)
    # a null identifies nothing: a number for each of these rows, mixed one to one, that
    # stays the same in all steps
    without = stored(without.withColumn("n", F.monotonically_increasing_id()))
    return keyed(with_id, number, by_text).union(keyed(without, F.lit(None).cast("long"), F.xxhash64("n")))


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_lines, removed): per row of ``docs`` its lines with a word and the
    numbers (from 0) of those that go. Texts are not shuffled."""
    ship_package(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)
    stay = kept_lines(keyed.select("id", "h", as_text(F.col("text")).alias("text")))
    own = F.col("row").getField(id_col).alias("own")
    lines = keyed.select(own, "id", "h", F.split(as_text(F.col("text")), "\n").alias("lines"))
    number = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.get("lines", i).rlike("[^ \\t\\x0B\\f\\r]"))
    rows = lines.select("own", "id", "h", number.alias("worded")).alias("a")
    joined = rows.join(stay.alias("b"), F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.h") == F.col("b.h")), "left")
    none = F.array().cast("array<int>")
    gone = F.array_except("a.worded", F.coalesce("b.kept", none))
    return joined.select(F.col("a.own").alias(id_col), F.size("a.worded").cast("long").alias("n_lines"), gone.alias("removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the shortened text, ``n_lines`` (lines with a word) and ``n_removed``."""
    ship_package(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)
    stay = stored(kept_lines(keyed.select("id", "h", as_text(F.col("text")).alias("text"))))
    rows = keyed.select("row", "id", "h").alias("a")
    joined = rows.join(stay.alias("b"), F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.h") == F.col("b.h")), "left")
    text = F.col("row").getField(text_col).cast("string")
    decided = joined.select("row", _rebuilt(text, F.col("kept")).alias("new"))
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    cols = [(F.col("new.text") if c == text_col else F.col("row").getField(c)).alias(c) for c in names]
    return decided.select(*cols, F.col("new.n_lines").alias("n_lines"), F.col("new.n_removed").alias("n_removed"))
