"""Phrase collocations: frequent phrases of 2 to 4 words, scored by their weakest cut.

Texts are lower-cased (A-Z) and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, pieces into
words ``[^\\x20\\x09]+``. All counts are per language. A phrase is a candidate if it occurs
``LEAST`` times or more (overlapping occurrences count); cut after its first k words it
scores floor(SCALE * count / (count of the first part + count of the rest)), and the lowest
cut counts. A candidate goes if a longer candidate that contains it has ``COVER`` percent or
more of its occurrences. The first ``TOP`` of each language are returned.

Method, sorting of suffix pointers:

1. ``word_counts``: words by language, and a 64-bit number for each (checked to be different
   for different words; else they are numbered with another seed).
2. ``pair_counts``: pairs of frequent neighbours, counted in buckets (``gram_counts``).
   Only places that begin with a frequent pair can begin a phrase: bit tables of the frequent
   words and pairs pass all of these and few others. Their size follows the number of
   entries, up to 2**``TABLE_BITS`` bits; a fuller table only passes more.
3. ``suffixes``: every such place gives the suffix of up to four words that its piece and the
   pairs allow. A task sorts its suffixes, adds up equal ones and sends them to the bucket of
   their leading pair; those of a hot pair (more than one in ``HOT`` of all words, so at most
   ``HOT`` pairs) go to the bucket of all their words, so that no bucket holds a hot phrase
   whole.
4. ``phrase_counts``: in a bucket, multikey three-way quicksort to four words: the pointers of
   a partition are split by their next word into less, equal and greater; the weight of an
   equal partition is the count of its words, and it is split by the following word. Partitions
   lighter than ``LEAST`` are abandoned. (Parts of hot pairs are counted without abandoning,
   up to three words, and added up.)
5. ``collocations``: cuts, coverage and ranking as joins and aggregations of the phrases.

Edge cases: a null text counts as empty, a null language is ``und``; very long texts and
words are taken whole; repeated rows count as often as they occur; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm import textscan as ts
from orderlens.llm.common import as_text, partitions_for, quoted, ship_package, stored
from orderlens.llm.gram_counts import bucket_bits, gram_blobs, gram_numbers, merged_buckets

LEAST = 30
LONGEST = 4
COVER = 80
SCALE = 2_000_000
TOP = 2000
HOT = 2000
TABLE_BITS = 28
#: Suffixes that a task holds before it passes them on.
HELD = 1_000_000

_W = ["w1", "w2", "w3", "w4"]


def _bytes_table(text: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(text)] = True
    return out


_BREAKS = _bytes_table(b".,;:!?\n\x0b\x0c\r")
_KEPT = ~(_BREAKS | _bytes_table(b" \t"))


class _Words:
    """The words of a slice: bytes of the different ones, the number of each, rows and
    which neighbours are in one piece."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        lower = ts.lower_table()[data]
        starts, ends = ts.spans(lower, bounds, _KEPT)
        offsets = np.append(0, np.cumsum(ends - starts))
        body = np.ascontiguousarray(lower[_KEPT[lower]])
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
        coded = words.dictionary_encode()
        self.number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.words = coded.dictionary.to_pylist()
        self.row = ts.rows_of(starts, bounds)
        breaks = np.append(0, np.cumsum(_BREAKS[lower]))
        self.joined = (self.row[1:] == self.row[:-1]) & (breaks[starts[1:]] == breaks[ends[:-1]]) if len(starts) else np.zeros(0, bool)


def _numbers(w: _Words, langs: list[str], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit numbers of the slice's different words, and of its rows' languages."""
    words = np.array([xxhash.xxh64_intdigest(x, seed) for x in w.words], dtype=np.uint64)
    kinds = {x: xxhash.xxh64_intdigest(x, seed + 1) for x in set(langs)}
    return words, np.array([kinds[x] for x in langs], dtype=np.uint64)


def _in_language(words: np.ndarray, langs: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ts.mix(words + langs * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)  # never 0


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[_Words, list[str]]]:
    """Slices of batches of (lang, text)."""
    langs = batch.column(0).to_pylist()
    for first, data, bounds in ts.slices(batch.column(1)):
        yield _Words(data, bounds), langs[first : first + len(bounds) - 1]


_WORD = T.StructType(
    [T.StructField("lang", T.StringType()), T.StructField("word", T.BinaryType()), T.StructField("w", T.LongType()), T.StructField("n", T.LongType())]
)


def word_counts(texts: DataFrame, seed: int) -> DataFrame:
    """(lang, word, w, n): words by language, their number and count, for (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0

        def summed() -> pa.Table:
            out = pa.concat_tables(held).group_by(["lang", "word", "w"]).aggregate([("n", "sum")])
            return out.rename_columns(["lang", "word", "w", "n"])

        for batch in batches:
            for words, langs in _slices(batch):
                if not words.words:
                    continue
                kinds = pa.array(langs).dictionary_encode()
                code = kinds.indices.to_numpy().astype(np.int64)[words.row] * len(words.words) + words.number
                code, n = np.unique(code, return_counts=True)
                kind, word = code // len(words.words), code % len(words.words)
                hashes, of_kinds = _numbers(words, kinds.dictionary.to_pylist(), seed)
                w = _in_language(hashes[word], of_kinds[kind]).view(np.int64)
                lang, spelled = kinds.dictionary.take(pa.array(kind)), pa.array(words.words, pa.binary()).take(pa.array(word))
                held.append(pa.table([lang, spelled, pa.array(w), pa.array(n)], names=_WORD.names))
                size += len(code)
            if size > HELD:
                held = [summed()]
                size = held[0].num_rows
                if size > HELD // 2:
                    yield from held.pop().to_batches()
                    size = 0
        if held:
            yield from summed().to_batches()

    found = texts.select("lang", "text").mapInArrow(count, _WORD)
    return found.groupBy("lang", "word", "w").agg(F.sum("n").alias("n"))


def bit_table(keys: DataFrame, entries: int) -> np.ndarray:
    """Bit table of the long column ``k``: about 16 bits an entry, a power of two, at most
    2**TABLE_BITS bits in all."""
    size, per = 1 << min(max((16 * max(entries, 1)).bit_length(), 16), TABLE_BITS), 32768
    place = F.pmod("k", F.lit(size))
    rows = keys.groupBy(F.floor(place / per).alias("b")).agg(F.bitmap_construct_agg(place % per).alias("m")).toArrow()
    out = np.zeros(size // 8, dtype=np.uint8)
    for b, m in zip(rows["b"].to_pylist(), rows["m"].to_pylist()):
        out[b * per // 8 : (b + 1) * per // 8] = np.frombuffer(m, dtype=np.uint8)
    return out


def _in_table(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = (keys & np.uint64(len(table) * 8 - 1)).astype(np.int64)
    return (table[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _pairs(words: _Words, langs: list[str], seed: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each word, first words of pairs of frequent neighbours, the pairs' hashes)."""
    hashes, of_rows = _numbers(words, langs, seed)
    w = _in_language(hashes[words.number], of_rows[words.row])
    often = _in_table(frequent, w)
    at = np.flatnonzero(words.joined & often[1:] & often[:-1]) if len(w) else np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        return w, at, ts.mix(w[at] * np.uint64(0xC2B2AE3D27D4EB4F) + w[at + 1])


_PAIR = T.StructType([T.StructField("k", T.LongType()), T.StructField("n", T.LongType())])


def pair_counts(texts: DataFrame, seed: int, frequent: np.ndarray, bits: int) -> DataFrame:
    """(k, n): numbers of pairs of frequent neighbours that occur often enough. Two pairs
    with one number only let more places through."""

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for words, langs in _slices(batch):
            yield _pairs(words, langs, seed, frequent)[2]

    def finish(bucket: int, low: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        keys = (low[n >= LEAST].astype(np.int64)) | (bucket << 32)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n[n >= LEAST])], names=_PAIR.names)

    return merged_buckets(gram_blobs(texts.select("lang", "text"), hashes, bits), bits, finish, _PAIR)


def _equal_rows(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different columns of a matrix of four rows, and their added counts."""
    order = np.lexsort(rows[::-1])
    rows, n = rows[:, order], n[order]
    first = np.flatnonzero(np.append(True, (rows[:, 1:] != rows[:, :-1]).any(axis=0))) if rows.shape[1] else np.zeros(0, np.int64)
    return rows[:, first], (np.add.reduceat(n, first) if len(first) else n)


_SUFFIXES = T.StructType(
    [T.StructField("bucket", T.IntegerType()), T.StructField("hot", T.BooleanType())] + [T.StructField(c, T.BinaryType()) for c in (*_W, "n")]
)


def _suffix_rows(rows: np.ndarray, n: np.ndarray, pair_bits: int, bits: int, hot: np.ndarray) -> pa.RecordBatch:
    """Sorted suffixes as rows of ``_SUFFIXES``, one a bucket."""
    with np.errstate(over="ignore"):
        pair = ts.mix(rows[0] * np.uint64(0xC2B2AE3D27D4EB4F) + rows[1])
        whole = ts.mix(ts.mix(pair * np.uint64(0x165667B19E3779F9) + rows[2]) + rows[3])
    is_hot = np.isin(gram_numbers(pair, pair_bits), hot)
    key = (np.where(is_hot, whole, pair) >> np.uint64(64 - bits)).astype(np.int64) * 2 + is_hot
    order = np.argsort(key, kind="stable")
    rows, n, key = rows[:, order], n[order], key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    ends = np.append(first, len(key)).astype(np.int64)

    def cells(values: np.ndarray) -> pa.Array:
        buffers = [None, pa.py_buffer(ends * values.itemsize), pa.py_buffer(np.ascontiguousarray(values))]
        return pa.Array.from_buffers(pa.large_binary(), len(first), buffers).cast(pa.binary())

    own = key[first]
    columns = [pa.array((own // 2).astype(np.int32)), pa.array(own % 2 == 1), *map(cells, rows), cells(n)]
    return pa.RecordBatch.from_arrays(columns, names=_SUFFIXES.names)


def suffixes(texts: DataFrame, seed: int, frequent: np.ndarray, often: np.ndarray, hot: np.ndarray, pair_bits: int, bits: int) -> DataFrame:
    """Suffixes that begin with a pair of the bit table ``often``, by bucket. ``hot``:
    numbers of hot pairs."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return _equal_rows(np.concatenate([r for r, _ in held], axis=1), np.concatenate([n for _, n in held]))

        for batch in batches:
            for words, langs in _slices(batch):
                w, at, hashes = _pairs(words, langs, seed, frequent)
                at = at[_in_table(often, gram_numbers(hashes, pair_bits))]
                if not len(at):
                    continue
                goes_on = np.zeros(len(w) + LONGEST, dtype=bool)
                goes_on[at] = True
                wide = np.append(w, np.zeros(LONGEST, dtype=np.uint64))
                third = goes_on[at + 1]
                fourth = third & goes_on[at + 2]
                rows = np.stack([w[at], w[at + 1], np.where(third, wide[at + 2], 0), np.where(fourth, wide[at + 3], 0)]).astype(np.uint64)
                held.append(_equal_rows(rows, np.ones(len(at), np.int64)))
                size += held[-1][0].shape[1]
                if size > HELD:
                    held = [merged()]
                    size = held[0][0].shape[1]
                    if size > HELD // 2:
                        yield _suffix_rows(*held.pop(), pair_bits, bits, hot)
                        size = 0
        if held:
            yield _suffix_rows(*merged(), pair_bits, bits, hot)

    return texts.select("lang", "text").mapInArrow(emit, _SUFFIXES)


def multikey_sort(rows: np.ndarray, weight: np.ndarray, least: int, whole_from: int = 2) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(pointers, words, weights): of the phrases of 2 words or more in the columns of
    ``rows`` (0 where a suffix has ended), one pointer each, their number of words and
    weight. Partitions lighter than ``least`` are abandoned, but those of fewer than
    ``whole_from`` words are kept whatever their weight.

    All partitions are split at once: ``part`` numbers the partition of each pointer
    (consecutive ones), ``depth`` gives the words that a partition has in common."""
    pointer = np.arange(rows.shape[1])
    part = np.zeros(len(pointer), dtype=np.int64)
    depth = np.zeros(1, dtype=np.int64)
    while len(pointer):
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        size = np.diff(np.append(first, len(part)))
        part = np.repeat(np.arange(len(first)), size)
        key = rows[depth[part], pointer]
        pivot = key[first + size // 2][part]
        side = (key >= pivot).astype(np.int64) + (key > pivot)
        # stable three-way partition of every part: places from counts of the sides
        child = 3 * part + side
        count = np.bincount(child, minlength=3 * len(first))
        begin = np.cumsum(count) - count
        place = np.empty(len(part), dtype=np.int64)
        for s in range(3):
            of = np.flatnonzero(side == s)
            place[of] = np.arange(len(of)) - (np.cumsum(count[s::3]) - count[s::3])[part[of]] + begin[3 * part[of] + s]
        moved = np.empty_like(pointer)
        moved[place] = pointer
        pointer = moved
        child = np.repeat(np.arange(3 * len(first)), count)
        heavy = np.bincount(child, weights=weight[pointer], minlength=3 * len(first)).astype(np.int64)
        deep = np.repeat(depth, 3)
        deep[1::3] += 1
        stays = (count > 0) & ((heavy >= least) | (deep < whole_from))
        equal = np.zeros(3 * len(first), dtype=bool)
        equal[1::3] = True
        for words in range(2, rows.shape[0] + 1):
            of = np.flatnonzero(stays & equal & (deep == words))
            if len(of):
                yield pointer[begin[of]], words, heavy[of]
        stays &= deep < rows.shape[0]
        alive = stays[child]
        pointer, child = pointer[alive], child[alive]
        ended = rows[deep[child], pointer] == 0
        pointer, part = pointer[~ended], child[~ended]
        if not len(pointer):
            return
        # what is left of a partition may be too light now
        left = np.bincount(part, weights=weight[pointer], minlength=len(deep))
        alive = ((left >= least) | (deep + 1 < whole_from))[part]
        pointer, part = pointer[alive], part[alive]
        depth = deep[np.unique(part)]


_PHRASE = T.StructType([T.StructField(c, T.LongType()) for c in (*_W, "a")])


def phrase_counts(routed: DataFrame, bits: int) -> DataFrame:
    """(w1..w4, a): phrases (0 after the last word) that occur often enough."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(held: list[tuple[np.ndarray, np.ndarray]], hot: bool) -> Iterator[pa.RecordBatch]:
            rows, n = np.concatenate([r for r, _ in held], axis=1), np.concatenate([n for _, n in held])
            for pointer, words, a in multikey_sort(rows, n, LEAST, LONGEST if hot else 2):
                out = rows[:, pointer]
                out[words:] = 0
                yield pa.RecordBatch.from_arrays([*(pa.array(x.view(np.int64)) for x in out), pa.array(a)], names=_PHRASE.names)

        key, held = None, []
        for batch in batches:
            for i, mine in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if mine != key and held:
                    yield from counted(held, key[1])
                    held = []
                key = mine
                cells = [np.frombuffer(batch.column(c)[i].as_py(), dtype=np.uint64) for c in range(2, 6)]
                held.append((np.stack(cells), np.frombuffer(batch.column(6)[i].as_py(), dtype=np.int64)))
        if held:
            yield from counted(held, key[1])

    parts = partitions_for(routed.sparkSession, 1 << bits, 4)
    placed = routed.repartition(parts, "bucket", "hot").sortWithinPartitions("bucket", "hot")
    return placed.mapInArrow(sort, _PHRASE).groupBy(*_W).agg(F.sum("a").alias("a")).filter(F.col("a") >= LEAST)


def _part(begin: int, end: int) -> list[Column]:
    """Words begin to end of a phrase as a phrase of its own."""
    return [F.col(_W[begin + i]).alias(f"p{i + 1}") if begin + i < end else F.lit(0).cast("long").alias(f"p{i + 1}") for i in range(LONGEST)]


_P = ["p1", "p2", "p3", "p4"]
_SIZE = "2 + int(w3 <> 0) + int(w4 <> 0)"


def _exact(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(20,0)")


def _scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """(w1..w4, a, l, r, score) by the lowest cut of every phrase."""
    known = phrases.select(*[F.col(w).alias(p) for w, p in zip(_W, _P)], F.col("a").alias("f"))
    zero = [F.lit(0).cast("long").alias(p) for p in _P[1:]]
    known = known.union(words.select(F.col("w").alias("p1"), *zero, F.col("n").alias("f")))
    sides = []
    for size in range(2, LONGEST + 1):
        for k in range(1, size):
            for side, (b, e) in enumerate([(0, k), (k, size)]):
                cut = F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), *_part(b, e))
                sides.append(F.when(F.expr(f"{_SIZE} = {size}"), cut))
    parts = phrases.select(*_W, "a", F.explode(F.filter(F.array(*sides), lambda x: x.isNotNull())).alias("c")).select(*_W, "a", "c.*")
    found = parts.join(known, _P).groupBy(*_W, "a", "k").agg(
        F.sum(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.sum(F.when(F.col("side") == 1, F.col("f"))).alias("r")
    )
    score = F.expr(f"cast({SCALE} as decimal(10,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = found.groupBy(*_W, "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    return lowest.select(*_W, "a", "c.l", "c.r", "c.score")


def _covered(phrases: DataFrame) -> DataFrame:
    """(p1..p4, longer): phrases inside longer ones, with the greatest count of these."""
    inner = []
    for size in range(3, LONGEST + 1):
        for n in range(2, size):
            for b in range(size - n + 1):
                inner.append(F.when(F.expr(f"{_SIZE} = {size}"), F.struct(*_part(b, b + n))))
    subs = phrases.filter("w3 <> 0").select("a", F.explode(F.filter(F.array(*inner), lambda x: x.isNotNull())).alias("s"))
    return subs.groupBy(*[F.col(f"s.{p}").alias(p) for p in _P]).agg(F.max("a").alias("longer"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``TOP`` phrases of each language;
    a, l and r are the counts of the phrase and of its lowest cut's parts, n the words of
    the language."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.coalesce(quoted(lang_col).cast("string"), F.lit("und")).alias("lang"), as_text(quoted(text_col)).alias("text"))
    seed = 0
    while True:
        words = stored(word_counts(texts, seed))
        if words.groupBy("w").count().filter("count > 1").isEmpty():
            break
        seed += 2
    total = words.agg(F.sum("n")).first()[0] or 0
    frequent = words.filter(F.col("n") >= LEAST)
    table = bit_table(frequent.select(F.col("w").alias("k")), frequent.count())
    pair_bits = bucket_bits(total)
    pairs = stored(pair_counts(texts, seed, table, pair_bits), batch_rows=500)
    often = bit_table(pairs.select("k"), pairs.count())
    hot = pairs.filter(F.col("n") * F.lit(HOT) > F.lit(total)).select("k").toArrow()["k"].to_numpy().astype(np.uint64)
    bits = bucket_bits(2 * total)
    phrases = stored(phrase_counts(suffixes(texts, seed, table, often, hot, pair_bits, bits), bits), batch_rows=500)

    scored = _scored(phrases, frequent.select("w", "n"))
    covered = _covered(phrases)
    same = [F.col(w) == F.col(p) for w, p in zip(_W, _P)]
    kept = scored.join(covered, same, "left").filter(
        F.col("longer").isNull() | (F.lit(100).cast("decimal(3,0)") * _exact("longer") < F.lit(COVER).cast("decimal(3,0)") * _exact("a"))
    )
    spelled = kept.select(*_W, "a", "l", "r", "score", F.posexplode(F.array(*_W)).alias("at", "w")).filter("w <> 0")
    spelled = spelled.join(frequent.select("lang", "word", "w"), "w").groupBy(*_W, "a", "l", "r", "score", "lang").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", F.col("word").cast("string").alias("word")))), lambda x: x["word"]), " ").alias("phrase")
    )
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = spelled.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= TOP)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return top.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
