"""SimHash near-duplicates: fingerprints and an exact Hamming self-join.

Fingerprint: A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, shingles are 4
consecutive words joined by a space (repeats included; the whole sequence if there
are fewer words). A bit is 1 if it is set in more than half of the shingles' XXH64
(seed 42). No words: fingerprint zero, linked like any other.

Join: all pairs of different fingerprints with at most ``max_bits`` differing bits.
Of b blocks of bits at least b - max_bits are equal in such a pair, so each
fingerprint goes to one group for every choice of that many blocks. b grows with the
number of fingerprints, so that groups stay small on average. In a group, a binary
trie is joined with itself: pairs of nodes are walked down together, differing bits
are added up, and a pair is dropped once it has more than ``max_bits``. The walk is
vectorised over all groups of a task. A group over ``GROUP_LIMIT`` is cut into chunks
and each pair of chunks is a group of its own, so that no task grows with a hot key.

A group gives back a spanning forest of its links (at most one edge a member), never
all its pairs; connected components over those edges lose no link.

Edge cases: null text is a text without words; null ids are kept, and a component
whose ids are all null has a null id; repeated rows are in one component; the empty
table gives no rows; extra columns stay, those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm import textscan as ts
from orderlens.llm.common import as_text, checkpointed, packed, partitions_for, quoted, ship_package
from orderlens.llm.components import connected_components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
GROUP_AVERAGE = 4096
GROUP_LIMIT = 20_000

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_SEPARATORS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text as a signed number."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    norm = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(len(words) - size + 1, 1)
    last = ends[min(size, len(words)) - 1 :].tolist()
    first = [0, *(ends[: n - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(norm[a:b], SEED) for a, b in zip(first, last)], dtype=">u8")
    octets = hashes.view(np.uint8).reshape(-1, 8)
    if n < 400:
        ones = np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    else:
        places = (octets + np.arange(0, 2048, 256, dtype=np.int64)).ravel()
        ones = (np.bincount(places, minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(2 * ones > n).view(">i8")[0])


_LOWER = bytes(ts.lower_table())


@F.arrow_udf(T.LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array([fingerprint(x.as_py()) for x in texts], pa.int64())


def block_choices(rows: int, max_bits: int = MAX_BITS) -> tuple[int, list[int]]:
    """(number of blocks, masks of equal bits): the fewest blocks whose groups have
    ``GROUP_AVERAGE`` evenly spread fingerprints or fewer."""
    for blocks in range(max_bits + 1, max_bits + 6):
        edges = [64 * i // blocks for i in range(blocks + 1)]
        parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
        masks = [sum(c) for c in combinations(parts, blocks - max_bits)]
        if rows >> min(m.bit_count() for m in masks) <= GROUP_AVERAGE:
            break
    return blocks, masks


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def trie_self_join(values: np.ndarray, groups: np.ndarray, max_bits: int = MAX_BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of values of one group that differ in at most ``max_bits`` bits.

    ``values`` (uint64) are sorted within ``groups``, which are contiguous: a range of
    equal leading bits is a node of the group's binary trie. A frontier of node pairs
    (ranges, bits that differ so far) goes down one bit at a time; wide frontiers are
    worked off in parts, depth first, so that memory is bounded."""
    n = len(values)
    cuts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    lo, hi = cuts, np.append(cuts[1:], n)
    ones_before: dict[int, np.ndarray] = {}

    def ones(bit: int) -> np.ndarray:
        if bit not in ones_before:
            ones_before[bit] = np.concatenate([[0], np.cumsum((values >> np.uint64(63 - bit)) & np.uint64(1))]).astype(np.int64)
        return ones_before[bit]

    big = hi - lo > 1
    zero = np.zeros(int(big.sum()), dtype=np.int64)
    stack = [(0, lo[big], hi[big], lo[big], hi[big], zero)]
    while stack:
        bit, a, b, c, d, bits = stack.pop()
        if len(a) > 200_000:
            for s in range(0, len(a), 100_000):
                stack.append((bit, *(x[s : s + 100_000] for x in (a, b, c, d, bits))))
            continue
        small = (b - a) * (d - c) <= 16 if bit < 64 else np.ones(len(a), dtype=bool)
        if small.any():
            yield from _leaf_pairs(values, a[small], b[small], c[small], d[small], max_bits)
        a, b, c, d, bits = (x[~small] for x in (a, b, c, d, bits))
        if not len(a):
            continue
        count = ones(bit)
        m1 = b - (count[b] - count[a])  # where the node's values with this bit set begin
        m2 = d - (count[d] - count[c])
        same = a == c  # a node with itself
        other = ~same
        parts = [(a, m1, c, m2, bits), (m1, b, m2, d, bits), (a, m1, m2, d, bits + 1)]
        parts.append(tuple(x[other] for x in (m1, b, c, m2, bits + 1)))
        a, b, c, d, bits = (np.concatenate(x) for x in zip(*parts))
        live = (b > a) & (d > c) & (bits <= max_bits) & ~((a == c) & (b - a < 2))
        stack.append((bit + 1, *(x[live] for x in (a, b, c, d, bits))))


def _leaf_pairs(values, a, b, c, d, max_bits):
    """Pairs below small node pairs, by their differing bits."""
    size = (b - a) * (d - c)
    for s in _chunks(size, 1_000_000):
        k = size[s]
        which = np.repeat(np.arange(len(k)), k)
        within = np.arange(len(which)) - np.repeat(np.cumsum(k) - k, k)
        width = (d[s] - c[s])[which]
        i, j = a[s][which] + within // width, c[s][which] + within % width
        near = (i < j) & (np.bitwise_count(values[i] ^ values[j]) <= max_bits)
        if near.any():
            yield i[near], j[near]


def _chunks(size: np.ndarray, most: int) -> Iterator[slice]:
    total = np.cumsum(size)
    start = 0
    while start < len(size):
        base = total[start - 1] if start else 0
        end = max(int(np.searchsorted(total, base + most, side="right")), start + 1)
        yield slice(start, end)
        start = end


def _roots(parent: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index of each component, pairs added as they come."""
    for i, j in pairs:
        while True:
            a, b = parent[i], parent[j]
            differ = a != b
            if not differ.any():
                break
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = parent[parent]
                if np.array_equal(up, parent):
                    break
                parent[:] = up
    return parent


_EDGES = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


def _forest(max_bits: int):
    """mapInArrow over rows (key, chunks, fp) sorted by them: edges to the smallest
    member of each local component."""

    def linked(keys: np.ndarray, chunks: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        change = np.append(True, (keys[1:] != keys[:-1]) | (chunks[1:] != chunks[:-1]))
        groups = np.cumsum(change)
        values = fps.view(np.uint64)
        order = np.lexsort((values, groups))
        values, groups = values[order], groups[order]
        root = _roots(np.arange(len(values)), trie_self_join(values, groups, max_bits))
        child = np.flatnonzero(root != np.arange(len(values)))
        signed = values.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[child]), pa.array(signed[root[child]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
            rows += batch.num_rows
            if rows < 50_000:
                continue
            keys, chunks, fps = (np.concatenate(x) for x in zip(*held))
            # the last group may go on in the next batch
            differ = np.flatnonzero((keys != keys[-1]) | (chunks != chunks[-1]))
            done = int(differ[-1]) + 1 if len(differ) else 0
            if done:
                yield linked(keys[:done], chunks[:done], fps[:done])
            held, rows = [(keys[done:], chunks[done:], fps[done:])], len(keys) - done
        if rows:
            yield linked(*(np.concatenate(x) for x in zip(*held)))

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Edges (u, v) that connect the different fingerprints (one column ``fp``, each
    value once) exactly as all their links would."""
    spark = fps.sparkSession
    n = fps.count()
    _, masks = block_choices(n, max_bits)
    # the key of a group: which blocks, and their bits spread over 64 by a hash; a
    # clash of two keys only joins more values
    spread = fps.select(
        "fp", F.explode(F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks)])).alias("key")
    )
    sizes = spread.groupBy("key").agg(F.count("*").alias("size"))
    sizes = checkpointed(sizes.filter(F.col("size") > group_limit))
    if sizes.isEmpty():
        cut = spread.withColumn("chunks", F.lit(0).cast("long"))
    else:
        chunk = F.pmod(F.xxhash64("fp"), F.col("c"))
        cut = (
            spread.join(sizes, "key", "left")
            .withColumn("c", F.coalesce(F.ceil(F.col("size") * 2 / F.lit(group_limit)), F.lit(1)).cast("long"))
            .withColumn("mine", chunk)
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1)))
            .select("key", (F.least("mine", "other") * F.col("c") + F.greatest("mine", "other")).alias("chunks"), "fp")
        )
    parts = partitions_for(spark, n * len(masks), 2_000_000)
    placed = cut.select("key", "chunks", "fp").repartition(parts, "key", "chunks").sortWithinPartitions("key", "chunks")
    return placed.mapInArrow(_forest(max_bits), _EDGES)


def clusters(docs: DataFrame, id_col: str, text_col: str, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, text_hash, fp, root, component_id): one row per row of ``docs``. Ids, hashes
    and fingerprints are checkpointed, texts never. ``root`` names the component by its
    smallest fingerprint, ``component_id`` by its smallest id."""
    ship_package(docs.sparkSession)
    text = as_text(quoted(text_col))
    base = checkpointed(docs.select(quoted(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), _fingerprints(text).alias("fp")))
    vertices = base.groupBy("fp").agg(F.min("id").alias("first"))
    roots = connected_components(links(vertices.select("fp"), max_bits))
    tree = vertices.join(roots.withColumnRenamed("u", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = tree.groupBy("root").agg(F.min("first").alias("component_id"))
    named = tree.select("fp", "root").join(names, "root")
    return base.join(named, "fp").select("id", "text_hash", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """(id_col, fingerprint, component_id), one row per row of ``docs``."""
    out = clusters(docs, id_col, text_col, max_bits)
    name = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return out.select(F.col("id").alias(id_col), name.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` per component: that of the smallest id (a null id only if
    the component has no other; then the smallest text hash). Repeated rows with the
    same id and text count as one document, of which one row stays."""
    found = clusters(docs, id_col, text_col, max_bits)
    each = found.groupBy("root", "id", "text_hash").agg(F.count("*").alias("rows"))
    first = F.min(F.struct(F.col("id").isNull(), F.col("id").alias("id"), F.col("text_hash").alias("h"), F.col("rows").alias("rows")))
    chosen = checkpointed(each.groupBy("root").agg(first.alias("o")).select("o.id", "o.h", "o.rows"))
    keyed = packed(docs)
    keyed = keyed.select("row", F.col("row").getField(id_col).alias("k"), F.xxhash64(as_text(F.col("row").getField(text_col))).alias("kh"))
    kept = keyed.join(chosen, F.col("k").eqNullSafe(F.col("id")) & (F.col("kh") == F.col("h")))
    if chosen.filter("rows > 1").isEmpty():
        return kept.select("row.*")
    once = kept.filter("rows > 1").dropDuplicates(["k", "kh"])
    return kept.filter("rows = 1").select("row.*").unionByName(once.select("row.*"))
