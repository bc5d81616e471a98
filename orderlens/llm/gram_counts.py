"""Counts of hashed word n-grams of a corpus, exact and in bounded groups.

Tasks count the 64-bit hashes of their texts' n-grams and send them on by bucket: the
first ``bits`` bits of a hash name the bucket, the next 32 the n-gram in it. A row holds
all that a task knows of a bucket, sorted numbers of 4 bytes and counts of one (a larger
count is several entries), so a shuffled n-gram takes 5 bytes before compression. A bucket
is merged in one task; ``bucket_bits`` gives so many buckets that one gets at most about
``BUCKET_ENTRIES`` entries, whatever the corpus: hashes spread evenly, and a hot n-gram is
one entry a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orderlens.llm.common import partitions_for
from orderlens.llm.textscan import release_memory

BUCKET_ENTRIES = 1 << 20
#: n-grams that a task holds before it sorts them and passes them on.
HELD = 3_000_000

_BLOB = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("grams", T.BinaryType()), T.StructField("counts", T.BinaryType())])


def bucket_bits(entries: int) -> int:
    """Bits of the bucket number for at most so many n-gram occurrences (1 to 30)."""
    return min(max(1, (max(entries, 1) // BUCKET_ENTRIES).bit_length()), 30)


def gram_numbers(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bucket and number in the bucket of 64-bit hashes, as one number of bits + 32 bits."""
    return hashes >> np.uint64(32 - bits)


def _added(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different numbers and their added counts."""
    if not len(grams):
        return grams, n
    order = np.argsort(grams)
    grams = grams[order]
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    return grams[first], np.add.reduceat(n[order], first)


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different numbers and how often each occurs."""
    grams = np.sort(grams)
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    return grams[first], np.diff(np.append(first, len(grams)))


def _blobs(grams: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Sorted different gram numbers and their counts as rows, one a bucket."""
    times = -(-n // 255)
    last = np.cumsum(times) - 1
    grams = np.repeat(grams, times)
    counts = np.full(len(grams), 255, dtype=np.uint8)
    counts[last] = n - 255 * (times - 1)
    bucket = (grams >> np.uint64(32)).astype(np.int32)
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    ends = np.append(first, len(grams)).astype(np.int64)
    low = (grams & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    def cells(values: np.ndarray) -> pa.Array:
        offsets = pa.py_buffer(ends * values.itemsize)
        cut = pa.Array.from_buffers(pa.large_binary(), len(first), [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])
        return cut.cast(pa.binary())

    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), cells(low), cells(counts)], names=_BLOB.names)


def gram_blobs(rows: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> DataFrame:
    """(bucket, grams, counts) of the hashes that a function finds in the batches of ``rows``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for found in hashes(batch):
                held.append(gram_numbers(found, bits))
                size += len(found)
                if size > HELD:
                    yield _blobs(*_counted(np.concatenate(held)))
                    held, size = [], 0
                    release_memory()
        if size:
            yield _blobs(*_counted(np.concatenate(held)))

    return rows.mapInArrow(count, _BLOB)


def merged_buckets(blobs: DataFrame, bits: int, finish: Callable[[int, np.ndarray, np.ndarray], pa.RecordBatch], schema: T.StructType) -> DataFrame:
    """Of every bucket what ``finish`` makes of it: (bucket, sorted numbers in the bucket,
    their counts) to a batch of ``schema``."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def done() -> pa.RecordBatch:
            grams = np.concatenate([np.frombuffer(g, dtype=np.uint32) for g, _ in held])
            n = np.concatenate([np.frombuffer(c, dtype=np.uint8) for _, c in held]).astype(np.int64)
            return finish(bucket, *_added(grams, n))

        for batch in batches:
            for b, g, c in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if b != bucket and held:
                    yield done()
                    held = []
                bucket = b
                held.append((g.as_py(), c.as_py()))
        if held:
            yield done()
        release_memory()

    parts = partitions_for(blobs.sparkSession, 1 << bits, 16)
    return blobs.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(merge, schema)
