"""Periodic runs: stretches of consecutive words that repeat with a period.

A run is a maximal stretch of words with smallest period q (words q apart are
identical) of at least ``max(MIN_WORDS, MIN_TURNS * q)`` words. Words are
``[^\\x20\\x09-\\x0D]+``, compared byte by byte. The operator lists every run of a text
and gives the text with each run collapsed to its first q words.

Method, seed and extend on diagonals:

- A run of period q holds at least ``max(MIN_WORDS - q, 2 * q)`` words that equal the word
  q later. So k-grams of a length that this overlap guarantees are indexed: 16 words for
  lags below 16, then 32 for lags 16 to 31, 64 for 32 to 63 and so on. Longer grams are
  numbered from pairs of shorter ones, and only from grams that occur again.
- Occurrence pairs: a gram and its next occurrence in the same document. As the gram is
  longer than the lag, a nearer occurrence would give the stretch a shorter period
  (periodicity lemma); so the pair of neighbours is the only one that a run needs, and
  pairs grow with the words, never with their square.
- Seeds are walked by lag and place with the furthest place covered on each lag: a seed
  within it extends that diagonal, any other one begins a new one. Every place is
  indexed, so the last seed's end is the diagonal's end.

Grams are found by 64-bit hashes of word numbers, and every pair is compared word by word;
should two different grams collide, the slice is hashed anew. All work is on slices of
whole texts in Arrow batches: no shuffle, and memory follows the longest text.

Edge cases: a null text counts as empty (no words, no runs, empty result); a very long
text is one slice of its own; repeated rows and null ids are worked off row by row; an
empty table gives an empty table; extra columns stay, those named like a result are
replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm import textscan as ts
from orderlens.llm.common import packed, ship_package

MIN_WORDS = 24
MIN_TURNS = 3
#: The shortest guaranteed overlap: the least of ``max(MIN_WORDS - q, 2 * q)`` over all q.
SEED = 16


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """A number for every word, equal for equal bytes and only for these. The words are
    the maximal runs of kept bytes."""
    offsets = np.append(0, np.cumsum(ends - starts))
    body = np.ascontiguousarray(data[keep[data]])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _seed_hashes(ids: np.ndarray, row: np.ndarray, salt: int) -> np.ndarray:
    """Hashes of the SEED words from each place on; those that cross a row mean nothing."""
    with np.errstate(over="ignore"):
        h = ts.mix(ids.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64)))
        step = 1
        while step < SEED:
            h = ts.mix(h[:-step] * np.uint64(0xD6E8FEB86659FD93) + h[step:])
            step *= 2
        return h ^ ts.mix(row[: len(h)].astype(np.uint64) + np.uint64(1))


def _recurring(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key occurs more than once, by key and place, and the groups' numbers."""
    if not len(keys):
        return places, np.zeros(0, np.int64)
    order = np.argsort(keys)
    sorted_keys = keys[order]
    same = sorted_keys[1:] == sorted_keys[:-1]
    again = np.append(same, False) | np.append(False, same)
    keys, places = sorted_keys[again], places[order][again]
    order = np.lexsort((places, keys))
    keys, places = keys[order], places[order]
    return places, np.cumsum(np.append(False, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)


def find_runs(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in the rows ``first[r]:first[r + 1]`` of word
    numbers; starts count from the first row's first word. By start, then period."""
    none = np.zeros(0, np.int64)
    n = len(ids)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    places = np.flatnonzero(np.arange(n) + SEED <= first[1:][row]) if n else none
    if len(places) < 2:
        return none, none, none
    salt = 1
    while True:
        at, group = _recurring(_seed_hashes(ids, row, salt)[places], places)
        near = np.flatnonzero(group[1:] == group[:-1])
        i, j = at[near], at[near + 1]
        equal = row[i] == row[j]
        for t in range(SEED):
            equal &= ids[i + t] == ids[j + t]
        if equal.all():
            break
        salt += 1
    found_lag, found_at, found_k = [none], [none], [none]
    k, least = SEED, 1
    while len(at):
        near = np.flatnonzero(group[1:] == group[:-1])
        i, lag = at[near], at[near + 1] - at[near]
        seed = (lag >= least) & (lag < k)
        found_lag.append(lag[seed])
        found_at.append(i[seed])
        found_k.append(np.full(int(seed.sum()), k))
        # grams of twice the length, from two that occur again
        number = np.full(n, -1, dtype=np.int64)
        number[at] = group
        at = at[at + k < n]
        at = at[(number[at + k] >= 0) & (row[at] == row[np.minimum(at + k, n - 1)])]
        groups = int(group[-1]) + 1
        at, group = _recurring(number[at] * groups + number[at + k], at)
        k, least = 2 * k, k
    lag, at, k_of = (np.concatenate(x) for x in (found_lag, found_at, found_k))
    if not len(lag):
        return none, none, none
    order = np.lexsort((at, lag))
    lag, at, covered = lag[order], at[order], (at + k_of)[order]
    # a seed within what its lag's diagonal has covered goes on with it
    fresh = np.append(True, (lag[1:] != lag[:-1]) | (at[1:] > covered[:-1]))
    begin = np.flatnonzero(fresh)
    start, period = at[begin], lag[begin]
    length = covered[np.append(begin[1:], len(at)) - 1] - start + period
    long = length >= np.maximum(MIN_WORDS, MIN_TURNS * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_RESULT = T.StructType(
    [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(_RUN)), T.StructField("collapsed", T.StringType())]
)


@F.arrow_udf(_RESULT)
def _periodic(texts: pa.Array) -> pa.Array:
    keep = ts.spaces_table()
    n_words, sizes, collapsed = [], [], []
    parts: list[list[np.ndarray]] = [[], [], []]
    for _, data, bounds in ts.slices(texts):
        starts, ends = ts.spans(data, bounds, keep)
        first = np.searchsorted(starts, bounds)
        begin, length, period = find_runs(word_numbers(data, starts, ends, keep), first)
        row = np.searchsorted(first, begin, side="right") - 1
        own = np.bincount(row, minlength=len(bounds) - 1)
        n_words.append(np.diff(first))
        sizes.append(own)
        for part, values in zip(parts, (begin - first[row], length, period)):
            part.append(values)
        steps = np.bincount(begin + period, minlength=len(starts) + 1) - np.bincount(begin + length, minlength=len(starts) + 1)
        stays = np.cumsum(steps) == 0
        raw = data.tobytes()
        for r, has in enumerate(own.tolist()):
            words = raw[bounds[r] : bounds[r + 1]].split()
            if has:
                words = [w for w, stay in zip(words, stays[first[r] : first[r + 1]].tolist()) if stay]
            collapsed.append(b" ".join(words).decode())
    flat = [np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts]
    offsets = np.append(0, np.cumsum(np.concatenate(sizes))) if sizes else np.zeros(1, np.int64)
    runs = pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in flat], names=_RUN.names)
    )
    counts = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
    return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), runs, pa.array(collapsed, pa.string())], names=_RESULT.names)


def periodic_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (by start, then period; starts are word numbers
    from 0) and ``collapsed`` (words outside the repeated turns, joined by one space)."""
    ship_package(docs.sparkSession)
    text = F.col("row").getField(text_col).cast("string")
    rows = packed(docs).select("row", _periodic(text).alias("found"))
    names = [c for c in docs.columns if c.lower() not in _RESULT.names]
    return rows.select(*[F.col("row").getField(c).alias(c) for c in names], "found.*")


def strongest(runs: Column) -> Column:
    """Of a column of runs, the one with the greatest length / period (compared exactly),
    then the smallest start and period; null without runs."""

    def order(x, y):
        mine, other = x["length"] * y["period"], y["length"] * x["period"]
        return (
            F.when(mine > other, -1).when(mine < other, 1)
            .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
            .when(x["period"] != y["period"], F.when(x["period"] < y["period"], -1).otherwise(1)).otherwise(0)
        )

    return F.get(F.array_sort(runs, order), F.lit(0))
