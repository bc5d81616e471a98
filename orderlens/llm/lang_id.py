"""Language identification by compression.

One zstandard compressor per language, primed with a raw-content dictionary of that
language's text. A text is normalised (lower case, ASCII digits and marks dropped, white
space collapsed), cut into pieces of ``PIECE`` bytes, and every piece is compressed with
each dictionary; the language with the smallest total is chosen. A margin to the second
below ``MIN_MARGIN`` of the total, or below ``MIN_BYTES``, is narrow: the row is
``rejected`` (its language stays the best guess). ``score`` is the chosen language's share
of ``exp(-bytes / SCORE_BYTES)`` over the languages.

Learning: the dictionaries come from a bounded sample of labelled rows, at most
``SAMPLE_ROWS`` rows a language by a hash of id and text, ``SAMPLE_CHARS`` characters of
each, ``DICTIONARY_BYTES`` bytes together. Every labelled language is learned: if there
are so many that their dictionaries would exceed ``TOTAL_BYTES``, each gets an equal share
of it. Prediction reads whole texts and takes time in proportion to the languages.

Edge cases: a null text or one without a letter is ``und`` with score 0; with no labelled
row every text is ``und``; of equal sizes the language with more labelled rows wins, then
the smaller name; null labels teach nothing; equal texts get equal rows; an empty table
gives no rows; extra columns stay, those named like a result are replaced.
"""

from __future__ import annotations

import math

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import as_text, quoted, ship_package, with_results

SAMPLE_ROWS = 400
#: Rows by hash, times SAMPLE_ROWS, from which a language's sample is taken.
CANDIDATES = 16
SAMPLE_CHARS = 1500
DICTIONARY_BYTES = 256 << 10
TOTAL_BYTES = 200 * DICTIONARY_BYTES
#: Languages whose compressors a worker holds at once; of more, it makes them text by text.
HELD = 200
LEVEL = 3
PIECE = 4096
MIN_MARGIN = 0.01
MIN_BYTES = 2
SCORE_BYTES = 4.0
UNKNOWN = "und"

_BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_DROPPED = bytes(b for b in range(128) if not chr(b).isalpha() and chr(b) not in " \t\n\x0b\x0c\r")


def normalised(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(_BLANKS, _DROPPED).split())


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def _compressor(primed: zstandard.ZstdCompressionDict) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False)


class Classifier:
    """Dictionaries by language, in the order of preference for ties."""

    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.dictionaries = dictionaries
        self._primed: list[zstandard.ZstdCompressionDict] | None = None
        self._compressors: list[zstandard.ZstdCompressor] = []

    def __getstate__(self):
        return {"dictionaries": self.dictionaries, "_primed": None, "_compressors": []}

    def sizes(self, text: str) -> list[int]:
        if self._primed is None:
            self._primed = []
            for content in self.dictionaries.values():
                primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                primed.precompute_compress(level=LEVEL)
                self._primed.append(primed)
            if len(self._primed) <= HELD:
                self._compressors = list(map(_compressor, self._primed))
        data = normalised(text)
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self._compressors or map(_compressor, self._primed)]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.dictionaries or not has_letter(text):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(text)
        best = min(sizes)
        share = 1 / sum(math.exp((best - s) / SCORE_BYTES) for s in sizes)
        others = sorted(sizes)[1:]
        margin = others[0] - best if others else math.inf
        return list(self.dictionaries)[sizes.index(best)], share, margin < max(MIN_BYTES, MIN_MARGIN * best)


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Classifier:
    """Dictionaries from the labelled rows."""
    rows = labelled.filter(quoted(lang_col).isNotNull()).select(
        quoted(lang_col).cast("string").alias("lang"), F.xxhash64(quoted(id_col), as_text(quoted(text_col))).alias("place"),
        F.substring(as_text(quoted(text_col)), 1, SAMPLE_CHARS).alias("text"),
    )
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    share = max(1, min(DICTIONARY_BYTES, TOTAL_BYTES // max(1, len(counts))))
    # the rows with the smallest hashes, about CANDIDATES times as many as are wanted: what
    # reaches a language's task is bounded, however many rows and input tasks there are
    bars = [(r["lang"], 2.0**63 * min(2 * CANDIDATES * SAMPLE_ROWS / r["count"] - 1, 1.0)) for r in counts]
    bars = rows.sparkSession.createDataFrame(bars, "lang string, bar double")
    rows = rows.join(F.broadcast(bars), "lang").filter(F.col("place").cast("double") <= F.col("bar")).drop("bar")
    first = Window.partitionBy("lang").orderBy("place", "text")
    sample = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= SAMPLE_ROWS)
    # rows after those that fill the share are not collected; what normalising drops from
    # a text does not count
    left = F.length(F.regexp_replace("text", r"[\x00-@\[-`{-\x7F]+", ""))
    before = F.sum(left).over(first.rowsBetween(Window.unboundedPreceding, -1))
    sample = sample.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < share)
    texts: dict[str, list[tuple[int, str]]] = {r["lang"]: [] for r in counts}
    for r in sample.select("lang", "n", "text").collect():
        texts[r["lang"]].append((r["n"], r["text"]))
    joined = {lang: b" ".join(normalised(t) for _, t in sorted(found))[:share] for lang, found in texts.items()}
    return Classifier({lang: content for lang, content in joined.items() if content})


_RESULT = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
)


def identify(docs: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``."""
    ship_package(docs.sparkSession)

    @F.arrow_udf(_RESULT)
    def predict(texts: pa.Array) -> pa.Array:
        found = [model.predict(t.as_py()) for t in texts]
        langs, scores, rejected = zip(*found) if found else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], names=_RESULT.names
        )

    out = docs.select("*", predict(quoted(text_col).cast("string")).alias("__lang"))
    return with_results(out, {n: F.col("__lang")[n] for n in _RESULT.names}).drop("__lang")


def held_out(id_col: Column) -> Column:
    """Rows that a model must not learn from: crc32 of the id's text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))
