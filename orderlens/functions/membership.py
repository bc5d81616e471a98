"""Membership filters: rows whose key may be in a set, without shuffling the rows.

The keys' hashes make a bitmap, built by Spark's bitmap aggregate and cut into pieces of
``PIECE`` bits. The pieces are broadcast: at most ``2**bits`` bits whatever the number of
keys (2 MB for 24). Rows of keys in the set always pass; others pass as often as the bitmap
is full, so an exact step has to follow. With far more keys than bits all rows pass, and
the exact step does the whole work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24
PIECE = 32768  # the bits of one bitmap of Spark's bitmap functions


def key_hash(columns: list[Column], salt: int = 0) -> Column:
    """64-bit hash of several values; nulls are values (xxhash64 passes them over)."""
    return F.xxhash64(F.lit(salt), *columns, *[c.isNull() for c in columns])


def _piece(place: str) -> Column:
    """The number of a bit's piece, never null for a hash. A division might be null for what
    Spark knows: it would test the join key for null below all that makes the row, and so
    compute the row and its hash twice."""
    return F.shiftright(F.col(place), PIECE.bit_length() - 1)


def may_be_in(df: DataFrame, hashed: Column, keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """Rows of ``df`` whose 64-bit hash may be in the column ``key`` of ``keys``."""
    place = F.col(key).bitwiseAND(F.lit((1 << bits) - 1))
    pieces = keys.select(place.alias("__place")).groupBy(_piece("__place").alias("__piece")).agg(
        F.bitmap_construct_agg(F.col("__place") % PIECE).alias("__bits")
    )
    marked = df.withColumn("__own", hashed.bitwiseAND(F.lit((1 << bits) - 1)))
    joined = marked.join(F.broadcast(pieces), _piece("__own") == F.col("__piece"))
    # the byte that holds the bit, as a number
    byte = F.ascii(F.decode(F.expr(f"substring(__bits, cast(__own % {PIECE} as int) div 8 + 1, 1)"), "ISO-8859-1"))
    held = F.expr("shiftright(__byte, cast(__own % 8 as int)) & 1 = 1")
    return joined.withColumn("__byte", byte).filter(held).select(*[F.col(f"`{c}`") for c in df.columns])
