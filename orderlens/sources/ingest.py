"""Raw text -> typed tables (S9-S12, S16) and the raw CSV reader.

Typed loads fail loudly by default, as a database ``CONVERT`` does: a bad date,
number, time or an over-long text raises. ``strict=False`` turns bad values into
nulls instead and leaves texts whole; ``quarantine`` parts good rows from bad ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType, IntegerType, LongType, StringType, StructField, StructType

from orderlens.functions.columns import WHITE, stripped
from orderlens.schemas import (
    DATE_DIM_WIDTHS,
    EXPECTED_COLUMNS,
    NA_TOKENS,
    OPTION_WIDTHS,
    ORDER_ITEM_WIDTHS,
    TYPED_SCHEMAS,
)

C = F.col
INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"

# Text formats of the sources.
DATE_KEY_FORMAT = "d-M-yyyy"  # DD-MM-YYYY, one-digit day/month accepted
# A date and a time of day, with or without fraction and zone (Z or an offset).
TIMESTAMP_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?\s*(Z|[+-]\d{2}:?\d{2})?$"
ZONE_TEXT = r"\s*(Z|[+-]\d{2}:?\d{2})$"


# S1 -------------------------------------------------------------------------
class ColumnMismatch(ValueError):
    """A raw file's header is not the expected one."""


def column_differences(actual: list[str], table: str) -> tuple[list[str], list[str]]:
    """(missing, unexpected) columns of a header, in order."""
    expected = EXPECTED_COLUMNS[table]
    return [c for c in expected if c not in actual], [c for c in actual if c not in expected]


def read_raw_csv(spark: SparkSession, path: str, table: str, columns: str = "strict") -> DataFrame:
    """Read raw CSV files of one table as text, numbering records per file.

    Columns go by the header's names, in any order. ``columns="strict"`` raises
    ``ColumnMismatch`` when columns are missing or unexpected; ``columns="report"``
    returns the file's own columns, for the quality report to list the
    differences. All files must have the same header; a file with another one, a
    record with too few or too many fields, and a quote that is never closed fail
    the read with the file and row.

    Every column is a string; the tokens NULL null NA N/A NaN nan become
    null, blanks stay blank. ``source_row`` is the record's row in its file
    counting the header as row 1 (the first record is row 2); empty lines do
    not count.

    Quoted values may hold line breaks (records end in LF or CR LF). Files are read
    as lines all the same, so that big ones are split across many tasks; ``_records``
    says how lines become records."""
    if columns not in ("strict", "report"):
        raise ValueError(f"columns is strict or report, not {columns}")
    header = [c.lstrip("\ufeff") for c in spark.read.option("header", True).option("escape", '"').csv(path).columns]
    missing, unexpected = column_differences(header, table)
    if columns == "strict" and (missing or unexpected):
        raise ColumnMismatch(f"{table}: missing columns {missing}, unexpected columns {unexpected}")
    fields = [StructField(f"f{i}", StringType()) for i in range(len(header))]
    records = _parsed(_records(spark, path), fields)
    where = F.concat(C("_file"), F.lit(" row "), C("source_row").cast("string"))
    is_header = C("source_row") == 1
    same = F.lit(True)
    for i, name in enumerate(header):
        own = F.regexp_replace(C(f"r.f{i}"), "^\ufeff", "") if i == 0 else C(f"r.f{i}")
        same = same & own.eqNullSafe(F.lit(name))
    fault = (
        F.when(C("_unclosed"), F.raise_error(F.concat(F.lit("a quote is never closed: "), C("_file"))))
        .when(C("_bad"), F.raise_error(F.concat(F.lit("not one whole record: "), where)))
        .when(is_header & ~same, F.raise_error(F.concat(F.lit("another header: "), where)))
    )
    # the check is a filter that every row passes or fails the job on
    checked = records.filter(fault.cast("string").isNull() & ~is_header)
    kept = header if columns == "report" else EXPECTED_COLUMNS[table]
    out = []
    for c in kept:
        value = C(f"r.f{header.index(c)}")
        out.append(F.when(value.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(value).alias(c))
    return checked.select("source_row", *out)


_LINE = StructType(
    [StructField("value", StringType()), StructField("_file", StringType()), StructField("_block", LongType()),
     StructField("_line", LongType()), StructField("_odd", BooleanType()), StructField("_blank", BooleanType()),
     StructField("_inside", BooleanType()), StructField("_ends0", LongType()), StructField("_ends1", LongType())]
)


def _counted_lines(lines: DataFrame) -> DataFrame:
    """Lines (value, _file, _block, in file order within a split) with running counts of
    their split, as if the split began outside a quoted value:

    - ``_line``: its number; ``_odd``: it has an odd number of quotes;
    - ``_inside``: it begins inside a quoted value;
    - ``_ends0``: records that end before it. ``_ends1``: the same if the split began inside
      a quoted value, when every state is the opposite.

    A running count over a split as it is read has no built-in form without a shuffle of
    all lines, so this step is Arrow batches and numpy."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, state, totals, number = None, 0, [0, 0], 0
        for batch in batches:
            files, blocks = batch.column(1).dictionary_encode(), batch.column(2).to_numpy()
            code = files.indices.to_numpy()
            edges = np.flatnonzero((code[1:] != code[:-1]) | (blocks[1:] != blocks[:-1])) + 1
            for lo, hi in zip([0, *edges], [*edges, batch.num_rows]):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                here = (part.column(1)[0].as_py(), part.column(2)[0].as_py())
                if here != split:
                    split, state, totals, number = here, 0, [0, 0], 0
                odd = pc.count_substring(part.column(0), '"').to_numpy() % 2
                blank = ~pc.match_substring_regex(part.column(0), r"[^ \t\r\f\v]").to_numpy(zero_copy_only=False)
                after = (np.cumsum(odd) + state) % 2
                before = after ^ odd
                ends = []
                for s in (0, 1):
                    end = (after == s) & ~(blank & (before == s))
                    running = np.cumsum(end) + totals[s]
                    ends.append(running - end)
                    totals[s] = int(running[-1])
                columns = [
                    *part.columns, pa.array(np.arange(number, number + len(odd))), pa.array(odd == 1), pa.array(blank),
                    pa.array(before == 1), *(pa.array(e.astype(np.int64)) for e in ends),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=_LINE.names)
                state, number = int(after[-1]), number + len(odd)

    return lines.mapInArrow(count, _LINE)


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(text, _file, source_row, _unclosed): the records of CSV files, numbered from 1 per file.

    1. One row per input split: its quote parity, and how many records end in it from
       either state at its start.
    2. Prefix sums over a file's splits give the state at the start of each, and how many
       records end before it. A split is one row of about 50 bytes here, a millionth of
       its lines, so this table is broadcast.
    3. A line's record number is that of the records that end before it, plus one; so the
       lines of a record have one number even where it straddles splits. A record of one
       line is passed on as it is; only lines of longer records are shuffled, by their
       number, and joined. Without such records that branch has an empty join side and
       adaptive execution drops it."""
    text = spark.read.option("lineSep", "\n").text(path)
    lines = _counted_lines(text.select("value", C("_metadata.file_path").alias("_file"), C("_metadata.file_block_start").alias("_block")))
    one = lambda c: F.when(c, 1).otherwise(0)
    after = C("_inside") != C("_odd")
    splits = lines.groupBy(F.xxhash64("_file").alias("_f"), "_block").agg(
        F.sum(one(C("_odd"))).alias("_quotes"),
        F.sum(one(~after & (C("_inside") | ~C("_blank")))).alias("_n0"),
        F.sum(one(after & (~C("_inside") | ~C("_blank")))).alias("_n1"),
    )
    file, earlier = Window.partitionBy("_f"), Window.partitionBy("_f").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    started = splits.withColumn("_begins", F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2 == 1).withColumn(
        "_unclosed", F.sum("_quotes").over(file) % 2 == 1
    )
    ended = F.when(C("_begins"), C("_n1")).otherwise(C("_n0"))
    started = started.withColumn("_before", F.coalesce(F.sum(ended).over(earlier), F.lit(0)))
    starts = started.select("_f", C("_block").alias("_b"), "_begins", "_before", "_unclosed", (C("_begins") | (C("_quotes") > 0)).alias("_long"))

    def numbered(some: DataFrame) -> DataFrame:
        placed = lines.join(F.broadcast(some), (F.xxhash64("_file") == C("_f")) & (C("_block") == C("_b")))
        ends = F.when(C("_begins"), C("_ends1")).otherwise(C("_ends0"))
        inside = C("_inside") != C("_begins")
        whole = ~inside & ~C("_odd")
        return placed.withColumn("source_row", C("_before") + ends + 1).withColumn("_whole", whole)

    single = numbered(starts).filter(C("_whole") & ~C("_blank")).select(C("value").alias("text"), "_file", "source_row", "_unclosed")
    parts = numbered(starts.filter("_long")).filter(~C("_whole")).groupBy("_file", "source_row", "_unclosed").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_line", "value"))).alias("lines")
    )
    joined = parts.select(F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("text"), "_file", "source_row", "_unclosed")
    return single.unionByName(joined)


def _parsed(records: DataFrame, fields: list[StructField]) -> DataFrame:
    """Records with their fields (r); ``_bad``: another number of fields, or a bare CR
    outside quotes (which would end a record)."""
    schema = StructType([*fields, StructField("_corrupt", StringType())])
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "multiLine": "true"}
    text = F.regexp_replace("text", "\r$", "")
    parsed = F.from_csv(text, schema.simpleString()[len("struct<"):-1].replace(":", " "), options)
    bare = text.contains("\r") & F.regexp_replace(text, '"[^"]*"', "").contains("\r")
    return records.withColumn("r", parsed).withColumn("_bad", bare | C("r._corrupt").isNotNull())


# helpers --------------------------------------------------------------------
def _text(c: str, width: int, strict: bool) -> Column:
    """The text as it is: cutting a key would merge orders. Strictly, one longer than
    its landing width is an error."""
    if not strict:
        return C(c)
    return F.when(F.length(C(c)) > width, F.raise_error(F.lit(f"{c} is longer than {width}"))).otherwise(C(c))


def _flag(c: str) -> Column:
    """TRUE/FALSE text (any case) -> boolean; anything else -> null."""
    u = F.upper(C(c))
    return F.when(u == "TRUE", F.lit(True)).when(u == "FALSE", F.lit(False))


def _to_int(c: str, strict: bool) -> Column:
    if strict:
        return C(c).cast(IntegerType())
    return F.when(C(c).rlike(INT_TEXT), C(c).try_cast(IntegerType()))


def _to_decimal(c: str, strict: bool) -> Column:
    t = DecimalType(10, 2)
    return C(c).cast(t) if strict else C(c).try_cast(t)


def is_timestamp(c: str) -> Column:
    """Whether ``utc_timestamp`` has a value: the text has the form, and its local part is a
    time. The text is searched once for the form and once for the zone."""
    local = F.regexp_replace(F.regexp_extract(C(c), rf"^[{WHITE}]*({TIMESTAMP_TEXT.strip('^$')})[{WHITE}]*$", 1), ZONE_TEXT, "")
    return F.coalesce(local.try_cast("timestamp_ntz").isNotNull(), F.lit(False))


def utc_timestamp(c: str) -> Column:
    """ISO-8601 text with a date and a time (``T`` or space, optional seconds,
    fraction, ``Z`` or offset) -> timestamp without zone holding UTC wall-clock
    time; null for any other text."""
    text = stripped(c)
    zone = F.replace(F.regexp_extract(text, ZONE_TEXT, 1), F.lit(":"), F.lit(""))
    local = F.regexp_replace(text, ZONE_TEXT, "").try_cast("timestamp_ntz")
    minutes = F.when(
        F.length(zone) == 5,
        F.concat(F.substring(zone, 1, 1), F.lit("1")).cast("int")
        * (F.substring(zone, 2, 2).cast("int") * 60 + F.substring(zone, 4, 2).cast("int")),
    ).otherwise(F.lit(0))
    return F.when(text.rlike(TIMESTAMP_TEXT), local - F.make_dt_interval(F.lit(0), F.lit(0), minutes, F.lit(0)))


def _to_timestamp(c: str, strict: bool) -> Column:
    value = utc_timestamp(c)
    if not strict:
        return value
    bad = C(c).isNotNull() & value.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit(f"{c} is no timestamp: "), C(c)))).otherwise(value)


def conform_typed(df: DataFrame, table: str) -> DataFrame:
    """The landing contract, enforced: names, order and types must be those
    declared."""
    declared = TYPED_SCHEMAS[table]
    actual = [(f.name, f.dataType) for f in df.schema.fields]
    if actual != [(f.name, f.dataType) for f in declared.fields]:
        raise ValueError(f"{table} does not meet its landing contract: {df.schema.simpleString()}")
    return df


def quarantine(raw: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(typed good rows, raw bad rows): bad are rows with a value that the strict load
    would fail on."""
    lenient = {"date_dim": ingest_date_dim, "order_items": ingest_order_items, "order_item_options": ingest_options}[table]
    widths = {"date_dim": DATE_DIM_WIDTHS, "order_items": ORDER_ITEM_WIDTHS, "order_item_options": OPTION_WIDTHS}[table]
    typed = lenient(raw, strict=False)
    flags = {"is_weekend", "is_holiday", "IS_LOYALTY"}  # any other text is null there, strictly too
    bad = F.lit(False)
    for f, expr in zip(typed.schema.fields, _typed_columns(raw, table, strict=False)):
        if f.name in widths:
            bad = bad | F.coalesce(F.length(C(f.name)) > widths[f.name], F.lit(False))
        elif f.name not in flags:
            bad = bad | (C(f.name).isNotNull() & expr.isNull())
    marked = raw.withColumn("__bad", bad)
    return lenient(marked.filter(~C("__bad")).drop("__bad"), strict=False), marked.filter("__bad").drop("__bad")


# S9-S11 ---------------------------------------------------------------------
def _typed_columns(raw: DataFrame, table: str, strict: bool) -> list[Column]:
    """The typed columns of a table, in contract order."""
    widths = {"date_dim": DATE_DIM_WIDTHS, "order_items": ORDER_ITEM_WIDTHS, "order_item_options": OPTION_WIDTHS}[table]
    by_type = {
        "boolean": lambda c: _flag(c),
        "int": lambda c: _to_int(c, strict),
        "decimal(10,2)": lambda c: _to_decimal(c, strict),
        "timestamp_ntz": lambda c: _to_timestamp(c, strict),
        "date": lambda c: F.to_date(C(c), DATE_KEY_FORMAT) if strict else F.try_to_date(C(c), DATE_KEY_FORMAT),
        "string": lambda c: _text(c, widths[c], strict),
    }
    return [by_type[f.dataType.simpleString()](f.name).alias(f.name) for f in TYPED_SCHEMAS[table].fields]


def ingest_date_dim(raw: DataFrame, strict: bool = True) -> DataFrame:
    """DD-MM-YYYY -> date, numbers -> int, TRUE/FALSE -> boolean."""
    return conform_typed(raw.select(*_typed_columns(raw, "date_dim", strict)), "date_dim")


def ingest_order_items(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Typed order lines."""
    return conform_typed(raw.select(*_typed_columns(raw, "order_items", strict)), "order_items")


def ingest_options(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Typed options."""
    return conform_typed(raw.select(*_typed_columns(raw, "order_item_options", strict)), "order_item_options")


# S12 ------------------------------------------------------------------------
def preview_conversion(raw_items: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows (by source row) with raw and converted time
    and loyalty flag side by side. The limit is the feature (a preview); Spark
    plans it as a per-partition top-n then a final top-n."""
    return (
        raw_items.select(
            "source_row",
            "CREATION_TIME_UTC",
            utc_timestamp("CREATION_TIME_UTC").alias("converted_creation_time"),
            "IS_LOYALTY",
            F.when(C("IS_LOYALTY") == "TRUE", F.lit(1))
            .when(C("IS_LOYALTY") == "FALSE", F.lit(0))
            .alias("converted_is_loyalty"),
        )
        .orderBy("source_row")
        .limit(n)
    )


# S16 ------------------------------------------------------------------------
def describe_schema(spark: SparkSession, df: DataFrame, widths: dict[str, int] | None = None) -> DataFrame:
    """One row per column: position, name, type, maximum text length
    (the declared landing width for text columns; Spark strings carry none).
    Built from the frame's schema (metadata, one row per column)."""
    widths = widths or {}
    rows = [
        (i + 1, f.name, f.dataType.simpleString(),
         widths.get(f.name) if isinstance(f.dataType, StringType) else None)
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(
        rows, "ordinal_position int, column_name string, data_type string, character_maximum_length int"
    )


def text_length(c: str | Column) -> Column:
    """T-SQL LEN: length without trailing blanks."""
    col = C(c) if isinstance(c, str) else c
    return F.length(F.rtrim(col))


__all__ = [
    "ColumnMismatch",
    "column_differences",
    "conform_typed",
    "describe_schema",
    "ingest_date_dim",
    "ingest_options",
    "ingest_order_items",
    "preview_conversion",
    "quarantine",
    "read_raw_csv",
    "text_length",
    "utc_timestamp",
]
