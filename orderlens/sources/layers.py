"""Bronze / silver / gold Parquet layers, registered gold tables, report output
(S2-S6, S14, S15).

A published layer is a folder with one pointer file, ``_current``. It names the versions
that each table consists of; a version is a folder that is written once and never changed:

    base/_current                                    the pointer
    base/_data/<table>/version=<v>/part-...          one write of a table
    base/_data/<table>/version=<v>/ORDER_MONTH=<m>/  ... of a partitioned table

Publishing replaces the pointer by one rename, whatever the number of tables: readers see
all of a run or nothing of it. A partitioned table may consist of several versions, each
with the months that are current in it, so a run can replace the months that it touches, or
add rows, without rewriting the others. Read a layer with ``read_layer``.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlens.schemas import GOLD_COMMENTS, GOLD_SCHEMAS

# Folder names per layer (fixed values).
BRONZE_TABLES = {"order_items": "order_items", "options": "order_items_options", "date_dim": "date_dim"}
SILVER_TABLES = {"order_items": "order_items", "options": "order_item_options", "date_dim": "date_dim"}

#: The partition column of tables by month: the month's first day; null for rows without
#: a date.
MONTH = "ORDER_MONTH"

_POINTER = "_current"
#: Versions of a table: by version the current partition values, or None for all rows.
Versions = dict[str, list[str | None] | None]


def layer_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


class _Files:
    """The few file system operations of a layer, by Hadoop's API."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.jvm = spark._jvm  # noqa: SLF001
        self.gateway = spark.sparkContext._gateway  # noqa: SLF001
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()  # noqa: SLF001
        self.fs = self.path(base).getFileSystem(self.conf)

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)

    def names(self, path: str) -> list[str]:
        where = self.path(path)
        return [s.getPath().getName() for s in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def read(self, path: str) -> str | None:
        where = self.path(path)
        if not self.fs.exists(where):
            return None
        stream = self.fs.open(where)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def replace(self, path: str, text: str) -> None:
        """Write a small file aside and rename it over the old one in one step."""
        aside = f"{path}-{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(aside), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        where = self.fs.makeQualified(self.path(path))
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), self.conf)
        context.rename(self.fs.makeQualified(self.path(aside)), where, how)


def _pointer(files: _Files, base: str) -> dict:
    text = files.read(f"{base}/{_POINTER}")
    return json.loads(text) if text else {"run": None, "tables": {}, "schemas": {}, "superseded": []}


def versions(spark: SparkSession, base: str) -> dict[str, Versions]:
    """The published tables of a layer and the versions that each consists of."""
    base = base.rstrip("/")
    return _pointer(_Files(spark, base), base)["tables"]


def _data(base: str, table: str, version: str | None = None) -> str:
    return f"{base}/_data/{table}" + (f"/version={version}" if version else "")


def _read(spark: SparkSession, base: str, table: str, parts: Versions, schema: str) -> DataFrame:
    roots = [_data(base, table, v) for v in parts]
    df = spark.read.schema(StructType.fromJson(json.loads(schema))).option("basePath", _data(base, table)).parquet(*roots)
    current = []
    for version, months in parts.items():
        here = F.col("version") == version
        if months is not None:
            known = [F.lit(m).cast(df.schema[MONTH].dataType) for m in months if m is not None]
            of = F.col(MONTH).isin(known) if known else F.lit(False)
            here = here & (of | F.col(MONTH).isNull() if None in months else of)
        current.append(here)
    if len(current) > 1:  # a pure filter on partition columns: the files of others are not read
        df = df.filter(reduce(lambda a, b: a | b, current))
    return df.drop("version")


def read_layer(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Scan one dataset of a layer (schema as stored, with the partition column if it
    has one): what the pointer names, or a plain folder where there is none."""
    base = base.rstrip("/")
    pointer = _pointer(_Files(spark, base), base)
    parts = pointer["tables"].get(table)
    if parts is None:
        return spark.read.parquet(layer_path(base, table))
    return _read(spark, base, table, parts, pointer["schemas"][table])


def stored_row_counts(spark: SparkSession, base: str) -> DataFrame:
    """C4 for stored tables: (table_name, row_count) from the files' footers."""
    counts = [
        read_layer(spark, base, t).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t in versions(spark, base)
    ]
    return reduce(DataFrame.unionByName, counts)


class Staged:
    """Datasets written into a layer, not yet part of it.

    ``write`` makes a new version of a table; ``publish`` makes all of them current at once.
    A failure before or in ``publish`` leaves the layer as it was; leaving the ``with``
    block clears what was not published. The versions that a run supersedes stay until the
    next run has published, for readers that have begun."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")
        self.files = _Files(spark, self.base)
        self.before = _pointer(self.files, self.base)
        self.version = uuid.uuid4().hex[:16]
        self.folder = f"{self.base}/_staged/{self.version}"  # scratch of the run
        self.written: dict[str, Versions] = {}
        self.schemas: dict[str, str] = {}
        self.begun: list[str] = []

    def __enter__(self) -> Staged:
        return self

    def __exit__(self, *error: object) -> None:
        self.files.delete(self.folder)
        for table in self.begun:
            self.files.delete(self.path(table))

    def path(self, table: str) -> str:
        return _data(self.base, table, self.version)

    def write(self, df: DataFrame, table: str, by_month: bool = False, mode: str = "overwrite", fmt: str = "parquet") -> None:
        """A new version of a table. ``by_month``: partitioned by the column ORDER_MONTH.
        ``mode``: overwrite replaces all rows, ``touched`` the months that ``df`` has rows
        in, append adds the rows to those that are there."""
        self.begun.append(table)
        if by_month:
            # few files a month: shuffled by month, big months split and small ones joined
            # at run time
            df = df.hint("rebalance", MONTH)
        writer = df.write.partitionBy(MONTH) if by_month else df.write
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(self.path(table))
        mine: list[str | None] | None = None
        if by_month:
            folders = [n.partition("=")[2] for n in self.files.names(self.path(table)) if n.startswith(f"{MONTH}=")]
            mine = sorted((None if m.startswith("__") else m for m in folders), key=str)
        old: Versions = self.before["tables"].get(table, {}) if mode in ("append", "touched") else {}
        if mode == "touched":
            if mine is None or any(m is None for m in old.values()):
                raise ValueError(f"{table} is not partitioned by month")
            old = {v: left for v, months in old.items() if (left := [m for m in months if m not in mine])}
        added = {self.version: mine} if mine != [] else {}
        self.written[table] = {**old, **added} or {self.version: []}
        self.schemas[table] = df.schema.json()

    def read(self, table: str) -> DataFrame:
        """A table as it will be."""
        return _read(self.spark, self.base, table, self.written[table], self.schemas[table])

    def publish(self) -> None:
        """Make the written versions current, all at once."""
        now = _pointer(self.files, self.base)
        if now["run"] != self.before["run"]:
            raise RuntimeError(f"{self.base} was published by another run meanwhile")
        tables = {**now["tables"], **self.written}
        gone = [
            _data(self.base, t, v) for t, parts in now["tables"].items() for v in parts if v not in tables[t]
        ]
        pointer = {"run": self.version, "tables": tables, "schemas": {**now["schemas"], **self.schemas}, "superseded": gone}
        self.files.replace(f"{self.base}/{_POINTER}", json.dumps(pointer, indent=1))
        self.begun = []
        for folder in now["superseded"]:
            self.files.delete(folder)


def write_layer(df: DataFrame, base: str, table: str, mode: str = "overwrite", by_month: bool = False) -> None:
    """Write one dataset of a layer (modes as ``Staged.write``). A write that fails
    leaves the earlier rows readable."""
    with Staged(df.sparkSession, base) as staged:
        staged.write(df, table, by_month, mode)
        staged.publish()


def table_folder(spark: SparkSession, base: str, table: str) -> str:
    """The folder of a published table that is one version."""
    parts = versions(spark, base)[table]
    if len(parts) > 1:
        raise ValueError(f"{table} consists of {len(parts)} versions; use read_layer")
    return _data(base.rstrip("/"), table, next(iter(parts)))


def register_gold(spark: SparkSession, base: str, database: str = "gold") -> list[str]:
    """Register every gold dataset with its contract's columns and comment: an external
    Parquet table, or, for one by month, a view of its current months. Reading through them
    enforces the contract types, so gold must be written through ``gold.conform``. Register
    again after each publication (the job does)."""
    base = base.rstrip("/")
    current = versions(spark, base)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for table, schema in GOLD_SCHEMAS.items():
        name, parts = f"{database}.{table}", current.get(table, {})
        comment = GOLD_COMMENTS[table].replace("'", "\\'")
        kind = "VIEW" if any(m is not None for m in parts.values()) else "TABLE"
        if spark.catalog.tableExists(name):
            old = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
            if old != kind or kind == "TABLE":
                spark.sql(f"DROP {old} {name}")
        if kind == "TABLE":
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            where = table_folder(spark, base, table) if parts else layer_path(base, table)
            spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet LOCATION '{where}' COMMENT '{comment}'")
        else:
            cols = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
            selects = []
            for version, months in parts.items():
                listed = ", ".join(f"DATE '{m}'" for m in months if m is not None)
                tests = [f"{MONTH} IN ({listed})"] * bool(listed) + [f"{MONTH} IS NULL"] * (None in months) or ["false"]
                selects.append(f"SELECT {cols} FROM parquet.`{_data(base, table, version)}` WHERE {' OR '.join(tests)}")
            spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT '{comment}' AS {' UNION ALL '.join(selects)}")
        names.append(name)
    return names


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a registered table (data at its location is kept)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Select all of a registered table."""
    return spark.table(name)


def write_report(frames: dict[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    """One folder per report dataset (Parquet, or CSV with a header), published
    together: a report that fails half way leaves the earlier one as it was. Returns the
    folders."""
    spark = next(iter(frames.values())).sparkSession
    with Staged(spark, base) as staged:
        for name, df in frames.items():
            staged.write(df, name, fmt=fmt)
        staged.publish()
        return {name: staged.path(name) for name in frames}
