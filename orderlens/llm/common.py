"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.session import checkpoint_dir


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this library importable in Python workers, once per application, by
    Spark's own file distribution (``addPyFile``)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="package-")
    archive = os.path.join(folder, "package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path, _, names in sorted(os.walk(top)):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(path, name)
                out.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_results(df: DataFrame, results: dict[str, Column]) -> DataFrame:
    """All columns of ``df`` plus ``results``. A result replaces an input column
    of the same name (compared without case, as Spark resolves names)."""
    taken = {name.lower() for name in results}
    kept = [quoted(c) for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[col.alias(name) for name, col in results.items()])


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame) -> DataFrame:
    """One struct column ``row`` with every input column, so that an operator's
    working columns can never clash with them. Undo with ``select("row.*")``."""
    return df.select(F.struct(*[quoted(c) for c in df.columns]).alias("row"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with an eager reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Spark settings for the writing job: it frees its shuffle files at its end (they are
#: made again from the lineage should anything still need them).
_WHILE_STORING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Rows a batch that Python workers get meanwhile: few enough for batches of long texts.
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, batch_rows: int = 2000) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back:
    cuts the lineage, and a later job reads the columns that it needs. The shuffle files
    of the writing job are freed at its end, so that the steps of an operator do not add
    up on disk. The folder belongs to the application, as its checkpoints do."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4()}"
    settings = _WHILE_STORING | {_BATCH_ROWS: str(batch_rows)}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        df.write.parquet(path)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(path)


def as_text(col: Column) -> Column:
    """Null texts count as empty ones."""
    return F.coalesce(col.cast(T.StringType()), F.lit(""))


def partitions_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Shuffle partitions for ``rows`` rows at about ``rows_each`` per task, and no
    fewer than the session asks for."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_each))
