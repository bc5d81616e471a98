"""Inputs shared by registered queries: the fixture tables and silver layers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderlens.operators import silver
from orderlens.sources import fixtures

Query = Callable[[SparkSession, str], DataFrame]


def items(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.order_items(spark, d)


def options(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.order_items_options(spark, d)


def silver_lines(spark: SparkSession, d: str) -> DataFrame:
    return silver.silver_order_items(items(spark, d), options(spark, d), fixtures.order_calendar(spark, d))


def silver_opts(spark: SparkSession, d: str) -> DataFrame:
    return silver.silver_options(options(spark, d))
