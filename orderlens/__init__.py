"""orderlens: restaurant order analytics as Spark DataFrame jobs.

Layout
------
``sources``    readers and writers: raw CSV, bronze/silver/gold Parquet layers,
               typed ingest, and the test-table recipe (``sources.fixtures``).
``functions``  reusable Column expressions (revenue, dayparts, missing-value
               predicate, week start, ...) and the distributed row numbering.
``operators``  DataFrame -> DataFrame building blocks: silver, gold, checks,
               business metrics, data-quality rules, profiling.
``plans``      end-to-end jobs (bronze->silver, silver->gold, quality report),
               the query registry and the DuckDB oracle SQL.
``streaming``  nothing: every input of the workload is a bounded batch.
"""

__all__ = ["functions", "operators", "plans", "sources"]
