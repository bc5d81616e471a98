"""Streaming.

The workload has no unbounded source: no stream, watermark, trigger or state
appears in it (the daily lifetime-value snapshot is the batch gold dataset
``customer_ltv_daily``). Nothing is built here; see README.
"""
