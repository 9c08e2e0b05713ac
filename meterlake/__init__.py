"""meterlake: interval-meter readings on Spark.

Parse monthly readings workbooks, key them by meter and UTC time, select
calendar periods, compute per-meter high-water marks, load full (idempotent)
or delta (strictly newer) point sets, keep request/status audit tables, and
run the same delta rule over arriving files with Structured Streaming.
"""

__version__ = "0.1.0"
