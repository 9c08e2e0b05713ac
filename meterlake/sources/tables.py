"""Typed access to the stored tables and the readings views derived from them.

Column mapping (driver tables standing in for meter data):

* ``events``: ``user_id`` -> meter, ``ts`` -> reading time, ``value`` -> consumption,
  ``event_type`` -> field / status, ``props`` -> JSON settings document.
* ``orders``: ``o_custkey`` -> meter, ``o_orderdate`` -> reading time,
  ``o_totalprice`` -> consumption (seven years, so month selection is real).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.session import ship_package

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one stored table; Catalyst prunes columns and pushes filters into the scan."""
    ship_package(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings view of ``events``: cpe STRING, date_time TIMESTAMP_NTZ, consumption DOUBLE, seq BIGINT.

    ``seq`` (the event id) is kept as a deterministic tie-breaker for equal times.
    """
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("cpe"),
        F.col("ts").alias("date_time"),
        F.col("value").alias("consumption"),
        F.col("event_id").alias("seq"),
    )


def order_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings view of ``orders`` (multi-year)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("cpe"),
        F.col("o_orderdate").alias("date_time"),
        F.col("o_totalprice").alias("consumption"),
        F.col("o_orderkey").alias("seq"),
    )


def meter_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All known meters (one row each): the customer table keyed as ``cpe``."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("cpe"), "c_mktsegment")
