"""From raw workbook rows to typed, keyed readings (B3, B4, B6 and the B chain).

Raw rows are ``file STRING, row INT, cells ARRAY<STRING>`` -- cells by
position, as they sit in the sheet. The reference layout: 8 preamble rows,
then one header row (replaced by fixed names), then date, time and
consumption; any later column is ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.parsing import merge_date_time, parse_number
from meterlake.plans.joins import lookup_join

PREAMBLE_ROWS = 8          # rows skipped before the header row
HEADER_ROWS = 1
READING_NAMES = ("date", "time", "consumption")


def first_three(raw: DataFrame, names: Sequence[str] = READING_NAMES, cells: str = "cells",
                keep: Sequence[str] = ("file", "row")) -> DataFrame:
    """Keep the first ``len(names)`` cells by position under fixed names."""
    kept = [F.col(k) for k in keep if k in raw.columns]
    return raw.select(*kept, *[F.try_element_at(F.col(cells), F.lit(i + 1)).alias(n) for i, n in enumerate(names)])


def data_rows(raw: DataFrame, skip: int = PREAMBLE_ROWS + HEADER_ROWS, cells: str = "cells") -> DataFrame:
    """Drop the preamble and header rows (0-based ``row < skip``), blank rows and file markers (``row = -1``)."""
    first = F.slice(F.col(cells), 1, 3)
    not_blank = F.exists(first, lambda c: c.isNotNull() & (F.trim(c) != ""))
    return raw.filter((F.col("row") >= skip) & not_blank)


def attach_series(df: DataFrame, cpe: str | Column | DataFrame, on: str = "file",
                  name: str = "cpe") -> DataFrame:
    """The meter code of every row.

    A string sets one code on all rows (one file); a Column derives it per row
    (e.g. from the file path); a DataFrame ``(file, cpe)`` maps many files to
    their meters through a size-checked lookup join.
    """
    if isinstance(cpe, str):
        return df.withColumn(name, F.lit(cpe))
    if isinstance(cpe, Column):
        return df.withColumn(name, cpe)
    return lookup_join(df, cpe.select(on, name), on, "left")


def type_readings(rows: DataFrame, thousands: str = ",", decimal: str = ".") -> DataFrame:
    """B1 + B2 on named text cells: ``date_time`` TIMESTAMP_NTZ and ``consumption`` DOUBLE."""
    return rows.select(
        *[c for c in rows.columns if c not in ("date", "time", "consumption")],
        merge_date_time("date", "time").alias("date_time"),
        parse_number("consumption", thousands, decimal).alias("consumption"),
        F.col("date").alias("_date"), F.col("time").alias("_time"),
        F.col("consumption").alias("_consumption"),
    )


def parse_readings(raw: DataFrame, cpe: str | Column | DataFrame,
                   skip: int = PREAMBLE_ROWS + HEADER_ROWS) -> tuple[DataFrame, DataFrame]:
    """The whole parse: rows -> (readings, quarantine).

    readings: ``cpe, date_time, consumption, file, row``; quarantine (``file, row,
    date, time, consumption, reason``) keeps the raw text of every data row whose
    date/time or number did not parse, and one row (``row = -1``) with the error
    of every file that could not be read to its end.
    """
    typed = type_readings(first_three(data_rows(raw, skip)))
    typed = attach_series(typed, cpe)
    ok = F.col("date_time").isNotNull() & F.col("consumption").isNotNull()
    good = typed.filter(ok).select("cpe", "date_time", "consumption", "file", "row")
    why = F.when(F.col("date_time").isNull(), "date or time").otherwise("consumption")
    bad = typed.filter(~ok).select("file", "row", F.col("_date").alias("date"), F.col("_time").alias("time"),
                                   F.col("_consumption").alias("consumption"), why.alias("reason"))
    none = F.lit(None).cast("string")
    unread = raw.filter(F.col("row") < 0).select(
        "file", "row", none.alias("date"), none.alias("time"), none.alias("consumption"),
        F.coalesce(F.try_element_at("cells", F.lit(1)), F.lit("unreadable file")).alias("reason"))
    return good, bad.unionByName(unread)


def key_by_time(readings: DataFrame, key: str = "cpe", ts: str = "date_time") -> DataFrame:
    """The time becomes the row key: columns led by (meter, time), rows
    clustered by them inside each partition (no shuffle; writers range-partition)."""
    rest = [c for c in readings.columns if c not in (key, ts)]
    return readings.select(key, ts, *rest).sortWithinPartitions(key, ts)
