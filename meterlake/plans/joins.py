"""Joins against lookup tables whose size is measured before broadcasting.

A lookup (one row per meter, per file, per task) is small for one customer and
large for a national fleet. It is materialised once with a reliable
checkpoint -- the expensive aggregate behind it runs once and its lineage is
cut -- then its exact size is measured on the materialised rows. Under the
limit it is broadcast and the large side is never shuffled; over it, both sides
shuffle on the key and AQE splits skewed partitions of the large side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.session import broadcast_limit, checkpoint_dir

_FIXED = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
    T.LongType: 8, T.FloatType: 4, T.DoubleType: 8, T.TimestampType: 8,
    T.TimestampNTZType: 8, T.DecimalType: 16,
}


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _row_parts(df: DataFrame) -> tuple[int, list[Column]]:
    fixed = 0
    var_cols: list[Column] = []
    for f in df.schema.fields:
        size = next((v for k, v in _FIXED.items() if isinstance(f.dataType, k)), None)
        if size is not None:
            fixed += size
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            var_cols.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)))
        else:
            # nested values: measure their JSON text as an upper-bound proxy
            var_cols.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0)))
    # 16 bytes of row overhead per row, like UnsafeRow's null bitset + header
    return fixed + 16, var_cols


def measure(df: DataFrame) -> tuple[int, int]:
    """Row count and in-memory byte estimate of an (already materialised) frame.

    One pass with a partial aggregate per partition (one row per partition
    reaches the final aggregate): no rows are shuffled. A ``limit`` before the
    aggregate would look cheaper but plans as a single-partition exchange that
    every partition feeds with up to ``limit`` rows -- far worse for a large
    lookup than reading it once.
    """
    per_row, var_cols = _row_parts(df)
    aggs = [F.count(F.lit(1)).alias("n")]
    if var_cols:
        total = var_cols[0]
        for c in var_cols[1:]:
            total = total + c
        aggs.append(F.sum(total).alias("v"))
    row = df.agg(*aggs).first()
    n = int(row["n"])
    var = int(row["v"] or 0) if var_cols else 0
    return n, n * per_row + var


def lookup_join(large: DataFrame, lookup: DataFrame, on, how: str = "left",
                max_bytes: int | None = None, report: dict | None = None,
                materialized: bool = False) -> DataFrame:
    """``large JOIN lookup`` with a size-checked broadcast of ``lookup``.

    ``how`` must keep the large side as the streamed side (inner, left,
    left_semi, left_anti). ``report`` (optional dict) receives the measured size
    and the chosen strategy. ``materialized=True`` skips the checkpoint for a
    lookup that is already a written table (a plain scan).
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti", "leftsemi", "leftanti"):
        raise ValueError(f"lookup_join keeps the large side on the left; got how={how!r}")
    limit = broadcast_limit(large.sparkSession) if max_bytes is None else max_bytes
    small = lookup if materialized else materialize(lookup)
    rows, size = measure(small)
    use_broadcast = size <= limit
    if report is not None:
        report.update(rows=rows, bytes=size, broadcast=use_broadcast)
    right = F.broadcast(small) if use_broadcast else small
    return large.join(right, on, how)
