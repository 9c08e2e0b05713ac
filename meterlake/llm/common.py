"""Shared helpers of the training-data operators."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.session import scratch_path

# Whitespace that separates words: space and the ASCII controls \x09 to \x0D.
SPACES = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One stored table, by whatever path Spark can open."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, batch: int | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    Cuts the lineage: a lost executor never repeats the work behind the table,
    and each later reader sees the same rows. ``batch``: rows of an Arrow batch;
    ``codec``: how the files are packed (None: as the session says).
    """
    path = scratch_path(df.sparkSession, name)
    with _shuffles_dropped(df.sparkSession), batches_of(df.sparkSession, batch):
        df.write.parquet(path, compression=codec)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote, once all that was made of them is written too."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.stored_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Within, each finished action drops its shuffle files, as nothing reads them again."""
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


@contextmanager
def batches_of(spark: SparkSession, rows: int | None):
    """Within, Arrow batches hold at most ``rows`` rows (None: as the session says)."""
    if rows is None:
        yield
        return
    with _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows)):
        yield


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order (null: none)."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(spaced, " "), "")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def doc_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, as ``doc_id`` and ``text``: extra columns cannot clash."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def numbered(df: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """``df`` with its place in ``order`` as ``rank`` (from 0, all different), and the number of rows.

    A range sort deals the rows out, so equal leading keys may be split; each
    sorted partition numbers its own rows, and the counts of the partitions --
    one row each -- give what comes before them.
    """
    ordered = df.orderBy(*order)
    placed = stored(ordered.select("*", F.spark_partition_id().alias("__part"),
                                   F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__at")), name)
    counts = {r["__part"]: r["n"] for r in placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for part in sorted(counts):
        starts.append((part, total))
        total += counts[part]
    before = df.sparkSession.createDataFrame(starts, "__part int, __before long")
    ranked = placed.join(F.broadcast(before), "__part")
    return ranked.select(*df.columns, (F.col("__before") + F.col("__at")).alias("rank")), total
