"""Sharding along a Hilbert curve over document metadata.

Language, source and size are each cut into 32 cells; documents are ordered by
the Hilbert index of their cell (then by id), and the order is cut into runs of
equal length. Documents that are close in all three dimensions share shards, so
a filter on any of them skips files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import bind, numbered, stored

BITS = 5
DIMENSIONS = ("lang", "source", "size")
ORDER = ("curve", "doc_id", "text_crc32", "size")


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Index of a cell on the Hilbert curve (transpose method: undo, Gray code, interleave)."""
    n = len(cells)

    def undo(i, q):
        def step(x):
            hit = x[i].bitwiseAND(F.lit(q)) != 0
            swap = x[0].bitwiseXOR(x[i]).bitwiseAND(F.lit(q - 1))
            first = F.when(hit, x[0].bitwiseXOR(F.lit(q - 1))).otherwise(x[0].bitwiseXOR(swap))
            other = F.when(hit, x[i]).otherwise(x[i].bitwiseXOR(swap))
            return F.array(first, *[other if k == i else x[k] for k in range(1, n)])
        return step

    def gray(x):
        out = [x[0]]
        for k in range(1, n):
            out.append(x[k].bitwiseXOR(out[-1]))
        return F.array(*out)

    def settle(x):
        flips = F.lit(0)
        for b in range(bits - 1, 0, -1):
            flips = flips.bitwiseXOR(F.when(x[n - 1].bitwiseAND(F.lit(1 << b)) != 0, (1 << b) - 1).otherwise(0))
        return bind(flips, lambda t: F.transform(x, lambda v: v.bitwiseXOR(t)))

    def interleave(x):
        out = F.lit(0).cast("long")
        for b in range(bits - 1, -1, -1):
            for k in range(n):
                bit = F.shiftright(x[k], b).bitwiseAND(F.lit(1)).cast("long")
                out = F.shiftleft(out, 1).bitwiseOR(bit)
        return out

    x = F.array(*[c.cast("int") for c in cells])
    for b in range(bits - 1, 0, -1):
        for i in range(n):
            x = bind(x, undo(i, 1 << b))
    return bind(bind(bind(x, gray), settle), interleave)


def _cells(docs: DataFrame) -> list[Column]:
    """Cells of language, source (by hash; null is cell 0) and size (halves of powers of two)."""
    top = (1 << BITS) - 1

    def named(c):
        return F.coalesce(1 + F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(top)), F.lit(0))

    size = F.octet_length(F.coalesce(F.col("text"), F.lit("")))
    return [named("lang"), named("source"),
            F.least(F.floor(2 * F.log2(1 + size / F.lit(8))), F.lit(top))]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       hilbert_index(_cells(docs), BITS).alias("curve"))


def _ranked(docs: DataFrame) -> DataFrame:
    """Every row's key with its rank along the curve and the number of rows."""
    ranked, total = numbered(_keyed(docs), list(ORDER), "curve")
    return ranked.withColumn("total", F.lit(total).cast("long"))


def assign_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, curve for every row of ``docs``.

    Law ``rows``: runs of the curve order, counts at most one apart; slots count
    from 0 in each shard along the curve. Equal keys are ordered by id, then by
    checksum and size; rows equal in all of them are alike, so their order does
    not matter. A null text has size 8 and checksum 0; null ids, languages and
    sources sort first; repeated rows take a slot each; an empty table gives no
    rows. ``grown_shard`` is null, as the law is not ``key``.
    """
    r = _ranked(docs)
    shard = F.expr(f"(rank * {shards}) div total")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return (r.withColumn("shard", shard)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
                    (F.col("rank") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve"))


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``docs`` with its ``shard``, laid out along the curve.

    The rows are sorted along the curve and written once; a row's rank is its
    place in its sorted partition after the counts of the partitions before, and
    cuts the shards as in ``assign_shards``: counts are at most one apart, also
    where rows are equal or have no id (the order of the input breaks such ties,
    so a row repeated often is dealt over tasks and shards). Null texts,
    languages and sources and empty tables are taken; an existing column ``shard``
    is replaced. Each file covers a short run, so its column statistics prune.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumns({
        "__llm_curve": hilbert_index(_cells(docs), BITS), "__llm_doc_id": F.col("doc_id").cast("long"),
        "__llm_text_crc32": F.crc32(text.cast("binary")), "__llm_size": (F.octet_length(text) + 8).cast("long"),
        "__llm_tie": F.monotonically_increasing_id()})
    ordered = keyed.orderBy(*[f"__llm_{c}" for c in ORDER], "__llm_tie").drop(*[f"__llm_{c}" for c in ORDER], "__llm_tie")
    placed = stored(ordered.withColumns({
        "__llm_part": F.spark_partition_id(),
        "__llm_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "laid_out")
    counts = placed.groupBy("__llm_part").agg(F.count(F.lit(1)).alias("n")).collect()   # one row per partition
    starts, total = [], 0
    for part, n in sorted((r["__llm_part"], r["n"]) for r in counts):
        starts.append((part, total))
        total += n
    before = docs.sparkSession.createDataFrame(starts, "__llm_part int, __llm_before long")
    shard = F.expr(f"((__llm_before + __llm_at) * {shards}) div {max(total, 1)}L").cast("int")
    ranked = placed.join(F.broadcast(before), "__llm_part").withColumn("shard", shard)
    return ranked.drop("__llm_part", "__llm_at", "__llm_before")
