"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint has eight bytes. Two fingerprints that differ in at most ``d``
bits have at least ``8 - d`` equal bytes at equal positions (the guaranteed
minimum). Posting lists of single (position, byte) entries would be ``n / 256``
long each, so the index is keyed by every set of ``8 - d`` positions together
with the bytes found there: a pair meets in a list only if it reaches the
minimum. Inside the join each pair is tallied (number of shared positional
bytes), kept once -- at the first position set it shares -- and verified by its
bit distance.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import doc_rows, stored
from meterlake.llm.graph import components
from meterlake.session import ship_package

SEED = 42


def text_fingerprint(text: str | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash of one text (helper of the Arrow stage).

    ``bytes.lower`` changes A-Z only and ``bytes.split`` cuts at exactly
    ``\\x20 \\x09-\\x0D``.
    """
    import numpy as np
    import xxhash

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    if len(found) < shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        starts = (ends - sizes)[: len(found) - shingle + 1].tolist()
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED)
                  for a, b in zip(starts, ends[shingle - 1:].tolist(), strict=True)]
    raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(raw), 65536):
        counts += np.unpackbits(raw[i:i + 65536], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp) with ``fp`` as a signed long, one row per input row."""
    ship_package(docs.sparkSession)

    def hashed(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            fps = np.fromiter((text_fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return doc_rows(docs).mapInArrow(hashed, "doc_id long, fp long")


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def fingerprint_links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """Pairs (a < b) of distinct fingerprints at ``max_bits`` or fewer differing bits."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must lie between 0 and 7: eight byte positions are indexed")
    need = 8 - max_bits
    sets = list(combinations(range(8), need))
    entries = [F.struct(F.lit(k).alias("set"),
                        reduce(lambda x, y: x.bitwiseOR(y),
                               [F.shiftleft(_byte(F.col("fp"), p), 8 * i) for i, p in enumerate(s)]).alias("bytes"))
               for k, s in enumerate(sets)]
    postings = fps.select("fp", F.explode(F.array(*entries)).alias("e")).select("fp", "e.set", "e.bytes")
    a, b = postings.alias("a"), postings.alias("b")
    differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    shared = [(_byte(differ, p) == 0).cast("int") for p in range(8)]
    tally = reduce(lambda x, y: x + y, shared)
    # The first ``need`` shared positions name the one set that reports the pair.
    rank = [reduce(lambda x, y: x + y, shared[: p + 1]) for p in range(8)]
    first = reduce(lambda x, y: x + y,
                   [F.when((shared[p] == 1) & (rank[p] <= need), 1 << p).otherwise(0) for p in range(8)])
    masks = F.array(*[F.lit(sum(1 << p for p in s)) for s in sets])
    # Spark sizes the postings by the table before the explode, too low by the number of sets: they must not be broadcast.
    return (a.join(b.hint("merge"), (F.col("a.set") == F.col("b.set")) & (F.col("a.bytes") == F.col("b.bytes"))
                   & (F.col("a.fp") < F.col("b.fp")) & (F.bit_count(differ) <= max_bits)
                   & (tally >= need) & (first == masks[F.col("a.set")]))
            .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at most
    ``max_bits`` differing bits. Rows of one fingerprint collapse to a class
    first (the minimum id, combined before the shuffle), so groups of copies
    never meet pairwise; links join classes only. Null and wordless texts have
    fingerprint zero and link like any other; repeated rows stay repeated; a
    null ``doc_id`` keeps its row and is no one's smallest id unless its whole
    component is null; an empty table gives no rows.
    """
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    classes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    links = fingerprint_links(classes.select("fp"), max_bits)
    roots = stored(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "roots")
    linked = classes.join(roots, classes["fp"] == roots["node"])
    lowest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = roots.join(lowest, "root").select(F.col("node").alias("fp"), "component_id")
    whole = stored(classes.join(named, "fp", "left")
                   .select("fp", F.coalesce("component_id", "first_id").alias("component_id")), "class_ids")
    return fps.join(whole, "fp", "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: that of the smallest id.

    Columns stay as they are. A ``doc_id`` names one document, so rows that
    repeat it count as copies and one of them stays. Rows without an id can't
    be named by a component and all stay.
    """
    found = near_duplicates(docs, shingle, max_bits)
    keep = stored(found.where(F.col("doc_id") == F.col("component_id"))
                  .select(F.col("doc_id").alias("__llm_id")).distinct(), "kept_ids")
    named = docs.join(keep, docs["doc_id"] == keep["__llm_id"], "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where(F.col("doc_id").isNull()))
