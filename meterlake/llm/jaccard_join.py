"""N-gram Jaccard join by rare-first prefix filtering.

Each document is the set of its distinct word n-grams. Sorted rare first, two
sets that reach the similarity share an n-gram within their prefixes, so
documents meet only in the lists of their prefix n-grams. The length filter
compares set sizes, the positional filter bounds the overlap by the places of
the shared n-gram, and the suffix filter bounds it by how the n-grams of the two
sets fall into ranges of their hashes: within the join by the ranges that hold an
odd number in one set alone (each is an n-gram that the sets don't share), then by
the numbers in each range. What passes is verified once on the whole sets.

The sets, 8 bytes an n-gram, are never kept nor sent: they are larger than the
texts, so each step makes them anew from the texts of its rows, which are stored
once under their numbers.

Equal sets are one class from the start. A list of n classes is not n * n pairs:
first every class meets only a hub of each list, and the links found give
components; then lists are joined with themselves, but only members of different
components meet. No link between two components is lost, and a large group of
near copies costs as many pairs as it has members.

Rarity is counted over all documents in a table of fixed size, indexed by hash:
an n-gram's count includes those it shares its cell with. Any one order for all
documents gives the same links; the counts only decide how long the lists are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import batches_of, discard, doc_rows, stored
from meterlake.llm.graph import components
from meterlake.llm.lm import ChunkHashes, _mix, _signed
from meterlake.plans.joins import lookup_join
from meterlake.session import ship_package

SHINGLE, PERCENT = 4, 85
CELLS = 1 << 21           # of the rarity table
SLICE = 1 << 14           # cells that travel together
SLICES = 8                # such slices in an Arrow batch
CHUNK = 1 << 18           # characters of text hashed at once, or one longer text
HELD = 1 << 18            # n-grams sorted at once, or those of one larger set
BINS = 64                 # hash ranges of the suffix filter
MARKS = [f"s{i}" for i in range(4)]   # 256 bits: whether a hash range holds an odd number of a set's n-grams
BATCH = 500               # texts or sets in an Arrow batch
TABLE_BATCH = 64          # sets, or slices of counts (64 kB each), in one while the table is made
HUBS = 2                  # rounds in which every class meets a hub


def _chunks(items, size, most):
    part, total = [], 0
    for x in items:
        part.append(x)
        total += size(x)
        if total >= most:
            yield part
            part, total = [], 0
    if part:
        yield part


def text_sets(np, hashes, texts, shingle):
    """(sorted distinct n-gram hashes of all texts, one text after another; how many each text has)."""
    h, doc = hashes(texts)
    words = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(words) - words
    # The n-gram that begins at each word; the last words of a text begin none.
    gram = h.copy()
    short = words < shingle
    left = words[doc] - (np.arange(len(h)) - first[doc])
    for k in range(1, shingle):
        ends = left > k
        at = np.flatnonzero(ends)
        gram[at] = _mix(np, gram[at], h[at + k])
    # A text of fewer words is one n-gram: its whole sequence, told apart by its length.
    lone = short[doc] & (left == words[doc])
    gram[lone] = _mix(np, gram[lone], words[doc[lone]].astype(np.uint64))
    begins = (left >= shingle) | lone
    gram, doc = gram[begins], doc[begins]
    order = np.lexsort((gram, doc))
    gram, doc = gram[order], doc[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])
    gram, doc = gram[new], doc[new]
    return gram, np.bincount(doc, minlength=len(texts))


def _set_batches(batches, shingle, grams=True):
    """Batches (rid, doc_id, n, k1, k2, s0 to s3, grams) of batches (rid, doc_id, text); without ``grams``, if they are not wanted."""
    import numpy as np
    import pyarrow as pa

    hashes = ChunkHashes(np)
    for b in batches:
        done = 0
        for part in _chunks((t.as_py() for t in b.column("text")), lambda t: len(t or "") + 1, CHUNK):
            gram, n = text_sets(np, hashes, part, shingle)
            ends = np.cumsum(n)
            keys = []
            for salt in (1, 2):
                sums = np.concatenate([[np.uint64(0)], np.cumsum(_mix(np, gram, gram >> np.uint64(salt)), dtype=np.uint64)])
                keys.append(_signed(np, _mix(np, sums[ends] - sums[ends - n], n.astype(np.uint64))))
            spots = np.repeat(np.arange(len(n)) * 256, n) + (gram >> np.uint64(56)).astype(np.int64)
            odd = np.packbits((np.bincount(spots, minlength=256 * len(n)) & 1).astype(bool)).view(np.int64).reshape(-1, 4)
            columns = [b.column("rid").slice(done, len(part)), b.column("doc_id").slice(done, len(part)), pa.array(n), *keys,
                       *[pa.array(odd[:, i].copy()) for i in range(4)]]
            if grams:
                columns.append(pa.array([gram[z - m:z].tobytes() for z, m in zip(ends.tolist(), n.tolist(), strict=True)], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["rid", "doc_id", "n", "k1", "k2", *MARKS, "grams"][:len(columns)])
            done += len(part)


def numbered_texts(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, text): every row under a number of its own."""
    return doc_rows(docs).select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")


def text_digests(texts: DataFrame, shingle: int = SHINGLE, grams: bool = False) -> DataFrame:
    """(rid, doc_id, n, k1, k2, s0 to s3) of each row (rid, doc_id, text), and its n-gram hashes (``grams``), rising, as bytes.

    ``k1``, ``k2`` digest the set, ``s0`` to ``s3`` hold its odd hash ranges.
    """
    ship_package(texts.sparkSession)
    kinds = f"rid long, doc_id long, n long, k1 long, k2 long, {', '.join(f'{s} long' for s in MARKS)}{', grams binary' * grams}"
    return texts.select("rid", "doc_id", "text").mapInArrow(lambda batches: _set_batches(batches, shingle, grams), kinds)


def document_sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``text_digests`` of all rows of ``docs`` with their n-grams."""
    return text_digests(numbered_texts(docs), shingle, grams=True)


def _runs_of(np, column):
    """(first row, n-grams of each row, all of them) of runs of at most ``HELD`` n-grams, or of one larger set; no copies."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1] // 8
    every = np.frombuffer(column.buffers()[2] or b"", np.uint64)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + HELD, side="right")) - 1)
        yield first, np.diff(offsets[first:last + 1]).astype(np.int64), every[offsets[first]:offsets[last]]
        first = last


def table_batches(total):
    """(part, n): the slices of a table of counts, a few in a batch, so that neither side holds a second table."""
    import pyarrow as pa

    width = min(SLICE, len(total))
    for first in range(0, len(total) // width, SLICES):
        parts = range(first, min(first + SLICES, len(total) // width))
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array([total[p * width:(p + 1) * width].tobytes() for p in parts], pa.binary())],
                                         ["part", "n"])


def count_cells(sets: DataFrame, cells: int = CELLS, shingle: int | None = None):
    """Occurrences of each cell of the rarity table over all sets: one array, whatever the input.

    A task counts its sets in one table; the tables are added slice by slice.
    With ``shingle``, ``sets`` holds texts (rid, doc_id, text), whose sets are made on the way.
    """
    import numpy as np

    def counted(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros(cells, np.uint32)
        for b in batches if shingle is None else _set_batches(batches, shingle):
            for _, _, gram in _runs_of(np, b.column("grams")):
                np.add.at(total, (gram & np.uint64(cells - 1)).astype(np.int64), 1)
        yield from table_batches(total)

    def added(batches):
        import numpy as np
        import pyarrow as pa

        held = {}
        for b in batches:
            for part, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if part not in held:
                    held[part] = np.zeros(len(n) // 4, np.int64)
                held[part] += np.frombuffer(n, np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([x.tobytes() for x in held.values()], pa.binary())], ["part", "n"])

    kinds = "part long, n binary"
    tables = sets.select(*(["grams"] if shingle is None else ["rid", "doc_id", "text"])).mapInArrow(counted, kinds)
    with batches_of(sets.sparkSession, TABLE_BATCH):
        # Written, so that the shuffled tables go at once.
        kept = stored(tables.repartition("part").mapInArrow(added, kinds), "cells")
        summed = kept.toArrow()   # cells * 8 bytes
    discard(kept)
    out = {p: np.frombuffer(n, np.int64) for p, n in zip(summed.column(0).to_pylist(), summed.column(1).to_pylist(), strict=True)}
    whole = np.concatenate([out[p] for p in sorted(out)]) if out else np.zeros(cells, np.int64)
    return np.minimum(whole, 2**32 - 1).astype(np.uint32)


def prefix_length(n, percent: int):
    """n-grams of the rare-first prefix of a set of ``n``: ``n - ceil(t n) + 1``."""
    return n - -(-percent * n // 100) + 1


def prefixes(sets: DataFrame, counts, percent: int, shingle: int | None = None) -> DataFrame:
    """(h, rid, n, pos, score): the prefix n-grams of each set with their places in its rare-first order.

    With ``shingle``, ``sets`` holds texts (rid, doc_id, text), whose sets are made on the way.

    ``score`` says how common the prefix is: among near copies, the text that the
    others were edited from has no rare n-grams of its own and so the highest.
    """
    spark = sets.sparkSession
    table = spark.sparkContext.broadcast(counts)   # of fixed size

    def run(batches):
        import numpy as np
        import pyarrow as pa

        rare = table.value
        for b in batches if shingle is None else _set_batches(batches, shingle):
            rids = b.column("rid").to_numpy()
            for first, n, gram in _runs_of(np, b.column("grams")):
                rid = rids[first:first + len(n)]
                doc = np.repeat(np.arange(len(n)), n)
                # Stable sorts: the n-grams of a set rise already.
                count = rare[(gram & np.uint64(len(rare) - 1)).astype(np.int64)]
                order = np.argsort(count, kind="stable")
                order = order[np.argsort(doc[order], kind="stable")]
                pos = np.arange(len(gram)) - np.repeat(np.cumsum(n) - n, n)
                mine = pos < prefix_length(n, percent)[doc]
                logs = np.bincount(doc[mine], np.log2(np.maximum(count[order][mine], 1)), len(n))
                score = (100 * logs / np.maximum(prefix_length(n, percent), 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [_signed(np, gram[order][mine]), pa.array(rid[doc[mine]]), pa.array(n[doc[mine]].astype(np.int32)),
                     pa.array(pos[mine].astype(np.int32)), pa.array(score[doc[mine]])], ["h", "rid", "n", "pos", "score"])

    held = ["rid", "grams"] if shingle is None else ["rid", "doc_id", "text"]
    return sets.select(*held).mapInArrow(run, "h long, rid long, n int, pos int, score int")


def bin_counts(np, gram):
    """How many n-grams fall into each range of the hash."""
    return np.bincount((gram >> np.uint64(64 - (BINS - 1).bit_length())).astype(np.int64), minlength=BINS)


def linked(np, a, b, percent: int) -> bool:
    """Whether two rising arrays of distinct hashes reach the similarity: the suffix filter, then the whole overlap."""
    need = -(-percent * (len(a) + len(b)) // (100 + percent))
    if min(len(a), len(b)) < need or np.minimum(bin_counts(np, a), bin_counts(np, b)).sum() < need:
        return False
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) >= need


def verify(pairs: DataFrame, texts: DataFrame, percent: int, shingle: int = SHINGLE) -> DataFrame:
    """(a, b) of the ``pairs`` that reach the similarity. Each side's text is joined in once."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        hashes = ChunkHashes(np)
        for b in batches:
            found = []
            both = ((x.as_py(), y.as_py()) for x, y in zip(b.column("ta"), b.column("tb"), strict=True))
            for part in _chunks(both, lambda p: len(p[0] or "") + len(p[1] or "") + 2, CHUNK):
                gram, n = text_sets(np, hashes, [t for p in part for t in p], shingle)
                sets = np.split(gram, np.cumsum(n)[:-1])
                found += [linked(np, x, y, percent) for x, y in zip(sets[::2], sets[1::2], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(found, pa.bool_()))

    one = texts.select(F.col("rid").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("rid").alias("b"), F.col("text").alias("tb"))
    # Only texts that some pair names travel.
    half = lookup_join(one, pairs.select("a", "b"), "a", "inner", materialized=True)
    rest = lookup_join(two, pairs.select("b").distinct(), "b", "left_semi", materialized=True)
    return half.join(rest, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _hub_pairs(lists: DataFrame, labelled: DataFrame, sizes: DataFrame, percent: int, turn: int = 0, tried: DataFrame | None = None) -> DataFrame:
    """(a, b): each class with the hub, of another component, that most of its lists name and that it has not met.

    Even turns look to the common hub of a list first, odd ones to the drawn one; hubs
    that the length filter rules out (``sizes``: rid, n) are passed over.
    """
    first, second = ("0", "1") if turn % 2 == 0 else ("1", "0")
    hub = (F.when(F.col(f"g{first}") != F.col("comp"), F.col(f"h{first}"))
           .when(F.col(f"g{second}") != F.col("comp"), F.col(f"h{second}")))
    met = labelled.join(lists, "h").select("rid", "n", hub.alias("hub")).where("hub is not null")
    tally = met.groupBy("rid", "n", "hub").agg(F.count(F.lit(1)).alias("k"))
    hub_sizes = sizes.select(F.col("rid").alias("hub"), F.col("n").alias("m"))
    tally = lookup_join(tally, hub_sizes, "hub", "inner", materialized=True).where(
        100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
    tally = tally.select("rid", "hub", "k", F.least("rid", "hub").alias("a"), F.greatest("rid", "hub").alias("b"))
    if tried is not None:
        tally = tally.join(tried, ["a", "b"], "left_anti")
    best = tally.groupBy("rid").agg(F.max(F.struct("k", "a", "b")).alias("m"))
    return best.select("m.a", "m.b").distinct()


def _label(postings: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``postings`` with the component of each class (itself, if it has no link yet)."""
    if roots is None:
        return postings.withColumn("comp", F.col("rid"))
    named = roots.select(F.col("node").alias("rid"), "root")
    return (lookup_join(postings, named, "rid", "left", materialized=True)
            .withColumn("comp", F.coalesce("root", "rid")).drop("root"))


def _open_lists(labelled: DataFrame, turn: int = 0) -> DataFrame:
    """Lists with members of two components or more, with two hubs (``h0``, ``h1``) and their components (``g0``, ``g1``).

    ``h0`` is the member with the most common prefix, ``h1`` one drawn anew each turn.
    """
    draw = F.xxhash64("rid", F.lit(turn))
    common = F.col("score").cast("long") * F.lit(1 << 40) + draw.bitwiseAND(F.lit((1 << 40) - 1))
    return (labelled.groupBy("h")
            .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                 F.max_by("rid", common).alias("h0"), F.max_by("comp", common).alias("g0"),
                 F.max_by("rid", draw).alias("h1"), F.max_by("comp", draw).alias("g1"))
            .where("lo < hi").drop("lo", "hi"))


def cross_pairs(open_postings: DataFrame, percent: int) -> DataFrame:
    """(a, b): classes of different components that pass the length, positional and first suffix filter in some list.

    The smaller set needs only the shorter prefix that its larger partners allow.
    Postings carry the odd ranges of their sets (``MARKS``): sets with ``need``
    n-grams in common differ in ``na + nb - 2 * need`` at most.
    """
    a, b = open_postings.alias("a"), open_postings.alias("b")
    na, nb, pa, pb = F.col("a.n"), F.col("b.n"), F.col("a.pos"), F.col("b.pos")
    need = F.ceil(percent * (na + nb) / F.lit(100.0 + percent) - 1e-9)
    # n-grams up to the shared one, and those after it, can't give more.
    most = F.least(pa, pb) + 1 + F.least(na - pa, nb - pb) - 1
    differ = sum((F.bit_count(F.col(f"a.{s}").bitwiseXOR(F.col(f"b.{s}"))) for s in MARKS), F.lit(0))
    index = na - F.ceil(2.0 * percent * na / (100.0 + percent) - 1e-9) + 1
    return (a.join(b, (F.col("a.h") == F.col("b.h")) & (F.col("a.comp") != F.col("b.comp"))
                   & ((na < nb) | ((na == nb) & (F.col("a.rid") < F.col("b.rid"))))
                   & (100 * na >= percent * nb) & (pa < index) & (most >= need) & (differ <= na + nb - 2 * need))
            .select(F.least("a.rid", "b.rid").alias("a"), F.greatest("a.rid", "b.rid").alias("b")).distinct())


def similar_classes(texts: DataFrame, classes: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """(node, root): components of the links between ``classes`` (rid, n, s0 to s3), for those that have a link.

    ``texts`` holds the text of each ``rid`` (and ``doc_id``); the n-grams of rows that stand for no class are only counted.
    """
    counts = count_cells(texts, shingle=shingle)
    own = lookup_join(texts, classes.select("rid"), "rid", "left_semi", materialized=True)
    postings = stored(prefixes(own, counts, percent, shingle), "prefixes", BATCH)
    shared = postings.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("h")
    # Written, so that the join stands alone and can be split at a frequent n-gram.
    shared = stored(shared, "shared")
    met = stored(postings.join(shared, "h", "left_semi"), "lists")
    discard(postings, shared)
    edges, roots, tried = None, None, None
    for turn in range(HUBS + 1):
        labelled = _label(met, roots)
        lists = stored(_open_lists(labelled, turn), "open_lists")
        # Lists of one component are done with.
        unsettled = stored(labelled.join(lists.select("h"), "h", "left_semi"), "unsettled")
        discard(met)
        met = unsettled.drop("comp")
        met.stored_path = unsettled.stored_path
        if turn < HUBS:
            pairs = _hub_pairs(lists, unsettled, classes.select("rid", "n"), percent, turn, tried)
        else:
            marked = lookup_join(unsettled, classes.select("rid", *MARKS), "rid", "inner", materialized=True)
            pairs = cross_pairs(marked, percent).join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        tried = pairs if tried is None else tried.union(pairs)
        found = stored(verify(pairs, texts, percent, shingle), "links", BATCH)
        discard(lists)
        links = found.select(F.col("a").alias("u"), F.col("b").alias("v"))
        edges = links if edges is None else edges.union(links)
        # Components so far stand for the links that made them.
        roots = stored(components(edges), "roots")
        edges = roots.select(F.col("node").alias("u"), F.col("root").alias("v"))
    discard(met)
    return roots


def near_copies(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Two rows link when ``100 * intersection >= percent * union`` of their sets of
    lower-cased (A-Z) word n-grams; a text of fewer words is one n-gram, and a null,
    empty or wordless text has none and links with nothing. ``component_id`` is
    the smallest id reachable by links; repeated rows and repeated ids stay and
    link as copies; a null ``doc_id`` keeps its row and is no one's smallest id
    unless its whole component has none. An empty table gives no rows. N-grams
    count as equal when their 64-bit hashes are.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must lie between 1 and 100")
    # Packed well, as they stay until the last pair is verified.
    texts = stored(numbered_texts(docs), "texts", codec="zstd")
    rows = stored(text_digests(texts, shingle), "rows", BATCH)
    classes = stored(rows.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("rid").alias("rid"), F.min("doc_id").alias("first_id"),
                                                                            *[F.min(s).alias(s) for s in MARKS]), "classes")
    roots = similar_classes(texts, classes, percent, shingle)
    discard(texts)
    linked_classes = classes.join(roots, classes["rid"] == roots["node"])
    lowest = linked_classes.groupBy("root").agg(F.min("first_id").alias("low"))
    named = roots.join(lowest, "root").select(F.col("node").alias("rid"), "low", F.lit(True).alias("linked"))
    ids = stored(classes.join(named, "rid", "left").select(
        "k1", "k2", "n", F.when(F.col("linked"), F.col("low")).otherwise(F.col("first_id")).alias("component_id")), "class_ids")
    return (rows.select("doc_id", "n", "k1", "k2").join(ids, ["k1", "k2", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))
