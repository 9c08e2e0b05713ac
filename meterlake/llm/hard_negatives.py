"""Hard negatives through a multiway hyperplane tree with sibling distance ranges (GNAT).

Every node of the tree has a few split points; a row belongs to the nearest one
(the cells are bounded by hyperplanes), and each split point stores the range of
its distances to the rows of every sibling subtree. A search for scores within a
window is a search in an annulus around the anchor: a sibling goes when the
annulus, seen from some split point, does not meet the stored range. What stays
is compared exactly, leaf by leaf.

Inner products become distances by one more coordinate, ``sqrt(M^2 - |x|^2)`` with
the greatest norm ``M`` (0 for an anchor): then ``d^2 = |q|^2 + M^2 - 2 score``.

The split points come from a bounded sample; every row is put into its leaf, and
the ranges cover all rows. Rows travel as packs of one leaf, anchors as packs of
those that visit a leaf, and the two are joined by leaf: a leaf that holds a
third of all rows is many packs, which the join can deal out.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import discard, stored
from meterlake.plans.joins import lookup_join
from meterlake.session import ship_package

QUANT = 256               # an entry x counts as floor(QUANT * x)
LARGEST = float(1 << 20)  # entries must be smaller: scores of up to 64 of them fit 64 bits
SAMPLE = 4096             # rows from which split points are chosen, at most
DEGREE = 16               # split points of a node
DEPTH = 2
ROW_PACK, ANCHOR_PACK = 2048, 256
BUFFER = 1 << 16          # rows a task holds before it gives out its packs
HELD = 128                # anchor packs whose best scores a task holds
BEST = 5                  # positives an anchor, negatives a positive
SLACK = 1e-6              # of the greatest norm, added to each distance range


@dataclass
class Node:
    points: object                                 # k x (d + 1)
    children: list = field(default_factory=list)   # node numbers, or ~leaf
    low: object = None                             # k x k: smallest distance of point i to a row of child j
    high: object = None


def _near(np, x, points):
    """Distances of rows to points."""
    d2 = (x * x).sum(1)[:, None] + (points * points).sum(1)[None, :] - 2 * (x @ points.T)
    return np.sqrt(np.maximum(d2, 0))


class Tree:
    """The split points; node 0 is the root."""

    def __init__(self, np, sample, degree: int = DEGREE, depth: int = DEPTH):
        self.nodes: list[Node] = []
        self.leaves = 0
        self.paths: list[list[tuple[int, int]]] = []   # by leaf: (node, child place) from the root on
        self._grow(np, sample, degree, depth, [])

    def _grow(self, np, sample, degree, depth, path):
        if path and (depth == 0 or len(sample) < 2 * degree):
            self.paths.append(path)
            self.leaves += 1
            return ~(self.leaves - 1)
        at = len(self.nodes)
        # Far apart: each next point is the one farthest from all before it.
        chosen = [0]
        gap = _near(np, sample, sample[:1])[:, 0]
        while len(chosen) < min(degree, len(sample)) and gap.max() > 0:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, _near(np, sample, sample[chosen[-1:]])[:, 0])
        node = Node(sample[chosen])
        self.nodes.append(node)
        mine = _near(np, sample, node.points).argmin(1)
        node.children = [self._grow(np, sample[mine == j], degree, depth - 1, [*path, (at, j)]) for j in range(len(chosen))]
        return at

    def leaf_of(self, np, x):
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            if at < 0:
                out[rows] = ~at
            elif len(rows):
                near = _near(np, x[rows], self.nodes[at].points).argmin(1)
                todo += [(c, rows[near == j]) for j, c in enumerate(self.nodes[at].children)]
        return out

    def meets(self, np, q, near, far, slack):
        """Which leaves may hold a row between ``near`` and ``far`` (rows x windows) of the anchors ``q``: anchors x leaves."""
        out = np.zeros((len(q), self.leaves), bool)
        todo = [(0, np.arange(len(q)))]
        while todo:
            at, rows = todo.pop()
            if at < 0:
                out[rows, ~at] = True
                continue
            if not len(rows):
                continue
            node = self.nodes[at]
            d = _near(np, q[rows], node.points)
            alive = np.zeros((len(rows), len(node.children)), bool)
            for w in range(near.shape[1]):
                a, z = near[rows, w, None], far[rows, w, None]
                # From point i, rows of the annulus lie between these distances.
                least, most = np.maximum(d - z, a - d) - slack, d + z + slack
                fits = (least[:, :, None] <= node.high[None]) & (most[:, :, None] >= node.low[None])
                alive |= fits.all(1) & (z >= a)
            todo += [(c, rows[alive[:, j]]) for j, c in enumerate(node.children)]
        return out


def usable(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label",
           vector_col: str = "embedding") -> DataFrame:
    """(vec_id, label, v, norm2): rows that take part, entries as packed 64-bit floats of whole numbers."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    whole = F.forall(v, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))
    rows = (vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                           v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & whole))
    grid = F.transform("v", lambda c: F.floor(F.lit(QUANT) * c).cast("int"))
    return (rows.select("vec_id", "label", grid.alias("v"))
            .select("*", F.aggregate("v", F.lit(0).cast("long"), lambda s, c: s + c.cast("long") * c.cast("long")).alias("norm2")))


def _vectors(np, column, dim, dtype=float):
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, dim)


def _unpack(np, blob, dim):
    return np.frombuffer(blob, np.int32).reshape(-1, dim)


def _lifted(np, v, top):
    """Rows with the coordinate that gives them all the norm ``sqrt(top)``."""
    v = v.astype(float)
    return np.column_stack([v, np.sqrt(np.maximum(top - (v * v).sum(1), 0))])


def pack_rows(rows: DataFrame, tree: Tree, dim: int, top: int) -> DataFrame:
    """(leaf, ids, labels, vs): rows of one leaf together, at most ``ROW_PACK`` in a pack."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        held, size = [], 0

        def packs():
            leaf, ids, labels, vs = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.argsort(leaf, kind="stable")
            edges = np.flatnonzero(np.diff(leaf[order], prepend=-1))
            cuts = [i for a, z in zip(edges, [*edges[1:], len(order)], strict=True) for i in range(a, z, ROW_PACK)]
            parts = np.split(order, cuts[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(leaf[p[0]]) for p in parts]), *[pa.array([c[p].tobytes() for p in parts], pa.binary()) for c in (ids, labels, vs)]],
                ["leaf", "ids", "labels", "vs"])

        for b in batches:
            v = _vectors(np, b.column("v"), dim, np.int32)
            held.append((tree.leaf_of(np, _lifted(np, v, top)), b.column("vec_id").to_numpy(), b.column("label").to_numpy(), v))
            size += len(v)
            if size >= BUFFER:
                yield from packs()
                held, size = [], 0
        if held:
            yield from packs()

    return rows.select("vec_id", "label", "v").mapInArrow(run, "leaf long, ids binary, labels binary, vs binary")


def fit_ranges(packs: DataFrame, tree: Tree, dim: int, top: int) -> None:
    """Fill in the tree's distance ranges from every row: one table entry per node, point and child."""
    import numpy as np

    def run(batches):
        import numpy as np
        import pyarrow as pa

        found = {}
        for b in batches:
            for leaf, blob in zip(b.column("leaf").to_pylist(), b.column("vs").to_pylist(), strict=True):
                x = _lifted(np, _unpack(np, blob, dim), top)
                for at, j in tree.paths[leaf]:
                    d = _near(np, x, tree.nodes[at].points)
                    low, high = found.get((at, j), (np.inf, -np.inf))
                    found[at, j] = np.minimum(low, d.min(0)), np.maximum(high, d.max(0))
        rows = [(at, j, i, float(low[i]), float(high[i])) for (at, j), (low, high) in found.items() for i in range(len(low))]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 3 else pa.float64()) for k, c in enumerate(columns)],
                                         ["node", "child", "point", "low", "high"])

    for node in tree.nodes:
        k = len(node.children)
        node.low, node.high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
    ranges = (packs.select("leaf", "vs").mapInArrow(run, "node long, child long, point long, low double, high double")
              .groupBy("node", "child", "point").agg(F.min("low").alias("low"), F.max("high").alias("high")))
    for r in ranges.collect():   # as many rows as the tree has entries
        tree.nodes[r["node"]].low[r["point"], r["child"]] = r["low"]
        tree.nodes[r["node"]].high[r["point"], r["child"]] = r["high"]


ANCHORS = "leaf long, pack string, keys binary, ids binary, labels binary, vs binary, lows binary, highs binary"


def visits(anchors: DataFrame, tree: Tree, dim: int, top: int, home: bool) -> DataFrame:
    """Packs of anchors by the leaves they visit: their own (``home``), or all whose ranges meet their windows.

    ``anchors`` has key, vec_id, label, v and the score windows ``lows`` and
    ``highs`` (arrays of one length; an empty window has its low above its high).
    """
    def run(batches):
        import uuid

        import numpy as np
        import pyarrow as pa

        for b in batches:
            v = _vectors(np, b.column("v"), dim, np.int32)
            keys, ids, labels = (b.column(c).to_numpy() for c in ("key", "vec_id", "label"))
            lows, highs = (b.column(c).flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1) for c in ("lows", "highs"))
            f = v.astype(float)
            q = np.column_stack([f, np.zeros(len(f))])
            if home:
                met = np.zeros((len(v), tree.leaves), bool)
                met[np.arange(len(v)), tree.leaf_of(np, _lifted(np, v, top))] = True
            else:
                base = ((f * f).sum(1) + top)[:, None]
                near = np.sqrt(np.maximum(base - 2.0 * np.minimum(highs, 2**62), 0))
                far = np.sqrt(np.maximum(base - 2.0 * np.maximum(lows, -(2**62)), 0))
                far = np.where(lows > highs, -1.0, far)
                met = tree.meets(np, q, near, far, SLACK * (1 + top**0.5))
            out = []
            for leaf in range(tree.leaves):
                mine = np.flatnonzero(met[:, leaf])
                for a in range(0, len(mine), ANCHOR_PACK):
                    p = mine[a:a + ANCHOR_PACK]
                    out.append((leaf, uuid.uuid4().hex, *[c[p].tobytes() for c in (keys, ids, labels, v, lows, highs)]))
            columns = list(zip(*out, strict=True)) or [()] * 8
            kinds = [pa.int64(), pa.string(), *[pa.binary()] * 6]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["leaf", "pack", "keys", "ids", "labels", "vs", "lows", "highs"])

    return anchors.select("key", "vec_id", "label", "v", "lows", "highs").mapInArrow(run, ANCHORS)


def _best(np, scores, ids, best: int):
    """The ``best`` entries of each row by falling score, then rising id (columns with a score below all windows go last)."""
    if scores.shape[1] > best:
        # Keep all that tie with the last place, then sort what is kept.
        edge = np.partition(scores, scores.shape[1] - best, axis=1)[:, -best][:, None]
        width = int((scores >= edge).sum(1).max())
        if width < scores.shape[1]:
            pick = np.argpartition(scores, scores.shape[1] - width, axis=1)[:, -width:]
            scores, ids = np.take_along_axis(scores, pick, 1), np.take_along_axis(ids, pick, 1)
    order = np.lexsort((ids, -scores), axis=1)[:, :best]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def search(packs: DataFrame, anchors: DataFrame, same: bool, dim: int, exact: bool, best: int = BEST) -> DataFrame:
    """(key, w, score, id): the best rows of each window of each anchor, of its label (``same``) or of others.

    Each task keeps the best of the anchor packs it works on; what the tasks
    give out is at most ``best`` rows for an anchor's window and leaf part.
    """
    none = 1 - 2**63

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held = {}

        def out():
            for keys, scores, ids in held.values():
                a, w, k = np.nonzero(scores > none)
                yield pa.RecordBatch.from_arrays([pa.array(keys[a]), pa.array(w.astype(np.int32)), pa.array(scores[a, w, k]), pa.array(ids[a, w, k])],
                                                 ["key", "w", "score", "id"])

        for b in batches:
            for r in range(b.num_rows):
                got = {c: b.column(c)[r].as_py() for c in b.schema.names}
                q = _unpack(np, got["vs"], dim)
                keys, own, label = (np.frombuffer(got[c], np.int64) for c in ("keys", "ids", "labels"))
                lows, highs = (np.frombuffer(got[c], np.int64).reshape(len(keys), -1) for c in ("lows", "highs"))
                x, ids, labels = _unpack(np, got["row_vs"], dim), *(np.frombuffer(got[c], np.int64) for c in ("row_ids", "row_labels"))
                kind = float if exact else object     # sums below 2**53 are exact as floats
                s = (q.astype(kind) @ x.T.astype(kind)).astype(np.int64)
                fits = (own[:, None] != ids[None]) & ((label[:, None] == labels[None]) == same)
                if got["pack"] not in held:
                    if len(held) >= HELD:
                        yield from out()
                        held.clear()
                    held[got["pack"]] = (keys, np.full((*lows.shape, best), none), np.zeros((*lows.shape, best), np.int64))
                _, top_s, top_i = held[got["pack"]]
                wide = np.broadcast_to(ids, s.shape)
                for w in range(lows.shape[1]):
                    inside = fits & (s >= lows[:, w, None]) & (s <= highs[:, w, None])
                    hit = np.flatnonzero(inside.any(1))
                    if len(hit):
                        all_s = np.concatenate([top_s[hit, w], np.where(inside[hit], s[hit], none)], axis=1)
                        all_i = np.concatenate([top_i[hit, w], wide[hit]], axis=1)
                        top_s[hit, w], top_i[hit, w] = _best(np, all_s, all_i, best)
        yield from out()

    rows = packs.select("leaf", F.col("ids").alias("row_ids"), F.col("labels").alias("row_labels"), F.col("vs").alias("row_vs"))
    pairs = lookup_join(rows, anchors, "leaf", "inner", materialized=True)
    found = pairs.drop("leaf").mapInArrow(run, "key long, w int, score long, id long")
    place = F.row_number().over(Window.partitionBy("key", "w").orderBy(F.desc("score"), "id"))
    return found.select("*", place.alias("place")).where(F.col("place") <= best)


def _windows(n: int, low, high):
    return F.array_repeat(F.lit(low).cast("long"), n), F.array_repeat(F.lit(high).cast("long"), n)


def mine(vectors: DataFrame, is_anchor=None, relabel=None, best: int = BEST, low_share: tuple[int, int] = (80, 100),
         id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each anchor (``is_anchor``, a condition on ``vec_id``; every hundredth id
    by default) and each of its ``best`` nearest other rows of its label, the
    ``best`` rows of other labels whose score lies between ``low_share`` of the
    positive's score and that score. ``relabel`` changes ``label`` first.

    Rows with a null id, label or vector, an empty vector, or a null,
    non-finite or huge (2**20 or more) entry take no part, nor do rows of another
    length than the commonest (the longer, if equally common). An id names a
    row: rows that share the anchor's id are not its partners; other repeated
    rows count one by one, and an anchor row repeated whole is searched once.
    Equal scores go by the smaller id. An anchor without positives, or without
    rows in a window, gives no rows; an empty table gives none.
    """
    import numpy as np

    spark = vectors.sparkSession
    ship_package(spark)
    kinds = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = usable(vectors, id_col, label_col, vector_col)
    if relabel is not None:
        rows = rows.withColumn("label", relabel)
    rows = stored(rows, "vectors")
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("top"))
    first = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    if first is None:
        return spark.createDataFrame([], kinds)
    dim, n, top = first["d"], first["n"], first["top"]
    exact = top < 2**53
    rows = rows.where(F.size("v") == dim).drop("norm2")
    sample = rows if n <= SAMPLE else rows.sample(False, SAMPLE / n, 7).limit(SAMPLE)
    points = sample.select("v").toArrow().column("v").combine_chunks()
    points = points if len(points) else rows.select("v").limit(1).toArrow().column("v").combine_chunks()
    tree = Tree(np, _lifted(np, _vectors(np, points, dim, np.int32), top))
    packs = stored(pack_rows(rows, tree, dim, top), "row_packs")
    fit_ranges(packs, tree, dim, top)

    chosen = rows.where(F.col("vec_id") % 100 == 0 if is_anchor is None else is_anchor).distinct()
    anchors = stored(chosen.withColumn("key", F.monotonically_increasing_id()), "anchors")
    low, high = _windows(1, -(2**62), 2**62)

    def run(asked, same, home):
        packed = stored(visits(asked, tree, dim, top, home), "visits")
        found = stored(search(packs, packed, same, dim, exact, best), "found")
        discard(packed)
        return found

    def bounded(asked, found):
        """The windows, each from the last of ``best`` scores already found in the anchor's own leaf."""
        edge = found.where(F.col("place") == best).select("key", "w", "score")
        edges = edge.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("edge"))
        lows = F.transform("lows", lambda x, i: F.greatest(x, F.coalesce(F.element_at("edge", i), x)))
        return asked.join(edges, "key", "left").withColumn("lows", F.when(F.col("edge").isNull(), F.col("lows")).otherwise(lows))

    asked = anchors.withColumns({"lows": low, "highs": high})
    positives = run(bounded(asked, run(asked, True, True)), True, False)
    share, whole = low_share
    ranked = F.sort_array(F.collect_list(F.struct("place", "id", "score")))
    five = positives.groupBy("key").agg(ranked.alias("p"))
    # Smallest whole score that is at least share/whole of the positive's.
    floor = F.transform("p", lambda p: (-F.floor(-(p["score"].cast("decimal(25,0)") * share) / whole)).cast("long"))
    filled = lambda a, x: F.concat(a, F.array_repeat(F.lit(x).cast("long"), best - F.size(a)))
    windows = stored(anchors.join(five, "key").select(
        "*", filled(floor, 1).alias("lows"), filled(F.transform("p", lambda p: p["score"]), 0).alias("highs")), "windows")
    negatives = run(bounded(windows, run(windows, False, True)), False, False)
    named = windows.select("key", F.col("vec_id").alias("anchor_id"), F.posexplode("p").alias("w", "p"))
    return (negatives.join(named, ["key", "w"])
            .select("anchor_id", F.col("p.id").alias("positive_id"), F.col("place").cast("int").alias("rank"),
                    F.col("id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score")))
