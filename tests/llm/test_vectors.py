"""Whitening and hard negatives against numpy over all rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm import hard_negatives, whitening

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType())])


def frame(spark, rows):
    """The table with extra columns whose names the operators use inside."""
    return spark.createDataFrame(rows, SCHEMA).select(
        "*", *[F.lit(1).alias(c) for c in ("v", "n", "key", "leaf", "component", "score", "norm2", "place")])


def clusters(rng, n, dim, groups=6, spread=0.25):
    centres = rng.normal(size=(groups, dim))
    v = centres[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, dim))
    v /= np.linalg.norm(v, axis=1)[:, None]
    return [(i, [float(c) for c in row.astype(np.float32)], int(rng.integers(10))) for i, row in enumerate(v)]


ODD = [(9001, None, 1), (9002, [None] * 8, 2), (9003, [float("nan")] + [0.0] * 7, 3), (9004, [float("inf")] + [0.0] * 7, 4),
       (9005, [], 5), (9006, [0.5] * 3, 5), (9007, [1e30] + [0.0] * 7, 6)]


def whole(rows, dim):
    return [(i, np.floor(1024 * np.array(v)).astype(np.int64) + 100_000) for i, v, _ in rows
            if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) and abs(c) < 2**20 for c in v)]


def check_whitened(got, rows, dim, rank):
    kept = whole(rows, dim)
    x = np.array([v for _, v in kept])
    n, sums = len(x), x.sum(0)
    gap = n * x - sums
    _, spread, vectors = np.linalg.svd(gap / n, full_matrices=False)
    values, vectors = spread**2 / n, vectors.T
    k = min(8, dim)
    assert len(got) == n * k and {r.n for r in got} == {n}
    exact = [sum(int(c)**2 for c in g) for g in gap]
    assert sorted((r.vec_id is None, r.vec_id or 0, r.deviation or 0) for r in got if r.component == 1) == sorted(
        (i is None, i or 0, e if e < 2**63 else 0) for (i, _), e in zip(kept, exact, strict=True))
    for c in range(1, k + 1):
        mine = sorted(((r.vec_id is None, r.vec_id or 0, r.whitened) for r in got if r.component == c), key=lambda r: r[:2])
        if c > rank:
            assert all(w is None for _, _, w in mine)
            continue
        want = sorted(((i is None, i or 0, w) for (i, _), w in zip(kept, gap / n @ vectors[:, c - 1] / math.sqrt(values[c - 1]), strict=True)),
                      key=lambda r: r[:2])
        a, b = np.array([r[2] for r in mine]), np.array([r[2] for r in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6
        assert {r.explained for r in got if r.component == c}.pop() == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
    assert {r.identity_error for r in got}.pop() < 1e-9


def test_whitening(spark):
    rng = np.random.default_rng(1)
    rows = clusters(rng, 400, 8) + ODD + [(None, [0.25] * 8, 1), (5, [0.125] * 8, 1), (5, [0.125] * 8, 1)]
    check_whitened(whitening.whiten(frame(spark, rows)).collect(), rows, 8, 8)


def test_whitening_of_badly_scaled_vectors(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(300, 12)) * 10.0 ** -np.arange(-4, 8)[None, :] ** 1.0
    v[:, 3] = v[:, 0] * 0.5 + rng.normal(size=300) * 0.01
    rows = [(i, [float(np.float32(c)) for c in row], 0) for i, row in enumerate(v)]
    kept = np.array([x for _, x in whole(rows, 12)])
    rank = np.linalg.matrix_rank(len(kept) * kept - kept.sum(0))
    check_whitened(whitening.whiten(frame(spark, rows)).collect(), rows, 12, rank)


def test_whitening_without_full_rank(spark):
    rows = [(i, [float(i % 5), float(i % 3), 1.0, float(i % 5), 0.0], 0) for i in range(40)]
    check_whitened(whitening.whiten(frame(spark, rows)).collect(), rows, 5, 2)
    same = [(i, [0.5, 0.25], 0) for i in range(7)]
    got = whitening.whiten(frame(spark, same)).collect()
    assert len(got) == 14 and {(r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(0, None, None, None)}
    assert whitening.whiten(frame(spark, [])).count() == 0 == whitening.whiten(frame(spark, ODD[:1])).count()


def test_shifted_passes_settle(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(500, 6))
    base[:, 5] = base[:, 0] * 1000 + base[:, 5] / 500
    model = whitening.fit(frame(spark, [(i, [float(c) for c in r], 0) for i, r in enumerate(base)]))
    assert 2 <= model.passes <= 4


def plain_negatives(rows, dim):
    """The contract, row by row."""
    kept = [(i, (y + 1) % 10 if i % 7 == 0 else y, np.floor(256 * np.array(v)).astype(np.int64)) for i, v, y in rows
            if None not in (i, y, v) and len(v) == dim and all(c is not None and math.isfinite(c) and abs(c) < 2**20 for c in v)]
    out = []
    seen = set()
    for i, y, v in kept:
        if i % 100 or (i, y, v.tobytes()) in seen:
            continue
        seen.add((i, y, v.tobytes()))
        near = sorted((-int(v @ u), j) for j, z, u in kept if j != i and z == y)[:5]
        away = sorted((-int(v @ u), j) for j, z, u in kept if j != i and z != y)
        for p, j in near:
            fits = [(s, k) for s, k in away if 80 * -p <= 100 * -s <= 100 * -p][:5]
            out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives(spark, seed):
    rng = np.random.default_rng(seed)
    rows = clusters(rng, 1500, 8, spread=0.25 * seed) + ODD
    # Many equal vectors (ties), an anchor that is repeated whole, one repeated with other entries, opposite directions.
    rows += [(3000 + i, rows[300][1], i % 10) for i in range(300)] + [rows[500], rows[500], (700, rows[701][1], 3)]
    rows += [(5000 + 50 * i, [-c for c in rows[i][1]], 4) for i in range(8)] + [(None, rows[1][1], 1), (8, rows[2][1], None)]
    relabel = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(frame(spark, rows).repartition(5), relabel=relabel)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain_negatives(rows, 8)
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == want


def test_hard_negatives_few_rows(spark):
    rng = np.random.default_rng(5)
    few = [(100 * i, v, y % 2) for i, v, y in clusters(rng, 6, 4)]
    relabel = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    assert sorted(map(tuple, hard_negatives.mine(frame(spark, few), relabel=relabel).collect())) == plain_negatives(few, 4)
    assert hard_negatives.mine(frame(spark, [])).count() == 0 == hard_negatives.mine(frame(spark, ODD[:4])).count()
    zero = [(i, [0.0, 0.0], i % 2) for i in range(0, 300, 50)]
    assert sorted(map(tuple, hard_negatives.mine(frame(spark, zero), relabel=relabel).collect())) == plain_negatives(zero, 2)


def test_ranges_rule_out_siblings():
    """Clustered rows: a narrow window leaves few leaves, and none that holds a row of the window goes."""
    rng = np.random.default_rng(7)
    v = np.array([r[1] for r in clusters(rng, 3000, 6, groups=40, spread=0.05)])
    x = np.floor(256 * v)
    top = int((x * x).sum(1).max())
    lifted = hard_negatives._lifted(np, x, top)
    tree = hard_negatives.Tree(np, lifted[:1000])
    leaf = tree.leaf_of(np, lifted)
    for node in tree.nodes:
        k = len(node.children)
        node.low, node.high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
    for row, at in zip(lifted, leaf, strict=True):
        for n, j in tree.paths[at]:
            d = hard_negatives._near(np, row[None], tree.nodes[n].points)[0]
            tree.nodes[n].low[:, j] = np.minimum(tree.nodes[n].low[:, j], d)
            tree.nodes[n].high[:, j] = np.maximum(tree.nodes[n].high[:, j], d)
    f = x[:50]
    scores = f @ x.T
    high = np.sort(scores, axis=1)[:, -6:-5]
    base = (f * f).sum(1)[:, None] + top
    near, far = np.sqrt(np.maximum(base - 2 * high, 0)), np.sqrt(np.maximum(base - 2 * 0.95 * high, 0))
    met = tree.meets(np, np.column_stack([f, np.zeros(50)]), near, far, 1e-3)
    inside = (scores <= high) & (scores >= 0.95 * high)
    assert all(met[a, leaf[i]] for a, i in zip(*np.nonzero(inside), strict=True))
    assert met.mean() < 0.5
