"""SimHash groups, components, shards and repeated passages against plain Python."""

import random
import zlib
from collections import Counter

import brute
import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from cases import empty, frame, noise, odd_rows
from pyspark.sql import functions as F

from meterlake.llm import graph, shards, simhash_dups, suffix_dups


def near_copies():
    rng = random.Random(3)
    rows = []
    for i in range(6):
        w = [noise(rng, 4, "abcdefghijkl") for _ in range(150)]
        for j in range(8):
            v = list(w)
            for _ in range(j):
                v[rng.randrange(len(v))] = noise(rng, 4, "ABCxyz")
            rows.append((100 + 10 * i + j, (" " if j % 2 else "\n").join(v)))
    return rows


@pytest.fixture()
def estimated_broadcasts(spark):
    """Spark's own default: tables that it takes for smaller than 10 MB are broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_simhash_matches_all_pairs(spark):
    rows = odd_rows() + near_copies()
    got = [(r.doc_id, f"{r.fp & (2**64 - 1):016x}", r.component_id)
           for r in simhash_dups.near_duplicates(frame(spark, rows)).collect()]
    want = brute.simhash(rows)
    assert sorted(got, key=repr) == want
    assert any(d is not None and d != c for d, _, c in want)


def test_links_at_every_distance(spark):
    rng = random.Random(4)
    fps = set()
    for _ in range(30):
        a = rng.getrandbits(64)
        fps |= {a} | {a ^ sum(1 << b for b in rng.sample(range(64), n)) for n in range(1, 8)}
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    for bits in (0, 3, 4):
        got = {(r.a, r.b) for r in simhash_dups.fingerprint_links(spark.createDataFrame(signed, "fp long"), bits).collect()}
        want = {(min(x, y), max(x, y)) for (x,) in signed for (y,) in signed
                if x != y and ((x ^ y) & (2**64 - 1)).bit_count() <= bits}
        assert got == want


def test_postings_are_never_broadcast(spark, estimated_broadcasts):
    """Spark's estimate for exploded postings is that of the table before, too low by the number of position sets."""
    fps = spark.range(2000).select(F.xxhash64("id").alias("fp"))
    plan = simhash_dups.fingerprint_links(fps)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_keep_one(spark):
    docs = frame(spark, near_copies() + [(100, near_copies()[0][1]), (None, "no id"), (None, "no id")])
    kept = simhash_dups.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    roots = {r[2] for r in brute.simhash([(r.doc_id, r.text) for r in docs.collect()]) if r[0] is not None}
    assert ids == Counter({**dict.fromkeys(roots, 1), None: 2})
    assert simhash_dups.keep_one(empty(spark)).count() == 0


def test_pipeline_stage_never_broadcasts_postings(spark, estimated_broadcasts, monkeypatch):
    plans = []

    def seen(links):
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return graph.components(links)

    monkeypatch.setattr(simhash_dups, "components", seen)
    docs = frame(spark, near_copies())
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, None)
    assert {r.doc_id for r in kept.collect()} == {r[2] for r in brute.simhash(near_copies())}
    (plan,) = plans
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, i) for i in range(201, 260)] + [(7, 7)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((top(a), top(b)))
            up[y] = x
    got = {(r.node, r.root) for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {(x, top(x)) for x in list(up)}


def test_hilbert_steps_are_neighbours(spark):
    for n, bits in ((2, 3), (3, 2)):
        side = 1 << bits
        cells = spark.range(side**n)
        axes = [F.expr(f"cast(id div {side**k} % {side} as int)") for k in range(n)]
        rows = cells.select(*[a.alias(f"x{i}") for i, a in enumerate(axes)],
                            shards.hilbert_index(axes, bits).alias("h")).orderBy("h").collect()
        assert [r.h for r in rows] == list(range(side**n))
        for a, b in zip(rows, rows[1:], strict=False):
            assert sum(abs(a[i] - b[i]) for i in range(n)) == 1


def test_shards(spark):
    rows = odd_rows() + [(i, "same") for i in range(1000, 1100)]
    docs = frame(spark, rows)
    got = shards.assign_shards(docs, 24).collect()
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    laid = shards.shard_documents(docs, 24)
    assert Counter((r.doc_id, r.shard) for r in laid.collect()) == Counter((r.doc_id, r.shard) for r in got)
    assert laid.columns == docs.columns
    assert shards.assign_shards(empty(spark)).count() == 0 == shards.shard_documents(empty(spark)).count()
    assert Counter(r.shard for r in shards.assign_shards(docs.limit(5), 24).collect()).most_common(1)[0][1] == 1


def test_equal_rows_are_dealt_over_the_shards(spark):
    docs = frame(spark, [(None, "the same text")] * 240)
    assert set(Counter(r.shard for r in shards.shard_documents(docs, 24).collect()).values()) == {10}


def test_shards_prune(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), F.expr("cast(id % 97 as int)")).alias("text"),
                                    (F.col("id") % 4).cast("string").alias("lang"), (F.col("id") % 9).cast("string").alias("source"))
    spread = (shards.shard_documents(docs, 24).groupBy("lang", "source").agg(F.countDistinct("shard").alias("n"))
              .agg(F.avg("n")).first()[0])
    assert spread < 5


def passages(length):
    rng = random.Random(7)
    base = [noise(rng, rng.randint(10, 6 * length)) for _ in range(10)]
    texts = list(base)
    for _ in range(25):
        b = rng.choice(base)
        a = rng.randint(0, len(b))
        piece = list(b[a:a + rng.randint(length // 2, 3 * length)])
        for _ in range(rng.randint(0, 2)):
            if piece:
                piece[rng.randrange(len(piece))] = "#"
        texts.append(noise(rng, rng.randint(0, 300)) + "".join(piece) + noise(rng, rng.randint(0, 300)))
    return texts + ["a" * 3 * length, "ab" * length, "a" * (length + 20), None, "", texts[3], texts[3],
                    "xyz" * length + noise(rng, 50), "é" * length, base[0][:length], base[0][:length - 1], noise(rng, 900, "ab")]


@pytest.mark.parametrize("length", [400, 40])
def test_repeats(spark, length):
    rows = list(enumerate(passages(length)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dups.remove_repeats(frame(spark, rows), length).collect()}
    want = brute.repeats([(t or "").encode() for _, t in rows], length)
    assert got == dict(enumerate(want))


def test_repeats_odd_rows(spark):
    rows = odd_rows()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dups.remove_repeats(frame(spark, rows)).collect()]
    want = [(i, *w) for (i, _), w in zip(rows, brute.repeats([(t or "").encode() for _, t in rows]), strict=True)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert suffix_dups.remove_repeats(empty(spark)).count() == 0


def test_suffix_order(spark):
    rng = random.Random(8)
    strings = [[rng.randint(1, 2) for _ in range(rng.randint(1, 40))] for _ in range(12)] + [[1] * 30, [1] * 29]
    rows = [(d, 5, j, c, j, j + 1) for d, s in enumerate(strings) for j, c in enumerate(s)]
    string = spark.createDataFrame(rows, "dn long, s long, j long, sym long, t long, e long")
    got = [(r.rank, strings[r.dn][r.j:]) for r in suffix_dups.suffix_ranks(string, 100).collect()]
    assert sorted(r for r, _ in got) == list(range(len(rows)))
    order = [s for _, s in sorted(got, key=lambda x: x[0])]
    assert order == sorted(order)


def test_windows_are_hashed_in_blocks(monkeypatch):
    rng = random.Random(9)
    scheme = suffix_dups.Scheme(40)
    texts = [noise(rng, n).encode() for n in (39, 40, 700, 0, 90, 2500, 41)]
    for block, group, most in ((1 << 20, 1 << 16, 1), (1 << 20, 1, 5), (300, 200, 99)):
        monkeypatch.setattr(suffix_dups, "BLOCK", block)
        monkeypatch.setattr(suffix_dups, "GROUP", group)
        parser = suffix_dups.Parser(scheme)
        blocks = list(parser.anchors(texts))
        assert len(blocks) <= most
        found = [tuple(int(v) for v in r) for b in blocks for r in zip(*b, strict=True)]
        # Every window start of every text is served once, by an anchor at or after it.
        assert sorted((r[0], i) for r in found for i in range(r[2], r[3] + 1)) == [
            (d, i) for d, text in enumerate(texts) for i in range(len(text) - 39)]
        assert all(0 <= r[1] - i < scheme.w for r in found for i in range(r[2], r[3] + 1))
        for d in (2, 5):
            t, lo, hi = (np.array([r[c] for r in found if r[0] == d]) for c in (1, 2, 3))
            made = list(parser.windows(texts[d], t, lo, hi, t * 10))
            assert len(made) <= (1 if block > 2500 else 20)
            got = [r for b in made for r in zip(*(c.tolist() for c in b), strict=True)]
            at = {i: x for x, a, z in zip(t.tolist(), lo.tolist(), hi.tolist(), strict=True) for i in range(a, z + 1)}
            assert [(i, rank) for _, rank, _, i in got] == [(i, at[i] * 10) for i in range(len(texts[d]) - 39)]
            same = {}
            for _, _, digest, i in got:
                assert same.setdefault(texts[d][i:i + 40], digest) == digest
            assert len(set(same.values())) == len(same)


def test_ranges_of_a_text_are_put_together():
    runs = [[(3, 5), (9, 9), (6, 7), (3, 4)], [(2**30, 2**31 - 2), (0, 0), (0, 0)], [(7, 9), (0, 20), (4, 5), (22, 22)]]
    packed = pa.array([[(a << 32) + z for a, z in r] for r in runs], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([4, 5, 6]), packed], ["k1", "k2", "ranges"])
    (out,) = suffix_dups._merge([batch])
    assert out.to_pylist() == [
        {"k1": 1, "k2": 4, "first": [3, 9], "last": [7, 9]},
        {"k1": 2, "k2": 5, "first": [0, 2**30], "last": [0, 2**31 - 2]},
        {"k1": 3, "k2": 6, "first": [0, 22], "last": [20, 22]}]
