"""The n-gram Jaccard join against all pairs."""

import random

import brute
import numpy as np
import pytest
from cases import empty, frame, noise, odd_rows
from pyspark.sql import functions as F

from meterlake.llm import jaccard_join
from meterlake.llm.lm import ChunkHashes


def copies(rng, groups, size, words, edits):
    rows, i = [], 0
    for _ in range(groups):
        base = [noise(rng, 5, "abcdefghijkl") for _ in range(words)]
        for j in range(size):
            w = list(base)
            for _ in range(rng.randint(0, edits)):
                w[rng.randrange(len(w))] = noise(rng, 5, "ABCxyz")
            rows.append((1000 + i, (" ", "\n", "\t ")[j % 3].join(w[rng.choice((0, 0, 1)):])))
            i += 1
    return rows


@pytest.mark.parametrize("percent,shingle", [(85, 4), (60, 2), (100, 4)])
def test_components_match_all_pairs(spark, percent, shingle):
    rng = random.Random(percent)
    rows = copies(rng, 4, 15, 120, 6) + copies(rng, 3, 6, 40, 2)
    shared = " ".join(noise(rng, 5) for _ in range(60))
    rows += [(5000 + i, shared + " " + noise(rng, 200, "mnopq ")) for i in range(20)]       # one long passage in all of them
    rows += [(6000 + i, " ".join(f"w{k}" for k in range(3 * i, 3 * i + 60))) for i in range(30)]   # a chain
    rows += odd_rows() + [(7000, "Two Words"), (7001, "two\twords"), (7002, "two words more")]
    docs = frame(spark, [(i if i is None else i, t) for i, t in rows])
    got = sorted(map(tuple, jaccard_join.near_copies(docs.repartition(3), shingle, percent).collect()), key=repr)
    want = brute.jaccard(rows, shingle, percent)
    assert got == want
    assert any(d is not None and d != c for d, _, c in want)


def test_edges_of_the_similarity(spark):
    """Sets whose overlap is just enough, and one n-gram short of it."""
    rows = []
    for i, n in enumerate((17, 37, 40, 57, 100, 200)):
        base = [f"g{i}x{k}" for k in range(n)]
        for j, cut in enumerate((0, 100 * n // 85 - n, 100 * n // 85 - n + 1)):
            rows.append((100 * i + j, " ".join(base + [f"new{i}q{j}q{k}" for k in range(cut)])))
    got = sorted(map(tuple, jaccard_join.near_copies(frame(spark, rows), 1, 85).collect()), key=repr)
    want = brute.jaccard(rows, 1, 85)
    assert got == want and len({c for _, _, c in want}) > 6


def test_empty_and_wordless(spark):
    assert jaccard_join.near_copies(empty(spark)).count() == 0
    got = jaccard_join.near_copies(frame(spark, [(1, None), (2, ""), (3, " \n"), (None, None)])).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in got) == [(0, 0, None), (1, 0, 1), (2, 0, 2), (3, 0, 3)]


def test_text_sets():
    rng = random.Random(2)
    texts = [None, "", "a", "a b", "a b c", "a b c d", "A b C d", "a b c d e a b c d", *[noise(rng, 300, "ab ") for _ in range(20)]]
    for shingle in (1, 2, 4):
        gram, n = jaccard_join.text_sets(np, ChunkHashes(np), texts, shingle)
        sets = [brute.shingles(t, shingle) for t in texts]
        assert n.tolist() == [len(s) for s in sets]
        mine = np.split(gram, np.cumsum(n)[:-1])
        assert all(np.all(np.diff(g.astype(object)) > 0) for g in mine if len(g))
        for a in range(len(texts)):
            for b in range(len(texts)):
                assert len(np.intersect1d(mine[a], mine[b])) == len(sets[a] & sets[b])


def test_hot_list_makes_few_pairs(spark):
    """A group of near copies gives pairs in proportion to its members."""
    rng = random.Random(9)
    rows = copies(rng, 1, 300, 100, 1)
    sets = jaccard_join.document_sets(frame(spark, rows)).select("rid", "n", "grams").persist()
    counts = jaccard_join.count_cells(sets)
    met = jaccard_join.prefixes(sets, counts, 85)
    pairs = jaccard_join._hub_pairs(jaccard_join._open_lists(jaccard_join._label(met, None)), jaccard_join._label(met, None),
                                    sets.select("rid", "n"), 85)
    assert 0 < pairs.count() <= 300
    assert met.groupBy("h").count().agg(F.max("count")).first()[0] > 100


def test_base_text_is_the_hub(spark):
    """Copies that link with their base alone meet it in the first turn."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    spots = [set(rng.sample(range(120), 3)) for _ in range(200)]
    rows = [(i, " ".join(w if k not in spots[i] else f"x{i}_{k}" for k, w in enumerate(base))) for i in range(200)]
    rows.append((900, " ".join(base)))
    sets = jaccard_join.document_sets(frame(spark, rows)).persist()
    met = jaccard_join.prefixes(sets, jaccard_join.count_cells(sets), 85)
    labelled = jaccard_join._label(met, None)
    pairs = jaccard_join._hub_pairs(jaccard_join._open_lists(labelled), labelled, sets.select("rid", "n"), 85)
    hub = sets.where("doc_id = 900").first()["rid"]
    near = sum(hub in (p.a, p.b) for p in pairs.collect())
    assert near >= 150


def test_odd_ranges_keep_links(spark):
    """The bits in the join drop pairs of a hot list that can't link, and none that does."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(f"x{i}_{k}" if rng.random() < (0.06 if i % 2 else 0.008) else w for k, w in enumerate(base))) for i in range(120)]
    sets = jaccard_join.document_sets(frame(spark, rows)).persist()
    met = jaccard_join._label(jaccard_join.prefixes(sets, jaccard_join.count_cells(sets), 85), None)
    marked = met.join(sets.select("rid", *jaccard_join.MARKS), "rid")
    ids = {r.rid: r.doc_id for r in sets.select("rid", "doc_id").collect()}
    got = {tuple(sorted((ids[p.a], ids[p.b]))) for p in jaccard_join.cross_pairs(marked, 85).collect()}
    held = {i: brute.shingles(t, 4) for i, t in rows}
    want = {(a, b) for a in held for b in held if a < b and 100 * len(held[a] & held[b]) >= 85 * len(held[a] | held[b])}
    assert want <= got
    assert 100 < len(want) <= len(got) < len(want) + 300


def test_rarity_tables_travel_in_small_batches(spark, monkeypatch):
    rng = np.random.default_rng(3)
    batches = list(jaccard_join.table_batches(rng.integers(0, 9, jaccard_join.CELLS).astype(np.uint32)))
    assert max(b.nbytes for b in batches) < 1 << 20
    assert sum(b.num_rows for b in batches) == jaccard_join.CELLS // jaccard_join.SLICE
    # 64 slices, read back in batches of no more.
    asked = []
    plain = jaccard_join.batches_of
    monkeypatch.setattr(jaccard_join, "batches_of", lambda s, n: asked.append(n) or plain(s, n))
    grams = [np.sort(rng.integers(0, 2**63, 40, dtype=np.uint64)) for _ in range(50)]
    sets = spark.createDataFrame([(bytearray(g.tobytes()),) for g in grams], "grams binary").repartition(3)
    counts = jaccard_join.count_cells(sets)
    plainly = np.bincount((np.concatenate(grams) & np.uint64(jaccard_join.CELLS - 1)).astype(np.int64), minlength=jaccard_join.CELLS)
    assert (counts == plainly).all()
    assert asked[0] * jaccard_join.SLICE * 4 <= 4 << 20


def test_sets_are_made_from_texts_and_never_stored(spark, monkeypatch):
    """Sets are larger than the texts: no written table holds them, and the steps make the same ones from the texts."""
    kept, plain = {}, jaccard_join.stored

    def noted(df, name, *more, **named):
        kept.setdefault(name, df.columns)
        return plain(df, name, *more, **named)

    monkeypatch.setattr(jaccard_join, "stored", noted)
    rows = odd_rows() + copies(random.Random(7), 6, 5, 30, 2)
    got = sorted(map(tuple, jaccard_join.near_copies(frame(spark, rows)).collect()), key=repr)
    assert got == sorted(brute.jaccard(rows, 4, 85), key=repr)
    assert "texts" in kept and not any("grams" in columns for columns in kept.values())
    texts = jaccard_join.numbered_texts(frame(spark, rows)).persist()
    sets = jaccard_join.text_digests(texts, 4, grams=True).persist()
    counts = jaccard_join.count_cells(sets)
    assert (jaccard_join.count_cells(texts, shingle=4) == counts).all()
    assert sorted(jaccard_join.prefixes(texts, counts, 85, 4).collect()) == sorted(jaccard_join.prefixes(sets, counts, 85).collect())
