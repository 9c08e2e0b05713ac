"""Toxicity, decontamination, mixing and LM scores: held-out accuracy and plain Python versions."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from cases import empty, frame, noise, odd_rows
from pyspark.sql import functions as F

from meterlake.llm import decontaminate, lm, mixing, queries, toxicity
from meterlake.llm.common import read



def test_toxicity_on_held_out_labels(spark):
    docs, labels = read(spark, "/root/testdata/sf0.1", "documents"), read(spark, "/root/testdata/sf0.1", "labels")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = toxicity.fit(toxicity.sample_labelled(docs, labels.where(half), 1500))
    found = toxicity.score(docs, model).join(labels.where(~half).select("doc_id", F.col("toxic").alias("is")), "doc_id")
    n = {(r["is"], r.toxic): r["count"] for r in found.groupBy("is", "toxic").count().collect()}
    assert n.get((1, True), 0) >= 0.7 * (n.get((1, True), 0) + n.get((1, False), 0))
    assert n.get((0, True), 0) <= 0.01 * n[0, False]


def test_severity_grows_with_insults(spark):
    rng = random.Random(1)
    plain = [noise(rng, 4, "abcdef") for _ in range(200)]
    bad = ["vile", "nasty", "awful", "rotten"]
    rows, labels = [], []
    for i in range(400):
        k = rng.randint(1, 4) if i % 4 == 0 else 0
        rows.append((i, " ".join(rng.choices(plain, k=40) + rng.sample(bad, k))))
        labels.append((i, 1, int(k > 0)))
    docs = frame(spark, rows)
    model = toxicity.fit(toxicity.sample_labelled(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    assert len(model.cuts) == 2 and model.cuts[0] < model.cuts[1]
    s = [model.expected(" ".join(plain[:30] + bad[:k])) for k in range(5)]
    assert s == sorted(s) and s[0] < 0.3 < 1 < s[4] <= 2
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, t in labels if not t}
    assert toxicity.score(frame(spark, odd_rows()), model).count() == len(odd_rows())
    assert toxicity.score(empty(spark), model).count() == 0


def test_toxicity_without_both_classes(spark):
    for rows in ([], [(1, 0)], [(1, 1)], [(None, 1), (1, None)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        model = toxicity.fit(toxicity.sample_labelled(frame(spark, odd_rows()), labels))
        assert model.expected("anything") == 0


def test_toxicity_samples_one_row_per_labelled_id(spark):
    rows = [(i % 5, f"text {i}") for i in range(100)] + [(i, None) for i in range(5)]
    labels = spark.createDataFrame([(i, int(i == 0)) for i in range(5)], "doc_id long, toxic int")
    one, two = (sorted(map(tuple, toxicity.sample_labelled(frame(spark, r), labels, 4).collect())) for r in (rows, rows[::-1]))
    assert one == two and len({d for d, _, _ in one}) == len(one) == 4
    assert all(t is not None for _, t, _ in one)


def plain_alignment(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1][j + 1] = max(0, h[i][j] + (2 if x == y else -1), h[i][j + 1] - 1, h[i + 1][j] - 1)
    return max(map(max, h))


def test_alignment_scores():
    rng = random.Random(2)
    for _ in range(60):
        a = np.array([rng.randrange(6) for _ in range(rng.randint(1, 25))])
        b = np.array([rng.randrange(6) for _ in range(rng.randint(1, 40))])
        score, first, last = decontaminate.smith_waterman(np, a, b)
        assert score == plain_alignment(a, b)
        if score:
            assert plain_alignment(a, b[first:last + 1]) == score


def test_leaks_exact_edited_and_clean(spark):
    rng = random.Random(3)
    words = [noise(rng, 5, "abcdefghij") for _ in range(400)]
    items = [(i, " ".join(rng.choices(words, k=30))) for i in range(20)] + [(50, None), (51, "a b"), (None, "x y z")]
    rows, want = [], set()
    for i in range(120):
        body, item = rng.choices(words, k=rng.randint(0, 200)), None
        if i % 3 == 0:
            item = rng.randrange(20)
            copy = items[item][1].split()
            for _ in range(i % 7):
                copy[rng.randrange(len(copy))] = "edited"
            at = rng.randint(0, len(body))
            body[at:at] = [w.upper() + "," for w in copy]
            want.add((i, item))
        rows.append((i, " ".join(body)))
    docs, bench = frame(spark, rows + odd_rows()), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()}
    want |= {(4, 51), (11, 51)}  # two odd rows hold the two words of item 51
    assert got == want
    blocks = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench, block_bytes=600).collect()}
    assert blocks == want
    kept = decontaminate.drop_leaked(docs, bench)
    assert kept.columns == docs.columns
    leaked = {d for d, i in want if i != 51}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _ in rows + odd_rows() if i not in leaked)
    assert decontaminate.find_leaks(empty(spark), bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.where("false")).count() == 0


def test_leaks_with_short_intact_runs(spark):
    item = [f"w{i}" for i in range(30)]
    longer = [x for i, w in enumerate(item) for x in ([w, f"extra{i}"] if i % 3 == 2 else [w])]
    replaced = [f"other{i}" if i % 4 == 3 else w for i, w in enumerate(item)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    for copy in (longer, replaced):  # alone in the corpus: the triples broken by the edits are in no document
        got = decontaminate.find_leaks(frame(spark, [(7, " ".join(["before", *copy, "after"])), (8, "w0 w1 x")]), bench)
        assert [(r.doc_id, r.item_id) for r in got.collect()] == [(7, 1)]


def test_leaks_of_a_long_run_below_the_share(spark):
    item = [f"w{i}" for i in range(59)]
    rows = [(n, " ".join([*(f"a{i}" for i in range(9)), *item[20:20 + n], *(f"b{i}" for i in range(9))])) for n in (12, 13, 28)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: (r.score, r.first_word, r.last_word, r.share) for r in decontaminate.find_leaks(frame(spark, rows), bench).collect()}
    assert got == {n: (2 * n, 9, 8 + n, n / 59) for n in (13, 28)}


def test_passages_reach_back_to_the_earliest_seed():
    item = [f"w{i}" for i in range(10)]
    items = decontaminate.number_items(np, [(0, item)])
    keys = np.unique(decontaminate.pair_keys(np, items.words, len(items.names), True)[1])
    seeds = decontaminate.pick_seeds(np, items, keys, np.ones(len(keys), np.int64), 0.5, 13)
    assert seeds.need.tolist() == [3] and set(range(9)) - set(seeds.offset.tolist()) == {7}  # 4 places hit, 3 needed; the last has one pair
    found = [-1] * 30 + [items.names[w] for w in ("w0", "w1", "w2", "w7", "w8", "w9")] + [-1] * 2
    got = list(decontaminate.passages(np, np.array(found), items, seeds, 0.5))
    assert got == [(0, 26 - 10, 30 + 10 + 10)]  # w8 at 34 is word 8 of an item that begins at 26


def test_rare_places_are_the_seeds():
    items = decontaminate.number_items(np, [(0, [f"w{i}" for i in range(20)])])
    keys = np.unique(decontaminate.pair_keys(np, items.words, len(items.names), True)[1])
    counts = np.where(keys // 20 < 6, 1000, 1)  # pairs that begin with one of the first six words are common
    seeds = decontaminate.pick_seeds(np, items, keys, counts, 0.5, 99)
    assert set(seeds.offset.tolist()) == set(range(6, 19)) and seeds.need.tolist() == [3]  # 9 places hit: 6 may go


def test_leaks_without_three_words_in_a_row(spark):
    item = [f"w{i}" for i in range(30)]
    inserted = [x for i, w in enumerate(item) for x in ([w, f"extra{i}"] if i % 2 else [w])]
    replaced = [f"other{i}" if i % 3 == 2 else w for i, w in enumerate(item)]
    spread = [x for i, w in enumerate(item) for x in (w, f"extra{i}")]
    dropped = [w for i, w in enumerate(item) if i % 4 != 3]
    copies = [inserted, replaced, spread, dropped]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = [(i, " ".join(["before", *c, "after"])) for i, c in enumerate(copies)] + [(9, "w0 w1 w2 and w7 w8")]
    got = {r.doc_id: r.score for r in decontaminate.find_leaks(frame(spark, rows), bench).collect()}
    assert got == {i: plain_alignment(item, c) for i, c in enumerate(copies)} and min(got.values()) >= 30


def test_short_items_match_as_a_whole(spark):
    bench = spark.createDataFrame([(1, "red"), (2, "red fox"), (3, "a red fox"), (4, "..."), (5, "")], "item_id long, text string")
    rows = [(1, "Red!"), (2, "one red, fox"), (3, "fox red"), (4, "a red fox ran"), (5, "red the fox"), (6, "nothing")]
    docs = frame(spark, rows)
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == {(d, 1) for d in range(1, 6)} | {(2, 2), (4, 2), (2, 3), (4, 3), (5, 3)}
    assert {r.doc_id for r in decontaminate.drop_leaked(docs, bench).collect()} == {1, 3, 6}


def edited(rng, words, vocabulary):
    """A copy with words replaced, left out or put in, one in two to one in ten."""
    out, rate = [], rng.choice((0.5, 0.4, 0.3, 0.2, 0.1))
    for w in words:
        kind = rng.randrange(3) if rng.random() < rate else 3
        out += ([rng.choice(vocabulary)], [], [w, rng.choice(vocabulary)], [w])[kind]
    return out


@pytest.mark.parametrize("vocabulary_size, share", [(12, 0.5), (60, 0.5), (2000, 0.5), (200, 0.7), (200, 0.35)])
def test_leaks_equal_all_alignments(spark, vocabulary_size, share):
    """Every document against every item by the plain dynamic programme: the same pairs and scores."""
    rng = random.Random(vocabulary_size)
    vocabulary = [f"v{i}" for i in range(vocabulary_size)]
    items = [(i, rng.choices(vocabulary, k=rng.choice((3, 4, 5, 8, 12, 13, 20, 30)))) for i in range(12)]
    rows = []
    for d in range(60):
        body = rng.choices(vocabulary, k=rng.randint(0, 25))
        if d % 2:
            at = rng.randint(0, len(body))
            body[at:at] = edited(rng, rng.choice(items)[1], vocabulary)
        rows.append((d, body))
    want = {}
    for d, body in rows:
        for i, item in items:
            score = plain_alignment(item, body)
            run = any(item[a:a + 13] == body[b:b + 13] for a in range(len(item) - 12) for b in range(len(body) - 12))
            if run or score >= share * 2 * len(item):
                want[d, i] = score
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string")
    docs = frame(spark, [(d, " ".join(t)) for d, t in rows])
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.find_leaks(docs, bench, share).collect()}
    assert got == want and want


TARGETS = {"good": 0.9, "poor": 0.06, "toxic": 0.04}


def test_mix_meets_targets(spark):
    docs, labels = read(spark, "/root/testdata/sf0.01", "documents"), mixing.label_domains(read(spark, "/root/testdata/sf0.01", "labels"))
    got = mixing.mix(docs, labels, TARGETS).collect()
    assert len(got) == docs.count() and min(r.rate for r in got) >= 0
    total = sum(r.n_tokens for r in got)
    for d, w in TARGETS.items():
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in got) / total - w) <= 0.002 * w + 1e-9
    marks = {r.doc_id: r.domain for r in labels.collect()}
    right = [r.domain == marks[r.doc_id] for r in got if marks.get(r.doc_id) in ("good", "poor")]
    assert sum(right) >= 0.9 * len(right)


def test_rates_are_a_least_squares_solution(spark):
    rng = random.Random(5)
    rows = [(i, rng.randint(1, 500), *rng.choice([(64, 0, 0), (0, 64, 0), (32, 32, 0), (8, 8, 48)])) for i in range(200)]
    found = spark.createDataFrame(rows, "doc_id long, n_tokens long, q0 int, q1 int, q2 int")
    fit = mixing.fit_rates(found, [0.2, 0.7, 0.1], steps=100, close=1e-6)
    p = np.array([r[2:] for r in rows]) / 64
    m = np.array([r[1] for r in rows])
    r, y, pace = np.ones(len(rows)), np.ones(len(rows)), 1.0
    for move, carry in fit.steps:
        new = np.maximum(0, y - p @ np.array(move))
        y, r = new + carry * (new - r), new
    assert np.allclose((r * m) @ p, fit.reached, rtol=1e-6)
    assert np.allclose(fit.reached, fit.targets, rtol=1e-3)
    rates = found.select("doc_id", fit.rate([F.col(f"q{i}") / 64 for i in range(3)]).alias("r")).orderBy("doc_id").collect()
    assert np.allclose([x.r for x in rates], r)


def test_mix_odd_rows(spark):
    labels = spark.createDataFrame([(1, "good"), (None, "poor"), (11, "poor")], "doc_id long, domain string")
    rows = odd_rows()
    got = mixing.mix(frame(spark, rows), labels, TARGETS).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert all(abs(sum(r[f"p_{d}"] for d in TARGETS) - 1) < 1e-9 and r.rate >= 0 for r in got)
    assert mixing.mix(empty(spark), labels, TARGETS).count() == 0
    none = labels.where("false")
    assert mixing.mix(frame(spark, rows), none, TARGETS).count() == len(rows)
    docs = frame(spark, rows)
    assert mixing.sample_mix(docs, labels, TARGETS, "good").columns == docs.columns


def test_thinning_keeps_the_wanted_domain(spark):
    docs, labels = read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels")
    clean = docs.join(labels.where("toxic = 1").select("doc_id"), "doc_id", "left_anti")
    marks = mixing.label_quality(labels)
    for targets in ({"good": 0.97, "poor": 0.03}, {"good": 0.5, "poor": 0.5}):
        rated = {r.doc_id: r for r in mixing.mix(clean, marks, targets).collect()}
        kept = {r.doc_id for r in mixing.sample_mix(clean, marks, targets, "good").select("doc_id").collect()}
        assert {i for i, r in rated.items() if r.domain == "good"} <= kept
        poor = [i for i, r in rated.items() if r.domain == "poor"]
        share = sum(i in kept for i in poor) / len(poor)
        assert share < 0.75 if targets["poor"] < 0.1 else share == 1


def plain_scores(train, rows, order, alpha, least):
    def tokens(t):
        return (t or "").encode().lower().split()

    c = [Counter() for _ in range(order + 1)]
    for _, t in train:
        w = tokens(t)
        for n in range(1, order + 1):
            c[n].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    total = sum(c[1].values())

    def s(ctx, w):
        g = (*ctx, w)
        if not ctx:
            return math.log(c[1][g] / total) if c[1][g] else math.log(1 / (total + 1))
        if c[len(g)][g] >= least:
            return math.log(c[len(g)][g] / c[len(ctx)][ctx])
        return math.log(alpha) + s(ctx[1:], w)

    out = []
    for d, t in rows:
        w = tokens(t)
        out.append((d, len(w), sum(s(tuple(w[max(0, i - order + 1):i]), w[i]) for i in range(len(w)))))
    return out


@pytest.mark.parametrize("order,part", [(2, None), (3, 40)])
def test_lm_scores(spark, order, part):
    rng = random.Random(9)
    rows = odd_rows() + [(200 + i, noise(rng, 300, "abc  ")) for i in range(60)]
    corpus = rows if part is None else rows[:part]
    got = lm.score(frame(spark, rows), frame(spark, corpus), order).collect()
    want = plain_scores(corpus, rows, order, lm.ALPHA, lm.MIN_COUNT)
    def key(x):
        return (repr(x[0]), x[1], round(x[2], 1))

    a = sorted(((r.doc_id, r.n_words, r.log_score) for r in got), key=key)
    b = sorted(want, key=key)
    assert [x[:2] for x in a] == [x[:2] for x in b]
    assert np.allclose([x[2] for x in a], [x[2] for x in b], rtol=1e-5, atol=0.01)
    assert all((r.mean_log_score is None) == (r.n_words == 0) for r in got)


def test_lm_query_counts_pairs_met_once(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, "/root/testdata/sf0.001", "documents").collect()]
    want = {d: (n, s) for d, n, s in plain_scores(rows, rows, 2, lm.ALPHA, 1)}
    got = {r.doc_id: (r.n_words, r.log_score) for r in queries.op8_lm_scores(spark, "/root/testdata/sf0.001").collect()}
    assert {d: n for d, (n, _) in got.items()} == {d: n for d, (n, _) in want.items()}
    assert np.allclose([got[d][1] for d in want], [s for _, s in want.values()], rtol=1e-5, atol=0.01)


@pytest.mark.parametrize("limit", [None, 0])
def test_lm_scores_of_the_corpus_itself(spark, limit):
    """Every pair counts; words settled in the tasks, or joined like pairs when their table is too large to broadcast."""
    rng = random.Random(4)
    rows = odd_rows() + [(300 + i, noise(rng, 200, "ab  ")) for i in range(20)]
    if limit is not None:
        spark.conf.set("meterlake.broadcast.maxBytes", str(limit))
    try:
        got = [(r.doc_id, r.n_words, r.log_score) for r in lm.score(frame(spark, rows), min_count=1).collect()]
    finally:
        spark.conf.unset("meterlake.broadcast.maxBytes")
    want = plain_scores(rows, rows, 2, lm.ALPHA, 1)
    a, b = (sorted(x, key=lambda r: (repr(r[0]), r[1], round(r[2], 1))) for x in (got, want))
    assert [x[:2] for x in a] == [x[:2] for x in b]
    assert np.allclose([x[2] for x in a], [x[2] for x in b], rtol=1e-5, atol=0.01)


def test_lm_backs_off_on_held_out_documents(spark):
    corpus, rows = [(1, "a b a b c")], [(2, "a c b z")]
    (got,) = lm.score(frame(spark, rows), frame(spark, corpus), min_count=1).collect()
    want = plain_scores(corpus, rows, 2, lm.ALPHA, 1)[0][2]
    assert got.log_score == pytest.approx(want, abs=1e-3)
    assert want < math.log(2 / 5) + 3 * math.log(lm.ALPHA)      # all three later words are backed off


def test_lm_empty(spark):
    assert lm.score(empty(spark)).count() == 0
    rows = lm.score(frame(spark, [(1, "a b")]), empty(spark)).collect()
    assert rows[0].log_score == pytest.approx(math.log(0.4))
