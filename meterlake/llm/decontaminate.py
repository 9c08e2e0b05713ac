"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The word pairs of the test items, adjacent and with one word between, are counted
over all documents, and each item keeps the rarest of its pairs as seeds. Where
a document holds enough seeds of an item, the passage around them is aligned
with the item by words. The test items are a stated query set: they are taken in
blocks of a bounded size, and each block meets all documents in Arrow batches.

Why no alignment is lost. An alignment with m of the item's n words matched and e
edits scores 2m - e. If that reaches the share s of the best score 2n, then
e <= 2m - 2sn, and at most m - sn of the m - 1 steps from one matched word to the
next hold two edits or more. The other steps, at least sn - 1, hold one edit or
none: there an item pair (adjacent or one apart) equals a document pair (adjacent or
one apart). So each such alignment hits ``least`` = ceil(sn - 1) places of its item, and
after the most common ``least`` - ``NEED`` places are left out it still hits ``NEED``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import Any, NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import doc_rows, stored
from meterlake.session import ship_package

MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SHARE = 0.5                    # of the score of an item aligned with itself
MIN_RUN = 13                       # words of an item in a row that count whatever their share of it
MIN_WORDS = 3                      # of an item, for its copies to drop a document
NEED = 3                           # seeds of an item in a passage before it is aligned
BLOCK_BYTES = 4 * 1024 * 1024      # of item texts held at once
CHUNK_CHARS = 1024 * 1024          # of document texts held as word numbers (one text at least)
HITS = 1 << 19                     # seed hits expanded at once
_WORDS = re.compile(r"[^\W_]+")
FOUND = "doc_id long, item_id long, score int, share double, first_word int, last_word int"


class Items(NamedTuple):
    """A block of items. Word numbers are those of the items' own words; -1 is any other word."""

    names: dict[str, int]
    words: Any    # the items' word numbers one after another, two gaps (-1) after each
    first: Any    # where each item begins in ``words``
    size: Any     # words of each item
    ids: Any      # item_id of each


class Seeds(NamedTuple):
    keys: Any     # sorted, different
    posts: Any    # key's place * number of items + item, sorted
    offset: Any   # of each post: word of the item where its pair begins
    need: Any     # by item: different offsets that a passage must hold
    least: Any    # by item: score that counts


def tokens(text: str | None) -> list[str]:
    """Lower-case runs of letters and digits: case, spacing and marks do not hide a copy."""
    return _WORDS.findall((text or "").lower())


def number_items(np, texts: list[tuple[int, list[str]]]) -> Items:
    names: dict[str, int] = {}
    words: list[int] = []
    first, size = [], []
    for _, found in texts:
        first.append(len(words))
        size.append(len(found))
        words += [names.setdefault(w, len(names)) for w in found]
        words += (-1, -1)
    return Items(names, np.array(words, np.int64), np.array(first, np.int64), np.array(size, np.int64),
                 np.array([item for item, _ in texts], np.int64))


def pair_keys(np, words, n_names: int, single: bool = False):
    """(place, key) of every pair of known words, adjacent or one apart; ``single``: of every known word too."""
    places, keys = [], []
    for step in (1, 2):
        place = np.flatnonzero((words[:-step] >= 0) & (words[step:] >= 0))
        places.append(place)
        keys.append(words[place] * n_names + words[place + step])
    if single:
        place = np.flatnonzero(words >= 0)
        places.append(place)
        keys.append(words[place] + n_names * n_names)
    return np.concatenate(places), np.concatenate(keys)


def key_places(np, keys, wanted):
    """(which of ``wanted`` are in the sorted ``keys``, their places there)."""
    at = np.searchsorted(keys, wanted)
    held = np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == wanted)
    return held, at[held]


def pick_seeds(np, items: Items, keys, counts, min_share: float, min_run: int) -> Seeds:
    """The rarest places of each item, enough for every alignment of ``min_share`` and every run of ``min_run`` words.

    ``keys`` are all keys of the items, ``counts`` how often the documents hold
    them. An item so short that one word would reach the share has all its
    places and counts only as a whole.
    """
    place, key = pair_keys(np, items.words, len(items.names), True)
    of = np.searchsorted(items.first, place, "right") - 1
    at = np.searchsorted(keys, key)
    lone = key >= len(items.names) ** 2
    weight = np.bincount(place[~lone], counts[at[~lone]], len(items.words))
    keep = np.zeros(len(items.words), bool)
    need, least = np.ones(len(items.size), np.int64), min_share * MATCH * items.size
    for item, (a, n) in enumerate(zip(items.first.tolist(), items.size.tolist(), strict=True)):
        must = math.ceil(min_share * n - 1 - 1e-9)
        if must < 1:
            least[item] = MATCH * n
            keep[a:a + n] = True
            continue
        order = np.argsort(weight[a:a + n - 1], kind="stable")
        window = min_run - 1 if n >= min_run else n
        need[item] = enough = max(1, min(NEED, must, window))
        keep[a + order[:n - 1 - (must - enough)]] = True
        if n >= min_run:
            rank = np.empty(n - 1, np.int64)
            rank[order] = np.arange(n - 1)
            views = np.lib.stride_tricks.sliding_window_view(rank, window)
            best = np.argpartition(views, enough - 1, axis=1)[:, :enough] + np.arange(len(views))[:, None]
            keep[a + best.ravel()] = True
    kept = keep[place] & (~lone | (items.size[of] == 1))
    used, where = np.unique(key[kept], return_inverse=True)
    posts = where * len(items.size) + of[kept]
    order = np.argsort(posts, kind="stable")
    return Seeds(used, posts[order], (place[kept] - items.first[of[kept]])[order], need, least)


def smith_waterman(np, item, passage) -> tuple[int, int, int]:
    """(score, first, last) of the best local alignment, as places in ``passage`` (word numbers)."""
    steps = np.arange(len(passage) + 1) * GAP

    def ends(a, b):
        """Best score and the place in ``b`` where it ends (the earliest)."""
        row, best, place = np.zeros(len(b) + 1, np.int64), 0, 0
        for x in a:
            cell = np.maximum(row[:-1] + np.where(b == x, MATCH, MISMATCH), row[1:] + GAP)
            new = np.concatenate([[0], np.maximum(cell, 0)])
            row = np.maximum.accumulate(new - steps[:len(new)]) + steps[:len(new)]
            k = int(row.argmax())
            if row[k] > best:
                best, place = int(row[k]), k
        return best, place

    score, last = ends(item, passage)
    if not score:
        return 0, 0, 0
    _, back = ends(item[::-1], passage[:last][::-1])
    return score, last - back, last - 1


def passages(np, words, items: Items, seeds: Seeds, min_share: float):
    """(item, first, end) of every passage of ``words`` that holds enough seeds of an item.

    A passage reaches as far around its seeds as an alignment of ``min_share``
    can; passages that meet are one. Gaps of two (-1) keep texts apart.
    """
    n_items, n_names = len(items.size), len(items.names)
    single = bool(len(seeds.keys)) and bool(seeds.keys[-1] >= n_names * n_names)
    place, key = pair_keys(np, words, n_names, single)
    held, at = key_places(np, seeds.keys, key)
    place = place[held]
    total = np.searchsorted(seeds.posts, (at + 1) * n_items) - np.searchsorted(seeds.posts, at * n_items)
    turns = max(1, -(-int(total.sum()) // HITS))
    cuts = np.linspace(0, n_items, min(turns, n_items) + 1).astype(np.int64).tolist()
    for low, high in zip(cuts, cuts[1:], strict=False):
        begin = np.searchsorted(seeds.posts, at * n_items + low)
        n = np.searchsorted(seeds.posts, at * n_items + high) - begin
        post = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - begin, n)
        if not len(post):
            continue
        item, offset = seeds.posts[post] % n_items, seeds.offset[post]
        start = np.repeat(place, n) - offset
        order = np.lexsort((start, item))
        item, offset, start = item[order], offset[order], start[order]
        reach = np.ceil(2 * (1 - min_share) * items.size).astype(np.int64)
        new = np.ones(len(item), bool)
        new[1:] = (np.diff(item) > 0) | (np.diff(start) > (items.size + 2 * reach)[item[1:]])
        group = np.cumsum(new) - 1
        widest = int(items.size.max()) + 1
        different = np.bincount(np.unique(group * widest + offset) // widest, minlength=int(group[-1]) + 1)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(item)) - 1
        for g in np.flatnonzero(different >= seeds.need[item[heads]]).tolist():
            i = int(item[heads[g]])
            yield i, int(start[heads[g]] - reach[i]), int(start[tails[g]] + items.size[i] + reach[i])


def _longest_run(np, item, passage) -> int:
    """Words in a row that both hold."""
    run, best = np.zeros(len(passage) + 1, np.int64), 0
    for x in item:
        run[1:] = np.where(passage == x, run[:-1] + 1, 0)
        best = max(best, int(run.max()))
    return best


def align(np, words, begins, items: Items, seeds: Seeds, min_share: float, min_run: int):
    """Best alignment of each text and item that reaches ``min_share`` or lies around a run of ``min_run`` words.

    ``words`` are the texts' word numbers, each text followed by two gaps;
    ``begins`` says where each text begins, with the end of the last. Gives
    {(text, item): (score, share, first, last)}. No alignment scores more than
    MATCH for each word that item and passage share, so passages that share
    too few for either are not aligned.
    """
    out: dict[tuple[int, int], tuple] = {}
    bounds = np.asarray(begins)
    for item, first, end in passages(np, words, items, seeds, min_share):
        n = int(items.size[item])
        left = items.words[items.first[item]:items.first[item] + n]
        # seeds of neighbouring texts may share a passage: each text has its own part of it
        low = max(0, int(np.searchsorted(bounds, max(first, 0), "right")) - 1)
        high = min(int(np.searchsorted(bounds, end, "left")), len(begins) - 1)
        for text in range(low, high):
            a, b = max(first, begins[text]), min(end, begins[text + 1] - 2)
            right = words[a:max(a, b)]
            has, wants = Counter(right.tolist()), Counter(left.tolist())
            shared = sum(min(c, has[w]) for w, c in wants.items())
            enough = MATCH * shared >= seeds.least[item]
            if not enough and shared < min_run:
                continue
            run = n >= min_run and shared >= min_run and _longest_run(np, left, right) >= min_run
            if not run and not enough:
                continue
            score, start, last = smith_waterman(np, left, right)
            if score and (run or score >= seeds.least[item] - 1e-9) and score > out.get((text, item), (0,))[0]:
                at = a - begins[text]
                out[text, item] = (score, score / (MATCH * n), at + start, at + last)
    return out


def _chunks(np, texts, names: dict[str, int]):
    """(number of the first text, word numbers with two gaps after each text, where each begins and the last ends)."""
    get, begun, words, begins, held = names.get, 0, [], [0], 0
    for k, text in enumerate(texts):
        words += [get(w, -1) for w in tokens(text)]
        words += (-1, -1)
        begins.append(len(words))
        held += len(text or "")
        if held >= CHUNK_CHARS or k + 1 == len(texts):
            yield begun, np.array(words, np.int64), begins
            begun, words, begins, held = k + 1, [], [0], 0


def _count_keys(docs: DataFrame, items: Items, keys):
    """How often all of ``docs`` hold each key (bounded by the block of items)."""
    import numpy as np
    import pyarrow as pa

    held = docs.sparkSession.sparkContext.broadcast((items.names, keys))  # both bounded by the block

    def counted(batches):
        names, keys = held.value
        sums = np.zeros(len(keys), np.int64)
        for b in batches:
            for _, words, _ in _chunks(np, b.column(1).to_pylist(), names):
                found = key_places(np, keys, pair_keys(np, words, len(names))[1])[1]
                np.add.at(sums, *np.unique(found, return_counts=True))
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], ["k", "n"])

    rows = docs.mapInArrow(counted, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(keys), np.int64)
    counts[rows.column("k").to_numpy()] = rows.column("n").to_numpy()
    return counts


def _blocks(benchmark: DataFrame, block_bytes: int, min_words: int):
    """Item ids and words, block by block."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for i in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).distinct().collect()
        texts = [(r["item_id"], tokens(r["text"])) for r in sorted(part)]
        texts = [(item, found) for item, found in texts if len(found) >= max(1, min_words)]
        if texts:
            yield texts


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_share: float = MIN_SHARE,
               block_bytes: int = BLOCK_BYTES, min_run: int = MIN_RUN, min_words: int = 1) -> DataFrame:
    """Pairs of document and test item whose alignment reaches ``min_share`` or that share ``min_run`` words in a row.

    Columns: doc_id, item_id, score, share (of the item's score with itself),
    first_word and last_word of the passage. One row per input row and item;
    repeated documents report again, repeated items once, items of one id but
    different texts by their best text. Items of so few words that a single one
    reaches the share (one or two words at 0.5) match only as a whole; those of
    less than ``min_words`` words are left out. Null or empty texts and null item
    ids match nothing; an empty table on either side gives no rows.
    """
    import numpy as np
    import pyarrow as pa

    spark = docs.sparkSession
    ship_package(spark)
    rows = doc_rows(docs)
    out = spark.createDataFrame([], FOUND)
    for texts in _blocks(benchmark, block_bytes, min_words):
        items = number_items(np, texts)
        keys = np.unique(pair_keys(np, items.words, len(items.names), True)[1])
        seeds = pick_seeds(np, items, keys, _count_keys(rows, items, keys), min_share, min_run)
        held = spark.sparkContext.broadcast((items, seeds))  # at most block_bytes of texts

        def aligned(batches, held=held):
            items, seeds = held.value
            for b in batches:
                ids, found = b.column(0).to_pylist(), []
                for begun, words, begins in _chunks(np, b.column(1).to_pylist(), items.names):
                    best: dict[tuple, tuple] = {}
                    for (text, item), rest in align(np, words, begins, items, seeds, min_share, min_run).items():
                        key = text, int(items.ids[item])
                        if key not in best or rest[0] > best[key][0]:
                            best[key] = rest
                    found += [(ids[begun + text], item, *rest) for (text, item), rest in best.items()]
                columns = list(zip(*found, strict=True)) or [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                                 ["doc_id", "item_id", "score", "share", "first_word", "last_word"])

        out = out.union(rows.mapInArrow(aligned, FOUND))
    return out


def drop_leaked(docs: DataFrame, benchmark: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """``docs`` without the documents of which a passage matches a test item; columns stay as they are.

    Rows without an id are kept: a finding can't name them. Items of less than
    ``MIN_WORDS`` words drop nothing: any text may hold one or two words.
    """
    leaked = stored(find_leaks(docs, benchmark, min_share, min_words=MIN_WORDS).select(F.col("doc_id").alias("__llm_id"))
                    .where(F.col("__llm_id").isNotNull()).distinct(), "leaked")
    return docs.join(leaked, docs["doc_id"] == leaked["__llm_id"], "left_anti")
