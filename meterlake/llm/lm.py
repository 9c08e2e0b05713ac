"""Language-model scores by stupid backoff, computed with joins.

``S(w | context) = c(context w) / c(context)`` if the n-gram was kept, else
``alpha`` times the score after a shorter context; a word's own score is its
share of all words. The counts cover all documents; longer n-grams met less
than ``min_count`` times are not kept.

Each n-gram is a 64-bit hash. The log score of a word telescopes over the
n-grams that end at it: every kept n-gram adds what its score gains over backing
off from it. So the score of a document is one sum over its exploded n-grams,
each joined to one gain in a table that is partitioned by hash.

Where the corpus is the scored documents themselves, the order is 2 and every
pair counts, every pair has been seen and ``alpha`` is never reached. The log
scores of a document then add up to the logs of its pairs' counts less those of
the words that are contexts after the first word (see ``score_own``). A count of 1
has the log 0, so only n-grams met twice or more need a row in the table, though
all are counted.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import discard, doc_rows, stored
from meterlake.session import broadcast_limit, ship_package

ORDER, ALPHA, MIN_COUNT = 2, 0.4, 2
SLICES = 3                # the n-grams are exploded and joined in so many parts of the hash range
SCALE = 1_000_000         # gains are whole numbers: sums don't depend on their order
_CHUNK = 1 << 22          # characters of text hashed at once, or one longer text
_OWN_CHUNK = 1 << 20      # the same for the documents' scores against themselves
OWN_SLICES = 2            # parts of the hash range in which those are joined


class ChunkHashes:
    """Words of a chunk of texts as 64-bit hashes (helper of the Arrow stages; made once per task).

    The hash of any stretch of bytes comes from running sums modulo 2**64, so
    the words of a chunk are found and hashed by array operations.
    """

    def __init__(self, np):
        self.np = np
        self.values = np.random.default_rng(8).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, base, size):
        out = self.np.full(size, base, self.np.uint64)
        out[0] = 1
        return self.np.multiply.accumulate(out)

    def __call__(self, texts):
        """(hash of each word, number of its text), in order; A-Z count as lower case."""
        np = self.np
        raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
        data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        if len(self.up) <= len(data):
            self.up = self._powers(0x9E3779B97F4A7C15, 2 * len(data))
            self.down = self._powers(pow(0x9E3779B97F4A7C15, -1, 2**64), 2 * len(data))
        gap = self.space[data]
        ends = np.flatnonzero(gap & ~np.concatenate([[True], gap[:-1]]))
        starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[:len(data)], out=sums[1:])
        x = (sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64)
        first = np.cumsum([0, *[len(r) + 1 for r in raw]])[:-1]
        return _mix(np, x, x >> np.uint64(7)), np.searchsorted(first, starts, side="right") - 1


def _mix(np, a, b):
    """Hash of an n-gram from those of its first n - 1 words and of its last word."""
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0xD1B54A32D192ED03))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _levels(np, h, doc, order):
    """[(hashes of the n-grams, their texts)] for n = 1 .. order; none crosses texts."""
    out, at = [(h, doc)], np.arange(len(h))
    for n in range(2, order + 1):
        short = out[-1][0]
        fits = at + n - 1 < len(h)
        fits[fits] = doc[at[fits]] == doc[at[fits] + n - 1]
        at = at[fits]
        long = _mix(np, short[fits], h[at + n - 1])
        out.append((long, doc[at]))
    return out


def _runs(np, key, *more):
    """Distinct values of an array and of those that go with it, and how often each occurs."""
    order = np.lexsort((*more, key)) if more else np.argsort(key)
    cols = [c[order] for c in (key, *more)]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
    at = np.flatnonzero(new)
    return (*[c[at] for c in cols], np.diff(np.append(at, len(order))))


def _signed(np, a):
    import pyarrow as pa

    return pa.array(np.ascontiguousarray(a, dtype=np.uint64).view(np.int64))


def _chunks(texts, most: int = _CHUNK):
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def count_ngrams(docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT) -> list[DataFrame]:
    """Written count tables by length: (h, n) of all words, then (h, ctx, suf, last, n) of each kept longer n-gram.

    ``ctx`` and ``suf`` name the n-gram without its last and without its first
    word. Each task counts its chunks before the shuffle.
    """
    ship_package(docs.sparkSession)
    rows = doc_rows(docs).select("text")

    def counted(length):
        def run(batches):
            import numpy as np
            import pyarrow as pa

            hashes = ChunkHashes(np)
            for b in batches:
                for part in _chunks(b.column(0).to_pylist()):
                    h, doc = hashes(part)
                    if length == 1:
                        keys, n = _runs(np, h)
                        yield pa.RecordBatch.from_arrays([_signed(np, keys), pa.array(n)], ["h", "n"])
                        continue
                    short, owner = _levels(np, h, doc, length - 1)[-1]
                    # Neighbours among the shorter n-grams of a text are context and suffix.
                    both = owner[1:] == owner[:-1]
                    ctx, suf, n = _runs(np, short[:-1][both], short[1:][both])
                    yield pa.RecordBatch.from_arrays([_signed(np, ctx), _signed(np, suf), pa.array(n)], ["ctx", "suf", "n"])
        return run

    tables = [stored(rows.mapInArrow(counted(1), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "words")]
    for length in range(2, order + 1):
        sums = (rows.mapInArrow(counted(length), "ctx long, suf long, n long")
                .groupBy("ctx", "suf").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))
        # The hash of an n-gram is mixed from its context and its last word, which its suffix's row names.
        if length == 2:
            named = sums.withColumn("last", F.col("suf"))
        else:
            named = sums.join(tables[-1].select(F.col("h").alias("suf"), "last"), "suf")
        tables.append(stored(named.select("ctx", "suf", "last", "n")
                             .mapInArrow(_named, "h long, ctx long, suf long, last long, n long"), "ngrams"))
    return tables


def _named(batches):
    import numpy as np
    import pyarrow as pa

    for b in batches:
        ctx, last = (b.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("ctx", "last"))
        yield pa.RecordBatch.from_arrays([_signed(np, _mix(np, ctx, last)), *b.columns], ["h", "ctx", "suf", "last", "n"])


def gains(tables: list[DataFrame], alpha: float = ALPHA) -> tuple[DataFrame, float, list[DataFrame]]:
    """((h, gain) for every kept n-gram, the log score of an unknown word, tables written on the way).

    A word's gain is its log share less that of an unknown word; an n-gram's is
    its log ratio less the backed-off score of its suffix. Contexts and suffixes
    of kept n-grams are kept, so both joins find them.
    """
    words = tables[0]
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    floor = math.log(1 / (total + 1))
    scored = words.select("h", "n", F.log(F.col("n") / F.lit(max(total, 1))).alias("v"))
    out, used = [scored.select("h", (F.col("v") - floor).alias("gain"))], []
    for t in tables[1:]:
        ctx = scored.select(F.col("h").alias("ctx"), F.col("n").alias("cn"))
        suf = scored.select(F.col("h").alias("suf"), F.col("v").alias("sv"))
        joined = stored(t.join(ctx, "ctx").select("h", "suf", "n", F.log(F.col("n") / F.col("cn")).alias("v")), "ratios")
        used.append(joined)
        out.append(joined.join(suf, "suf").select("h", (F.col("v") - F.col("sv") - math.log(alpha)).alias("gain")))
        scored = joined.select("h", "n", "v")
    whole = out[0]
    for t in out[1:]:
        whole = whole.union(t)
    return whole.select("h", F.round(F.col("gain") * SCALE).cast("long").alias("gain")), floor, used


def explode_ngrams(docs: DataFrame, order: int = ORDER, slices: int = 1, part: int = 0) -> DataFrame:
    """(key, h, n): the distinct n-grams of each text in one part of the hash range; ``key`` is the text's XXH64."""
    ship_package(docs.sparkSession)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        hashes = ChunkHashes(np)
        for b in batches:
            keys, texts = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_pylist()
            first = 0
            for chunk in _chunks(texts):
                grams, owner = (np.concatenate(c) for c in zip(*_levels(np, *hashes(chunk), order), strict=True))
                if slices > 1:
                    mine = (grams >> np.uint64(40)) % np.uint64(slices) == part
                    grams, owner = grams[mine], owner[mine]
                owner, grams, n = _runs(np, owner, grams)
                yield pa.RecordBatch.from_arrays([pa.array(keys[first + owner]), _signed(np, grams), pa.array(n)],
                                                 ["key", "h", "n"])
                first += len(chunk)

    text = F.coalesce("text", F.lit(""))
    return (doc_rows(docs).select(F.xxhash64(text).alias("key"), text.alias("text"))
            .mapInArrow(run, "key long, h long, n long"))


def _kinded(np, h, kind: int):
    """Hashes whose lowest bit tells words (1) from pairs (0)."""
    return (h & ~np.uint64(1)) | np.uint64(kind)


def _pairs(np, h, doc):
    """(hashes of the pairs of neighbours, their texts)."""
    same = doc[1:] == doc[:-1]
    return _kinded(np, _mix(np, h[:-1], h[1:])[same], 0), doc[1:][same]


def count_own(docs: DataFrame) -> DataFrame:
    """(h, gain): scaled log count of every word and pair met twice or more in ``docs``; one pass over the texts."""
    ship_package(docs.sparkSession)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        hashes = ChunkHashes(np)
        for b in batches:
            for part in _chunks((t.as_py() for t in b.column(0)), _OWN_CHUNK):
                h, doc = hashes(part)
                for grams in (_kinded(np, h, 1), _pairs(np, h, doc)[0]):
                    keys, n = np.unique(grams, return_counts=True)
                    yield pa.RecordBatch.from_arrays([_signed(np, keys), pa.array(n)], ["h", "n"])

    counts = doc_rows(docs).select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return counts.where("n > 1").select("h", F.round(F.log("n") * SCALE).cast("long").alias("gain"))


def explode_own(docs: DataFrame, words, part: int = 0, slices: int = 1) -> DataFrame:
    """(key, h, n): the distinct pairs of each text in one part of the hash range; ``key`` is the text's XXH64.

    A word takes its log away each time it is a context after the first word of
    the text; the only word of a text adds it. ``words`` (broadcast arrays of hashes
    and gains) settles that in the task: one row of the text, with the hash of no
    n-gram and the lowest bit set, has their sum. Without it words are rows like pairs.
    """
    ship_package(docs.sparkSession)
    mine_only = part

    def run(batches):
        import numpy as np
        import pyarrow as pa

        hashes = ChunkHashes(np)
        for b in batches:
            keys, first = b.column(0).to_numpy(), 0
            for part in _chunks((t.as_py() for t in b.column(1)), _OWN_CHUNK):
                h, doc = hashes(part)
                begins = np.diff(doc, prepend=-1) != 0
                ends = np.diff(doc, append=-1) != 0
                adds = np.where(begins & ends, 1, np.where(begins | ends, 0, -1))
                pairs, owner = _pairs(np, h, doc)
                grams = [(pairs, owner, np.ones(len(pairs), np.int64))]
                if words is None:
                    grams.append((_kinded(np, h, 1)[adds != 0], doc[adds != 0], adds[adds != 0]))
                for gram, own, n in grams:
                    if slices > 1:
                        here = (gram >> np.uint64(40)) % np.uint64(slices) == mine_only
                        gram, own, n = gram[here], own[here], n[here]
                    # One sort by a mix of both tells equal n-grams of one text.
                    mark = _mix(np, gram, own.astype(np.uint64))
                    order = np.argsort(mark)
                    mark = mark[order]
                    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(mark)), bool), mark[1:] != mark[:-1]]))
                    at = order[new]
                    n = np.add.reduceat(n[order], new) if len(new) else n
                    yield pa.RecordBatch.from_arrays([pa.array(keys[first + own[at]]), _signed(np, gram[at]), pa.array(n)], ["key", "h", "n"])
                if words is not None and mine_only == 0:
                    known, gain = words.value
                    mine = _kinded(np, h, 1).view(np.int64)
                    sums = np.zeros(len(part), np.int64)
                    if len(known) and len(mine):
                        at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                        np.add.at(sums, doc, np.where(known[at] == mine, gain[at], 0) * adds)
                    lone = keys[first:first + len(part)]
                    spread = _mix(np, lone.view(np.uint64), np.arange(len(lone), dtype=np.uint64))
                    yield pa.RecordBatch.from_arrays([pa.array(lone), _signed(np, _kinded(np, spread, 1)), pa.array(sums)], ["key", "h", "n"])
                first += len(part)

    text = F.coalesce("text", F.lit(""))
    return (doc_rows(docs).select(F.xxhash64(text).alias("key"), text.alias("text"))
            .mapInArrow(run, "key long, h long, n long"))


def score_own(docs: DataFrame) -> DataFrame:
    """``score`` of ``docs`` against themselves at order 2 with every pair counted.

    For the words w1 .. wm of a text, ``ln c(w1)/T + sum ln c(w[i-1] w[i])/c(w[i-1])``
    is the sum of ``ln c`` over its pairs, less that of ``w2 .. w[m-1]``, less ``ln T``
    (T being all words); of a single word, ``ln c(w1)/T``. Logs are rounded to whole
    millionths before they are added, so sums don't depend on their order.
    """
    table = stored(count_own(docs), "gains")
    is_word = F.col("h").bitwiseAND(F.lit(1)) == 1
    words, pairs = None, table
    if 16 * table.where(is_word).count() <= broadcast_limit(docs.sparkSession):   # measured; else words are joined like pairs
        import numpy as np

        found = table.where(is_word).toArrow()
        h, gain = (found.column(c).to_numpy() for c in ("h", "gain"))
        order = np.argsort(h)
        words = docs.sparkSession.sparkContext.broadcast((h[order], gain[order]))
        pairs = table.where(~is_word)
    unmatched = F.when(is_word, F.col("n")).otherwise(F.lit(0)) if words is not None else F.lit(0)
    sums = None
    for part in range(OWN_SLICES):
        here = F.pmod(F.shiftrightunsigned("h", 40), F.lit(OWN_SLICES)) == part
        met = explode_own(docs, words, part, OWN_SLICES).join(pairs.where(here), "h", "left")
        each = met.select("key", F.coalesce(F.col("n") * F.col("gain"), unmatched).alias("s")).where("s <> 0")
        each = stored(each.groupBy("key").agg(F.sum("s").alias("s")), "sums")
        sums = each if sums is None else sums.union(each)
    discard(table)
    rows, per_text = _text_rows(docs, sums.groupBy("key").agg(F.sum("s").alias("s")))
    total = rows.agg(F.sum("n_words")).first()[0] or 1
    score = F.when(F.col("n_words") > 0, F.coalesce("s", F.lit(0.0)) / SCALE - math.log(total)).otherwise(F.lit(0.0))
    return _scored(rows, per_text, score)


def _text_rows(docs: DataFrame, sums: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((doc_id, key, n_words) of every row, (key, s) of every text): copies share the sum that they made together."""
    text = F.coalesce("text", F.lit(""))
    spaced = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    n = F.size(F.array_remove(F.split(spaced, " "), "")).cast("long")
    rows = stored(doc_rows(docs).select("doc_id", F.xxhash64(text).alias("key"), n.alias("n_words")), "rows")
    copies = rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    return rows, stored(sums.join(copies, "key").select("key", (F.col("s") / F.col("copies")).alias("s")), "text_sums")


def _scored(rows: DataFrame, per_text: DataFrame, total) -> DataFrame:
    return (rows.join(per_text, "key", "left")
            .select("doc_id", "n_words", total.alias("log_score"),
                    F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_score")))


def score(docs: DataFrame, corpus: DataFrame | None = None, order: int = ORDER, alpha: float = ALPHA,
          min_count: int = MIN_COUNT, slices: int = SLICES) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) for every row of ``docs``.

    Counts come from ``corpus`` (``docs`` itself if not given). Natural logs;
    words no corpus holds score one over its words plus one. Copies of a text
    gather in one key and share its sum. Null and wordless texts have 0 words,
    log score 0 and no mean; repeated rows and null ids stay; an empty corpus
    makes every word unknown; empty ``docs`` give no rows.
    """
    if order < 1:
        raise ValueError("order must be 1 or more")
    if corpus is None and order == 2 and min_count == 1:
        return score_own(docs)
    tables = count_ngrams(docs if corpus is None else corpus, order, min_count)
    table, floor, used = gains(tables, alpha)
    table = stored(table, "gains")
    discard(*tables, *used)
    hash_part = F.pmod(F.shiftrightunsigned("h", 40), F.lit(slices))
    sums = None
    for part in range(slices):
        found = explode_ngrams(docs, order, slices, part).join(table.where(hash_part == part), "h")
        each = stored(found.groupBy("key").agg(F.sum(F.col("n") * F.col("gain")).alias("s")), "sums")
        sums = each if sums is None else sums.union(each)
    rows, per_text = _text_rows(docs, sums.groupBy("key").agg(F.sum("s").alias("s")))
    # Every word backs off once for each order that its place allows beyond the first.
    backoffs = sum((F.greatest(F.col("n_words") - k, F.lit(0)) for k in range(1, order)), F.lit(0))
    base = F.col("n_words") * F.lit(floor) + backoffs * F.lit(math.log(alpha))
    return _scored(rows, per_text, base + F.coalesce("s", F.lit(0.0)) / SCALE)
