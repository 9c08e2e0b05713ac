"""Quality rules: a hashed n-gram log-likelihood ratio of trusted against raw text.

Two multinomials over hashed words and word pairs are counted: the target over
the documents that ``labels`` trusts, the raw one over all documents. A
document scores the mean of ``ln(p_target / p_raw)`` over its n-grams, and a
fixed threshold decides on every document. Each bucket is smoothed by itself, so
its weight depends neither on the number of buckets nor on the corpus size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import SPACES, bind, doc_rows, stored
from meterlake.plans.joins import lookup_join

BUCKETS = 1 << 20        # a power of two: of words, and as many of word pairs
SMOOTHING = 16.0         # occurrences added to each bucket, trusted as often as the whole corpus is
SCALE = 10_000           # weights are whole numbers: sums don't depend on their order
PLACE_BITS = 20          # of a number that holds a window's place below the upper bits of its hash
MIN_RATIO = -0.11        # mean natural log ratio below which a document is rejected


def _covered(places: Column) -> Column:
    """Words in the windows that begin at ``places`` (sorted): each adds those beyond the end of the one before it."""
    return F.aggregate(places, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
                       lambda acc, i: F.struct((i + 3).alias("end"), (acc["n"] + i + 3 - F.greatest(acc["end"], i)).alias("n")),
                       lambda acc: acc["n"])


def _covered_by_rows(h: Column) -> Column:
    """``_covered`` of the windows whose hash is in ``h`` twice, by sorting (hash, place) rows: any number of windows."""
    rows = F.sort_array(F.arrays_zip(h.alias("h"), F.sequence(F.lit(0), F.size(h) - 1).alias("i")))

    def pick(s):
        n = F.size(s)
        edge = F.array(F.lit(None).cast("bigint"))
        key = F.transform(s, lambda x: x["h"])
        before = F.concat(edge, F.slice(key, 1, n - 1))
        after = F.concat(F.slice(key, 2, n), edge)
        twin = F.zip_with(F.zip_with(before, after, lambda b, a: F.struct(b.alias("b"), a.alias("a"))), s,
                          lambda e, x: F.when((e["b"] == x["h"]) | (e["a"] == x["h"]), x["i"]))
        return _covered(F.sort_array(F.array_compact(twin)))

    return bind(rows, pick)


def repeated_window_words(found: Column) -> Column:
    """Words that lie in three-word windows met twice or more in the text, the first included."""
    low = (1 << PLACE_BITS) - 1

    def covered(h):
        # The upper bits of a hash and the place in one number, as numbers sort faster than rows.
        packed = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))

        def twins(s):
            n = F.size(s) - 1
            return F.array_compact(F.zip_with(F.slice(s, 1, n), F.slice(s, 2, n), lambda a, b: F.when(
                a.bitwiseXOR(b).between(0, low),
                F.struct(a.bitwiseAND(F.lit(low)).cast("int").alias("a"), b.bitwiseAND(F.lit(low)).cast("int").alias("b")))))

        def pick(t):
            clash = F.exists(t, lambda x: F.get(h, x["a"]) != F.get(h, x["b"]))
            places = F.array_union(F.transform(t, lambda x: x["a"]), F.transform(t, lambda x: x["b"]))
            return (F.when(F.size(t) == 0, F.lit(0)).when(clash, _covered_by_rows(h))
                    .otherwise(_covered(F.sort_array(places))))

        return F.when(F.size(h) > low, _covered_by_rows(h)).otherwise(bind(bind(packed, twins), pick))

    def windows(h):
        three = F.transform(F.slice(h, 1, F.size(h) - 2), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))
        # A text without a repeated window, told by their set, needs no sorting.
        once = bind(three, lambda x: F.when(F.size(F.array_distinct(x)) == F.size(x), F.lit(0)).otherwise(covered(x)))
        return F.when(F.size(h) < 4, F.lit(0)).otherwise(once)

    # Every word is hashed once.
    return bind(F.transform(found, lambda w: F.xxhash64(w)), windows)


def rule_columns(text: Column, pieces: Column) -> list[Column]:
    """The base measures of a text that is not null, ``pieces`` being the text cut at every space (see ``_pieces``)."""
    found = F.array_remove(pieces, "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(f"[^{SPACES}]")))
    symbols = "#*$%&|<>"
    return [F.size(found).cast("long").alias("n_words"),
            (F.length(text) - F.size(pieces) + 1).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, f"[^{symbols}]++", "")).cast("long").alias("n_symbols"),
            bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_window_words(found).cast("long").alias("n_repeat_words")]


def _spaced(text: Column) -> Column:
    # A pattern that hardly matches: ``translate`` looks up every character.
    return F.regexp_replace(text, r"[\x09-\x0D]", " ")


def _pieces(spaced: Column) -> Column:
    """What lies between the spaces, empty where two follow each other."""
    return F.split(spaced, " ")


def _ngram_rows(rows: DataFrame, *keep: str) -> DataFrame:
    """A row (``keep``, one, two) for each word of ``__w``: its bucket, and that of the pair it begins (null: the last word).

    ``__w`` holds the lower-cased words of a row; one without words gives a row
    of nulls. Rows, unlike functions over arrays, run in generated code.
    """
    # The outer form: for the other one Spark would split every text once more, to filter on the number of words.
    each = rows.select(*keep, "__w", F.posexplode_outer("__w").alias("__i", "__word"))
    h = each.select(*keep, F.xxhash64("__word").alias("__h"), "__word", F.get("__w", F.col("__i") + 1).alias("__next"))
    one, two = F.col("__h"), F.xxhash64("__h", F.xxhash64("__next"))
    return h.select(*keep, *[F.when(F.col(c).isNotNull(), x.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")).alias(name)
                             for c, x, name in (("__word", one, "one"), ("__next", two, "two"))])


def _lower_words(spaced: Column) -> Column:
    return F.array_remove(_pieces(F.lower(spaced)), "")


def fit_ratio(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """(bucket, weight): scaled log ratio of each bucket, at most ``2 * BUCKETS`` rows.

    ``trusted_ids`` holds ``doc_id``. Both counts cover all texts and are
    combined before the shuffle; the trusted ids are broadcast only if they
    measure below the library's limit. The corpus's trusted share smooths each bucket, so one
    that has hardly been met weighs little.
    """
    ids = trusted_ids.select(F.col("doc_id").alias("t")).where(F.col("t").isNotNull()).distinct()
    ids = stored(ids, "trusted")
    rows = doc_rows(docs)
    per_doc = (lookup_join(rows, ids, rows["doc_id"] == ids["t"], "left", materialized=True)
               .select(_lower_words(_spaced(F.coalesce("text", F.lit("")))).alias("__w"), F.col("t").isNotNull().cast("long").alias("t")))
    ngrams = (_ngram_rows(per_doc, "t")
              .select("t", F.explode(F.array("one", F.col("two").bitwiseOR(F.lit(BUCKETS)))).alias("bucket")).where("bucket IS NOT NULL"))
    counts = stored(ngrams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("trusted")), "ngrams")
    order = F.floor(F.col("bucket") / BUCKETS)
    totals = counts.groupBy(order.alias("o")).agg(F.sum("raw").alias("nr"), F.sum("trusted").alias("nt"))
    whole = F.col("nt") / F.col("nr")
    gain = (F.col("trusted") + SMOOTHING * whole) / (F.col("raw") + SMOOTHING) / whole
    weight = F.when(F.col("nt") > 0, F.round(F.log(gain) * SCALE)).otherwise(F.lit(0.0))
    return (counts.join(F.broadcast(totals), order == F.col("o"))
            .select("bucket", weight.cast("long").alias("weight")))


def _weight_array(weights: DataFrame, first: int) -> DataFrame:
    """One row, one array: the weights of the ``BUCKETS`` buckets from ``first`` on (0 where ``weights`` has none)."""
    every = weights.sparkSession.range(first, first + BUCKETS).select(F.col("id").alias("bucket"))
    offset = 1 << 31
    packed = F.shiftleft(F.col("bucket"), 32) + F.coalesce("weight", F.lit(0)) + offset
    own = weights.where(F.col("bucket").between(first, first + BUCKETS - 1))
    listed = every.join(own, "bucket", "left").agg(F.sort_array(F.collect_list(packed)).alias("x"))
    return listed.select(F.transform("x", lambda x: (x.bitwiseAND(F.lit((1 << 32) - 1)) - offset).cast("int")).alias("w"))


def score_quality(docs: DataFrame, weights: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """One row per input row: doc_id, the base measures, base_failed, ratio, kept.

    The weights, an array of ``BUCKETS`` whole numbers for words and one for pairs,
    go to every task as scalar subqueries. A document's words become rows, which are
    added up before the shuffle: one row a document travels. A row without words has no
    ratio (null) and fails the base rules. Null texts have no words; repeated rows, null
    and repeated ids stay apart. Without trusted documents all weights are zero and
    the base rules alone decide.
    """
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = doc_rows(docs).select(F.monotonically_increasing_id().alias("__row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("__row", "doc_id", "text", _spaced(F.col("text")).alias("__s"))
    rows = rows.select("__row", "doc_id", "text", "__s", _pieces(F.col("__s")).alias("__p"))
    rows = rows.select("__row", "doc_id", *rule_columns(F.col("text"), F.col("__p")), _lower_words(F.col("__s")).alias("__w"))
    each = _ngram_rows(rows, "__row", "doc_id", *base)
    # Each array is used once, so that the subquery's value stands in its place and no row carries it.
    gain = [F.coalesce(F.get(_weight_array(weights, first).scalar(), c), F.lit(0)).cast("long")
            for first, c in ((0, F.col("one")), (BUCKETS, F.col("two")))]
    total = each.select("__row", "doc_id", *base, (gain[0] + gain[1]).alias("s"))
    # All rows of a ``__row`` have the same values.
    summed = total.groupBy("__row").agg(*[F.max(c).alias(c) for c in ("doc_id", *base)], F.sum("s").alias("s"))
    measured = summed.select("doc_id", *base, "s").withColumn("n", F.greatest(2 * F.col("n_words") - 1, F.lit(0)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    ratio = F.when(F.col("n") > 0, F.col("s") / F.col("n") / SCALE)
    return (measured.select("doc_id", *base, failed.alias("base_failed"), ratio.alias("ratio"))
            .select("*", (~F.col("base_failed") & F.coalesce(F.col("ratio") >= min_ratio, F.lit(True))).alias("kept")))


def rate_quality(docs: DataFrame, labels: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """``score_quality`` with weights fitted on ``docs`` and the ids that ``labels`` marks as quality 1."""
    trusted = labels.where(F.col("quality") == 1).select("doc_id")
    weights = stored(fit_ratio(docs, trusted), "ratio_weights")
    return score_quality(docs, weights, min_ratio)
