"""Mixing to target weights with soft domain membership.

A naive Bayes classifier over hashed words, fitted on the labelled table, gives
each document posterior shares of the domains. Nonnegative rates per document
are then fitted by projected gradient least squares so that the expected tokens
of each domain, ``sum(rate * tokens * share)``, meet the targets.

The gradient is taken in the metric of the documents' tokens, so documents with
equal posteriors keep equal rates. Posteriors are rounded to a lattice, and the
descent runs over the lattice cells in use, whose number has a bound that does
not depend on the number of documents.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import doc_rows, stored, words
from meterlake.plans.joins import lookup_join

BUCKETS = 1 << 13
SCALE = 10_000          # log weights are whole numbers: sums don't depend on their order
SURE_WORDS = 48         # a longer document is as certain as one of so many words
LEVELS = 64             # posterior shares are multiples of 1 / LEVELS before normalising
STEPS, CLOSE = 100, 1e-3


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from ``labels``: toxic, else good or poor by quality; unmarked rows are left out."""
    domain = (F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good")
              .when(F.col("quality") == 0, "poor"))
    return labels.select("doc_id", domain.alias("domain")).where(F.col("domain").isNotNull())


def label_quality(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from ``labels`` by quality alone: good or poor."""
    domain = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", domain.alias("domain")).where(F.col("domain").isNotNull())


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(F.lower(word)), F.lit(BUCKETS))


def fit_domains(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> DataFrame:
    """(bucket, w): per bucket the scaled log share of each domain, at most ``BUCKETS`` rows and one null row.

    The row of bucket null holds the scaled log priors. All labelled documents
    are counted, combined before the shuffle. A doc_id labelled with several
    domains counts for the alphabetically first.
    """
    marks = stored(labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
                   .groupBy(F.col("doc_id").cast("long").alias("t")).agg(F.min("domain").alias("domain")), "domains")
    rows = lookup_join(doc_rows(docs).withColumnRenamed("doc_id", "t"), marks, "t", "inner", materialized=True)
    tally = [F.sum((F.col("domain") == d).cast("long")).alias(f"c{i}") for i, d in enumerate(domains)]
    grams = rows.select("domain", F.explode(words(F.col("text"))).alias("w")).select("domain", _bucket(F.col("w")).alias("bucket"))
    counts = stored(grams.groupBy("bucket").agg(*tally), "domain_words")
    names = [f"c{i}" for i in range(len(domains))]
    total = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"n_{c}") for c in names])
    logs = [F.round(SCALE * F.log((F.col(c) + 1) / (F.col(f"n_{c}") + BUCKETS))).cast("long") for c in names]
    empty = [F.round(SCALE * F.log(1 / (F.col(f"n_{c}") + BUCKETS))).cast("long") for c in names]
    spark = docs.sparkSession
    every = spark.range(BUCKETS).select(F.col("id").alias("bucket"))
    seen = every.join(F.broadcast(counts), "bucket", "left").join(F.broadcast(total), F.lit(True))
    weights = seen.select("bucket", F.array(*[F.coalesce(a, b) for a, b in zip(logs, empty, strict=True)]).alias("w"))
    prior = marks.agg(*tally, F.count(F.lit(1)).alias("n")).select(
        F.lit(None).cast("long").alias("bucket"),
        F.array(*[F.round(SCALE * F.log((F.coalesce(c, F.lit(0)) + 1) / (F.col("n") + len(domains)))).cast("long")
                  for c in names]).alias("w"))
    return weights.union(prior)


def posteriors(docs: DataFrame, weights: DataFrame, domains: list[str], levels: int = LEVELS) -> DataFrame:
    """(doc_id, doc_hash, n_tokens, q0, q1, ...) for every row of ``docs``.

    ``q``: whole numbers, ``levels`` times the posterior of each domain. The
    log likelihood per word counts at most ``SURE_WORDS`` times, so long texts
    keep soft shares; a document without words has the prior's.
    """
    k = len(domains)
    prior = weights.where(F.col("bucket").isNull()).first()["w"]
    wide = weights.where(F.col("bucket").isNotNull()).select("bucket", *[F.col("w")[i].alias(f"w{i}") for i in range(k)])
    rows = doc_rows(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id",
                                 F.xxhash64("doc_id", "text").alias("doc_hash"), words(F.col("text")).alias("w"))
    keys = ["row", "doc_id", "doc_hash", "n_tokens"]
    grams = (rows.select("row", "doc_id", "doc_hash", F.size("w").cast("long").alias("n_tokens"),
                         F.explode_outer("w").alias("word"))
             .select(*keys, _bucket(F.col("word")).alias("bucket")))
    # At most BUCKETS rows.
    summed = (grams.join(F.broadcast(wide), "bucket", "left").groupBy(*keys)
              .agg(*[F.coalesce(F.sum(f"w{i}"), F.lit(0)).alias(f"s{i}") for i in range(k)]))
    sure = F.least(F.col("n_tokens"), F.lit(SURE_WORDS)) / F.greatest(F.col("n_tokens"), F.lit(1)) / SCALE
    logs = summed.select(*keys, *[(prior[i] / SCALE + F.col(f"s{i}") * sure).alias(f"l{i}") for i in range(k)])
    top = F.greatest(*[F.col(f"l{i}") for i in range(k)]) if k > 1 else F.col("l0")
    odds = logs.select(*keys, *[F.exp(F.col(f"l{i}") - top).alias(f"e{i}") for i in range(k)])
    whole = reduce(lambda a, b: a + b, [F.col(f"e{i}") for i in range(k)])
    return odds.select("doc_id", "doc_hash", "n_tokens",
                       *[F.floor(levels * F.col(f"e{i}") / whole + 0.5).cast("int").alias(f"q{i}") for i in range(k)])


def _shares(k: int) -> list[Column]:
    whole = reduce(lambda a, b: a + b, [F.col(f"q{i}") for i in range(k)])
    return [F.col(f"q{i}") / whole for i in range(k)]


def _largest_eigenvalue(m: list[list[float]]) -> float:
    """Of a small symmetric matrix without negative entries (power steps)."""
    v = [1.0] * len(m)
    size = 1.0
    for _ in range(200):
        v = [sum(a * b for a, b in zip(row, v, strict=True)) for row in m]
        size = max(map(abs, v)) or 1.0
        v = [x / size for x in v]
    return size


@dataclass(frozen=True)
class Fit:
    """Fitted steps ``(move, carry)``: see ``step_rates``; the rate of shares p is the fold over them from r = 1."""

    steps: list[tuple[list[float], float]]
    reached: list[float]    # expected tokens of each domain
    targets: list[float]

    def rate(self, shares: list[Column]) -> Column:
        if not self.steps:
            return F.lit(1.0)
        path = F.array(*[F.struct(F.array(*[F.lit(x) for x in m]).alias("m"), F.lit(c).alias("c")) for m, c in self.steps])

        def down(at, s):
            r = step_rates(at["y"], [s["m"][i] for i in range(len(shares))], shares)
            return F.struct(r.alias("r"), (r + s["c"] * (r - at["r"])).alias("y"))

        return F.aggregate(path, F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("y")), down, lambda at: at["r"])


    def rate_of(self, shares: list[float]) -> float:
        """The rate of one posterior."""
        r = y = 1.0
        for move, carry in self.steps:
            new = max(0.0, y - sum(a * b for a, b in zip(move, shares, strict=True)))
            r, y = new, new + carry * (new - r)
        return r


def step_rates(y: Column, move: list[Column], shares: list[Column]) -> Column:
    """One projected step: down the gradient ``move . shares`` from ``y``, not below 0."""
    return F.greatest(F.lit(0.0), y - reduce(lambda a, b: a + b, [x * p for x, p in zip(move, shares, strict=True)]))


def fit_rates(found: DataFrame, weights: list[float], steps: int = STEPS, close: float = CLOSE) -> Fit:
    """Projected gradient least squares for ``weights`` (shares of all tokens) over ``posteriors`` rows.

    Each step is one distributed sum over the cells of the posterior lattice:
    the residuals of the domains, one number each, return to the driver. The
    loss is ``sum((reached - target)^2 / target)``; the step is one over the
    largest eigenvalue of its Hessian, taken from a point carried beyond the
    last one (Nesterov). Ends when all targets are met to ``close`` of their
    size, or after ``steps`` steps. No tokens: rates stay 1.
    """
    k = len(weights)
    names = [f"q{i}" for i in range(k)]
    cells = stored(found.groupBy(*names).agg(F.sum("n_tokens").alias("m")).where("m > 0").coalesce(8), "cells")
    p = _shares(k)
    gram = cells.agg(F.sum("m").alias("m"), *[F.sum(F.col("m") * p[i] * p[j]).alias(f"g{i}_{j}")
                                              for i in range(k) for j in range(k)]).first()
    total = float(gram["m"] or 0)
    if not total:
        return Fit([], [0.0] * k, [0.0] * k)
    goal = [w / sum(weights) for w in weights]
    safe = [max(g, 1e-6) for g in goal]
    top = _largest_eigenvalue([[gram[f"g{i}_{j}"] / total / (safe[i] * safe[j]) ** 0.5 for j in range(k)] for i in range(k)])
    state = cells.withColumn("r", F.lit(1.0)).withColumn("y", F.lit(1.0))
    sums = [F.sum(F.col(v) * F.col("m") * p[i]) for v in ("r", "y") for i in range(k)]
    taken, pace = [], 1.0
    while True:
        row = [float(x) / total for x in state.agg(*sums).first()]
        reached, ahead = row[:k], row[k:]
        if len(taken) == steps or max(abs(a - g) / s for a, g, s in zip(reached, goal, safe, strict=True)) < close:
            break
        move = [(a - g) / s / top for a, g, s in zip(ahead, goal, safe, strict=True)]
        pace, last = (1 + (1 + 4 * pace * pace) ** 0.5) / 2, pace
        carry = (last - 1) / pace
        taken.append((move, carry))
        state = (state.withColumn("next", step_rates(F.col("y"), [F.lit(x) for x in move], p))
                 .withColumn("y", F.col("next") + carry * (F.col("next") - F.col("r")))
                 .withColumn("r", F.col("next")).drop("next"))
        if len(taken) % 4 == 0:
            state = stored(state, "cells")
    return Fit(taken, [x * total for x in reached], [g * total for g in goal])


def _fitted(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], levels: int) -> tuple[DataFrame, Fit]:
    domains = sorted(targets)
    weights = stored(fit_domains(docs, labelled, domains), "domain_weights")
    found = stored(posteriors(docs, weights, domains, levels), "posteriors")
    fit = fit_rates(found, [targets[d] for d in domains])
    p = _shares(len(domains))
    best = F.greatest(*[F.col(f"q{i}") for i in range(len(domains))]) if len(domains) > 1 else F.col("q0")
    domain = F.coalesce(*[F.when(F.col(f"q{i}") == best, d) for i, d in enumerate(domains)])
    return found.select("doc_id", "doc_hash", "n_tokens", *[p[i].alias(f"p_{d}") for i, d in enumerate(domains)],
                        domain.alias("domain"), fit.rate(p).alias("rate")), fit


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], levels: int = LEVELS) -> DataFrame:
    """(doc_id, doc_hash, n_tokens, p_<domain>..., domain, rate) for every row of ``docs``.

    ``targets`` holds each domain's share of the tokens. Null texts have no
    words: their posterior is the prior and they weigh nothing in the fit.
    Repeated rows share a rate, null ids stay; without labels the domains are
    equally likely; an empty table gives no rows.
    """
    return _fitted(docs, labelled, targets, levels)[0]


def sample_mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], keep: str) -> DataFrame:
    """``docs`` thinned to the mix, columns as they are.

    Every document whose likeliest domain is ``keep`` stays. The others stay
    with the probability ``rate / rate of a pure document of keep`` (1 at most):
    what counts for the mix is the ratio of the rates. The draw is a hash of id
    and text, so runs agree and copies share a fate; no row is repeated.
    """
    rated, fit = _fitted(docs, labelled, targets, LEVELS)
    whole = max(fit.rate_of([float(d == keep) for d in sorted(targets)]), 1e-9)
    draw = F.pmod(F.xxhash64("doc_hash", F.lit(20)), F.lit(1 << 30)) / float(1 << 30)
    thin = (F.col("domain") != keep) & (draw >= F.col("rate") / whole)
    gone = stored(rated.where(thin).select(F.col("doc_hash").alias("__llm_hash")).distinct(), "thinned")
    keyed = docs.withColumn("__llm_key", F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    return keyed.join(gone, keyed["__llm_key"] == gone["__llm_hash"], "left_anti").drop("__llm_key")
