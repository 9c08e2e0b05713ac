"""Toxicity by cumulative-link (proportional-odds) ordinal regression.

``P(grade <= k) = sigmoid(cut_k - w.x)``: one weight vector serves all ordered
cuts. Features are the distinct words of a text (runs of letters, lower case,
named by CRC-32). The model is fitted on a bounded sample of labelled rows; all
documents are scored whole in Arrow batches.

``labels`` marks documents as toxic or not. Severity above that is taken from
the sample: a toxic document's grade is 1, or 2 if it holds more than the usual
number of words that are far likelier in toxic documents.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import doc_rows, stored
from meterlake.session import ship_package

MAX_SAMPLE = 12_000      # labelled rows that the model is fitted on, at most
MIN_DOCS = 3             # a feature lies in so many sampled documents at least
MAX_SHARE = 0.2          # and in this share of them at most
MARKER_ODDS = 3.0        # log odds from which a word marks toxic documents
STEPS, RATE, L1 = 300, 0.1, 5e-5
REJECT = 0.3             # expected severity from which a document counts as toxic
_LETTERS = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> set[int]:
    """CRC-32 of each distinct lower-case run of letters."""
    return {zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in set(_LETTERS.findall((text or "").lower()))}


@dataclass(frozen=True)
class OrdinalModel:
    """Shared weights by feature, and rising cuts between the grades."""

    weights: dict[int, float] = field(default_factory=dict)
    cuts: tuple[float, ...] = ()

    def at_least(self, text: str | None) -> list[float]:
        """P(grade >= k) for k = 1, 2, ...; the sum is exact, so its order does not matter."""
        known = self.weights
        s = math.fsum(known[f] for f in features(text) if f in known)
        return [1 / (1 + math.exp(min(700.0, c - s))) for c in self.cuts]

    def expected(self, text: str | None) -> float:
        return math.fsum(self.at_least(text))


def sample_labelled(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_SAMPLE) -> DataFrame:
    """(doc_id, text, toxic) of at most ``max_rows`` labelled documents, picked by a hash of the id.

    An id that several rows have gives one row: of its texts that are not null the one of the smallest hash.
    """
    marked = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
              .groupBy(F.col("doc_id").cast("long").alias("t")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    picked = stored(marked.orderBy(F.xxhash64("t"), "t").limit(max_rows), "label_sample")
    rows = doc_rows(docs)
    found = rows.join(F.broadcast(picked), rows["doc_id"] == picked["t"])
    first = F.min(F.struct(F.col("text").isNull().alias("no"), F.xxhash64("text").alias("h"), F.col("text").alias("text")))
    return (found.groupBy("doc_id", "toxic").agg(first.alias("first"))
            .select("doc_id", F.col("first.text").alias("text"), "toxic"))


def fit(sample: DataFrame) -> OrdinalModel:
    """Fit on the driver: the sample is bounded (see ``sample_labelled``), and only feature numbers reach it."""
    import numpy as np
    import pyarrow as pa

    def hashed(batches):
        for b in batches:
            rows = [sorted(features(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(rows, pa.list_(pa.int64()))], ["doc_id", "toxic", "f"])

    ship_package(sample.sparkSession)
    found = sample.mapInArrow(hashed, "doc_id long, toxic int, f array<long>").toArrow()
    found = found.sort_by([("doc_id", "ascending")]).combine_chunks()
    toxic = np.asarray(found.column("toxic").to_pylist(), dtype=np.int64)
    n = len(toxic)
    if n == 0 or toxic.min() == toxic.max():
        return OrdinalModel()
    lists = found.column("f").combine_chunks()
    flat = lists.flatten().to_numpy()
    row = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
    names, at = np.unique(flat, return_inverse=True)
    held = np.bincount(at, minlength=len(names))
    use = (held >= MIN_DOCS) & (held <= max(MIN_DOCS, MAX_SHARE * n))
    col = np.cumsum(use) - 1
    keep = use[at]
    row, at, names = row[keep], col[at[keep]], names[use]
    if not len(names):
        return OrdinalModel()
    hits = np.bincount(at, weights=toxic[row].astype(float), minlength=len(names))
    rest = np.bincount(at, minlength=len(names)) - hits
    odds = np.log((hits + 0.5) / (toxic.sum() + 1)) - np.log((rest + 0.5) / (n - toxic.sum() + 1))
    marks = np.bincount(row, weights=(odds >= MARKER_ODDS)[at].astype(float), minlength=n)
    usual = np.median(marks[toxic == 1])
    grade = toxic + ((toxic == 1) & (marks > usual))
    return _descend(np, row, at, grade, names)


def _descend(np, row, at, grade, names) -> OrdinalModel:
    """Adam steps on the mean log loss, with soft thresholding of the shared weights."""
    n, k = len(grade), int(grade.max())
    w, moment, square = np.zeros(len(names)), np.zeros(len(names)), np.zeros(len(names))
    below = np.array([np.mean(grade <= j) for j in range(k)])
    cuts = np.log(below / (1 - below))
    cut_square = np.zeros(k)

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))

    for t in range(1, STEPS + 1):
        s = np.bincount(row, weights=w[at], minlength=n)
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        up, low = sigmoid(edges[grade + 1] - s), sigmoid(edges[grade] - s)
        share = np.maximum(up - low, 1e-12)
        pull = (1 - up - low) / n                      # of the loss, by the score
        g = np.bincount(at, weights=pull[row], minlength=len(names))
        cut_g = np.zeros(k)
        for j in range(k):
            cut_g[j] = (np.sum((low * (1 - low) / share)[grade == j + 1])
                        - np.sum((up * (1 - up) / share)[grade == j])) / n
        moment = 0.9 * moment + 0.1 * g
        square = 0.999 * square + 0.001 * g * g
        step = RATE * (moment / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
        w = w - step
        w = np.sign(w) * np.maximum(np.abs(w) - RATE * L1 / (np.sqrt(square / (1 - 0.999**t)) + 1e-4), 0)
        cut_square = 0.999 * cut_square + 0.001 * cut_g * cut_g
        cuts = np.sort(cuts - RATE * cut_g / (np.sqrt(cut_square / (1 - 0.999**t)) + 1e-8))
    used = np.abs(w) > 1e-6
    return OrdinalModel(dict(zip(names[used].tolist(), w[used].tolist(), strict=True)), tuple(cuts.tolist()))


def score(docs: DataFrame, model: OrdinalModel, reject: float = REJECT) -> DataFrame:
    """(doc_id, expected_severity, grade, toxic) for every row of ``docs``.

    ``expected_severity`` is the sum of P(grade >= k); ``grade`` is the largest
    grade of at least even probability. Null and empty texts have no features
    and score as such; repeated rows and null ids stay rows of their own;
    labels without both classes give severity 0 everywhere.
    """
    import pyarrow as pa

    def graded(batches):
        for b in batches:
            p = [model.at_least(t) for t in b.column(1).to_pylist()]
            severity = [math.fsum(x) for x in p]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(severity, pa.float64()),
                 pa.array([sum(v >= 0.5 for v in x) for x in p], pa.int32()),
                 pa.array([s >= reject for s in severity], pa.bool_())],
                ["doc_id", "expected_severity", "grade", "toxic"])

    ship_package(docs.sparkSession)
    return doc_rows(docs).mapInArrow(graded, "doc_id long, expected_severity double, grade int, toxic boolean")


def drop_toxic(docs: DataFrame, model: OrdinalModel, reject: float = REJECT) -> DataFrame:
    """``docs`` without the rows whose expected severity reaches ``reject``; columns stay as they are."""
    @F.pandas_udf("double")
    def severity(text: pd.Series) -> pd.Series:
        return pd.Series([model.expected(t) for t in text], dtype="float64")

    ship_package(docs.sparkSession)
    return docs.where(severity(F.col("text").cast("string")) < reject)
