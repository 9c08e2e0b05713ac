"""Secret scans over a ledger of content-addressed blobs.

Each version of a text is a blob, addressed by its SHA-256. The ledger (a
folder of Parquet tables) knows which rule versions have scanned which blob, so
a run scans one copy of each blob by the rules it has not met, appends what it
found, and joins findings back to every path that holds the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import doc_rows
from meterlake.llm.spans import kind_count, kind_start_end, listing, matches
from meterlake.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """One kind of secret; a changed pattern needs a new ``version``."""

    kind: str
    version: int
    pattern: str
    hint: str
    least: int
    group: int = 0
    base: bool = False

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


RULES = (
    Rule("assign", 1, r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)",
         r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]", 8, 2, True),
    Rule("access", 1, r"AKIA[A-Z0-9]++", "AKIA", 16, 0, True),
    # Runs below 32 digits fail whole, so only long runs need be met.
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{32,}+", r"[0-9a-f]{32}", 32, 0, True),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}+", r"gh[pousr]_", 40),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}+", "xox", 15),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", "eyJ", 30),
    Rule("pem", 1, r"-----BEGIN (?:[A-Z]{1,20} ){0,4}PRIVATE KEY-----", "PRIVATE KEY-----", 20),
)
BASE = tuple(r.kind for r in RULES if r.base)
SPANS = "array<struct<start:int,place:int,end:int,kind:string,value:string>>"
LEDGER = f"blob_id string, rule string, spans {SPANS}"


def blob_id(text: Column) -> Column:
    """Content address of a text (null counts as empty)."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _findings(text: Column, rule: Rule, place: int) -> Column:
    hint = (F.regexp_like(text, F.lit(rule.hint)) if "[" in rule.hint or "(" in rule.hint
            else F.contains(text, F.lit(rule.hint)))
    found = matches(text, rule.pattern, lambda m, g: F.length(g) >= rule.least, hint, rule.group)
    return F.transform(found, lambda s: F.struct(s["start"], F.lit(place).alias("place"), s["end"],
                                                 F.lit(rule.kind).alias("kind"), s["value"])).cast(SPANS)


def _ledger(docs: DataFrame, path: str) -> DataFrame:
    """The ledger's rows; a folder that has none yet is an empty ledger."""
    spark = docs.sparkSession
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan_unseen(docs: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger has not seen, append it, and return the ledger.

    Rows of the ledger: (blob_id, rule, spans), one per scanned pair of blob
    and rule version, found or not. Copies of a blob are combined before the
    shuffle, so a text that fills a third of the rows is scanned once. Runs that
    overlap, or a run that its caller repeats, may append a pair twice; readers
    count equal rows once.
    """
    keys = [r.key for r in rules]
    blobs = (doc_rows(docs).select(blob_id(F.col("text")).alias("blob_id"),
                                   F.coalesce("text", F.lit("")).alias("text"))
             .groupBy("blob_id").agg(F.first("text").alias("text")))
    seen = (_ledger(docs, ledger_path).where(F.col("rule").isin(keys))
            .groupBy("blob_id").agg(F.collect_set("rule").alias("seen")))
    todo = blobs.join(seen, "blob_id", "left").where(F.coalesce(F.size("seen"), F.lit(0)) < len(keys))
    done = F.coalesce(F.col("seen"), F.expr("cast(array() as array<string>)"))
    scans = [F.when(~F.array_contains(done, r.key),
                    F.struct(F.lit(r.key).alias("rule"), _findings(F.col("text"), r, i).alias("spans")))
             for i, r in enumerate(rules)]
    new = (todo.select("blob_id", F.array_compact(F.array(*scans)).alias("scan"))
           .select("blob_id", F.explode("scan").alias("s")).select("blob_id", "s.rule", "s.spans"))
    new.write.mode("append").parquet(ledger_path)
    return _ledger(docs, ledger_path)


def scan_secrets(docs: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob_id, spans) for every row of ``docs``, the path being ``doc_id``.

    ``spans`` holds (start, place, end, kind, value) by start, then by the
    order of ``rules``; offsets are code points, the end exclusive. Without a
    ``ledger_path`` a new ledger is begun in the shared folder. A null text
    counts as empty; repeated rows and null ids are paths of their own; an
    empty table gives no rows.
    """
    where = ledger_path or scratch_path(docs.sparkSession, "secret_ledger")
    keys = [r.key for r in rules]
    found = (scan_unseen(docs, where, rules).where(F.col("rule").isin(keys) & (F.size("spans") > 0))
             .groupBy("blob_id").agg(F.collect_set(F.struct("rule", "spans")).alias("scans"))
             .select("blob_id", F.sort_array(F.flatten("scans.spans")).alias("spans")))
    paths = doc_rows(docs).select("doc_id", blob_id(F.col("text")).alias("blob_id"))
    return paths.join(found, "blob_id", "left").select(
        "doc_id", "blob_id", F.coalesce("spans", F.expr(f"cast(array() as {SPANS})")).alias("spans"))


def secret_digest(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """The contract's columns of ``scan_secrets``: counts, hash of the base spans, all spans."""
    found = scan_secrets(docs, ledger_path)
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    counts = [kind_count(spans, k).alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts,
                        F.sha2(listing(base, kind_start_end), 256).alias("base_sha256"),
                        listing(spans, kind_start_end).alias("spans"))
