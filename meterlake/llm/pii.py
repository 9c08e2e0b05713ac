"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

All of it is DataFrame functions; a document is searched in its own row, so
nothing is shuffled. Patterns use possessive loops and look-behinds, which give
the same matches as the plain forms without their recursion and rescans, so a
text of any length is searched in linear time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import doc_rows
from meterlake.llm.spans import kind_count, kind_start_end, listing, matches

# Words that make a kind likelier nearby.
CONTEXT = {
    "email": ["email", "e-mail", "mail", "contact", "write to"],
    "ip": ["ip", "address", "host", "server", "login"],
    "card": ["card", "visa", "mastercard", "amex", "payment", "credit"],
    "phone": ["phone", "tel", "call", "mobile", "fax"],
    "iban": ["iban", "account", "bank", "transfer", "bic"],
    "ssn": ["ssn", "social security", "taxpayer"],
}
CONTEXT_REACH = 40


def luhn(digits: Column) -> Column:
    """Whether a string of ASCII digits passes the Luhn check."""
    each = F.split(F.reverse(digits), "")

    def term(x, i):
        v = x.cast("int") * (F.lit(1) + i % 2)
        return F.when(v > 9, v - 9).otherwise(v)

    return F.aggregate(F.transform(each, term), F.lit(0), lambda a, v: a + v) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an IBAN (upper-case letters and digits, no spaces) leaves 1 modulo 97."""
    moved = F.split(F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4)), "")

    def push(rest, c):
        letter = F.ascii(c) - 55
        return F.when(letter >= 10, (rest * 100 + letter) % 97).otherwise((rest * 10 + F.ascii(c) - 48) % 97)

    return F.aggregate(moved, F.lit(0), push) == 1


def _digits(match: Column) -> Column:
    return F.translate(match, "+ ().-", "")


def _is_ip(match: Column, _) -> Column:
    short = F.transform(F.split(match, "[.]"), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(short, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False))


def _is_card(match: Column, _) -> Column:
    d = F.translate(match, " -", "")
    return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)


def _is_iban(match: Column, _) -> Column:
    return mod97(F.translate(match, " ", ""))


@dataclass(frozen=True)
class Kind:
    """One kind of personal data. ``sure``: the score of a span without context words."""

    name: str
    pattern: str
    passes: object
    hint: str
    sure: float
    base: bool


_LOCAL = "A-Za-z0-9._%+-"
KINDS = (
    # An address may start where the last one ended, inside a run of local characters.
    Kind("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda m, g: F.lit(True), "@", 0.9, True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _is_ip, r"[0-9]\.[0-9]", 0.6, True),
    Kind("card", r"[0-9]++(?:[\x20-][0-9]++)*+", _is_card, r"[0-9](?:[\x20-]?[0-9]){12}", 0.9, True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, g: F.length(_digits(m)).between(9, 15),
         r"\+[0-9][\x20().0-9-]", 0.7, True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)"
         r"(?![A-Za-z0-9])", _is_iban, r"[A-Z]{2}[0-9]{2}[A-Z0-9\x20]", 0.9, False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda m, g: F.lit(True),
         r"[0-9]{3}-[0-9]{2}-[0-9]", 0.2, False),
)
BASE = tuple(k.name for k in KINDS if k.base)
CONTEXT_BONUS = 0.4


def _scored(text: Column, kind: Kind) -> Column:
    """(kind, start, end, value, score) of one kind; score rises with a context word nearby."""
    hint = F.contains(text, F.lit("@")) if kind.hint == "@" else F.regexp_like(text, F.lit(kind.hint))
    found = matches(text, kind.pattern, kind.passes, hint)
    near = "(?i)(?<![a-z])(?:" + "|".join(CONTEXT[kind.name]) + ")(?![a-z])"

    def scored(s):
        first = F.greatest(s["start"] - CONTEXT_REACH, F.lit(0))
        around = F.concat(F.substring(text, first + 1, s["start"] - first), F.lit("\n"),
                          F.substring(text, s["end"] + 1, F.lit(CONTEXT_REACH)))
        bonus = F.when(F.regexp_like(around, F.lit(near)), CONTEXT_BONUS).otherwise(0.0)
        return F.struct(F.lit(kind.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        s["value"].alias("value"), F.least(F.lit(1.0), F.lit(kind.sure) + bonus).alias("score"))

    return F.transform(found, scored)


def find_pii(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """(doc_id, spans): the personal data of every row, as arrays of (kind, start, end, value, score).

    Spans come by kind in the order of ``KINDS``, then by start; offsets are
    code points, the end exclusive. A span stays when its checksum holds and
    its score -- the kind's own, more with a context word within 40 characters
    -- reaches ``min_score``; kinds of the base set (email, ip, card, phone)
    stay at any score. One row per input row, repeated rows included; a null
    text counts as empty; an empty table gives no rows.
    """
    text = F.col("text")
    rows = doc_rows(docs).select("doc_id", F.coalesce(text, F.lit("")).alias("text"))
    parts = []
    for k in KINDS:
        spans = _scored(text, k)
        parts.append(spans if k.base else F.filter(spans, lambda s: s["score"] >= min_score))
    return rows.select("doc_id", F.concat(*parts).alias("spans"))


def pii_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of ``find_pii``: counts, hash of the base spans, all spans."""
    found = find_pii(docs)
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    counts = [kind_count(spans, k).alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts,
                        F.sha2(listing(base, kind_start_end), 256).alias("base_sha256"),
                        listing(spans, kind_start_end).alias("spans"))
