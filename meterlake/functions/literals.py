"""Type inference of setting values given as text (H1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words read as booleans (compared lower-cased).
TRUE_WORDS = ("true", "yes", "y", "1")
FALSE_WORDS = ("false", "no", "n", "0")

INT_PATTERN = r"^[0-9]+$"
FLOAT_PATTERN = r"^([0-9]+[.][0-9]*|[.][0-9]+)$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def inferred_type(text) -> Column:
    """``bool``, ``int``, ``float`` or ``str`` for a text value (null stays null).

    Order matters: ``"1"`` and ``"0"`` are booleans; digits only is an int; one
    dot among digits is a float; anything else (including negatives) stays text.
    ASCII digits only.
    """
    s = _c(text)
    low = F.lower(s)
    return (F.when(s.isNull(), F.lit(None))
            .when(low.isin(*TRUE_WORDS) | low.isin(*FALSE_WORDS), "bool")
            .when(s.rlike(INT_PATTERN), "int")
            .when(s.rlike(FLOAT_PATTERN), "float")
            .otherwise("str"))


def infer_type(text) -> Column:
    """H1: struct(type, as_bool, as_int, as_float, as_str) with only the matching value set.

    Digits beyond a 64-bit integer stay an ``int`` and keep their text in ``as_str``.
    """
    s = _c(text)
    t = inferred_type(s)
    return F.struct(
        t.alias("type"),
        F.when(t == "bool", F.lower(s).isin(*TRUE_WORDS)).alias("as_bool"),
        F.when(t == "int", s.try_cast("bigint")).alias("as_int"),
        F.when(t == "float", s.try_cast("double")).alias("as_float"),
        F.when((t == "str") | ((t == "int") & s.try_cast("bigint").isNull()), s).alias("as_str"),
    )
