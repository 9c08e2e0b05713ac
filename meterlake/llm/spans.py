"""Regular-expression spans with code-point offsets, in DataFrame functions only.

Spark returns the matches of a pattern but not where they lie. Splitting by the
same pattern gives the text between them, so the running sum of the lengths of
both gives every start and end in code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,value:string>"


def matches(text: Column, pattern: str, passes, hint: Column | None = None, group: int = 0) -> Column:
    """Array of (start, end, value) of the leftmost non-overlapping matches that pass.

    ``passes(match, group)`` gives a boolean; failing matches are dropped and
    their text is not tried again. ``hint`` is a cheap necessary condition:
    texts without it are not searched. ``text`` must not be null.
    """
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    between = F.split(text, pattern, -1)
    rows = F.arrays_zip(F.slice(between, 1, F.size(between) - 1).alias("gap"), found.alias("hit"), part.alias("part"))

    def step(acc, x):
        start = acc["pos"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("value"))
        return F.struct(end.alias("pos"),
                        F.when(passes(x["hit"], x["part"]), F.concat(acc["out"], F.array(span)))
                        .otherwise(acc["out"]).alias("out"))

    out = F.aggregate(rows, F.struct(F.lit(0).alias("pos"), none.alias("out")), step, lambda acc: acc["out"])
    searched = F.regexp_like(text, F.lit(pattern)) if hint is None else hint
    return F.when(searched, out).otherwise(none)


def listing(spans: Column, label) -> Column:
    """``label(span)`` texts joined by commas."""
    return F.array_join(F.transform(spans, label), ",")


def kind_start_end(span: Column) -> Column:
    return F.concat_ws(":", span["kind"], span["start"].cast("string"), span["end"].cast("string"))


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
