"""Settings documents as columns and key/value rows.

All functions are schema-level rewrites (resolved on the driver from the
schema, executed as plain projections) or joins on key/value rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.literals import inferred_type


def _q(parts: Sequence[str]) -> str:
    return ".".join(f"`{p}`" for p in parts)


def _leaves(st: T.StructType, path: tuple[str, ...] = ()):
    for f in st.fields:
        p = path + (f.name,)
        if isinstance(f.dataType, T.StructType):
            yield from _leaves(f.dataType, p)
        else:
            yield p


def flatten_columns(df: DataFrame, sep: str = ".") -> DataFrame:
    """H5: nested structs -> one column per leaf, named by the lower-cased dotted path."""
    return df.select(*[F.col(_q(p)).alias(sep.join(p).lower()) for p in _leaves(df.schema)])


def leaf_names(df: DataFrame, sep: str = ".", keep_level: int = -1) -> DataFrame:
    """H6: keep one segment of each dotted name (default the last).

    Deviation: two columns mapping to the same name is an error (a dict would
    silently keep the last).
    """
    new = [c.split(sep)[keep_level] for c in df.columns]
    dup = sorted({n for n in new if new.count(n) > 1})
    if dup:
        raise ValueError(f"names collide after keeping level {keep_level}: {dup}")
    return df.toDF(*new)


def nest_columns(df: DataFrame, sep: str = ".") -> DataFrame:
    """H7: ``a.b`` columns -> struct ``a`` with field ``b``; plain names stay.

    Deviation: names with more than two segments are an error instead of
    losing the third segment onward.
    """
    groups: dict[str, list[tuple[str, str]]] = {}
    order: list[str] = []
    for c in df.columns:
        parts = c.split(sep)
        if len(parts) > 2:
            raise ValueError(f"column {c!r} nests deeper than two levels")
        head = parts[0]
        if head not in groups:
            groups[head] = []
            order.append(head)
        groups[head].append((c, parts[1] if len(parts) == 2 else ""))
    cols = []
    for head in order:
        members = groups[head]
        if len(members) == 1 and members[0][1] == "":
            cols.append(F.col(f"`{members[0][0]}`").alias(head))
        elif any(m[1] == "" for m in members):
            raise ValueError(f"{head!r} is both a value and a group")
        else:
            cols.append(F.struct(*[F.col(f"`{c}`").alias(leaf) for c, leaf in members]).alias(head))
    return df.select(*cols)


def set_values(settings: DataFrame, updates: DataFrame, scope: Sequence[str] = (),
               key: str = "key", value: str = "value", seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """H8: apply ``updates`` (last one per key wins) to known keys only.

    Returns (settings with new values and their inferred type, updates naming
    unknown keys). Both are joins on (scope..., key); no driver-side dict.
    """
    k = [*scope, key]
    last = (updates.groupBy(*k)
            .agg(F.max_by(F.col(value), F.col(seq)).alias("_new")))
    known = settings.select(*k).distinct()
    unknown = last.join(known, k, "left_anti").withColumnRenamed("_new", value)
    merged = (settings.join(last, k, "left")
              .select(*k, F.coalesce(F.col("_new"), F.col(value)).alias(value),
                      F.col("_new").isNotNull().alias("changed")))
    return merged.withColumn("value_type", inferred_type(F.col(value))), unknown


def env_pairs(kv: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """H9: environment-style pairs: upper-cased key, value as text."""
    others = [c for c in kv.columns if c not in (key, value)]
    return kv.select(*others, F.upper(F.col(key)).alias(key), F.col(value).cast("string").alias(value))


def _containers(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.StructType]]:
    """Every declared map with its path, outermost first."""
    out = [(path, schema)]
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            out += _containers(f.dataType, (*path, f.name))
    return out


def _json_field(doc: Column, path: Sequence[str]) -> Column:
    return F.get_json_object(doc, "$." + ".".join(path))


def _json_type(doc: Column, path: Sequence[str]) -> Column:
    """JSON type of the value at ``path`` (``STRING``, ``BIGINT``, ``OBJECT<...>``, ...):
    the document parsed as a VARIANT, so a same-named key elsewhere cannot be mistaken for it."""
    value = F.try_variant_get(F.try_parse_json(doc), "$." + ".".join(path), "variant")
    return F.schema_of_variant(value)


def schema_violations(df: DataFrame, doc: str, schema: T.StructType, require_all: bool = False) -> DataFrame:
    """Per row, the first rule the document breaks (null when valid).

    Rules: the text must be a JSON object; each declared container must be a
    map (``container: <path>``) without keys that the schema does not declare
    (``undeclared: <path>``, the alphabetically first); each declared leaf must
    parse as its type (strings must be JSON strings); with ``require_all`` every
    leaf must be present.
    """
    d = F.col(doc)
    as_map = F.from_json(d, T.MapType(T.StringType(), T.StringType()))
    parsed = F.from_json(d, schema)
    reason = F.when(d.isNull() | as_map.isNull(), F.lit("malformed"))
    for path, inner in _containers(schema):
        held = F.from_json(_json_field(d, path), T.MapType(T.StringType(), T.StringType())) if path else as_map
        name = ".".join(path)
        if path:
            kind = _json_type(d, path)
            reason = reason.when(kind.isNotNull() & ~kind.startswith("OBJECT"), F.lit(f"container: {name}"))
        more = F.array_sort(F.array_except(F.map_keys(held), F.array(*[F.lit(c) for c in inner.names])))
        reason = reason.when(F.size(more) > 0, F.concat(F.lit("undeclared: " + (name + "." if name else "")), more[0]))
    for path in _leaves(schema):
        leaf_type = schema
        for p in path:
            leaf_type = leaf_type[p].dataType
        raw = _json_field(d, path)
        typed = parsed
        for p in path:
            typed = typed.getField(p)
        name = ".".join(path)
        if require_all:
            reason = reason.when(raw.isNull(), F.lit(f"missing: {name}"))
        if isinstance(leaf_type, T.StringType):
            bad = raw.isNotNull() & (_json_type(d, path) != F.lit("STRING"))
        else:
            bad = raw.isNotNull() & typed.isNull()
        reason = reason.when(bad, F.lit(f"type: {name}"))
    return df.withColumn("violation", reason)


def parse_document(df: DataFrame, doc: str, schema: T.StructType,
                   require_all: bool = False) -> tuple[DataFrame, DataFrame]:
    """Validated documents parsed into columns; (parsed, rejected with reason)."""
    checked = schema_violations(df, doc, schema, require_all)
    good = (checked.filter(F.col("violation").isNull())
            .withColumn("_doc", F.from_json(F.col(doc), schema))
            .select(*[c for c in df.columns if c != doc], "_doc.*"))
    bad = checked.filter(F.col("violation").isNotNull())
    return good, bad
