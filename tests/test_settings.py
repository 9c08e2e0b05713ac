"""Settings documents (H1, H5-H11), with the reference's own fixtures."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.literals import infer_type
from meterlake.operators import settings as stg


def test_flatten_columns_reference_fixture(spark):
    # {'a': 1, 'b': {'x': 2, 'y': 3}, 'c': 4} -> a, b.x, b.y, c
    df = spark.range(1).select(F.lit(1).alias("a"), F.struct(F.lit(2).alias("x"), F.lit(3).alias("Y")).alias("B"),
                               F.lit(4).alias("c"))
    flat = stg.flatten_columns(df)
    assert flat.columns == ["a", "b.x", "b.y", "c"]
    assert tuple(flat.first()) == (1, 2, 3, 4)


def test_leaf_names_and_collision(spark):
    df = spark.range(1).select(F.lit(1).alias("a.b"), F.lit(2).alias("c.d"))
    assert stg.leaf_names(df).columns == ["b", "d"]
    assert stg.leaf_names(df, keep_level=0).columns == ["a", "c"]
    clash = spark.range(1).select(F.lit(1).alias("a.b"), F.lit(2).alias("c.b"))
    with pytest.raises(ValueError):
        stg.leaf_names(clash)


def test_nest_columns(spark):
    df = spark.range(1).select(F.lit(1).alias("a.b"), F.lit(2).alias("c.d"), F.lit(3).alias("e"))
    nested = stg.nest_columns(df)
    assert nested.columns == ["a", "c", "e"]
    row = nested.first()
    assert row["a"]["b"] == 1 and row["c"]["d"] == 2 and row["e"] == 3
    with pytest.raises(ValueError):
        stg.nest_columns(spark.range(1).select(F.lit(1).alias("a.b.c")))


LITERALS = ["1", "1.0", "True", "False", "test", "0", "yes", "N", "42", ".5", "-3"]


def test_infer_type_literals(spark):
    df = spark.createDataFrame([(x,) for x in LITERALS], "v string")
    got = [tuple(r[0]) for r in df.select(infer_type("v")).collect()]
    kinds = [g[0] for g in got]
    assert kinds == ["bool", "float", "bool", "bool", "str", "bool", "bool", "bool", "int", "float", "str"]
    assert got[0][1] is True and got[3][1] is False and got[7][1] is False
    assert got[8][2] == 42 and got[1][3] == 1.0 and got[9][3] == 0.5 and got[4][4] == "test"


def test_set_values_known_and_unknown(spark):
    settings = spark.createDataFrame([(1, "portal.nif", "123"), (1, "influxdb.port", "8086")],
                                     "t int, key string, value string")
    updates = spark.createDataFrame([(1, "influxdb.port", "9999", 2), (1, "influxdb.port", "7777", 1),
                                     (1, "nope", "x", 3)], "t int, key string, value string, seq long")
    merged, unknown = stg.set_values(settings, updates, scope=["t"])
    got = {r["key"]: (r["value"], r["changed"], r["value_type"]) for r in merged.collect()}
    assert got == {"portal.nif": ("123", False, "int"), "influxdb.port": ("9999", True, "int")}
    assert [r["key"] for r in unknown.collect()] == ["nope"]
    env = {r["key"]: r["value"] for r in stg.env_pairs(merged.select("key", "value")).collect()}
    assert env == {"PORTAL.NIF": "123", "INFLUXDB.PORT": "9999"}


def test_schema_violations_and_parse(spark):
    schema = T.StructType([T.StructField("portal", T.StructType([T.StructField("nif", T.IntegerType()),
                                                                   T.StructField("cpe", T.StringType())]))])
    docs = spark.createDataFrame([
        (1, '{"portal": {"nif": 5, "cpe": "PT1"}}'),
        (2, '{"portal": {"nif": "5", "cpe": "PT1"}}'),
        (3, '{"portal": {"nif": 5, "cpe": 7}}'),
        (4, '{"portal": {"nif": 5}}'),
        (5, "nope"),
        (6, '{"portal": {"nif": 5, "cpe": 7, "x": {"cpe": "PT9"}}}'),   # same key nested deeper is a string
        (7, '{"portal": "text"}'),
        (8, '{"portal": {"nif": 5, "cpe": "PT1"}, "more": 1}'),
    ], "id int, doc string")
    v = {r["id"]: r["violation"] for r in stg.schema_violations(docs, "doc", schema, require_all=True).collect()}
    assert v == {1: None, 2: "type: portal.nif", 3: "type: portal.cpe", 4: "missing: portal.cpe", 5: "malformed",
                 6: "undeclared: portal.x", 7: "container: portal", 8: "undeclared: more"}
    v2 = {r["id"]: r["violation"] for r in stg.schema_violations(docs, "doc", schema).collect()}
    assert v2[4] is None
    good, bad = stg.parse_document(docs, "doc", schema, require_all=True)
    assert [r["portal"]["cpe"] for r in good.collect()] == ["PT1"]
    assert bad.count() == 7
