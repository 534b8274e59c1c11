"""Plain lines are told from all others, and both give the fields and rescued text of variant parsing."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketflow.sources import rescue

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("b", T.BooleanType())])
# line, plain?, (id, n, x, b), rescued text
LINES = [
    ('{"id":"a","n":1,"x":2.5,"b":true}', True, ("a", 1, 2.5, True), None),
    (' { "b" : null, "id" : "1995-03-01" } ', True, ("1995-03-01", None, None, None), None),
    ("{}", True, (None,) * 4, None),
    ('{"x":3}', True, (None, None, 3.0, None), None),
    ('{"id":"5"}', False, ("5", None, None, None), None),                          # may have been a number
    ('{"id":5}', False, (None,) * 4, '{"id":5}'),
    ('{"id":true,"n":1}', False, (None, 1, None, None), '{"id":true}'),
    ('{"id":{"a":1}}', False, (None,) * 4, '{"id":{"a":1}}'),
    ('{"id":1e400}', False, (None,) * 4, '{"id":"Infinity"}'),
    ('{"x":"NaN"}', False, (None,) * 4, '{"x":"NaN"}'),
    ('{"x":1e400,"n":2}', False, (None, 2, None, None), '{"x":"Infinity"}'),
    ('{"x":0}', False, (None, None, 0.0, None), None),
    ('{"n":2.5}', False, (None,) * 4, '{"n":2.5}'),
    ('{"n":1,"N":2}', False, (None, 1, None, None), '{"N":2}'),
    ('{"n":1,"n":1}', False, (None,) * 4, '{"n":1,"n":1}'),                        # a key twice
    ("{'id':'a'}", False, (None,) * 4, "{'id':'a'}"),
    ('[{"id":"a"}]', False, (None,) * 4, '[{"id":"a"}]'),
    ('{"id":"a"', False, (None,) * 4, '{"id":"a"'),
    ('{"_bad":"a"}', False, (None,) * 4, '{"_bad":"a"}'),
]


def test_plain_and_other_lines(spark):
    lines = spark.createDataFrame([(x[0],) for x in LINES] + [("  ",)], "value string")
    got = {r.line: r for r in rescue.rescue_json(lines.withColumn("line", F.col("value")), SCHEMA, keep=("line",)).collect()}
    assert got.keys() == {x[0] for x in LINES}
    for line, _, fields, rescued in LINES:
        assert tuple(got[line])[:4] == fields, line
        assert got[line]._rescued_data == rescued or json.loads(got[line]._rescued_data) == json.loads(rescued), line


def test_only_other_lines_are_parsed_as_variant(spark):
    with_bad = T.StructType([*SCHEMA.fields, T.StructField("_bad", T.StringType())])
    lines = spark.createDataFrame([(x[0],) for x in LINES], "value string").select("value", F.from_json("value", with_bad, rescue._STRICT).alias("read"))
    plain = rescue._plain(F.col("value"), F.json_object_keys("value"), F.col("read"), SCHEMA)
    assert {r.value: r.plain for r in lines.select("value", plain.alias("plain")).collect()} == {x[0]: x[1] for x in LINES}
    plan = rescue.rescue_json(lines.select("value"), SCHEMA)._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN NOT _plain" in plan and plan.count("parseJson") == 1
