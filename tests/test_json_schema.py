"""The JSON schema compiler: every keyword on hand-made documents."""
import pytest
from pyspark.sql import functions as F

from tripflow.operators.json_schema import validate, validation_report

SCHEMA = {
    "title": "t", "type": "object", "required": ["a", "b.c"], "additionalProperties": False,
    "properties": {
        "a": {"type": "integer", "exclusiveMinimum": 0, "exclusiveMaximum": 10},
        "b.c": {"const": "x"},
        "d": {"type": "array", "minItems": 1, "items": {"type": "object", "required": ["e"], "properties": {
            "e": {"type": ["number", "null"], "maximum": 5}, "f": {"type": "array", "items": {"enum": [1, "1", True, None]}}}}},
        "it's?": {"type": "string", "minLength": 2, "pattern": "b"},
        "never": False, "any": True,
    },
}
CASES = [
    ('{"a":1,"b.c":"x"}', "Success"),
    (' {"a":1.0,"b.c":"x","any":[{}]} ', "Success"),
    (None, "$: no document"), ("", "$: not JSON"), ("{", "$: not JSON"), ('{"a":1,"b.c":"x"} 7', "$: not JSON"),
    ('{"a":1}{"a":1}', "$: not JSON"), ('{"a":1,"a":2,"b.c":"x"}', "$: not JSON"), ("7", "$: type"), ("null", "$: type"), ("[]", "$: type"),
    ("{}", "$.a: required"), ('{"a":1}', "$.b.c: required"), ('{"a":null,"b.c":"x"}', "$.a: type"),
    ('{"a":1.5,"b.c":"x"}', "$.a: type"), ('{"a":true,"b.c":"x"}', "$.a: type"), ('{"a":"1","b.c":"x"}', "$.a: type"),
    ('{"a":0,"b.c":"x"}', "$.a: exclusiveMinimum"), ('{"a":10,"b.c":"x"}', "$.a: exclusiveMaximum"),
    ('{"a":1,"b.c":"y"}', "$.b.c: const"), ('{"a":1,"b.c":"x","z":1,"y":1}', "$.y: not allowed"),
    ('{"a":1,"b.c":"x","d":[]}', "$.d: minItems"), ('{"a":1,"b.c":"x","d":[{"e":1},{}]}', "$.d[1].e: required"),
    ('{"a":1,"b.c":"x","d":[{"e":null},{"e":5.5}]}', "$.d[1].e: maximum"), ('{"a":1,"b.c":"x","d":[3]}', "$.d[0]: type"),
    ('{"a":1,"b.c":"x","d":[{"e":1,"f":[1,"1",true,null,1.0]}]}', "Success"),
    ('{"a":1,"b.c":"x","d":[{"e":1,"f":[1,false]}]}', "$.d[0].f[1]: enum"),
    ('{"a":1,"b.c":"x","it\'s?":"\U0001F600b"}', "Success"), ('{"a":1,"b.c":"x","it\'s?":"b"}', "$.it's?: minLength"),
    ('{"a":1,"b.c":"x","it\'s?":"cc"}', "$.it's?: pattern"), ('{"a":1,"b.c":"x","it\'s?":null}', "$.it's?: type"),
    ('{"a":1,"b.c":"x","never":1}', "$.never: not allowed"),
]


def test_every_keyword(spark):
    df = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(CASES)], "i int, doc string")
    got = {r["i"]: r["v"] for r in df.select("i", validate("doc", SCHEMA).alias("v")).collect()}
    assert [(d, got[i]) for i, (d, _) in enumerate(CASES)] == CASES


def test_report_and_plan(spark):
    df = spark.createDataFrame([("[1,2]",), ("[1,\"x\"]",), ("[true]",), (None,)], "doc string")
    rep = validation_report(df, "doc", {"items": {"type": "integer"}})
    assert {(r["verdict"], r["rows"]) for r in rep.collect()} == {("Success", 1), ("$[]: type", 2), ("$: no document", 1)}
    assert validation_report(df.limit(0), "doc", True).count() == 0
    from tripflow.plans.catalog import plan_text
    plan = plan_text(spark.range(3).select(validate(F.col("id").cast("string"), SCHEMA).alias("v")))
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("bad", [{"oneOf": []}, {"type": "text"}, {"additionalProperties": {}}, {"enum": [[1]]}])
def test_unsupported_schemas_are_errors(spark, bad):
    with pytest.raises(ValueError):
        validate("doc", bad)
