import pytest

from pyspark.sql import functions as F

from stepledger.domain import DEFAULT
from stepledger.functions import jsontext, schema
from stepledger.functions.schema import SchemaError, Validator

# keyword, schema, values that fit, values that do not
CASES = [
    ("type", {"type": "integer"}, [1, 2.0, -3, 10**400], [1.5, "1", None, True, []]),
    ("type list", {"type": ["string", "null"]}, ["a", None], [1, False]),
    ("number", {"type": "number"}, [1, 1.5], [True, "1"]),
    ("enum", {"enum": [1, [True], {"a": None}]}, [1.0, [True], {"a": None}], [True, [1], {"a": 0}]),
    ("const", {"const": {"a": 1, "b": [2]}}, [{"b": [2.0], "a": 1}], [{"a": 1}, {"a": True, "b": [2]}]),
    ("false zero", {"const": False}, [False], [0, None]),
    ("all, any, one, not", {"allOf": [{"minimum": 1}], "anyOf": [{"maximum": 3}, {"minimum": 9}], "not": {"const": 2}}, [1, 3, 9], [0, 2, 5]),
    ("oneOf", {"oneOf": [{"minimum": 2}, {"maximum": 4}]}, [1, 5], [3]),
    ("if", {"if": {"minimum": 10}, "then": {"multipleOf": 5}, "else": {"maximum": 3}}, [10, 3], [11, 4]),
    ("bounds", {"minimum": 1, "exclusiveMaximum": 3}, [1, 2.9, "x"], [0.99, 3]),
    ("multipleOf", {"multipleOf": 0.01}, [0.07, 19.99, 1], [0.075]),
    ("lengths", {"minLength": 2, "maxLength": 3}, ["łł", "😀😀", 5], ["ł", "😀😀😀😀", ""]),
    ("pattern", {"pattern": "^user:"}, ["user:", 7], ["a user:", "a\nuser:"]),
    ("bad pattern", {"pattern": "("}, ["anything"], []),
    ("items", {"prefixItems": [{"type": "string"}], "items": {"type": "integer"}}, [[], ["a"], ["a", 1]], [[1], ["a", "b"]]),
    ("item counts", {"minItems": 1, "maxItems": 2, "uniqueItems": True}, [[1], [1, True]], [[], [1, 1.0], [1, 2, 3], [{"a": 1, "b": 2}, {"b": 2, "a": 1}]]),
    ("contains", {"contains": {"const": 1}, "minContains": 2, "maxContains": 3}, [[1, 1], [1, 2, 1, 1]], [[1], [1, 1, 1, 1]]),
    ("minContains 0", {"contains": {"const": 1}, "minContains": 0}, [[], [2]], []),
    ("objects", {"required": ["a"], "properties": {"a": {"type": "string"}}, "patternProperties": {"^x": {"type": "integer"}}, "additionalProperties": False}, [{"a": "s"}, {"a": "s", "xy": 1}, 3], [{}, {"a": 1}, {"a": "s", "xy": "1"}, {"a": "s", "b": 1}]),
    ("property counts and names", {"minProperties": 1, "maxProperties": 2, "propertyNames": {"maxLength": 2}}, [{"ab": 1}], [{}, {"abc": 1}, {"a": 1, "b": 1, "c": 1}]),
    ("dependent", {"dependentRequired": {"a": ["b"]}, "dependentSchemas": {"c": {"required": ["d"]}}}, [{"a": 1, "b": 1}, {"c": 1, "d": 1}, {}], [{"a": 1}, {"c": 1}]),
    ("unevaluated properties", {"allOf": [{"properties": {"a": True}}], "anyOf": [{"properties": {"b": {"const": 1}}, "required": ["b"]}, True], "unevaluatedProperties": False}, [{"a": 1}, {"a": 1, "b": 1}], [{"b": 2}, {"c": 1}]),
    ("unevaluated items", {"prefixItems": [True], "contains": {"const": "x"}, "unevaluatedItems": False}, [[1, "x"], ["x"]], [[1, "x", 2]]),
    ("not gives no annotations", {"not": {"not": {"properties": {"a": True}}}, "unevaluatedProperties": False}, [{}], [{"a": 1}]),
    ("references", {"$defs": {"n": {"type": "integer"}, "a/b~c": {"type": "string"}}, "properties": {"x": {"$ref": "#/$defs/n"}, "y": {"$ref": "#/$defs/a~1b~0c"}, "z": {"$ref": "#"}}}, [{"x": 1, "y": "s", "z": {"x": 2}}], [{"x": "1"}, {"y": 1}, {"z": {"x": "2"}}]),
    ("anchor", {"$defs": {"n": {"$anchor": "here", "type": "integer"}}, "$ref": "#here"}, [1], ["a"]),
    ("ids", {"$id": "http://x/root.json", "$defs": {"n": {"$id": "sub/n.json", "$defs": {"i": {"type": "integer"}}, "$ref": "#/$defs/i"}}, "$ref": "sub/n.json"}, [1], ["a"]),
    ("recursion", {"$id": "http://x/tree", "properties": {"kids": {"type": "array", "items": {"$ref": "tree"}}, "v": {"type": "integer"}}}, [{"v": 1, "kids": [{"v": 2}]}], [{"kids": [{"v": "a"}]}]),
    ("dynamic", {"$id": "http://x/strict", "$dynamicAnchor": "node", "$ref": "tree", "unevaluatedProperties": False, "$defs": {"tree": {"$id": "tree", "$dynamicAnchor": "node", "properties": {"kids": {"items": {"$dynamicRef": "#node"}}}}}}, [{"kids": [{"kids": []}]}], [{"kids": [{"typo": 1}]}]),
    ("booleans", True, [1, None], []),
    ("false", False, [], [1, None]),
    ("format is a note", {"format": "date-time", "contentMediaType": "x"}, ["no date", 3], []),
]


@pytest.mark.parametrize("name,rule,good,bad", CASES, ids=[c[0] for c in CASES])
def test_keyword(name, rule, good, bad):
    v = Validator(rule)
    assert [x for x in good if not v.is_valid(x)] == []
    assert [x for x in bad if v.is_valid(x)] == []


def test_other_documents_and_missing_ones():
    registry = {"http://x/int.json": {"type": "integer", "$defs": {"s": {"type": "string"}}}}
    assert Validator({"$id": "http://x/a.json", "$ref": "int.json"}, registry).is_valid(1)
    assert not Validator({"$ref": "http://x/int.json#/$defs/s"}, registry).is_valid(1)
    for rule in ({"$ref": "http://x/none.json"}, {"$ref": "#/$defs/none"}, {"$ref": "#none"}, {"$ref": "#"}):
        with pytest.raises(SchemaError):
            Validator(rule).is_valid({})


def test_native_columns_equal_the_validator(spark):
    import json

    values = ['{"ticket_id":"a"}', '{"ticket_id":""}', '{"ticket_id":1}', "{}", "[]", "3", '"x"', "null", '{"requester_id":"user:a","body_text":"łłłł","lifecycle_profile":"d"}', '{"requester_id":"a user:","body_text":"łł","lifecycle_profile":"d"}', '{"ticket_id":"a","window":{}}', '{"ticket_id":"a","window":{"from_utc":1}}', '{"ticket_id":"a","window":{"x":1}}', '{"ticket_id":"a","window":[]}', '{"agent_profile":{"deep":{"x":[1]}}}', '{"agent_id":"a","ticket_id":"b"}', '{"ticket_id":"a","a/b":1}', '{"~":1}']
    calls = [json.dumps({"jsonrpc": "2.0", "method": "x", "params": json.loads(v), "id": 1}) for v in values]
    frame = spark.createDataFrame(list(enumerate(calls)), "i int, c string").withColumn("f", F.get(jsontext.read_calls(F.array("c")), 0)["facts"]).cache()
    for method, rule in DEFAULT.params.items():
        assert schema.is_native(rule)
        got = {r["i"]: r["v"] for r in frame.select("i", schema.native(rule, F.col("f")).alias("v")).collect()}
        assert got == {i: Validator(rule).is_valid(json.loads(v)) for i, v in enumerate(values)}, method


def test_validate_column(spark):
    frame = spark.createDataFrame([("1",), ("2.0",), ('"a"',), ("1 x",), (None,), ("",), ("NaN",), ("[" * 5000,)], "t string")
    assert [r[0] for r in frame.select(schema.validate(F.col("t"), {"type": "integer"})).collect()] == [True, True, False, False, False, False, False, False]
    with pytest.raises(Exception):
        Validator("no schema").is_valid(1)
