import pytest
from pyspark.sql import functions as F

from corpusloom.operators import repair, rules


def test_rules_as_data(spark):
    text = '[{"name": "b", "column": "n", "op": "more", "value": 3, "confidence": 0.99}, {"name": "a", "column": "t", "op": "matches", "value": "^x", "confidence": 0.5}, {"name": "g", "column": "t", "op": "empty", "guard": true}]'
    df = spark.createDataFrame([(1, 5, "xy"), (2, 5, " "), (3, 1, "xy"), (4, None, None), (5, 5, "q")], "i int, n int, t string")
    r = {x.i: x for x in rules.judged(df, rules.load_rules(text)).collect()}
    assert [(r[i].reasons, r[i].guards, r[i].confidence, r[i].excluded) for i in range(1, 6)] == [(["a", "b"], [], 0.99, True), (["b"], ["g"], 0.99, False), (["a"], [], 0.5, False), ([], ["g"], 0.0, False), (["b"], [], 0.99, True)]
    assert rules.load_rules("") == [] and rules.load_rules(None) == []
    none = rules.judged(df, []).collect()
    assert all(x.reasons == [] and not x.excluded for x in none)
    with pytest.raises(ValueError):
        rules.load_rules('[{"name": "x", "column": "n", "op": "unknown"}]')


def test_cascade_and_first_valid(spark):
    df = spark.createDataFrame([(1, "h", 0, None), (2, "h", 5, "a"), (3, "h", 5, "b"), (4, None, 5, "c"), (5, "k", None, "d")], "i int, h string, n int, t string")
    kind = rules.first_case([("zero", [rules.Rule("", "n", "is", 0)]), ("both", [rules.Rule("", "n", "more", 1), rules.Rule("", "t", "in", ["a", "c"])])], "rest")
    assert [x[0] for x in df.orderBy("i").select(kind).collect()] == ["zero", "both", "rest", "both", "rest"]
    state = rules.first_valid(df, "h", ["i"], F.col("n") > 1)
    assert {x.i: x.state for x in state.collect()} == {1: "invalid", 2: "first", 3: "repeated", 4: "first", 5: "invalid"}
    assert df.select(rules.first_case([], "x")).distinct().count() == 1


def test_overrides(spark):
    rows = spark.createDataFrame([(1, "h", "p"), (2, "x", "p"), (3, None, None)], "i int, host string, platform string")
    site = spark.createDataFrame([("h", 0.95), ("h", 0.5)], "host string, cutoff double")
    family = spark.createDataFrame([("p", 0.1)], "platform string, cutoff double")
    got = rules.overridden(rows, [(site, "host"), (family, "platform")], "cutoff", 0.7, 0.4, 0.9)
    assert {x.i: x.cutoff for x in got.collect()} == {1: 0.9, 2: 0.4, 3: 0.7} and got.columns == ["platform", "host", "i", "cutoff"]


def test_json_errors(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": "x"}',), ("{}",), ("nope",), (None,)], "j string")
    got = df.select(repair.json_errors(F.col("j"), {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer"}}}).alias("e")).collect()
    assert [x.e for x in got] == [[], ["$.a: is no integer"], ["$: lacks 'a'"], ["$: is no JSON"], []]
