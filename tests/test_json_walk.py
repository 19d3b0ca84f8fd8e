"""Deep merges of JSON texts: one walk however deep, and what a text keeps."""

import json

import pytest

from tidemark.operators import json_merge
from tidemark.queries import REGISTRY, catalog


def nested(levels, inner, left="{\"k\":", right="}"):
    return left * levels + inner + right * levels


def merged(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i INT, a STRING, b STRING")
    return [r["m"] for r in json_merge.merge_column(df, ["i"], "a", "b", "m").orderBy("i").collect()]


def test_one_round_walks_all_levels(spark, monkeypatch):
    made, real = [], json_merge.scratch_path
    monkeypatch.setattr(json_merge, "scratch_path", lambda *a: made.append(a) or real(*a))
    assert merged(spark, [(nested(n, '{"x":1}'), nested(n, '{"y":2}')) for n in (1, 41, 200)]) == [nested(n, '{"x":1,"y":2}') for n in (1, 41, 200)]
    assert len(made) == 1


def test_the_leaves_of_deep_texts_are_found_in_one_round(spark, monkeypatch):
    made, real = [], json_merge.scratch_path
    monkeypatch.setattr(json_merge, "scratch_path", lambda *a: made.append(a) or real(*a))
    a, b = '{"s":{"t":[1]},"x":1,"z":{"u":{}}}', '{"s":{"t":[1]},"y":null,"z":{"u":{}}}'
    df = spark.createDataFrame([(1, nested(30, a), nested(30, b))], "i INT, a STRING, b STRING")
    found = {(len(r["_path"]), r["_path"][-1], r["_value"]) for r in json_merge.leaves(df, ["i"], "a", "b").collect()}
    assert found == {(31, "s", '{"t":[1]}'), (31, "x", "1"), (31, "y", "null"), (31, "z", '{"u":{}}')}
    assert len(made) == 1


def test_objects_and_lists_nested_deeply(spark):
    a, b = nested(250, '{"x":1}'), nested(250, '{"y":1}')
    lists = [f'{{"a":{nested(250, n, "[", "]")}}}' for n in ("1", "2")]
    got = merged(spark, [(a, b), tuple(lists), (a, lists[0])])
    assert got[0] == nested(250, '{"x":1,"y":1}')
    assert got[1] == f'{{"a":[{nested(249, "1", "[", "]")},{nested(249, "2", "[", "]")}]}}'
    assert got[2] == lists[0][:-1] + "," + a[1:]


def test_values_keep_their_type_and_digits(spark):
    pairs = [
        ('{"a":1,"b":0}', '{"a":true,"b":false}'),
        ('{"a":{"b":1}}', '{"a":{"b":"1"}}'),
        ('{"a":[1,true]}', '{"a":[true,1]}'),
        ('{"a":1.50,"n":12345678901234567890123.25}', '{"b":100.0,"c":1e2,"d":-0e0,"e":1.0e40}'),
        ('{"x":1e2}', '{"x":100}'),
        ('{"x":1e2}', None),
        ('{"q\\"\\\\":"\\u0001\\u001f\\n/","\\u2028ü":1}', '{"😀":"😀","￿":{"😀":1,"￿":2}}'),
    ]
    assert merged(spark, pairs) == [
        '{"a":true,"b":false}',
        '{"a":{"b":"1"}}',
        '{"a":[1,true,true,1]}',
        '{"a":1.5,"b":100,"c":100,"d":0,"e":1.0E40,"n":12345678901234567890123.25}',
        '{"x":100}',
        '{"x":100.0}',
        '{"q\\"\\\\":"\\u0001\\u001F\\n/"," ü":1,"￿":{"😀":1,"￿":2},"😀":"😀"}',
    ]


def test_what_is_no_json_fails_the_job(spark):
    with pytest.raises(Exception, match="MALFORMED"):
        merged(spark, [("{}", '{"a":1,"a":2}')])
    with pytest.raises(Exception, match="MALFORMED"):
        merged(spark, [("{}", "nul")])
    assert json.loads(merged(spark, [('{"a":1}', ' {"b":2} ')])[0]) == {"a": 1, "b": 2}


@pytest.mark.parametrize("name", ["merged_json_leaves", "merged_json_deep"])
def test_texts_are_made_by_many_tasks(tables, monkeypatch, name):
    seen = []
    for f in ("leaves", "merge_column"):
        monkeypatch.setattr(catalog, f, lambda rows, *a, f=f: seen.append(rows) or getattr(json_merge, f)(rows, *a))
    REGISTRY[name].build(tables)
    assert "REPARTITION_BY_NUM" in seen[0]._jdf.queryExecution().executedPlan().toString()
