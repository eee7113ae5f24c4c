import json

from tramaspark.operators.latest import latest
from tramaspark.operators.nested import flatten, parse_json_column


def rows(tables):
    return {name: sorted(tuple(r) for r in t.select("k", "sk", "parent_sk", "ordinal").collect()) for name, t in tables.items()}


def test_typed_arrays_keep_positions(spark):
    df = spark.createDataFrame(
        [(1, [("a", ["x", None, " ", "y"]), None, ("b", None)]), (2, []), (3, None)], "k int, l array<struct<n:string,d:array<string>>>"
    )
    got = rows(flatten(df, "k", "l"))
    assert got["l"] == [(1, "0", None, 0), (1, "2", None, 2)]
    assert got["l.d"] == [(1, "0.0", "0", 0), (1, "0.3", "0", 3)]


def test_clashing_field_names(spark):
    df = spark.createDataFrame([(1, [(5, "x", 7)])], "k int, l array<struct<k:int,sk:string,ordinal:int>>")
    assert flatten(df, "k", "l")["l"].columns == ["k", "sk", "parent_sk", "ordinal", "k_", "sk_", "ordinal_"]


def test_uneven_json(spark):
    texts = {
        1: [{"n": "a", "v": [{"d": ["p", None, ""]}, None, {"d": "q, ,r"}]}],
        2: {"n": "lone", "v": {"d": []}},
        3: None,
        5: [None, {"otro": 1, "v": None}],
    }
    data = [(k, None if v is None and k == 3 else json.dumps(v)) for k, v in texts.items()] + [(4, ""), (6, "{broken"), (7, "null"), (8, " ")]
    df = parse_json_column(spark.createDataFrame(data, "k int, j string"), "j", "l", frozenset({"d"}))
    got = rows(flatten(df, "k", "l"))
    assert got["l"] == [(1, "0", None, 0), (2, "0", None, 0), (5, "1", None, 1)]
    assert got["l.v"] == [(1, "0.0", "0", 0), (1, "0.2", "0", 2), (2, "0.0", "0", 0)]
    assert got["l.v.d"] == [(1, "0.0.0", "0.0", 0), (1, "0.2.0", "0.2", 0), (1, "0.2.2", "0.2", 2)]


def test_no_json_at_all(spark):
    df = parse_json_column(spark.createDataFrame([(1, None)], "k int, j string"), "j", "l")
    assert all(t.count() == 0 for t in flatten(df, "k", "l").values())


def test_latest_ties_nulls_and_empty(spark):
    schema = "id long, ts timestamp, v string, m map<string,string>"
    df = spark.sql("select * from values (1L, timestamp'2020-01-01', 'old', map('a','b')), (1L, timestamp'2021-01-01', 'new', null), (2L, null, 'only', null), (null, timestamp'2021-01-01', 'x', null), (1L, timestamp'2021-01-01', 'new', null) t(id, ts, v, m)")
    assert sorted((r.id, r.v) for r in latest(df, "id", "ts", ["v", "m"]).collect()) == [(1, "new"), (2, "only")]
    assert latest(spark.createDataFrame([], schema), "id", "ts", ["v"]).count() == 0
