import random

import pytest
from pyspark.sql import functions as F

from tramaspark.operators.hierarchy import descendants, hierarchy, paths


def brute(parent):
    out = {}
    for v in parent:
        seen, at = [], v
        while at not in seen and parent[at] is not None:
            seen.append(at)
            at = parent[at]
        if parent[at] is None:
            out[v] = (at, len(seen))
        else:
            ring = seen[seen.index(at) :]
            out[v] = (min(ring), -1 if v in ring else -2)
    return out


def frame(spark, parent):
    rows = [(v, p, 2) for v, p in parent.items() if p is not None] + [(v, "zz", 1) for v, p in parent.items() if p is not None][:3]
    return spark.createDataFrame(rows, "child string, parent string, ts int").withColumn("ts", F.timestamp_seconds("ts"))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_forest_with_circles(spark, seed):
    r = random.Random(seed)
    names = [f"n{i:03}" for i in range(150)]
    parent = {v: (r.choice(names[:i]) if i > 3 else None) for i, v in enumerate(names)}
    for i in range(120, 126):
        parent[names[i]] = names[i + 1]
    parent[names[126]] = names[120]
    parent["self"] = "self"
    parent["below"] = "self"
    parent["zz"] = None
    nodes, cyclic = hierarchy(frame(spark, parent), "child", "parent", "ts")
    got = {x.node: (x.root_key, x.depth) for x in nodes.select("node", "root_key", "depth").unionByName(cyclic).collect()}
    want = brute(parent)
    linked = {v for v, p in parent.items() if p is not None} | {p for p in parent.values() if p}
    assert got == {v: want[v] for v in linked | {"zz"}}
    full = {x.node: x for x in paths(nodes, "/", length=3).collect()}
    light, _ = hierarchy(frame(spark, parent), "child", "parent", "ts", intervals=False)
    assert {(x.node, x.root_key, x.depth, x.size) for x in light.collect()} == {(x.node, x.root_key, x.depth, x.size) for x in full.values()}
    for v, row in full.items():
        chain, at = [v], v
        while parent[at] is not None:
            at = parent[at]
            chain.append(at)
        assert row.path == "/".join(reversed(chain))
        under = {u for u, y in full.items() if y.root_key == row.root_key and row.pre < y.pre < row.pre + row.size}
        assert under == {u for u, y in full.items() if v in y.path.split("/")[:-1]}
    some = spark.createDataFrame([("n000",), ("n001",)], "node string")
    down = descendants(nodes, some).groupBy("ancestor").count().collect()
    assert {x[0]: x[1] for x in down} == {v: full[v].size - 1 for v in ("n000", "n001") if v in full and full[v].size > 1}


def test_chain_and_star(spark):
    parent = {f"c{i:03}": f"c{i - 1:03}" if i else None for i in range(90)} | {f"s{i}": "c000" for i in range(200)}
    nodes, cyclic = hierarchy(frame(spark, parent), "child", "parent", "ts")
    assert cyclic.count() == 0
    assert nodes.agg(F.max("depth")).collect()[0][0] == 89
    assert nodes.where("node = 'c000'").select("size").collect()[0][0] == 290
    assert nodes.where("root_key = 'c000'").agg(F.countDistinct("pre"), F.max("pre")).collect()[0] == (290, 289)


def test_empty_and_null_keys(spark):
    schema = "child string, parent string, ts timestamp"
    nodes, cyclic = hierarchy(spark.createDataFrame([], schema), "child", "parent", "ts")
    assert nodes.count() == cyclic.count() == 0
    odd = spark.sql("select * from values (cast(null as string), 'p', timestamp'2020-01-01'), ('', 'q', null), ('a', '', null), ('b', null, null) t(child, parent, ts)")
    nodes, _ = hierarchy(odd, "child", "parent", "ts")
    assert sorted(r.node for r in nodes.collect()) == ["a", "b", "p", "q"]


def test_long_chain_in_segments(spark):
    parent = {f"c{i:04}": f"c{i - 1:04}" if i else None for i in range(2500)}
    nodes, _ = hierarchy(frame(spark, parent).where("parent <> 'zz'"), "child", "parent", "ts")
    got = {x.node: x.path for x in paths(nodes, "/").where("node in ('c0000', 'c1023', 'c1024', 'c2499')").collect()}
    assert all(p == "/".join(f"c{i:04}" for i in range(int(v[1:]) + 1)) for v, p in got.items()) and len(got) == 4
