import random

from pyspark.sql import functions as F

from tramaspark.llm.groups import components


def brute(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        for x in (a, b):
            if x:
                find(x)
        if a and b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {v: find(v) for v in parent}


def run(spark, pairs, **options):
    df = spark.createDataFrame(pairs, "a string, b string")
    return {r.record_key: r.group_key for r in components(df, F.col("a"), F.col("b"), **options).collect()}


def test_random_graphs_on_a_grid(spark):
    r = random.Random(5)
    pairs = [(f"v{r.randrange(400):03}", f"v{r.randrange(400):03}") for _ in range(250)]
    pairs += [(b, a) for a, b in pairs[:40]] + pairs[:40] + [(f"chain{i:03}", f"chain{i + 1:03}") for i in range(120)]
    pairs += [("hub", f"leaf{i}") for i in range(150)] + [(None, "alone"), ("", "bare"), ("solo", None), (None, None), ("x", "x"), ("é", "z")]
    assert run(spark, pairs, edges_per_cell=40) == brute(pairs)


def test_no_pairs(spark):
    assert run(spark, []) == {}
    assert run(spark, [(None, "a"), ("", None)]) == {"a": "a"}


def test_other_columns_do_not_matter(spark):
    df = spark.createDataFrame([("a", "b", 1, "x")], "placeholder_key string, candidate_key string, rep int, row string")
    assert components(df, F.col("placeholder_key"), F.col("candidate_key")).columns == ["record_key", "group_key"]
