from tramaspark.runtime import lookup


def test_hot_keys_are_bounded_and_nothing_is_lost(spark):
    rows = [("a", k) for k in range(50)] + [("b", k) for k in range(40)] + [("c", k) for k in range(30)] + [("d", 1), (None, 2), ("x", 3)]
    left = spark.createDataFrame(rows, "k string, n int")
    right = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5)], "k string, v int")
    for how in ("left", "inner"):
        want = sorted(map(repr, left.join(right, "k", how).collect()))
        for most in (1, 2, 10):
            assert sorted(map(repr, lookup(left, right, "k", hot_rows=20, how=how, most_hot=most).collect())) == want
        assert sorted(map(repr, lookup(left, right, "k", how=how, rows=len(rows)).collect())) == want
    assert lookup(left.limit(0), right, "k", hot_rows=0).count() == 0
