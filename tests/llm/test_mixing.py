from tramaspark.llm.mixing import mix, mix_report


def test_shares_caps_and_repeats(spark, monkeypatch):
    counts = spark.createDataFrame([(i, "a" if i % 10 else "b", i, 100) for i in range(4000)] + [(9000, None, 1, 100), (9001, "c", 1, 0)], "doc_id long, source string, cluster long, n_tokens long")
    targets = spark.createDataFrame(
        [("m", "a", 0.5, 1, 0.5), ("m", "b", 0.4, 3, 0.5), ("m", "zz", 0.1, 2, 0.5), ("x", "b", 1.0, 2, 1.0), (None, "a", 1.0, 1, 1.0), ("m", None, 0.1, 1, 0.5)],
        "mezcla_id string, source string, peso double, max_repeticiones int, fraccion_corpus double",
    )
    drawn = mix(counts, targets).collect()
    assert max(r.copias for r in drawn if r.mezcla_id == "m" and r.source == "b") <= 3
    assert all(r.copias == 2 for r in drawn if r.mezcla_id == "x")
    assert {r.source for r in drawn} == {"a", "b"}
    again = mix(counts.repartition(7), targets).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, drawn))
    with monkeypatch.context() as m:
        m.setattr("tramaspark.llm.mixing.MOST_TARGETS", 0)
        assert sorted(map(tuple, mix(counts, targets).collect())) == sorted(map(tuple, drawn))
    got = {(r.mezcla_id, r.source): r for r in mix_report(mix(counts, targets), counts, targets).collect()}
    assert abs(got["m", "a"].obtenido / got["m", "a"].objetivo - 1) < 0.05
    assert abs(got["m", "b"].obtenido / got["m", "b"].objetivo - 1) < 0.05
    assert got["m", "zz"].limitada and got["m", "zz"].obtenido == 0 and got["x", "b"].limitada
    assert sum(r.peso_real for k, r in got.items() if k[0] == "m") == 1.0


def test_empty(spark):
    counts = spark.createDataFrame([], "doc_id long, source string, cluster long, n_tokens long")
    targets = spark.createDataFrame([("m", "a", 1.0, 1, 0.5)], "mezcla_id string, source string, peso double, max_repeticiones int, fraccion_corpus double")
    assert mix(counts, targets).count() == 0
    assert mix_report(mix(counts, targets), counts, targets).count() == 1
    assert mix(counts, targets.limit(0)).count() == 0
