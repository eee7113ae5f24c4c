import random
from collections import defaultdict

from tramaspark.llm.packing import Bins, fill_report, pack
from tramaspark.llm.tokens import encoding, token_counts

SCHEMA = "doc_id long, source string, cluster long, n_tokens long"


def check(spark, rows, kinds, **options):
    counts = spark.createDataFrame(rows, SCHEMA)
    containers = spark.createDataFrame(kinds, "contenedor string, capacidad_tokens int")
    out = pack(counts, containers, **options)
    got = out.collect()
    size = {k: c for k, c in kinds if k and c and c > 0}
    cluster = {r[0]: r[2] for r in rows}
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.contenedor, r.doc_id].append((r.trozo, r.desde, r.n_tokens))
        bins[r.contenedor, r.caja].append((r.doc_id, r.n_tokens))
    for kind, room in size.items():
        for doc, _, _, n in rows:
            parts = sorted(pieces[kind, doc])
            assert sum(p[2] for p in parts) == (n or 0)
            assert len(parts) == -(-(n or 0) // room)
            assert all(p[1] == p[0] * room for p in parts)
    for (kind, _), items in bins.items():
        assert sum(n for _, n in items) <= size[kind]
        seen = [cluster[d] for d, _ in items]
        assert len(seen) == len(set(seen))
    return out, bins


def test_every_token_once_and_tight(spark):
    r = random.Random(4)
    rows = [(i, r.choice(["a", "b", None]), i, int(r.expovariate(1 / 300)) + 1) for i in range(3000)]
    out, bins = check(spark, rows, [("s", 512), ("m", 2048), (None, 5), ("zero", 0)], per_shard=400)
    report = {x.contenedor: x.llenado for x in fill_report(out, spark.createDataFrame([("s", 512), ("m", 2048)], "contenedor string, capacidad_tokens int")).collect()}
    assert report["s"] > 0.98 and report["m"] > 0.98


def test_copies_are_kept_apart(spark):
    rows = [(i, "a", 7, 10) for i in range(200)] + [(1000 + i, "b", 1000 + i, 30) for i in range(100)] + [(5000, None, 1, None), (5001, None, 2, 0)]
    _, bins = check(spark, rows, [("k", 100)], per_shard=50)
    assert len(bins) == 200


def test_exact_capacity_and_empty(spark):
    _, bins = check(spark, [(1, "a", 1, 100), (2, "a", 2, 250)], [("k", 100)])
    assert len(bins) == 4
    check(spark, [], [("k", 100)])
    check(spark, [(1, "a", 1, 3)], [])


def test_the_tightest_compatible_bin():
    b = Bins(10)
    assert [b.place(6, 1, 1), b.place(7, 1, 2)] == [0, 1]
    assert b.place(3, 1, 2) == 0  # bin 1 would be tighter but holds the cluster
    assert b.place(3, 1, 4) == 1
    assert b.place(2, 1, 0) == 2


def test_counts_are_the_tokenizers(spark):
    texts = [None, "", "hola mundo", "a" * 5000, "ñ€" * 300, "dos\n\nlíneas"]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)] + [(None, "x", "s", 1)], "doc_id long, text string, source string, n_tokens int")
    e = encoding("/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
    got = {r.doc_id: r.n_tokens for r in token_counts(df).collect()}
    assert got == {i: len(e.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)}
    assert e.decode(e.encode_ordinary(texts[5])) == texts[5]
