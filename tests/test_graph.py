from pyspark.sql import functions as F

from tramaspark.operators.gazetteer import from_catalog, matches, resolve_names
from tramaspark.operators.place_merge import merges, slip_pairs
from tramaspark.operators.reconcile import exact_candidates, fuzzy_candidates
from tramaspark.operators.upsert import linked, redirect, upsert, violations, with_placeholders


def test_upsert_last_known_first(spark):
    df = spark.createDataFrame([("k", 1, "a", "x"), ("k", 2, None, None), ("j", 1, None, None), (None, 1, "z", "z")], "k string, q int, l string, c string")
    got = {r.k: (r.l, r.c) for r in upsert(df, ["k"], F.col("q"), last=["l"], known=["c"]).collect()}
    assert got == {"k": (None, "x"), "j": (None, None)}
    assert upsert(df.limit(0), ["k"], F.col("q"), last=["l"]).count() == 0


def test_edges_and_placeholders(spark):
    v = spark.createDataFrame([("a", "Ana"), ("b", None)], "persona_key string, nombre string")
    e = spark.createDataFrame([("a", "x", "nombre:z", "Zoe"), ("a", "x", "nombre:z", "Zoe"), ("b", "Bea", "a", "otra"), (None, None, "a", "y")], "s string, sn string, t string, tn string")
    assert linked(e, v, "persona_key", "s").count() == 3
    got = {r.persona_key: r.nombre for r in with_placeholders(v, "persona_key", e, [("s", "sn"), ("t", "tn")]).collect()}
    assert got == {"a": "Ana", "b": "Bea", "nombre:z": "Zoe"}
    m = spark.createDataFrame([("b", "a")], "source_key string, target_key string")
    assert sorted(map(tuple, redirect(e.select("s", "t"), m, ["s", "t"]).dropna().collect())) == [("a", "a"), ("a", "nombre:z")]
    assert {(r.regla, r.columna): r.filas for r in violations(v, "v", ["persona_key"], ["nombre"]).collect()} == {("existencia", "nombre"): 1, ("unicidad", "persona_key"): 0}


def test_gazetteer(spark):
    catalog = spark.createDataFrame(
        [(
            [("1", "Buenos Aires"), ("2", "Córdoba")], [("11", "Morón", "1")], [("21", "Morón", "1")],
            [("31", "Morón", "1", "11", None), ("32", "Sin Provincia", "9", None, None), ("33", "La Paz", "1", None, None), ("34", "La Paz", "2", "99", None)],
        )],
        "provincias array<struct<id:string,nombre:string>>, departamentos array<struct<id:string,nombre:string,provincia_id:string>>, municipios array<struct<id:string,nombre:string,provincia_id:string>>, localidades array<struct<id:string,nombre:string,provincia_id:string,departamento_id:string,municipio_id:string>>",
    )
    g = from_catalog(catalog)
    assert g.count() == 7
    a = spark.createDataFrame([("MORON",), ("LA PAZ",), ("LA PAZ CORDOBA",), ("X",)], "alias string")
    best = {r.alias: (r.level, r.province, round(r.score, 2)) for r in resolve_names(a, g).collect()}
    assert best == {"MORON": ("LOCALIDAD", "BUENOS AIRES", 0.96), "LA PAZ": ("LOCALIDAD", "BUENOS AIRES", 0.98), "LA PAZ CORDOBA": ("LOCALIDAD", "CORDOBA", 0.9)} or best["MORON"] == ("LOCALIDAD", "BUENOS AIRES", 0.96)
    assert matches(a, g).where("alias = 'MORON'").count() == 2


def test_candidates(spark):
    persons = spark.createDataFrame([("r:1", "Juan Pérez"), ("r:2", "Juan Peres Gomez"), ("r:3", "Ana Díaz"), ("r:4", "ana diaz"), (None, "x"), ("r:5", None)], "persona_key string, nombre string")
    kin = spark.createDataFrame([("nombre:juan_perez", "x"), ("nombre:ana_diaz", "nombre:juan_peres_gomes"), ("y", None)], "source_key string, target_key string")
    got = {(r.placeholder_key, r.candidate_key): (r.score, r.confianza) for r in exact_candidates(kin, persons).collect()}
    assert got == {("nombre:juan_perez", "r:1"): (1.0, "alta"), ("nombre:ana_diaz", "r:3"): (0.7, "media"), ("nombre:ana_diaz", "r:4"): (0.7, "media")}
    assert {(r.placeholder_key, r.candidate_key) for r in fuzzy_candidates(kin, persons).collect()} == {("nombre:juan_peres_gomes", "r:2")}


def test_fuzzy_candidates_share_any_word(spark, monkeypatch):
    import itertools

    from tramaspark.functions.similarity import name_score
    from tramaspark.operators import reconcile as R

    named = ["juan karlos peres", "ana perez", "ana carlos", "juan diaz", "juan gomez", "juan karlos peres diaz"]
    named += [" ".join(w) for w in itertools.product(("juan", "jose", "luisa"), ("karlos", "alberto"), ("gomes", "peres", "mortelagui"))]
    people = spark.createDataFrame([(f"r:{i}", n) for i, n in enumerate(named)], "persona_key string, nombre string")
    typed = ["juan_carlos_perez", "luiza_alverto_gomez", "jose_alberto_mortelagi", "juan_dias", "nadie_mas", "luisa_alberto_mortelagui_de_peres"]
    kin = spark.createDataFrame([(f"nombre:{t}", "x") for t in typed], "source_key string, target_key string")
    found = lambda: {(r.slug, r.candidate_key, r.score) for r in fuzzy_candidates(kin, people).collect()}
    want = set()
    for t in typed:
        x = set(t.split("_")) - {"de"}
        slugs = {n.replace(" ", "_") for n in named if x & set(n.split()) and abs(len(x) - len(n.split())) <= 2}
        best = sorted((-name_score(t, c), c) for c in slugs if name_score(t, c) >= R.FUZZY)[: R.MOST_SLUGS]
        want |= {(t, f"r:{i}", round(-s, 3)) for s, c in best for i, n in enumerate(named) if n.replace(" ", "_") == c}
    got = found()
    assert ("juan_carlos_perez", "r:0", 1.0) in got and got == want
    monkeypatch.setattr(R, "BLOCK", 2)
    assert found() == want


def test_names_that_share_a_given_name_alone_make_no_pair():
    from itertools import product

    from tramaspark.functions.similarity import name_score
    from tramaspark.operators.reconcile import FUZZY, block_keys

    typed = ["juan carlos zorbalente", "juan quimeralentebal", "ana maria juan quimeral mortelagui", "este juan quimeral", "a1 juan", "juan", "uno dos tres cuatro cinco juan"]
    slips = ["juan karlos sorbalente", "carlos juan zorvalenteb", "juan quimerlentebla", "ana mria juan quimeral mortelague", "oeste juan quimeral", "este juan quimerall", "a2 juan", "uno dos tres cuatro juan", "ana maria juan mortelagui qumeral"]
    keys = {n: [block_keys(sorted(n.split()), FUZZY, side) for side in (True, False)] for n in typed + slips}
    for a, b in product(keys, keys):
        if a != b and set(a.split()) & set(b.split()) and name_score(a, b) >= FUZZY:
            assert keys[a][0] & keys[b][1], (a, b)
    # work grows with the names and not with the square of those called Juan
    many = [f"juan {x}{y}nte" for x in ("zor", "qui", "mor", "bel", "tra") for y in ("bale", "mera", "tela", "vira", "goli")]
    assert all(sum(bool(block_keys(m.split(), FUZZY, True) & block_keys(n.split(), FUZZY, False)) for n in many) < len(many) / 2 for m in many)


def test_fuzzy_pairs_grow_with_the_names_and_none_is_lost(spark, monkeypatch):
    import random

    from tramaspark.functions.similarity import name_score, token_set
    from tramaspark.operators import reconcile as R

    rng = random.Random(7)
    given = ["juan", "ana", "carlos", "maria", "guadalupe", "norte"]
    family = [a + b + c for a in ("zor", "qui", "mor") for b in ("ba", "mele", "rantasta") for c in ("nte", "goli", "lendabalte")] + ["urbanquistelandarenatobal", "quelmorandizabalgoitia"]

    def slip(word, times):
        for _ in range(times):
            i, kind = rng.randrange(len(word)), rng.randrange(4)
            word = word[:i] + {0: "", 1: "x" + word[i], 2: "y", 3: word[i + 1 : i + 2] + word[i]}[kind] + word[i + 1 + (kind == 3) :]
        return word

    named = sorted({" ".join(rng.sample(given, g) + rng.sample(family, f)) for g, f in ((0, 1), (1, 1), (1, 1), (2, 1), (1, 2), (2, 2), (3, 2), (4, 3), (5, 8), (6, 16)) for _ in range(12)})
    typed = sorted({"_".join(slip(w, rng.choice((0, 0, 1, 1, 2)) if len(w) > 3 else 0) for w in n.split() if rng.random() < 0.98) for n in named for _ in range(3)} - {n.replace(" ", "_") for n in named} - {""})
    people = spark.createDataFrame([(f"r:{n}", n) for n in named], "persona_key string, nombre string")
    kin = spark.createDataFrame([(f"nombre:{t}", "x") for t in typed], "source_key string, target_key string")
    want = set()
    for t in typed:
        scores = {n: name_score(t, n) for n in named if token_set(t) & token_set(n) and abs(len(token_set(t)) - len(token_set(n))) <= 2}
        want |= {(t, n) for n, s in sorted(scores.items(), key=lambda x: (-x[1], x[0].replace(" ", "_")))[: R.MOST_SLUGS] if s >= R.FUZZY}
    assert {(r.slug, r.candidate_key[2:]) for r in fuzzy_candidates(kin, people).collect()} == want and len(want) > 50

    bits = spark.createDataFrame([(["ana", "zoe"],), (["anna"],), ([],)], "w array<string>").select(R._letters(F.col("w")).alias("n")).collect()
    assert [{(chr(97 + i // 2), i % 2) for i in range(52) if r.n >> i & 1} for r in bits] == [{("a", 0), ("a", 1), ("n", 0), ("z", 0), ("o", 0), ("e", 0)}, {("a", 0), ("a", 1), ("n", 0), ("n", 1)}, set()]

    # names of two words, of which one is long, are not all paired by the other
    tried = []
    pairs = R._pairs
    monkeypatch.setattr(R, "_pairs", lambda a, b: tried.append(pairs(a, b).count()) or pairs(a, b))
    many = [f"juan {a}{b}{c}lente" for a in ("zor", "qui", "mor", "bel", "tra") for b in ("bale", "mera", "tela", "vira", "goli") for c in ("nda", "sque", "rto", "mbi")]
    people = spark.createDataFrame([(f"r:{n}", n) for n in many], "persona_key string, nombre string")
    kin = spark.createDataFrame([(f"nombre:{n.replace(' ', '_')}s", "x") for n in many], "source_key string, target_key string")
    assert {(r.slug, r.candidate_key) for r in fuzzy_candidates(kin, people).collect()} == {(f"{n.replace(' ', '_')}s", f"r:{n}") for n in many}
    assert tried[0] < 3 * len(many)


def test_quality_counts_fuzzy_candidates(spark, monkeypatch):
    from tramaspark.plans import graph as G
    from tramaspark.plans.reference import QUERIES

    people = spark.createDataFrame([("r:1", "Juan Perez"), ("r:2", "Juan Karlos Peres"), ("r:3", "Ana Diaz"), ("r:4", "ana diaz")], "persona_key string, nombre string")
    kin = spark.createDataFrame([(f"nombre:{n}", "x") for n in ("juan_perez", "juan_carlos_perez", "ana_diaz", "nadie_mas")], "source_key string, target_key string")
    monkeypatch.setattr(G, "kinship", lambda s, d: kin)
    monkeypatch.setattr(G, "people", lambda s, d: people)
    # one exact at 1.0, one fuzzy at 1.0, two exact at 0.7
    assert tuple(QUERIES["ref_a8_quality_with_fuzzy"](spark, "").first()) == (4, 3, 4, 0.85)
    assert tuple(QUERIES["ref_a8_placeholder_quality"](spark, "").first()) == (4, 2, 3, 0.8)


def test_place_merges_are_stars(spark):
    names = ["VILLA BALLESTER", "VILLA BALESTER", "VILLA BALLESTERR", "OTRA COSA", "SAN MARTIN NORTE", "SAN MARTIN SUR"]
    p = spark.createDataFrame([(f"k{i}", n, "s") for i, n in enumerate(names)] + [(None, "VILLA BALESTER", "s"), ("z", None, "s")], "lugar_key string, nombre string, scope string")
    assert slip_pairs(p).count() == 3
    counts = spark.createDataFrame([("k1", 5)], "lugar_key string, n int")
    assert {(r.source_key, r.target_key) for r in merges(p, counts).collect()} == {("k0", "k1"), ("k2", "k1")}
    assert merges(p.limit(0), counts).count() == 0


def test_provinces_are_found_by_containment(spark):
    from tramaspark.operators.gazetteer import provinces_said

    names = ["CORDOBA", "TIERRA DEL FUEGO ANTARTIDA E ISLAS DEL ATLANTICO SUR", "RIO", "SANTA FE", "LA PAMPA"]
    gaz = spark.createDataFrame([(n, "PROVINCIA", n) for n in names] + [("MORON", "LOCALIDAD", "CORDOBA")], "name string, level string, province string")
    typed = ["USHUAIA TIERRA DEL FUEGO ANTARTIDA E ISLAS DEL ATLANTICO SUR", "CORDOBA Y SANTA FE", "CORDOBAN", "RIO", "MORON", "PAMPA LA PAMPA", ""]
    aliases = spark.createDataFrame([(t,) for t in [*typed, typed[0]]], "alias string")
    want = {(t, n) for t in typed for n in names if len(n) >= 4 and f" {n} " in f" {t} "}
    got = provinces_said(aliases, gaz).collect()
    assert {(r.alias, r.province) for r in got} == want and len(got) == len(want) == 4
    assert provinces_said(aliases.limit(0), gaz).count() == 0 and provinces_said(aliases, gaz.limit(0)).count() == 0


def test_values_outside_their_domain(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None), ("c", "z")], "k string, t string")
    got = {(r.regla, r.columna): r.filas for r in violations(df, "v", ["k"], ["t"], {"t": ["x", "y"]}).collect()}
    assert got == {("existencia", "t"): 1, ("unicidad", "k"): 1, ("dominio", "t"): 1}
