import itertools

import numpy as np
import pytest

from tramaspark.llm import canonical as C
from tramaspark.llm import linkage as K
from tramaspark.llm.variants import linked_pairs
from tramaspark.llm import persons as P

REF = [("g1", "Coronel Arabelén", "Partido Quiba", "Costa Brava del Este"), ("g2", "Arabelén", "Partido Toma", "Mesopía"), ("g3", "Villa Dorsal", "Partido Toma", "Mesopía"), ("g4", "Villa Dorsal", "Partido Quiba", "Puna Serena"), ("g5", "Torchequén", None, "Puna Serena")]


@pytest.mark.parametrize(
    "typed, province, want",
    [
        ("CORONEL ARABELÉN", None, "g1"), ("Cnel Arabelen (C. B. del Este)", None, "g1"), ("Villa Dorsal", None, "NO_HALLADO"), ("Villa Dorsal", "PUNA SERENA", "g4"), ("Villa Dorsal, Partido Toma", None, "g3"),
        ("Ciudad de Villa Dorsa1 - Mesop.", None, "g3"), ("Torchequén, extranjero", None, "NO_HALLADO"), ("Torchequén (Ruritania)", None, "NO_HALLADO"), ("Hospital Zonal de Torchequen (ex Km 40)", None, "g5"),
        ("Mesopía", None, "NO_HALLADO"), ("s/d", None, "NO_HALLADO"), ("TorchequÃ©n", "", "g5"), ("V. Dorsal, P. Serena", None, "NO_HALLADO"), ("x" * 20000, None, "NO_HALLADO"),
    ],
)
def test_places(typed, province, want):
    index = C.Index(sorted(REF), C.Weights.of([C.plain_name(r[1]) for r in REF]))
    known = {C.folded(r[3]): C.words(C.folded(r[3])) for r in REF}
    t = C.read(typed, province, known)
    assert C.decide(t, C.candidates(index, t))[0] == want


def invented(n, homonyms=0):
    """A list of n entries of invented names in 24 provinces, the first `homonyms` of one name in as many departments."""
    syllables = [a + b for a in "bcdfgjlmnprstvz" for b in "aeiou"]
    name = lambda k: syllables[k % 75] + syllables[k * 7 % 74] + syllables[k * 13 % 73] + "rn"[k % 2] + "ao"[k // 2 % 2]
    out = [(f"g{k:06}", "San Josebán", f"Departamento {name(k * 31 + 5).title()}", "Cuyania") for k in range(homonyms)]
    return out + [(f"g{k:06}", ("Villa " if k % 5 == 0 else "") + name(k).title(), f"Departamento {name(k % 97)}", f"Provincia {k % 24}") for k in range(homonyms, n)]


def test_cosine_is_exact_and_no_entry_is_missed():
    ref = invented(300)
    w = C.Weights.of([C.plain_name(r[1]) for r in ref])
    index = C.Index(ref, w)
    every = sorted({g for n in index.names for g in C.grams(n)})
    all_grams = [C.grams(n) for n in index.names]
    rows = np.array([[g.get(k, 0) * w.idf[k] for k in every] for g in all_grams])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    for k, a in list(enumerate(index.names))[::7]:
        brute = dict(enumerate(rows @ rows[k]))
        got = {i: s for i, s, _ in index.hits(a)}
        assert set(got) == {i for i, s in brute.items() if s >= C.THRESHOLD}
        assert all(got[i] == pytest.approx(brute[i]) for i in got)


def found_in(ref, typed, block):
    """Ids and scores of typed values with the list in blocks."""
    w = C.Weights.of([C.plain_name(r[1]) for r in ref])
    known = {p: C.words(p) for p in sorted({C.folded(r[3]) for r in ref})}
    reads = [C.read(t, None, known) for t in typed]
    got = [[] for _ in typed]
    for k in range(0, len(ref), block):
        index = C.Index(ref[k : k + block], w)
        for out, t in zip(got, reads, strict=True):
            out += C.candidates(index, t)
    return [C.decide(t, g) for t, g in zip(reads, got, strict=True)]


def test_results_do_not_depend_on_blocks():
    ref = invented(10_000, homonyms=12)
    typed = [r[1] for r in ref[:400:29]] + [f"V. {r[1].split()[-1]}, {r[3]}" for r in ref[20:400:35]] + ["San Joseban", "San Joseban, " + ref[11][2], "nada de esto"]
    whole = found_in(ref, typed, len(ref))
    assert whole == found_in(ref, typed, 3) == found_in(ref, typed, 1700)
    assert whole[-2][0] == "g000011" and whole[-3][0] == whole[-1][0] == "NO_HALLADO"


def test_homonyms_are_told_apart_by_department():
    ref = invented(500, homonyms=12)
    assert [i for i, _ in found_in(ref, [f"San Joseban, {r[2]}" for r in ref[:12]], 7)] == [r[0] for r in ref[:12]]


def test_blocks_of_the_list_give_the_same(spark, monkeypatch):
    values = spark.createDataFrame([("Villa Dorsal", "Mesopía"), ("Villa Dorsal", None), ("Torchequen", None), ("nada", None), ("Villa Dorsal", "Mesopía")], "valor string, provincia string")
    ref = spark.createDataFrame(REF + [(None, "x", None, None)], "georef_id string, localidad string, departamento string, provincia string")
    whole = sorted(map(tuple, C.map_to_reference(values, ref).select("valor", "provincia", "georef_id").collect()))
    monkeypatch.setattr(C, "REFERENCE_BLOCK", 2)
    assert whole == sorted(map(tuple, C.map_to_reference(values, ref).select("valor", "provincia", "georef_id").collect()))
    assert [r[2] for r in whole] == ["g5", "NO_HALLADO", "g3", "NO_HALLADO"] and len(C.map_to_reference(values.limit(0), ref).collect()) == 0
    assert {r.georef_id for r in C.mapped(values, ref.limit(0)).collect()} == {"NO_HALLADO"}


NAMES = {
    "r:1": "Juan Carlos Zorbalente Quimeral", "v:1": "ZORBALENTE QUIMERAL, Juan C.", "n:1": "Juan Carlos Zorvalente-Quimeral", "r:2": "Juan Zorbalente", "r:3": "Ana Zorbalente Quimeral", "v:3": "Anita Zorbalente Quimeral",
    "r:4": "Pedro Zorbalente Quimeral", "r:5": None, "r:6": "", "r:7": "No hay informacion.", "v:7": "No hay informacion.", "r:8": "Juan Alberto Mortelagui", "v:8": "Juan Antonio Mortelagui", "n:8": "Juan Mortelagui",
    "r:9": "Madonna", "v:9": "x" * 9000 + " y",
}


def test_variants_are_linked(spark, monkeypatch):
    df = spark.createDataFrame(list(NAMES.items()), "clave string, nombre string")
    got = {(r.clave_a, r.clave_b) for r in linked_pairs(df).collect()}
    want = set(itertools.combinations(sorted(["r:1", "v:1", "n:1", "r:2"]), 2)) | {("r:3", "v:3")}
    assert got == want
    assert linked_pairs(df.limit(0)).count() == 0


def test_large_blocks_are_split_without_loss(spark, monkeypatch):
    from tramaspark.llm import variants as V

    forms = spark.createDataFrame([(f"{g}|zorbalente{s} quimeral",) for g in ("juan", "jose", "jorge", "julio", "jesus") for s in "abcdefgh"], "form string")
    whole = {(r.form_a, r.form_b) for r in V.name_pairs(forms).collect()}
    monkeypatch.setattr(V, "BLOCK", 7)
    assert {(r.form_a, r.form_b) for r in V.name_pairs(forms).collect()} == whole
    every = [r.form for r in forms.collect()]
    brute = {(a, b) for a, b in itertools.combinations(sorted(every), 2) if P.compare(P.from_form(a), P.from_form(b))[0]}
    assert whole == brute


def test_records_without_keys(spark):
    cols = ["clave", "tabla", "nombre", "nacimiento", "lugar", "secuestro", "lugar_secuestro", "ocupacion", "nota", "anio", "mes", "dia"]
    rows = [
        ("v:1", "v", "Ana Zorbalente Quimeral", "1950-03-04", None, None, None, None, None, None, None, None), ("d:1", "d", "Zorbalente Quimeral, Ana", "04/03/1950", None, None, None, None, None, None, None, None),
        ("d:2", "d", "Zorbalente Quimeral, Ana", "11/09/1931", None, None, None, None, None, None, None, None), ("n:1", "n", "Anita Zorbalente Quimeral", None, None, None, None, None, "x. Nacimiento: 4 de marzo de 1950, Sitio.", 1950, "mar", 4),
        ("v:2", "v", "Luis Mortelagui Sandoral", None, None, None, None, None, None, None, None, None), ("d:3", "d", "Mortelagui Sandoral, Luis", None, None, None, None, None, None, None, None, None),
        ("v:3", "v", None, "1950", None, None, None, None, None, None, None, None), ("v:4", "v", "", None, None, None, None, None, None, None, None, None),
    ]
    schema = ", ".join(f"{c} {'int' if c in ('anio', 'dia') else 'string'}" for c in cols)
    df = spark.createDataFrame(rows, schema)
    got = {(r.clave_a, r.clave_b): r.confianza for r in K.link(df).collect()}
    assert set(got) == {("d:1", "v:1"), ("d:1", "n:1"), ("n:1", "v:1"), ("d:3", "v:2")}
    assert 0 < got["d:3", "v:2"] < got["d:1", "v:1"] <= 1
    assert K.link(df.limit(0)).count() == 0


def test_common_names_keep_their_candidates(spark, monkeypatch):
    cols = ["clave", "tabla", "nombre", "nacimiento", "lugar", "secuestro", "lugar_secuestro", "ocupacion", "nota", "anio", "mes", "dia"]
    row = lambda key, name, born: (key, key[0], name, born, *[None] * 8)
    rows = [row(f"d:{i}", "Zorbalente Quimeral, Juan", f"{1850 + i % 80}-{1 + i % 12:02}") for i in range(K.COMMON + 50)]
    rows += [row("d:x", "Zorbalente Quimeral, Juan", "1950-03"), row("v:1", "Juan Carlos Zorbalente Quimeral", "1950-03")]
    schema = ", ".join(f"{c} {'int' if c in ('anio', 'dia') else 'string'}" for c in cols)
    assert [tuple(r)[:2] for r in K.link(spark.createDataFrame(rows, schema)).collect()] == [("d:x", "v:1")]

    few = [row(f"{t}:{i}", f"{g} Zorbalente {f}", None) for t in "vdn" for i, (g, f) in enumerate(itertools.product(("Juan", "Juan Carlos", "Ana"), ("Quimeral", "Mortelagui", "")))]
    people, _ = K.stored(K.described(spark.createDataFrame(few, schema)))
    edges = lambda: {(r.a, r.b): round(r.weight, 9) for r in K.candidate_edges(people).collect()}
    whole = edges()
    monkeypatch.setattr(K, "COMMON", 2)
    assert edges() == whole
    held = {r.clave: K.keys(K._loaded(r.datos)) for r in people.collect()}
    assert set(whole) == {(a, b) for a in held for b in held if a[0] < b[0] and held[a] & held[b]}


def test_names_join_until_none_moves(spark):
    from tramaspark.llm.variants import clusters

    together = ["manuel nicolas|zorbalente quimeral", "manuel nicolas|zorbalente", "manuel|zorbalente quimeral"]
    apart = ["juan alberto|mortelagui", "juan antonio|mortelagui", "juan|mortelagui"]
    got = {r.form: r.group_key for r in clusters(spark.createDataFrame([(f,) for f in together + apart], "form string")).collect()}
    assert len({got[f] for f in together}) == 1 and len({got[f] for f in apart}) == 3
    assert len(got) == 6


def test_long_names_join_fuller_ones(spark):
    from tramaspark.llm.variants import clusters

    together = ["juan alberto raul|zorbalente quimeral", "juan alberto|zorbalente quimeral", "juan alberto raul|zorbalente"]
    got = clusters(spark.createDataFrame([(f,) for f in together], "form string")).collect()
    assert {r.form for r in got} == set(together) and len({r.group_key for r in got}) == 1


def test_a_slip_in_the_first_family_name_keeps_the_candidate(spark):
    cols = ["clave", "tabla", "nombre", "nacimiento", "lugar", "secuestro", "lugar_secuestro", "ocupacion", "nota", "anio", "mes", "dia"]
    row = lambda key, name, born=None, taken=None: (key, key[0], name, born, None, taken, *[None] * 6)
    rows = [
        row("d:1", "Oscar Ramon Bonrexona Hurtobrasco"), row("v:1", "Oscar Ramon Borexona Hurtobrasco"), row("d:2", "Ignacio Juan Jargoldueta", "1930-07-20"), row("v:2", "Ignacio Juan Jaroldueta", "1930"),
        row("d:3", "Ana Silva Ramos", "1950-03-04", "1977-05-06"), row("v:3", "Ana Silva Ramos", "1950-03-04", "1977-05-06"), row("v:4", "Ana Silva Ramos", "04/03/1950"), row("d:5", "Juan Sosa", "1950-03-04"), row("v:5", "Sosa Juan", "1950-03-04"),
    ]
    schema = ", ".join(f"{c} {'int' if c in ('anio', 'dia') else 'string'}" for c in cols)
    got = {(r.clave_a, r.clave_b) for r in K.link(spark.createDataFrame(rows, schema)).collect()}
    assert got == {("d:1", "v:1"), ("d:2", "v:2"), ("d:3", "v:3"), ("d:3", "v:4"), ("d:5", "v:5")}


def test_pairs_are_stored_as_numbers(spark, monkeypatch):
    """Records' keys come back at the end, whatever they look like; what is kept for each pair meanwhile has none."""
    cols = ["clave", "tabla", "nombre", "nacimiento", "lugar", "secuestro", "lugar_secuestro", "ocupacion", "nota", "anio", "mes", "dia"]
    long = "x" * 500
    rows = [(f"{t}:{long}{i}", t, name, None, *[None] * 8) for t in "zvd" for i, name in enumerate(("Ana Zorbalente Quimeral", "Luis Mortelagui Sandoral"))]
    schema = ", ".join(f"{c} {'int' if c in ('anio', 'dia') else 'string'}" for c in cols)
    kinds = []
    kept = K.stored
    monkeypatch.setattr(K, "stored", lambda df: kinds.append(dict(df.dtypes)) or kept(df))
    got = [tuple(r)[:2] for r in K.link(spark.createDataFrame(rows, schema)).collect()]
    assert sorted(got) == sorted((f"{a}:{long}{i}", f"{b}:{long}{i}") for i in (0, 1) for a, b in itertools.combinations("dvz", 2))
    assert all(k["a"] == k["b"] == "bigint" for k in kinds if "a" in k) and sum("key" in k for k in kinds) == 2
    assert all(k["key"] == "bigint" for k in kinds if "key" in k)
