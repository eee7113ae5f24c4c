from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tramaspark.llm import partial_dates
from tramaspark.llm import persons as P
from tramaspark.llm import variants as V


@pytest.mark.parametrize(
    "typed, given_words, family",
    [
        ("PÉREZ GÓMEZ, Juan C.", ("juan", "c"), ("perez", "gomez")), ("Sra. Ana Pérez Gómez de López", ("ana",), ("perez", "gomez")), ('José "Pepe" Díaz', ("jose",), ("diaz",)), ("Pepe Díaz", ("jose",), ("diaz",)),
        ("G. Díaz", ("g",), ("diaz",)), ("Díaz Ríos Ana", ("ana",), ("diaz", "rios")), ("Ml. Díaz", ("manuel",), ("diaz",)), ("Anamaría Díaz", ("ana", "maria"), ("diaz",)),
        ("Ramos, Juan", ("juan",), ("ramos",)), ("Juan Ramos", ("juan",), ("ramos",)), ("Silva Ana", ("ana",), ("silva",)), ("Ana Maria Sosa", ("ana", "maria"), ("sosa",)), ("Juan Martin", ("juan",), ("martin",)),
        ("Juan Vera", ("juan",), ("vera",)), ("Pedro Martinez Fernandez", ("pedro",), ("martinez", "fernandez")),
    ],
)
def test_names_are_read(typed, given_words, family):
    assert P.Name(given_words, family) in P.readings(typed)


@pytest.mark.parametrize(
    "a, b, whole",
    [
        ("Ana Maria Sosa", "Ana Maria Sosa Lima", False), ("Sosa, Ana Maria", "Ana Maria Sosa", True), ("Gomez Micaela", "Micaela Gomez", True), ("Gomez Suarez Micaela", "Micaela Gomez Suarez", True),
        ("Juan Carlos Perez Gomez", "Juan Carlos Alberto Perez Gomez", False), ("Silva Ramos Ana", "Ana Silva Ramos", True), ("Juan Ramos", "Ramos, Juan", True), ("Marin, Jose", "Jose Marin", True), ("Jose Martin", "Martin Jose", True),
        ("Gomez, Micaela Lucrecia", "Micaela Lucrecia Gomez", True), ("Juan C. Silva", "Juan Carlos Silva", False),
    ],
)
def test_variants_are_accepted_and_share_a_block(a, b, whole):
    x, y = (P.from_form(P.parse(t)) for t in (a, b))
    score, got = P.compare(x, y)
    assert score >= 0.9 and got == whole
    assert {k for k, _ in P.block_keys(x)} & {k for k, _ in P.block_keys(y)}


@pytest.mark.parametrize("a, b", [("Juan Ramos", "Ana Ramos"), ("Juan Silva", "Juan Sosa"), ("Juan Alberto Perez", "Juan Antonio Perez"), ("Micaela Gomez", "Lucrecia Gomez")])
def test_other_persons_are_not(a, b):
    assert P.compare(P.from_form(P.parse(a)), P.from_form(P.parse(b)))[0] == 0


def test_unreadable_names():
    assert [P.parse(x) for x in (None, "", "-", "No hay informacion.", "N/N", "123")] == [None] * 6


def test_very_long_names_have_one_reading():
    text = " ".join(f"zor{chr(97 + k % 26)}bal" for k in range(3000))
    assert len(P.readings(text)) == 1 and P.compare(P.from_form(P.parse(text)), P.from_form(P.parse(text)))[1]
    assert all(len(k) < 40 for k, _ in P.block_keys(P.from_form(P.parse("Ana " + "zorbalqt" * 2000))))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("ana juan micaela silva ramos sosa gomez martin vera perez zorba j m".split()), min_size=2, max_size=5))
def test_order_of_given_and_family_words_does_not_matter(words):
    """A name and its inversion with a comma agree in some reading, for every split."""
    for k in range(1, len(words)):
        a = P.from_form(P.parse(", ".join([" ".join(words[k:]), " ".join(words[:k])])))
        assert P.compare(a, a)[1]
        if any(n in P.from_form(P.parse(" ".join(words))) for n in a):
            assert P.compare(a, P.from_form(P.parse(" ".join(words))))[1]


@settings(max_examples=60, deadline=None)
@given(st.dates(date(1900, 1, 1), date(1999, 12, 31)), st.sampled_from(["%d/%m/%Y", "%Y-%m-%d", "%d.%m.%Y", "%d-%m-%Y"]))
def test_dates_are_read_in_any_notation(day, shape):
    assert partial_dates.partial_date(day.strftime(shape)) == (day.year, day.month, day.day)
    assert partial_dates.date_evidence((1976, 2, 3), (1976, 3, 2)) == 0.9


def test_split_blocks_compare_no_pair_twice(monkeypatch):
    rows = lambda letter: [(f"juan|{letter}{k}", "f", P.from_form(f"juan|zorbal{letter}{k}")) for k in range(40)]
    done = []
    monkeypatch.setattr(V, "compare", lambda a, b: done.append(1) or (0.0, False))
    assert not list(V._pairs(V.couples(rows("a"), rows("b")))) and len(done) == 1600
    done.clear()
    assert not list(V._pairs(V.couples(rows("a")))) and len(done) == 780


def test_a_large_group_gives_all_its_pairs(spark, monkeypatch):
    from itertools import combinations

    df = spark.createDataFrame([(f"r:{k}", "Ana Silva Ramos") for k in range(30)] + [("v:1", "Gomez Micaela"), ("v:2", "Micaela Gomez")], "clave string, nombre string")
    want = {*combinations(sorted(f"r:{k}" for k in range(30)), 2), ("v:1", "v:2")}
    monkeypatch.setattr(V, "BLOCK", 7)
    got = [tuple(r) for r in V.linked_pairs(df).collect()]
    assert len(got) == len(want) and set(got) == want
    assert {(r.clave, r.group_key) for r in V.members(df).collect() if r.clave[0] == "v"} and V.members(df).count() == 32


def test_large_blocks_try_only_couples_that_can_be_accepted():
    from itertools import combinations

    given_words = ["juan", "jose", "jorge", "julio", "jesus", "juancho", "juan carlos", "carlos juan", "j", "jarquilo", "pedro jose"]
    family = ["zorbalente", "zorbalante", "zorbaleante", "zorblente", "sorbalente quimeral", "zorbalenet", "zarbilonte", "zrbalente", "zorbalene", "zrobalente"]
    forms = [*(f"{g}|{f}" for g in given_words for f in family), "juan|zorbalente/zorbalente|juan"]
    blocks: dict[str, list] = {}
    for f in forms:
        for key, kind in P.block_keys(P.from_form(f)):
            blocks.setdefault(key, []).append((f, kind, P.from_form(f)))
    tried = [(key, list(V.likely(key, rows))) for key, rows in blocks.items()]
    every = {frozenset((a[0], b[0])) for rows in blocks.values() for a, b in combinations(rows, 2) if P.compare(a[2], b[2])[0]}
    accepted = lambda found: {frozenset(p[:2]) for p in V._pairs(found)}
    assert every == set().union(*(accepted(c) for _, c in tried))
    halves = [V.likely(k, r[::2], r[1::2]) for k, r in blocks.items()] + [V.likely(k, h) for k, r in blocks.items() for h in (r[::2], r[1::2])]
    assert every == set().union(*map(accepted, halves))
    # one block of twenty given names, forty records each: only namesakes are tried
    names = sorted(n for n in P.FAMILIAR if n[0] == "a")
    rows = [(f, "f", P.from_form(f)) for k in range(40) for n in names for f in [f"{n}|zorbalente{'aeiou'[k % 5] * (k // 5)}"]]
    few = sum(1 for _ in V.likely("f:a:srblnt", rows))
    assert few <= len(rows) * 40 and few < len(rows) * (len(rows) - 1) / 2 / 5
