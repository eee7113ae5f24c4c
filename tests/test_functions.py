import difflib
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tramaspark.functions import dates, kin, names, places, similarity, text
from tramaspark.operators.resolve import resolve_places


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(make(F.col("v"))).collect()[0][0]


@pytest.mark.parametrize(
    "make, value, want",
    [
        (text.norm_space, " a \t b ", "a b"), (text.norm_space, None, None), (text.slug, "José Ñandú-2", "jose_nandu_2"), (text.clean_text, "  -  ", None), (text.clean_text, "No hay informacion.", None),
        (text.clean_text, "No hay información.", None), (text.name_key, "Ana Díaz", "nombre:ana_diaz"), (dates.iso_from_dmy, "31/02/1976", None), (dates.iso_from_dmy, "05/02/1976", "1976-02-05"),
        (dates.iso_from_dmy, "5/2/1976", None), (dates.iso_from_long, "5 de setiembre, 1976", "1976-09-05"), (dates.iso_from_long, "31 de abril, 1976", None), (dates.to_float, "x", None), (dates.first_int, "a 12 b 3", 12),
        (kin.relation_kind, "Abuela  Materna", "ABUELA_MATERNA"), (kin.relation_kind, None, "OTRA"), (places.institution_town, "COMISARIA 1 DE SAN MARTIN", "SAN MARTIN"), (places.without_province, "CASTELAR BS AS", "CASTELAR"),
        (places.province_said, "ROSARIO SANTA FE", "SANTA FE"), (places.repeated_tail, "EN LA CALLE MORON MORON", "MORON"), (places.without_caba, "BARRIO DE FLORES CAPITAL FEDERAL", "BARRIO FLORES"),
    ],
)
def test_scalars(spark, make, value, want):
    assert one(spark, value, make) == want


def test_partial_and_earliest(spark):
    assert tuple(one(spark, "1976/02", dates.partial)) == ("1976-02-01", "1976-02-29", "MONTH")
    assert tuple(one(spark, "0000", dates.partial)) == (None, None, None)
    assert one(spark, ["1977", "1976/05"], dates.earliest, "array<string>") == "1976-05-01"
    assert one(spark, ["invierno", None, " ", "1976?"], dates.earliest, "array<string>") == "invierno | 1976?"
    assert one(spark, [], dates.earliest, "array<string>") is None


def test_address_and_kin(spark):
    a = one(spark, "Av. Corrientes 1234, Capital", places.street_address)
    assert (a.direccion_norm, a.via, a.numero, a.confianza) == ("AV. CORRIENTES 1234", None, "1234", 0.85)
    assert tuple(one(spark, " Madre", kin.edge_type)) == ("MADRE_DE", True)
    assert one(spark, "cónyuge", kin.edge_type) is None
    assert one(spark, "cónyuge", lambda c: kin.edge_type(c, True)).tipo == "PAREJA_DE"


def test_resolution_by_the_rules(spark):
    want = {
        "Capital Federal": "lugar:CIUDAD:ciudad_autonoma_de_buenos_aires", "Asunción, Paraguay": "lugar:CIUDAD:asuncion|lugar:PAIS:paraguay",
        "Castelar, Bs. As.": "lugar:CIUDAD:castelar|lugar:PROVINCIA:buenos_aires|lugar:PAIS:argentina", "Comisaria 1 de San Martin": "lugar:CIUDAD:san_martin|lugar:PROVINCIA:buenos_aires|lugar:PAIS:argentina",
        "Se desconoce (Cafe X y Y)": "lugar:CIUDAD:cafe_x_y_y|lugar:PROVINCIA:buenos_aires|lugar:PAIS:argentina", "Chile": "lugar:PAIS:chile",
    }
    raw = spark.createDataFrame([(v,) for v in [*want, "Av. Corrientes 1234", "Se desconoce", None, "", "-"]], "v string")
    assert {r.raw: r.lugar_key for r in resolve_places(raw, None).collect()} == want
    assert resolve_places(raw.limit(0), None).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdeé ñ12", max_size=12), st.text(alphabet="abcdeé ñ12", max_size=12))
def test_similarities_are_bounded_and_symmetric(a, b):
    assert similarity.name_score(a, b) == pytest.approx(similarity.name_score(b, a), abs=0.35)
    assert 0 <= similarity.name_score(a, b) <= 1
    assert names.jaro_winkler(a, b) == pytest.approx(names.jaro_winkler(b, a), abs=0.1)
    assert names.osa(a, b, 99) == names.osa(b, a, 99)
    assert names.folded(names.folded(a)) == names.folded(a)


def test_name_scores():
    assert similarity.name_score("juan perez", "juan peres") == 1.0
    assert similarity.name_score("barrio norte", "barrio sur") == 0.0
    assert similarity.merge_verdict("VILLA BALLESTER", "VILLA BALESTER")[2] == "typo_un_token"
    assert similarity.merge_verdict("VILLA BALLESTER", "VILLA BALESTER")[1] == pytest.approx(difflib.SequenceMatcher(None, "VILLA BALLESTER", "VILLA BALESTER").ratio())
    assert similarity.merge_verdict("SAN MARTIN NORTE", "SAN MARTIN SUR")[2] == "direccion_conflictiva"


def test_strip_accents_against_unicode(spark):
    values = ["Ñandú ª º ü Ç ø ﬁ ½", "São João", "Ångström", None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(text.strip_accents(F.col("v"))).collect()]
    assert got == [v and "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)) for v in values]


def test_places_abroad_and_addresses(spark):
    typed = ["SANTIAGO DE CHILE", "CHILE", "VALDIVIA CHILE", "DE CHILE", "A B C D E F G CHILE", "CABA CHILE", "CORDOBA", "PARIS FRANCIA"]
    df = spark.createDataFrame([(t,) for t in typed], "t string").select("t", places.abroad(F.col("t")).alias("x"))
    got = {r.t: tuple(r.x) if r.x else None for r in df.collect()}
    assert got == {
        "SANTIAGO DE CHILE": ("SANTIAGO", "CHILE", "CL"), "CHILE": (None, "CHILE", "CL"), "VALDIVIA CHILE": ("VALDIVIA", "CHILE", "CL"), "DE CHILE": None, "A B C D E F G CHILE": None, "CABA CHILE": None,
        "CORDOBA": None, "PARIS FRANCIA": ("PARIS", "FRANCIA", "FR"),
    }
    raw = ["Calle Sarmiento 123, Castelar", "En la vía pública Rivadavia y Medrano", "Comisaría 1 de Morón", "Se desconoce", "Rivadavia 4500", None, "", "12"]
    df = spark.createDataFrame([(t,) for t in raw], "t string").select("t", places.street_address(F.col("t")).alias("x"))
    got = {r.t: (r.x.direccion_norm, r.x.via, r.x.numero, r.x.confianza) if r.x else None for r in df.collect()}
    assert got["Calle Sarmiento 123, Castelar"] == ("CALLE SARMIENTO 123", "CALLE", "123", 0.95) and got["Rivadavia 4500"] == ("RIVADAVIA 4500", None, "4500", 0.85)
    assert got["En la vía pública Rivadavia y Medrano"][3] == 0.65
    assert [got[t] for t in ("Comisaría 1 de Morón", "Se desconoce", None, "", "12")] == [None] * 5
