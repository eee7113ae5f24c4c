import json

import pytest
from pyspark.sql import functions as F

from tramaspark.plans.graph import Options
from tramaspark.plans.load import load, tables

PLACES = ["Castelar, Bs. As.", "Castelarr, Bs. As.", None]


@pytest.fixture
def records(spark, tmp_path):
    d = str(tmp_path / "in")
    spark.sql(
        """select * from values
        (1L, 'Ana', 'Díaz', 'Ana Díaz', 'Fem', 'Liberado/a', '05/02/1976', 'Castelar, Bs. As.', null, null, null, 'Castelarr, Bs. As.', array(named_struct('registro', 2L, 'nombre_completo', 'Luis Paz', 'relacion', 'hermano')),
            array(named_struct('id_ccd', 'c1', 'relacion', 'pario_en', 'fecha', array('1976/05'))), timestamp'2024-01-01'),
        (2L, 'Luis', 'Paz', 'Luis Paz', null, null, null, 'Castelar, Bs. As.', '31/02/1950', 'Chile', null, null, null, null, timestamp'2024-01-01')
        t(registro, nombre, apellido, nombre_completo, Sexo, descripcion_estado, descripcion_fecha_de_secuestro, descripcion_lugar_de_secuestro, descripcion_fecha_nacimiento, `Lugar de nacimiento`, descripcion_fecha_de_asesinato, `Lugar de asesinato`, victimas_relacionadas_red, ccds, actualizado_en)"""
    ).write.parquet(f"{d}/detalles.parquet")
    spark.sql("select 7L id_nietx, 'Eva Paz' nombre_completo, 'abierto' estado, named_struct('ADN', cast(null as string), 'Localización', cast(null as string), 'Restitución', cast(null as string)) restituido, timestamp'2024-01-01' cargado_en").write.parquet(f"{d}/nietxs.parquet")
    spark.sql("select * from values (1L, 7L, 'Rosa Paz', 'madre', null, timestamp'2024-01-01'), (2L, 7L, 'Luis Paz', 'padre', null, timestamp'2024-01-01'), (3L, 7L, ' ', 'padre', 2L, timestamp'2024-01-01') t(relacion_id, id_nietx, nombre_completo_relacion, relacion, id_persona, cargado_en)").write.parquet(f"{d}/relaciones.parquet")
    spark.sql("select 'c1' id_ccd, 'Centro' denominacion, 'Castelar, Bs. As.' ubicacion, '1' zona, '' subzona, '-' area, null jurisdiccion, null emplazamiento_propiedad, -34.5D lat, -58.5D lon, timestamp'2024-01-01' actualizado_en").write.parquet(f"{d}/ccds.parquet")
    return d


def test_a_whole_load(spark, records, tmp_path):
    folder = tmp_path / "fuentes"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps({"personas": [{"persona_key": "registro:1", "nombre": "Ana D."}, {"persona_key": "k:1", "nombre": "Otra"}], "jerarquias": [{"tipo_relacion": "PARTE_DE", "child_key": "x", "parent_key": "y"}]}))
    out = str(tmp_path / "grafo")
    options = Options(use_gazetteer=False, apply_place_merges=True)
    names = load(spark, records, out, options, str(folder))
    assert names == ["alias", "candidatos", "direcciones", "eventos", "fusiones", "informe", "lugares", "parte_de", "personas", "relaciones"]
    read = lambda n: spark.read.parquet(f"{out}/{n}")
    people = {r.persona_key: r for r in read("personas").collect()}
    assert people["registro:1"].nombre == "Ana D." and people["registro:1"].registro == 1 and "k:1" in people
    assert people["nietx:7"].ADN == "SÍ" and people["nietx:7"].adn_imputed and people["nombre:rosa_paz"].nombre == "Rosa Paz"
    assert {(r.source_key, r.tipo, r.target_key) for r in read("relaciones").collect()} == {("nombre:rosa_paz", "MADRE_DE", "nietx:7"), ("nombre:luis_paz", "PADRE_DE", "nietx:7"), ("registro:1", "HERMANX_DE", "registro:2")}
    assert {(r.placeholder_key, r.candidate_key) for r in read("candidatos").collect()} == {("nombre:luis_paz", "registro:2")}
    events = {(r.persona_key, r.tipo_relacion, r.fecha) for r in read("eventos").collect()}
    assert ("registro:1", "PARIO_EN", "1976-05-01") in events and ("registro:1", "SECUESTRADO_EN", "1976-02-05") in events and ("registro:2", "NACIO_EN", "DESCONOCIDA") in events
    (merge,) = read("fusiones").collect()
    assert "castelarr" in merge.source_key and merge.reason == "typo_un_token"
    assert read("eventos").where(F.col("lugar_key") == merge.source_key).count() == 0 and read("lugares").where(F.col("lugar_key") == merge.source_key).count() == 0
    links = {(r.child_key, r.parent_key) for r in read("parte_de").collect()}
    assert ("x", "y") in links and ("lugar:CCD:c1", merge.target_key) in links


def test_switches(spark, records):
    made = tables(spark, records, Options(skip_places=True, skip_candidates=True, skip_report=True, keep_placeholders=False))
    assert sorted(made) == ["personas", "relaciones"]
    assert "nombre:rosa_paz" not in {r.persona_key for r in made["personas"].collect()}
