import json

import pytest
from pyspark.sql import functions as F

from tramaspark.functions import html
from tramaspark.sources import files, pages
from tramaspark.streaming.upserts import current, into_table

P = "lesahumanidad-"
VICTIM = f"""<html><script>"</p>"</script><article class="x victima"><h1> Ana <b>Díaz</b></h1><div class="{P}contenedor-img"><img src="/a.jpg"></div>
<div class="{P}ficha-items"><ul><li><strong>Fecha de Nacimiento:</strong> 1950<li><strong>Edad:</strong>  26</li><li>sin</li></ul></div><h4 class="{P}victima-subtitulo">Relato</h4><p>Uno<br>dos</p>
<div class="{P}ccds-de-una-victima"><ul><li><a class="{P}link-ccd" href="/c/1">Centro</a></li></ul></div>
<div class="{P}agrupamiento-tabla-sentencia"><a class="{P}link-sentencia" href="/s/1">Causa 1</a></div><table class="{P}tabla"><tbody><tr><td class="{P}tabla-victimas-sentencias-imputados-campo-imputado"><a class="{P}link-imputado" href="/i/1">Uno</a>
<td class="{P}tabla-victimas-sentencias-imputados-campo-delitos">a, ,b</td></tr></tbody></table></article>"""


def test_victim_pages(spark):
    df = spark.createDataFrame([("u", VICTIM), ("v", "<p>nada"), ("w", None), ("x", "")], "url string, html string")
    (r,) = html.extract(df, html.victim).collect()
    assert (r.source_url, r.nombre, r.imagen_url, r.relato_hechos) == ("u", "Ana Díaz", "/a.jpg", "Unodos")
    assert r.datos_personales == {"fecha_de_nacimiento": "1950", "edad": "26"}
    assert r.sentencias[0].imputados[0].asDict() == {"imputado_nombre": "Uno", "imputado_url": "/i/1", "delitos": ["a", "", "b"]}
    assert r.centros_clandestinos[0].url == "/c/1"


def test_other_pages_and_links(spark):
    s = f"""<article class=sentencia><h1>T</h1><div class="{P}ficha-items-sentencia"><ul><li><strong>Tribunal:</strong> A<br>B</li></ul><a href="x.pdf">pdf</a></div><div class="{P}agrupamiento-tabla-sentencia">Víctima: Luz</div>
    <table class="{P}tabla-sentencias-victimas-imputados"><tbody><tr><td class="{P}tabla-sentencias-victimas-imputados-campo-imputado"><a href="/i">I</a></td><td class="{P}tabla-sentencias-victimas-imputados-campo-delitos">q,,r</td></tr></tbody></table></article>"""
    got = html.sentence(s, "https://h.example/d/1")
    assert got["datos_tecnicos"] == {"tribunal": "A, B", "sentencia_completa_pdf": "x.pdf"}
    assert got["victimas_e_imputados"][0]["imputados"] == [{"imputado_nombre": "I", "imputado_url": "https://h.example/i", "delitos": ["q", "r"]}]
    page = '<div><a href="/v/1"><button class="btn-ver-mas">x</button></a></div><li><a href="/v/2">t</a><button class=btn-ver-mas></button></li><a class="next" href="?p=2">'
    df = spark.createDataFrame([("https://h.example/l", page)], "url string, html string")
    (r,) = html.extract(df, html.list_links).collect()
    assert (r.enlaces, r.siguiente) == (["https://h.example/v/1", "https://h.example/v/2"], "https://h.example/l?p=2")
    assert html.centre(f'<article class="centrodetencion"><div class="{P}ficha-items-ccd"><li><strong>Zona:</strong>1</div></article>', "u")["metadatos"] == {"Zona": "1"}
    assert html.accused(f'<article class=imputado><table class="{P}tabla-imputados-condenas"><tbody><tr><td class="{P}tabla-imputados-condenas-campo-sentencias">S</td><td class="{P}tabla-imputados-condenas-campo-sanciones">5</td></table></article>', "u")["condenas_recibidas"] == [{"sentencia_nombre": "S", "sentencia_url": "", "sancion": "5"}]


def test_direct_sources(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps({"source_id": "b", "personas": [{"persona_key": "k", "nombre": "B"}], "lugares": None}))
    (tmp_path / "a.json").write_text(json.dumps({"personas": [{"persona_key": "k", "nombre": "A"}]}))
    (tmp_path / "ccds.json").write_text("[]")
    tables, read = files.direct_sources(spark, str(tmp_path))
    assert read == ["a.json", "b.json"]
    assert [r.nombre for r in tables["personas"].orderBy("_file", "_pos").collect()] == ["A", "B"]
    assert tables["lugares"].count() == 0 and files.direct_sources(spark, str(tmp_path / "none"))[1] == []
    for bad in ([], {"x": []}, {"personas": {}}, {"personas": ["x"]}):
        (tmp_path / "c.json").write_text(json.dumps(bad))
        with pytest.raises(files.BadSource):
            files.direct_sources(spark, str(tmp_path))


def test_csv_and_json(spark, tmp_path):
    (tmp_path / "s.csv").write_bytes("PROVINCIA;LOCALIDAD;CEM - CCD - EP;LUGAR DE HALLAZGO;HOJA DE REFERENCIA;Lat;Long;Suma de CASOS;a;b;c;d;e\nCórdoba;X;CEM;;;-3,45376E+15;-64.1;3;;;;;\n".encode("latin-1"))
    (r,) = files.sites_csv(spark, str(tmp_path / "s.csv"), "ISO-8859-1").collect()
    assert (r.PROVINCIA, r.Lat, r["Suma de CASOS"]) == ("Córdoba", "-3,45376E+15", 3)
    files.write_records(spark.range(5).coalesce(1), str(tmp_path / "o"))
    assert files.read_records(spark, str(tmp_path / "o"), "id long", lines=True).count() == 5
    files.write_arrays(spark.range(7).repartition(3), str(tmp_path / "p"))
    assert sorted(r.id for r in files.read_records(spark, str(tmp_path / "p"), "id long").collect()) == list(range(7))
    files.write_arrays(spark.range(0), str(tmp_path / "q"))
    assert files.read_records(spark, str(tmp_path / "q"), "id long").count() == 0


def test_lists_are_followed_to_their_details(spark):
    more = lambda *ids: "".join(f'<a class="{P}link-btn-ver-mas" href="/v/{i}">Ver más</a>' for i in ids)
    detail = lambda n: f'<article class="victima"><h1>{n}</h1></article>'
    base = "https://h.example"
    rows = [
        (f"{base}/l?p=1", more(1, 2, 1) + '<a class="next" href="/l?p=2">'), (f"{base}/l?p=2", more(2, 9) + '<a class="next" href="/l?p=1">'), (f"{base}/l?p=3", more(3)),
        (f"{base}/v/1", detail("Uno")), (f"{base}/v/2", detail("Dos")), (f"{base}/v/3", detail("Tres")), (None, None),
    ]
    pages = spark.createDataFrame(rows, "url string, html string")
    start = spark.createDataFrame([(f"{base}/l?p=1",)], "url string")
    assert sorted(r.nombre for r in html.crawl(pages, start, html.victim).collect()) == ["Dos", "Uno"]
    assert html.crawl(pages, start.limit(0), html.victim).count() == 0


def test_paging():
    asked = []

    def get(url):
        asked.append(url)
        start = int(url.split("inicio=")[1].split("&")[0])
        return {"total": 5, "x": [{"id": i} for i in range(start, min(start + 2, 5))]}

    assert [r["id"] for r in pages.pages("http://h", "x", "id", 2, get)] == [0, 1, 2, 3, 4] and len(asked) == 3


def test_stream_upserts(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    rows = lambda *r: spark.createDataFrame([*r], "id long, t string, v string").withColumn("t", F.to_timestamp("t"))
    stream = spark.readStream.schema("id long, t timestamp, v string").option("recursiveFileLookup", True).parquet(str(source))
    batches = [
        rows((1, "2020-01-02", "new"), (None, "2020-01-02", "nobody")), rows((1, "2020-01-01", "old"), (2, "2020-01-01", "other")),
        rows((2, "2019-01-01", "very late"), (3, None, "no time")), rows((1, "2021-01-01", "newest")), rows((1, "2021-01-01", "newest")),
    ]
    for k, one in enumerate(batches):
        one.write.parquet(str(source / str(k)))
        into_table(stream, out, str(tmp_path / "c"), "id", "t", buckets=4).trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.id, r.v) for r in current(spark, out).collect()) == [(1, "newest"), (2, "other"), (3, "no time")]
    kept = [p.parent.parent.name for p in (tmp_path / "out").glob("v=*/bucket=*/*.parquet")]
    assert len(kept) < 8 and current(spark, str(tmp_path / "none")) is None
