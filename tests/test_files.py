"""Readers, writers, parsers, splitting groups and the streaming upsert on small fixtures."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cumload.functions import parsers
from cumload.operators import splitting
from cumload.sources import records, sinks
from cumload.streaming import upserts


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_items_at_any_depth(spark):
    item = lambda i: {"identificador": i, "titulo": "t" + i, "url_html": None}
    tree = {"diario": [{"seccion": [{"nombre": "III. Otras", "departamento": {"nombre": "D", "epigrafe": [{"item": item("a")}, {"item": [item("b"), item("c")]}]}}, {"nombre": "V", "item": item("d")}]}]}
    rows = spark.createDataFrame([(json.dumps(tree),), (None,)], "s string").select(F.inline(records.items("s"))).collect()
    assert [(r.id, r.section, r.department) for r in rows] == [("a", "III. Otras", "D"), ("b", "III. Otras", "D"), ("c", "III. Otras", "D"), ("d", "V", None)]
    assert one(spark, records.section_label(F.lit("III. Otras")))[0] == "III"


def test_xml(spark):
    raw = "<documento><metadatos><identificador>X1</identificador><fecha_publicacion>20240102</fecha_publicacion></metadatos><texto><p>uno <b>dos</b></p><p> </p><p>tres</p></texto></documento>"
    rows = spark.createDataFrame([(raw,), ("<broken",), (None,)], "x string").select(records.xml_document("x").alias("d")).select("d.*").collect()
    assert (rows[0].id, rows[0].published, rows[0].text) == ("X1", dt.date(2024, 1, 2), "uno dos\ntres")
    assert rows[1].id is None and rows[2].text is None


def test_search_records(spark):
    page = {"results": [{"id": "1", "title": "<b>A</b> B", "date": "05/02/2024", "body": "<p>x</p>", "bodyNoHtml": "", "pdf": [{"publicUrl": "u"}]}, {"id": "2", "pdf": []}]}
    r = records.search_records(spark.createDataFrame([(json.dumps(page),)], "value string")).collect()
    assert tuple(r[0]) == ("1", "A B", dt.date(2024, 2, 5), "u", "x") and tuple(r[1]) == ("2", None, None, None, "")


def test_files(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"properties": {"a": "1"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}))
    r = records.features(spark, str(tmp_path / "g.json")).first()
    assert (r.properties, r.kind, json.loads(r.coordinates)) == ({"a": "1"}, "Point", [1, 2])
    (tmp_path / "h.json").write_text(json.dumps({"crs": {"properties": {"name": "other"}}, "features": []}))
    with pytest.raises(Exception, match="unknown coordinate system"):
        records.features(spark, str(tmp_path / "h.json")).collect()
    (tmp_path / "d.csv").write_text("# note\nfamily,source\na,x\na,\n")
    with pytest.raises(ValueError, match="repeated"):
        records.dimension(spark, str(tmp_path / "d.csv"), "family", "source")
    (tmp_path / "t.csv").write_text("a,b\n1,x\n")
    assert records.typed(spark, str(tmp_path / "t.csv"), "a int, b string").collect()[0].a == 1
    (tmp_path / "u.csv").write_text("a,b\none,x\n")
    with pytest.raises(Exception, match="row does not fit"):
        records.typed(spark, str(tmp_path / "u.csv"), "a int, b string").collect()
    (tmp_path / "m.json").write_text('{"11": {"cells": [{"s": "x", "n": 2}]}, "12": {"cells": []}}')
    assert [tuple(r) for r in records.keyed_cells(spark, str(tmp_path / "m.json"), "s: string, n: int").collect()] == [("11", "x", 2)]


def test_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(3), path)
    sinks.replace_table(spark.read.parquet(path).where("id > 0"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2]
    assert sinks.write_once(lambda: spark.range(1), str(tmp_path / "o"), spark) and not sinks.write_once(lambda: spark.range(2), str(tmp_path / "o"), spark)
    manifest = sinks.export_all({"a": spark.range(4), "b": spark.sql("SELECT DATE '2024-01-02' AS day")}, str(tmp_path / "x"), {"b": "day"}).collect()
    assert {(r.name, r.n, r.newest) for r in manifest} == {("a", 4, None), ("b", 1, dt.date(2024, 1, 2))}
    pts = spark.createDataFrame([(1, "ñ", 1.0, 2.0), (2, None, None, None)], "k int, name string, x double, y double").withColumn("g", F.lit("all"))
    got = json.loads(sinks.feature_collection(pts, sinks.point(F.col("x"), F.col("y")), ["name"], "g", "k").first().collection)
    assert [f["geometry"] and f["geometry"]["coordinates"] for f in got["features"]] == [[1.0, 2.0], None] and got["features"][0]["properties"] == {"name": "ñ"}


def test_names(spark):
    words = lambda t: parsers.key_words(F.lit(t))
    r = one(spark, F.array_join(words("planta solar ronda ii de 50 mwp"), " "), parsers.phase_token(words("ronda 2")), parsers.phase_markers(words("guadame ii y set 02")), parsers.phase_token(words("ronda sur")))
    assert tuple(r) == ("ronda ii", "2", ["2", "ii"], None)
    same = lambda a, b: parsers.same_name(F.lit(a), F.lit(b))
    assert tuple(one(spark, same("plantas rey i, rey ii y rey iii", "rey ii"), same("campos y olivares", "campos"), same("50 mw", "50 mw"))) == (True, False, False)
    key = lambda x: parsers.procedure_key(F.lit(x))
    got = one(spark, *[key(x) for x in ("aau/ja/0073/20", "pfot 365 ac", "pfot-12-alm", "peol-fv-252 de", "x/1", None)])
    assert [tuple(x) if x else None for x in got] == [("aau/ja", "73", "20"), ("pfot", "365", "ac"), ("pfot-alm", "12", ""), ("peol-fv", "252", ""), None, None]
    family = lambda a, b: parsers.same_family(F.lit(a), F.lit(b))
    assert tuple(one(spark, family("pfot-alm", "pfot"), family("peol-fv", "pfot"), family("pfot", "peol"))) == (True, True, False)
    lists = F.array(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.array(F.lit("a"), F.lit("b"), F.lit("d")))
    assert tuple(one(spark, parsers.shared_prefix(lists), parsers.distinct_names(F.array(F.lit("B x"), F.lit("b  X"), F.lit("A"))))) == (["a", "b"], ["A", "B x"])
    side = lambda k, m: {"key": key(k), "markers": F.array(*map(F.lit, m)).cast("array<string>"), "storage": F.lit(False)}
    assert tuple(one(spark, parsers.conflict(side("pfot-1", []), side("pfot-2", [])), parsers.conflict(side("x", ["ii"]), side("x", ["iv"])), parsers.conflict(side("x", []), side("x", ["i"])))) == ("expediente", "phase", None)


def test_annex(spark):
    texts = ["a\nAnexo I\nRelación de bienes y derechos\nx", "la relación de bienes y derechos figura", "DNI 12345678Z\nTitular: y", "", None]
    rows = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(parsers.without_annex(F.col("t"))).collect()]
    assert (rows[0].text, rows[0].held_back) == ("a", False) and rows[0].removed_chars == len(texts[0]) - 1
    assert rows[2].text == "DNI 12345678Z" and rows[2].held_back and rows[3].text == "" and rows[4].text is None


def test_periods(spark):
    texts = ["durante el plazo de treinta (30) días hábiles, contados", "recurso de alzada en el plazo de un mes. Abre un plazo de 20 días naturales.", "plazo de dos meses", "sin plazo", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(parsers.period("t").alias("p")).select("p.*").collect()
    assert [(r.amount, r.unit) for r in rows] == [(30, "habiles"), (20, "naturales"), (2, "meses"), (None, None), (None, None)]
    assert rows[0].evidence == "plazo de treinta (30) días hábiles"
    assert [parsers.easter(y) for y in (2024, 2025, 2026)] == [dt.date(2024, 3, 31), dt.date(2025, 4, 20), dt.date(2026, 4, 5)]
    cases = [(dt.date(2024, 3, 27), 1, "habiles"), (dt.date(2024, 1, 31), 1, "meses"), (dt.date(2024, 5, 3), 1, "naturales"), (None, 1, "meses")]
    ends = [r[0] for r in spark.createDataFrame(cases, "d date, n int, u string").coalesce(1).select(parsers.deadline("d", "n", "u")).collect()]
    assert ends == [dt.date(2024, 4, 1), dt.date(2024, 2, 29), dt.date(2024, 5, 6), None]


def test_family_groups(spark):
    d = dt.date
    p = spark.createDataFrame([(1, 30.0, d(2020, 1, 1)), (2, 30.0, d(2021, 1, 1)), (3, 30.0, d(2023, 6, 1)), (4, 60.0, d(2020, 1, 1)), (5, 45.0, d(2020, 1, 1))], "id long, mw_best double, first_seen date")
    fam = spark.createDataFrame([(i, "f") for i in range(1, 6)] + [(1, "g"), (2, "g")], "id long, family string")
    at = spark.createDataFrame([(1, 10), (2, 11), (3, 11), (4, 10), (5, 99)], "id long, place long")
    r = splitting.family_groups(p, fam, at, spark.createDataFrame([(10, 11)], "place long, other long")).collect()
    assert [(x.family, x.project_ids, x.mw_total) for x in r] == [("f", [1, 2], 60.0)]


def test_stream_upsert(spark, tmp_path):
    src, log, schema = str(tmp_path / "in"), str(tmp_path / "log"), "id long, day int, text string"
    run = lambda: upserts.upsert_stream(spark.readStream.schema(schema).parquet(src), log, str(tmp_path / "c"), "id", "day", "text").awaitTermination()
    spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "x"), (None, 1, "n")], schema).coalesce(1).write.parquet(src)
    run()
    spark.createDataFrame([(1, 3, "c"), (2, 5, "x"), (3, 1, None)], schema).coalesce(1).write.mode("append").parquet(src)
    run()
    now = upserts.latest(spark, log, "id")
    assert {(r.id, r.text, r._attempts) for r in now.collect()} == {(1, "c", 2), (2, "x", 1), (3, None, 1)}
    assert spark.read.parquet(log).where("batch = 1").count() == 2
    upserts.apply_batch(spark.createDataFrame([(1, 3, "c"), (3, 1, None)], schema), 1, log, "id", "day", "text")  # a replay
    assert spark.read.parquet(log).count() == 4
    derived = spark.read.parquet(log).where("batch = 0").select("id", "_hash")
    assert [r.id for r in upserts.still_valid(derived, upserts.latest(spark, log, "id"), "id").collect()] == [2]
