"""Rules over texts, files and shapes on small cases."""

import datetime as dt
import json
import struct
import xml.etree.ElementTree as ET

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cumload.functions import coordinates, decisions, shown
from cumload.operators import figures, likeness, overlay, search, selection, shapes, spatial, texts
from cumload.sources import records, sinks
from cumload.streaming import upserts


def values(spark, column, rows, shape="t string"):
    """The column over rows, in order."""
    table = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], f"_i int, {shape}")
    return [r.v for r in table.select("_i", column.alias("v")).orderBy("_i").collect()]


def test_company_keys(spark):
    names = ["Tayant Investment12, S.L.", "Ábaco (grupo) Solar S.A.", "Energía 3i Solar Co", "Enel Green Power España, S.L.", "Solar PV22 S. L. L.", "S.L.", "Uno A.I.E.", "Alfa Sociedad Limitada Unipersonal"]
    assert values(spark, texts.developer_key(F.col("t")), names) == ["tayant-investment-12", "abaco-solar", "energia-3i-solar-co", "enel-green-power-espana", "solar-pv-22", "", "uno", "alfa"]
    assert values(spark, texts.family_key(F.col("t")), ["alfa-seis", "alfa-xii", "alfa-xxxix", "alfa-12", "alfa", "xii", "alfa-solar", "12-i"]) == ["alfa", "alfa", "alfa", "alfa", "alfa", "xii", "alfa-solar", "12"]


def test_last_operative_sentence(spark):
    said = [
        "se formula declaracion de impacto ambiental favorable a la realizacion del proyecto x",
        "formular declaracion de impacto ambiental desfavorable de la linea y establece las condiciones",
        "formula declaracion de impacto ambiental sobre otra cosa",
        "no otorgar la autorizacion ambiental unificada",
        "resuelve no otorgar la autorizacion ambiental unificada",
        "acuerda otorgar autorizacion ambiental unificada. resuelve denegar la autorizacion ambiental unificada",
        "por lo que resuelve: donde dice: se otorga autorizacion ambiental unificada, debe decir: se deniega la autorizacion ambiental unificada",
        "dar publicidad a que se otorga la modificacion de la autorizacion ambiental unificada",
        "resuelve que no es necesario el sometimiento al procedimiento de evaluacion de impacto ambiental ordinaria",
        "resuelve que es necesario el sometimiento al procedimiento de evaluacion de impacto ambiental ordinaria",
        "texto sin decision",
        None,
    ]
    got = [None if v is None else (v.doc_type, v.verdict) for v in values(spark, decisions.operative(F.col("t")), said)]
    yes, no = "favorable_condicionada", "desfavorable"
    assert got == [("dia", yes), ("dia", yes), None, None, ("aau", no), ("aau", no), ("aau", no), ("modificacion", yes), ("informe_impacto", yes), ("informe_impacto", "no_aplica"), None, None]
    title = "acuerdo por el que se deniega autorizacion ambiental unificada"
    rows = [("otro", title, "nada"), ("informacion_publica", title, "nada"), ("dia", "x", said[4]), ("aau", title, said[7])]
    got = values(spark, decisions.decided(F.col("k"), F.col("a"), F.col("b")), rows, "k string, a string, b string")
    assert [None if v is None else (v.doc_type, v.verdict) for v in got] == [("aau", no), None, None, ("modificacion", yes)]


def test_labelled_capacity(spark):
    rows = [("61,2 MWp/51 MWn", ""), ("250 MW pico", ""), ("51 MWnom", ""), ("116,5 MWp y 116,5 MWp", ""), ("Plantas de 10 MWp", ""), ("Filabres, 153 MW, y La Rambla, 100 MWp", ""), ("PSF Uno", "de 109,52 MWp (90,75 MWn)"), ("109,5 MWp", "109,52 MWp (90,75 MWn) y 20 MWp (10 MWn)"), ("x", "1 MWp (2 MWn), 3 MWp (4 MWn)"), ("y", "potencia pico de 199,976 Mwp, una potencia nominal de 160 MW"), (None, None)]
    got = [None if v is None else (v.nominal, v.peak) for v in values(spark, decisions.labelled_capacity(F.col("a"), F.col("b")), rows, "a string, b string")]
    assert got == [(51.0, 61.2), (None, 250.0), (51.0, None), (None, None), None, None, (90.75, 109.52), (90.75, 109.52), (None, None), (160.0, 199.976), (None, None)]
    found = F.struct(F.col("fn").alias("nominal"), F.col("fp").alias("peak"))
    rows = [(None, 109.52, 109.5, None), (51.0, 61.2, 1.0, 2.0), (51.0, None, None, 51.0), (None, None, 3.0, 4.0)]
    got = [tuple(v) for v in values(spark, decisions.with_capacity(found, F.col("n"), F.col("p")), rows, "fn double, fp double, n double, p double")]
    assert got == [(None, 109.52), (51.0, 61.2), (51.0, None), (3.0, 4.0)]


def test_generation_and_names(spark):
    rows = [("parque fotovoltaico retuerta para su hibridacion con el parque eolico existente retuerta de 38 mw", "solar_fv", 10), ("parque eolico filabres y parque solar la rambla", "solar_fv", 3), ("hibridacion solar y eolica", None, 2), ("linea aerea desde parque eolico san cristobal", "otra", 4), ("planta fotovoltaica", "solar_fv", None), (None, "eolica", 5)]
    got = [tuple(v) for v in values(spark, decisions.checked_generation(F.col("a"), F.col("b"), F.col("c")), rows, "a string, b string, c int")]
    assert got == [("solar_fv", None, 1), ("eolica", 3, 1), ("hibrida", 2, 1), ("otra", 4, 0), ("solar_fv", None, 0), ("eolica", 5, 0)]
    names = ["PSF Alba de 50 MW y su infraestructura de evacuación", "Ronda y sus líneas de evacuación", "Planta (12,5 MWp) Sur", "de 5 MW", "Carmona 100 MW", "Carmona 10 MW"]
    assert values(spark, decisions.trimmed_name(F.col("t")), names) == ["PSF Alba", "Ronda", "Planta", "de 5 MW", "Carmona 100", "Carmona 10 MW"]


def test_corrections_find_their_targets(spark):
    day = dt.date
    rows = [
        (1, "boja", "disposition.2023.140.5", day(2023, 7, 24), "resolucion de 19 de julio de 2023, de la delegacion en cadiz, sobre la planta uno", ""),
        (2, "boja", "disposition.2023.141.5", day(2023, 7, 25), "resolucion de 19 de julio de 2023, de la delegacion en huelva, sobre la planta dos", ""),
        (3, "boja", "disposition.2023.150.1", day(2023, 8, 1), "correccion de errores de la resolucion de 19 de julio de 2023, de la delegacion en cadiz, sobre la planta uno (boja num. 140, de 24 de julio de 2023)", ""),
        (4, "boja", "disposition.2023.150.2", day(2023, 8, 1), "correccion de errores de la resolucion de 19 de julio de 2023, de la delegacion", ""),
        (5, "boe", "BOE-B-2023-77", day(2023, 1, 1), "anuncio de la planta", ""),
        (6, "boe", "BOE-B-2023-99", day(2023, 2, 1), "anuncio por el que se corrigen errores", "advertido error en boe-b-2023-77"),
        (7, "boe", "BOE-A-2023-1", day(2022, 12, 30), "resolucion de 22 de diciembre de 2022, de la direccion general, por la que se formula declaracion", ""),
        (8, "boe", "BOE-A-2023-9", day(2023, 4, 10), "resolucion de 3 de abril de 2023, de la direccion general, por la que se corrigen errores en la de 22 de diciembre de 2022, por la que se formula declaracion", ""),
    ]
    table = spark.createDataFrame(rows, "id long, source string, source_id string, published date, title string, text string")
    assert {(r.id, r.target) for r in decisions.correction_targets(table).collect()} == {(3, 1), (6, 5), (8, 7)}


def test_places_by_likeness(spark):
    places = spark.createDataFrame([("alcala de guadaira", "41004"), ("carmona", "41024")], "folded string, place string")
    names = spark.createDataFrame([("carmona",), ("alcala de guadairo",), ("cordoba",)], "folded string")
    assert {(r.folded, r.place) for r in likeness.canonical_places(names, places).collect()} == {("carmona", "41024"), ("alcala de guadairo", "41004")}


def test_small_readers(spark):
    assert values(spark, decisions.first_json_object(F.col("t")), ['so {"a": {"b": 1}} and', "{no} {\"a\":2}", "none", None]) == ['{"a": {"b": 1}}', '{"a":2}', None, None]
    titles = ["Resolución de la Dirección General de Calidad y Evaluación Ambiental, por la que", "Acuerdo de la Delegación Territorial de Sostenibilidad, Medio Ambiente en Sevilla, por el que", "Anuncio"]
    assert values(spark, decisions.authority(F.col("t")), titles) == ["Dirección General de Calidad y Evaluación Ambiental", "Delegación Territorial en Sevilla", None]
    assert values(spark, decisions.gazette_reference(F.col("a"), F.col("b")), [("boe", "BOE-A-1"), ("boja", "disposition.2")], "a string, b string") == ["BOE-A-1", "BOJA disposition.2"]
    assert values(spark, decisions.title_technology(F.col("t")), ["parque eolico", "planta solar y eolica", "huerto fotovoltaico", "linea"]) == ["eolica", "hibrida", "solar_fv", None]
    assert values(spark, decisions.project_numbers(F.col("t")), ["(PP. 0123/2021) y PP 4/2020"]) == [["123/2021", "4/2020"]]
    assert values(spark, decisions.is_generic(F.col("t"), ["planta", "solar"]), ["planta solar 2", "planta ronda"]) == [True, False]
    for kind, a, b, want in (("number", 100.0, 101.0, True), ("number", 100.0, 110.0, False), ("number", None, None, True)):
        assert values(spark, decisions.lenient(kind, F.col("a"), F.col("b")), [(a, b)], "a double, b double") == [want]
    assert values(spark, decisions.lenient("text", F.col("a"), F.col("b")), [("Ábaco, S.L.", "abaco s l"), ("a", None)], "a string, b string") == [True, False]


def test_selection(spark):
    rows = [("informacion publica de la subestacion para evacuacion de energias renovables en cadiz", True), ("informacion publica de la planta solar en cadiz", True), ("informacion publica de la planta solar en soria", True)]
    assert values(spark, selection.is_consultation(F.lit("V"), F.col("a")), rows, "a string, b boolean") == [False, True, False]
    assert values(spark, selection.in_region(F.lit("x"), F.col("t")), ["la delegacion territorial en jaen", "la junta de andalucia"]) == [True, False]
    assert values(spark, selection.assesses(F.lit("x"), F.col("t")), ["exento del tramite de evaluacion de impacto ambiental ordinaria", "evaluacion de impacto ambiental ordinaria"]) == [False, True]
    assert values(spark, selection.is_decision(F.lit("III"), F.lit("ministerio para la transicion ecologica"), F.col("t")), ["impacto ambiental del parque eolico", "impacto ambiental de la presa"]) == [True, False]
    pages = spark.createDataFrame([("q", 0, 50, 120), ("q", 1, 50, 120), ("q", 2, 20, 120), ("q", 3, 50, 120), ("r", 0, 0, 0)], "query string, page int, received int, total int")
    assert {(r.query, r.page) for r in selection.landed_pages(pages).collect()} == {("q", 0), ("q", 1), ("q", 2)}
    years = spark.createDataFrame([(2022, 400.0), (2021, 400.0), (2020, 400.0)], "year int, seconds double")
    assert {r.year for r in selection.coverage_years(years, 900).collect()} == {2022, 2021}


def test_what_is_shown(spark):
    assert values(spark, shown.number(F.col("t"), 1), [1234.56], "t double") == ["1.234,6"]
    assert values(spark, shown.coverage(F.col("a"), F.col("b"), F.col("c")), [(2, 3, 1), (1, 1, 0)], "a int, b int, c int") == ["MW declarados en 2 de 3 proyectos; en 1 se usa la potencia pico", "MW declarados en 1 de 1 proyecto"]
    assert values(spark, shown.long_date(F.col("t")), [dt.date(2019, 8, 8)], "t date") == ["8 de agosto de 2019"]
    assert values(spark, shown.site_name(F.col("t"), {"cardena": "cardeña"}), ["SIERRA DE CARDENA Y MONTORO", "LEBRIJA-LAS CABEZAS", "CANAL II"]) == ["Sierra de Cardeña y Montoro", "Lebrija-Las Cabezas", "Canal II"]
    assert values(spark, shown.protected_area_key(F.col("t")), ["Red Natura 2000 (ZEC Andévalo Occidental)", "Zona Especial de Conservación (ZEC) Andévalo Occidental (ES6150010)", "ZEC y ZEPA Doñana", "Doñana", "ZEC"]) == ["zec:andevalo occidental"] * 2 + ["zec+zepa:donana", "doñana", "zec"]
    assert values(spark, shown.unquoted(F.col("t")), ["«**x y**»"]) == ["x y"]
    assert values(spark, shown.family_label(F.col("t")), [["Alfa Solar Uno", "alfa solar Dos"], ["A", "B"]], "t array<string>") == ["Alfa Solar", None]
    statuses, technologies, metrics = ["a", "b", "c"], ["x", "y"], ["mw", "ha"]
    state = shown.view_state("metrica=ha&estado=a,zz&m=41004&natura=1", statuses, technologies, ["a", "b"], metrics)
    assert state == {"metric": "ha", "statuses": ["a"], "technologies": ["x", "y"], "natura": True, "selected": "41004"}
    assert shown.view_query(state, ["a", "b"], technologies, metrics) == "metrica=ha&estado=a&natura=1&m=41004" and shown.view_state("", statuses, technologies, ["a", "b"], metrics)["statuses"] == ["a", "b"]
    assert shown.group_summary(["a"], statuses, {"a": "Alta"}) == "Alta" and shown.class_labels([10, 2000], "MW") == ["hasta 10 MW", "más de 10 hasta 2.000 MW", "más de 2.000 MW"]
    said = shown.payloads(F.col("t"), ["mw"], ["name"], ["developer"], {"kind": (("dia", "aau"), "otro")})
    got = [tuple(v) for v in values(spark, said, ['{"mw": {"a": "1.200,5", "b": 2}, "name": ["x", "y"], "developer": ["p", "q"], "kind": "dia"}', '{"mw": "n/a", "kind": "zz"}', "{broken", None])]
    assert got == [(1202.5, "x", "p; q", "dia"), (None, None, None, "otro"), (None, None, None, "otro"), (None, None, None, "otro")]
    targets = spark.createDataFrame([(1, 2)], "old long, target long")
    assert shown.permanent_redirects(targets, "/p").first().destination == "/p/2"
    with pytest.raises(Exception, match="invalid redirect"):
        shown.permanent_redirects(spark.createDataFrame([(1, 1)], "old long, target long"), "/p").collect()


def test_search_and_order(spark):
    names = ["Ñu", "Nz", "Ávila", "Almería", "Ronda 10", "Ronda 2"]
    table = spark.createDataFrame([(n,) for n in names], "name string")
    assert [r.name for r in table.orderBy(*search.spanish(F.col("name"))).collect()] == ["Almería", "Ávila", "Nz", "Ñu", "Ronda 2", "Ronda 10"]
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, None), (3, dt.date(2023, 1, 1))], "id int, due date")
    assert [r.id for r in search.by_deadline(rows, "due", "id", 9).collect()] == [3, 1, 2]
    one = spark.createDataFrame([(1, "Ronda")], "id long, name string")
    many = spark.createDataFrame([(2, "Otra", ["aau12345"])], "id long, name string, files array<string>")
    indexed = search.index(one, one.limit(0), one, many)
    assert [(r.kind, r.rank) for r in search.search(indexed, "ronda").collect()] == [("municipality", 0), ("developer", 0)]
    assert [r.kind for r in search.search(indexed, "AAU 1/23.45").collect()] == ["project"] and search.search(indexed, " ").count() == search.search(indexed, "12-35").count() == 0


def test_site_figures(spark):
    docs = spark.createDataFrame([(1, 10, dt.date(2020, 1, 1), ["a"], 5.0, "x"), (1, 11, dt.date(2021, 1, 1), ["b"], None, ""), (1, 12, dt.date(2022, 1, 1), None, 0.0, None)], "project long, id long, published date, places array<string>, mw double, name string")
    r = figures.project_rollup(docs, ["mw", "name"]).first()
    assert (r.project_id, r.first_seen.year, r.last_seen.year, r.mw, r.name, r.places) == (10, 2020, 2022, 0.0, "x", ["a", "b"])
    record = spark.createDataFrame([(1, "dia", 5), (2, "desconocido", 9)], "id long, status string, status_document_id long")
    titles = spark.createDataFrame([(5, "t")], "id long, title string")
    assert {(x.id, x.status_document_id, x.status_title) for x in figures.status_record(record, titles).collect()} == {(1, 5, "t"), (2, None, None)}
    with pytest.raises(Exception, match="no document 5"):
        figures.status_record(record, titles.limit(0)).collect()
    places = spark.createDataFrame([(1,)], "place long")
    with pytest.raises(Exception, match="unknown place"):
        figures.known_places(spark.createDataFrame([(2,)], "place long"), places, "place").collect()
    ev = spark.createDataFrame([(1, 1, dt.date(2020, 1, 1), {"mw": "old", "id": "12345678Z"}), (1, 2, dt.date(2021, 1, 1), {"mw": "new"})], "project long, id long, published date, evidence map<string,string>")
    out = {x.field: [q.quote for q in x.quotes] for x in figures.evidence_by_field(ev).collect()}
    assert out["mw"] == ["new", "old"]
    kept = ev.select(figures.published_evidence(F.col("evidence"), ["mw", "id"], r"\d{8}[A-Z]").alias("e")).collect()
    assert kept[0].e == {"mw": "old"}
    cond = spark.createDataFrame([(1, "z", 0, "c"), (1, "agua", 1, "b"), (1, "agua", 0, "a")], "project long, category string, position int, text string")
    assert [(x.category, x.texts) for x in figures.conditions_by_category(cond, ["agua"]).orderBy("rank").collect()] == [("agua", ["a", "b"]), ("z", ["c"])]
    assert abs(values(spark, figures.radius_metres(*[F.lit(float(x)) for x in (0, -0.01, 0, 0.01)]), ["x"])[0] - 1113.2) < 0.5
    weak = figures.weak_matches(spark.createDataFrame([(1, 1, 0.7), (2, 1, 0.9), (3, 1, 0.5)], "id long, project long, score double"), spark.createDataFrame([(3,)], "id long"))
    assert [x.id for x in weak.collect()] == [1]
    assert values(spark, figures.shows_something(F.col("a"), F.col("b")), [([], ["x"]), ([], None)], "a array<string>, b array<string>") == [True, False]


def square(x, y, w, h):
    return [[{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))]]


def test_polygons(spark):
    assert shapes.intersects(square(0, 0, 1, 1), square(1, 1, 1, 1)) and shapes.intersects(square(0, 0, 4, 4), square(1, 1, 1, 1)) and not shapes.intersects(square(0, 0, 1, 1), square(2, 2, 1, 1))
    ring = square(0, 0, 4, 4) + square(1, 1, 2, 2)
    assert not shapes.intersects(ring, square(1.5, 1.5, 1, 1)) and shapes.covered_area(ring, [square(0, 0, 4, 4)]) == 12
    assert shapes.covered_area(square(0, 0, 4, 4), [square(1, 1, 2, 2), square(2, 2, 4, 1)]) == 5
    rng = np.random.default_rng(1)
    for _ in range(20):  # triangles against the share of random points that lie in base and cover
        base, cover = rng.uniform(0, 10, (3, 2)), [rng.uniform(0, 10, (3, 2)) for _ in range(3)]
        rings = lambda t: [[{"x": a, "y": b} for a, b in t]]
        points = rng.uniform(0, 10, (40_000, 2))

        def inside(t, points=points):
            side = [(b[0] - a[0]) * (points[:, 1] - a[1]) - (b[1] - a[1]) * (points[:, 0] - a[0]) > 0 for a, b in zip(t, np.roll(t, -1, axis=0), strict=True)]
            return (side[0] == side[1]) & (side[1] == side[2])

        want = 100 * (inside(base) & np.any([inside(c) for c in cover], axis=0)).mean()
        assert abs(shapes.covered_area(rings(base), [rings(c) for c in cover]) - want) < 1.5
    assert [tuple(map(float, p)) for p in shapes.simplified([(0, 0), (1, 0.01), (2, 0), (3, 1)], 0.1)] == [(0, 0), (2, 0), (3, 1)]
    table = spark.createDataFrame([(1, square(0, 0, 2, 2)), (2, square(2, 0, 2, 2)), (3, square(9, 9, 1, 1))], f"id long, rings {shapes.RINGS}")
    met = shapes.intersecting(table, table, cell=3.0)
    assert {(r.id, r.other_id) for r in met.collect()} == {(a, b) for a in (1, 2) for b in (1, 2)} | {(3, 3)}
    assert [r.a for r in table.select(shapes.area(F.col("rings")).alias("a")).collect()] == [4.0, 4.0, 1.0]
    edges = shapes.dissolved_edges(table.where("id < 3").withColumn("by", F.lit("r")), "by")
    assert edges.count() == 6
    thin = spark.createDataFrame([([[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.001}, {"x": 2.0, "y": 0.0}, {"x": 2.0, "y": 2.0}]],)], f"rings {shapes.RINGS}")
    assert len(thin.select(shapes.simplified_rings(F.col("rings"), 0.01).alias("r")).first().r[0]) == 3
    text = table.where("id = 1").select(shapes.to_geojson(F.col("rings"), 1).alias("g")).first().g
    assert text == '{"type":"Polygon","coordinates":[[[0.0,0.0],[2.0,0.0],[2.0,2.0],[0.0,2.0],[0.0,0.0]]]}'
    back = values(spark, shapes.from_geojson(F.lit("Polygon"), F.col("t")), ["[[[0,0],[1,0],[1,1]]]"])[0]
    assert [(p.x, p.y) for p in back[0]] == [(0, 0), (1, 0), (1, 1)]
    # a degree square at the equator and at 60 degrees: areas of the ellipsoid
    cells = spark.createDataFrame([(square(0, 0, 1, 1),), (square(0, 60, 1, 1),)], f"rings {shapes.RINGS}")
    areas = [r.a / 1e6 for r in cells.select(shapes.area(shapes.equal_area(F.col("rings"))).alias("a")).collect()]
    assert abs(areas[0] / 12308.8 - 1) < 2e-3 and abs(areas[1] / 6122.0 - 1) < 4e-3


def test_points_take_the_zone_that_places_most(spark):
    boxes = spark.createDataFrame([("g", -3.1, 36.1, -2.9, 36.2)], "group string, xmin double, ymin double, xmax double, ymax double")
    points = spark.createDataFrame([("g", 500000.0, 4000000.0, None), ("g", 500010.0, 4000010.0, None), ("g", 500000.0, 4000000.0, None), ("g", 100000.0, 4300000.0, None)], "group string, x double, y double, zone int")
    out = shapes.placed_points(points, boxes).collect()
    assert len(out) == 2 and {r.zone for r in out} == {30} and all(abs(r.lon + 3) < 0.01 for r in out)
    assert spatial.touching_boxes(boxes.select(F.lit(1).alias("id"), "xmin", "xmax", "ymin", "ymax"), 1.0).count() == 0


def test_published_tables_and_feeds(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 5):
        sinks.publish(spark.range(n), path)
        assert sinks.published(spark, path).count() == n
    for n in (3, 5):
        sinks.replace_table(spark.range(n), str(tmp_path / "r"))
        assert spark.read.parquet(str(tmp_path / "r")).count() == n
    sinks.write_csv(spark.range(0), str(tmp_path / "none"))
    assert sum(p.stat().st_size for p in (tmp_path / "none").glob("part-*")) == 0
    rows = spark.createDataFrame([("a", 1, dt.date(2024, 1, 1), "x & y", "/p?a=1&b=2", "<s>", "dia")], "area string, id long, published date, title string, url string, summary string, category string")
    feed = ET.fromstring(sinks.atom_feeds(rows, "area", "tag:example.org,2026").first().feed)
    atom = "{http://www.w3.org/2005/Atom}"
    assert feed.findtext(f"{atom}title") == "Projects of a" and feed.findtext(f"{atom}author/{atom}name") and {x.get("rel") for x in feed.findall(f"{atom}link")} == {"self", "alternate"}
    assert feed.find(f"{atom}entry/{atom}category").get("term") == "dia" and feed.findtext(f"{atom}entry/{atom}title") == "x & y"


def test_coordinates_in_texts(spark):
    turbines = """El parque se ubica en Tarifa.
Las coordenadas UTM (ETRS89, huso 30) de los aerogeneradores son las siguientes:
X
Y
AE-01
254.321
4.003.456
AE-02
254.980
4.003.912
AE-03
255.640,50
4.004.377,25
La parcela 12."""
    outline = "Coordenadas UTM de los vértices de la poligonal (ED50 Huso 29): V1 X: 305123 Y: 4155321 V2 X: 306001 Y: 4155390 V3 X: 306050 Y: 4154700 V1 X: 305200 Y: 4154650 V2 X: 305201 Y: 4154651 V3 X: 305202 Y: 4154652. Presupuesto: 305.000 4.150.000 euros."
    one, two, three, four = values(spark, coordinates.coordinate_groups(F.col("t")), [turbines, outline, "305123 4155321", None])
    assert [(p.label, p.x, p.y) for p in one[0].points] == [("AE-01", 254321.0, 4003456.0), ("AE-02", 254980.0, 4003912.0), ("AE-03", 255640.5, 4004377.25)]
    assert (one[0].kind, one[0].zone, one[0].datum, one[0].stated) == ("puntos", 30, "ETRS89", True) and one[0].heading.startswith("Las coordenadas UTM") and len(one) == 1
    assert [(g.kind, g.zone, g.datum, [p.label for p in g.points]) for g in two] == [("poligono", 29, "ED50", ["V1", "V2", "V3"])] * 2
    assert three == [] and four == [] and coordinates.points("X=4155321 Y=305123, utm") == [(305123.0, 4155321.0, None, 2, 18)]


def test_landed_shapes_and_exports(spark, tmp_path):
    points = [(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (0.0, 0.0)]
    body = struct.pack("<i4dii", 5, 0, 0, 2, 2, 1, len(points)) + struct.pack("<i", 0) + b"".join(struct.pack("<dd", *p) for p in points)
    (tmp_path / "a.shp").write_bytes(bytes(100) + struct.pack(">ii", 1, len(body) // 2) + body)
    row = records.shapefile(spark, str(tmp_path)).first()
    assert row.record == 1 and [(p.x, p.y) for p in row.rings[0]] == points[:3]
    assert records.previous(spark, str(tmp_path / "none"), "id int").count() == 0
    tiles = spark.createDataFrame([(0.0, 0.0, 1.0, 1.0), (5.0, 5.0, 6.0, 6.0)], "xmin double, ymin double, xmax double, ymax double")
    assert shapes.tiles_in_box(tiles, 0.5, 0.5, 2, 2).count() == 1
    with pytest.raises(Exception, match="no text in document"):
        spark.createDataFrame([("<documento><metadatos><identificador>D1</identificador></metadatos></documento>",)], "x string").select(records.xml_document("x")).collect()


def test_recent_rows_come_once(spark, tmp_path):
    day = dt.datetime(2024, 1, 1)
    for k, rows in enumerate(([("a", day), ("b", day)], [("a", day + dt.timedelta(days=7)), ("c", day)])):
        spark.createDataFrame(rows, "id string, at timestamp").write.parquet(str(tmp_path / "in" / f"n{k}"))
    stream = spark.readStream.schema("id string, at timestamp").parquet(str(tmp_path / "in" / "n*"))
    upserts.recent_once(stream, "at", ["id"]).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_unions_and_repairs_have_parts_and_holes(spark):
    box = lambda x, y, w, h: [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    assert overlay.union([[box(0, 0, 4, 4), box(1, 1, 1, 1)]]) == [[box(0, 0, 4, 4), [(1, 1), (1, 2), (2, 2), (2, 1)]]]
    assert len(overlay.union([[[(0, 0), (2, 2), (2, 0), (0, 2)]]])) == 2 and len(overlay.union([[box(0, 0, 1, 1)], [box(1, 1, 1, 1)]])) == 2
    assert overlay.union([[[(0, 0), (2, 0), (3, 0), (2, 0), (2, 2), (0, 2)]]]) == [[box(0, 0, 2, 2)]] and overlay.union([[box(0, 0, 1, 1)] * 2]) == [] and overlay.union([]) == []
    assert [len(p) for p in overlay.union([[box(0, 0, 9, 9), box(1, 1, 7, 7), box(3, 3, 2, 2)]])] == [2, 1]
    rng, grid = np.random.default_rng(7), np.arange(0, 30, 0.1) + 0.05
    places = np.stack([a.ravel() for a in np.meshgrid(grid, grid)], axis=1)
    for _ in range(60):  # boxes and self-crossing rings against a raster
        polygons = [[box(*rng.integers(0, 20, 2).tolist(), *rng.integers(1, 9, 2).tolist())] if rng.random() < 0.5 else [[tuple(p) for p in rng.uniform(0, 25, (rng.integers(3, 7), 2))]] for _ in range(rng.integers(1, 12))]
        parts = overlay.union(polygons)
        want = overlay.inside(places, [overlay._segments(p) for p in polygons])
        times = sum((overlay.inside(places, [overlay._segments(p)]).astype(int) for p in parts), np.zeros(len(places), int))
        assert (times != want).mean() < 1e-3 and abs(sum(overlay.signed_area(r) for p in parts for r in p) - want.sum() * 0.01) < 4
        assert all(len(set(r)) == len(r) for p in parts for r in p)
    rows = [("a", square(0, 0, 2, 2)), ("a", square(1, 1, 2, 2)), ("a", square(9, 9, 1, 1)), ("b", square(0, 0, 4, 4) + square(1, 1, 1, 1)), (None, square(0, 0, 1, 1)), ("c", [])]
    out = {r.by: r for r in overlay.dissolved(spark.createDataFrame(rows, f"by string, rings {shapes.RINGS}"), "by", at_once=1).withColumn("area", overlay.part_areas(F.col("parts"))).collect()}
    assert {k: (len(r.parts), r.area) for k, r in out.items()} == {"a": (2, 8.0), "b": (1, 15.0), None: (1, 1.0)}


def test_rings_of_other_lengths_than_their_neighbours(spark):
    """An outline of four corners whose hole has six or three, as boxes that overlap in part leave it."""
    hole, frame = [[{"x": x, "y": y} for x, y in ((1.0, 1.0), (1.0, 3.0), (2.0, 3.0), (2.0, 2.0), (3.0, 2.0), (3.0, 1.0))]], square(0, 0, 4, 4)
    corner = [[{"x": x, "y": y} for x, y in ((1.0, 1.0), (1.0, 2.0), (2.0, 1.0))]]
    around = [square(0, 0, 4, 1), square(0, 0, 1, 4), square(3, 0, 1, 4), square(0, 3, 4, 1), square(2, 2, 2, 2)]
    # as shapes with such holes, and as boxes whose first union has one, which the second step gets
    rows = [("a", frame + hole), ("a", square(9, 9, 1, 1)), ("b", frame + corner), *(("c", r) for r in around), ("d", [None, *frame]), ("d", None)]
    table = spark.createDataFrame(rows, f"by string, rings {shapes.RINGS}")
    for at_once in (1, 64):
        out = {r.by: (sorted(len(ring) for part in r.parts for ring in part), r.area) for r in overlay.dissolved(table, "by", at_once=at_once).withColumn("area", overlay.part_areas(F.col("parts"))).collect()}
        assert out == {"a": ([4, 4, 6], 14.0), "b": ([3, 4], 15.5), "c": ([4, 6], 13.0), "d": ([4], 16.0)}
    for of in (overlay.repaired, overlay.parts_of):
        assert values(spark, overlay.part_areas(of(F.col("t"))), [(frame + hole,), (frame + corner,), ([None, *frame],), (None,)], f"t {shapes.RINGS}") == [13.0, 15.5, 16.0, None]
    own, other = (spark.createDataFrame([r], f"id long, rings {shapes.RINGS}") for r in ((1, frame + corner), (2, square(0, 0, 2, 2) + corner)))
    assert [r.a for r in own.select(shapes.area(F.col("rings")).alias("a")).collect()] == [15.5]
    assert [[len(r) for r in x.r] for x in own.select(shapes.simplified_rings(F.col("rings"), 0.1).alias("r")).collect()] == [[4, 3]]
    assert [len(r) for r in json.loads(own.select(shapes.to_geojson(F.col("rings"), 1).alias("g")).first().g)["coordinates"]] == [5, 4]
    assert [(r.id, r.other_id) for r in shapes.intersecting(own, other, 3.0).collect()] == [(1, 2)]
    assert [(r.id, round(r.share, 9)) for r in shapes.covered_share(own, other, 3.0).collect()] == [(1, round(3.5 / 15.5, 9))]


def test_many_parts_are_nested_by_boxes(monkeypatch):
    """Frames with a hole and an island each: a ring is held to those whose boxes hold it, not to all larger ones."""
    box = lambda x, y, side: [(x, y), (x + side, y), (x + side, y + side), (x, y + side)]
    rings = [box(10.0 * (i % 20) + k, 10.0 * (i // 20) + k, 9.0 - 2 * k) for i in range(400) for k in (0.0, 2.0, 3.0)]
    asked, inside = [], overlay.inside
    monkeypatch.setattr(overlay, "inside", lambda *a: asked.append(1) or inside(*a))
    assert sorted(map(len, overlay.nested(rings))) == [1] * 400 + [2] * 400 and len(asked) == 3 * 400


def test_areas_of_several_parts(spark):
    two, ring = square(0, 0, 1, 1) + square(5, 5, 1, 1), square(1, 1, 1, 1) + square(0, 0, 4, 4)
    rows = spark.createDataFrame([(1, two), (2, ring), (3, None), (4, [])], f"id long, rings {shapes.RINGS}")
    out = {r.id: (r.a, r.g) for r in rows.select("id", shapes.area(F.col("rings")).alias("a"), shapes.to_geojson(F.col("rings"), 1).alias("g")).collect()}
    assert [out[i][0] for i in (1, 2, 3, 4)] == [2.0, 15.0, None, 0.0]
    assert json.loads(out[1][1])["type"] == "MultiPolygon" and len(json.loads(out[1][1])["coordinates"]) == 2
    hole = json.loads(out[2][1])
    assert hole["type"] == "Polygon" and [len(r) for r in hole["coordinates"]] == [5, 5] and [0.0, 0.0] in hole["coordinates"][0]


def test_words_of_all_scripts(spark):
    nbsp = "\u00a0"
    found = values(spark, decisions.labelled_capacity(F.col("t"), F.lit("")), [f"Planta de 109,5{nbsp}MWp", "de 61,2 MWP/51 MWN, y su infraestructura"])
    assert [(f.nominal, f.peak) for f in found] == [(None, 109.5), (51.0, 61.2)]
    names = {"PLANTA SOLAR UNO Y SU INFRAESTRUCTURA DE EVACUACIÓN": "PLANTA SOLAR UNO", "Planta X de 20 MWh": "Planta X", "Planta Y de 5 kWn": "Planta Y", "Parque fotovoltaico Tabernas 100 MW": "Parque fotovoltaico Tabernas 100", "PSFV Carmona 49,9 MWp": "PSFV Carmona 49,9 MWp", "Parque eolico Ronda II 50 MW": "Parque eolico Ronda II 50 MW", "de 50 MW": "de 50 MW", "Planta de Almacenamiento Teleiro Los Barrios, de potencial instalada de 5 MW y 20 MWH y línea de evacuación": "Planta de Almacenamiento Teleiro Los Barrios", "Solar Airport PV e infraestructura de evacuación": "Solar Airport PV"}
    assert values(spark, decisions.trimmed_name(F.col("t")), list(names)) == list(names.values())
    assert values(spark, decisions.is_correction(F.col("t")), ["CORRECCIÓN DE ERRORES de la", "Corrección de errores", "otra"]) == [True, True, False]


def test_numbers_that_are_no_points():
    assert coordinates.points("UTM 254.321 4.123.456,78 €") == [] and coordinates.points("utm 254.321 uno dos tres 4.003.456") == []
    assert coordinates.points("UTM 254.321" + " " * 41 + "4.003.456") == [] and len(coordinates.points("UTM 254.321" + " " * 40 + "4.003.456")) == 1
    swapped = coordinates.points("Coordenadas UTM: Y = 4.120.214,5; X = 389.751,25. Otra: 389751.25 4120214.50")
    assert [p[:2] for p in swapped] == [(389751.25, 4120214.5)] * 2
    above = "Las coordenadas de este documento se expresan en ETRS89 salvo indicación.\n" + "x" * 700
    [group] = coordinates.groups(above + "\nCoordenadas UTM ED50 huso 29 del centro de la planta:\nX: 680.500 Y: 4.150.250")
    assert (group["datum"], group["zone"], group["stated"]) == ("ED50", 29, True)
    [stated], [unstated] = coordinates.groups("Proyecto en huso 30.\n" + "z" * 700 + "\nCoordenadas UTM: X 559.820 Y 4.104.987"), coordinates.groups("Coordenadas UTM: X 559.820 Y 4.104.987")
    assert (stated["zone"], unstated["zone"], unstated["datum"], unstated["stated"]) == (30, None, "ETRS89", False)
    first, second = coordinates.groups("Coordenadas UTM ETRS89 huso 30 de los aerogeneradores:\nA1 254321 4003456\n" + "Texto de la resolución. " * 10 + "\nCoordenadas UTM de la subestación:\nSET 256000 4004000")
    assert [p["label"] for p in first["points"] + second["points"]] == ["A1", "SET"] and second["heading"] == "Coordenadas UTM de la subestación:"
    assert coordinates.groups("Importes parciales de la obra civil: 254.321 / 4.003.456.") == []


def test_few_segments_are_noded_as_many_are(monkeypatch):
    rng = np.random.default_rng(4)
    shapes = [[np.round(rng.random((rng.integers(3, 8), 2)) * size) for _ in range(rng.integers(1, 4))] for size in (3, 6, 1000) for _ in range(60)]
    few = [overlay.union([s]) for s in shapes]
    monkeypatch.setattr(overlay, "FEW", 0)
    assert few == [overlay.union([s]) for s in shapes]


def test_equal_polygons_of_a_batch_are_repaired_once(monkeypatch):
    done = []
    monkeypatch.setattr(overlay, "union", lambda polygons: done.append(polygons) or [])
    tie, box = [[0.0, 0.0, 2.0, 2.0, 2.0, 0.0, 0.0, 2.0]], [[0.0, 0.0, 2.0, 0.0, 2.0, 2.0, 0.0, 2.0]]
    assert overlay._repaired.func(pd.Series([tie, None, box, tie, tie])).tolist() == [[], None, [], [], []] and len(done) == 2


def test_covers_meet_in_blocks_and_equal_ones_once(spark, monkeypatch):
    rng = np.random.default_rng(6)
    met, each, crossings = [], [], shapes._crossings
    monkeypatch.setattr(shapes, "_crossings", lambda a, b: met.append(len(a) * len(b)) or crossings(a, b))
    corners = np.round(rng.random((600, 2)) * 100)
    covers = [[np.array([(x, y), (x + 2, y), (x + 2, y + 3), (x, y + 3)])] for x, y in corners]
    cells = {(int(x) + i, int(y) + j) for x, y in corners for i in range(2) for j in range(3)}
    base = [np.array([(0.0, 0.0), (50.0, 0.0), (50.0, 60.0), (0.0, 60.0)])]
    assert shapes.covered_area(base, covers) == pytest.approx(sum(x < 50 and y < 60 for x, y in cells)) and max(met) <= 256 * 4096
    real = shapes.intersecting
    monkeypatch.setattr(shapes, "intersecting", lambda a, b, cell: each.append(b.count()) or real(a, b, cell))
    square = lambda x: [[(x, 0.0), (x + 1.0, 0.0), (x + 1.0, 1.0), (x, 1.0)]]
    kind = f"id long, rings {shapes.RINGS}"
    zones = spark.createDataFrame([(k, square(float(k % 2))) for k in range(50)], kind)
    out = shapes.covered_share(spark.createDataFrame([(1, [[(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (0.0, 1.0)]])], kind), zones, 3.0).collect()
    assert [tuple(r) for r in out] == [(1, 0.5)] and each == [2]
