"""Names found by likeness and by search, held to comparisons of all with all."""

import random

import pytest
from pyspark.sql import functions as F

from cumload import catalog
from cumload.operators import likeness, postings, search
from cumload.operators.resolve import indel_ratio

DATA = "/root/testdata/sf0.001"


def typo(rng, name):
    for _ in range(rng.choice((0, 1, 1, 2, 3))):
        i = rng.randrange(len(name) + 1)
        name = name[:i] + rng.choice(("", "a", "n", " ")) + name[i + rng.choice((0, 1)) :]
    return name


def test_similar_names_are_those_of_brute_force(spark):
    rng = random.Random(5)
    parts = ["san", "villa", "nueva", "del", "rio", "aa", "aaa", "mar", "ñu", "torre", "é"]
    right = {" ".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(1500)} | {"", "a", "b", "ab", "aaaa", "aaaaa", "x" * 300}
    left = {typo(rng, n) for n in rng.sample(sorted(right), 500)} | {"", "a", "ba", "aaaaaa", "x" * 290, "x" * 240}
    table = lambda names: spark.createDataFrame([(n,) for n in [*names, None, "villa"]], "name string")
    for least in (0.9, 0.95, 1.0):
        want = {(a, b) for a in left | {"villa"} for b in right | {"villa"} if indel_ratio(a, b) >= least}
        rows = likeness.similar_names(table(left), table(right), least).collect()
        assert {(r.a, r.b) for r in rows} == want and len(rows) == len(want)
    assert len(want) < len({(r.a, r.b) for r in likeness.similar_names(table(left), table(right)).collect()})
    with pytest.raises(ValueError):
        likeness.similar_names(table(left), table(right), 0.8)
    assert likeness.similar_names(table(left).limit(0), table(right)).count() == 0


def test_canonical_names_of_the_whole_table(spark):
    rows = spark.read.parquet(f"{DATA}/part.parquet").collect()
    labels = {}
    for r in rows:
        name = f"{r.p_name} {r.p_brand} {r.p_type}".lower()
        labels[name] = min(labels.get(name, str(r.p_partkey)), str(r.p_partkey))
    want = {}
    for r in rows:
        name = f"{r.p_name} {r.p_brand} {r.p_type}".lower()
        at = r.p_partkey % len(name)
        cut = name[:at] + name[at + 1 :]
        score, place = min((-indel_ratio(cut, other), p) for other, p in labels.items())
        if score <= -0.9:
            want[cut] = place
    assert dict(map(tuple, catalog.t22_canonical_names(spark, DATA).collect())) == want


def test_the_most_alike_name_is_that_of_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    parts = ["san", "villa", "nueva", "del", "rio", "aa", "aaa", "mar", "ñu"]
    right = [(" ".join(rng.choices(parts, k=rng.randint(1, 5))), k % 70) for k in range(400)] + [("", 1), ("a", 2), ("aaaaa", 3), ("x" * 300, 4), ("x" * 257, 5)]
    left = {typo(rng, n) for n, _ in right for _ in range(2)} | {"", "b", "aaaa", "aaaaaa", "x" * 299, "x" * 256, "x" * 258}
    known = {}
    for n, p in right:
        known[n] = min(known.get(n, str(p)), str(p))
    best = {a: min((-indel_ratio(a, b), p) for b, p in known.items()) for a in left}
    table = spark.createDataFrame([(n, p) for n, p in right] + [(None, 0)], "folded string, place long")
    asked = spark.createDataFrame([(n,) for n in [*left, None, "villa"]], "folded string")
    later, similar = [], likeness.similar_names
    monkeypatch.setattr(likeness, "similar_names", lambda a, b, least: later.extend(r.name for r in a.collect()) or similar(a, b, least))
    for least in (0.9, 0.96):
        got = likeness.canonical_places(asked, table, least).collect()
        want = {a: p for a, (s, p) in best.items() if -s >= least} | {"villa": known["villa"]}
        assert {r.folded: r.place for r in got} == want and len(got) == len(want)
    # names with an equal one or one a letter apart are compared with no others
    assert all(min(abs(len(a) + len(b) - round(indel_ratio(a, b) * (len(a) + len(b)))) for b in known) > 1 or len(a) < 14 or len(a) > 256 for a in later)


def test_a_stored_index_finds_what_a_scan_finds(spark, tmp_path):
    rng = random.Random(8)
    names = ["Planta (Ronda)", "Ronda", "Cádiz «Norte»", "Los Ñañes", "Serón II", "Norte-Ronda", "ASERRÓN", "R", None, ""]
    rows = [(rng.choice(search.KINDS), str(i), rng.choice(names), rng.sample(["AAU/SE/12-34", "PFot 365", "Güevéjar", "se12", None], rng.randint(0, 3))) for i in range(300)]
    entries = spark.createDataFrame([*rows, ("site", "x", "Otra", None)], "kind string, id string, name string, keys array<string>")
    path = f"{tmp_path}/index"
    postings.write_index(entries, path)
    scan = entries.withColumn("folded", search.fold(F.coalesce("name", F.lit("")))).withColumn("keys", F.coalesce("keys", F.array().cast("array<string>"))).cache()
    for query in ("ronda", "RONDA", "cadiz", "r", "ñ", "ser", "n", "se/12", "12 34", "aau se 1234", "e/1", "guevejar", "zzz", "", "  ", "ronda x"):
        assert postings.find(spark, path, query, 25).collect() == search.best(scan, query, 25).collect(), query
    assert [r.rank for r in postings.find(spark, path, "ronda", 1000).collect()][:1] == [0] and {r.name: r.rank for r in postings.find(spark, path, "ronda", 1000).collect()} == {"Ronda": 0, "Planta (Ronda)": 1, "Norte-Ronda": 1}
    plan = postings._rows(spark, path, "ronda")._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in plan and "PartitionFilters" in plan and len(postings._rows(spark, path, "ronda").inputFiles()) >= 1


def test_places_are_found_without_accents(spark):
    places = spark.createDataFrame([("Cádiz",), ("Arcos de Cádiz",), ("Jaén",)], "name string")
    assert [r.name for r in search.find_places(places, "cadiz").collect()] == ["Cádiz", "Arcos de Cádiz"]
    assert search.find_places(places, "JAEN").count() == 1
