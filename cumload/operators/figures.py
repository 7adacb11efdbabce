"""Figures of areas, developers and projects as a site shows them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The three groups of a headline: those that add up, those without a verdict, the refused.
HEADLINE = {"accumulating": ("F",), "undecided": ("O",), "refused": ("P",)}


def newest(value: Column, published: Column, document: Column, zero_counts: bool = True) -> Column:
    """Aggregate: the value of the newest document that states one (A7). Empty texts state none; zeros do only if they count."""
    states = value.isNotNull() & (value.cast("string") != "")
    return F.max_by(F.when(states if zero_counts else states & (value != 0), value), F.when(states if zero_counts else states & (value != 0), F.struct(published, document)))


def project_rollup(documents: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """One row per project: first and last day, the newest stated value of each attribute, all places (A7, E13). ``documents``: project, id, published, places (array), attributes."""
    at = (F.col("published"), F.col("id"))
    every = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce("places", F.array().cast("array<string>"))))))
    return documents.groupBy("project").agg(F.min("id").alias("project_id"), F.min("published").alias("first_seen"), F.max("published").alias("last_seen"), *[newest(F.col(a), *at).alias(a) for a in attributes], every.alias("places"))


def project_names(documents: DataFrame, overrides: DataFrame) -> DataFrame:
    """Name of each project: the newest that a person gave, else the newest of a decision, else the newest, else none with the id.

    ``documents``: project, id, published, doc_type, name; ``overrides``: id, given.
    """
    rows = documents.join(overrides, "id", "left")
    at = (F.col("published"), F.col("id"))
    named = rows.groupBy("project").agg(newest(F.col("given"), *at).alias("a"), newest(F.when(F.col("doc_type") == "dia", F.col("name")), *at).alias("b"), newest(F.col("name"), *at).alias("c"), F.min("id").alias("id"))
    return named.select("project", F.coalesce("a", "b", "c", F.concat(F.lit("Proyecto sin nombre ("), F.col("id").cast("string"), F.lit(")"))).alias("name"))


def developers(projects: DataFrame) -> DataFrame:
    """One row per developer key (A9): its name as most often printed, all names, projects, and projects and MW by status.

    ``projects``: id, key, name (as printed; a row per company of a project), status, mw. Of names printed equally often
    one that is not all capitals counts, then the last by letters.
    """
    names = projects.groupBy("key", "name").agg(F.count_distinct("id").alias("n"))
    shown = names.groupBy("key").agg(F.max_by("name", F.struct("n", F.col("name") != F.upper("name"), "name")).alias("name"), F.array_sort(F.collect_set("name")).alias("names"))
    each = projects.select("key", "id", "status", "mw").distinct()
    status = each.groupBy("key", "status").agg(F.count("*").alias("n"), F.round(F.coalesce(F.sum("mw"), F.lit(0.0)), 4).alias("mw"), F.count("mw").alias("declared"))
    cells = F.array_sort(F.collect_list(F.struct("status", "n", "mw")))
    return shown.join(status.groupBy("key").agg(F.sum("n").alias("projects"), F.sum("declared").alias("mw_count"), cells.alias("by_status")), "key")


def developer_rollups(developers: DataFrame) -> DataFrame:
    """Corporate groups, and families of two companies or more (A10): companies, distinct projects, MW, and the company with most projects.

    ``developers``: key, family, parent (null: no group), id, mw (a row per company and project).
    """
    keyed = developers.withColumn("rollup", F.coalesce("parent", "family")).withColumn("is_group", F.col("parent").isNotNull())
    each = keyed.select("rollup", "is_group", "id", "mw").distinct().groupBy("rollup", "is_group").agg(F.count_distinct("id").alias("projects"), F.round(F.coalesce(F.sum("mw"), F.lit(0.0)), 4).alias("mw"))
    lead = keyed.groupBy("rollup", "is_group", "key").agg(F.count_distinct("id").alias("n")).groupBy("rollup", "is_group").agg(F.count("*").alias("companies"), F.min_by("key", F.struct(-F.col("n"), F.col("key"))).alias("lead"))
    return each.join(lead, ["rollup", "is_group"]).where("is_group OR companies >= 2")


def headline_totals(cells: DataFrame, by: str, without: Sequence[str] = ()) -> DataFrame:
    """Projects, MW, declared and fallback figures of each area in the three headline groups (A11, A37). ``cells``: by, status, technology and figures; ``without``: technologies left out."""
    some = cells.where(~F.col("technology").isin(*without)) if without else cells
    out = []
    for group, statuses in HEADLINE.items():
        inside = F.col("status").isin(*statuses)
        part = lambda c, inside=inside: F.coalesce(F.sum(F.when(inside, c)), F.lit(0))
        out += [part(F.col("project_count")).cast("long").alias(f"{group}_projects"), F.round(part(F.col("mw_best")), 4).alias(f"{group}_mw"), part(F.col("mw_count") + F.col("mw_peak_fallback_count")).cast("long").alias(f"{group}_declared")]
    return some.groupBy(by).agg(*out)


def metric(name: str, area_ha: str = "area_ha") -> Column:
    """A metric of summed figures (A13): MW, hectares, projects, or MW a square kilometre, 0 where there is no area."""
    density = F.when(F.col(area_ha) > 0, F.col("mw") / (F.col(area_ha) / 100)).otherwise(0.0)
    return {"mw": F.col("mw"), "ha": F.col("hectares"), "proyectos": F.col("projects").cast("double"), "densidad": density}[name]


def selected_panel(cells: DataFrame, area: str, statuses: Sequence[str], technologies: Sequence[str]) -> DataFrame:
    """What a selected area shows: matching cells by status, with coverage."""
    some = cells.where(F.col("status").isin(*statuses) & F.col("technology").isin(*technologies))
    return some.groupBy(area, "status").agg(F.sum("project_count").alias("projects"), F.round(F.sum("mw_best"), 4).alias("mw"), F.sum(F.col("mw_count") + F.col("mw_peak_fallback_count")).alias("declared"))


def developer_places(projects: DataFrame, bridge: DataFrame) -> DataFrame:
    """Projects of each developer in each place (A35). ``projects``: id, developer_id."""
    return projects.select("id", "developer_id").join(bridge, "id").groupBy("developer_id", "nation").agg(F.count("*").alias("projects"))


def status_counts(projects: DataFrame, by: str) -> DataFrame:
    """Projects by status."""
    return projects.groupBy(by, "status").agg(F.count("*").alias("projects"))


def first_spellings(values: DataFrame, by: str, key: Column) -> DataFrame:
    """The first spelling of each distinct value of ``by`` (A23). ``values``: by, value, position."""
    return values.groupBy(by, key.alias("key")).agg(F.min_by("value", "position").alias("value"))


def extent(points: DataFrame, by: str, digits: int = 5) -> DataFrame:
    """Bounding box of the points of each ``by`` (A25, A32). ``points``: by, x, y."""
    return points.groupBy(by).agg(*[F.round(f(c), digits).alias(f"{c}{n}") for c in ("x", "y") for n, f in (("min", F.min), ("max", F.max))])


def radius_metres(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Half the diagonal of a box in degrees, in metres at its middle latitude."""
    metres = 111_320.0
    high, wide = (ymax - ymin) * metres, (xmax - xmin) * metres * F.cos(F.radians((ymin + ymax) / 2))
    return F.sqrt(high * high + wide * wide) / 2


def padded(box: DataFrame, share: float = 0.1) -> DataFrame:
    """Boxes wider by a share of their size on each side."""
    w, h = (F.col("xmax") - F.col("xmin")) * share, (F.col("ymax") - F.col("ymin")) * share
    return box.withColumns({"xmin": F.col("xmin") - w, "xmax": F.col("xmax") + w, "ymin": F.col("ymin") - h, "ymax": F.col("ymax") + h})


def evidence_by_field(documents: DataFrame, by: str = "project") -> DataFrame:
    """Quotes of each field, newest document first (A33). ``documents``: by, id, published, evidence (map)."""
    each = documents.select(by, "id", "published", F.explode("evidence").alias("field", "quote")).where("quote <> ''")
    return each.groupBy(by, "field").agg(F.transform(F.sort_array(F.collect_list(F.struct("published", "id", "quote")), asc=False), lambda q: F.struct(q["quote"].alias("quote"), q["id"].alias("id"))).alias("quotes"))


def conditions_by_category(conditions: DataFrame, order: Sequence[str]) -> DataFrame:
    """Conditions of a project by category, in a fixed order of categories, others last (A34). ``conditions``: project, category, position, text."""
    rank = F.coalesce(F.nullif(F.array_position(F.lit(list(order)), F.col("category")), F.lit(0)), F.lit(len(order) + 1))
    return conditions.groupBy("project", "category", rank.alias("rank")).agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "text"))), lambda c: c["text"]).alias("texts"))


def accuracy(labels: DataFrame, documents: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Hits, cases and share of each field over the labels that carry it, and labels without a document.

    Both sides: id and the fields. A label without a field is no case of that field; without a document it is missing.
    """
    joined = labels.alias("l").join(documents.withColumn("_there", F.lit(True)).alias("d"), F.col("l.id") == F.col("d.id"), "left")
    each = joined.select(F.coalesce("d._there", F.lit(False)).alias("there"), F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"l.{f}").cast("string").alias("want"), F.col(f"d.{f}").cast("string").alias("got")) for f in fields])))
    hit = F.col("there") & F.col("want").eqNullSafe(F.col("got"))
    said = each.where("want IS NOT NULL")
    return said.groupBy("field").agg(F.count_if(hit).alias("hits"), F.count_if("there").alias("n"), F.count_if(~F.col("there")).alias("missing")).withColumn("share", F.when(F.col("n") > 0, F.round(F.col("hits") / F.col("n"), 6)))


def compared(old: DataFrame, new: DataFrame) -> DataFrame:
    """How two assignments of documents differ (A31): kind (split, merged), project, parts. ``old``, ``new``: id, project."""
    both = old.select("id", F.col("project").alias("a")).join(new.select("id", F.col("project").alias("b")), "id")
    part = lambda kind, one, other: both.groupBy(one).agg(F.count_distinct(other).alias("parts")).where("parts > 1").select(F.lit(kind).alias("kind"), F.col(one).alias("project"), "parts")
    return part("split", "a", "b").unionByName(part("merged", "b", "a"))


def weak_matches(bridge: DataFrame, old: DataFrame, below: float = 0.8) -> DataFrame:
    """New documents that joined a project by a weak match (A31). ``bridge``: id, project, score; ``old``: id."""
    return bridge.where(F.col("score") < below).join(old.select("id"), "id", "left_anti")


def timeline(documents: DataFrame) -> DataFrame:
    """Each project's documents oldest first, with their place and the last one (W6). ``documents``: project, id, published."""
    each = F.transform(F.array_sort(F.collect_list(F.struct("published", "id"))), lambda d: d["id"])
    return documents.groupBy("project").agg(each.alias("ids"), F.max_by("id", F.struct("published", "id")).alias("last_id"))


def feed_entries(documents: DataFrame, bridge: DataFrame, places: DataFrame) -> DataFrame:
    """A document's feeds: its project's places and their sites, each site once (J21). ``documents``: id (of the project), document; gives feed, document."""
    at = documents.join(bridge, "id")
    towns = at.select(F.concat(F.lit("place:"), F.col("nation").cast("string")).alias("feed"), "document")
    sites = at.join(places, "nation").select(F.concat(F.lit("site:"), "province").alias("feed"), "document")
    whole = documents.select(F.lit("all").alias("feed"), "document")
    return towns.unionByName(sites).unionByName(whole).distinct()


def known_places(rows: DataFrame, places: DataFrame, key: str) -> DataFrame:
    """``rows`` as they are; a row of a place that is not known is an error."""
    there = places.select(F.col(key).alias("_known")).distinct()
    fits = F.when(F.col("_known").isNotNull(), True).otherwise(F.raise_error(F.concat(F.lit(f"unknown {key}: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("boolean"))
    return rows.join(there, F.col(key) == F.col("_known"), "left").where(fits).drop("_known")


def status_record(projects: DataFrame, documents: DataFrame) -> DataFrame:
    """Projects with the document of their status; unknown ones have none, and a dangling id is an error (F19). ``projects``: id, status, status_document_id; ``documents``: id, title."""
    wanted = projects.withColumn("_wanted", F.when(F.col("status") != "desconocido", F.col("status_document_id")))
    docs = documents.select(F.col("id").alias("_doc"), F.col("title").alias("status_title"))
    there = F.when(F.col("_wanted").isNull() | F.col("_doc").isNotNull(), True).otherwise(F.raise_error(F.concat(F.lit("no document "), F.col("_wanted").cast("string"))).cast("boolean"))
    return wanted.join(docs, F.col("_wanted") == F.col("_doc"), "left").where(there).select("id", "status", F.col("_wanted").alias("status_document_id"), "status_title")


def shown_statuses(cells: DataFrame, by: str, statuses: Sequence[str]) -> DataFrame:
    """MW of each area by status, without the statuses whose total is 0 everywhere."""
    wide = cells.groupBy(by).pivot("status", list(statuses)).agg(F.round(F.sum("mw_best"), 4))
    total = wide.agg(*[F.coalesce(F.sum(f"`{x}`"), F.lit(0.0)).alias(x) for x in statuses]).first()
    return wide.select(by, *[F.coalesce(F.col(f"`{x}`"), F.lit(0.0)).alias(x) for x in statuses if total[x] != 0])


def published_evidence(evidence: Column, fields: Sequence[str], identity: str) -> Column:
    """Evidence of the fields that may be shown, without quotes that hold an identity number."""
    return F.map_filter(evidence, lambda k, v: k.isin(*fields) & ~v.rlike(identity))


def shows_something(*parts: Column) -> Column:
    """Whether any part of a document has something to show."""
    return F.coalesce(F.greatest(*[F.coalesce(F.size(p) > 0, F.lit(False)) for p in parts]), F.lit(False))


def region_shares(areas: DataFrame, key: str, value: str) -> DataFrame:
    """Share of each area in the whole region, 0 where the region has none (J10). The region is one row."""
    whole = F.broadcast(areas.agg(F.sum(value).alias("_whole")))
    return areas.crossJoin(whole).select(key, F.when(F.col("_whole") > 0, F.round(F.col(value) / F.col("_whole"), 6)).otherwise(0.0).alias("share"))


def common(a: Column, b: Column) -> tuple[Column, Column]:
    """How many members two sets share, and whether they are one set (U4)."""
    return F.size(F.array_intersect(a, b)).cast("long"), F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))
