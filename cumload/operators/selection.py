"""Which gazette items are taken up (F2 to F6, S5, U5, Z6). Texts come folded (see ``texts.fold``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Provinces, words of renewable plants, instruments and authorities.
PROVINCES = ("almeria", "cadiz", "cordoba", "granada", "huelva", "jaen", "malaga", "sevilla")
RENEWABLE = ("fotovoltaic", "solar", "eolic", "hibrid", "renovable")
INSTRUMENTS = ("autorizacion ambiental unificada", "impacto ambiental", "informacion publica")
AUTHORITIES = ("sostenibilidad", "medio ambiente")
ASSESSMENT_TITLES = ("impacto ambiental", "evaluacion ambiental", "estudio de impacto")
ASSESSMENT_BODIES = ("estudio de impacto ambiental", "evaluacion de impacto ambiental ordinaria", "evaluacion de impacto ambiental simplificada")
# Phrases that name these words without meaning them.
GRID = r"evacuacion de (?:las )?(?:energias )?renovables"
EXEMPTION = r"(?:exent[ao]s?|exencion) del tramite de evaluacion de impacto ambiental[^.]*"


def has_any(text: Column, words: Sequence[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | text.contains(w)
    return found


def is_decision(section: Column, department: Column, title: Column) -> Column:
    """Decisions of the ministry on renewable plants (F2): section III, its department, an impact statement, a renewable word."""
    return (section == "III") & department.contains("transicion ecologica") & title.contains("impacto ambiental") & has_any(title, RENEWABLE)


def in_region(title: Column, body: Column) -> Column:
    """Whether the title names the region, or the body consults a delegation in one of its provinces."""
    return has_any(title, (*PROVINCES, "andalucia")) | has_any(body, [f"delegacion territorial en {p}" for p in PROVINCES])


def is_consultation(section: Column, title: Column) -> Column:
    """Consultations of section V on renewable plants in the region (F3); grid works name renewables only as what they carry."""
    plants = F.regexp_replace(title, GRID, " ")
    return (section == "V") & title.contains("informacion publica") & has_any(plants, RENEWABLE) & has_any(title, (*PROVINCES, "andalucia"))


def assesses(title: Column, body: Column) -> Column:
    """Whether a consultation covers the assessment (F5): by its title, or by its body without the exemption clause."""
    return has_any(title, ASSESSMENT_TITLES) | has_any(F.regexp_replace(body, EXEMPTION, " "), ASSESSMENT_BODIES)


def is_regional_record(organisation: Column, title: Column, body: Column) -> Column:
    """Records of the regional gazette (F6): an environment authority, an instrument in the title, a renewable word in title or text."""
    return has_any(organisation, AUTHORITIES) & has_any(title, INSTRUMENTS) & (has_any(title, RENEWABLE) | has_any(body, RENEWABLE))


def landed_pages(pages: DataFrame, size: int = 50) -> DataFrame:
    """Pages of a search that count (S5): from page 0 up to the first that is empty or completes the total. ``pages``: query, page, received, total."""
    ended = F.col("received").isNull() | (F.col("received") == 0) | ((F.col("page") + 1) * size >= F.col("total"))
    last = pages.groupBy(F.col("query").alias("_query")).agg(F.min(F.when(ended, F.col("page"))).alias("_last"))
    return pages.join(last, F.col("query") == F.col("_query")).where((F.col("received") > 0) & (F.col("_last").isNull() | (F.col("page") <= F.col("_last")))).drop("_query", "_last")


def coverage_years(years: DataFrame, budget: float) -> DataFrame:
    """Years that a scan of bounded time completes, newest first; a year that the time cuts is left out (Z6, A28). ``years``: year, seconds."""
    later = years.select(F.col("year").alias("_y"), F.col("seconds").alias("_s"))  # one row per year
    spent = years.join(later, F.col("_y") >= F.col("year")).groupBy("year").agg(F.sum("_s").alias("spent"))
    return spent.where(F.col("spent") <= budget).select("year", "spent")
