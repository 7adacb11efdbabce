"""How figures, names and states are written (T36, T37, T39 to T41, T46, T49, T52, T53, K12), and how stated payloads are read."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from urllib.parse import parse_qs, urlencode

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumload.operators.texts import fold

# Months, small words of place names, designations of protected areas.
MONTHS = "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()
SMALL = ("de", "del", "la", "las", "los", "y", "e", "en")
DESIGNATIONS = {
    "zepa": r"\bzona de especial proteccion para las aves\b|\bzepa\b",
    "zec": r"\bzona (?:especial de|de especial) conservacion\b|\bzec\b",
    "lic": r"\blugar de importancia comunitaria\b|\blic\b",
    "ziae": r"\bzona de importancia para las aves esteparias(?: de andalucia)?\b|\bziae\b",
    "iba": r"\barea importante para la conservacion de las aves(?: y la biodiversidad)?\b|\bimportant bird areas?\b|\bibas?\b",
}
CONNECTORS = ("y", "e", "de", "del", "la", "las", "los", "el", "n")


def number(value: Column, decimals: int) -> Column:
    """A figure with Spanish separators, grouped by thousands."""
    return F.translate(F.format_number(value, decimals), ",.", ".,")


def megawatts(nominal: Column, peak: Column) -> Column:
    """A project's MW, the peak marked as such where no nominal figure is stated, null without either."""
    return F.coalesce(F.concat(number(nominal, 1), F.lit(" MW")), F.concat(number(peak, 1), F.lit(" MW pico")))


def coverage(declared: Column, total: Column, peak: Column) -> Column:
    """The note on how many projects state MW, and how many of these the peak alone."""
    base = F.concat(F.lit("MW declarados en "), number(declared, 0), F.lit(" de "), number(total, 0), F.when(total == 1, " proyecto").otherwise(" proyectos"))
    return F.when(peak > 0, F.concat(base, F.lit("; en "), number(peak, 0), F.lit(" se usa la potencia pico"))).otherwise(base)


def long_date(day: Column) -> Column:
    """8 de agosto de 2019."""
    return F.concat(F.day(day).cast("string"), F.lit(" de "), F.element_at(F.lit(MONTHS), F.month(day)), F.lit(" de "), F.year(day).cast("string"))


def labelled(value: Column, labels: Mapping[str, str]) -> Column:
    """A value's label, itself without one."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]), value), value)


def site_name(raw: Column, accents: Mapping[str, str]) -> Column:
    """A site's name in title case: small words stay small unless they begin a name, numerals are capitals, accents are put back."""
    known = F.create_map(*[F.lit(x) for kv in accents.items() for x in kv]) if accents else F.lit(None).cast("map<string,string>")
    parts = F.regexp_extract_all(F.trim(F.regexp_replace(F.lower(raw), r"\s+", " ")), F.lit(r"\p{L}+|[^\p{L}]+"), 0)

    def shown(w: Column, i: Column) -> Column:
        begins = (i == 0) | F.coalesce(F.get(parts, i - 1).rlike(r"[-/]\s?$"), F.lit(False))
        word = F.coalesce(F.try_element_at(known, w), w)
        return F.when(w.rlike("^[ivxl]+$"), F.upper(w)).when(~begins & w.isin(*SMALL), w).otherwise(F.concat(F.upper(F.left(word, F.lit(1))), F.substring(word, F.lit(2), F.length(word))))

    return F.array_join(F.transform(parts, shown), "")


def unquoted(text: Column) -> Column:
    """A quote without marks or emphasis around it."""
    return F.trim(F.regexp_replace(F.replace(text, F.lit("**"), F.lit("")), "^[\"'«“]+|[\"'»”]+$", ""))


def protected_area_key(name: Column) -> Column:
    """One key for a protected area however it is written: its designations and the words of its name; in lower case without either."""
    text = fold(name)
    kinds = F.array_sort(F.array_compact(F.array(*[F.when(text.rlike(p), k) for k, p in DESIGNATIONS.items()])))
    bare = text
    for p in (*DESIGNATIONS.values(), r"\bred natura 2000\b", r"\bes\d{5,}\b"):
        bare = F.regexp_replace(bare, p, " ")
    words = F.array_join(F.filter(F.split(bare, r"[^\p{L}]+"), lambda w: w != ""), " ")
    ends = "|".join(CONNECTORS)
    site = F.regexp_replace(F.regexp_replace(words, rf"^(?:(?:{ends})(?: |$))+", ""), rf"(?:(?:^| )(?:{ends}))+$", "")
    return F.when((F.size(kinds) == 0) | (site == ""), F.lower(name)).otherwise(F.concat(F.array_join(kinds, "+"), F.lit(":"), site))


def longest_spellings(names: DataFrame, by: str, key: Column) -> DataFrame:
    """Each distinct name of ``by`` in its longest spelling, the first of equals (T37). ``names``: by, name, position."""
    return names.groupBy(by, key.alias("key")).agg(F.max_by("name", F.struct(F.length("name"), -F.col("position"))).alias("name"))


def family_label(names: Column) -> Column:
    """The leading words that all names share, whatever the case, less than a whole name where there are others; null without any."""
    split = F.transform(names, lambda n: F.split(n, r"\s+"))
    low = F.transform(names, lambda n: F.split(F.lower(n), r"\s+"))
    most = F.array_min(F.transform(split, lambda w: F.size(w)))
    same = F.filter(F.sequence(F.lit(0), most), lambda k: F.size(F.array_distinct(F.transform(low, lambda w: F.slice(w, F.lit(1), k)))) <= 1)
    return F.nullif(F.array_join(F.slice(F.get(split, 0), F.lit(1), F.array_max(same)), " "), F.lit(""))


def view_state(query: str, statuses: Sequence[str], technologies: Sequence[str], usual: Sequence[str], metrics: Sequence[str]) -> dict:
    """A page's state from its query string; what is missing or unknown takes its default."""
    stated = {k: v[-1] for k, v in parse_qs(query, keep_blank_values=True).items()}
    pick = lambda name, known, default: [x for x in known if x in stated[name].split(",")] if name in stated else list(default)
    place = stated.get("m", "")
    return {"metric": stated.get("metrica") if stated.get("metrica") in metrics else metrics[0], "statuses": pick("estado", statuses, usual), "technologies": pick("tecnologia", technologies, technologies), "natura": stated.get("natura") == "1", "selected": place if len(place) == 5 and place.isdigit() else None}


def view_query(state: Mapping, usual: Sequence[str], technologies: Sequence[str], metrics: Sequence[str]) -> str:
    """The query string of a state: only what differs from the defaults."""
    out = {"metrica": state["metric"] if state["metric"] != metrics[0] else None, "estado": ",".join(state["statuses"]) if set(state["statuses"]) != set(usual) else None, "tecnologia": ",".join(state["technologies"]) if len(state["technologies"]) != len(technologies) else None, "natura": "1" if state["natura"] else None, "m": state["selected"]}
    return urlencode({k: v for k, v in out.items() if v is not None}, safe=",")


def group_summary(chosen: Sequence[str], every: Sequence[str], labels: Mapping[str, str]) -> str:
    """A filter in words: all, none, one by its name, or how many of how many."""
    if len(chosen) in (0, len(every)):
        return "todos" if chosen else "ninguno"
    return labels.get(chosen[0], chosen[0]) if len(chosen) == 1 else f"{len(chosen)} de {len(every)}"


def class_labels(thresholds: Sequence[float], unit: str) -> list[str]:
    """Labels of the classes between thresholds."""
    shown = [f"{t:,.0f}".replace(",", ".") for t in thresholds]
    if not shown:
        return [f"más de 0 {unit}"]
    return [f"hasta {shown[0]} {unit}", *(f"más de {a} hasta {b} {unit}" for a, b in zip(shown[:-1], shown[1:], strict=True)), f"más de {shown[-1]} {unit}"]


def permanent_redirects(targets: DataFrame, page: str) -> DataFrame:
    """(source, destination) pages of retired ids (K12); an entry that leads to itself or nowhere is an error. ``targets``: old, target."""
    sound = F.when(F.col("target").isNotNull() & (F.col("old") != F.col("target")), True).otherwise(F.raise_error(F.concat(F.lit("invalid redirect of "), F.col("old").cast("string"))).cast("boolean"))
    path = lambda c: F.concat(F.lit(f"{page}/"), F.col(c).cast("string"))
    return targets.where(sound).select(path("old").alias("source"), path("target").alias("destination"))


def _number(value) -> float | None:
    """A stated number; "254.321,50" and "51,2" are Spanish, lists and objects are sums of their numbers."""
    if isinstance(value, (list, dict)):
        parts = [n for n in map(_number, value.values() if isinstance(value, dict) else value) if n is not None]
        return sum(parts) if parts else None
    if isinstance(value, str):
        text = value.strip()
        text = text.replace(".", "").replace(",", ".") if "," in text and "." in text else text.replace(",", ".")
        try:
            return float(text)
        except ValueError:
            return None
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None


def payloads(raw: Column, numbers: Sequence[str], firsts: Sequence[str], joined: Sequence[str], enums: Mapping[str, tuple[Sequence[str], str | None]]) -> Column:
    """A stated JSON payload as a struct (T23): numbers folded, first values, joined lists, and words of a list of allowed ones or their default. Broken JSON states nothing."""
    columns = [*[(n, "double") for n in numbers], *[(n, "string") for n in (*firsts, *joined, *enums)]]

    def texts(value) -> list[str]:
        many = value.values() if isinstance(value, dict) else value if isinstance(value, list) else [value]
        return [str(v).strip() for v in many if v not in (None, "")]

    def one(text: str | None) -> tuple:
        try:
            said = json.loads(text or "{}")
        except ValueError:
            said = {}
        said = said if isinstance(said, dict) else {}
        word = lambda n: next(iter(texts(said.get(n))), None)
        return (*[_number(said.get(n)) for n in numbers], *[word(n) for n in firsts], *["; ".join(texts(said.get(n))) or None for n in joined], *[word(n) if word(n) in allowed else default for n, (allowed, default) in enums.items()])

    @F.pandas_udf(", ".join(f"{n} {t}" for n, t in columns))
    def read(rows: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(t) for t in rows], columns=[n for n, _ in columns])

    return read(raw)
