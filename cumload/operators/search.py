"""Search, order and its ranks."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from cumload.operators.texts import expediente_key, fold

#: Kinds of a search result in the order they are shown.
KINDS = ("municipality", "site", "developer", "project")

@F.pandas_udf(ArrayType(StringType()))
def fold_all(lists: pd.Series) -> pd.Series:
    """Lists of keys, each folded as names are; null keys are left out."""
    return lists.map(lambda keys: [] if keys is None else list(fold.func(pd.Series([k for k in keys if k is not None], dtype=object))))


def folded(text: str) -> str:
    """A query as names are folded."""
    return fold.func(pd.Series([text]))[0]


def spanish(name: Column) -> list[Column]:
    """Keys that order names as Spanish does, whatever the case or accent, numbers by value (O3): ñ after n."""
    plain = F.translate(F.lower(name), "áéíóúü", "aeiouu")
    padded = F.regexp_replace(F.regexp_replace(plain, r"(\d+)", "000000000000$1"), r"0*(\d{12})(?!\d)", "$1")
    return [F.replace(padded, F.lit("ñ"), F.lit("n￿")), name]


def declared_rank(projects: Column, declared: Column, value: Column) -> Column:
    """A rank that puts areas with projects but no figure after all figures, and areas without projects last."""
    return F.when(projects == 0, -2.0).when(declared == 0, -1.0).otherwise(value)


def find_places(places: DataFrame, query: str, name: str = "name", size: int = 8) -> DataFrame:
    """Names that hold the query, whatever the case or accents, those that start with it first, then by letters."""
    q = folded(query)
    low = fold(F.col(name))
    return places.withColumn("_low", low).where(F.col("_low").contains(q)).withColumn("starts", F.col("_low").startswith(q)).drop("_low").orderBy(F.desc("starts"), name).limit(size)


def index(municipalities: DataFrame, sites: DataFrame, developers: DataFrame, projects: DataFrame) -> DataFrame:
    """One table of everything that can be found: kind, id, name, files (O9). ``projects`` has files, the others id and name."""
    none = F.array().cast("array<string>")
    parts = [df.select(F.lit(k).alias("kind"), F.col("id").cast("string").alias("id"), "name", (F.col("files") if k == "project" else none).alias("files")) for k, df in zip(KINDS, (municipalities, sites, developers, projects), strict=True)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# Fixed value: what parts the words of a name.
APART = "[\\s«»\"'(),.;/-]+"


def rank(low: Column, query: str) -> Column:
    """0 for a folded name that starts with the query, 1 for a word of it that does, 2 for a name that holds it, else null; an empty query finds nothing."""
    q = folded(query)
    if not q:
        return F.lit(None).cast("int")
    word = F.exists(F.split(low, APART), lambda w: w.startswith(q))
    return F.when(low.startswith(q), 0).when(word, 1).when(low.contains(q), 2)


def query_key(query: str) -> str:
    """A query as files are compared."""
    return re.sub(r"[\s/.-]+", "", folded(query))


def best(entries: DataFrame, query: str, size: int = 10) -> DataFrame:
    """The best entries for a query: by rank, kind, length of the name and name (O7, O8). ``entries``: kind, id, name, folded, keys (array).

    A key that holds the query ranks 3; so does one that holds it without blanks, slashes, dots and dashes, if four
    characters or more are left.
    """
    q, key = folded(query), query_key(query)
    by_key = F.exists("_keys", lambda k: k.contains(q))
    if len(key) >= 4:
        by_key = by_key | F.exists("_keys", lambda k: F.regexp_replace(k, r"[\s/.-]+", "").contains(key))
    found = F.coalesce(rank(F.col("folded"), query), F.when(F.coalesce(by_key, F.lit(False)) & F.lit(bool(q)), 3))
    kind = F.array_position(F.lit(list(KINDS)), F.col("kind"))
    return entries.withColumn("_keys", fold_all("keys")).withColumn("rank", found).where("rank IS NOT NULL").orderBy("rank", kind, F.length("name"), "name", "id").limit(size).select("kind", "id", "name", "rank")


def search(indexed: DataFrame, query: str, size: int = 10) -> DataFrame:
    """The best results of a full scan of ``index``; ``postings`` finds the same in a stored one."""
    return best(indexed.withColumn("folded", fold(F.coalesce("name", F.lit("")))).withColumnRenamed("files", "keys"), query, size)


def file_keys(files: Column) -> Column:
    """A project's files as search compares them (O8, T42): one string of keys."""
    return expediente_key(F.concat_ws(" ; ", files))


def by_deadline(rows: DataFrame, deadline: str, key: str, size: int) -> DataFrame:
    """Earliest deadline first, rows without one last."""
    return rows.orderBy(F.coalesce(deadline, F.to_date(F.lit("9999-12-31"))), key).limit(size)


def largest_first(groups: DataFrame, size: str, key: str) -> DataFrame:
    """Groups by falling size, then key."""
    return groups.orderBy(F.desc(size), key)


def matching_areas(areas: DataFrame, cells: DataFrame, key: str, province: str | None = None) -> DataFrame:
    """Areas of a province with a matching project."""
    some = areas.where(F.col("province") == province) if province else areas
    return some.join(cells.where("project_count > 0").select(key).distinct(), key, "left_semi")
