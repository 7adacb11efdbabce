"""Text and scalar rules as column expressions (T*, F2 to F6, F15, F17)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Legal forms that end a company's name (letters may stand apart), and number words that end a family's.
LEGAL_FORMS = ("s ?l ?u", "s ?l ?l", "s ?l", "s ?a ?u", "s ?a", "a ?i ?e", "sociedad limitada(?: unipersonal)?", "sociedad anonima(?: unipersonal)?")
NUMBER_WORDS = "uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciseis diecisiete dieciocho diecinueve veinte treinta cuarenta cincuenta one two three four five six seven eight nine ten".split()
#: Roman numerals up to xxxix.
NUMERAL = "x{0,3}(?:ix|iv|v?i{0,3})"


@F.pandas_udf(StringType())
def fold(texts: pd.Series) -> pd.Series:
    """NFKD without combining marks, lower case, single spaces."""
    return texts.map(lambda t: None if t is None else " ".join("".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower().split()))


def tokens(folded: Column) -> Column:
    return F.filter(F.split(folded, "[^a-z0-9]+"), lambda t: t != "")


def matches(folded: Column, query: str) -> Column:
    """Substring search; an empty query finds all."""
    return F.lit(True) if not query else folded.contains(query)


def developer_key(name: Column) -> Column:
    """Slug of a company: accents folded, no parentheses or punctuation, no legal form at the end, a word's trailing digits apart (T4)."""
    words = F.trim(F.regexp_replace(F.regexp_replace(fold(F.regexp_replace(name, r"\([^)]*\)", " ")), "[^a-z0-9]+", " "), " +", " "))
    bare = F.regexp_replace(F.concat(F.lit(" "), words), f"(?:\\s+(?:{'|'.join(LEGAL_FORMS)}))+$", "")
    return F.replace(F.trim(F.regexp_replace(bare, r"\b([a-z]+)(\d+)\b", "$1 $2")), F.lit(" "), F.lit("-"))


def family_key(key: Column) -> Column:
    """A developer key without a trailing number, numeral or number word, unless nothing is left (T5)."""
    return F.regexp_replace(key, f"^(.+)-(?:[0-9]+|(?=[ivx]){NUMERAL}|{'|'.join(NUMBER_WORDS)})$", "$1")


def grouped_developers(keys: DataFrame, groups: DataFrame) -> DataFrame:
    """key, family, group_name, parent of every developer key (T6). ``keys``: key; ``groups``: key, name, parent (null: a row that joins spellings).

    A spelling row for the key, else for its family, gives the family of its own name. Of the rows for key, family and
    that family, the first with a parent is the group, else the first spelling row.
    """
    rows = groups.select(F.col("key").alias("_key"), F.struct("name", "parent", family_key(developer_key("name")).alias("family")).alias("_row"))

    def found(df: DataFrame, on: str, name: str) -> DataFrame:
        return df.join(rows, F.col(on) == F.col("_key"), "left").withColumnRenamed("_row", name).drop("_key")

    own = found(found(keys.withColumn("plain", family_key(F.col("key"))), "key", "a"), "plain", "b")
    first = F.coalesce("a", "b")
    spelling = F.when(first["parent"].isNull() & (first["family"] != ""), first["family"])
    all_rows = found(own.withColumn("family", F.coalesce(spelling, "plain")), "family", "c")
    listed = F.array_compact(F.array("a", "b", "c"))
    group = F.coalesce(F.get(F.filter(listed, lambda r: r["parent"].isNotNull()), 0), F.get(listed, 0))
    return all_rows.select("key", "family", group["name"].alias("group_name"), group["parent"].alias("parent"))


def names(joined: Column) -> Column:
    """Parts of a ``;`` list, trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(joined, ";"), lambda x: F.trim(x)), lambda x: x != "")


def expediente_key(value: Column) -> Column:
    """Folded, without blanks, slashes, dots and dashes."""
    return F.regexp_replace(fold(value), r"[\s/.-]+", "")


def blanked_match(text: Column, phrase: str, wanted: str) -> Column:
    """Whether ``wanted`` is found once ``phrase`` is blanked out."""
    return F.regexp_replace(F.lower(text), phrase, " ").rlike(wanted)


def chunks(text: Column, size: int = 8000) -> Column:
    """Pieces of ``size`` characters."""
    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.length(text) - 1) / size).cast("int")), lambda i: F.substring(text, i * size + 1, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def checked(value: Column, low: float, high: float) -> tuple[Column, Column]:
    """A value in its range or null, and 1 if it was dropped."""
    ok = value.between(low, high)
    return F.when(ok, value), F.when(value.isNotNull() & ~ok, 1).otherwise(0)


def confidence(start: Column, problems: Column) -> Column:
    """0.1 less for each problem, not below 0."""
    return F.greatest(F.lit(0.0), F.round(start - 0.1 * problems, 6))


def redacted(items: Column) -> Column:
    """Items without an identity number."""
    return F.filter(items, lambda x: ~x.rlike("(?i)([0-9]{8}[A-Z]|[XYZ][0-9]{7}[A-Z]|[0-9]{3}-[0-9]{2}-[0-9]{4})"))


def wilson(hits: Column, n: Column, z: float = 1.959964) -> tuple[Column, Column]:
    """Score interval of a share; (0, 1) without cases."""
    p, zz = hits / n, z * z
    mid, wide = (p + zz / (2 * n)) / (1 + zz / n), z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n)) / (1 + zz / n)
    return F.when(n > 0, F.greatest(F.lit(0.0), mid - wide)).otherwise(0.0), F.when(n > 0, F.least(F.lit(1.0), mid + wide)).otherwise(1.0)
