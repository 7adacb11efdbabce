"""A stored search index: grams of folded names and keys by bucket, so that a query reads the rows of one gram.

Whatever holds the query holds each of its trigrams (a query of one or two
letters is a gram itself), so the rows of its rarest gram hold all results.
Ranks are computed on those alone, with the rule that a full scan would use.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cumload.operators import search, texts

#: Folders of the postings; a gram lies in one.
BUCKETS = 64


def _bucket(gram: Column) -> Column:
    return F.pmod(F.crc32(gram), F.lit(BUCKETS)).cast("int")


def bucket_of(gram: str) -> int:
    return zlib.crc32(gram.encode()) % BUCKETS


def _grams(text: Column) -> Column:
    """All pieces of one to three characters, each once."""
    of = lambda n: F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(of(1), of(2), of(3)))


def write_index(entries: DataFrame, path: str) -> None:
    """Write the postings of ``entries`` (kind, id, name, keys: array) below ``path``, and how often each gram occurs.

    Null names are found by their keys only; null keys are none. A row is written once for each gram, sorted by gram in
    the files, whose statistics let a reader skip the others.
    """
    keys = F.filter(F.coalesce("keys", F.array().cast("array<string>")), lambda k: k.isNotNull())
    rows = entries.select("kind", "id", "name", texts.fold(F.coalesce("name", F.lit(""))).alias("folded"), keys.alias("keys"))
    # a key is one line of text, so that no gram runs from one to the next
    joined = rows.withColumn("lines", texts.fold(F.array_join("keys", "\u0001"))).withColumn("files", texts.expediente_key(F.array_join("keys", "\u0001")))
    posted = joined.withColumn("gram", F.explode(F.array_union(_grams(F.col("folded")), F.array_union(_grams(F.col("lines")), _grams(F.col("files")))))).withColumn("bucket", _bucket(F.col("gram")))
    posted.repartition("bucket", F.pmod(F.xxhash64("kind", "id"), F.lit(8))).sortWithinPartitions("bucket", "gram").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    stored = entries.sparkSession.read.parquet(f"{path}/postings")
    stored.groupBy("bucket", "gram").agg(F.count("*").alias("n")).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/grams")


def _pieces(text: str) -> list[str]:
    return [text[i : i + 3] for i in range(len(text) - 2)] or [text]


def _rarest(spark: SparkSession, path: str, text: str) -> str | None:
    """The gram of ``text`` with the fewest rows, or none if one of its grams has no row."""
    pieces = sorted(set(_pieces(text)))
    read = spark.read.parquet(f"{path}/grams").where(F.col("bucket").isin(sorted({bucket_of(p) for p in pieces})) & F.col("gram").isin(pieces))
    found = {r.gram: r.n for r in read.collect()}  # at most one row a gram of the query
    return min(pieces, key=lambda p: (found[p], p)) if len(found) == len(pieces) else None


def _rows(spark: SparkSession, path: str, text: str) -> DataFrame | None:
    gram = _rarest(spark, path, text)
    if gram is None:
        return None
    return spark.read.parquet(f"{path}/postings").where((F.col("bucket") == bucket_of(gram)) & (F.col("gram") == gram))


def find(spark: SparkSession, path: str, query: str, size: int = 10) -> DataFrame:
    """kind, id, name, rank of the best results in a written index, as ``search.best`` of a full scan (O7, O8). An empty query finds nothing."""
    q, key = search.folded(query), search.query_key(query)
    parts = [_rows(spark, path, t) for t in ([q] if q else []) + ([key] if q and len(key) >= 4 else [])]
    hits = [p for p in parts if p is not None]
    if not hits:
        return spark.createDataFrame([], "kind string, id string, name string, rank int")
    rows = hits[0].select("kind", "id", "name", "folded", "keys")
    for other in hits[1:]:
        rows = rows.union(other.select("kind", "id", "name", "folded", "keys"))
    return search.best(rows.distinct(), query, size)
