"""Writers (K3 to K6, K8 to K11). Tables are written by their tasks; only what a file's format puts in one piece is gathered, by key."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def replace_table(df: DataFrame, path: str) -> None:
    """Write a full rebuild beside the old table, then swap by renames (K3).

    A failed write changes nothing, and a failed swap puts the old table back. Between the two renames a reader that
    opens the path finds no table; readers that must never see that take ``publish`` and ``published``.
    """
    spark, new, old = df.sparkSession, path.rstrip("/") + "._new", path.rstrip("/") + "._old"
    df.write.mode("overwrite").parquet(new)
    fs, where = _fs(spark, path)
    fresh, aside = _fs(spark, new)[1], _fs(spark, old)[1]
    fs.delete(aside, True)
    if fs.exists(where):
        fs.rename(where, aside)
    if not fs.rename(fresh, where):
        if fs.exists(aside):
            fs.rename(aside, where)
        raise OSError(f"could not move {new} to {path}")
    fs.delete(aside, True)


def publish(df: DataFrame, path: str) -> str:
    """Write a full rebuild as a version of its own below ``path``, then point to it: readers see one version or the next (K3). Returns the version's folder."""
    spark, version = df.sparkSession, f"v{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    fs, where = _fs(spark, f"{path}/_current/{time.time_ns():020d}-{version}")
    fs.create(where).close()  # an empty file is there or not; the last by name is current
    return f"{path}/{version}"


def published(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``publish`` wrote last."""
    fs, where = _fs(spark, f"{path}/_current")
    last = max(status.getPath().getName() for status in fs.listStatus(where))
    return spark.read.parquet(f"{path}/{last.partition('-')[2]}")


def first_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key by ``order``; later ones are ignored (K4). A fold with map-side combining, no sort."""
    whole = F.min_by(F.struct(*rows.columns), F.col(order))
    return rows.groupBy(F.col(key).alias("_key")).agg(whole.alias("_row")).select("_row.*")


def write_csv(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """CSV parts with a header, null as nothing; with ``order`` the parts are ranges in that order (K5, O1). Without rows there is one empty part."""
    rows = df.orderBy(*order) if order else df
    if rows.isEmpty():
        rows.sparkSession.createDataFrame([], "value string").coalesce(1).write.mode("overwrite").text(path)
    else:
        rows.write.mode("overwrite").csv(path, header=True, emptyValue="")


def feature(geometry: Column, properties: list[str]) -> Column:
    """A GeoJSON feature as text from GeoJSON geometry and named columns."""
    return F.concat(F.lit('{"type":"Feature","geometry":'), F.coalesce(geometry, F.lit("null")), F.lit(',"properties":'), F.to_json(F.struct(*properties), {"ignoreNullFields": "false"}), F.lit("}"))


def point(lon: Column, lat: Column, decimals: int = 5) -> Column:
    """GeoJSON of a point."""
    return F.when(lon.isNotNull() & lat.isNotNull(), F.to_json(F.struct(F.lit("Point").alias("type"), F.array(F.round(lon, decimals), F.round(lat, decimals)).alias("coordinates"))))


def write_features(df: DataFrame, geometry: Column, properties: list[str], path: str) -> None:
    """One feature a line (GeoJSON text sequence), however many there are (K6)."""
    df.select(feature(geometry, properties).alias("value")).write.mode("overwrite").text(path)


def feature_collection(df: DataFrame, geometry: Column, properties: list[str], by: str, order: str) -> DataFrame:
    """(by, collection): a FeatureCollection of each ``by``, a file's worth of features each (K6)."""
    one = df.select(by, F.struct(F.col(order).alias("k"), feature(geometry, properties).alias("f")).alias("x")).groupBy(by).agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return one.select(by, F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.transform("xs", lambda x: x["f"]), ","), F.lit("]}")).alias("collection"))


def escaped(text: Column) -> Column:
    """XML text: &, <, > and double quotes (K9)."""
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def atom_feeds(entries: DataFrame, by: str, authority: str, size: int = 50, *, title: str = "Projects of", author: str = "cumload", base: str = "https://example.org") -> DataFrame:
    """(by, n, feed): an Atom 1.0 document of the ``size`` newest entries of each feed.

    ``entries``: by, id, published (date), title, url, summary, category. The feed has what RFC 4287 asks for: id,
    title, updated, author, and links to itself and its page.
    """
    w = Window.partitionBy(by).orderBy(F.desc("published"), F.desc("id"))
    stamp = lambda d: F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    text = F.concat(
        F.lit(f"<entry><id>{authority}:entry/"), F.col("id").cast("string"), F.lit("</id><title>"), escaped(F.coalesce("title", F.lit(""))), F.lit("</title><updated>"), stamp("published"),
        F.lit('</updated><link rel="alternate" href="'), escaped(F.coalesce("url", F.lit(""))), F.lit('"/><category term="'), escaped(F.coalesce("category", F.lit(""))), F.lit('"/><summary type="text">'), escaped(F.coalesce("summary", F.lit(""))), F.lit("</summary></entry>"),
    )
    newest = entries.withColumn("r", F.row_number().over(w)).where(F.col("r") <= size).withColumn("x", F.struct("r", text.alias("t")))
    feeds = newest.groupBy(by).agg(F.count("*").alias("n"), stamp(F.max("published")).alias("updated"), F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "\n").alias("body"))
    head = F.concat(F.lit(f'<?xml version="1.0" encoding="utf-8"?>\n<feed xmlns="http://www.w3.org/2005/Atom"><id>{authority}:feed/'), escaped(F.col(by).cast("string")), F.lit(f"</id><title>{escape(title)} "), escaped(F.col(by).cast("string")), F.lit("</title><updated>"), F.col("updated"), F.lit(f'</updated><author><name>{escape(author)}</name></author><link rel="self" href="{escape(base)}/feed/'), escaped(F.col(by).cast("string")), F.lit(f'.xml"/><link rel="alternate" href="{escape(base)}/'), escaped(F.col(by).cast("string")), F.lit('"/>\n'))
    return feeds.select(by, "n", F.concat(head, F.col("body"), F.lit("\n</feed>")).alias("feed"))


def rewritten(rows: DataFrame, column: str, prefix: str, old: str, new: str) -> DataFrame:
    """Replace ``old`` in URLs that start with ``prefix``."""
    url = F.col(column)
    return rows.withColumn(column, F.when(url.startswith(prefix), F.replace(url, F.lit(old), F.lit(new))).otherwise(url))


def write_once(make: Callable[[], DataFrame], path: str, spark: SparkSession, refresh: bool = False) -> bool:
    """Write an expensive layer unless it is there; says whether it wrote."""
    if exists(spark, path + "/_SUCCESS") and not refresh:
        return False
    make().write.mode("overwrite").parquet(path)
    return True


def newest_by_source(rows: DataFrame, source: str, day: str) -> DataFrame:
    """source, n, newest of each source and of all (K7, A27), in one pass with partial sums."""
    each = rows.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"), F.max(day).alias("newest"))
    return each.unionByName(each.agg(F.lit("ALL").alias("source"), F.sum("n").alias("n"), F.max("newest").alias("newest")).select("source", "n", "newest"))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path, as the file system counts them (K7)."""
    fs, where = _fs(spark, path)
    return int(fs.getContentSummary(where).getLength())


def export_all(tables: Mapping[str, DataFrame], folder: str, dates: Mapping[str, str]) -> DataFrame:
    """Write all tables, then a manifest (name, n, newest, bytes) counted on what was written (K7, K8). ``dates``: date column of the tables that have one."""
    spark, parts = next(iter(tables.values())).sparkSession, []
    missing = [n for n, c in dates.items() if c not in tables[n].columns]
    if missing:
        raise ValueError(f"no date column in {missing}")
    for name, df in tables.items():
        replace_table(df, f"{folder}/{name}")
        newest = F.max(dates[name]).cast("date") if name in dates else F.lit(None).cast("date")
        size = F.lit(stored_bytes(spark, f"{folder}/{name}"))
        parts.append(spark.read.parquet(f"{folder}/{name}").agg(F.count("*").alias("n"), newest.alias("newest")).select(F.lit(name).alias("name"), "n", "newest", size.alias("bytes")))
    manifest = parts[0]
    for p in parts[1:]:
        manifest = manifest.unionByName(p)
    manifest.coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")
    return spark.read.schema("name string, n long, newest date, bytes long").json(f"{folder}/manifest")
