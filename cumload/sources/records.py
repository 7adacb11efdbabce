"""Readers of landed files (S1 to S4, S6, S8, S10, S12, S13). Fetching over HTTP is a job of its own; these read what it landed."""

from __future__ import annotations

import datetime as dt
import json
import struct
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, StringType, StructField, StructType

#: Coordinate systems that the readers accept; others are an error.
KNOWN_CRS = ("urn:ogc:def:crs:OGC:1.3:CRS84", "urn:ogc:def:crs:EPSG::4326", "EPSG:4326")


def _texts(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def issue_days(spark: SparkSession, first: str, last: str, landed: DataFrame) -> DataFrame:
    """Days from first to last with their landed summary; days without an issue have none (S1). ``landed``: day, summary."""
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("day"))
    return days.join(landed, "day", "left")


def section_label(name: Column) -> Column:
    """'III. Otras disposiciones' is section III (S3)."""
    return F.trim(F.split_part(name, F.lit("."), F.lit(1)))


def _walk(node, section, department, out):
    if isinstance(node, list):
        for each in node:
            _walk(each, section, department, out)
    elif isinstance(node, dict):
        for name, child in node.items():
            for each in child if isinstance(child, list) else [child]:
                named = each.get("nombre") if isinstance(each, dict) else None
                if name == "item" and isinstance(each, dict):
                    out.append((section, department, each.get("identificador"), each.get("titulo"), each.get("url_html")))
                else:
                    _walk(each, named if name == "seccion" else section, named if name == "departamento" else department, out)
    return out


@F.pandas_udf(ArrayType(_texts("section", "department", "id", "title", "url")))
def items(summaries: pd.Series) -> pd.Series:
    """Items at any depth of a summary's JSON, each with its section and department; a child may be an object or a list."""
    return summaries.map(lambda s: [] if s is None else _walk(json.loads(s), None, None, []))


def _document(raw):
    try:
        root = ET.fromstring(raw or "")
    except ET.ParseError:
        return (None,) * 5
    meta = lambda tag: root.findtext(f"metadatos/{tag}")
    body = root.find("texto")
    if body is None:
        raise ValueError(f"no text in document {meta('identificador')}")
    day = meta("fecha_publicacion")
    lines = [" ".join("".join(p.itertext()).split()) for p in body.iter("p")]
    return meta("identificador"), meta("titulo"), meta("departamento"), dt.datetime.strptime(day, "%Y%m%d").date() if day else None, "\n".join(x for x in lines if x)


@F.pandas_udf(_texts("id", "title", "department").add("published", DateType()).add("text", StringType()))
def xml_document(raw: pd.Series) -> pd.DataFrame:
    """A document's metadata, its day, and the paragraphs of its own text; nulls for broken XML, an error for one without a text."""
    return pd.DataFrame([_document(x) for x in raw], columns=["id", "title", "department", "published", "text"])


def search_records(pages: DataFrame) -> DataFrame:
    """Records of landed search pages (column ``value``: JSON): tags stripped, dates read, text falls back to the body."""
    shape = "results array<struct<id string, title string, date string, body string, bodyNoHtml string, pdf array<struct<publicUrl string>>>>"
    r = pages.select(F.explode(F.from_json("value", shape)["results"]).alias("r"))
    bare = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " "))
    text = F.coalesce(F.nullif(F.col("r.bodyNoHtml"), F.lit("")), bare(F.col("r.body")), F.lit(""))
    return r.select("r.id", bare(F.col("r.title")).alias("title"), F.to_date("r.date", "dd/MM/yyyy").alias("published"), F.get("r.pdf", 0)["publicUrl"].alias("url"), text.alias("text"))


def features(spark: SparkSession, path: str) -> DataFrame:
    """Features of GeoJSON files: properties (map), kind, coordinates (JSON text). An unknown coordinate system fails."""
    shape = "crs struct<properties struct<name string>>, features array<struct<properties map<string,string>, geometry struct<type string, coordinates string>>>"
    one = spark.read.text(path, wholetext=True).select(F.from_json("value", shape).alias("c"))
    crs = F.col("c.crs.properties.name")
    known = F.when(crs.isNull() | crs.isin(*KNOWN_CRS), True).otherwise(F.raise_error(F.concat(F.lit("unknown coordinate system: "), crs)).cast("boolean"))
    return one.where(known).select(F.explode("c.features").alias("f")).select("f.properties", F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"))


def dimension(spark: SparkSession, path: str, key: str, required: str) -> DataFrame:
    """A small CSV table with # comments; repeated keys and rows without ``required`` are errors."""
    rows = spark.read.csv(path, header=True, comment="#")
    twice = [r[0] for r in rows.groupBy(key).count().where("count > 1").limit(5).collect()]
    bare = [r[0] for r in rows.where(F.coalesce(F.trim(required), F.lit("")) == "").select(key).limit(5).collect()]
    if twice or bare:
        raise ValueError(f"{path}: repeated {key} {twice}, without {required} {bare}")
    return rows


def typed(spark: SparkSession, path: str, schema: str, kind: str = "csv") -> DataFrame:
    """CSV or JSON rows of a schema; the first row that does not fit fails with its text."""
    options = {"header": True} if kind == "csv" else {}
    rows = spark.read.schema(f"{schema}, _corrupt string").options(columnNameOfCorruptRecord="_corrupt", mode="PERMISSIVE", **options).format(kind).load(path)
    fits = F.when(F.col("_corrupt").isNull(), True).otherwise(F.raise_error(F.concat(F.lit("row does not fit: "), F.col("_corrupt"))).cast("boolean"))
    return rows.where(fits).drop("_corrupt")


def keyed_cells(spark: SparkSession, path: str, cell: str, key: str = "area") -> DataFrame:
    """Cells of a JSON object {area: {cells: [...]}}, one row each (S13). ``cell``: fields of a cell as DDL."""
    one = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string, struct<cells: array<struct<{cell}>>>>")).alias(key, "v"))
    return one.select(key, F.inline("v.cells"))


def previous(spark: SparkSession, path: str, schema: str, kind: str = "csv") -> DataFrame:
    """The last run's export, no rows where there is none yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    return typed(spark, path, schema, kind) if there else spark.createDataFrame([], schema)


def shapefile(spark: SparkSession, path: str) -> DataFrame:
    """name, record, rings of the polygons of .shp files (S8): one file a task, records in order; other shapes are an error."""

    def read(batches):
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                data, at, rows = bytes(content), 100, []
                while at < len(data):
                    number, words = struct.unpack_from(">ii", data, at)
                    kind = struct.unpack_from("<i", data, at + 8)[0]
                    if kind == 5:
                        parts, count = struct.unpack_from("<ii", data, at + 44)
                        starts = [*struct.unpack_from(f"<{parts}i", data, at + 52), count]
                        flat = struct.unpack_from(f"<{2 * count}d", data, at + 52 + 4 * parts)
                        # a ring's last point repeats its first
                        rows.append((name, number, [[{"x": flat[2 * k], "y": flat[2 * k + 1]} for k in range(a, b - 1)] for a, b in zip(starts[:-1], starts[1:], strict=True)]))
                    elif kind:
                        raise ValueError(f"{name}: shape {kind} of record {number} is no polygon")
                    at += 8 + 2 * words
                yield pd.DataFrame(rows, columns=["name", "record", "rings"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.shp").load(path).select("path", "content")
    return files.mapInPandas(read, "name string, record int, rings array<array<struct<x:double,y:double>>>")
