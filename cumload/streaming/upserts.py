"""Streaming forms of the upserts: a log of changes by batch, and late rows within a watermark (K1, K2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cumload.sources.sinks import exists


def latest(spark: SparkSession, log: str, key: str) -> DataFrame:
    """Current row of each key in a log."""
    rows = spark.read.parquet(log)
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("batch")))).where("_r = 1").drop("_r")


def apply_batch(batch: DataFrame, number: int, log: str, key: str, order: str, content: str) -> None:
    """Append the keys whose newest content differs from the log's.

    A batch owns its folder and compares with earlier batches only, so replaying it after a failure writes the same
    rows again instead of twice. ``order`` ranks rows of one key within a batch. Rows without a key are refused: they
    could never be updated.
    """
    spark = batch.sparkSession
    cols = batch.columns
    newest = batch.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*cols), F.struct(F.col(order), F.col(content))).alias("_row")).select("_row.*")
    new = newest.withColumn("_hash", F.sha2(F.coalesce(F.col(content).cast("string"), F.lit("")), 256))
    if number and exists(spark, log):
        held = spark.read.parquet(log).where(F.col("batch") < number)
        seen = held.groupBy(F.col(key).alias("_key")).agg(F.max_by("_hash", "batch").alias("_old"), F.max("_attempts").alias("_tries"))
        new = new.join(seen, new[key] == seen["_key"], "left").where("_old IS NULL OR _old <> _hash")
    else:
        new = new.withColumn("_tries", F.lit(0))
    out = new.select(*cols, "_hash", (F.coalesce("_tries", F.lit(0)) + 1).cast("int").alias("_attempts"))
    out.write.mode("overwrite").parquet(f"{log}/batch={number}")


def upsert_stream(stream: DataFrame, log: str, checkpoint: str, key: str, order: str, content: str) -> StreamingQuery:
    """Run all that is there through ``apply_batch``, then stop."""
    return stream.writeStream.foreachBatch(lambda b, n: apply_batch(b, n, log, key, order, content)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def still_valid(derived: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Derived rows whose source has not changed since (hash-guarded invalidation). ``derived``: key, _hash of the text it was made from."""
    return derived.join(current.select(key, "_hash"), [key, "_hash"], "left_semi")


def recent_once(stream: DataFrame, when: str, key: list[str], delay: str = "14 days") -> DataFrame:
    """Rows once per key while re-reads of the last two weeks repeat them."""
    return stream.withWatermark(when, delay).dropDuplicatesWithinWatermark(key)
