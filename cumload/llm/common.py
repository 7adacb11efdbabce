"""Shared pieces of the training-data operators: tables, checkpoints, positions."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word, as the result contracts define it: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of rows that go to a Python worker at a time. The session's own bound is 10,000 rows, which are 33 MB of texts
#: of 3 kB: the executor holds them beside its heap, the worker once more.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let batches for Python end at BATCH_BYTES, unless the session names a bound of its own."""
    if "spark.sql.execution.arrow.maxBytesPerBatch" not in spark.conf.getAll:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` in the shared folder that the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only where nothing is
    set and the master is local (tests) a temporary folder is used. The files
    go when the DataFrame is no longer referenced, if the cluster cleans
    checkpoints.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="cumload-"))
    return df.checkpoint()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """For each name one like it that is no column of ``df``, whatever the case: what an operator adds beside a user's columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def words(text: str | Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_positions(df: DataFrame, key: str, order: Sequence[str | Column], weight: str | None = None, *, rows: int, bucket_rows: int = 2048) -> DataFrame:
    """Add ``position``: the sum of ``weight`` (or the row count) before each row of its key.

    A window over a whole key would put a hot key into one task, so rows are
    first dealt by hash into buckets of about ``bucket_rows`` rows; the sums of
    the buckets (a few rows) give each bucket's start, and only the rows of one
    bucket meet in a window. ``order`` must be total up to rows that are alike
    in everything used later; it also decides the bucket, so reruns agree.
    """
    n = max(1, -(-rows // bucket_rows))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(7), *order), F.lit(n)).cast("int"))
    amount = F.col(weight) if weight else F.lit(1).cast("long")
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(key, "_bucket").agg(F.sum(amount).alias("_sum")).select(key, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(key, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_before", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    return placed.join(starts, [key, "_bucket"]).withColumn("position", F.col("_start") + F.col("_before")).drop("_bucket", "_start", "_before")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder, for files that are not tables."""
    import uuid

    checkpointed(spark.range(0))  # so that the folder is set
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"
