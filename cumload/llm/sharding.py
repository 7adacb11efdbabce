"""Sharding by jump consistent hashing (operator 3).

A document's shard depends on its key and the shard count alone: no ring
table is kept, and one more shard takes rows only into itself, about one row
in (count + 1).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumload.llm.common import checkpointed, running_positions


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards in range(shards) of 64-bit keys (Lamping and Veach, 2014)."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    at, ahead = np.zeros(len(state), dtype=np.int64), np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    while len(live):
        at[live] = ahead[live]
        state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((state[live] >> np.uint64(33)).astype(np.float64) + 1.0)
        ahead[live] = np.minimum((at[live] + 1) * step, 2.0**62).astype(np.int64)
        live = live[ahead[live] < shards]
    return at


def jump_shard(key: Column, shards: int) -> Column:
    """Column of shards for a column of keys of any type; null is a key like any other."""

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(dtype=np.int64), shards).astype(np.int32))

    return place(F.xxhash64(key))


def shard(docs: DataFrame, shards: int = 16, *, key: str = "doc_id") -> DataFrame:
    """Add ``shard`` (and nothing else): a projection without a shuffle."""
    return docs.withColumn("shard", jump_shard(F.col(key), shards))


def slots(docs: DataFrame, shards: int = 16, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One narrow row per document: its key, size, text checksum, shard, slot in the shard, and its shard in a grown set.

    Defined cases: a null text has size 1 and the checksum of no bytes; null
    keys hash like any value; rows with equal keys go to one shard and get
    slots of their own; an empty table gives no rows.
    """
    body = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    # jump hashing takes under a microsecond a row; two columns in one pass need one exchange with Python
    narrow = checkpointed(docs.select(F.col(key), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).cast("long").alias("text_crc32"), jump_shard(F.col(key), shards).alias("shard"), jump_shard(F.col(key), shards + 1).alias("grown_shard")))
    return running_positions(narrow, "shard", [key, "text_crc32", "size"], rows=narrow.count()).withColumnRenamed("position", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = 16, *, key: str = "doc_id", max_rows: int = 1_000_000) -> None:
    """Write ``docs`` as Parquet below ``path``/shard=N; files of one shard are bounded and written by many tasks."""
    shard(docs, shards, key=key).write.option("maxRecordsPerFile", max_rows).partitionBy("shard").mode("overwrite").parquet(path)
