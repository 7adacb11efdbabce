"""Approximate nearest neighbours by randomly rotated one-bit codes (operator 2).

Vectors are centred, rotated at random (short ones are padded first, so a code
has at least ``code_bits`` bits) and reduced to the signs of their
coordinates, packed into bytes, with two correction scalars: the distance to
the centre, and the inner product of the unit vector with its own code. The
inner product with a query is estimated from the packed bits and the scalars,
with an error bound; only vectors whose bound reaches the best upper bounds
are compared exactly. Codes are made and stored once; tasks that estimate get
codes alone, and the vectors are fetched for what passes the bounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumload.llm.common import checkpointed

#: Deviations of the estimator that its bound covers (Gao and Long, 2024, use 1.9).
EPSILON = 1.9


def rotation(bits: int, seed: int) -> np.ndarray:
    """A random rotation of ``bits`` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, distances to the centre, inner products of unit vectors with their codes)."""
    away = vectors - centre
    norm = np.sqrt((away * away).sum(axis=1))
    turned = (away / np.where(norm > 0, norm, 1.0)[:, None]) @ turn[: vectors.shape[1]]
    own = np.abs(turned).sum(axis=1) / math.sqrt(turn.shape[0])
    return np.packbits(turned >= 0, axis=1), norm, np.where(norm > 0, own, 1.0)


def estimate(queries: np.ndarray, codes: np.ndarray, norm: np.ndarray, own: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated squared distances of queries (rows) to coded vectors (columns), and their error bounds."""
    bits = turn.shape[0]
    away = queries - centre
    far = np.sqrt((away * away).sum(axis=1))
    turned = (away @ turn[: queries.shape[1]]).astype(np.float32)
    signs = np.unpackbits(codes, axis=1, count=bits).astype(np.float32) * 2 - 1
    inner = (turned @ signs.T) / math.sqrt(bits) / own
    spread = np.sqrt(np.maximum(1 - own * own, 0)) / own * EPSILON / math.sqrt(bits - 1)
    return far[:, None] ** 2 + norm**2 - 2 * norm * inner, 2 * np.outer(far, norm * spread)


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, v (array of double), size: without vectors that are null, zero, empty or hold null or non-finite components."""
    x = embeddings.select("vec_id", F.col(vector).cast("array<double>").alias("v")).where(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    return x.where(finite & F.exists("v", lambda c: c != 0)).withColumn("size", F.size("v"))


def _width(size: int, code_bits: int) -> int:
    return -(-max(code_bits, size) // 8) * 8


def codes(rows: DataFrame, centres: dict[int, np.ndarray], *, code_bits: int, seed: int) -> DataFrame:
    """vec_id, size, same (a hash of the vector), code (packed bits), norm, own: one narrow row per vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for n in np.unique(sizes):
                part = batch.filter(pa.array(sizes == n))
                turn = turns.setdefault(int(n), rotation(_width(int(n), code_bits), seed))
                packed, norm, own = encode(part.column("v").flatten().to_numpy().reshape(-1, int(n)), centres[int(n)], turn)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("size"), part.column("same"), pa.array([c.tobytes() for c in packed], pa.binary()), pa.array(norm), pa.array(own)], ["vec_id", "size", "same", "code", "norm", "own"])

    return rows.select("vec_id", "size", F.xxhash64("v").alias("same"), "v").mapInArrow(run, "vec_id long, size int, same long, code binary, norm double, own double")


def search(embeddings: DataFrame, *, k: int = 10, every: int = 100, vector: str = "embedding", code_bits: int = 512, block_rows: int = 16384, query_rows: int = 4096, seed: int = 5) -> DataFrame:
    """The ``k`` nearest rows of each row whose vec_id ``every`` divides: query_id, rank, vec_id, score.

    Queries and codes are dealt by hash into blocks and each pair of blocks is
    one task's work, so neither side is ever gathered or broadcast. A code is
    sent once per query block (80 bytes at 512 bits), a vector only to queries
    whose bounds it passes; those are reranked in double precision.

    Defined cases: vectors that are null, empty, zero or not finite take no
    part; vectors are compared with vectors of their own length alone; a query
    never finds rows of its own vec_id; of rows with one vec_id, each is a
    candidate and the one with the smallest vector asks; of equal vectors only
    the ``k`` + 1 smallest ids can be among the nearest, so the others are left
    out before the search; fewer candidates than ``k`` are all returned; an
    empty table gives no rows. The centre is the mean of all vectors of a
    length: one small row per length.
    """
    rows = checkpointed(usable(embeddings, vector))
    found = {r["size"]: r for r in rows.groupBy("size").agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("asked")).collect()}
    mean = rows.select("size", F.posexplode("v")).groupBy("size", "pos").agg(F.avg("col").alias("m")).collect()
    centres = {n: np.array([m.m for m in sorted((m for m in mean if m["size"] == n), key=lambda m: m.pos)]) for n in found}
    blocks = {n: (-(-r["asked"] // query_rows), -(-r.n // block_rows)) for n, r in found.items() if r["asked"]}
    spark = embeddings.sparkSession
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    grid = spark.createDataFrame([(n, q, c) for n, (q, c) in blocks.items()], "g_size int, q_blocks int, c_blocks int")

    def block(salt: int, of: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.col(of)).cast("int")

    def gridded(df: DataFrame) -> DataFrame:  # the grid has one row per vector length that has queries
        return df.join(F.broadcast(grid), F.col("size") == F.col("g_size"))

    asked = checkpointed(gridded(rows.where(F.col("vec_id") % every == 0)).groupBy("size", "vec_id", "q_blocks", "c_blocks").agg(F.min("v").alias("v")).select("size", F.col("vec_id").alias("q_id"), block(1, "q_blocks").alias("qb"), "c_blocks", F.col("v").alias("q_v")))
    queries = asked.select(F.col("size").alias("q_size"), "qb", F.explode(F.sequence(F.lit(0), F.col("c_blocks") - 1)).alias("cb"), "q_id", "q_v")
    alike = Window.partitionBy("size", "same", "code", "norm").orderBy("vec_id")
    coded = codes(rows, centres, code_bits=code_bits, seed=seed).withColumn("_nth", F.dense_rank().over(alike)).where(F.col("_nth") <= k + 1).drop("_nth").distinct()
    pool = gridded(checkpointed(coded)).select(F.col("size").alias("p_size"), F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("p_qb"), block(2, "c_blocks").alias("p_cb"), F.col("vec_id").alias("p_id"), "code", "norm", "own")

    def plausible(key: tuple, ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        """Candidates of each query that its bounds leave in this block, and the k-th upper bound here."""
        out = {"query_id": [np.empty(0, np.int64)], "vec_id": [np.empty(0, np.int64)], "lower": [np.empty(0)], "limit": [np.empty(0)]}
        if len(ask) and len(have):
            centre = centres[key[0]]
            turn = rotation(_width(len(centre), code_bits), seed)
            q, ids, asking = np.stack(ask["q_v"].to_numpy()), have["p_id"].to_numpy(), ask["q_id"].to_numpy()
            packed = np.frombuffer(b"".join(have["code"]), dtype=np.uint8).reshape(len(have), -1)
            for at in range(0, len(q), 128):
                about, error = estimate(q[at : at + 128], packed, have["norm"].to_numpy(), have["own"].to_numpy(), centre, turn)
                other = ids[None, :] != asking[at : at + 128, None]
                upper = np.where(other, about + error, np.inf)
                limit = np.partition(upper, k - 1, axis=1)[:, k - 1] if upper.shape[1] > k else np.full(len(upper), np.inf)
                row, column = np.nonzero(other & (about - error <= limit[:, None]))
                for name, values in zip(out, (asking[at + row], ids[column], (about - error)[row, column], limit[row]), strict=True):
                    out[name].append(values)
        return pd.DataFrame({name: np.concatenate(parts) for name, parts in out.items()})

    def exact(key: tuple, ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        if not len(ask) or not len(have):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        place = {q: i for i, q in enumerate(ask["q_id"])}
        q, which = np.stack(ask["q_v"].to_numpy()), have["query_id"].map(place).to_numpy()
        x = np.stack(have["v"].to_numpy())
        scores = np.concatenate([np.sqrt(((x[at : at + 8192] - q[which[at : at + 8192]]) ** 2).sum(axis=1)) for at in range(0, len(x), 8192)])
        return pd.DataFrame({"query_id": have["query_id"], "vec_id": have["vec_id"], "score": scores})

    near = checkpointed(queries.groupBy("q_size", "qb", "cb").cogroup(pool.groupBy("p_size", "p_qb", "p_cb")).applyInPandas(plausible, "query_id long, vec_id long, lower double, limit double"))
    # a query's bound over all blocks: the least of the blocks' k-th upper bounds, combined before the shuffle
    best = near.groupBy(F.col("query_id").alias("_q")).agg(F.min("limit").alias("_best"))
    passed = near.join(best, F.col("query_id") == F.col("_q")).where(F.col("lower") <= F.col("_best")).select("query_id", "vec_id").distinct()
    places = asked.select(F.col("q_id").alias("_q"), F.col("size").alias("_size"), "qb")
    pairs = passed.join(places, F.col("query_id") == F.col("_q")).join(rows.withColumnRenamed("vec_id", "_id"), (F.col("vec_id") == F.col("_id")) & (F.col("size") == F.col("_size")))
    # the survivors of a query block are dealt on into parts, so none of them grows with the table
    parts = max(c for _, c in blocks.values())
    part = F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(parts)).cast("int")
    fetched = pairs.select(F.col("_size").alias("p_size"), F.col("qb").alias("p_qb"), part.alias("p_part"), "query_id", "vec_id", "v")
    around = asked.select(F.col("size").alias("q_size"), "qb", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "q_id", "q_v")
    scored = around.groupBy("q_size", "qb", "part").cogroup(fetched.groupBy("p_size", "p_qb", "p_part")).applyInPandas(exact, "query_id long, vec_id long, score double")
    top = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return scored.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
