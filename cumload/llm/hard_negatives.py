"""Hard negatives by product quantisation with stored residual norms (operator 13).

Vectors become integers. A code names, for each pair of components, one of 256
integer centroids; beside it stands the norm of what the code leaves out. An
anchor's inner product with a coded row is the sum of table entries, and the
product of the anchor's norm with the residual norm bounds what is missing, so
that a row is left out only when no value within the bound could be among the
wanted ones. What is left is scored exactly, in integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumload.llm.common import checkpointed

#: Components that share a centroid, and centroids of each such pair (their number is one byte of a code).
PAIR, CENTROIDS = 2, 256


def usable(embeddings: DataFrame, *, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, label, size, v (array of long): rows whose label, id and components are all there and finite.

    Of rows with one vec_id the one with the smallest label and vector takes part.
    """
    x = embeddings.select("vec_id", "label", F.col(vector).cast("array<double>").alias("x")).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull())
    whole = x.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))))
    rows = whole.select("vec_id", "label", F.size("x").alias("size"), F.transform("x", lambda c: F.floor(scale * c)).alias("v"))
    if whole.groupBy("vec_id").count().where(F.col("count") > 1).isEmpty():
        return rows
    first = Window.partitionBy("vec_id").orderBy("label", "v")
    return rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") == 1).drop("_n")


def _padded(flat: np.ndarray, n: int, size: int) -> np.ndarray:
    """(n, pairs, PAIR) of the components, zeros after the last."""
    pairs = max(1, -(-size // PAIR))
    out = np.zeros((n, pairs * PAIR), dtype=np.int64)
    out[:, :size] = flat.reshape(n, size)
    return out.reshape(n, pairs, PAIR)


def centroids(points: np.ndarray, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """At most CENTROIDS integer centroids of integer points (k-means); few distinct points are their own."""
    distinct = np.unique(points, axis=0)
    if len(distinct) <= CENTROIDS:
        return distinct
    at = distinct[np.random.default_rng(seed).choice(len(distinct), CENTROIDS, replace=False)].astype(np.float64)
    for _ in range(rounds):
        near = nearest(points, at)
        n = np.bincount(near, minlength=CENTROIDS)
        for k in range(points.shape[1]):
            at[:, k] = np.where(n > 0, np.bincount(near, points[:, k], CENTROIDS) / np.maximum(n, 1), at[:, k])
    return np.unique(np.rint(at).astype(np.int64), axis=0)


def nearest(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The nearest centroid of each point."""
    p, c = points.astype(np.float64), at.astype(np.float64)
    return np.concatenate([np.argmin((c * c).sum(axis=1) - 2 * (p[i : i + 4096] @ c.T), axis=1) for i in range(0, len(p), 4096)]) if len(p) else np.empty(0, np.int64)


def codebooks(rows: DataFrame, sizes: list[int], *, sample_rows: int) -> dict[int, np.ndarray]:
    """For each vector length the centroids of each pair, fitted on the ``sample_rows`` rows whose vec_id hashes lowest.

    Each pair is fitted in a task of its own; (pairs, CENTROIDS, PAIR), short books filled up with their last centroid.
    """

    def fit(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        found = centroids(np.stack(part["xy"].to_numpy()).astype(np.int64))
        return pd.DataFrame({"size": key[0], "pair": key[1], "c": range(len(found)), "xy": list(found)})

    out = {}
    for n in sizes:
        pairs = max(1, -(-n // PAIR))
        full = F.concat("v", F.array_repeat(F.lit(0).cast("long"), pairs * PAIR - n))
        cut = F.transform(F.sequence(F.lit(0), F.lit(pairs - 1)), lambda k: F.slice(full, k * PAIR + 1, PAIR))
        sample = rows.where(F.col("size") == n).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows)
        fitted = sample.select("size", F.posexplode(cut).alias("pair", "xy")).groupBy("size", "pair").applyInPandas(fit, "size int, pair int, c int, xy array<long>").collect()
        book = np.zeros((pairs, CENTROIDS, PAIR), dtype=np.int64)
        for r in sorted(fitted, key=lambda r: (r.pair, r.c)):
            book[r.pair, r.c :] = r.xy
        out[n] = book
    return out


def encode(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (n, pairs) of integer vectors (n, pairs, PAIR), and the norms of their residuals, rounded up."""
    code = np.stack([nearest(x[:, m], book[m]) for m in range(x.shape[1])], axis=1).astype(np.uint8)
    left = (x - book[np.arange(x.shape[1]), code]).astype(np.float64)
    return code, np.sqrt((left * left).sum(axis=(1, 2))) * (1 + 1e-9)


def coded(rows: DataFrame, books: dict[int, np.ndarray]) -> DataFrame:
    """vec_id, label, size, vec (packed 64-, 32- or 16-bit integers), code, residual: one row per vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for n in np.unique(sizes):
                part = batch.filter(pa.array(sizes == n))
                x = _padded(part.column("v").flatten().to_numpy(zero_copy_only=False), part.num_rows, int(n))
                code, residual = encode(x, books[int(n)])
                most = np.abs(x).max(axis=(1, 2))
                packed = [r.astype("<i2" if m < 1 << 15 else "<i4" if m < 1 << 31 else "<i8").tobytes() for r, m in zip(x.reshape(len(x), -1), most, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("vec_id", "label", "size")), pa.array(packed, pa.binary()), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(residual)], ["vec_id", "label", "size", "vec", "code", "residual"])

    return rows.mapInArrow(run, f"vec_id {dict(rows.dtypes)['vec_id']}, label {dict(rows.dtypes)['label']}, size int, vec binary, code binary, residual double")


def unpacked(vecs: pd.Series, pairs: int) -> np.ndarray:
    """(n, pairs * PAIR) integers of packed vectors."""
    width = pairs * PAIR
    out = np.empty((len(vecs), width), dtype=np.int64)
    lengths = vecs.map(len).to_numpy()
    for kind, n in (("<i2", 2), ("<i4", 4), ("<i8", 8)):
        if (own := lengths == n * width).any():
            out[own] = np.frombuffer(b"".join(vecs[own]), dtype=kind).reshape(-1, width)
    return out


@dataclass
class Block:
    """Rows of one block: ids, labels, integer vectors, codes by pair and residual norms."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    codes: np.ndarray
    residual: np.ndarray

    @classmethod
    def of(cls, have: pd.DataFrame, pairs: int) -> Block:
        codes = np.frombuffer(b"".join(have["code"]), dtype=np.uint8).reshape(len(have), pairs)
        return cls(have["p_id"].to_numpy(), have["p_label"].to_numpy(), unpacked(have["vec"], pairs), np.ascontiguousarray(codes.T), have["residual"].to_numpy())

    def take(self, rows: np.ndarray) -> Block:
        return Block(self.ids[rows], self.labels[rows], self.vectors[rows], np.ascontiguousarray(self.codes[:, rows]), self.residual[rows])

    def bounds(self, anchors: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (anchors, rows) of the inner products: sums of table entries, less and plus the residual bound."""
        q = anchors.reshape(len(anchors), -1, PAIR).astype(np.float64)
        tables = np.einsum("amk,mck->mac", q, book.astype(np.float64))
        about = np.zeros((len(anchors), len(self.ids)))
        for table, code in zip(tables, self.codes, strict=True):
            about += table.take(code, axis=1)
        norm = np.sqrt((q * q).sum(axis=(1, 2)))
        # sums of integers are exact below 2 ** 53; beyond, they are off by less than this share
        slack = np.abs(about) * 1e-9 + np.outer(norm, self.residual) * (1 + 1e-9) + 1e-6
        return about - slack, about + slack

    def exact(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.vectors[rows] @ anchor


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th largest, minus infinity if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -math.inf


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties by smaller id."""
    some = np.flatnonzero(scores >= _kth(scores, k))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def nearest_alike(anchors: np.ndarray, ids: np.ndarray, labels: np.ndarray, block: Block, book: np.ndarray, k: int) -> Iterator[tuple]:
    """(anchor, row, score) for the k best rows of each anchor's own label in a block."""
    for label in np.unique(labels):
        asking, rows = np.flatnonzero(labels == label), np.flatnonzero(block.labels == label)
        if not len(rows):
            continue
        own = block.take(rows)
        for at in range(0, len(asking), 64):
            group = asking[at : at + 64]
            low, high = own.bounds(anchors[group], book)
            for a, lo, hi in zip(group, low, high, strict=True):
                other = own.ids != ids[a]
                left = np.flatnonzero(other & (hi >= _kth(lo[other], k)))
                scores = own.exact(anchors[a], left)
                for i in _best(scores, own.ids[left], k):
                    yield ids[a], own.ids[left[i]], scores[i]


def within_windows(anchors: np.ndarray, ids: np.ndarray, labels: np.ndarray, windows: list, block: Block, book: np.ndarray, k: int) -> Iterator[tuple]:
    """(anchor, positive, row, positive's score, score) for the k best rows of other labels in each window of an anchor."""
    for at in range(0, len(ids), 64):
        low, high = block.bounds(anchors[at : at + 64], book)
        for a, lo, hi in zip(range(at, at + len(low)), low, high, strict=True):
            other = block.labels != labels[a]
            wanted = []
            left = np.zeros(len(other), dtype=bool)
            for positive, score, least, most in windows[a]:
                if least > most:
                    continue
                inside = lo[other & (lo >= least) & (hi <= most)]
                left |= other & (hi >= max(least, _kth(inside, k))) & (lo <= most)
                wanted.append((positive, score, least, most))
            rows = np.flatnonzero(left)
            scores = block.exact(anchors[a], rows)
            for positive, score, least, most in wanted:
                fit = np.flatnonzero((scores >= least) & (scores <= most))
                for i in fit[_best(scores[fit], block.ids[rows[fit]], k)]:
                    yield ids[a], positive, block.ids[rows[i]], score, scores[i]


def mine(embeddings: DataFrame, *, every: int = 100, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, vector: str = "embedding", scale: int = 256, relabel: tuple[int, int] | None = None, sample_rows: int = 4096, block_rows: int = 16384, anchor_rows: int = 512) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id ``every`` divides; their positives the
    first ``positives`` rows of their label. A window of an anchor and a
    positive takes scores from ``least`` to ``most`` hundredths of the
    positive's; of the rows of other labels in it the first ``negatives`` are
    returned. Higher scores come first, ties by smaller vec_id. ``relabel``
    (m, n): a label becomes (label + 1) % n where m divides vec_id.

    Anchors and rows are dealt by hash into blocks, and a pair of blocks is one
    task's work, which returns at most ``negatives`` rows for each window: no
    label, vector or window is gathered whole. Rows are sent with codes and
    packed integers, so a window whose bounds exclude little (small scores)
    costs exact products and no further shuffle. The codebooks are fitted on a
    bounded sample; all rows are coded, and the bounds hold for each.

    Defined cases: rows whose label, vector, id or any component is null or
    not finite take no part; an empty or zero vector scores 0; vectors meet
    vectors of their own length alone; of rows with one vec_id the smallest
    (label, vector) takes part; of rows alike in label and vector all but the
    first ``positives`` + 1 or ``negatives`` ids are passed over as candidates,
    since they could never be returned; other columns are ignored; vectors of
    any length are read whole; an empty table gives no rows. Components so
    large that a product may not fit a long raise an error.
    """
    rows = usable(embeddings, vector=vector, scale=scale)
    if relabel:
        kind = dict(rows.dtypes)["label"]
        rows = rows.withColumn("label", F.when(F.col("vec_id") % relabel[0] == 0, (F.col("label") + 1) % relabel[1]).otherwise(F.col("label")).cast(kind))
    rows = checkpointed(rows)
    largest = F.array_max(F.transform("v", lambda c: F.abs(c)))
    found = {r["size"]: r for r in rows.groupBy("size").agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("asked"), F.coalesce(F.max(largest), F.lit(0)).alias("most")).collect()}
    if any(max(1, n) * r.most**2 >= 1 << 63 for n, r in found.items()):
        raise ValueError("components too large: an inner product may not fit 64 bits")
    sizes = [n for n, r in found.items() if r.asked]
    spark, ids = embeddings.sparkSession, dict(rows.dtypes)["vec_id"]
    if not sizes:
        return spark.createDataFrame([], f"anchor_id {ids}, positive_id {ids}, rank int, negative_id {ids}, positive_score long, negative_score long")
    books = codebooks(rows, sizes, sample_rows=sample_rows)
    grid = spark.createDataFrame([(n, -(-found[n].asked // anchor_rows), -(-found[n].n // block_rows)) for n in sizes], "size int, q_blocks int, c_blocks int")  # a row per vector length

    def block(salt: int, of: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.col(of)).cast("int")

    stored = checkpointed(coded(rows.join(F.broadcast(grid.select("size")), "size", "left_semi").select("vec_id", "label", "size", "v"), books))
    alike = Window.partitionBy("size", "label", "vec").orderBy("vec_id")
    kept = stored.withColumn("_n", F.row_number().over(alike)).where(F.col("_n") <= max(positives + 1, negatives)).drop("_n")
    pool = checkpointed(kept.join(F.broadcast(grid), "size").select("size", "q_blocks", block(2, "c_blocks").alias("p_cb"), F.col("vec_id").alias("p_id"), F.col("label").alias("p_label"), "vec", "code", "residual"))
    spread = pool.select(F.col("size").alias("p_size"), F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("p_qb"), "p_cb", "p_id", "p_label", "vec", "code", "residual").groupBy("p_size", "p_qb", "p_cb")
    asked = stored.where(F.col("vec_id") % every == 0).join(F.broadcast(grid), "size").select("size", block(1, "q_blocks").alias("qb"), "c_blocks", F.col("vec_id").alias("a_id"), F.col("label").alias("a_label"), F.col("vec").alias("a_vec"))
    asked = checkpointed(asked)

    def per_block(df: DataFrame, *more: str):
        return df.select("size", "qb", F.explode(F.sequence(F.lit(0), F.col("c_blocks") - 1)).alias("cb"), "a_id", "a_label", "a_vec", *more).groupBy("size", "qb", "cb")

    def alike_in(key: tuple, ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        out: list = []
        if len(ask) and len(have):
            book = books[key[0]]
            out = [*nearest_alike(unpacked(ask["a_vec"], len(book)), ask["a_id"].to_numpy(), ask["a_label"].to_numpy(), Block.of(have, len(book)), book, positives)]
        return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score"])

    def inside(key: tuple, ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        out: list = []
        if len(ask) and len(have):
            book = books[key[0]]
            windows = [[(w["positive_id"], s := w["positive_score"], -(-least * s // 100), most * s // 100) for w in own] for own in ask["windows"]]
            out = [*within_windows(unpacked(ask["a_vec"], len(book)), ask["a_id"].to_numpy(), ask["a_label"].to_numpy(), windows, Block.of(have, len(book)), book, negatives)]
        return pd.DataFrame(out, columns=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    near = per_block(asked).cogroup(spread).applyInPandas(alike_in, f"anchor_id {ids}, positive_id {ids}, positive_score long")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = near.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= positives)
    windows = checkpointed(chosen.groupBy(F.col("anchor_id").alias("a_id")).agg(F.sort_array(F.collect_list(F.struct("positive_id", "positive_score"))).alias("windows")))
    hard = per_block(asked.join(windows, "a_id"), "windows").cogroup(spread).applyInPandas(inside, f"anchor_id {ids}, positive_id {ids}, negative_id {ids}, positive_score long, negative_score long")
    ranked = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return hard.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
