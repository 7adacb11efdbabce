"""Mixing sources to target weights (operator 1).

Every source's words are laid end to end and cut into blocks of a fixed
length, the last one short. Output shards draw how many blocks they take of
each source from a multinomial over what the sources owe; the blocks a source
gives are its slots 0, 1, 2 ..., and a keyed pseudorandom permutation of its
block indices, a new one for each pass over the source, maps slots to blocks;
the last slot takes only the words that are still missing. Slots and blocks
then meet in an equi-join on (source, block): no source is ever gathered,
however large. The draws are made in the tasks, each from its shards' places
in a tree of seeded draws.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumload.llm.common import checkpointed, fresh, running_positions, words
from cumload.llm.shingles import word_edges

#: No source is repeated more often than this.
MAX_EPOCHS = 3
_M = np.uint64(0xFFFFFFFFFFFFFFFF)


def targets(sizes: Mapping[str | None, int], weights: Sequence[float] = (5, 2, 1), max_epochs: float = MAX_EPOCHS) -> dict[str | None, float]:
    """Share the total size by weight; what a source cannot give goes to the others by weight.

    Sources are taken by code point, null last, and weigh ``weights`` in turn.
    """
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    total, out, free = float(sum(sizes.values())), {}, list(order)
    while free:
        rest, share = total - sum(out.values()), sum(weight[s] for s in free)
        full = [s for s in free if rest * weight[s] / share > max_epochs * sizes[s]]
        for s in full or free:
            out[s] = float(max_epochs * sizes[s]) if full else rest * weight[s] / share
        free = [s for s in free if s not in out]
    return out


def _keys(key: int) -> list[np.uint64]:
    return [np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) & int(_M)) for r in range(1, 5)]


def _rounds(left: np.ndarray, right: np.ndarray, keys: Sequence[np.uint64], mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Feistel rounds: each mixes one half, by the other, into the next."""
    for k in keys:
        h = (right + k) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        left, right = right, left ^ ((h >> np.uint64(33)) & mask)
    return left, right


def permuted(values: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """Images of ``values`` under a keyed permutation of range(n), or under its inverse: Feistel rounds, walked until inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift, keys = np.uint64((1 << half) - 1), np.uint64(half), _keys(key)

    def once(x: np.ndarray) -> np.ndarray:
        high, low = x >> shift, x & mask
        if back:  # the rounds undone are the same rounds on swapped halves, keys in reverse
            low, high = _rounds(low, high, keys[::-1], mask)
        else:
            high, low = _rounds(high, low, keys, mask)
        return (high << shift) | low

    out = once(values.astype(np.uint64))
    while (out_of := out >= np.uint64(n)).any():
        out[out_of] = once(out[out_of])
    return out.astype(np.int64)


@dataclass(frozen=True)
class Share:
    """What a source gives: its blocks, the slots that all passes take, and the words of the last slot."""

    source_key: int
    blocks: int
    slots: int
    last: int


def _key(seed: int, source_key: int, epoch: int) -> int:
    return zlib.crc32(f"{seed}:{source_key}:{epoch}".encode())


def share(source_key: int, size: int, target: float, block_words: int, seed: int) -> Share:
    """Slots that take round(target) words of a source: whole passes, then as many blocks of one more as are needed."""
    blocks, (epoch, rest) = -(-size // block_words), divmod(round(target), size)
    if not rest:
        return Share(source_key, blocks, epoch * blocks, block_words)
    short = size - (blocks - 1) * block_words
    at = int(permuted(np.array([blocks - 1]), blocks, _key(seed, source_key, epoch), back=True)[0])  # the short block's slot
    missing = block_words - short
    slots = -(-rest // block_words) if rest <= at * block_words else -(-(rest + missing) // block_words)
    before = (slots - 1) * block_words - (missing if at < slots - 1 else 0)
    return Share(source_key, blocks, epoch * blocks + slots, rest - before)


def shard_counts(owed: np.ndarray, shards: int, shard_slots: int, seed: int, low: int, high: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, first slots, slots) by source for the shards in [low, high).

    A tree over the shards: a node draws from a multinomial over what its
    sources owe how much of each goes to its left half, from a seed of its own;
    what a draw takes beyond a source is drawn again among the rest. Every
    caller sees the same tree, and descends to its own shards only.
    """
    total = int(owed.sum())

    def down(lo: int, hi: int, first: np.ndarray, has: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        if hi <= low or lo >= high:
            return
        if hi - lo == 1:
            yield lo, first, has
            return
        mid, rng, left = (lo + hi) // 2, np.random.default_rng((seed, lo, hi)), np.zeros_like(has)
        want = min(mid * shard_slots, total) - lo * shard_slots
        while (short := want - int(left.sum())) > 0:
            room = has - left
            left += np.minimum(rng.multinomial(short, room / room.sum()), room)
        yield from down(lo, mid, first, left)
        yield from down(mid, hi, first + left, has - left)

    if shards:
        yield from down(0, shards, np.zeros_like(owed), owed)


@dataclass
class Mix:
    """``sources``: source, source_size, target. ``pieces``: where each document lies in the blocks
    (doc_id, row_key, source_key, block, at, start, length). ``slots``: which block fills which slot
    (shard, slot, source_key, block, epoch, words: how many of the block's words it takes)."""

    sources: dict[str | None, tuple[int, float]]
    documents: DataFrame
    pieces: DataFrame
    slots: DataFrame
    block_words: int


def mix(docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), block_words: int = 64, shard_slots: int = 16384, max_epochs: int = MAX_EPOCHS, seed: int = 17) -> Mix:
    """Plan the mix of ``docs`` (doc_id, text, source; other columns are ignored).

    Every source gives exactly its target, rounded to a word. Defined cases:
    null source is a source of its own; null or blank texts have size 0 and no
    pieces; rows alike in doc_id, source and text are separate documents; an
    empty table gives an empty mix. What the driver holds is one row per
    source; shards and their draws exist in the tasks alone.
    """
    spark = docs.sparkSession
    sized = checkpointed(docs.select("doc_id", "source", F.xxhash64("doc_id", "source", "text").alias("row_key"), F.xxhash64("source").alias("source_key"), words("text").alias("size")))
    found = sized.groupBy("source", "source_key").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    goal = targets({r.source: r["size"] for r in found}, weights, max_epochs)
    shares = [share(r.source_key, r["size"], goal[r.source], block_words, seed) for r in sorted(found, key=lambda r: r.source_key) if r["size"]]

    placed = running_positions(sized, "source_key", ["row_key", "doc_id"], "size", rows=sum(r.n for r in found))
    first, last = F.floor(F.col("position") / block_words), F.floor((F.col("position") + F.col("size") - 1) / block_words)
    cut = placed.withColumn("block", F.explode(F.when(F.col("size") > 0, F.sequence(first, last)).otherwise(F.array(F.lit(-1).cast("long")))))
    start = F.greatest(F.col("block") * block_words - F.col("position"), F.lit(0))
    end = F.least((F.col("block") + 1) * block_words - F.col("position"), F.col("size"))
    has = F.col("block") >= 0
    at = F.greatest(F.col("position") - F.col("block") * block_words, F.lit(0))
    pieces = cut.select("doc_id", "row_key", "source_key", "source", "size", "block", F.when(has, at).otherwise(0).alias("at"), F.when(has, start).otherwise(0).alias("start"), F.when(has, end - start).otherwise(0).alias("length"))

    owed = np.array([s.slots for s in shares], dtype=np.int64)
    shards = -(-int(owed.sum()) // shard_slots)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            low, high = (int(batch["id"].min()), int(batch["id"].max()) + 1) if len(batch) else (0, 0)
            for shard, firsts, counts in shard_counts(owed, shards, shard_slots, seed, low, high):
                for i in np.flatnonzero(counts):
                    s = shares[i]
                    slot = np.arange(firsts[i], firsts[i] + counts[i], dtype=np.int64)
                    epoch, block = slot // s.blocks, np.empty_like(slot)
                    for e in np.unique(epoch):
                        block[epoch == e] = permuted(slot[epoch == e] % s.blocks, s.blocks, _key(seed, s.source_key, e))
                    yield pd.DataFrame({"shard": shard, "slot": slot, "source_key": s.source_key, "block": block, "epoch": epoch, "words": np.where(slot == s.slots - 1, s.last, block_words)})

    # a range of shards for each task: spark.range deals its ids in order, so a batch is a run of shards
    tasks = max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    slots = spark.range(0, shards, 1, tasks).mapInPandas(fill, "shard long, slot long, source_key long, block long, epoch long, words long")
    return Mix({r.source: (r["size"], goal[r.source]) for r in found}, sized, pieces, slots, block_words)


def taken(mixed: Mix) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    spark = mixed.pieces.sparkSession
    cut = F.col("words") < mixed.block_words
    times = mixed.slots.groupBy("source_key", "block").agg(F.count_if(~cut).alias("times"), F.collect_list(F.when(cut, F.col("words"))).alias("cuts"))
    # pieces are told apart by their place in the source, so documents that are alike stay apart
    # the merge hint: the planner takes the slots for as small as the shards they are made from, and would broadcast them
    partly = F.aggregate(F.coalesce("cuts", F.array().cast("array<long>")), F.lit(0).cast("long"), lambda a, w: a + F.least(F.greatest(w - F.col("at"), F.lit(0)), F.col("length")))
    used = mixed.pieces.join(times.hint("merge"), ["source_key", "block"], "left").groupBy("doc_id", "row_key", "source", "size").agg(F.sum(F.col("length") * F.coalesce("times", F.lit(0)) + partly).alias("words"))
    alike = mixed.documents.groupBy(F.col("doc_id").alias("_doc"), F.col("row_key").alias("_key")).agg(F.count("*").alias("copies"))
    # rows alike in everything share what they took, the first of them taking what does not divide
    shared = used.join(alike, (F.col("row_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc"))).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    part = (F.floor(F.col("words") / F.col("copies")) + F.when(F.col("copy") <= F.col("words") % F.col("copies"), 1).otherwise(0)).cast("long")
    facts = spark.createDataFrame([(s, n, t) for s, (n, t) in mixed.sources.items()], "_source string, source_size long, target double")
    return shared.join(facts, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "size", "source_size", "target", part.alias("taken"), "source")


def drawn_words(texts: pa.Array, starts: pa.Array, lengths: pa.Array) -> pa.Array:
    """The words of a text in the pieces given, as they stand there: pieces that touch are cut out in one, others are parted by a line end."""
    out = []
    for text, at, n in zip(texts.cast(pa.binary()), starts, lengths, strict=True):
        data, runs = text.as_py(), []
        for a, k in zip(at.as_py(), n.as_py(), strict=True):
            if runs and runs[-1][1] == a:
                runs[-1][1] = a + k
            else:
                runs.append([a, a + k])
        start, end = word_edges(data)
        out.append(b"\n".join([data[start[a] : end[b - 1]] for a, b in runs]))
    return pa.array(out, pa.binary()).cast(pa.string())


def mixed_documents(docs: DataFrame, mixed: Mix) -> DataFrame:
    """The mix as documents: one row for each document and pass, with the words taken in that pass.

    Rows have the columns of ``docs``, whatever their names; n_chars, if there,
    is that of the new text. Words keep what stood between them, lines
    included; parts of a text that do not touch are joined by a line end. Rows
    alike in doc_id, source and text give their passes once each. Defined
    cases: null and blank texts give no rows, an empty table none.
    """
    row, doc, key, drawn = fresh(docs, "_row", "_doc", "_key", "_drawn")
    length = F.least(F.col("length"), F.col("words") - F.col("at"))
    parts = mixed.pieces.where("block >= 0").join(mixed.slots.hint("merge"), ["source_key", "block"]).where(F.col("words") > F.col("at"))
    passes = parts.groupBy("doc_id", "row_key", "epoch").agg(F.sort_array(F.collect_list(F.struct("start", length.alias("length")))).alias(drawn)).select(F.col("doc_id").alias(doc), F.col("row_key").alias(key), drawn)
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "source", "text")).dropDuplicates([row, "doc_id"])
    joined = keyed.join(passes, (F.col(row) == F.col(key)) & F.col("doc_id").eqNullSafe(F.col(doc)))
    out = joined.withColumn("text", F.arrow_udf(drawn_words, "string")("text", f"{drawn}.start", f"{drawn}.length"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
