"""N-gram Jaccard join by chosen paths (operator 6).

Documents are sets of hashed shingles; documents with one set are one record.
In each run every record walks a path: a node of the tree picks a place on the
hash circle, and its records go on by the first token of theirs from there.
Two sets share that token with a chance of their similarity. A node with few
records is a leaf and is compared by brute force; larger ones are split again,
down to a fixed depth. Runs repeat until sets at the threshold have met with
the target probability. A pair is looked at in the first leaf its records
share, so nothing is counted twice and no pair leaves its task: what is
returned grows with the records. Leaves that no token splits (large groups of
near copies) are cut into chunks, and each pair of chunks is a task's work.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumload.llm.common import checkpointed, fresh
from cumload.llm.shingles import mixed, shingle_set

THRESHOLD, SHINGLE_WORDS = 0.8, 5
#: Places on the hash circle where a set's token is noted; nodes pick among them.
PLACES = 64
#: Nodes with more than this share of the rows are broadcast; there are fewer of them than this.
HOT_NODES = 2000
_BOUNDS = (np.arange(PLACES, dtype=np.uint64) << np.uint64(58)) + np.uint64(1 << 40)


#: Deviations below the threshold that the sketch filter lets pass, and the share of pairs at the threshold that it loses.
SKETCH_DEVIATIONS, SKETCH_MISS = 4, 1e-4


def runs_needed(threshold: float, depth: int, target: float) -> int:
    """Runs after which two sets at the threshold have met in a leaf, and passed the sketch filter, with probability ``target``."""
    met = min(target / (1 - SKETCH_MISS), 1 - 1e-9)
    return math.ceil(math.log(1 - met) / math.log(1 - threshold**depth))


def records(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, row_key (hash of the text), rec (digest of the set, null without words), n, places (a token for each), sketch, tokens (32 bits each, sorted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 1000) for at in range(0, batch.num_rows, 1000)):
                rec, size, places, sketch, tokens = [], [], [], [], []
                for x in part.column(2).cast(pa.binary()):
                    s = shingle_set(x.as_py() or b"", words)
                    if not len(s):
                        rec.append(None), size.append(0), places.append(None), sketch.append(None), tokens.append(None)
                        continue
                    at = s[np.searchsorted(s, _BOUNDS) % len(s)]
                    short = np.unique((s >> np.uint64(32)).astype("<u4"))
                    rec.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    size.append(len(short))
                    places.append(at.view(np.int64))
                    sketch.append((mixed(at + np.uint64(1)) & np.uint64(0xFF)).astype(np.uint8).tobytes())
                    tokens.append(short.tobytes())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(rec, pa.binary()), pa.array(size, pa.int32()), pa.array(places, pa.list_(pa.int64())), pa.array(sketch, pa.binary()), pa.array(tokens, pa.binary())], ["doc_id", "row_key", "rec", "n", "places", "sketch", "tokens"])

    return docs.select("doc_id", F.xxhash64("text").alias("row_key"), "text").mapInArrow(run, "doc_id long, row_key long, rec binary, n int, places array<long>, sketch binary, tokens binary")


def leaves(recs: DataFrame, runs: int, depth: int, limit: int) -> DataFrame:
    """rec, run, node, size: where each record's paths end, without leaves of one record.

    Nodes that hold over a two-thousandth of all rows are fewer than two
    thousand, so they may be broadcast: their rows are not shuffled by node.
    """
    picks = F.array(*[F.get("places", F.lit((r * 37 + 11) % PLACES)) for r in range(runs)])
    rows = recs.select("rec", F.posexplode(picks).alias("run", "token")).select("rec", "run", F.xxhash64("run", "token").alias("node"))
    ends, total = [], recs.count() * runs
    for level in range(1, depth + 1):
        sizes = checkpointed(rows.groupBy("node").agg(F.count("*").alias("size")).where("size >= 2"))
        hot = F.col("size") > max(limit, total // HOT_NODES)
        known = sizes.where(hot).select(F.col("node").alias("_node"), F.col("size").alias("_size"))
        marked = rows.join(F.broadcast(known), F.col("node") == F.col("_node"), "left").select("rec", "run", "node", "_size")
        hot_rows = marked.where("_size IS NOT NULL").select("rec", "run", "node", F.col("_size").alias("size"))
        sized = hot_rows.unionByName(marked.where("_size IS NULL").drop("_size").join(sizes.where(~hot), "node"))
        last = level == depth
        ends.append(sized if last else sized.where(F.col("size") <= limit))
        if last:
            break
        place = F.pmod(F.xxhash64("node", F.lit(level)), F.lit(PLACES)).cast("int")
        # only rows of large nodes go on, and only they fetch their record's tokens
        rows = checkpointed(sized.where(F.col("size") > limit).join(recs.select("rec", "places"), "rec").select("rec", "run", F.xxhash64("node", F.get("places", place)).alias("node")))
    out = ends[0]
    for e in ends[1:]:
        out = out.unionByName(e)
    return checkpointed(out)


def _cells(rows: DataFrame, limit: int, chunk: int) -> DataFrame:
    """Add cell, i, j and own: a leaf of up to ``limit`` records is one cell; larger ones have a cell for each pair of chunks."""
    chunks = F.when(F.col("size") <= limit, 1).otherwise(F.ceil(F.col("size") / chunk)).cast("int")
    own = F.pmod(F.xxhash64("rec"), chunks).cast("int")
    placed = rows.withColumn("_chunks", chunks).withColumn("own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    return placed.withColumn("i", F.least("own", "_other")).withColumn("j", F.greatest("own", "_other")).withColumn("cell", F.xxhash64("node", "i", "j")).drop("_chunks", "_other", "node", "size")


def _pairs(own: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that a cell compares: all within a chunk, or those across two."""
    if i == j:
        return np.triu_indices(len(own), 1)
    a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
    return np.repeat(a, len(b)), np.tile(b, len(a))


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches cut at cells: rows come sorted by cell; a cell is bounded by its chunks."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = batch.column("cell").to_numpy()
        at = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on in the next batch
        if at:
            yield pa.Table.from_batches([*held, batch.slice(0, at)])
            held = []
        elif held and held[0].column("cell")[0].as_py() != cell[-1]:
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _bytes(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, dtype=np.uint8).reshape(-1, width)


def _longs(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _ends(cell: np.ndarray) -> list[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _plausible(runs: int, threshold: float):
    """Rows (rec in a cell) that have a partner whose sketch may reach the threshold, met first in this cell."""
    deviation = SKETCH_DEVIATIONS * math.sqrt(threshold * (1 - threshold))

    def near(a: np.ndarray, b: np.ndarray, sketch: np.ndarray, n: np.ndarray) -> np.ndarray:
        small, large = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        ok = small >= threshold * large - 1e-9
        a, b, small = a[ok], b[ok], small[ok]
        ok[ok] = (sketch[a] == sketch[b]).mean(axis=1) >= threshold - deviation / np.sqrt(np.minimum(PLACES, small))
        return ok

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_cell(batches):
            cell, n, run = (table.column(c).to_numpy() for c in ("cell", "n", "run"))
            own, i, j = (table.column(c).to_numpy() for c in ("own", "i", "j"))
            sketch, paths = _bytes(table.column("sketch"), PLACES), _longs(table.column("paths"), runs)
            keep = np.zeros(len(cell), dtype=bool)

            def look(a: np.ndarray, b: np.ndarray, keep=keep, sketch=sketch, n=n, paths=paths, run=run) -> None:
                ok = near(a, b, sketch, n)
                a, b = a[ok], b[ok]
                before = np.arange(runs)[None, :] < run[a][:, None]
                met = ((paths[a] == paths[b]) & (paths[a] != 0) & before).any(axis=1)
                keep[a[~met]] = True
                keep[b[~met]] = True

            # all small cells at once, by the distance of two rows; large ones one by one
            spans = _ends(cell)
            length = np.repeat([e - s for s, e in spans], [e - s for s, e in spans])
            small = length <= 16
            for d in range(1, 16):
                a = np.flatnonzero(small[:-d] & (cell[:-d] == cell[d:])) if len(cell) > d else np.empty(0, dtype=int)
                if not len(a):
                    break
                cross = (i[a] == j[a]) | (own[a] != own[a + d])
                for at in range(0, len(a), 100_000):
                    look(a[cross][at : at + 100_000], a[cross][at : at + 100_000] + d)
            for s, e in spans:
                if e - s > 16:
                    a, b = _pairs(own[s:e], int(i[s]), int(j[s]))
                    for at in range(0, len(a), 100_000):
                        look(a[at : at + 100_000] + s, b[at : at + 100_000] + s)
            if keep.any():
                yield from table.filter(pa.array(keep)).select(["cell", "i", "j", "own", "run", "rec", "class_id", "copies", "paths"]).combine_chunks().to_batches()

    return run_all


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left with each right set, by products of 0/1 matrices of bounded width."""
    la, ra = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(la, ra)
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    if not len(both):
        return out
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)]
    width = 4096
    at = [np.searchsorted(both, x) for x in (la, ra)]
    hit = [(p < len(both)) & (both[np.minimum(p, len(both) - 1)] == x) for p, x in zip(at, (la, ra), strict=True)]
    for low in range(0, len(both), width):
        parts = []
        for k, x in enumerate((left, right)):
            m = np.zeros((len(x), min(width, len(both) - low)), dtype=np.float32)
            use = hit[k] & (at[k] >= low) & (at[k] < low + width)
            m[rows[k][use], at[k][use] - low] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out


def _linked(runs: int, threshold: float):
    """For each record of a cell with links: how many documents it links to here, and the lowest class it hangs together with."""

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_cell(batches):
            cell, run, copies, ids = (table.column(c).to_numpy() for c in ("cell", "run", "copies", "class_id"))
            own, i, j = (table.column(c).to_numpy() for c in ("own", "i", "j"))
            paths = _longs(table.column("paths"), runs)
            tokens = [np.frombuffer(x, dtype="<u4") for x in table.column("tokens").to_pylist()]
            n = np.array([len(t) for t in tokens])
            links, root = np.zeros(len(cell), dtype=np.int64), ids.copy()
            for s, e in _ends(cell):
                if e - s < 2:
                    continue
                if i[s] == j[s]:
                    a = b = np.arange(s, e)
                else:
                    a, b = s + np.flatnonzero(own[s:e] == i[s]), s + np.flatnonzero(own[s:e] == j[s])
                    if not len(a) or not len(b):
                        continue
                both = shared_counts([tokens[x] for x in a], [tokens[x] for x in b])
                union = n[a][:, None] + n[b][None, :] - both
                like = both >= threshold * union - 1e-6
                for r in range(int(run[s])):
                    like &= (paths[a, r][:, None] != paths[b, r][None, :]) | (paths[a, r] == 0)[:, None]
                if i[s] == j[s]:
                    np.fill_diagonal(like, False)
                np.add.at(links, a, like @ copies[b])
                if i[s] != j[s]:
                    np.add.at(links, b, like.T @ copies[a])
                # the lowest class in reach, within the cell
                while True:
                    low = root.copy()
                    down = np.where(like, root[b][None, :], np.iinfo(np.int64).max).min(axis=1)
                    root[a] = np.minimum(root[a], down)
                    up = np.where(like, root[a][:, None], np.iinfo(np.int64).max).min(axis=0)
                    root[b] = np.minimum(root[b], up)
                    if (low == root).all():
                        break
            use = links > 0
            if use.any():
                yield pa.RecordBatch.from_arrays([pa.array(ids[use]), pa.array(links[use]), pa.array(root[use])], ["class_id", "links", "root"])

    return run_all


def components(edges: DataFrame) -> DataFrame:
    """node, component (its lowest node) of undirected ``edges`` (a, b): lowest labels of neighbours, with jumps to a label's own label, until none changes."""
    both = checkpointed(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = checkpointed(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")))
    while True:  # each round lowers a label at least
        around = both.join(labels.select(F.col("a").alias("b"), F.col("label").alias("near")), "b").groupBy("a").agg(F.min("near").alias("near"))
        lower = labels.join(around, "a").select("a", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("a").alias("_at"), F.col("label").alias("_to"))
        new = checkpointed(lower.join(jump, F.col("label") == F.col("_at"), "left").select("a", F.least("label", F.coalesce("_to", "label")).alias("label"), "was"))
        if new.where("label < was").isEmpty():
            return new.select(F.col("a").alias("node"), F.col("label").alias("component"))
        labels = new.select("a", "label")


def join(docs: DataFrame, *, threshold: float = THRESHOLD, words: int = SHINGLE_WORDS, target_recall: float = 0.999, depth: int = 3, limit: int = 128, chunk: int = 512, broadcast_rows: int = 500_000) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): doc_id, class_id, copy_class, n_links, row_key.

    ``copy_class`` is the lowest doc_id with the same set of shingles,
    ``class_id`` the lowest of all documents that links (similarity of at least
    ``threshold``) tie together, ``n_links`` the number of other documents that
    the document itself is linked to, copies included.

    Sets are told apart by a digest, not by ids: texts that share an id, or
    have none, are tied by what they hold. Shingles are compared by 32 bits of
    their hashes, so two sets of n shingles share about n * n / 2**32 too many
    (one in ten pairs of 20,000 words has one, a change of 0.00005).

    Defined cases: words are compared without ASCII case; a text of fewer than
    ``words`` words is one shingle; null, empty and blank texts have no links
    and are classes of their own, named by their id; rows alike are copies of
    each other; an empty table gives no rows. Rows without doc_id never name a
    class, unless no other is in it: it has a negative number then, made from
    the digest.
    """
    runs = runs_needed(threshold, depth, target_recall)
    sets = checkpointed(records(docs, words))
    with_words = sets.where(F.col("rec").isNotNull())
    recs = checkpointed(with_words.groupBy("rec").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("places").alias("places")).withColumn("class_id", F.xxhash64("rec")))
    ends = leaves(recs, runs, depth, limit)

    by_run = F.map_from_entries(F.collect_list(F.struct("run", "node")))
    paths = ends.groupBy("rec").agg(by_run.alias("m"), F.collect_list(F.struct("run", "node", "size")).alias("ends"))
    whole = paths.select("rec", F.transform(F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.coalesce(F.try_element_at("m", r), F.lit(0).cast("long"))).alias("paths"), "ends")
    placed = recs.drop("places", "first_doc").join(whole, "rec").select("rec", "class_id", "copies", "n", "sketch", "paths", F.inline("ends"))
    cells = _cells(placed, limit, chunk)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = cells.repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(_plausible(runs, threshold), "cell long, i int, j int, own int, run int, rec binary, class_id long, copies long, paths array<long>")
    near = checkpointed(near)

    wanted = checkpointed(near.select("rec").distinct().join(recs.select("rec", "first_doc"), "rec").select(F.col("rec").alias("_rec"), F.col("first_doc").alias("_doc")))
    if wanted.count() <= broadcast_rows:  # at most broadcast_rows rows of 24 bytes; beyond that a shuffled join
        wanted = F.broadcast(wanted)
    # one copy of each set: the rows of its lowest document
    held = with_words.select("doc_id", "rec", "tokens").join(wanted, (F.col("rec") == F.col("_rec")) & F.col("doc_id").eqNullSafe(F.col("_doc"))).groupBy("rec").agg(F.first("tokens").alias("tokens"))
    found = near.join(held, "rec").repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(_linked(runs, threshold), "class_id long, links long, root long")
    found = checkpointed(found)

    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    tied = components(found.select(F.col("class_id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "class_id")
    facts = checkpointed(recs.select("rec", "class_id", "first_doc", "copies").join(links, "class_id", "left").join(tied, "class_id", "left").withColumn("component", F.coalesce("component", "class_id")))
    unnamed = lambda c: -1 - F.shiftrightunsigned(c, 1)
    names = facts.groupBy("component").agg(F.coalesce(F.min("first_doc"), unnamed(F.col("component"))).alias("name"))
    named = facts.join(names, "component").select("rec", "name", F.coalesce("first_doc", unnamed(F.col("class_id"))).alias("copy_name"), "links", "copies")
    out = sets.select("doc_id", "row_key", "rec").join(named, "rec", "left")
    return out.select("doc_id", F.coalesce("name", "doc_id").alias("class_id"), F.coalesce("copy_name", "doc_id").alias("copy_class"), (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"), "row_key")


def one_of_each(docs: DataFrame, joined: DataFrame) -> DataFrame:
    """``docs`` with one document of each class of ``joined``: that of the lowest doc_id, then row_key. Rows alike stay once.

    Its columns stay as they are, whatever their names. Texts without words and
    without ids are one class of rows alike; an empty table gives no rows.
    """
    row, doc, key = fresh(docs, "_row", "_doc", "_key")
    first = joined.groupBy("class_id").agg(F.min(F.struct("doc_id", "row_key")).alias("f")).select(F.col("f.doc_id").alias(doc), F.col("f.row_key").alias(key))
    keyed = docs.withColumn(row, F.xxhash64("text")).dropDuplicates(["doc_id", row])
    return keyed.join(first, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(row) == F.col(key)), "left_semi").select(*docs.columns)
