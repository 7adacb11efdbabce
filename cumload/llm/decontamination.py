"""Benchmark decontamination by one Aho-Corasick automaton (operator 11).

Benchmark texts and documents become lower-case words between single blanks.
The windows of the benchmark (runs of words) are the automaton's patterns; each
normalised text is scanned once for all of them, and the places of its words in
the original text are kept, so that every hit has original offsets.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumload.llm.common import checkpointed

#: A word after A-Z are lower-cased: ASCII digits and letters, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[0x41:0x5B] += 0x20
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x41:0x5B] = _IN_WORD[0x61:0x7B] = True
_IN_WORD[0x80:] = True

HITS = "array<struct<start:int,end:int,first:int,words:int>>"


def words(text: str | Column) -> Column:
    """The normalised words of a text; null has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({WORD})"), 1), F.array().cast("array<string>"))


def windows(benchmark: DataFrame, *, window: int = 10) -> DataFrame:
    """pattern (a window's words between blanks, one before and one after), items (ids of the items that hold it, as strings)."""
    item = benchmark.select(F.col("item_id").cast("string").alias("item"), words("text").alias("w")).where(F.size("w") > 0)
    first = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))).alias("at")
    cut = item.select("item", "w", first).select("item", F.concat(F.lit(" "), F.array_join(F.slice("w", F.col("at"), F.lit(window)), " "), F.lit(" ")).alias("pattern"))
    return cut.groupBy("pattern").agg(F.collect_set("item").alias("items"))


class Scanner:
    """The automaton of some windows, over the bytes of normalised texts."""

    def __init__(self, patterns: list[tuple[bytes, list[str]]]):
        self.items = [tuple(items) for _, items in patterns]
        self.words = np.array([p.count(b" ") - 1 for p, _ in patterns], dtype=np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, (pattern, _) in enumerate(patterns):
            self.automaton.add_word(pattern.decode("latin-1"), k)
        if patterns:
            self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[int, list[dict], list[str]]:
        """(number of words, maximal runs of hit words with their places in the text, ids of the items found)."""
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        inside = _IN_WORD[data]
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edge[::2], edge[1::2]
        if not len(starts) or not self.items:
            return len(starts), [], []
        kept = inside.copy()
        kept[1:] |= inside[:-1]  # a word's bytes and the one after it, which becomes a blank
        plain = np.where(inside, _LOWERED[data], 0x20)[kept]
        found = [*self.automaton.iter(" " + plain.tobytes().decode("latin-1") + " ")]
        if not found:
            return len(starts), [], []
        at, which = np.array(found, dtype=np.int64).T
        # a match ends on the blank after its last word; place k of the scanned text lies after k - 1 kept bytes
        last = np.searchsorted(np.cumsum(ends - starts + 1), at)
        change = np.zeros(len(starts) + 1, dtype=np.int64)
        np.add.at(change, last - self.words[which] + 1, 1)
        np.add.at(change, last + 1, -1)
        run = np.flatnonzero(np.diff(np.cumsum(change[:-1]) > 0, prepend=False, append=False))
        a, b = run[::2], run[1::2]
        point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
        hits = [{"start": int(s), "end": int(e), "first": int(f), "words": int(n)} for s, e, f, n in zip(point[starts[a]], point[ends[b - 1]], a, b - a, strict=True)]
        return len(starts), hits, sorted({i for k in np.unique(which) for i in self.items[k]})


_held: dict[str, Scanner] = {}


def _scanner(name: str, block: Broadcast) -> Scanner:
    """The scanner of a block, built once in each Python worker, which holds one at a time."""
    if name not in _held:
        _held.clear()
        _held[name] = Scanner(block.value)
    return _held[name]


def merged(runs: list[dict]) -> list[dict]:
    """Runs of hit words, joined where they meet."""
    out: list[dict] = []
    for r in sorted(runs, key=lambda r: (r["first"], r["words"])):
        if out and r["first"] <= out[-1]["first"] + out[-1]["words"]:
            end = max(out[-1]["first"] + out[-1]["words"], r["first"] + r["words"])
            out[-1] = out[-1] | {"end": max(out[-1]["end"], r["end"]), "words": end - out[-1]["first"]}
        else:
            out.append(dict(r))
    return out


_FIELDS = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("first", pa.int32()), ("words", pa.int32())])


def _pass(docs: DataFrame, block: Broadcast, *, only_hits: bool) -> DataFrame:
    """doc_id, key (digest of the text), n_words, hits, items of each row, or of those with hits."""
    name, kind = uuid.uuid4().hex, dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(name, block)
        for batch in batches:
            texts = batch.column(1)
            found = []
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                n, hits, items = scanner.scan(text)
                if hits or not only_hits:
                    found.append((i, hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:16], n, hits, items))
            rows, keys, n, hits, items = map(list, zip(*found, strict=True)) if found else ([],) * 5
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(keys, pa.binary()), pa.array(n, pa.int64()), pa.array(hits, pa.list_(_FIELDS)), pa.array(items, pa.list_(pa.string()))], ["doc_id", "key", "n_words", "hits", "items"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, key binary, n_words long, hits {HITS}, items array<string>")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs = [merged([r for part in parts for r in part]) for parts in batch.column("runs").to_pylist()]
        items = [sorted({i for part in parts for i in part}) for parts in batch.column("sets").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(runs, pa.list_(_FIELDS)), pa.array(items, pa.list_(pa.string()))], ["doc_id", "n_words", "hits", "items"])


def scan(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, block_pairs: int = 200_000) -> DataFrame:
    """doc_id, n_words, hits and items for every row of ``docs``.

    ``hits`` are the maximal runs of words inside any occurrence of a window:
    start and end in code points of the original text, and the first word's
    number with the number of words. ``items`` are the ids, as sorted strings,
    of the items with occurring windows; an item shorter than a window is one.

    The windows are made and counted on Spark, and one automaton takes up to
    ``block_pairs`` pairs of window and item (about 10 million letters). A
    larger benchmark is dealt by hash into blocks of that size; each is
    broadcast by itself and the documents are scanned once a block, so no task
    and not the driver holds more than one. Only rows with hits are then joined.

    Defined cases: a null text, and one of separators alone, has no words and no
    hits; items without words, and null ids in ``items``, count for nothing,
    but the words of an item with a null id are hit; texts are scanned whole, in
    time linear in their length and hits; rows alike are each scanned; without a
    benchmark there are no hits; an empty table gives no rows; other columns are
    ignored.
    """
    patterns = checkpointed(windows(benchmark, window=window))
    pairs = patterns.agg(F.coalesce(F.sum(F.greatest(F.size("items"), F.lit(1))), F.lit(0))).first()[0]
    blocks = max(1, -(-pairs // block_pairs))
    context = docs.sparkSession.sparkContext

    def block(k: int) -> Broadcast:
        own = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == k).collect()  # about block_pairs pairs, counted above
        return context.broadcast([(r["pattern"].encode("utf-8", "surrogatepass"), r["items"]) for r in own])

    base = _pass(docs, block(0), only_hits=False)
    if blocks == 1:
        return base.drop("key")
    base = checkpointed(base)
    found = base.where(F.size("hits") > 0).select("doc_id", "key", "hits", "items", F.lit(0).alias("block"))
    more = [checkpointed(_pass(docs, block(k), only_hits=True).select("doc_id", "key", "hits", "items", F.lit(k).alias("block"))) for k in range(1, blocks)]
    for other in more:
        found = found.unionAll(other)
    # rows alike have hits alike: one of them for each block
    one = found.groupBy("doc_id", "key", "block").agg(F.any_value("hits").alias("hits"), F.any_value("items").alias("items"))
    sets = one.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(F.collect_list("hits").alias("runs"), F.collect_list("items").alias("sets"))
    joined = base.drop("hits", "items").join(sets, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    none = joined.select("doc_id", "n_words", F.coalesce("runs", F.array().cast(f"array<{HITS}>")).alias("runs"), F.coalesce("sets", F.array().cast("array<array<string>>")).alias("sets"))
    return none.mapInArrow(_together, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, hits {HITS}, items array<string>")


def report(scanned: DataFrame) -> DataFrame:
    """``scan``'s rows as counts: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["words"])
    ids = F.sha2(F.array_join("items", ","), 256)
    return scanned.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), ids.alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))
