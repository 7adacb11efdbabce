"""Quality rules with cross-document line frequency (operator 5).

One pass over the texts measures each document and hashes its normalised
lines. Lines are counted by the distinct documents of a host that hold them;
lines above the host's limit are removed, and a document that loses too much,
or has too little left, is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumload.llm.common import checkpointed, fresh

SYMBOLS = b"#*$%&|<>"
_BLANK = b" \t\n\x0b\x0c\r"
WINDOW = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five that the text holds twice or more."""
    if len(words) <= WINDOW:
        return 0
    h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    n = len(h) - WINDOW + 1
    windows = h[:n].copy()
    for k in range(1, WINDOW):
        windows *= _STEP
        windows += h[k : n + k]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(h), dtype=bool)
    for k in range(WINDOW):
        covered[k : n + k] |= twice
    return int(covered.sum())


def normalised(words: list[bytes]) -> bytes:
    """A line in lower case, with one space between words, any number as 0."""
    line = b" ".join(words).lower().translate(_DIGITS)
    while b"00" in line:
        line = line.replace(b"00", b"0")
    return line


def measured(data: bytes) -> tuple[tuple[int, ...], list[int], list[int]]:
    """The base counts of a UTF-8 text, and the hash and the words of each of its lines that has words."""
    seen = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    words: list[bytes] = []
    lines, hashes, sizes = [], [], []
    for line in data.split(b"\n"):
        if part := line.split():
            words += part
            lines.append(line)
            hashes.append(xxhash.xxh64_intdigest(normalised(part)) - (1 << 63))
            sizes.append(len(part))
    points = len(data) - int(seen[0x80:0xC0].sum())
    blank = int(seen[list(_BLANK)].sum())
    counts = (len(words), points - blank, int(seen[list(SYMBOLS)].sum()), len(lines) - len(set(lines)), repeated_words(words))
    return counts, hashes, sizes


_DIGITS = bytes(0x30 if 0x30 <= b <= 0x39 else b for b in range(256))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, host, row_key, the base counts, lines (hashes) and line_words, of ``docs`` (doc_id, text, source)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "host", "row_key", *FIELDS, "lines", "line_words"]
        for batch in batches:
            for part in (batch.slice(at, 2000) for at in range(0, batch.num_rows, 2000)):
                found = [measured(x.as_py() or b"") for x in part.column(3).cast(pa.binary())]
                counts = [pa.array([f[0][k] for f in found], pa.int64()) for k in range(len(FIELDS))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), *counts, pa.array([f[1] for f in found], pa.list_(pa.int64())), pa.array([f[2] for f in found], pa.list_(pa.int32()))], names)

    schema = "doc_id long, host string, row_key long, " + ", ".join(f"{x} long" for x in FIELDS) + ", lines array<long>, line_words array<int>"
    return docs.select("doc_id", "source", F.xxhash64("text").alias("row_key"), "text").mapInArrow(run, schema)


def frequent_lines(measures: DataFrame, *, min_documents: int, min_share: float, enough: int = 200, count_copies: bool = False) -> DataFrame:
    """host, line: lines that at least ``min_documents`` documents of the host hold, and ``min_share`` of them or ``enough``.

    Documents with equal texts are one document, so copies alone make no line
    frequent, unless ``count_copies`` tells them apart by their ids.
    """
    document = F.struct("doc_id", "row_key") if count_copies else F.col("row_key")
    named = measures.withColumn("document", document)
    hosts = named.groupBy("host").agg(F.count_distinct("document").alias("documents"))
    lines = named.select("host", "document", F.explode(F.array_distinct("lines")).alias("line"))
    counts = lines.groupBy("host", "line").agg(F.count_distinct("document").alias("n")).where(F.col("n") >= min_documents)
    hosts = hosts.withColumnRenamed("host", "_host")
    return counts.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).where((F.col("n") >= min_share * F.col("documents")) | (F.col("n") >= enough)).select("host", "line")


def rate(docs: DataFrame, *, min_words: int = 10, max_repeat_percent: int = 20, min_documents: int = 20, min_share: float = 0.01, enough: int = 200, min_left: float = 0.5, count_copies: bool = False, broadcast_rows: int = 200_000) -> DataFrame:
    """The base counts, base_failed, removed_words and kept of every document of ``docs`` (doc_id, text, source).

    Defined cases: a null text has no words (and fails the base); null hosts
    are one host; rows alike in doc_id and text are rated alike and each
    returned; an empty table gives no rows. A document is kept if it passes
    the base, keeps ``min_words`` words and ``min_left`` of its words after its
    frequent lines are removed. The frequent lines are broadcast only where
    they are counted to be at most ``broadcast_rows`` rows of 16 bytes and a
    host name; beyond that both sides are shuffled.
    """
    measures = checkpointed(measure(docs))
    frequent = checkpointed(frequent_lines(measures, min_documents=min_documents, min_share=min_share, enough=enough, count_copies=count_copies))
    side = frequent.select(F.col("host").alias("_host"), F.col("line").alias("_line"))
    if side.limit(broadcast_rows + 1).count() <= broadcast_rows:
        side = F.broadcast(side)

    lines = measures.select("doc_id", "row_key", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("l")).select("doc_id", "row_key", "host", F.col("l.lines").alias("line"), F.col("l.line_words").alias("n"))
    lost = lines.join(side, (F.col("line") == F.col("_line")) & F.col("host").eqNullSafe(F.col("_host")))
    # rows alike in doc_id, text and host lose the same words each: the sum over them is shared out
    removed = lost.groupBy("doc_id", "row_key", "host").agg(F.sum("n").alias("_lost"))
    alike = measures.groupBy("doc_id", "row_key", "host").agg(F.count("*").alias("_rows"), *[F.first(x).alias(x) for x in FIELDS])
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in ("doc_id", "row_key", "host")]
    joined = alike.alias("a").join(removed.alias("b"), same[0] & same[1] & same[2], "left")
    n, lost_words = F.col("n_words"), F.coalesce(F.col("_lost") / F.col("_rows"), F.lit(0)).cast("long")
    failed = (n < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * n)
    left = n - lost_words
    out = joined.select("a.doc_id", *FIELDS, failed.alias("base_failed"), (~failed & (left >= min_words) & (left >= min_left * n)).alias("kept"), lost_words.alias("removed_words"), F.explode(F.array_repeat(F.lit(0), F.col("_rows").cast("int"))).alias("_"))
    return out.drop("_")


def cleaned(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with the frequent lines of their hosts taken out of their texts.

    Texts that lose nothing stay as they are, null ones too; columns keep their names; rows alike each stay.
    """
    row, doc, key, host, lost = fresh(docs, "_row", "_doc", "_key", "_host", "_gone")
    keyed = docs.withColumn(row, F.xxhash64("text"))
    lines = measure(docs).select("doc_id", "row_key", "host", F.posexplode("lines").alias("at", "line")).distinct()
    gone = lines.join(frequent.withColumnRenamed("host", "_host"), ["line"]).where(F.col("host").eqNullSafe(F.col("_host"))).groupBy("doc_id", "row_key", "host").agg(F.collect_set("at").alias(lost)).select(F.col("doc_id").alias(doc), F.col("row_key").alias(key), F.col("host").alias(host), lost)
    joined = keyed.join(gone, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(row) == F.col(key)) & F.col("source").eqNullSafe(F.col(host)), "left")
    with_words = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    text = F.concat_ws("\n", F.filter(with_words, lambda x, i: ~F.array_contains(lost, i)))
    return joined.withColumn("text", F.when(F.col(lost).isNotNull(), text).otherwise(F.col("text"))).select(*docs.columns)
