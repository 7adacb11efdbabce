"""Cross-tokenizer alignment through a dictionary of groups (operator 12).

A text's tokens of two vocabularies are cut into groups wherever both end. Few
distinct groups make up most of a corpus: they are interned, the links between
their tokens are expanded once for each distinct group and counted by its
frequency, and what the counts say of a group is joined back by its key.

Texts are tokenized by chunks (a blank run and what follows it, up to the next
blank after something else): neither vocabulary joins across such a cut, so
equal chunks have equal tokens and groups and are done once.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumload.llm.common import checkpointed, scratch

#: Where the vocabularies lie; their folder is installed on every machine. The first is byte_bpe_50k.json's, as ranks.
BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Characters of one batch, whose groups are numbered together, and of its parts, held as chunks at a time.
BATCH_CHARS, PART_CHARS = 16_000_000, 2_000_000


_CUT, _RUN = re.compile(r"(?<=\S)(?= )"), re.compile(r"\s ")


def chunks(text: str) -> list[str]:
    """A text that starts with a blank, cut before each blank that does not follow white space."""
    return _CUT.split(text) if _RUN.search(text) else [f" {p}" for p in text[1:].split(" ")]


class Aligner:
    """Tokens of both vocabularies, and their groups, by chunk."""

    def __init__(self, ranks_path: str, pieces_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * len(ranks)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.b_bytes = [self._piece(i) for i in range(self.pieces.get_piece_size())]
        self.blank = self.pieces.piece_to_id("▁")
        self.sizes = [np.array([len(t) for t in own], dtype=np.int64) for own in (self.a_bytes, self.b_bytes)]

    def _piece(self, i: int) -> bytes:
        return bytes([int(self.pieces.id_to_piece(i)[3:-1], 16)]) if self.pieces.is_byte(i) else self.pieces.id_to_piece(i).replace("▁", " ").encode()

    def groups(self, distinct: list[str], number: Callable[[str], int]) -> Groups:
        """The groups of each chunk, as whole-array steps over all chunks laid end to end."""
        lists = [self.bytes.encode_ordinary(c) for c in distinct], self.pieces.encode([c[1:] for c in distinct], num_threads=1)
        lists[1][:] = [[self.blank] if c == " " else b for c, b in zip(distinct, lists[1], strict=True)]
        raw = [c.encode() for c in distinct]
        n_tokens = [np.fromiter(map(len, own), dtype=np.int64, count=len(own)) for own in lists]
        ids = [np.fromiter(chain.from_iterable(own), dtype=np.int64, count=int(n.sum())) for own, n in zip(lists, n_tokens, strict=True)]
        fit = np.ones(len(distinct), dtype=bool)
        for i, n, table in zip(ids, n_tokens, (self.a_bytes, self.b_bytes), strict=True):
            if b"".join([table[t] for t in i.tolist()]) != b"".join(raw):
                at = np.concatenate([[0], np.cumsum(n)])
                fit &= [b"".join([table[t] for t in i[at[k] : at[k + 1]].tolist()]) == raw[k] for k in range(len(raw))]
        if not fit.all():
            ids = [i[np.repeat(fit, n)] for i, n in zip(ids, n_tokens, strict=True)]
            n_tokens = [np.where(fit, n, 0) for n in n_tokens]
        ends = [np.cumsum(size[i]) for size, i in zip(self.sizes, ids, strict=True)]
        cuts = np.intersect1d(*ends, assume_unique=True)
        per = [np.bincount(np.searchsorted(cuts, e), minlength=len(cuts)) for e in ends]
        starts = [np.cumsum(n) - n for n in per]
        numbers = np.empty(len(cuts), dtype=np.int64)
        shape = per[0] * len(ids[1]) + per[1]
        for kind in np.unique(shape):
            own = np.flatnonzero(shape == kind)
            n_a, n_b = int(per[0][own[0]]), int(per[1][own[0]])
            tokens = np.stack([*(ids[0][starts[0][own] + k] for k in range(n_a)), *(ids[1][starts[1][own] + k] for k in range(n_b))], axis=1)
            if n_a + n_b <= 4:  # ids have 16 bits, so up to four are one number
                _, first, inverse = np.unique((tokens.astype(np.uint64) << (np.arange(n_a + n_b, dtype=np.uint64) * np.uint64(16))).sum(axis=1, dtype=np.uint64), return_index=True, return_inverse=True)
            else:
                _, first, inverse = np.unique(tokens, axis=0, return_index=True, return_inverse=True)
            named = [number(f"{','.join(map(str, t[:n_a]))}|{','.join(map(str, t[n_a:]))}") for t in tokens[first].tolist()]
            numbers[own] = np.array(named, dtype=np.int64)[inverse.ravel()]
        last = np.searchsorted(cuts, np.cumsum(np.where(fit, [len(r) for r in raw], 0)), side="right")
        return Groups(fit, *n_tokens, np.diff(last, prepend=0), numbers)


class Groups(NamedTuple):
    """For each chunk whether its tokens' bytes are its own, its number of A ids, B ids and groups; the groups' numbers."""

    fit: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    numbers: np.ndarray


_aligners: dict[tuple[str, ...], Aligner] = {}


def aligner(*paths: str) -> Aligner:
    """One for each Python worker and pair of vocabularies."""
    if paths not in _aligners:
        _aligners[paths] = Aligner(*paths)
    return _aligners[paths]


_ROWS = [("batch", pa.int64()), ("doc_id", None), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("held", pa.binary()), ("times", pa.binary()), ("number", pa.int32()), ("group", pa.string()), ("freq", pa.int64())]
_SCHEMA = "batch long, doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, held binary, times binary, number int, group string, freq long"


class Batch:
    """Documents whose groups are numbered together."""

    def __init__(self, number: int, kind: pa.DataType):
        self.number, self.kind, self.chars = number, kind, 0
        self.numbers: dict[str, int] = {}
        self.freq = np.zeros(0, dtype=np.int64)

    def part(self, ids: list, texts: list[str], tool: Aligner) -> pa.RecordBatch:
        """A row for each document: its figures, the numbers of its distinct groups (as gaps) and how often it holds each."""
        lists = [chunks(" " + t) if t else [] for t in texts]
        flat = pa.array([c for own in lists for c in own], pa.large_string()).dictionary_encode()
        at = flat.indices.to_numpy(zero_copy_only=False)
        numbers = self.numbers
        known = tool.groups(flat.dictionary.to_pylist(), lambda g: numbers.setdefault(g, len(numbers)))
        bounds = np.cumsum([0, *map(len, lists)])  # of each document's chunks
        whole, n_a, n_b = (np.concatenate([[0], np.cumsum(x[at])])[bounds] for x in (~known.fit, known.n_a, known.n_b))
        fit = np.diff(whole) == 0
        n_groups = known.n_groups
        lengths = n_groups[at]
        ends = np.cumsum(lengths)
        every = known.numbers[np.repeat((np.cumsum(n_groups) - n_groups)[at] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        at_group = np.concatenate([[0], ends])[bounds]
        self.freq = np.concatenate([self.freq, np.zeros(len(numbers) - len(self.freq), dtype=np.int64)])
        names = np.array([*numbers, ""], dtype=object)
        rows: list[tuple] = []
        for k, (doc_id, own) in enumerate(zip(ids, lists, strict=True)):
            if not own or not fit[k]:
                rows.append((doc_id, 0, 0, 0, "", b"", b""))
                continue
            of = every[at_group[k] : at_group[k + 1]]
            held, times = np.unique(of, return_counts=True)
            self.freq[held] += times
            digest = hashlib.sha256(";".join(names[of].tolist()).encode()).hexdigest()
            rows.append((doc_id, int(n_a[k + 1] - n_a[k]), int(n_b[k + 1] - n_b[k]), len(of), digest, np.diff(held, prepend=0).astype("<u4").tobytes(), times.astype("<u4").tobytes()))
        self.chars += sum(map(len, texts))
        return self._rows(zip(*rows, strict=True), len(rows), 1)

    def dictionary(self) -> pa.RecordBatch:
        """A row for each distinct group: its number, its ids and how often it occurs (not at all, if only texts without tokens hold it)."""
        return self._rows([list(self.numbers.values()), list(self.numbers), self.freq.tolist()], len(self.numbers), 8)

    def _rows(self, columns, n: int, first: int) -> pa.RecordBatch:
        given = dict(zip((c for c, _ in _ROWS[first:]), columns))
        given["batch"] = [self.number] * n
        return pa.RecordBatch.from_arrays([pa.array(list(given.get(c, [None] * n)), t or self.kind) for c, t in _ROWS], [c for c, _ in _ROWS])


def grouped(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Rows of documents (doc_id ... times) and of the groups of each batch (number, group, freq)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, now, made = aligner(*paths), None, 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, held = [], 0
                while at + len(texts) < batch.num_rows and held < PART_CHARS:
                    texts.append(batch.column(1)[at + len(texts)].as_py() or "")
                    held += len(texts[-1])
                if now is None:
                    now, made = Batch(TaskContext.get().partitionId() << 32 | made, batch.column(0).type), made + 1
                yield now.part(batch.column(0).slice(at, len(texts)).to_pylist(), texts, tool)
                at += len(texts)
                if now.chars >= BATCH_CHARS:
                    yield now.dictionary()
                    now = None
        if now is not None:
            yield now.dictionary()

    return docs.select("doc_id", "text").mapInArrow(run, _SCHEMA.format(kind=dict(docs.dtypes)["doc_id"]))


def links(groups: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """group, a, b, freq: a row for each pair of a group's tokens whose bytes overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(*paths)
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = [[s.split(",") for s in part] for part in zip(*(g.split("|") for g in batch.column("group").to_pylist()), strict=True)]
            ids = [np.array([int(i) for own in side for i in own], dtype=np.int64) for side in sides]
            # groups end together on both sides, so all of a batch are laid out as one text
            ends = [np.cumsum(s[i]) for s, i in zip(tool.sizes, ids, strict=True)]
            cut = np.union1d(*ends) - 1
            a, b = (np.searchsorted(e, cut, side="right") for e in ends)
            of = np.repeat(np.arange(batch.num_rows), [len(own) for own in sides[0]])[a]
            yield pa.RecordBatch.from_arrays([batch.column("group").take(pa.array(of)), pa.array(ids[0][a].astype(np.int32)), pa.array(ids[1][b].astype(np.int32)), batch.column("freq").take(pa.array(of))], ["group", "a", "b", "freq"])

    return groups.select("group", "freq").mapInArrow(run, "group string, a int, b int, freq long")


def paths(folder: str | None = None) -> tuple[str, str]:
    import public_tokenizers

    return tuple(f"{folder}/{n}" if folder else public_tokenizers.path(n) for n in (BYTE_VOCABULARY, PIECE_VOCABULARY))


def pair_counts(linked: DataFrame) -> DataFrame:
    """a, b, links: how many links of the corpus hold each pair."""
    return linked.groupBy("a", "b").agg(F.sum("freq").alias("links"))


def group_figures(linked: DataFrame) -> DataFrame:
    """For each distinct group the sum of its links' counts, and how many of them are the highest of their B id."""
    counts = checkpointed(pair_counts(linked))
    best = counts.groupBy(F.col("b").alias("_b")).agg(F.max("links").alias("most"))  # a row for each id of one vocabulary at most
    rated = linked.join(counts, ["a", "b"]).join(F.broadcast(best), F.col("b") == F.col("_b"))
    return rated.groupBy("group").agg(F.sum("links").alias("sum"), F.count_if(F.col("links") == F.col("most")).alias("best"))


def align(docs: DataFrame, *, folder: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``.

    One pass tokenizes: it writes, to the shared folder, the documents with the
    numbers of their groups and, for each batch of about 16 million characters,
    the groups that the numbers stand for. From then on only batches' groups
    are shuffled, one row for each batch that holds a group, so that the most
    common group has as many rows as there are batches.

    Defined cases: a null or empty text, and one whose tokens' bytes are not
    its own, has no tokens: zeros and an empty digest; long texts are read
    whole; rows alike are counted each; null ids stay null; an empty table
    gives no rows; other columns are ignored.
    """
    where, path = paths(folder), scratch(docs.sparkSession, "alignment")
    kind = dict(docs.dtypes)["doc_id"]
    grouped(docs, where).write.option("compression", "zstd").parquet(path)
    written = docs.sparkSession.read.schema(_SCHEMA.format(kind=kind)).parquet(path)
    own = written.where(F.col("freq") > 0).select("batch", "number", "group", "freq")
    distinct = own.groupBy("group").agg(F.sum("freq").alias("freq"))
    figures = group_figures(checkpointed(links(distinct, where)))
    held = own.join(figures, "group").select(F.col("batch").alias("g_batch"), "number", "sum", "best")
    texts = written.where(F.col("group").isNull()).select("batch", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "held", "times")

    def back(of: pa.Table, groups: pa.Table) -> pa.Table:
        number = groups["number"].to_numpy()
        tables = np.zeros((2, int(number.max()) + 1 if len(number) else 1), dtype=np.int64)
        tables[:, number] = groups["best"].to_numpy(), groups["sum"].to_numpy()
        sums = np.zeros((2, of.num_rows), dtype=np.int64)
        for k, (gaps, times) in enumerate(zip(of["held"].to_pylist(), of["times"].to_pylist(), strict=True)):
            if gaps:
                which = np.cumsum(np.frombuffer(gaps, dtype="<u4").astype(np.int64))
                sums[:, k] = tables[:, which] @ np.frombuffer(times, dtype="<u4").astype(np.int64)
        n_a, n_b, n_groups = (of[c].to_numpy() for c in ("n_a", "n_b", "n_groups"))
        # within a group each link starts where a token of either side does
        return pa.table({"doc_id": of["doc_id"], "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_a + n_b - n_groups, "n_best": sums[0], "count_sum": sums[1], "groups_sha256": of["groups_sha256"]})

    return texts.groupBy("batch").cogroup(held.groupBy("g_batch")).applyInArrow(back, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
