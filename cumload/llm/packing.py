"""Best-fit packing of token pieces into sequences (operator 4).

Tokens are ids of a public word-piece vocabulary. Documents over the sequence
length are cut into full pieces; all other pieces are packed whole by
bounded-space online best-fit: a fixed number of bins is open, far fewer than
a lane has sequences, a bitset keyed by free space finds the fullest bin that
still takes a piece, and when no bin may be added the fullest one closes.

Pieces arrive in hash order, a window of some hundred at a time, the longest
of a window first. With 128 open bins this takes 1.002 times the sequences
that the tokens would fill without a gap; in plain hash order it is 1.016,
with any number of bins (17,000 pieces of 674 tokens on average).
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumload.llm.common import checkpointed

SEQUENCE_TOKENS = 2048
#: Where the vocabulary lies; its folder is installed on every machine.
VOCABULARY = "word_bpe_49k.json"
#: Words of one generation of a Python worker's memory, of which it keeps two (about 250 bytes a word). Workers are
#: reused, so what one holds stays beside the later stages of a job.
CACHE_WORDS = 50_000
#: Characters of the texts that are held as words at a time (one long text may be more).
BATCH_CHARS = 500_000


class WordTokenizer:
    """Ids of a lower-casing BPE with word ends, word by word.

    The vocabulary's own rules never join across white space, so a text's ids
    are those of its white-space chunks in turn. Chunks are remembered; a new
    chunk's pieces are merged by a byte-pair core whose alphabet has one more
    byte, 0xFF, for the end of a word. Texts that hold a special token's string
    go to the reference implementation. Tests hold the two against each other.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        import json

        import regex
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        letters = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}

        def raw(token: str) -> bytes:
            end = token.endswith("</w>") and token != "</w>"
            return bytes(letters[c] for c in (token[:-4] if end else token)) + b"\xff" * end

        ranks: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        for b in range(256):
            ranks.setdefault(bytes([b, 0xFF]), len(ranks))
        for pair in model["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            ranks.setdefault(raw(left) + raw(right), len(ranks))
        self.ids = [b""] * len(ranks)
        special = {t["content"] for t in spec["added_tokens"]}
        for token, i in model["vocab"].items():
            if token not in special and (r := ranks.get(raw(token))) is not None:
                self.ids[r] = i.to_bytes(4, "little")
        self.special = tuple(special)
        self.core = tiktoken._tiktoken.CoreBPE(ranks, {}, r"[\s\S]")
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern).findall
        self.path = path
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cache_words = cache_words

    @cached_property
    def whole(self):
        """The reference implementation, read when the first odd text comes."""
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return Tokenizer.from_file(self.path)

    def piece(self, piece: str) -> bytes:
        return b"".join([self.ids[r] for r in self.core.encode_single_piece(piece.encode() + b"\xff")])

    def chunk(self, chunk: str) -> bytes:
        """Ids of a chunk that ``cache`` lacks: kept from the generation before, or merged anew."""
        if (out := self.older.get(chunk)) is None:
            lowered = "".join(map(str.lower, chunk)) if "Σ" in chunk else chunk.lower()
            if lowered.isalpha():
                out = self.piece(lowered)
            elif lowered[-1] in ".,!?" and lowered[:-1].isalpha():
                out = self.piece(lowered[:-1]) + self.piece(lowered[-1])
            else:
                out = b"".join(map(self.piece, self.pieces(lowered)))
        if len(self.cache) >= self.cache_words:
            self.older, self.cache = self.cache, {}
        self.cache[chunk] = out
        return out

    def odd(self, text: str) -> bool:
        """Whether only the reference implementation will do: a special token's string, or one of
        the separators 0x1C to 0x1F, where words part here but not in the vocabulary's rules."""
        return "<|" in text and any(s in text for s in self.special) or any(c in text for c in "\x1c\x1d\x1e\x1f")

    def encode(self, text: str) -> np.ndarray:
        return self.encode_batch([text])[0]

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as little-endian unsigned 32-bit numbers.

        The words of all texts are numbered in native code; each distinct word is looked up once.
        """
        odd = {i for i, t in enumerate(texts) if self.odd(t)}
        plain = [("" if i in odd else t if t.isascii() else unicodedata.normalize("NFC", t)) for i, t in enumerate(texts)]
        lists = pc.utf8_split_whitespace(pa.array(plain, pa.large_string()))
        words = lists.flatten().dictionary_encode()
        word = words.indices.to_numpy(zero_copy_only=False)
        known = [self.cache.get(w) or self.chunk(w) if w else b"" for w in words.dictionary.to_pylist()]
        ids = np.frombuffer(b"".join(known), dtype="<u4")
        lengths = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        starts = np.cumsum(lengths) - lengths
        of_word = lengths[word]
        ends = np.cumsum(of_word)
        flat = ids[np.repeat(starts[word] - (ends - of_word), of_word) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        out = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for i in odd:
            out[i] = np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, dtype="<u4")
        return out


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker and vocabulary."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


class OpenBins:
    """At most ``limit`` open bins; bit f of ``bits`` is set if a bin has f tokens free."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit, self.bits = capacity, limit, 0
        self.open = self.opened = self.closed = 0
        self.by_free: dict[int, list[int]] = {}

    def _put(self, sequence: int, free: int) -> None:
        self.by_free.setdefault(free, []).append(sequence)
        self.bits |= 1 << free

    def _take(self, free: int) -> int:
        found = self.by_free[free]
        sequence = found.pop()
        if not found:
            self.bits &= ~(1 << free)
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for a piece: the open bin with least room that takes it, else a new bin."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            sequence = self._take(free)
        else:
            if self.open == self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
                self.open -= 1
                self.closed += 1
            sequence, free = self.opened, self.capacity
            self.opened += 1
            self.open += 1
        if free == length:
            self.open -= 1
        else:
            self._put(sequence, free - length)
        return sequence, self.capacity - free


def tokenized(docs: DataFrame, *, vocabulary: str | None = None, tokens: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """Pieces of documents: doc_id, piece, start, length, ids_crc32 (and ids, as bytes, if asked for).

    A document's ids end with id 0; a null text is empty, so it has that id
    alone. Only documents over ``tokens`` are cut, every ``tokens`` ids.
    """
    import public_tokenizers

    path, width = vocabulary or public_tokenizers.path(VOCABULARY), 4 * tokens
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids

    end = np.zeros(1, dtype="<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode_batch
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, held = [], 0
                while at + len(texts) < batch.num_rows and held < BATCH_CHARS:
                    texts.append(batch.column(1)[at + len(texts)].as_py() or "")
                    held += len(texts[-1])
                rows: list[tuple] = []
                for doc_id, ids in zip(batch.column(0).slice(at, len(texts)).to_pylist(), encode(texts), strict=True):
                    whole = np.concatenate([ids, end]).tobytes()
                    for k, start in enumerate(range(0, len(whole), width)):
                        part = whole[start : start + width]
                        rows.append((doc_id, k, start // 4, len(part) // 4, zlib.crc32(part)) + (part,) * with_ids)
                at += len(texts)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _ in fields])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def pack(pieces: DataFrame, *, tokens: int = SEQUENCE_TOKENS, open_bins: int = 128, lane_sequences: int = 4096, window: int = 512) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (doc_id, piece, length, ...); each has 1 to ``tokens`` tokens.

    Full pieces are sequences already. The others are dealt by hash into lanes
    of about ``lane_sequences`` sequences, so the lanes grow in number and not
    in size, and within a lane into windows of about ``window`` pieces, which
    arrive one after the other. Offsets in a sequence are gapless. Rows alike
    in every column, and rows without ids, are packed one by one; an empty
    table gives no rows.
    """
    small = F.col("length") < tokens
    total, rows = pieces.where(small).agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    lanes = max(1, round(total / (tokens * lane_sequences)))
    windows = max(1, round(rows / (lanes * window)))
    lane = F.when(small, F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(lanes))).otherwise(-1 - F.pmod(F.xxhash64("doc_id", "piece"), F.lit(lanes))).cast("long")
    turn = F.pmod(F.xxhash64(F.lit(11), "doc_id", "piece", "ids_crc32"), F.lit(windows))
    # full pieces have lanes of their own: they keep the packing lanes short
    dealt = pieces.withColumn("_lane", lane).withColumn("_turn", turn).repartition(max(2, 2 * lanes), "_lane").sortWithinPartitions("_lane", "_turn", F.desc("length"), "doc_id", "piece").drop("_turn")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, bins = None, OpenBins(tokens, open_bins)
        for batch in batches:
            sequence, offset = np.empty(len(batch), dtype=np.int64), np.empty(len(batch), dtype=np.int64)
            for i, (lane_id, length) in enumerate(zip(batch["_lane"].to_numpy(), batch["length"].to_numpy(), strict=True)):
                if lane_id != at:
                    at, bins = lane_id, OpenBins(tokens, open_bins)
                    base = (2 * lane_id if lane_id >= 0 else -2 * lane_id - 1) << 32
                s, offset[i] = bins.place(int(length))
                sequence[i] = base + s
            yield batch.drop(columns="_lane").assign(sequence_id=sequence, offset=offset)

    from pyspark.sql.types import LongType

    return dealt.mapInPandas(place, pieces.schema.add("sequence_id", LongType()).add("offset", LongType()))


def packed(docs: DataFrame, **options: int) -> DataFrame:
    """Tokenize and pack ``docs`` (doc_id, text; other columns are ignored): one row per piece.

    Defined cases: a null or empty text is one piece of the closing id alone;
    long texts are cut, never shortened; rows alike give rows alike but for
    their places; null ids stay null; an empty table gives no rows.
    """
    return pack(checkpointed(tokenized(docs, tokens=options.get("tokens", SEQUENCE_TOKENS))), **options)


def sequences(packed_ids: DataFrame) -> DataFrame:
    """Whole sequences of pieces that carry ids: sequence_id, doc_ids, ids (little-endian unsigned 32-bit)."""
    parts = packed_ids.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.col("parts.doc_id").alias("doc_ids"), F.aggregate("parts.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"))
