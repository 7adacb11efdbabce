"""Decontamination, alignment of tokenizers and hard negatives against plain code."""

import glob
import hashlib
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from cumload.llm import alignment, decontamination, hard_negatives, queries

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def duck(sql):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    out = con.execute(sql)
    return [c[0] for c in out.description], sorted(out.fetchall(), key=repr)


@pytest.mark.parametrize("name", ["op11_decontamination", "op13_hard_negatives"])
def test_oracle(spark, name):
    out = queries.queries()[name](spark, SF)
    columns, expected = duck(queries.oracle_sql()[name])
    assert out.columns == columns and rows(out) == expected and expected


# decontamination


def plain_scan(docs, benchmark, window=10):
    lower = str.maketrans(decontamination.UPPER, decontamination.LOWER)
    words = lambda t: re.findall(decontamination.WORD, (t or "").translate(lower))
    windows: dict[tuple, set] = {}
    for item, text in benchmark:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + window]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, items = words(text), set(), set()
        for n in {len(p) for p in windows}:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    items |= {str(x) for x in own if x is not None}
        out.append((doc_id, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def leaks(spark):
    rng = random.Random(4)
    some = lambda n: " ".join(rng.choice(["red", "blue", "Grün", "the", "x1", "ÉTÉ", "one"]) for _ in range(n))
    items = [(1, some(30)), (2, "The  answer-is\tyes"), (3, "the"), (3, "another text of item three, said twice"), (None, "a nameless item"), (5, None), (6, " ,.; "), (10, some(10)), (7, "overlap a b a b a b a b a b")]
    docs = [(1, None), (2, ""), (3, items[0][1].upper().replace(" ", ", ")), (4, "no " * 50), (5, f"é {items[7][1]}!{items[0][1]}"), (5, f"é {items[7][1]}!{items[0][1]}"), (6, "A NAMELESS;ITEM and the answer is yes"), (7, "x" * 100_000 + " theatre the"), (None, "the"), (None, "the"), (None, "nothing"), (8, "overlap " + "a b " * 3000), (9, "ÉTÉ \x7f the\x00the"), (11, "answer is yes the")]
    docs += [(20 + k, some(rng.randint(1, 300))) for k in range(40)]
    return docs, items, spark.createDataFrame([(*d, "?", 1) for d in docs], "doc_id long, text string, n_words string, items int").repartition(3), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_pairs", [200_000, 9])
def test_windows_and_short_items_are_found(leaks, block_pairs):
    docs, items, table, benchmark = leaks
    assert rows(decontamination.report(decontamination.scan(table, benchmark, block_pairs=block_pairs))) == plain_scan(docs, items)


def test_hits_have_places_in_the_original_text(leaks):
    docs, _, table, benchmark = leaks
    texts = dict(d for d in docs if d[0] is not None)
    for r in decontamination.scan(table, benchmark).collect():
        for h in r.hits:
            part = (texts.get(r.doc_id) or "the")[h.start : h.end]
            assert len(re.findall(decontamination.WORD, part.lower())) == h.words and re.match(r"\w", part) and re.search(r"\w$", part)


def test_without_benchmark_or_documents(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    out = decontamination.report(decontamination.scan(odd_docs, none)).collect()
    assert len(out) == odd_docs.count() and not any(r.contaminated or r.n_items for r in out)
    assert decontamination.scan(no_docs, none).count() == 0


# alignment


def plain_align(texts):
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    found, count = [], Counter()
    for text in texts:
        a = t.encode(" " + text, add_special_tokens=False) if text else None
        b = sp.encode(text, num_threads=1) if text else []
        size_a = [bytes(letters[c] for c in x) for x in a.tokens] if text else []
        size_b = [bytes([int(p[3:-1], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [sp.id_to_piece(i)]]
        if not text or b"".join(size_a) != (" " + text).encode() or b"".join(size_b) != (" " + text).encode():
            found.append(None)
            continue
        (at, starts_a), (bt, starts_b) = ((ids, np.cumsum([0, *map(len, size)])) for ids, size in ((a.ids, size_a), (b, size_b)))
        links = [(at[i], bt[j]) for i in range(len(at)) for j in range(max(0, np.searchsorted(starts_b, starts_a[i], "right") - 1), min(len(bt), np.searchsorted(starts_b, starts_a[i + 1]) + 1)) if starts_b[j] < starts_a[i + 1] and starts_a[i] < starts_b[j + 1]]
        cuts = sorted(set(starts_a.tolist()) & set(starts_b.tolist()))
        of = lambda ids, starts, lo, hi: ",".join(map(str, ids[np.searchsorted(starts, lo) : np.searchsorted(starts, hi)]))
        groups = [f"{of(at, starts_a, lo, hi)}|{of(bt, starts_b, lo, hi)}" for lo, hi in zip(cuts, cuts[1:], strict=False)]
        found.append((len(at), len(bt), groups, links))
        count.update(links)
    best: dict[int, int] = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else (f[0], f[1], len(f[2]), len(f[3]), sum(count[x] == best[x[1]] for x in f[3]), sum(count[x] for x in f[3]), hashlib.sha256(";".join(f[2]).encode()).hexdigest()) for f in found]


def odd_texts():
    rng = random.Random(9)
    alphabet = ["a", "the", "ing", " ", " ", "  ", "\n", "\t", "\r\n", "é", "ñ", "漢字", "🙂", "1234", "'s", ".", "\x00", "\x1c", "\x85", "\xa0", " ", "<s>", "<|endoftext|>", "<unk>", "<0x0A>", "Ω", "ﬁ", "̈"]
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(150)]
    return [None, "", " ", "  ", "   ", "\n", " \n ", "a ", "a  ", "a\n b", "a\n\n  b", "a▁b", "▁", "plain words here", "plain words here", "<s> and </s>", "x" * 3000, "word " * 2000, *made]


def test_alignment(spark):
    texts = odd_texts() + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(30).collect()]
    table = spark.createDataFrame([(i if i != 5 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_a string").repartition(3)
    out = {r.doc_id: tuple(r)[1:] for r in alignment.align(table).collect()}
    expected = plain_align(texts)
    assert [x[:3] + x[6:] for x in expected] == [out[i if i != 5 else None][:3] + out[i if i != 5 else None][6:] for i in range(len(texts))]
    assert [out[i if i != 5 else None] for i in range(len(texts))] == expected and sum(x[0] > 0 for x in expected) > 100


def test_alignment_in_small_batches(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").coalesce(1)
    whole = rows(alignment.align(table))
    assert whole == rows(alignment.align(table.repartition(5))) and len(whole) == 200
    tool, batch = alignment.aligner(*alignment.paths()), alignment.Batch(7, pa.int64())
    texts = ["a b", "b a b", "▁ a", ""]
    out = batch.part([1, 2, 3, 4], texts, tool).to_pylist()
    numbers = {r["number"]: (r["group"], r["freq"]) for r in batch.dictionary().to_pylist()}
    assert [r["n_a"] for r in out] == [2, 3, 0, 0] and sum(f for _, f in numbers.values()) == 5 and all(r["batch"] == 7 for r in out)


def test_alignment_of_nothing(odd_docs, no_docs):
    assert alignment.align(no_docs).count() == 0
    assert alignment.align(odd_docs).count() == odd_docs.count()


# hard negatives


def plain_mine(table, every=10, k=5, n=10, least=30, most=90):
    use = [(i, lab, tuple(int(np.floor(256 * float(x))) for x in v)) for i, v, lab in table if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    use = [x for x in {i: min((y for y in use if y[0] == i), key=lambda y: (y[1], y[2])) for i, *_ in use}.values()]
    out = []
    for a, lab, v in (x for x in use if x[0] % every == 0):
        meet = [(-sum(p * q for p, q in zip(v, w, strict=True)), i, label) for i, label, w in use if i != a and len(w) == len(v)]
        for s, p, _ in sorted(x for x in meet if x[2] == lab)[:k]:
            fit = sorted(x for x in meet if x[2] != lab and least * -s <= 100 * -x[0] <= most * -s)[:n]
            out += [(a, p, r + 1, i, -s, -t) for r, (t, i, _) in enumerate(fit)]
    return sorted(out, key=repr)


def vectors(rng, n, dims, labels=4, spread=1.0):
    return [(i, [float(np.float32(x)) for x in rng.normal(size=dims) * spread], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("dims,spread", [(8, 0.3), (7, 0.3), (3, 0.01), (64, 5000.0)])
def test_hard_negatives(spark, dims, spread):
    table = vectors(np.random.default_rng(dims), 600, dims, spread=spread)
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, label int").repartition(4)
    expected = plain_mine(table)
    assert rows(hard_negatives.mine(df, every=10)) == expected and len(expected) > 100
    assert rows(hard_negatives.mine(df, every=10, block_rows=70, anchor_rows=9, sample_rows=300)) == expected


def test_hard_negatives_of_odd_rows(spark):
    rng = np.random.default_rng(1)
    same = [0.5, -0.25, 0.125]
    table = [(i, same, i % 3) for i in range(200)] + [(1000 + i, v, lab) for i, v, lab in vectors(rng, 100, 3, 3)] + [(2000, None, 1), (2010, [1.0, None, 2.0], 1), (2020, [1.0, float("nan"), 2.0], 1), (2030, [float("inf"), 0.0, 0.0], 1), (2040, same, None), (None, same, 1), (2050, [], 1), (2051, [], 1), (2052, [], 0), (2060, [0.0, 0.0, 0.0], 1), (2070, [1.0, 2.0], 1), (2071, [1.0, 2.5], 1), (2072, [0.5, 1.0], 0), (10, same, 1), (1010, [9.0, 9.0, 9.0], 2)]
    df = spark.createDataFrame([(*r, "x") for r in table], "vec_id long, embedding array<double>, label int, rank string").repartition(4)
    expected = plain_mine(table)
    assert rows(hard_negatives.mine(df, every=10)) == expected and rows(hard_negatives.mine(df, every=10, block_rows=20, anchor_rows=3)) == expected
    assert {r[0] for r in expected} >= {0, 1000, 2050}
    assert hard_negatives.mine(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        hard_negatives.mine(spark.createDataFrame([(0, [1e12], 1)], "vec_id long, embedding array<double>, label int"))


def test_bounds_hold_every_product():
    rng = np.random.default_rng(2)
    x = hard_negatives._padded(np.rint(rng.normal(size=(900, 10)) * 300).astype(np.int64).ravel(), 900, 10)
    book = np.zeros((5, hard_negatives.CENTROIDS, 2), dtype=np.int64)
    for m in range(5):
        found = hard_negatives.centroids(x[:, m])
        book[m, : len(found)], book[m, len(found) :] = found, found[-1]
    code, residual = hard_negatives.encode(x, book)
    block = hard_negatives.Block(np.arange(900), np.zeros(900), x.reshape(900, -1), np.ascontiguousarray(code.T), residual)
    low, high = block.bounds(x[:50].reshape(50, -1), book)
    true = x[:50].reshape(50, -1) @ x.reshape(900, -1).T
    assert (low <= true).all() and (true <= high).all() and (high - low).mean() < 0.4 * np.abs(true).max()
