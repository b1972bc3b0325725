import random
import struct
import tempfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tablescope.llm import packing as P
from tablescope.llm.encoding import encoder, text_slices

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def pieces_of(ids, size):
    out, first = [], (len(ids) - 1) % size + 1
    cuts = [0, *range(first, len(ids) + 1, size)]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        out.append((k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))))
    return out


def check(docs, tokenizer, size):
    rows = P.pack_documents(docs, PATH, size=size).collect()
    want = Counter()
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        want.update((r.doc_id, *p) for p in pieces_of(ids, size))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences), sum(r.length for r in rows)


def test_documents(documents, tokenizer):
    n, total = check(documents, tokenizer, 2048)
    assert n <= -(-total // 2048) * 1.02 + 1


@pytest.mark.parametrize("size", [7, 64])
def test_edge_cases(edge_docs, tokenizer, size):
    check(edge_docs, tokenizer, size)


def test_empty_table(no_docs):
    assert P.pack_documents(no_docs, PATH).count() == 0


def test_sequences_hold_the_ids(documents, tokenizer):
    placed = P.pack_documents(documents, PATH, with_ids=True)
    got = {r.sequence_id: r.ids for r in P.packed_sequences(placed).collect()}
    for r in placed.collect():
        assert got[r.sequence_id][r.offset: r.offset + r.length] == r.ids
    assert sum(map(len, got.values())) == sum(r.length for r in placed.collect())


def test_plan_uses_the_histogram_up():
    rnd = random.Random(8)
    for size in (10, 100, 512):
        histogram = {k: rnd.randint(1, 1000) for k in rnd.sample(range(1, size + 1), size // 2)}
        planned = P.plan(histogram, size)
        used = Counter()
        for lengths, n in planned:
            assert n > 0 and sum(lengths) <= size
            for k in lengths:
                used[k] += n
        assert used == histogram
        # no worse than best fit, longest first, which is within 2/9 of the least
        assert sum(n for _, n in planned) <= sum(n for _, n in P.best_fit_rest(histogram, size))
    assert P.plan({}, 10) == []
    assert P.plan({10: 3}, 10) == [((10,), 3)]


def test_least_squares_uses_patterns_of_a_perfect_histogram():
    planned = P.plan({60: 500, 40: 500, 50: 400, 30: 300, 20: 300}, 100)
    assert sum(n for _, n in planned) == -(-sum([60 * 500, 40 * 500, 50 * 400, 30 * 300, 20 * 300]) // 100)


def test_encoder_matches_the_library(tokenizer):
    rnd = random.Random(9)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "1", "23", ".", "'s", "\xa0", "　", "\x1c", "\x85", " ", "中",
             "😀", "<|endoftext|>", "ǅ", "\r\n", "\x00", "the", " The", "don't"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 20))) for _ in range(3000)] + [None, "", " ", "x" * 9000]
    array = pa.array(texts)
    got = [ids for a, b in text_slices(array) for ids in encoder(PATH).encode(array.slice(a, b - a))]
    want = [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in got] == want and got[0].dtype == np.dtype("<u2")


def test_special_tokens_as_the_unmodified_library_reads_them():
    plain = Tokenizer.from_file(PATH)
    rnd = random.Random(10)
    parts = ["a", " ", "  ", "\n", "the", " The", "<|endoftext|>", "<|endoftext|", "|>", "é", "1"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(2000)]
    texts += ["one <|endoftext|> two", None, "", "<|endoftext|>", " <|endoftext|> "]
    got = encoder(PATH, True).encode(pa.array(texts))
    want = [e.ids for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in got] == want


def test_queries_use_the_unmodified_tokenizer(spark):
    import corpus_pipeline
    from tablescope.llm import queries

    folder = tempfile.mkdtemp(prefix="tablescope-test-special-")
    docs = [(1, "one <|endoftext|> two"), (2, "three four"), (3, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    frame.write.parquet(f"{folder}/documents.parquet")
    plain = Tokenizer.from_file(PATH)
    ids = {i: plain.encode(t or "", add_special_tokens=False).ids for i, t in docs}
    want = {i: (len(x) + 1, zlib.crc32(struct.pack(f"<{len(x) + 1}I", *x, 0))) for i, x in ids.items()}
    for rows in (queries.op4_best_fit_packing(spark, folder), corpus_pipeline.packing_stage(spark, frame, folder)):
        assert {r.doc_id: (r.length, r.ids_crc32) for r in rows.collect()} == want
    at, want = 0, {}
    for i, x in ids.items():
        want[i] = (at, len(x) + 1, zlib.crc32(struct.pack(f"<{len(x) + 1}I", *x, 2)))
        at += len(x) + 1
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op6_token_store(spark, folder).collect()} == want
