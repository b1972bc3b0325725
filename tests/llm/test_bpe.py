import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tablescope.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def test_texts_match_the_library(spark, documents, edge_docs, reference):
    for docs in (documents, edge_docs):
        got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
               for r in bpe.round_trip_digests(docs, PATH, PATTERN).collect()}
        want = set()
        for r in docs.collect():
            ids = reference.encode_ordinary(r.text or "")
            want.add((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                      hashlib.sha256((r.text or "").encode()).hexdigest()))
        assert got == want


def test_encode_then_decode(edge_docs, no_docs):
    encoded = bpe.encode_documents(edge_docs, PATH, PATTERN)
    back = bpe.decode_documents(encoded, PATH, PATTERN)
    assert sorted((tuple(r) for r in back.collect()), key=repr) == sorted(((r.doc_id, r.text or "") for r in edge_docs.collect()), key=repr)
    assert bpe.encode_documents(no_docs, PATH, PATTERN).count() == 0


def test_random_strings(reference):
    rnd = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "1", "23", ".", "'s", "\xa0", "　", "\x1c", "中", "😀", "<|endoftext|>"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 20))) for _ in range(3000)] + ["", None]
    encoder = bpe.rank_encoder(PATH, PATTERN)
    ids = encoder.encode(pa.array(texts))
    assert [x.tolist() for x in ids] == [reference.encode_ordinary(t or "") for t in texts]
    assert encoder.decode(ids) == [(t or "").encode() for t in texts]
    assert [x.tolist() for x in bpe.RankEncoder(PATH, PATTERN + "|.").encode(pa.array(texts[:50]))] == [
        reference.encode_ordinary(t) for t in texts[:50]]


def test_very_long_pre_token(reference):
    rnd = random.Random(6)
    text = "".join(rnd.choice("abcdefgh") for _ in range(20_000))
    assert bpe.BytePairs(bpe.load_ranks(PATH), PATTERN).encode(text) == reference.encode_ordinary(text)


def test_queue_gives_least_rank_leftmost():
    queue, rnd = bpe.RankQueue(300_000), random.Random(7)
    want = sorted((rnd.randrange(300_000), rnd.randrange(50)) for _ in range(500))
    for x in rnd.sample(want, len(want)):
        queue.push(*x)
    assert [queue.pop() for _ in want] == want and not queue.top
