"""The corpus pipeline against a plain version of its stages."""

from collections import Counter

import corpus_pipeline
from tablescope.llm import pii
from tests.llm.conftest import SF
from tests.llm.test_minhash_dedup import brute as groups
from tests.llm.test_packing import pieces_of
from tests.llm.test_quality_rules import brute as measured
from tablescope.llm import quality_rules

import public_tokenizers
from tokenizers import Tokenizer


def good(text):
    """The quality rules' verdict, from plainly counted measures."""
    words, chars, symbols, dup_lines, _, failed = measured(text)
    if failed:
        return False
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    stop = sum(w.lower() in quality_rules.STOP_WORDS for w in text.split())
    return (2 <= chars / words <= 20 and symbols / words <= 0.25 and dup_lines / len(lines) <= 0.5
            and (words < quality_rules.SHARE_WORDS or stop / words >= 0.02))


def plain(rows):
    rows = [(i, t) for i, t in rows if good(t)]
    gone = {i for i, _, _, kept in groups(rows, 5, 80) if not kept}
    out = []
    for i, t in rows:
        if i not in gone:
            out.append((i, pii.masked(t, pii.all_spans([t], pii.trained())[1][0])))
    return out


def expected(rows):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return Counter((i, *p) for i, text in plain(rows)
                   for p in pieces_of(t.encode(text, add_special_tokens=False).ids + [0], 2048))


def staged(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    return Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in docs.collect())


def test_run_matches_the_plain_version(spark, documents):
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == expected([(r.doc_id, r.text) for r in documents.collect()])


def test_edge_cases(spark, edge_docs, no_docs):
    assert staged(spark, edge_docs) == expected([(r.doc_id, r.text) for r in edge_docs.collect()])
    assert not staged(spark, no_docs)


def test_stage_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "personal data",
                                                            "best-fit packing"]
