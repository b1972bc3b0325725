import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tablescope.llm import lexical as L

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(docs, items, k=10):
    counted = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in {(i, t) for i, t in items}:
        scored = []
        for d, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in TERM.findall((text or "").translate(LOWER)) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, n, d, -s) for n, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, k=10):
    d = spark.createDataFrame([(i, t, "x", 1.0, 2) for i, t in docs], "doc_id long, text string, term string, score double, item int")
    q = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc string")
    return sorted((tuple(r) for r in L.search(d, q, k=k).collect()), key=str)


@pytest.fixture(scope="module")
def words():
    rnd = random.Random(4)
    names = [f"w{i}" for i in range(40)] + ["Über", "naïve", "日本", "X9", "ſ"]
    docs = [(i, " ".join(rnd.choices(names, range(len(names), 0, -1), k=rnd.randrange(1, 60)))) for i in range(200)]
    docs += [(500 + i, docs[3][1]) for i in range(60)]  # ties
    docs += [(7, docs[7][1]), (None, docs[9][1]), (900, None), (901, ""), (902, "?! ..."), (903, "w1-W1_w1\x00w2\x7fw3")]
    items = [(i, " ".join(rnd.choices(names, k=rnd.randrange(1, 12)))) for i in range(30)]
    items += [(1, "w1 w1 w1 W2"), (1, "w1 w1 w1 W2"), (77, None), (78, ""), (79, "nowhere"), (None, "w3 w4")]
    return docs, items


def test_matches_brute_force(spark, words):
    assert found(spark, *words) == brute(*words)


def test_small_tiles_and_blocks(spark, words, monkeypatch):
    """The same rows whatever is cut: documents, items, vocabulary, kept lists."""
    q = words
    want = brute(*q, k=3)
    docs = spark.createDataFrame(q[0], "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(q[1], "item_id long, text string")
    assert sorted((tuple(r) for r in L.search(docs, items, k=3).collect()), key=str) == want
    for name, value in (("TILE_DOCS", 7), ("TILE_BYTES", 64), ("BLOCK_TERMS", 3), ("KEPT_BEST", 5), ("KEPT_WEIGHTS", 4)):
        monkeypatch.setattr(L, name, value)
    bits = bytes(b"\xff" * (L.BITS // 8))
    counts = [Counter(TERM.findall((t or "").translate(LOWER))) for _, t in q[0]]
    n, total = sum(bool(c) for c in counts), sum(sum(c.values()) for c in counts)
    df = Counter(t for c in counts for t in c)
    rows = [(i, t, c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))))
            for i, (_, text) in enumerate(sorted(set(q[1]), key=str))
            for t, c in Counter(TERM.findall((text or "").translate(LOWER))).items()]
    table = pa.table({"item": [r[0] for r in rows], "term": [r[1] for r in rows], "weight": [r[2] for r in rows]})
    tile = L.ItemTile([table])
    best = L.Best(len(tile.items), 3)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in q[0]], pa.int64()),
                                        pa.array([t.encode() if t is not None else None for _, t in q[0]], pa.binary())],
                                       names=["doc", "text"])
    for docs in L._doc_tiles([batch], bits):
        doc, term, tf, distinct = docs.counts()
        impact = L.impacts_of(tf, L.length_norms(docs.sizes, n, total)[doc])
        best.add(tile.scores(len(docs.ids), doc, term, impact, distinct),
                 np.array([i or 0 for i in docs.ids]), np.array([int(i is None) for i in docs.ids]))
    names = [i for i, _ in sorted(set(q[1]), key=str)]
    out, place = [], Counter()
    for item, doc, null, score in zip(best.item, best.doc, best.null, best.score):
        at = int(tile.items[item])
        place[at] += 1
        out.append((names[at], place[at], None if null else int(doc), int(score)))
    assert sorted(out, key=str) == want


def test_partial_sums_stay_exact():
    """No row of a block has weights whose sums could leave float64's integers."""
    rnd = random.Random(2)
    rows = [(rnd.randrange(4), f"t{i % 50}", rnd.choice([5, 10**9, 3 * L.ROW_WEIGHTS + 17])) for i in range(120)]
    rows = list({(i, t): (i, t, w) for i, t, w in rows}.values())
    total = Counter()
    for vocabulary, entries in L.blocks(rows, 4):
        load = Counter()
        for i, c, w in entries:
            load[i] += w
            total[i, vocabulary[c].decode()] += w
        assert max(load.values()) * 10**6 < 2**53
    assert total == {(i, t): w for i, t, w in rows}


def test_long_texts(spark, monkeypatch):
    docs = [(1, "alpha beta " * 600_000), (2, "alpha " + "x" * 6_000_000 + " beta"), (3, "gamma")]
    items = [(1, "alpha"), (2, "beta beta gamma"), (3, "alpha " * 1_000_000)]
    assert found(spark, docs, items) == brute(docs, items)


def test_few_rows(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None)], [(1, "a"), (2, None)]) == []
    assert found(spark, [(1, "a")], [(1, "a")]) == brute([(1, "a")], [(1, "a")])


def test_edge_documents(spark, edge_docs, no_docs):
    items = [(1, "quick brown fox"), (2, "words without an id"), (3, "endoftext EMAIL"), (None, "seven six")]
    q = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    got = L.search(edge_docs, q, k=4).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, items, k=4)
    assert L.search(no_docs, q).count() == 0
