import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tablescope.llm import minhash_dedup as M
from tablescope.llm.components import connected_components
from tablescope.llm.shingles import shingle_sets
from tests.llm.conftest import EDGE_SCHEMA

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i: i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, k, percent):
    """{(id, set size, component, kept)} by comparing all pairs."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    ids = sorted({i for i, _ in sets if i is not None})
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    own = [(i, s) for i, s in sets if i is not None and s]
    for a in range(len(own)):
        for b in range(a):
            (i, s), (j, t) = own[a], own[b]
            if i != j and 100 * len(s & t) >= percent * len(s | t):
                i, j = sorted((find(i), find(j)))
                parent[j] = i
    return sorted(((i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets), key=repr)


def found(docs, k, percent, **more):
    return sorted((tuple(r) for r in M.near_duplicates(docs, words=k, percent=percent, **more).collect()), key=repr)


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_matches_all_pairs(documents, k, percent):
    assert found(documents, k, percent) == brute([(r.doc_id, r.text) for r in documents.collect()], k, percent)


def test_edge_cases(edge_docs, no_docs):
    assert found(edge_docs, 3, 85) == brute([(r.doc_id, r.text) for r in edge_docs.collect()], 3, 85)
    assert M.near_duplicates(no_docs).count() == 0


def chained(n_groups, size, seed, words=60):
    """Groups of copies with more and more edits: many links near the
    threshold, chains, and members that only some others link to."""
    rnd, rows = random.Random(seed), []
    for g in range(n_groups):
        base = [f"w{rnd.randrange(5000)}" for _ in range(words)]
        texts = [base]
        for _ in range(size - 1):
            t = list(rnd.choice(texts[-5:] if rnd.random() < 0.5 else [base]))
            for _ in range(rnd.randint(0, 4)):
                t[rnd.randrange(len(t))] = f"e{rnd.randrange(10 ** 6)}"
            texts.append(t)
        rows += [" ".join(t) for t in texts]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_lose_no_link(spark, seed):
    rows = chained(6, 40, seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs, 3, 85) == brute(rows, 3, 85)


def test_star_edges_are_linear_and_the_rest_is_pruned(spark):
    """A large group: what is checked on full sets is far below all pairs."""
    rows = chained(1, 300, 3, words=150)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    checked = []
    whole = M._checked
    M._checked = lambda pairs, sets, percent: checked.append(pairs.count()) or whole(pairs, sets, percent)
    try:
        got = found(docs, 3, 85)
    finally:
        M._checked = whole
    assert got == brute(rows, 3, 85)
    assert sum(checked) < 300 * 299 / 2 / 4


def test_densified_signature_keeps_similarity():
    rnd = np.random.default_rng(4)
    for size in (1, 5, 40, 400):
        a = np.unique(rnd.integers(0, 2 ** 63, size, dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.append(a[: max(1, int(size * 0.9))], rnd.integers(0, 2 ** 63, size // 10 + 1, dtype=np.uint64)))
        same = (M.signature(a, 2520) == M.signature(b, 2520)).mean()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(same - true) < 0.2
        assert (M.signature(a, 2520) == M.signature(a.copy(), 2520)).all()


def test_shingles_of_many_texts_at_once():
    texts = ["A b\tC", "a B c", "", None, "   ", "c b a", "a bc", "ab c", "é Ü", "É ü", "word " * 30000]
    sets = [s.tobytes() for s in shingle_sets(pa.array(texts), 3)]
    want = [shingles(t, 3) for t in texts]
    for i in range(len(texts)):
        assert len(np.frombuffer(sets[i], np.uint64)) == len(want[i])
        for j in range(i):
            assert (sets[i] == sets[j]) == (want[i] == want[j]), (texts[i], texts[j])


def test_components_of_paths_and_stars(spark):
    edges = [(i + 1, i) for i in range(100, 150)] + [(7, x) for x in range(200, 230)] + [(5, 5), (300, 7), (150, 299)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[x] for x in range(100, 151)} == {100} and got[299] == 100
    assert {got[x] for x in (7, 300, *range(200, 230))} == {7}


def test_extra_columns_and_null_ids(spark):
    rows = [(None, "a b c d", None, None, None, None, None, None), (4, "a b c d", "x", "y", 1, "z", 1, 1),
            (3, "A B C D", None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, EDGE_SCHEMA)
    assert found(docs, 3, 85) == [(3, 2, 3, True), (4, 2, 3, False), (None, 2, None, True)]


#: A text, a near copy, and one of its own.
Y, NEAR_Y, X = " ".join(f"y{i}" for i in range(60)), " ".join(f"y{i}" for i in range(59)), " ".join(f"x{i}" for i in range(60))


@pytest.mark.parametrize("rows", [
    [(5, X), (5, Y), (7, NEAR_Y)],
    [(5, Y), (5, X), (7, NEAR_Y)],
    [(7, X), (7, Y), (5, NEAR_Y)],
    [(5, X), (5, Y), (3, X), (7, NEAR_Y)],
    [(5, X), (5, Y), (3, X), (4, Y), (9, X)],
])
def test_rows_that_share_an_id_are_linked_by_each_of_their_texts(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert found(docs, 3, 85) == brute(rows, 3, 85)


def test_a_pair_is_checked_by_each_set_of_its_first_id():
    sets = [s.tobytes() for s in shingle_sets(pa.array([X, Y, NEAR_Y]), 3)]
    batch = pa.RecordBatch.from_pydict({"a": [5, 5], "b": [7, 7], "set_a": sets[:2], "set_b": [sets[2]] * 2})
    both = pa.RecordBatch.from_pydict({"a": [5, 5], "b": [7, 7], "set_a": sets[1::-1], "set_b": [sets[2]] * 2})
    assert [out.column("linked").to_pylist() for out in M._check(85)([batch, both])] == [[False, True], [True, False]]


def compared(docs, monkeypatch, **more):
    """The rows found, and how many pairs were compared on full sets."""
    pairs = []
    whole = M._checked
    monkeypatch.setattr(M, "_checked", lambda p, sets, percent: pairs.append(p.count()) or whole(p, sets, percent))
    got = found(docs, 3, 85, **more)
    monkeypatch.undo()
    return got, sum(pairs)


def unlinked(size, seed=1, words=150, edits=9):
    """Copies of one text that share bands with all others but reach the
    similarity with none, or with few."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(5000)}" for _ in range(words)]
    rows = []
    for i in range(size):
        t = list(base)
        for at in rnd.sample(range(words), edits):
            t[at] = f"e{rnd.randrange(10 ** 9)}"
        rows.append((i, " ".join(t)))
    return rows


def test_a_group_that_stays_unlinked_costs_in_proportion(spark, monkeypatch):
    counts = {}
    for size in (300, 600):
        rows = unlinked(size)
        got, counts[size] = compared(spark.createDataFrame(rows, "doc_id long, text string"), monkeypatch)
        assert got == brute(rows, 3, 85)
        assert sum(r[3] for r in got) > 0.9 * size
    assert counts[600] < 2.5 * counts[300] and counts[600] < 600 * 30


def test_many_texts_of_one_id_cost_in_proportion(spark, monkeypatch):
    counts = {}
    for size in (150, 300):
        rnd = random.Random(2)
        texts = [" ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(60)) for _ in range(size)]
        rows = [(7, t) for t in texts] + [(100 + i, t.rsplit(" ", 1)[0]) for i, t in enumerate(texts)]
        got, counts[size] = compared(spark.createDataFrame(rows, "doc_id long, text string"), monkeypatch)
        assert {r[2] for r in got} == {7}
        assert [r[3] for r in got].count(True) == size
    assert counts[300] <= 2.1 * counts[150] <= 2.1 * 160


def test_rows_repeated_as_a_whole(spark, monkeypatch):
    rows = [(i, t) for i, t in [(1, Y), (2, NEAR_Y), (3, X)] for _ in range(50)]
    got, n = compared(spark.createDataFrame(rows, "doc_id long, text string"), monkeypatch)
    assert got == brute(rows, 3, 85) and n == 1


def test_levels_order_by_how_many_sets_share_a_shingle(spark):
    rnd = random.Random(9)
    df = {rnd.randrange(-(2 ** 63), 2 ** 63): rnd.choice([2, 3, 4, 9, 70, 5000]) for _ in range(3000)}
    levels = M._levels(spark.createDataFrame(list(df.items()), "shingle long, df long"))
    own = np.array(list(df), dtype=np.int64).view(np.uint64)
    found_in = M.rarity(own, [np.frombuffer(x, np.uint8) for x in levels])
    exact = np.array([n.bit_length() - 1 for n in df.values()])
    assert (found_in >= exact).all() and (found_in == exact).mean() > 0.8
    alone = np.array([rnd.randrange(2 ** 64) for _ in range(3000)], dtype=np.uint64)
    assert (M.rarity(alone, [np.frombuffer(x, np.uint8) for x in levels]) == 0).mean() > 0.8
    assert M._levels(spark.createDataFrame([], "shingle long, df long")) == []
