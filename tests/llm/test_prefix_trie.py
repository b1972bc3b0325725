import hashlib
import random
import zlib

import pytest

from tablescope.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int"


def digest(role, text):
    return hashlib.sha256(b"".join(hashlib.sha256((x or "").encode()).hexdigest().encode() for x in (role, text))).hexdigest()


def brute(rows, group=100, most=6):
    """Every prefix of every conversation, counted in dictionaries."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest(role, text), role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (c % group if c >= 0 else -(-c % group))
        built[c] = own.get(base, [])[:h] + v[h:]
    through = {}
    for c, v in built.items():
        for d in range(len(v) + 1):
            through.setdefault(tuple(v[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in sorted(through, key=len, reverse=True):
        leaves[p] = leaves.get(p, 0) or 1
        saved[p] = saved.get(p, 0) + ((len(through[p]) - 1) * len(p[-1][1]) if p else 0)
        if p:
            up = p[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[p]
            saved[up] = saved.get(up, 0) + saved[p]
    out = []
    for p, convs in through.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(p))
        out.append((min(convs), len(p), min(through[p[:-1]]) if p else None, len(convs), children.get(p, 0), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def found(spark, rows, parts=3):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in P.prefix_trie(frame).collect())


def conversation(rnd, conv, n, words=2):
    return [(conv, i, rnd.choice(["user", "assistant"]), rnd.choice("abcé😀"[:words]) * (1 + i % 3)) for i in range(n)]


def test_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [r for c in range(150) for r in conversation(rnd, c, rnd.randrange(1, 12), 3)]
    rows += [r for c in range(400, 420) for r in conversation(random.Random(1), c, 9)]  # copies
    rows += [r for c in range(903, 930) for r in conversation(rnd, c, rnd.randrange(1, 4))]  # no base: some end turnless
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 33])
def test_depths_at_powers_of_two(spark, n):
    rnd = random.Random(n)
    same = conversation(rnd, 100, n)
    rows = same + [(c, i, r, t if i < n - 1 or c % 2 else "other") for c in (101, 102, 103) for _, i, r, t in same]
    rows += [(200, i, "user", "b") for i in range(n // 2 + 1)]
    assert found(spark, rows, 2) == brute(rows)


def test_hot_conversation(spark):
    """One conversation holds most turns, over many tasks."""
    rnd = random.Random(3)
    rows = conversation(rnd, 5, 3000) + [r for c in range(300, 340) for r in conversation(rnd, c, 5)]
    assert found(spark, rows, 8) == brute(rows)


def test_edge_cases(spark):
    rows = [(None, 0, "user", "x"), (0, None, "user", "first"), (0, 0, None, None), (0, 0, "", ""), (0, 0, "", ""),
            (0, 3, "user", "a"), (0, 3, "user", "b"), (1, 5, "user", "z" * 100_000), (1, -4, "user", "neg"), (7, None, None, None),
            (-5, 1, "user", "m"), (-105, 1, "user", "n"), (-100, 2, "user", "o"), (250, 1, "user", "p"), (3, 1, "user", "\x00")]
    assert found(spark, rows) == brute(rows)


def test_few_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []
    turnless = [(c, 0, "user", "x") for c in range(101, 110) if zlib.crc32(str(c).encode()) % 6][:4]
    assert found(spark, turnless) == brute(turnless) and len(brute(turnless)) == 1


def test_ids_are_joined_in_ranges(spark, monkeypatch):
    rows = [(bytes([i % 3]), c) for i, c in enumerate(random.Random(1).sample(range(10_000), 3000))]
    want = {k: hashlib.sha256(",".join(str(c) for n, c in sorted(rows) if n == k).encode()).hexdigest() for k in (b"\0", b"\1", b"\2")}
    frame = spark.createDataFrame(rows, "node binary, conv long")
    assert {bytes(r["node"]): r["ends_sha256"] for r in P._ends_digest(frame).collect()} == want
    import pyarrow as pa
    monkeypatch.setattr(P, "CHUNK", 7)
    batches = [pa.RecordBatch.from_arrays([pa.array([k for k, _ in sorted(rows)][a:a + 100], pa.binary()),
                                           pa.array([c for _, c in sorted(rows)][a:a + 100], pa.int64())], names=["node", "conv"])
               for a in range(0, 3000, 100)]
    assert {n[0].as_py(): d[0].as_py() for b in P._hash_ids(P._join_ids(iter(batches))) for n, d in
            [(b.column("node").slice(i, 1), b.column("ends_sha256").slice(i, 1)) for i in range(b.num_rows)]} == want


def test_tables_of_rounds_are_deleted(spark):
    from tablescope import session
    made = []
    real = session._delete
    try:
        session._delete = lambda s, p: (made.append(p), real(s, p))
        frame = spark.createDataFrame([(1, 0, "user", "a", "x", 1)], SCHEMA)
        assert P.prefix_trie(frame).count() > 0
    finally:
        session._delete = real
    assert made
