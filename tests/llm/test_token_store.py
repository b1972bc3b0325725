import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablescope.llm import token_store as S
from tablescope.llm import perfect_hash as H

PATH = public_tokenizers.path("byte_bpe_50k.json")


def agrees(found, docs):
    """Every row is there with its ids, one after the other in the order of ids
    (nulls first); rows that share an id may stand in any order among them."""
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    want = []
    for r in docs.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((r.doc_id, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
    rows = sorted((tuple(r) for r in found.collect()), key=lambda r: r[1])
    assert sorted(((i, n, crc) for i, _, n, crc in rows), key=repr) == sorted(want, key=repr)
    assert [i for i, *_ in rows] == sorted((i for i, *_ in rows), key=lambda i: (i is not None, i or 0))
    assert [at for _, at, _, _ in rows] == [sum(n for _, _, n, _ in rows[:k]) for k in range(len(rows))]
    return True


@pytest.mark.parametrize("shard_ids", [S.SHARD_IDS, 3000])
def test_read_back(documents, shard_ids):
    shards = S.write_store(documents, PATH, shard_ids=shard_ids)
    assert agrees(S.read_store(shards), documents)


def test_edge_cases(edge_docs, no_docs):
    shards = S.write_store(edge_docs, PATH, shard_ids=100)
    assert agrees(S.read_store(shards), edge_docs)
    assert S.read_store(S.write_store(no_docs, PATH)).count() == 0


def test_keyed_access_knows_what_is_missing(documents):
    row = S.write_store(documents, PATH).first().asDict()
    keys, occurrence = S._keys_of(row, 0, row["n_docs"])
    for whole in (True, False):
        reader = S.ShardReader(row["payload"], row["index"], row["width"], whole)
        start, length = reader.find([keys[3], 10 ** 15, keys[0], None], [0, 0, 5, 0])
        assert length[0] > 0 and reader.ids(start[0], length[0])[-1] == 2
        assert list(length[1:]) == [-1, -1, -1]
        every = reader.find(keys, occurrence)
        assert (every[1] > 0).all() and (every[0] == np.cumsum(every[1]) - every[1]).all()
        reader.close()


def test_one_key_reads_a_few_blocks():
    """Whatever the number of keys: the head, a block per level, an entry."""
    for n in (100, 200_000):
        keys = [f"{i}:0" for i in range(n)]
        data = H.build(*H.key_hashes(keys), np.arange(n) * 7, np.full(n, 7))
        read = []
        index = H.Index(lambda place, size: read.append(size) or data[place:place + size], len(data))
        for i in (0, n // 2, n - 1):
            read.clear()
            start, length = index.find([keys[i]])
            assert (start[0], length[0]) == (7 * i, 7)
            assert sum(read) <= 72 * 30 + 24
    assert len(data) > 24 * n


@pytest.fixture()
def hot(spark):
    """A third of the rows without an id, a third with one id, over many tasks."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i % 11} of row {i}" if i % 5 else "same") for i in range(900)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_frequent_ids_are_spread_over_tasks(hot):
    shards = S.write_store(hot, PATH, shard_ids=200)
    sizes = [r["n"] for r in shards.groupBy("task").agg(F.sum("n_docs").alias("n")).collect()]
    assert len(sizes) >= 6 and max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]
    assert agrees(S.read_store(shards), hot)


def test_lookup_finds_every_occurrence(spark, hot):
    shards = S.write_store(hot, PATH, shard_ids=300)
    stored = {}
    for r in sorted(S.read_store(shards).collect(), key=lambda r: r["start"]):
        stored.setdefault(r["id"], []).append((r["start"], r["n_tokens"], r["ids_crc32"]))
    keys = [(i, n) for i, v in stored.items() for n in range(len(v))]
    missing = [(7, len(stored[7])), (None, len(stored[None])), (-1, 0), (10 ** 9, 0), (next(i for i in stored if i and i > 7), 1)]
    found = S.lookup(shards, spark.createDataFrame(keys + missing, "id long, occurrence long")).collect()
    assert len(found) == len(keys) + len(missing)
    got = {(r["id"], r["occurrence"]): r for r in found}
    for i, n in keys:
        start, size, crc = stored[i][n]
        r = got[i, n]
        assert r["start"] == start and len(r["ids"]) == size and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == crc
    assert all(got[k]["ids"] is None and got[k]["start"] is None for k in missing)
    assert S.lookup(S.write_store(hot.where("false"), PATH), spark.createDataFrame([(1, 0)], "id long, occurrence long")).first()["ids"] is None


def test_a_shard_is_read_back_in_parts(spark, documents, hot, monkeypatch):
    for docs in (documents, hot):
        shards = S.write_store(docs, PATH)
        whole = sorted((tuple(r) for r in S.read_store(shards).collect()), key=repr)
        with monkeypatch.context() as m:
            m.setattr(S, "TASK_IDS", 500)
            parts = S.read_store(shards)
            assert parts.rdd.getNumPartitions() > shards.count()
            assert sorted((tuple(r) for r in parts.collect()), key=repr) == whole


def test_perfect_hash_is_minimal():
    keys = [f"k{i}" for i in range(20_000)]
    first, second = H.key_hashes(keys)
    data = H.build(first, second, np.arange(len(keys)), np.ones(len(keys), np.int64))
    index = H.Index(lambda place, n: data[place:place + n], len(data), whole=True)
    assert sorted(index.number(first, second)) == list(range(len(keys))) and index.n == len(keys)
    assert (index.find(keys)[0] == np.arange(len(keys))).all()
    assert (index.find([f"x{i}" for i in range(5000)])[1] == -1).all()


def test_equal_hashes_go_to_the_sorted_rest():
    first = np.array([5, 5, 9], dtype=np.uint64)
    second = np.array([1, 2, 3], dtype=np.uint64)
    data = H.build(first, second, np.array([10, 20, 30]), np.array([1, 2, 3]))
    index = H.Index(lambda place, n: data[place:place + n], len(data))
    number = index.number(first, second)
    assert sorted(number) == [0, 1, 2]
    assert index._records(index.entries_at, H.ENTRY, 3, number)["start"].tolist() == [10, 20, 30]
    none = np.zeros(0, dtype=np.uint64)
    empty = H.build(none, none, none, none)
    assert H.Index(lambda place, n: empty[place:place + n], len(empty)).find(["a"])[1].tolist() == [-1]
