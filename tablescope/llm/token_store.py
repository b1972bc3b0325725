"""Token ids on disk with constant-time keyed access.

Documents are range-partitioned and sorted by id; each task writes shards. A
shard is a payload file of raw little-endian ids (2 bytes each if the
vocabulary allows, else 4), one document after the other, a file of the
documents' keys in the same order, and an index file: a minimal perfect hash
over the keys and, at each key's number, a stored 64-bit fingerprint, the
document's first id and its number of ids. A look-up (:func:`lookup`) finds the
shard by the ids that shards begin with, hashes the key, reads a block of bits
per level and one index entry, compares the fingerprint and reads one range of
the payload. A table of shards names the files; only files of task attempts that
Spark committed are named there, so a lost executor leaves nothing but unnamed
files.

Keys are (id, occurrence): rows that share an id are kept one after the other,
in the order in which they are read, and numbered from 0. An id may hold a third of
all rows: its rows lie over many tasks, each of which numbers its own, and the
table of shards says how many come before. A null id is a key of its own and
comes first; a null text has the end id alone. Extra columns are ignored. An
empty table gives no shards.
"""

from __future__ import annotations

import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablescope.llm import perfect_hash
from tablescope.llm.encoding import encoder, text_slices
from tablescope.llm.files import file_system, shared_folder
from tablescope.session import materialize, materialize_observed

#: Ids and documents in one shard at most, but for a longer document.
SHARD_IDS, SHARD_DOCS = 1 << 26, 1 << 20
#: Ids read at once, and ids that one task reads back.
READ_IDS, TASK_IDS = 1 << 21, 1 << 24
#: Parts that the keys of one shard are dealt to when they are looked up.
LOOKUP_PARTS = 16

_SHARD = ("task long, shard long, payload string, keys string, index string, width int, n_ids long, n_docs long, "
          "nulls long, first_id long, first_occurrence long, n_first long, last_id long, n_last long")
_NAMES = [c.split()[0] for c in _SHARD.split(", ")]
_KINDS = [{"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[c.split()[1]] for c in _SHARD.split(", ")]


def _key(i: int | None, occurrence: int) -> str:
    return f"{'' if i is None else i}:{occurrence}"


class _Shard:
    """One shard being written."""

    def __init__(self, folder: str, task: int, number: int):
        fs, path = file_system(folder)
        fs.create_dir(path, recursive=True)
        name = f"/{task:06d}-{number:04d}-{uuid.uuid4().hex}"
        self.fs, self.path = fs, path + name
        self.task, self.number, self.name = task, number, folder + name
        self.out = fs.open_output_stream(self.path + ".ids")
        self.keys: list[int | None] = []
        self.occurrence: list[int] = []
        self.lengths: list[int] = []
        self.total = 0

    def add(self, key: int | None, occurrence: int, ids: np.ndarray) -> None:
        self.out.write(ids.tobytes())
        self.keys.append(key)
        self.occurrence.append(occurrence)
        self.lengths.append(len(ids))
        self.total += len(ids)

    def close(self, width: int) -> pa.RecordBatch:
        self.out.close()
        nulls = sum(k is None for k in self.keys)
        with self.fs.open_output_stream(self.path + ".key") as out:
            out.write(np.array([0 if k is None else k for k in self.keys], dtype="<i8").tobytes())
        length = np.array(self.lengths, dtype=np.int64)
        hashes = perfect_hash.key_hashes([_key(*k) for k in zip(self.keys, self.occurrence, strict=True)])
        with self.fs.open_output_stream(self.path + ".idx") as out:
            out.write(perfect_hash.build(*hashes, np.cumsum(length) - length, length))
        n_first, n_last = (next((n for n, k in enumerate(ks) if k != ks[0]), len(ks)) for ks in (self.keys, self.keys[::-1]))
        row = [self.task, self.number, self.name + ".ids", self.name + ".key", self.name + ".idx", width, self.total,
               len(self.keys), nulls, self.keys[0], self.occurrence[0], n_first, self.keys[-1], n_last]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, _KINDS, strict=True)], names=_NAMES)


def _write(path: str, end_id: int, folder: str, shard_ids: int, special: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, special)
        end = np.array([end_id], dtype=enc.dtype)
        task = TaskContext.get().partitionId()
        shard, number, last, occurrence = None, 0, object(), 0
        for batch in batches:
            for a, b in text_slices(batch.column("text")):
                part = batch.slice(a, b - a)
                encoded = enc.encode(part.column("text"))
                for key, own in zip(part.column("id").to_pylist(), encoded, strict=True):
                    occurrence = occurrence + 1 if key == last else 0
                    last = key
                    ids = np.concatenate([own, end])
                    if shard and shard.total and (shard.total + len(ids) > shard_ids or len(shard.keys) >= SHARD_DOCS):
                        yield shard.close(enc.dtype.itemsize)
                        shard, number = None, number + 1
                    shard = shard or _Shard(folder, task, number)
                    shard.add(key, occurrence, ids)
        if shard:
            yield shard.close(enc.dtype.itemsize)
    return run


class ShardReader:
    """Keyed access to one shard; ``whole`` for many keys."""

    def __init__(self, payload: str, index: str, width: int, whole: bool = False):
        fs, path = file_system(index)
        self.index_file = fs.open_input_file(path)
        self.bytes_read = 0
        self.index = perfect_hash.Index(self._read, self.index_file.size(), whole)
        self.dtype = np.dtype(f"<u{width}")
        fs, path = file_system(payload)
        self.file = fs.open_input_file(path)

    def _read(self, place: int, n: int) -> bytes:
        self.bytes_read += n
        return self.index_file.read_at(n, place)

    def find(self, keys: list[int | None], occurrence: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(start, length) of each key in the shard; length -1 if it is not there.
        ``occurrence`` counts in the shard's task."""
        return self.index.find([_key(*k) for k in zip(keys, occurrence, strict=True)])

    def ids(self, start: int, length: int) -> np.ndarray:
        w = self.dtype.itemsize
        self.bytes_read += int(length) * w
        return np.frombuffer(self.file.read_at(int(length) * w, int(start) * w), dtype=self.dtype)

    def close(self) -> None:
        self.file.close()
        self.index_file.close()


def _runs(start: np.ndarray, length: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring documents to read at once, as index ranges."""
    a = 0
    for b in range(1, len(start) + 1):
        if b == len(start) or start[b] != start[b - 1] + length[b - 1] or start[b] + length[b] - start[a] > READ_IDS:
            yield a, b
            a = b


def _keys_of(row: dict, low: int, high: int) -> tuple[list[int | None], list[int]]:
    """Keys of the documents ``low`` to ``high`` of a shard, read by range."""
    fs, path = file_system(row["keys"])
    with fs.open_input_file(path) as f:
        first = low
        ids = np.frombuffer(f.read_at(8 * (high - low), 8 * low), dtype="<i8")
        # how many equal keys lie before, in the shard: looked for backwards
        before, same = 0, True
        while same and first > 0:
            step = min(first, 1 << 13)
            part = np.frombuffer(f.read_at(8 * step, 8 * (first - step)), dtype="<i8")
            null = np.arange(first - step, first) < row["nulls"]
            other = np.flatnonzero((part != ids[0]) | (null != (low < row["nulls"])))
            before += step - (int(other[-1]) + 1 if len(other) else 0)
            same = not len(other)
            first -= step
    null = np.arange(low, high) < row["nulls"]
    new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])])
    begin = np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
    occurrence = np.arange(len(ids)) - begin
    head = begin == 0
    occurrence[head] += before + (row["first_occurrence"] if before == low else 0)
    return [None if n else int(i) for i, n in zip(ids, null, strict=True)], occurrence.tolist()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            low, high = (row["n_docs"] * (row["part"] + k) // row["parts"] for k in (0, 1))
            if low == high:
                continue
            keys, occurrence = _keys_of(row, low, high)
            reader = ShardReader(row["payload"], row["index"], row["width"], whole=True)
            start, length = reader.find(keys, occurrence)
            if (length < 0).any():
                raise ValueError(f"{row['index']} lacks a key that the file of keys has")
            crc = []
            for a, b in _runs(start, length):
                ids = reader.ids(start[a], int(length[a:b].sum())).astype("<u4")
                for k in range(a, b):
                    own = ids[start[k] - start[a]: start[k] - start[a] + length[k]]
                    crc.append(zlib.crc32(own.tobytes()))
            reader.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(start + row["before"], pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["id", "start", "n_tokens", "ids_crc32"])


def write_store(docs: DataFrame, path: str, folder: str | None = None, *, end_id: int = 2, id_col: str = "doc_id",
                text_col: str = "text", shard_ids: int = SHARD_IDS, special: bool = False) -> DataFrame:
    """Writes the store to ``folder`` (default: a new one below the checkpoint
    folder) and returns its table of shards: ``task``, ``shard`` (their order
    is that of the ids), the files ``payload``, ``keys`` and ``index``,
    ``width``, ``n_ids``, ``n_docs``, ``nulls`` (keys without an id, which come
    first), ``first_id`` and its ``first_occurrence`` in the task, ``before``
    (ids in all earlier shards) and ``earlier`` (rows of ``first_id`` in them).
    With ``special``, special tokens in texts are read as the library does,
    else as plain text."""
    folder = folder or shared_folder(docs.sparkSession, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    shards = materialize(ordered.mapInArrow(_write(path, end_id, folder, shard_ids, special), _SHARD))
    # One narrow row per shard, not per document: the prefix sums are small.
    past = Window.orderBy("task", "shard").rowsBetween(Window.unboundedPreceding, -1)
    ends = shards.select("task", "shard", F.explode(F.array(
        F.struct(F.lit(True).alias("first"), F.col("first_id").alias("id"), F.col("n_first").alias("n")),
        F.struct(F.lit(False).alias("first"), F.col("last_id").alias("id"), F.col("n_last").alias("n")))).alias("e"))
    # a shard of one id alone has it as its first and its last: counted once
    ends = (ends.join(shards.select("task", "shard", F.col("n_first").alias("all"), "n_docs"), ["task", "shard"])
            .where((F.col("all") < F.col("n_docs")) | F.col("e.first")))
    of_id = Window.partitionBy("e.id").orderBy("task", "shard").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (ends.withColumn("earlier", F.coalesce(F.sum("e.n").over(of_id), F.lit(0))).where("e.first")
               .select("task", "shard", "earlier"))
    before = (shards.select("task", "shard", "n_ids")
              .withColumn("before", F.coalesce(F.sum("n_ids").over(past), F.lit(0))).drop("n_ids"))
    return shards.join(before, ["task", "shard"]).join(earlier, ["task", "shard"])


def read_store(shards: DataFrame) -> DataFrame:
    """Looks up every key of the files of keys: ``id``, ``start`` (ids of all
    documents before it), ``n_tokens``, ``ids_crc32`` (as unsigned 32-bit ids).
    A task reads about TASK_IDS of a shard, whatever few bytes name it."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("n_ids") / TASK_IDS)).cast("long")
    units, seen = materialize_observed(
        shards.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))),
        n=F.count(F.lit(1)))
    return (units.repartition(max(1, seen["n"]), "task", "shard", "part")
            .mapInArrow(_read, "id long, start long, n_tokens long, ids_crc32 long"))


def _placed(bounds: list[tuple]):
    """The number of the shard that each key lies in, if it is there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect_right(bounds, (i is not None, i or 0, n)) - 1
                  for i, n in zip(batch.column("id").to_pylist(), batch.column("occurrence").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], names=["id", "occurrence", "place"])
    return run


def _look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader, name = None, None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            found = None
            if row["index"] is not None:
                if row["index"] != name:
                    if reader:
                        reader.close()
                    reader, name = ShardReader(row["payload"], row["index"], row["width"]), row["index"]
                own = row["occurrence"]
                if row["id"] == row["first_id"]:  # numbered from the beginning of the task
                    own -= row["earlier"] - row["first_occurrence"]
                start, length = reader.find([row["id"]], [own])
                if length[0] >= 0:
                    found = row["before"] + int(start[0]), reader.ids(start[0], length[0]).tolist()
            out.append((row["id"], row["occurrence"], *(found or (None, None))))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())))],
            names=["id", "occurrence", "start", "ids"])
    if reader:
        reader.close()


def lookup(shards: DataFrame, keys: DataFrame) -> DataFrame:
    """``id``, ``occurrence``, ``start`` and ``ids`` of each of ``keys`` (``id``,
    ``occurrence``); nulls for a key that is not in the store. The driver and
    every task see where shards begin, one narrow row per shard; a key costs the
    blocks and the entry that its look-up touches, and its ids."""
    order = shards.orderBy("task", "shard").select("first_id", "earlier")
    bounds = order.collect()
    begins = [(r["first_id"] is not None, r["first_id"] or 0, r["earlier"]) for r in bounds]
    numbered = shards.withColumn("place", F.row_number().over(Window.orderBy("task", "shard")).cast("long") - 1)
    placed = (keys.select(F.col("id").cast("long").alias("id"), F.col("occurrence").cast("long").alias("occurrence"))
              .mapInArrow(_placed(begins), "id long, occurrence long, place long"))
    files = numbered.select("place", "payload", "index", "width", "first_id", "first_occurrence", "before", "earlier")
    part = F.pmod(F.xxhash64("id", "occurrence"), F.lit(LOOKUP_PARTS))
    return (placed.join(files, "place", "left").repartition("place", part).sortWithinPartitions("place")
            .mapInArrow(_look, "id long, occurrence long, start long, ids array<long>"))
