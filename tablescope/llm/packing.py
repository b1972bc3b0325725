"""Best-fit packing of documents into sequences by length patterns.

1. One pass encodes every document and yields its pieces, each with its place
   among the pieces of the same length in its task.
2. The histogram of lengths (at most one row per length, so bounded) goes to
   the driver. Patterns of up to ``PATTERN_PARTS`` lengths that fill a sequence
   are enumerated, non-negative least squares fits how often to repeat each so
   that they use up the histogram, and the counts are rounded.
3. The lengths left over are packed best fit, longest first, in bulk over the
   histogram: the fullest sequences with room, as many at once as there are.
4. The plan (pattern, repeats) has no rows per document: its size depends on
   the number of lengths. Pieces find their sequence by their rank among equal
   lengths, from per-task counts and a prefix sum over tasks.

Defined results: a null text is empty and gives one piece, its end token.
Repeated rows are packed each. Extra columns are ignored; an empty table gives
an empty result. A document over ``size`` tokens is cut into pieces of ``size``
tokens, the first of which may be shorter.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablescope.llm.encoding import encoder, text_slices
from tablescope.llm.runtime import rest
from tablescope.session import materialize

PATTERN_PARTS = 3
#: Steps of the least-squares fit; what it leaves is packed best fit anyway.
FIT_STEPS = 200

_PIECES = "piece int, start long, length long, ids_crc32 long, task long, rank long"


def _cut(path: str, end_id: int, size: int, with_ids: bool, special: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, special)
        end = np.array([end_id], dtype="<u4")
        task = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for batch in batches:
            for a, b in text_slices(batch.column("text")):
                part = batch.slice(a, b - a)
                row, piece, start, length, crc, rank, values = [], [], [], [], [], [], []
                for i, own_ids in enumerate(enc.encode(part.column("text"))):
                    ids = np.concatenate([own_ids, end])
                    at = 0
                    for k in range(-(-len(ids) // size)):
                        to = at + ((len(ids) - 1) % size + 1 if k == 0 else size)
                        own = ids[at:to]
                        row.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(len(own))
                        crc.append(zlib.crc32(own.tobytes()))
                        rank.append(seen[len(own)])
                        seen[len(own)] += 1
                        if with_ids:
                            values.append(own.astype(np.int64))
                        at = to
                columns = [part.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                           pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                           pa.array([task] * len(row), pa.int64()), pa.array(rank, pa.int64())]
                names = ["id", "piece", "start", "length", "ids_crc32", "task", "rank"]
                if with_ids:
                    columns.append(pa.array(values, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
            rest()
    return run


def full_patterns(lengths: np.ndarray, size: int, parts: int = PATTERN_PARTS) -> list[np.ndarray]:
    """Multisets of 1 to ``parts`` (3 at most) of ``lengths`` that sum to
    ``size``; one array per number of parts, each row descending."""
    have = np.zeros(size + 1, dtype=bool)
    have[lengths] = True
    out = [np.array([[size]])] if have[size] else []
    if parts >= 2:
        a = lengths[(2 * lengths >= size) & (lengths < size)]
        out.append(np.stack([a, size - a], axis=1)[have[size - a]])
    if parts >= 3:
        rows = []
        for a in lengths[(3 * lengths >= size) & (lengths < size)]:
            b = lengths[(lengths <= a) & (2 * lengths >= size - a) & (lengths < size - a)]
            b = b[have[size - a - b]]
            rows.append(np.stack([np.full(len(b), a), b, size - a - b], axis=1))
        out.append(np.concatenate(rows) if rows else np.zeros((0, 3), dtype=int))
    return [p for p in out if len(p)]


def fit_repeats(patterns: list[np.ndarray], histogram: np.ndarray, steps: int = FIT_STEPS) -> list[np.ndarray]:
    """Non-negative repeats x that make the lengths used, A x, come near the
    histogram in least squares (accelerated projected gradient). A length's
    error weighs as its square: what is left of short ones is easily placed."""
    n = len(histogram)
    weight = (np.arange(n) / max(1, n - 1)) ** 2

    def used(x: list[np.ndarray]) -> np.ndarray:
        return sum((np.bincount(p[:, j], weights=v, minlength=n) for p, v in zip(patterns, x, strict=True)
                    for j in range(p.shape[1])), np.zeros(n))

    def back(r: np.ndarray) -> list[np.ndarray]:
        r = r * weight
        return [r[p].sum(axis=1) for p in patterns]

    # The step: the largest eigenvalue of A'WA, by a few power iterations.
    v = [np.ones(len(p)) for p in patterns]
    top = 1.0
    for _ in range(15):
        v = back(used(v))
        top = float(np.sqrt(sum((x * x).sum() for x in v)))
        v = [x / top for x in v]
    step = 1 / (1.05 * top)
    x = [np.zeros(len(p)) for p in patterns]
    y, t = x, 1.0
    for _ in range(steps):
        g = back(used(y) - histogram)
        new = [np.maximum(0, a - step * b) for a, b in zip(y, g, strict=True)]
        u = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = [a + (t - 1) / u * (a - b) for a, b in zip(new, x, strict=True)]
        x, t = new, u
    return x


def best_fit_rest(left: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: [(lengths, sequences)]."""
    by_room: dict[int, list[list]] = defaultdict(list)  # room -> [[lengths, sequences]]
    rooms = np.zeros(size + 1, dtype=np.int64)  # sequences by room
    for length in sorted(left, reverse=True):
        todo = left[length]
        while todo:
            fits = np.flatnonzero(rooms[length:])
            if len(fits):
                room = length + int(fits[0])
                lengths, n = by_room[room].pop()
                take = min(n, todo)
                rooms[room] -= take
                if n > take:
                    by_room[room].append([lengths, n - take])
                by_room[room - length].append([(*lengths, length), take])
                rooms[room - length] += take
                todo -= take
            else:  # new sequences, each filled with as many of this length as fit
                each = size // length
                full, rest = divmod(todo, each)
                for k, n in ((each, full), (rest, 1)):
                    if k and n:
                        by_room[size - k * length].append([(length,) * k, n])
                        rooms[size - k * length] += n
                todo = 0
    return [(tuple(p), n) for kinds in by_room.values() for p, n in kinds]


def _planned(left: dict[int, int], size: int, patterns: list[np.ndarray]) -> list[tuple[tuple[int, ...], int]]:
    """Fitted repeats of ``patterns``, rounded, and best fit for the rest."""
    left = dict(left)
    counts = np.zeros(size + 1)
    for k, v in left.items():
        counts[k] = v
    out: list[tuple[tuple[int, ...], int]] = []
    if patterns:
        whole = [np.rint(x).astype(np.int64) for x in fit_repeats(patterns, counts)]
        wanted = [(int(n), tuple(map(int, row))) for p, w in zip(patterns, whole, strict=True)
                  for n, row in zip(w[w > 0], p[w > 0], strict=True)]
        # Rounding must not use more than there is; long pieces, the hardest to place, come first.
        for n, row in sorted(wanted, key=lambda x: (-x[1][0], -x[0], x[1])):
            n = min(n, *(left.get(k, 0) // row.count(k) for k in set(row)))
            if n > 0:
                out.append((row, n))
                for k in row:
                    left[k] -= n
    return out + best_fit_rest({k: v for k, v in left.items() if v}, size)


def plan(histogram: dict[int, int], size: int, parts: int = PATTERN_PARTS) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of one sequence, number of such sequences)] that uses up the
    histogram exactly.

    Patterns of short pieces can take what long ones need to fill up, so the
    fit is tried with all patterns, with those that hold a piece over half the
    size, and with none; the plan of fewest sequences is taken, of equal ones
    that with the most patterns.
    """
    left = {k: int(v) for k, v in histogram.items() if v}
    if not left:
        return []
    patterns = full_patterns(np.array(sorted(left)), size, parts)
    long = [p[2 * p[:, 0] > size] for p in patterns]
    least, best = -(-sum(k * n for k, n in left.items()) // size), None
    for choice in (patterns, [p for p in long if len(p)], []):
        planned = _planned(left, size, choice)
        n = sum(n for _, n in planned)
        if best is None or n < best[0]:
            best = n, planned
        if n == least:
            break
    return best[1]


def _slots(planned: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, first sequence and offset of each slot, by
    ascending first rank."""
    at: dict[int, int] = defaultdict(int)
    slots: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    base = 0
    for lengths, n in planned:
        offset = 0
        for k in lengths:
            slots[k].append((at[k], base, offset))
            at[k] += n
            offset += k
        base += n
    return {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v, strict=True)) for k, v in slots.items()}


def _place(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() + batch.column("before").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for k in np.unique(length):
                own = np.flatnonzero(length == k)
                first, base, place = slots[int(k)]
                at = np.searchsorted(first, rank[own], side="right") - 1
                sequence[own] = base[at] + rank[own] - first[at]
                offset[own] = place[at]
            keep = [n for n in batch.schema.names if n not in ("task", "rank", "before")]
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), pa.array(sequence), pa.array(offset)],
                                             names=[*keep, "sequence_id", "offset"])
    return run


def pack_documents(docs: DataFrame, path: str, *, size: int = 2048, end_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False, special: bool = False) -> DataFrame:
    """One row per piece: ``id_col``, ``piece``, ``start``, ``length``,
    ``ids_crc32``, (``ids``,) ``sequence_id``, ``offset``. ``path`` is a
    tokenizers file that every executor can open; with ``special``, special
    tokens in texts are read as the library does, else as plain text."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    columns = f"id {kind}, {_PIECES}" + ", ids array<long>" * with_ids
    pieces = materialize(rows.mapInArrow(_cut(path, end_id, size, with_ids, special), columns))
    counts = materialize(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(_slots(plan(histogram, size)))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = pieces.join(before, ["task", "length"])
    ids = ", ids array<long>" * with_ids
    order = ["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    return (placed.select(*order, "task", "rank", "before")
            .mapInArrow(_place(shared), f"id {kind}, piece int, start long, length long, ids_crc32 long{ids}, "
                                        "sequence_id long, offset long")
            .withColumnRenamed("id", id_col))


def packed_sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids`` of each packed sequence, from the rows of
    :func:`pack_documents` with ids; a group is one sequence, so bounded."""
    return (placed.groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids")))
