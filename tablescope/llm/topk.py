"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are quantised to integers and written as blocks: candidates by column
(each dimension's postings: the rows where it is not zero, and their values),
queries by row. A task joins one block of queries with one of candidates and
holds a dense score array of it. Term by term, every query with a weight in
that dimension scatters weight times posting into its scores. A partition
around the k-th score picks each query's best of the block, ties by id. The
blocks' best are merged per query; Spark keeps k rows of each query in a task
before the shuffle.

The stated queries meet all rows, block by block: work is queries times rows,
in tasks of bounded memory. Query blocks are sent to groups of candidate
blocks, neither side whole to one task.

Defined results: a vector that is null, empty or holds a null or non-finite
component takes no part, nor does a row without an id. Equal rows (same id,
same vector) are one. A row is not its own candidate, nor are rows that share
its id. Vectors shorter than others count as zero in the missing dimensions.
Extra columns are ignored. Quantised components are whole doubles of any size
(one whose product with the scale is no finite double takes no part, as if not
finite itself). Pairs whose score could leave 64 bits are scored in Python's
integers and ranked by their exact scores; a score outside 64 bits is put out as
the largest or smallest 64-bit integer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablescope.session import materialize_observed

#: Rows of a candidate block, of a query block, queries scored at once.
CANDIDATES, QUERIES, STEP = 4096, 512, 64
#: Candidate blocks that share one copy of a query block.
GROUP = 4
#: Products below this cannot leave 64 bits, however the estimate is rounded.
_LIMIT = 2.0 ** 61
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1

_BLOCK = "block long, n int, ids binary, width int, terms binary, kind string"


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, a whole double; null if any component
    is null or not finite, or there is none. Doubles from 2^53 on are whole."""
    x = F.transform(vector.cast("array<double>"), lambda v: v * scale)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return F.when(F.coalesce(F.size(x), F.lit(0)) > 0, F.when(~bad, F.transform(
        x, lambda v: F.when(F.abs(v) < 2.0 ** 53, F.floor(v).cast("double")).otherwise(v))))


def _kind(dense: np.ndarray) -> str:
    """The smallest type that holds whole doubles as they are."""
    low, high = dense.min(), dense.max()
    for kind, bound in (("<i4", 2.0 ** 31), ("<i8", 2.0 ** 63)):
        if -bound <= low and high < bound:
            return kind
    return "<f8"


def _blocks(size: int):
    """Packs a task's vectors into blocks of ``size`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids, vectors = [], []

        def block() -> pa.RecordBatch:
            width = max(map(len, vectors))
            dense = np.zeros((len(vectors), width))
            for i, v in enumerate(vectors):
                dense[i, : len(v)] = v
            kind = _kind(dense)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([len(ids)], pa.int32()),
                 pa.array([np.array(ids, dtype=np.int64).tobytes()], pa.binary()), pa.array([width], pa.int32()),
                 pa.array([dense.astype(kind).tobytes()], pa.binary()), pa.array([kind])],
                names=["block", "n", "ids", "width", "terms", "kind"])

        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), batch.column("q"), strict=True):
                ids.append(i)
                vectors.append(v.values.to_numpy(zero_copy_only=False))
                if len(ids) == size:
                    yield block()
                    number += 1
                    ids, vectors = [], []
        if ids:
            yield block()
    return run


def _matrix(raw, kind: str, n: int, width: int) -> np.ndarray:
    """Block bytes by column, as 64-bit integers, or whole doubles if larger."""
    return np.asfortranarray(np.frombuffer(raw, kind).reshape(n, width), dtype="<f8" if kind == "<f8" else np.int64)


def _magnitudes(rows: np.ndarray) -> np.ndarray:
    """The largest absolute component of each row, as a double: nothing wraps."""
    return np.maximum(rows.max(axis=1).astype(float), -rows.min(axis=1).astype(float))


def _small(rows: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """64-bit integers, with the rows that may be too large for them as zeros."""
    if keep.all() and rows.dtype == np.int64:
        return rows
    return np.asfortranarray(np.where(keep[:, None], rows, 0), dtype=np.int64)


def exact_score(query: np.ndarray, candidate: np.ndarray) -> int:
    """The inner product in Python's integers."""
    return sum(int(a) * int(b) for a, b in zip(query.tolist(), candidate.tolist(), strict=False))


def beyond(score: int) -> tuple[int, bytes | None, int]:
    """How a score is ordered and put out: its side (1 above, -1 below 64
    bits, else 0), bytes that order the scores of a side, and itself, cut to 64
    bits."""
    if _LEAST <= score <= _MOST:
        return 0, None, score
    size = (abs(score).bit_length() + 7) // 8
    key = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return (1, key, _MOST) if score > 0 else (-1, bytes(255 - b for b in key), _LEAST)


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores of every query (rows) with every candidate, term at a time."""
    scores = np.zeros((len(queries), len(candidates)), dtype=np.int64)
    for d in range(min(queries.shape[1], candidates.shape[1])):
        weight, value = queries[:, d], candidates[:, d]
        rows, posting = np.flatnonzero(weight), np.flatnonzero(value)
        if len(rows) == len(weight) and len(posting) == len(value):  # no gaps on either side
            scores += weight[:, None] * value
        elif len(rows) and len(posting):
            scores[np.ix_(rows, posting)] += weight[rows, None] * value[posting]
    return scores


def best(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest allowed scores, ties by smaller id."""
    at = np.flatnonzero(allowed)
    if len(at) > k:
        own = scores[at]
        least = np.partition(own, len(own) - k)[len(own) - k]
        at = at[own >= least]
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _score(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name: batch.column(name)[i]
                c_ids = np.frombuffer(get("c_ids").as_buffer(), np.int64)
                q_ids = np.frombuffer(get("q_ids").as_buffer(), np.int64)
                c = _matrix(get("c_terms").as_buffer(), get("c_kind").as_py(), len(c_ids), get("c_width").as_py())
                q = _matrix(get("q_terms").as_buffer(), get("q_kind").as_py(), len(q_ids), get("q_width").as_py())
                c_most, q_most, width = _magnitudes(c), _magnitudes(q), min(c.shape[1], q.shape[1])
                c_small, q_small = _small(c, c_most < 2.0 ** 62), _small(q, q_most < 2.0 ** 62)
                block = get("q_block").as_py()
                rows = []
                for a in range(0, len(q), STEP):
                    with np.errstate(over="ignore"):  # what wraps here is scored exactly below
                        scores = accumulate(q_small[a: a + STEP], c_small)
                    for j, own in enumerate(scores, a):
                        allowed = c_ids != q_ids[j]
                        with np.errstate(over="ignore"):
                            sure = c_most * q_most[j] * width < _LIMIT
                        found = [(0, None, int(own[p]), int(c_ids[p])) for p in best(own, c_ids, allowed & sure, k)]
                        if not sure.all():
                            found += [(*beyond(exact_score(q[j], c[p])), int(c_ids[p]))
                                      for p in np.flatnonzero(allowed & ~sure)]
                            found = sorted(found, key=lambda r: r[3])
                            found = sorted(found, key=lambda r: (r[0], r[1] or b"", r[2]), reverse=True)[:k]
                        rows += [(int(q_ids[j]), block, j, r[3], *r[:3]) for r in found]
                columns = list(zip(*rows, strict=True)) or [()] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.binary() if n == "key" else pa.int64()) for n, x in zip(_FOUND, columns, strict=True)],
                    names=list(_FOUND))
    return run


_FOUND = ("query_id", "block", "place", "vec_id", "side", "key", "score")


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of each query's ``k`` best
    rows. ``is_query`` is a condition on the id column, named ``id``."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("q"))
    rows, seen = materialize_observed(rows.where("id is not null and q is not null").dropDuplicates(),
                                      rows=F.count(F.lit(1)), queries=F.coalesce(F.count_if(is_query), F.lit(0)))

    def packed(part: DataFrame, n: int, size: int) -> DataFrame:
        # about one block per task, whatever files the table came in
        return part.repartition(max(1, -(-n // size)), F.xxhash64("id", "q")).mapInArrow(_blocks(2 * size), _BLOCK)

    def named(blocks: DataFrame, side: str) -> DataFrame:
        return blocks.select(*[F.col(c).alias(side + c) for c in ("block", "ids", "width", "terms", "kind")])

    blocks, made = materialize_observed(packed(rows, seen["rows"], CANDIDATES), n=F.count(F.lit(1)))
    groups = max(1, -(-made["n"] // GROUP))
    grouped = named(blocks, "c_").withColumn("group", F.pmod(F.xxhash64("c_block"), F.lit(groups)))
    asked = named(packed(rows.where(is_query), seen["queries"], QUERIES), "q_")
    sent = asked.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    pairs = grouped.join(sent, "group").select(
        "c_ids", "c_width", "c_terms", "c_kind", "q_block", "q_ids", "q_width", "q_terms", "q_kind")
    found = pairs.mapInArrow(_score(k), ", ".join(f"{c} {'binary' if c == 'key' else 'long'}" for c in _FOUND))
    # A query is (block, place); equal ids with different vectors stay apart.
    order = Window.partitionBy("block", "place").orderBy(F.desc("side"), F.desc("key"), F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
