"""Byte-level BPE: encoding with a hierarchical-bitmap rank queue, decoding.

Encoding one pre-token: its bytes are a doubly linked list of parts. Each
adjacent pair whose joined bytes have a rank puts its left position into the
bucket of that rank. Three levels of 64-bit words mark the buckets that hold
something, so the least rank is found by three find-first-set steps whatever
the number of ranks. Positions of one bucket come out leftmost first. A merge
makes entries of its neighbours stale; those are skipped when they come up, by
comparing the pair's present rank. A pre-token of n bytes makes at most 3n
entries, so very long ones cost n log n.

A text is cut by the pattern into pre-tokens; each is encoded alone. Stretches
between blanks repeat a lot, so :mod:`tablescope.llm.encoding` remembers their
ids and those of pre-tokens, within a bound, and gathers the ids of many texts
at once. Decoding gathers the tokens' bytes in the same way.

Defined results: a null text is an empty one, with no ids. Repeated rows are
each returned. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescope.llm.encoding import PRE_TOKEN, StretchEncoder, gathered, text_slices


class RankQueue:
    """Positions by rank; ``pop`` gives the leftmost of the least rank."""

    def __init__(self, n_ranks: int):
        self.buckets: list[list[int] | None] = [None] * n_ranks
        self.low = [0] * (n_ranks // 64 + 1)
        self.mid = [0] * (n_ranks // 4096 + 1)
        self.top = 0  # one bit per word of mid

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets[rank]
        if bucket:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        a, b = rank >> 6, rank >> 12
        self.low[a] |= 1 << (rank & 63)
        self.mid[b] |= 1 << (a & 63)
        self.top |= 1 << b

    def pop(self) -> tuple[int, int]:
        """(rank, position); the queue must not be empty."""
        b = (self.top & -self.top).bit_length() - 1
        word = self.mid[b]
        a = (b << 6) | ((word & -word).bit_length() - 1)
        word = self.low[a]
        rank = (a << 6) | ((word & -word).bit_length() - 1)
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            self.buckets[rank] = None
            self.low[a] &= ~(1 << (rank & 63))
            if not self.low[a]:
                self.mid[b] &= ~(1 << (a & 63))
                if not self.mid[b]:
                    self.top &= ~(1 << b)
        return rank, position


class BytePairs:
    """One vocabulary: ``ranks`` maps byte strings to ids, lower merges first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.byte_of = {i: b for b, i in ranks.items()}

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        queue, push = self.queue, self.queue.push
        # part i covers piece[i:after[i]]; pair[i] is the rank of it with the next part
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [-1] * n
        for i in range(n - 1):
            r = ranks.get(piece[i: i + 2])
            if r is not None:
                pair[i] = r
                push(r, i)
        while queue.top:
            rank, i = queue.pop()
            if pair[i] != rank:
                continue  # stale: a neighbour has been merged since
            j = after[i]
            end = after[j]
            after[i] = end
            pair[j] = pair[i] = -1
            if end < n:
                before[end] = i
                r = ranks.get(piece[i: after[end]])
                if r is not None:
                    pair[i] = r
                    push(r, i)
            k = before[i]
            if k >= 0:
                r = ranks.get(piece[k: end])
                pair[k] = -1 if r is None else r
                if r is not None:
                    push(r, k)
        out, i = [], 0
        while i < n:
            j = after[i]
            out.append(ranks[piece[i: j]])
            i = j
        return out

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self.pattern.findall(text):
            out += self.encode_piece(piece.encode())
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.byte_of.__getitem__, ids))


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankEncoder(StretchEncoder):
    """Encoding and decoding of many texts under one rank file."""

    def __init__(self, path: str, pattern: str):
        self.pairs = BytePairs(load_ranks(path), pattern)
        n = max(self.pairs.byte_of) + 1
        super().__init__(n)
        # the pattern that parts stretches safely; another one sees whole texts
        self.by_stretch = pattern == PRE_TOKEN.pattern
        tokens = [self.pairs.byte_of.get(i, b"") for i in range(n)]
        self.size = np.array([len(t) for t in tokens])
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.decimal = [str(i) for i in range(n)]

    def part_ids(self, part: str) -> list[int]:
        return self.pairs.encode_piece(part.encode())

    def whole_ids(self, texts: list[str]) -> list[list[int]]:
        return [self.pairs.encode(t) for t in texts]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        if self.by_stretch:
            return super().encode(texts)
        return [np.array(ids, self.dtype) for ids in self.whole_ids([t or "" for t in texts.to_pylist()])]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each sequence of ids."""
        if not ids:
            return []
        joined = np.concatenate(ids).astype(np.int64)
        if len(joined) and joined.min() < 0 or (self.size[joined] == 0).any():
            raise ValueError("an id that the vocabulary lacks")
        found, end = gathered(self.flat, self.size, joined)
        ends = np.append(0, end)[np.append(0, np.cumsum([len(x) for x in ids]))]
        raw = found.tobytes()
        return [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


@lru_cache(maxsize=2)
def rank_encoder(path: str, pattern: str) -> RankEncoder:
    return RankEncoder(path, pattern)


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = rank_encoder(path, pattern)
        for batch in batches:
            for a, b in text_slices(batch.column("text")):
                part = batch.slice(a, b - a)
                ids = enc.encode(part.column("text"))
                ends = np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("id"), lists], names=["id", "ids"])
    return run


def _digests(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = rank_encoder(path, pattern)
        decimal = enc.decimal.__getitem__
        for batch in batches:
            for a, b in text_slices(batch.column("text")):
                part = batch.slice(a, b - a)
                ids = enc.encode(part.column("text"))
                id_sha = [hashlib.sha256(",".join(map(decimal, x.tolist())).encode()).hexdigest() for x in ids]
                text_sha = [hashlib.sha256(raw).hexdigest() for raw in enc.decode(ids)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([len(x) for x in ids], pa.int64()), pa.array(id_sha, pa.string()),
                     pa.array(text_sha, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _decode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = rank_encoder(path, pattern)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                ids = [np.array(x or [], dtype=np.int64) for x in part.column("ids").to_pylist()]
                text = [raw.decode("utf-8", "replace") for raw in enc.decode(ids)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(text, pa.string())], names=["id", "text"])
    return run


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (array of int) of every whole text. ``path`` is a
    rank file (base64 token, rank) that every executor can open."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(_encode(path, pattern), f"id {kind}, ids array<int>")
            .withColumnRenamed("id", id_col))


def decode_documents(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                     ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``text`` of every row of ids (null: empty). Bytes that
    are no UTF-8 become the replacement character."""
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_decode(path, pattern), f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Encodes and decodes every text in one pass: ``id_col``, ``n_tokens``,
    ``ids_sha256`` (of the decimal ids, comma-joined), ``decoded_sha256``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(_digests(path, pattern), f"id {kind}, n_tokens long, ids_sha256 string, "
                                                     "decoded_sha256 string").withColumnRenamed("id", id_col))
