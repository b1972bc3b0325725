"""Ranked lexical search by dense blocked matrix products.

1. The items' terms set bits in a bitmap of fixed size, which lets the passes
   over the documents drop most terms that no item holds.
2. One pass counts documents, their terms, and in how many documents each term
   of the bitmap is found; a join with the items' terms drops what else is left.
3. The weighted terms of the items (weight times repeats) become tiles of some
   items and their compact vocabulary, written below the checkpoint folder. A
   tile's vocabulary is cut into blocks of at most ``BLOCK_TERMS`` columns whose
   weights, in every row, stay below ``ROW_WEIGHTS``: as an impact is below a
   million, every partial sum of a product is an integer below 2^53, which
   float64 holds exactly. Products of blocks are added as 64-bit integers.
4. A second pass cuts the documents into tiles. Per tile and block a dense
   matrix of impacts is multiplied with the weights by BLAS. A task keeps the
   ``k`` best of each item: what reaches the item's lowest kept score, ties
   included, is ordered by score and id and cut at ``k``.
5. The tasks' lists are merged per item, in two steps.

Tasks hold one tile of documents and one of items at a time. A long document is
counted in slices; what is kept of it are its distinct terms of the bitmap.

Defined results: a null or empty text has no terms; such a document is not
counted and never ranked, such an item has no rows. Items that agree in id and
text are one; items that share an id but not the text are ranked each. Every
document row is ranked for itself, also repeated ones and those without an id,
which come last among equal scores. Fewer than ``k`` documents with a score
above 0 give fewer rows; an empty table gives an empty result. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablescope.llm.files import file_system, shared_folder
from tablescope.llm.skew import join_by_group
from tablescope.session import materialize, materialize_observed

#: Bits of the bitmap of terms; a bucket of Spark's bitmaps has 32,768.
BITS = 1 << 22
#: A tile of items: so many at most, and so many weights (one larger item alone).
TILE_ITEMS, TILE_WEIGHTS = 256, 1 << 16
#: Columns of a block, and the bound of a row's weights in it: 2^53 / 10^6.
BLOCK_TERMS, ROW_WEIGHTS = 2048, (1 << 53) // 10**6
#: A tile of documents: so many at most, and about so many bytes of text; a
#: longer text is counted in slices of that size.
TILE_DOCS, TILE_BYTES = 512, 1 << 22
#: Weights that a task keeps between document tiles, and entries of its lists
#: before it puts them out and starts anew.
KEPT_WEIGHTS, KEPT_BEST = 1 << 20, 1 << 20
#: Groups of lists per item that the first merge step makes.
MERGE = 32

# Bytes that are no part of a term become blanks, A-Z lower case.
# Bytes above 127 belong to other characters, all of which are parts of terms.
_TERM_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def _slices(text: bytes) -> Iterator[bytes]:
    """Parts of a translated text of about TILE_BYTES, cut at blanks."""
    at = 0
    while len(text) - at > TILE_BYTES:
        cut = text.find(b" ", at + TILE_BYTES)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def term_counts(text: bytes) -> Counter[bytes]:
    """The terms of a UTF-8 text and their repeats."""
    out: Counter[bytes] = Counter()
    for part in _slices(text.translate(_TERM_BYTES)):
        out.update(part.split())
    return out


class DocTile:
    """Some documents: how many terms each has, and the counts of the terms
    that the bitmap lets through."""

    def __init__(self, bitmap: np.ndarray):
        self.bitmap, self.ids, self.sizes, self.bytes = bitmap, [], [], 0
        self._flat, self._owner, self._parts = [], [], []

    def add(self, doc: int | None, text: bytes) -> None:
        n = 0
        for part in _slices(text.translate(_TERM_BYTES)):
            found = part.split()
            n += len(found)
            self._flat += found
            self._owner.append((len(self.ids), len(found)))
            self.bytes += len(part)
            if len(part) >= TILE_BYTES:
                self._count()
        self.ids.append(doc)
        self.sizes.append(n)

    def _count(self) -> None:
        """Terms gathered so far become (document, term, count)."""
        if self._flat:
            coded = pa.array(self._flat, pa.binary()).dictionary_encode()
            distinct = coded.dictionary
            bit = np.fromiter(map(zlib.crc32, distinct.to_pylist()), np.int64, len(distinct)) % BITS
            passes = (self.bitmap[bit >> 3] >> (bit & 7) & 1).astype(bool)
            at = coded.indices.to_numpy()
            owner = np.repeat([d for d, _ in self._owner], [n for _, n in self._owner])
            key = (owner * len(distinct) + at)[passes[at]]
            key, count = np.unique(key, return_counts=True)
            doc, term = np.divmod(key, len(distinct))
            self._parts.append((doc, distinct.take(pa.array(term)), count))
        self._flat, self._owner = [], []

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """Documents, terms and counts of all pairs, and the distinct terms."""
        self._count()
        if not self._parts:
            none = np.zeros(0, np.int64)
            return none, none, none, pa.array([], pa.binary())
        doc = np.concatenate([p[0] for p in self._parts])
        coded = pa.concat_arrays([p[1] for p in self._parts]).dictionary_encode()
        key = doc * len(coded.dictionary) + coded.indices.to_numpy()
        key, where = np.unique(key, return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, where, np.concatenate([p[2] for p in self._parts]))
        doc, term = np.divmod(key, len(coded.dictionary))
        return doc, term, total, coded.dictionary


def _doc_tiles(batches: Iterator[pa.RecordBatch], bitmap: bytes) -> Iterator[DocTile]:
    bits = np.frombuffer(bitmap, np.uint8)
    tile = DocTile(bits)
    for batch in batches:
        for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text"), strict=True):
            tile.add(doc, text.as_py() or b"")
            if len(tile.ids) >= TILE_DOCS or tile.bytes >= TILE_BYTES:
                yield tile
                tile = DocTile(bits)
    if tile.ids:
        yield tile


def _count(bitmap: bytes):
    """Rows (term, documents that hold it, 0), and one (null, documents with
    terms, their terms) per tile."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _doc_tiles(batches, bitmap):
            _, term, _, distinct = tile.counts()
            docs = np.bincount(term, minlength=len(distinct)).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([distinct.cast(pa.string()), pa.nulls(1, pa.string())]),
                 pa.array([*docs, sum(n > 0 for n in tile.sizes)], pa.int64()),
                 pa.array([0] * len(distinct) + [sum(tile.sizes)], pa.int64())], names=["term", "df", "total"])
        pa.default_memory_pool().release_unused()  # the worker lives on between tasks
    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch.column("item").to_pylist(), batch.column("text"), strict=True):
            found = term_counts(text.as_py() or b"")
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(found), pa.int64()), pa.array(list(found), pa.binary()).cast(pa.string()),
                 pa.array(list(found.values()), pa.int64())], names=["item", "term", "n"])


def _write_tiles(folder: str):
    """Weights of items, an item's rows one after the other, become files of
    whole items; one row per file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        fs.create_dir(path, recursive=True)

        def write(items: list[int], rows: list[tuple]) -> tuple:
            name = f"{uuid.uuid4().hex}.arrow"
            file = pa.table({"item": pa.array([r[0] for r in rows], pa.int64()),
                             "term": pa.array([r[1] for r in rows], pa.string()),
                             "weight": pa.array([r[2] for r in rows], pa.int64())})
            with fs.open_output_stream(f"{path}/{name}") as f, pa.ipc.new_stream(f, file.schema) as out:
                out.write_table(file)
            return name, len(items), len(rows)

        def files() -> Iterator[tuple]:
            items, rows = [], []
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in ("item", "term", "weight")), strict=True):
                    if not items or items[-1] != row[0]:
                        if len(items) >= TILE_ITEMS or len(rows) >= TILE_WEIGHTS:
                            yield write(items, rows)
                            items, rows = [], []
                        items.append(row[0])
                    rows.append(row)
            if items:
                yield write(items, rows)

        for name, n_items, n_weights in files():
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n_items]), pa.array([n_weights])],
                                             names=["name", "items", "weights"])
    return run


def tile_groups(files: list[tuple[str, int, int]]) -> list[list[str]]:
    """Small files together, to the size of a tile."""
    out, items, weights = [], 0, 0
    for name, i, w in files:
        if not out or items + i > TILE_ITEMS or weights + w > TILE_WEIGHTS:
            out.append([])
            items = weights = 0
        out[-1].append(name)
        items, weights = items + i, weights + w
    return out


def blocks(rows: list[tuple[int, str, int]], n_items: int) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """The compact vocabulary of each block of a tile and its (item, column,
    weight) entries. A weight over the bound is dealt to several columns."""
    by_term: dict[str, list[tuple[int, int]]] = {}
    for item, term, weight in rows:
        by_term.setdefault(term, []).append((item, weight))
    most = ROW_WEIGHTS - 1
    vocabulary, entries, load = [], [], np.zeros(n_items, np.int64)
    for term, held in by_term.items():
        while held:
            part = [(i, min(w, most)) for i, w in held]
            held = [(i, w - most) for i, w in held if w > most]
            if len(vocabulary) >= BLOCK_TERMS or any(load[i] + w > most for i, w in part):
                yield vocabulary, entries
                vocabulary, entries, load = [], [], np.zeros(n_items, np.int64)
            for i, w in part:
                load[i] += w
                entries.append((i, len(vocabulary), w))
            vocabulary.append(term.encode())
    if vocabulary:
        yield vocabulary, entries


class ItemTile:
    """Items and the blocks of their weights."""

    def __init__(self, files: list[pa.Table]):
        rows = [r for f in files for r in zip(*(f.column(c).to_pylist() for c in ("item", "term", "weight")), strict=True)]
        self.items = np.unique([r[0] for r in rows])
        place = {item: i for i, item in enumerate(self.items.tolist())}
        self.size = len(rows)
        self.blocks = [(pa.array(vocabulary, pa.binary()), *(np.array(e) for e in zip(*entries, strict=True)))
                       for vocabulary, entries in blocks([(place[i], t, w) for i, t, w in rows], len(self.items))]

    def scores(self, n_docs: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, distinct: pa.Array) -> np.ndarray:
        """Exact scores, items by documents."""
        out = np.zeros((len(self.items), n_docs), np.int64)
        for vocabulary, item, column, weight in self.blocks:
            at = pc.fill_null(pc.index_in(vocabulary, value_set=distinct), -1).to_numpy()
            held = np.unique(at[at >= 0])  # the terms of the block that the documents hold
            if not len(held):
                continue
            row_of = np.full(len(distinct) + 1, -1)
            row_of[held] = np.arange(len(held))
            row = row_of[term]
            impacts = np.zeros((len(held), n_docs))
            impacts[row[row >= 0], doc[row >= 0]] = impact[row >= 0]
            row = row_of[at[column]]
            weights = np.zeros((len(self.items), len(held)))
            np.add.at(weights, (item[row >= 0], row[row >= 0]), weight[row >= 0])
            out += (weights @ impacts).astype(np.int64)
        return out


def impacts_of(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * norm)


def length_norms(sizes: list[int], n_docs: int, n_terms: int) -> np.ndarray:
    """Per document 100 - 75 + 75 * size * documents div terms; Python's
    integers, as the products may need more than 64 bits."""
    return np.array([25 + (75 * n * n_docs) // n_terms for n in sizes], np.int64)


class Best:
    """The k best documents of each item of a tile so far."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.item, self.doc, self.null, self.score = (np.zeros(0, np.int64) for _ in range(4))
        self.floor = np.ones(n_items, np.int64)  # only scores above 0

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        item, at = np.nonzero(scores >= self.floor[:, None])  # also what ties with the last one kept
        score = scores[item, at]
        item, doc, null, score = (np.concatenate(x) for x in (
            (self.item, item), (self.doc, ids[at]), (self.null, nulls[at]), (self.score, score)))
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        first = np.arange(len(item)) - np.searchsorted(item, item) < self.k
        kept = order[first]
        self.item, self.doc, self.null, self.score = item[first], doc[kept], null[kept], score[kept]
        held, count = np.unique(self.item, return_counts=True)
        last = np.cumsum(count) - 1
        self.floor[held[count == self.k]] = self.score[last[count == self.k]]


def _rank(bitmap: bytes, folder: str, groups: list[list[str]], n_docs: int, n_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        kept: dict[int, ItemTile] = {}

        def item_tile(g: int) -> ItemTile:
            if g in kept:
                return kept[g]
            files = []
            for name in groups[g]:
                with fs.open_input_stream(f"{path}/{name}") as f:
                    files.append(pa.ipc.open_stream(f).read_all())
            tile = ItemTile(files)
            if sum(t.size for t in kept.values()) + tile.size <= KEPT_WEIGHTS:
                kept[g] = tile
            return tile

        best: dict[int, tuple[np.ndarray, Best]] = {}

        def lists() -> Iterator[pa.RecordBatch]:
            for items, b in best.values():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items[b.item], pa.int64()), pa.array(b.doc, pa.int64(), mask=b.null == 1),
                     pa.array(b.score, pa.int64())], names=["item", "doc", "score"])
            best.clear()

        for docs in _doc_tiles(batches, bitmap):
            doc, term, tf, distinct = docs.counts()
            impact = impacts_of(tf, length_norms(docs.sizes, n_docs, n_terms)[doc])
            ids = np.array([0 if i is None else i for i in docs.ids], np.int64)
            nulls = np.array([i is None for i in docs.ids], np.int64)
            for g in range(len(groups)):
                tile = item_tile(g)
                if g not in best:
                    best[g] = tile.items, Best(len(tile.items), k)
                best[g][1].add(tile.scores(len(ids), doc, term, impact, distinct), ids, nulls)
            if sum(len(b.item) for _, b in best.values()) > KEPT_BEST:
                yield from lists()
        yield from lists()
        pa.default_memory_pool().release_unused()  # the worker lives on between tasks
    return run


def _bitmap(vocabulary: DataFrame) -> bytes:
    """Bits of the terms' CRC-32 modulo BITS; at most BITS / 8 bytes."""
    bit = F.crc32("term") % BITS
    parts = (vocabulary.select((F.floor(bit / 32768)).cast("long").alias("bucket"), (bit % 32768).alias("bit"))
             .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))
    out = bytearray(BITS // 8)
    buckets = parts.collect()
    for r in buckets:
        out[r["bucket"] * 4096:(r["bucket"] + 1) * 4096] = r["bits"]
    return bytes(out)


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item, numbered from 1."""
    order = [F.desc("score"), F.asc_nulls_last("doc")]
    part = Window.partitionBy("item", "part").orderBy(*order)
    whole = Window.partitionBy("item").orderBy(*order)
    return (lists.withColumn("part", F.spark_partition_id() % MERGE)
            .withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k)
            .withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k))


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """``item_col``, ``rank`` (from 1), ``id_col`` and ``score`` of the ``k``
    best documents of each item.

    Runs two passes over ``docs`` when it is called: the document frequencies
    and, after the items' weights are written, the scores.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").cast("binary").alias("text"))
    queries = materialize(items.select(F.col(item_col).alias("id"), F.col(query_col).cast("string").alias("text")).distinct()
                          .withColumn("item", F.monotonically_increasing_id()))
    postings, seen = materialize_observed(
        queries.select("item", F.col("text").cast("binary").alias("text"))
        .mapInArrow(_item_terms, "item long, term string, n long"), rows=F.count(F.lit(1)))
    vocabulary = materialize(postings.groupBy("term").agg(F.count(F.lit(1)).alias("held")))
    bitmap = _bitmap(vocabulary)
    counted = materialize(texts.mapInArrow(_count(bitmap), "term string, df long, total long")
                          .groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total")))
    size = counted.where("term is null").first()
    n_docs, n_terms = (size["df"], size["total"]) if size else (0, 0)
    weight = F.floor(1000.0 * F.log(F.lit(2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    known = materialize(vocabulary.join(counted, "term").select("term", "held", weight.alias("w")))
    weights = (join_by_group(postings, known, "term", "held", seen["rows"])
               .select("item", "term", (F.col("n") * F.col("w")).alias("weight")).where("weight > 0"))
    folder = shared_folder(spark, "item-tiles")
    written = materialize(weights.repartition("item").sortWithinPartitions("item", "term")
                          .mapInArrow(_write_tiles(folder), "name string, items long, weights long"))
    tiles = written.orderBy("name").collect()
    groups = tile_groups([tuple(r) for r in tiles])
    found = (texts.mapInArrow(_rank(bitmap, folder, groups, n_docs, n_terms, k), "item long, doc long, score long")
             if groups else spark.createDataFrame([], "item long, doc long, score long"))
    return (_merged(found, k).join(queries.select("item", "id"), "item")
            .select(F.col("id").alias(item_col), "rank", F.col("doc").alias(id_col), "score"))
