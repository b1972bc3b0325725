"""Near-duplicate documents: one-permutation MinHash with optimal
densification, banded buckets, star-shaped candidate edges, exact checks.

1. One pass over the texts gives each document's shingle set, its digest and
   its signature: the 64-bit shingle digests split into ``bands * rows`` equal
   ranges (one permutation), the least of each range is its value, and an
   empty range borrows the value of a filled one, chosen by a random order of
   its own (optimal densification). ``rows`` values make one band key.
2. Documents with equal sets are one node, named by the set's digest; copies
   are never expanded.
3. Buckets with one node are dropped. In the others every node gets an edge to
   one centre: the node that meets others in most bands, as that is the least
   edited one. So a bucket of n nodes proposes n - 1 pairs, not n * (n - 1) / 2.
4. Edges are checked on the full sets; those that hold give components.
5. What stars can miss: a link between two members of different components.
   The nodes of buckets that still hold more than one component are joined
   again, exactly, by their rarest shingles (see :func:`_rare_pairs`), and the
   pairs left are checked on the full sets too, so no candidate pair is lost.

With 42 bands of 6 rows two sets of similarity 0.8 share no bucket with a
probability of 3e-6, of 0.85 with 2e-9. Sets are compared by 64-bit digests of
shingles and are equal if their 128-bit digests are. Tables of the way are
deleted at the end; the result is a table in the checkpoint folder.

Defined results: a document without words (null, empty or blank text) has the
empty set and is linked with nothing; so is a row whose id is null, whose
component is null. Rows that share an id are one document: what is linked with
one of them is linked with all, and each is returned. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescope.llm.components import connected_components
from tablescope.llm.runtime import rest
from tablescope.llm.shingles import mix, shingle_sets
from tablescope.llm.skew import FREQUENT, MOST_BITS, join_by_group, split_by_keys, with_key_in
from tablescope.session import materialize, materialize_observed, scratch

BANDS, ROWS = 42, 6
_U = np.uint64
#: A centre's set goes to each task that checks it against some members; so
#: many parts a centre's members are dealt to at most.
CENTRE_PARTS = 1 << 16
#: Parts in which the nodes of a frequent rare-first shingle meet.
PAIR_PARTS = 32
#: Levels of rarity (a shingle of 2, 4, ... sets), bits per shingle of a level,
#: and bits of a level at most: 16 levels of 4 MB bound what is sent.
LEVELS, BITS_PER_SHINGLE, LEVEL_BITS = 16, 16, 1 << 25


@lru_cache(maxsize=4)
def _orders(bins: int) -> np.ndarray:
    """For each range the random order in which it looks for a filled one."""
    rng = np.random.default_rng(20170806)
    return np.argsort(rng.random((bins, bins)), axis=1)


def signature(sorted_set: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation signature of an ascending, non-empty digest set."""
    at = ((sorted_set >> _U(32)) * _U(bins) >> _U(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    out, filled = np.zeros(bins, dtype=_U), np.zeros(bins, dtype=bool)
    out[at[first]] = sorted_set[first]
    filled[at[first]] = True
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = _orders(bins)[empty]
        for part in (order[:, :16], order):  # sixteen tries nearly always do
            hit = filled[part]
            pick = hit.argmax(axis=1)
            if hit[np.arange(len(empty)), pick].all():
                break
        out[empty] = out[part[np.arange(len(empty)), pick]]
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band (the band's number is mixed in)."""
    place = mix(np.arange(7, 7 + rows, dtype=_U)) | _U(1)
    own = mix(np.arange(1000, 1000 + bands, dtype=_U))
    return mix(mix((mix(sig.reshape(bands, rows)) * place).sum(axis=1, dtype=_U)) + own)


def _sign(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column("id").is_valid().to_numpy(zero_copy_only=False)
            size, digest, keys = [], [], []
            for ok, s in zip(known, shingle_sets(batch.column("text"), k), strict=True):
                size.append(len(s))
                use = ok and len(s) > 0
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if use else None)
                keys.append(band_keys(signature(s, bands * rows), bands, rows).view(np.int64) if use else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(size, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["id", "n", "digest", "keys"])
            rest()
    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # few texts at a time: a set takes more room than its text
            for a in range(0, batch.num_rows, 512):
                sets = [s.tobytes() for s in shingle_sets(batch.column("text").slice(a, 512), k)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()), pa.array(sets, pa.binary())],
                    names=["node", "shingles"])
            rest()
    return run


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two ascending arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _check(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            x, y = batch.column("set_a"), batch.column("set_b")
            linked = []
            for i in range(batch.num_rows):
                own = np.frombuffer(x[i].as_buffer(), dtype=_U)
                other = np.frombuffer(y[i].as_buffer(), dtype=_U)
                common = _common(own, other)
                linked.append(100 * common >= percent * (len(own) + len(other) - common))
            yield pa.RecordBatch.from_arrays([a, b, pa.array(linked, pa.bool_())], names=["a", "b", "linked"])
        rest()
    return run


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(batch.column("shingles")[i].as_buffer(), dtype=np.int64))], names=["shingle"])
    rest()


def rarity(shingles: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The highest level whose bits hold each shingle, from 1; 0 for one that
    only its own set has."""
    out = np.zeros(len(shingles), dtype=np.int64)
    for k, bits in enumerate(levels, 1):
        at = (shingles & _U(8 * len(bits) - 1)).astype(np.int64)
        out[(bits[at >> 3] >> (at & 7)) & 1 == 1] = k
    return out


def _prefixes(percent: int, levels: list[bytes]):
    """The first shingles of each set, rarest first, that another set may have:
    ``rest`` is how many follow from there on, itself included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.frombuffer(x, dtype=np.uint8) for x in levels]
        for batch in batches:
            for i in range(batch.num_rows):
                own = np.frombuffer(batch.column("shingles")[i].as_buffer(), dtype=_U)
                n = len(own)
                level = rarity(own, held)
                order = np.lexsort((own, level))[:n - -(-n * percent // 100) + 1]
                at = np.flatnonzero(level[order] > 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[order[at]].view(np.int64)), pa.array(n - at, pa.int64()),
                     *(batch.column(c).take(pa.array([i] * len(at), pa.int64())) for c in ("node", "n", "component"))],
                    names=["shingle", "rest", "node", "n", "component"])
        rest()
    return run


def _checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b: nodes; distinct, b seldom frequent) with ``linked``. Members of
    a frequent ``a`` are dealt over many keys (a, part), each with a copy of
    its set; one key has few rows then, and a rare ``a`` no needless copies."""
    part = F.pmod(F.xxhash64("b"), F.lit(CENTRE_PARTS))
    pairs = pairs.select("a", "b", part.alias("part"))
    member = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    copies = pairs.select("a", "part").distinct().join(
        sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
    return (pairs.join(member, "b").join(copies, ["a", "part"])
            .select("a", "b", "set_a", "set_b")
            .mapInArrow(_check(percent), "a binary, b binary, linked boolean"))


def _may_link(n1, n2, percent: int, most=None):
    """Whether sets of sizes n1, n2 with ``most`` common elements at most can
    reach the similarity."""
    most = F.least(n1, n2) if most is None else most
    return 100 * most >= percent * (n1 + n2 - most)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = 5,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: ``id_col``, ``n_shingles``, ``component_id`` (the
    smallest id reachable over links of at least ``percent`` % similarity) and
    ``kept`` (it is its own component's smallest id)."""
    with scratch(docs.sparkSession):
        source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        found = _near_duplicates(source, words, percent, bands, rows)
        return materialize(found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                                        F.col("component").alias("component_id"),
                                        F.col("id").eqNullSafe(F.col("component")).alias("kept")), keep=True)


def _near_duplicates(source: DataFrame, words: int, percent: int, bands: int, rows: int) -> DataFrame:
    signed, seen = materialize_observed(
        source.mapInArrow(_sign(words, bands, rows), "id long, n long, digest binary, keys array<long>"),
        rows=F.count("digest"))
    with_set = signed.where("digest is not null")

    # Equal sets are one node, with the keys that they share; its id is the smallest.
    nodes = materialize(with_set.groupBy(F.col("digest").alias("node")).agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys")))
    buckets = nodes.select(F.explode("keys").alias("key"), "node", "n")
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key")
    members = materialize(buckets.join(shared, "key", "left_semi"))

    links = _links(members, nodes, source, words, percent).union(_one_document(with_set))
    # A component is named by a node; its id is the smallest of its nodes.
    label, linked = materialize_observed(connected_components(links).join(nodes.select("node", "id"), "node"),
                                         rows=F.count(F.lit(1)))
    smallest = materialize(label.groupBy("component").agg(F.min("id").alias("to"), F.count(F.lit(1)).alias("size")))
    label = join_by_group(label.select("node", "component"), smallest, "component", "size", linked["rows"])
    grouped = materialize(nodes.join(label.select("node", "to"), "node", "left").select(
        F.col("node").alias("digest"), "copies", F.coalesce("to", "id").alias("component")))
    found = join_by_group(with_set.select("id", "n", "digest"), grouped, "digest", "copies", seen["rows"])
    return found.select("id", "n", "component").unionByName(
        signed.where("digest is null").select("id", "n", F.col("id").alias("component")))


def _one_document(with_set: DataFrame) -> DataFrame:
    """Links (a, b) between the nodes of each id whose rows have several sets:
    all with the least of them."""
    own, seen = materialize_observed(with_set.select("id", F.col("digest").alias("b")).distinct(), rows=F.count(F.lit(1)))
    several = materialize(own.groupBy("id").agg(F.min("b").alias("a"), F.count(F.lit(1)).alias("size")).where("size > 1"))
    return join_by_group(own, several, "id", "size", seen["rows"]).where("a != b").select("a", "b")


def _node_sets(wanted: DataFrame, source: DataFrame, words: int) -> DataFrame:
    """``node``, ``shingles`` of the ``wanted`` nodes (node, id), once each, and
    of some others."""
    ids, seen = materialize_observed(wanted.select("id").distinct(), n=F.count(F.lit(1)))
    known = source.where("id is not null")
    # Texts stay where they are, unless the filter would let through too many.
    rows = (split_by_keys(known, ids, "id", seen["n"])[0] if 4 * seen["n"] <= MOST_BITS
            else with_key_in(known, ids, "id", seen["n"]))
    sets = materialize(rows.mapInArrow(_sets(words), "node binary, shingles binary"))
    # rows repeated as a whole have been read each
    _, seen = materialize_observed(sets.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), n=F.count(F.lit(1)))
    return materialize(sets.dropDuplicates(["node"])) if seen["n"] else sets


def _links(members: DataFrame, nodes: DataFrame, source: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) whose components are those of all links among the
    candidate pairs of ``members`` (key, node, n)."""
    wanted = nodes.select("node", "id").join(members.select("node").distinct(), "node", "left_semi")
    sets = _node_sets(wanted, source, words)

    # Stars: the centre of a bucket is its node with the most shared bands.
    bands_met = members.groupBy("node").agg(F.count(F.lit(1)).alias("met"))
    ranked = materialize(members.join(bands_met, "node"))
    centre = (ranked.groupBy("key").agg(F.min(F.struct((-F.col("met")).alias("m"), "node", "n")).alias("c"))
              .select("key", F.col("c.node").alias("a"), F.col("c.n").alias("n_a")))
    star = (ranked.join(centre, "key").where(F.col("node") != F.col("a"))
            .where(_may_link(F.col("n"), F.col("n_a"), percent))
            .select("a", F.col("node").alias("b")).distinct())
    first = materialize(_checked(star, sets, percent))
    linked = first.where("linked").select("a", "b")
    label = connected_components(linked)

    # Buckets that stars left with several components; of two nodes, the star
    # was the only pair.
    placed = materialize(members.join(label, "node", "left")
                         .select("key", "node", "n", F.coalesce("component", "node").alias("component")))
    split = (placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                       F.count(F.lit(1)).alias("size"))
             .where("lo < hi and size > 2").select("key"))
    open_, seen = materialize_observed(placed.join(split, "key", "left_semi").select("node", "n", "component").distinct(),
                                       n=F.count(F.lit(1)))
    if not seen["n"]:
        return linked
    own = materialize(with_key_in(sets, open_, "node", seen["n"]).join(open_, "node"))
    pairs = _rare_pairs(own, percent)
    tried = first.select(F.col("a"), F.col("b")).union(first.select(F.col("b"), F.col("a")))
    pairs = materialize(pairs.join(tried, ["a", "b"], "left_anti"))
    second = materialize(_checked(pairs, own, percent).where("linked"))
    return linked.union(second.select("a", "b"))


def _levels(counts: DataFrame) -> list[bytes]:
    """Bitmaps of the shingles (by their lowest bits) that at least 2, 4, 8 ...
    sets have. Each level has :data:`BITS_PER_SHINGLE` bits per shingle, up to
    :data:`LEVEL_BITS`: a bound on what reaches the driver and the tasks,
    whatever the data. A shingle that shares its bit with a more frequent one
    only counts as one."""
    size = counts.agg(*[F.count_if(F.col("df") >= 1 << k).alias(f"l{k}") for k in range(1, LEVELS + 1)]).first()
    wide = [min(LEVEL_BITS, 1 << max(16, (BITS_PER_SHINGLE * size[f"l{k}"] - 1).bit_length()))
            for k in range(1, LEVELS + 1) if size[f"l{k}"]]
    level = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.lit(bits).alias("bits"), F.lit(1 << k).alias("least"))
                                for k, bits in enumerate(wide, 1)])) if wide else None
    out = [bytearray(bits // 8) for bits in wide]
    if wide:
        bit = F.col("shingle").bitwiseAND(F.col("l.bits") - 1)
        parts = (counts.select("shingle", "df", level.alias("l")).where(F.col("df") >= F.col("l.least"))
                 .select(F.col("l.level").alias("level"), F.floor(bit / 32768).cast("long").alias("bucket"), (bit % 32768).alias("bit"))
                 .groupBy("level", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))
        buckets = parts.collect()
        for r in buckets:
            out[r["level"] - 1][r["bucket"] * 4096:(r["bucket"] + 1) * 4096] = r["bits"]
    return [bytes(x) for x in out]


def _rare_pairs(own: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes in different components of ``own`` (node, n,
    component, shingles) that may reach the similarity: a superset of those
    that do.

    Each set is put in one order for all: by the number of sets that have a
    shingle, in powers of two (see :func:`_levels`), then by digest. Two sets
    that reach the similarity share a shingle among the first of both, and what
    follows it there must suffice for the rest (prefix and position filters).
    The edits of a copy are rare, so come first, and few pairs are left. Only
    these first shingles leave a task as rows; a shingle that one set alone has
    takes a place among them but needs no row.
    """
    counts = materialize(own.select("shingles").mapInArrow(_shingle_rows, "shingle long")
                         .groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    prefix, seen = materialize_observed(
        own.mapInArrow(_prefixes(percent, _levels(counts)), "shingle long, rest long, node binary, n long, component binary"),
        rows=F.count(F.lit(1)))
    largest = materialize(
        prefix.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("size"))
        .groupBy("shingle").agg(F.max(F.struct("size", "component")).alias("top"), F.sum("size").alias("rows"),
                                F.count(F.lit(1)).alias("parts"))
        .where("parts > 1").select("shingle", "rows", F.col("top.component").alias("top")))
    outside = (join_by_group(prefix, largest, "shingle", "rows", seen["rows"])
               .where(F.col("component") != F.col("top"))
               .select("shingle", "top", F.col("node").alias("a"), F.col("n").alias("n_a"),
                       F.col("rest").alias("rest_a"), F.col("component").alias("component_a")))
    # The nodes of a frequent shingle (a thousand at most) meet in many parts.
    frequent = F.broadcast(largest.where(F.col("rows") * FREQUENT > seen["rows"])
                           .select("shingle", F.lit(True).alias("hot")))
    part = F.when(F.col("hot"), F.pmod(F.xxhash64("a"), F.lit(PAIR_PARTS))).otherwise(0)
    every = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(PAIR_PARTS - 1))).otherwise(F.array(F.lit(0)))
    outside = outside.join(frequent, "shingle", "left").withColumn("part", part.cast("int")).drop("hot")
    across = prefix.join(frequent, "shingle", "left").withColumn("part", F.explode(every)).drop("hot")
    both = ((F.col("component_a") != F.col("component"))
            & ((F.col("component") == F.col("top")) | (F.col("a") < F.col("node")))
            & _may_link(F.col("n_a"), F.col("n"), percent)
            & _may_link(F.col("n_a"), F.col("n"), percent, F.least("rest_a", "rest")))
    return outside.join(across, ["shingle", "part"]).where(both).select("a", F.col("node").alias("b")).distinct()
