"""Exact duplicate removal that moves only rows which may be repeated.

De-duplicating by a hash aggregate shuffles every column of every row. Here a
48-bit digest of each row is counted first (little of a row is shuffled, equal
ones collapse map-side), and the digests that occur more than once set
bits of a filter of bounded size, which is broadcast. A row whose bit is not set
has no equal and stays where it is; the others, the repeated ones and a few that
share a bit with one, are compared in full. Equal rows share their digest
whatever it is, so the result is exact also where digests or bits collide; that
only moves more rows.

The input is scanned once for the digests and once for each of the two kinds of
rows, which is worth it where shuffling a whole row costs more than reading it
again: wide rows, stored by column. Give it a written table, not a long plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StructType

from tablescope.functions.columns import internal
from tablescope.session import materialize_observed

#: Bits of a row's digest: of 10^12 different rows one in 300 shares its own.
DIGEST_BITS = 48
#: Bits of the filter per repeated digest, and its bounds: 2^27 bits are two
#: million words, some 64 MB where they are joined.
BITS_PER_DIGEST, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 27


def _floats_inside(kind: DataType) -> bool:
    if isinstance(kind, (FloatType, DoubleType)):
        return True
    if isinstance(kind, ArrayType):
        return _floats_inside(kind.elementType)
    if isinstance(kind, MapType):
        return True
    return isinstance(kind, StructType) and any(_floats_inside(f.dataType) for f in kind.fields)


def row_digest(df: DataFrame) -> Column:
    """:data:`DIGEST_BITS` bits that equal rows share. Zeros of either sign are equal, and so are
    all NaN; nested columns that may hold either are left out, which is allowed."""
    parts = []
    for f in df.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (FloatType, DoubleType)):
            parts.append(c + F.lit(0).cast(f.dataType))
        elif not _floats_inside(f.dataType):
            parts += [c, c.isNull()]  # a null column leaves the hash as it was
    return F.xxhash64(F.lit(len(parts)), *parts).bitwiseAND(F.lit((1 << DIGEST_BITS) - 1))


def _word(digest: Column, bits: int) -> Column:
    return F.shiftright(digest.bitwiseAND(F.lit(bits - 1)), 6)


def split_by_repeats(df: DataFrame, digest: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows that have no equal, and rows that may. Runs one job
    that counts digests; the filter's words are written as a small table."""
    d, word, own = (internal(n, df.columns) for n in ("_digest", "_word", "_bits"))
    marked = df.withColumn(d, row_digest(df) if digest is None else digest)
    repeated, seen = materialize_observed(
        marked.select(d).groupBy(d).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(d), n=F.count(F.lit(1)))
    bits = LEAST_BITS
    while bits < min(MOST_BITS, BITS_PER_DIGEST * seen["n"]):
        bits *= 2
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(d).bitwiseAND(F.lit(63)).cast("int"))
    words = repeated.groupBy(_word(F.col(d), bits).alias(word)).agg(F.bit_or(one).alias(own))
    known = marked.withColumn(word, _word(F.col(d), bits)).join(F.broadcast(words), word, "left")
    maybe = F.coalesce(F.col(own).bitwiseAND(one), F.lit(0)) != 0
    columns = ["`" + c.replace("`", "``") + "`" for c in df.columns]
    return known.where(~maybe).select(*columns), known.where(maybe).select(*columns)


def drop_repeated_rows(df: DataFrame) -> DataFrame:
    """``df`` without repeated rows, as ``dropDuplicates`` gives it."""
    once, maybe = split_by_repeats(df)
    return once.unionByName(maybe.dropDuplicates())
