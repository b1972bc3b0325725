"""A layout that lets filters on several columns skip most of a table.

A range filter reaches the scan, but in a table in arrival order every row group
holds every value, and nothing can be skipped; sorting helps the first column
only. Here each filter column is replaced by its rank among some quantiles, the
ranks' bits are interleaved into one key (a Z-order curve), and the table is
range-partitioned and sorted by it: rows that are near in all columns are near
in the files, so row groups are small boxes, and a filter on any of the columns
reads those that it cuts.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from tablescope.functions.columns import internal
from tablescope.operators.ranking import text_block
from tablescope.sources.footers import FILES_PER_TASK, file_system
from tablescope.sources.published import Manifest, publish

#: Ranks per column, as a power of two, and the accuracy of their quantiles.
BITS, ACCURACY = 6, 10_000


def _number(df: DataFrame, column: str) -> Column:
    """A double in the column's order (a text's first bytes)."""
    c, kind = F.col(f"`{column}`"), df.schema[column].dataType
    if isinstance(kind, (StringType, BinaryType)):
        return text_block(c, 0)
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, TimestampNTZType):
        return c.cast("timestamp").cast("double")
    if isinstance(kind, BooleanType):
        return c.cast("int").cast("double")
    if isinstance(kind, (NumericType, TimestampType)):
        return c.cast("double")
    raise ValueError(f"{column} has no order that a curve could follow")


def _rank(c: Column, cuts: Sequence[float], low: int = 0) -> Column:
    """How many of the ascending ``cuts`` are at most ``c``, by a tree of comparisons."""
    if not cuts:
        return F.lit(low)
    mid = len(cuts) // 2
    return F.when(c >= F.lit(cuts[mid]), _rank(c, cuts[mid + 1:], low + mid + 1)).otherwise(_rank(c, cuts[:mid], low))


def curve_key(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The place of a row on the curve through ``columns``; one aggregation over
    ``df`` finds the quantiles of all of them. Nulls rank lowest, NaN highest."""
    fractions = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = {c: _number(df, c) for c in columns}
    found = df.agg(*[F.percentile_approx(n, fractions, ACCURACY).alias(f"q{i}") for i, n in enumerate(numbers.values())]).first()
    key = F.lit(0).cast("long")
    for i, n in enumerate(numbers.values()):
        cuts = sorted(set(found[f"q{i}"] or []))
        rank = F.coalesce(_rank(n, cuts), F.lit(0)).cast("long")
        # ranks of a column with few values spread over all bits, so that each has its say
        rank = F.floor(rank * (1 << bits) / (len(cuts) + 1)).cast("long")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(numbers) + i))
    return key


def clustered(df: DataFrame, columns: Sequence[str], files: int | None = None, bits: int = BITS) -> DataFrame:
    """``df`` in the order of the curve through ``columns``, range-partitioned
    into ``files`` parts (default: as the session shuffles). Rows of one place
    on the curve are dealt over as many parts as they fill. Reads ``df`` twice,
    and a sample of it: give it a written table."""
    if bits * len(columns) > 62:
        raise ValueError("too many columns for a 64-bit curve")
    place, tie = internal("_place", df.columns), internal("_tie", df.columns)
    rows = df.withColumns({place: curve_key(df, columns, bits), tie: F.monotonically_increasing_id()})
    dealt = rows.repartitionByRange(files, place, tie) if files else rows.repartitionByRange(place, tie)
    return dealt.sortWithinPartitions(place).drop(place, tie)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, bits: int = BITS,
                    row_group_bytes: int | None = None) -> Manifest:
    """:func:`clustered` as a published Parquet table at ``path``; read it with
    :func:`published.read_published`."""
    options = {"parquet.block.size": str(row_group_bytes)} if row_group_bytes else {}
    return publish(clustered(df, columns, files, bits), path, options=options, about=lambda: {"clustered by": list(columns)})


def _groups(ranges: dict[str, tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for uri in batch.column("file").to_pylist():
                fs, path = file_system(uri)
                with fs.open_input_file(path) as f:
                    meta = pq.ParquetFile(f).metadata
                places = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    size = sum(group.column(i).total_compressed_size for i in range(meta.num_columns))
                    kept = True
                    for c, (low, high) in ranges.items():
                        s = group.column(places[c]).statistics
                        if s is not None and s.has_min_max:
                            kept = kept and not (s.max < low or s.min > high)
                    rows.append((size, kept))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.bool_())],
                                             names=["bytes", "kept"])
    return run


def pruning(table: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    """One row: ``row_groups`` and ``bytes`` of a Parquet table as it was read,
    and how many of them the inclusive ``ranges`` leave to read
    (``row_groups_read``, ``bytes_read``), by the statistics in its footers,
    which are all that is read here."""
    files = table.inputFiles()
    spark = table.sparkSession
    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, -(-len(files) // FILES_PER_TASK)))
    found = listed.mapInArrow(_groups(dict(ranges)), "bytes long, kept boolean")
    zero = F.lit(0).cast("long")
    return found.agg(F.count(F.lit(1)).alias("row_groups"), F.coalesce(F.sum("bytes"), zero).alias("bytes"),
                     F.count_if("kept").alias("row_groups_read"),
                     F.coalesce(F.sum(F.when(F.col("kept"), F.col("bytes"))), zero).alias("bytes_read"))
