"""Bounds of numeric columns from Parquet footers.

A Parquet file's footer holds, per row group and column, the smallest and
largest value and the number of nulls. Tasks read the footers of the files that
a table consists of, no column data, and their bounds are merged. What a footer
does not say for certain is scanned, and only that: a file whose statistics of a
column are missing (some writers leave them out where there is a NaN) or hold a
NaN, a file that Arrow cannot open, and columns that are in no file (partition
columns). All of it gives what a scan of the whole table gives.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructField, StructType

from tablescope.functions.columns import not_nan, numeric_columns

#: Footers that one task reads.
FILES_PER_TASK = 256

_FOUND = "file string, column string, rows long, nulls long, low double, high double, known boolean"


@dataclass(frozen=True)
class Bounds:
    """Of one column: rows of the table, those that are null or NaN (None: not
    known), and the smallest and largest other value (None: there is none)."""

    column: str
    rows: int
    low: float | None
    high: float | None
    missing: int | None = None

    @property
    def varies(self) -> bool:
        return self.low is not None and self.low < self.high


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a file's URI and its path there."""
    if uri.startswith("file:"):
        from urllib.parse import unquote

        return pafs.LocalFileSystem(), "/" + unquote(uri.removeprefix("file:")).lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def footer_rows(uri: str, columns: Sequence[str]) -> list[tuple]:
    """Rows of :data:`_FOUND` of one file; unknown in all if it cannot be opened."""
    try:
        fs, path = file_system(uri)
        with fs.open_input_file(path) as f:
            meta = pq.ParquetFile(f).metadata
    except (OSError, pa.ArrowException):  # a store or file that Arrow does not read: Spark scans it
        return [(uri, c, 0, None, None, None, False) for c in columns]
    places: dict[str, list[int]] = {}
    for i in range(meta.num_columns):
        places.setdefault(meta.schema.column(i).path.lower(), []).append(i)
    out = []
    for c in columns:
        at = places.get(c.lower(), [])
        if len(at) != 1:  # none: a partition column, say; more: spellings that only Spark tells apart
            out.append((uri, c, meta.num_rows, None, None, None, False))
            continue
        low, high, nulls, known = None, None, 0, True
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            s = group.column(at[0]).statistics
            if s is None or not (s.has_min_max or (s.has_null_count and s.null_count == group.num_rows)):
                known = known and not group.num_rows
                continue
            nulls = nulls + s.null_count if nulls is not None and s.has_null_count else None
            if s.has_min_max:
                a, b = float(s.min) + 0.0, float(s.max) + 0.0  # a zero bound may be of either sign
                known = known and not (math.isnan(a) or math.isnan(b))
                low, high = (a if low is None else min(low, a)), (b if high is None else max(high, b))
        out.append((uri, c, meta.num_rows, nulls, low, high, known))
    return out


def _read(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [n.split()[0] for n in _FOUND.split(", ")]
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()]
        for batch in batches:
            rows = [r for uri in batch.column("file").to_pylist() for r in footer_rows(uri, columns)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)
    return run


def table_bounds(table: DataFrame, columns: Sequence[str] | Mapping[str, str] | None = None) -> dict[str, Bounds]:
    """Bounds of numeric columns of ``table``, a Parquet table as it was read
    (no filter, no join): the files it consists of are asked, not its rows.

    ``columns`` are its numeric columns by default; a mapping gives the name in
    the files of a renamed column. The driver sees the list of files, as in any
    scan, and one row per column.
    """
    spark = table.sparkSession
    if columns is None:
        columns = numeric_columns(table)
    stored = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    for c in stored:
        if not isinstance(table.schema[c].dataType, NumericType):
            raise ValueError(f"{c} is no numeric column")
    files = table.inputFiles()
    if not files or not stored:
        return {c: Bounds(c, 0, None, None, 0) for c in stored}
    back = {f: c for c, f in stored.items()}
    tasks = -(-len(files) // FILES_PER_TASK)
    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(tasks)
    found = listed.mapInArrow(_read(list(back)), _FOUND)
    # a row per column and, for columns with any unknown file, the files to scan
    merged = found.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.min(F.when(F.col("known"), F.col("low"))).alias("low"),
        F.max(F.when(F.col("known"), F.col("high"))).alias("high"),
        F.when(F.bool_and(F.col("known") & F.col("nulls").isNotNull()), F.sum("nulls")).alias("nulls"),
        F.collect_list(F.when(~F.col("known"), F.col("file"))).alias("unknown"))
    out, unknown = {}, {}
    for r in merged.agg(F.collect_list(F.struct("*")).alias("columns")).first()["columns"]:  # one entry per column
        name = back[r["column"]]
        out[name] = Bounds(name, r["rows"], r["low"], r["high"], r["nulls"])
        if r["unknown"]:
            unknown[name] = r["unknown"]
    return {c: out[c] for c in stored} | _scanned(table, stored, unknown, out, len(files))


def _scanned(table: DataFrame, stored: Mapping[str, str], unknown: dict[str, list[str]], so_far: dict[str, Bounds],
             n_files: int) -> dict[str, Bounds]:
    """The bounds of columns whose footers leave files open: the values of these
    files are read, or the table's where that is all of them. Columns that share
    their open files are read together."""
    together: dict[tuple[str, ...], list[str]] = {}
    for c, files in unknown.items():
        together.setdefault(tuple(sorted(files)), []).append(c)
    out = {}
    for files, columns in together.items():
        whole, rows = len(files) == n_files, table
        if not whole:
            schema = StructType([StructField(stored[c], table.schema[c].dataType) for c in columns])
            rows = table.sparkSession.read.schema(schema).parquet(*files).toDF(*columns)
        aggs = [F.count(F.lit(1)).alias("rows")]
        for i, c in enumerate(columns):
            v = not_nan(rows, c).cast("double")
            aggs += [F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}"), F.count_if(v.isNull()).alias(f"m{i}")]
        seen = rows.agg(*aggs).first()
        for i, c in enumerate(columns):
            known = so_far[c]
            low = min((x for x in (known.low, seen[f"l{i}"]) if x is not None), default=None)
            high = max((x for x in (known.high, seen[f"h{i}"]) if x is not None), default=None)
            out[c] = Bounds(c, seen["rows"] if whole else known.rows, low, high, seen[f"m{i}"] if whole else None)
    return out


def numeric_bounds(table: DataFrame, columns: Sequence[str] | Mapping[str, str] | None = None) -> DataFrame:
    """(column, min, max) as the explorer's bounds, from the footers."""
    found = table_bounds(table, columns)
    return table.sparkSession.createDataFrame([(b.column, b.low, b.high) for b in found.values()],
                                              "column string, min double, max double")
