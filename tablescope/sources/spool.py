"""Typing text columns while they are read, once.

The types of a CSV's columns are known only when its last value has been seen,
so inferring them first reads the text twice, and a lazy reader parses it again
in every query. Here one pass writes each text column as a lattice of readings
(whole number, number, truth value, text) into a Parquet *spool*, and the same
write counts how many values have each reading. The counts then choose a
column of the spool per column of the table: nothing is parsed again, filters
and column pruning reach the Parquet scan, and its footers hold statistics.

A value's text is stored only where none of its readings spells it the same way
(``007``, ``1e5``), so a clean numeric column costs no text; a column that turns
out to be text puts its values together again, as they were.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablescope.session import materialize_observed
from tablescope.sources.published import manifest, publish, read_published

# Numbers as people write them; a cast alone would take "12d" for one.
_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?(inf|Inf|infinity|Infinity)\s*$"
# The spellings of truth values.
_YES, _NO = "True", "False"

TYPES = ("double", "boolean", "bigint", "string")


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def whole(v: Column) -> Column:
    return F.when(v.rlike(_WHOLE), v.try_cast("bigint"))


def number(v: Column) -> Column:
    return F.when(v.rlike(_NUMBER), v.try_cast("double"))


def chosen_type(values: int, whole_numbers: int, numbers: int, truths: int) -> str:
    """The narrowest reading that all values have; none at all is a double."""
    if not values:
        return "double"
    if truths == values:
        return "boolean"
    if whole_numbers == values:
        return "bigint"
    return "double" if numbers == values else "string"


@dataclass(frozen=True)
class Spooled:
    """A column of the table: its name, and its place in the spool. ``type`` is
    None for a column that was no text, which is stored as it is."""

    name: str
    place: int
    type: str | None

    def read(self) -> Column:
        if self.type is None:
            return F.col(f"v{self.place}").alias(self.name)
        w, n, y, t = (F.col(f"{kind}{self.place}") for kind in "wnyt")
        if self.type == "string":
            spelled = F.when(y, _YES).when(~y, _NO)
            column = F.coalesce(t, w.cast("string"), spelled, n.cast("string"))
        else:
            column = {"bigint": w, "double": n, "boolean": y}[self.type]
        return column.alias(self.name)


def _readings(df: DataFrame) -> tuple[list[Column], dict[str, Column]]:
    """The spool's columns, and the counts that decide the types."""
    columns, counts = [], {}
    for i, f in enumerate(df.schema.fields):
        v = quoted(f.name)
        if not isinstance(f.dataType, StringType):
            columns.append(v.alias(f"v{i}"))
            continue
        w, n, y = whole(v), number(v), F.when(v.isin(_YES, _NO), v == _YES)
        same = (w.cast("string") == v) | (n.cast("string") == v) | y.isNotNull()
        text = F.when(~F.coalesce(same, F.lit(False)), v)
        columns += [c.alias(f"{kind}{i}") for kind, c in zip("wnyt", (w, n, y, text), strict=True)]
        counts |= {f"values{i}": F.count_if(F.expr(f"t{i} is not null or n{i} is not null or y{i} is not null")),
                   f"whole{i}": F.count(f"w{i}"), f"numbers{i}": F.count(f"n{i}"), f"truths{i}": F.count(f"y{i}")}
    return columns, counts


def _typed(df: DataFrame, seen: dict[str, int]) -> list[Spooled]:
    return [Spooled(f.name, i, None if not isinstance(f.dataType, StringType) else chosen_type(
        seen[f"values{i}"], seen[f"whole{i}"], seen[f"numbers{i}"], seen[f"truths{i}"]))
        for i, f in enumerate(df.schema.fields)]


def _view(spool: DataFrame, columns: Sequence[Spooled]) -> DataFrame:
    return spool.select(*[c.read() for c in columns])


def spool_text(df: DataFrame) -> DataFrame:
    """``df`` with its text columns typed by their values: one pass over it,
    written as a table in the checkpoint folder, which the result reads. Columns
    that are no text stay as they are."""
    columns, counts = _readings(df)
    if not counts:
        return df
    spool, seen = materialize_observed(df.select(*columns), **counts)
    return _view(spool, _typed(df, seen))


def _fingerprint(df: DataFrame) -> list[list]:
    """(file, bytes, modification time) of what ``df`` reads."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in sorted(df.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        status = path.getFileSystem(conf).getFileStatus(path)
        out.append([name, status.getLen(), status.getModificationTime()])
    return out


def spool_to(df: DataFrame, source: DataFrame, folder: str) -> DataFrame:
    """:func:`spool_text` into a published table at ``folder``, for sessions to
    come: as long as the files of ``source`` (what ``df`` was read from) are the
    same, the spool there is used and no text is read."""
    spark, files = df.sparkSession, _fingerprint(source)
    found = manifest(spark, folder)
    if found is not None and found.about.get("files") == files:
        return open_spool(spark, folder)
    columns, counts = _readings(df)
    if not counts:
        return df
    seen = Observation()
    rows = df.select(*columns).observe(seen, *[c.alias(n) for n, c in counts.items()])
    publish(rows, folder, "parquet", about=lambda: {
        "files": files, "columns": [[c.name, c.place, c.type] for c in _typed(df, seen.get)]})
    return open_spool(spark, folder)


def open_spool(spark: SparkSession, folder: str) -> DataFrame:
    """The typed table of a spool that :func:`spool_to` published."""
    found = manifest(spark, folder)
    if found is None or "columns" not in found.about:
        raise FileNotFoundError(f"there is no spool at {folder}")
    return _view(read_published(spark, folder), [Spooled(*c) for c in found.about["columns"]])
