"""Published results: a table is seen whole, or not at all.

A result lives in a folder of its own below its path, and a small manifest
(format, schema, row count, files) names it::

    path/data-<id>/part-...        the rows, by Spark's own writer
    path/_manifest/00000003.json   the newest number is the result

Publishing writes a new data folder first, then the next manifest: a temporary
file renamed to its number, which is the one step that readers can see. Until
then, and after any failure, they follow the manifest before it, whose data is
still there. Superseded data is deleted with the next publication but one, so
that readers who have just planned a query on it can finish; what a failed
writer left behind is deleted by a publication a day later.

The manifest's schema also gives a CSV result its types back: nothing is
inferred. Of two writers at once, both succeed and the later number wins.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

_FOLDER = "_manifest"
#: Manifests whose data is kept besides the newest one's.
KEPT = 1
#: Data folders without a manifest are deleted once they are this old: a writer
#: may still be at work on a younger one.
ABANDONED_SECONDS = 24 * 3600

# CSV as spreadsheets and dataframe libraries write it.
_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: A null is an empty field, an empty text is ``""``; told apart on reading only
#: if the null value is no empty text. In a table of one column an empty line
#: would be no row: a null is spelled there (and such a text is read as one).
_NULL, _NULL_ALONE = "\0", "\\N"


@dataclass(frozen=True)
class Manifest:
    """What a published table is."""

    format: str
    schema: str
    rows: int
    folder: str
    files: list[tuple[str, int]] = field(default_factory=list)
    partition_by: list[str] = field(default_factory=list)
    options: dict[str, str] = field(default_factory=dict)
    about: dict = field(default_factory=dict)
    published: float = 0.0

    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


class _Store:
    """Files through the session's Hadoop file systems, wherever ``path`` is."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.base = spark.sparkContext._jvm, path.rstrip("/")
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.path(f"{self.base}/{name}" if name else self.base)

    def names(self, folder: str) -> list[tuple[str, int]]:
        """(name, age in milliseconds) of the entries of a folder; none if there is no such folder."""
        if not (self.fs.isDirectory(self.path(self.base)) and self.fs.exists(self.at(folder))):
            return []
        now = int(time.time() * 1000)
        return [(s.getPath().getName(), now - s.getModificationTime()) for s in self.fs.listStatus(self.at(folder))]

    def files(self, folder: str) -> list[tuple[str, int]]:
        """(path below ``folder``, bytes) of its data files."""
        root = self.fs.makeQualified(self.at(folder)).toString()
        found, out = self.fs.listFiles(self.at(folder), True), []
        while found.hasNext():
            s = found.next()
            name = s.getPath().toString().removeprefix(root).lstrip("/")
            if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
                out.append((name, s.getLen()))
        return sorted(out)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """A file with this name and text, whole from the moment it is seen;
        false if there is one already."""
        part = self.at(f"{_FOLDER}/.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(part, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        done = not self.fs.exists(self.at(name)) and self.fs.rename(part, self.at(name))
        if not done:
            self.fs.delete(part, False)
        return done

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def _numbers(store: _Store) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n, _ in store.names(_FOLDER) if n[0] not in "._" and n.endswith(".json"))


def _manifest(store: _Store, number: int) -> Manifest:
    held = json.loads(store.read(f"{_FOLDER}/{number:08d}.json"))
    return Manifest(**held | {"files": [tuple(f) for f in held["files"]]})


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest manifest at ``path``; None if nothing was published there."""
    store = _Store(spark, path)
    numbers = _numbers(store)
    return _manifest(store, numbers[-1]) if numbers else None


def _clean(store: _Store) -> None:
    """Delete superseded tables, and data that no writer can be at work on."""
    numbers = _numbers(store)
    for n in numbers[:-1 - KEPT]:
        store.delete(_manifest(store, n).folder)
        store.delete(f"{_FOLDER}/{n:08d}.json")
    live = {_manifest(store, n).folder for n in numbers[-1 - KEPT:]}
    for name, age in store.names(""):
        if name.startswith("data-") and name not in live and age > ABANDONED_SECONDS * 1000:
            store.delete(name)


def publish(df: DataFrame, path: str, fmt: str = "parquet", *, partition_by: list[str] | None = None,
            options: dict[str, str] | None = None, about: Callable[[], dict] | None = None) -> Manifest:
    """Write ``df`` and make it the table at ``path``; returns its manifest.

    Rows are counted, and for CSV texts with line breaks looked for, by the
    write job itself. ``about`` is called once the rows are written; what it
    returns comes back with the manifest. A failure leaves the table that was
    there before.
    """
    spark = df.sparkSession
    store = _Store(spark, path)
    newest = (_numbers(store) or [0])[-1]
    folder = f"data-{newest + 1:08d}-{uuid.uuid4().hex}"
    texts = [_quoted(f.name) for f in df.schema.fields if isinstance(f.dataType, StringType)] if fmt == "csv" else []
    breaks = F.coalesce(F.bool_or(F.concat_ws("", *texts).rlike("[\r\n]")), F.lit(False)) if texts else F.lit(False)
    seen = Observation(f"published_{uuid.uuid4().hex}")
    metrics = [F.count(F.lit(1)).alias("rows")] + ([breaks.alias("breaks")] if texts else [])
    given = dict(_CSV if fmt == "csv" else {}) | (options or {})
    if fmt == "csv" and len(df.columns) == 1:
        given.setdefault("nullValue", _NULL_ALONE)
    writer = df.observe(seen, *metrics).write.mode("errorifexists").format(fmt).options(**given)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{store.base}/{folder}")
    if fmt == "csv":
        given.setdefault("nullValue", _NULL)
        given["multiLine"] = bool(seen.get.get("breaks"))  # only then are files read whole
    made = Manifest(fmt, df.schema.json(), int(seen.get["rows"]), folder, store.files(folder), list(partition_by or []),
                    {k: str(v) for k, v in given.items()}, about() if about else {}, time.time())
    store.fs.mkdirs(store.at(_FOLDER))
    while True:  # another writer may take the number first
        newest = (_numbers(store) or [0])[-1]
        if store.write_new(f"{_FOLDER}/{newest + 1:08d}.json", json.dumps(asdict(made))):
            break
    _clean(store)
    return made


def read_published(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """The table that the newest manifest at ``path`` names, with the schema it
    was written with, or with ``schema`` (all text, say) if one is given."""
    found = manifest(spark, path)
    if found is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    schema = found.struct() if schema is None else schema
    if not found.files:  # a writer of no rows may write no file
        return spark.createDataFrame([], schema)
    df = (spark.read.schema(schema).format(found.format).options(**found.options)
          .load(f"{path.rstrip('/')}/{found.folder}"))
    # partition columns come back last: in the order they were written
    return df.select(*[_quoted(f.name) for f in found.struct().fields if f.name in df.columns])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
