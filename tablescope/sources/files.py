"""File sources: CSV (trip input, explorer input) and Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

from tablescope.sources.published import manifest, read_published
from tablescope.sources.spool import chosen_type, number, quoted, spool_text, spool_to, whole

# Text spellings read as missing by the explorer source.
NA_SPELLINGS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                "n/a", "nan", "null")


def read_csv(spark: SparkSession, paths: str | Sequence[str], *,
             schema: StructType | str | None = None,
             infer_sample_ratio: float = 1.0) -> DataFrame:
    """CSV with a header row.

    Pass ``schema`` for large inputs: inference is an extra full pass over
    the files. When inferring, ``infer_sample_ratio`` < 1 limits that pass
    to a sample. Lists of files and globs are accepted. A published table
    (:mod:`tablescope.sources.published`) states its schema itself.
    """
    if schema is not None:
        return _csv(spark, paths, schema)
    one = paths if isinstance(paths, str) else (list(paths)[0] if len(paths) == 1 else None)
    if one and manifest(spark, one) is not None:
        return read_published(spark, one)
    reader = spark.read.options(header=True, inferSchema=True, samplingRatio=infer_sample_ratio)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def read_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Parquet files, or a published table."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if len(paths) == 1 and manifest(spark, paths[0]) is not None:
        return read_published(spark, paths[0])
    return spark.read.parquet(*paths)


def null_spellings(df: DataFrame, na: Sequence[str] = NA_SPELLINGS) -> DataFrame:
    """Turn NA spellings in text columns, and NaN in float columns, into null.

    After this operators only see nulls (Spark would otherwise count NaN,
    sort it highest and let it poison sums).
    """
    exprs = {}
    na_list = list(na)
    for f in df.schema.fields:
        c = quoted(f.name)
        if isinstance(f.dataType, StringType):
            exprs[f.name] = F.when(c.isin(na_list), F.lit(None)).otherwise(c)
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            exprs[f.name] = F.nanvl(c, F.lit(None).cast(f.dataType))
    return df.withColumns(exprs) if exprs else df


def infer_text_types(df: DataFrame) -> DataFrame:
    """Type text columns from their non-null values: whole numbers become
    bigint, other plainly written numbers double, ``True``/``False`` boolean; a
    column without values becomes double; anything else stays text.

    One aggregation over the data decides all columns (a single row of
    counts reaches the driver), then one projection casts them. A table that
    is dear to read twice is better typed by :func:`spool.spool_text`.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not text:
        return df
    aggs = []
    for i, c in enumerate(text):
        v = quoted(c)
        aggs += [F.count(v).alias(f"n{i}"), F.count(whole(v)).alias(f"i{i}"), F.count(number(v)).alias(f"d{i}"),
                 F.count_if(v.isin("True", "False")).alias(f"b{i}")]
    counts = df.agg(*aggs).first()
    casts = {}
    for i, c in enumerate(text):
        kind = chosen_type(*(counts[f"{k}{i}"] for k in "nidb"))
        if kind == "double":
            casts[c] = F.nanvl(quoted(c).try_cast("double"), F.lit(None).cast("double"))
        elif kind == "bigint":
            casts[c] = quoted(c).try_cast("bigint")
        elif kind == "boolean":
            casts[c] = quoted(c) == "True"
    return df.withColumns(casts) if casts else df


def read_explorer_csv(spark: SparkSession, paths: str | Sequence[str], *,
                      schema: StructType | str | None = None, spool: str | None = None) -> DataFrame:
    """CSV for interactive exploration: header, NA spellings and NaN as
    null, then numeric typing of the text columns (so a numeric column with
    ``"NA"`` holes comes out numeric). Dates stay text unless ``schema``
    says otherwise.

    Without a ``schema`` the text is read once, into a Parquet table that all
    later queries read (:mod:`tablescope.sources.spool`): in the checkpoint
    folder, or at ``spool``, where later sessions find it as long as the files
    have not changed."""
    if schema is not None:
        return null_spellings(_csv(spark, paths, schema))
    raw = _csv(spark, paths, None)
    typed = null_spellings(raw)
    return spool_text(typed) if spool is None else spool_to(typed, raw, spool)


def _csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str | None) -> DataFrame:
    """CSV with a header, all text without a schema; a published table's rows
    are those of its newest manifest."""
    one = paths if isinstance(paths, str) else (list(paths)[0] if len(paths) == 1 else None)
    found = manifest(spark, one) if one else None
    if found is not None and found.format == "csv":
        text = StructType([StructField(f.name, StringType()) for f in found.struct().fields])
        return read_published(spark, one, schema=text if schema is None else schema)
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)
