"""Schema-level column helpers.

Everything here inspects ``df.schema`` / ``df.columns`` only (no job is run)
or builds a single projection, so it is free at any data size.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, NumericType, StringType


def normalise_name(name: str) -> str:
    """strip, lower-case, spaces to underscores."""
    return name.strip().lower().replace(" ", "_")


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`normalise_name` in one projection.

    Two raw names that normalise to the same name would give an ambiguous
    table; that is rejected up front with the clashing names.
    """
    new = [normalise_name(c) for c in df.columns]
    seen: dict[str, list[str]] = {}
    for raw, clean in zip(df.columns, new):
        seen.setdefault(clean, []).append(raw)
    clashes = {k: v for k, v in seen.items() if len(v) > 1}
    if clashes:
        raise ValueError(f"column names clash after normalisation: {clashes}")
    if new == list(df.columns):
        return df
    return df.toDF(*new)


# Substring rules that pick a column for a role, first match in
# schema order, applied to normalised names.
def _is_timestamp(c: str) -> bool:
    return "pickup" in c and ("date" in c or "time" in c)


def _is_fare(c: str) -> bool:
    return "fare" in c or "total" in c


def _is_distance(c: str) -> bool:
    return "dist" in c


def _is_payment(c: str) -> bool:
    return "payment" in c


def _is_vendor(c: str) -> bool:
    return "vendor" in c


ROLE_RULES = {
    "timestamp": _is_timestamp,
    "fare": _is_fare,
    "distance": _is_distance,
    "payment": _is_payment,
    "vendor": _is_vendor,
}


def find_role(columns: DataFrame | Sequence[str], role: str) -> str | None:
    """First column (schema order) that matches the role rule, else None."""
    cols = columns.columns if isinstance(columns, DataFrame) else list(columns)
    rule = ROLE_RULES[role]
    return next((c for c in cols if rule(c)), None)


def group_role(columns: DataFrame | Sequence[str]) -> str | None:
    """Grouping column of the trip reports: payment, else vendor."""
    return find_role(columns, "payment") or find_role(columns, "vendor")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """All numeric columns (every NumericType width, decimals included)."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in skip]


def string_columns(df: DataFrame, include_dates: bool = False) -> list[str]:
    """Categorical columns: strings, plus dates when asked."""
    kinds = (StringType, DateType) if include_dates else (StringType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def keep_existing(df: DataFrame, wanted: Iterable[str | None]) -> DataFrame:
    """Select the wanted columns that exist, in the wanted order, once each."""
    have = set(df.columns)
    out: list[str] = []
    for c in wanted:
        if c and c in have and c not in out:
            out.append(c)
    return df.select(*out)


def as_int_key(c: str | Column) -> Column:
    """Join-key cast that turns unparsable text into null instead of failing."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("int")


def as_number(df: DataFrame, c: str) -> Column:
    """Column ``c`` for comparison with numbers: text is cast, and text that
    is no number becomes null instead of failing the job; others unchanged."""
    col = F.col(c)
    return col.try_cast("double") if isinstance(df.schema[c].dataType, StringType) else col


def not_nan(df: DataFrame, c: str) -> Column:
    """Column ``c`` with NaN as null (floating-point columns only): a missing
    value, as everywhere in the library."""
    col = F.col(c)
    kind = df.schema[c].dataType
    return F.nanvl(col, F.lit(None).cast(kind)) if isinstance(kind, (DoubleType, FloatType)) else col


def internal(name: str, columns: Iterable[str]) -> str:
    """``name``, lengthened until no column has it."""
    taken = set(columns)
    while name in taken:
        name = "_" + name
    return name


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls with 0 in the given (value) columns only."""
    return df.fillna(0, subset=list(columns)) if columns else df
