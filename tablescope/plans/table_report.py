"""Generic table report: clean a table, then summary, monthly series, top-N
and the cleaned rows, each a DataFrame over the cleaned table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescope.operators.aggregate import compute_summary, compute_time_series
from tablescope.operators.quality import clean_dataframe
from tablescope.operators.ranking import compute_top_n
from tablescope.session import materialize, scratch

# Fixed value: rows of the top-N output.
TOP_N = 20

OUTPUTS = ("summary", "time_series", "top_n", "cleaned")


def row_sample(df: DataFrame, fraction: float) -> DataFrame:
    """A uniform sample by row hash: the same rows each time, equal rows alike."""
    bits = 20
    key = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(1 << bits))
    return df.filter(key < int(fraction * (1 << bits)))


def table_report(df: DataFrame, *, category_col: str | None = None,
                 date_col: str | None = None, top_col: str | None = None,
                 top_n: int = TOP_N, sample_fraction: float | None = None,
                 outputs: tuple[str, ...] = OUTPUTS, write_cleaned: bool | None = None,
                 by_digest: bool = False) -> dict[str, DataFrame]:
    """Outputs keyed ``summary``, ``time_series`` (when ``date_col`` is
    given or a ``date`` column exists), ``top_n`` and ``cleaned``; only those
    named in ``outputs`` are built. ``cleaned`` is every cleaned row, or a
    uniform sample of them if ``sample_fraction`` is given.

    The cleaned table costs a de-duplicating shuffle of the whole input (of
    digests with ``by_digest``, see :func:`quality.drop_duplicate_rows`), so
    where two or more outputs read it, it is written once as a Parquet table in
    the checkpoint folder, from which every output reads its columns;
    ``write_cleaned`` says so either way, and without it each output cleans anew.
    """
    cleaned = clean_dataframe(df, by_digest)
    if len(outputs) > 1 if write_cleaned is None else write_cleaned:
        cleaned = materialize(cleaned)
    out = {}
    if "summary" in outputs:
        out["summary"] = compute_summary(cleaned, category_col)
    date_col = date_col or ("date" if "date" in cleaned.columns else None)
    if date_col and "time_series" in outputs:
        out["time_series"] = compute_time_series(cleaned, date_col)
    if "top_n" in outputs:
        out["top_n"] = compute_top_n(cleaned, top_n, top_col, tiebreak=cleaned.columns)
    if "cleaned" in outputs:
        out["cleaned"] = cleaned if sample_fraction is None else row_sample(cleaned, sample_fraction)
    return out


def run_table_report(df: DataFrame, out_dir: str, fmt: str = "parquet", *,
                     parallel: int = 4, **options) -> dict[str, int]:
    """Clean ``df`` once, write every output of :func:`table_report` under
    ``out_dir`` (one directory each, up to ``parallel`` at once) and return
    rows written per output. The cleaned table in the checkpoint folder is
    deleted when the run ends. ``options`` go to :func:`table_report`."""
    from tablescope.sources.sinks import write_results

    with scratch(df.sparkSession):
        return write_results(table_report(df, **options), out_dir, fmt, parallel=parallel)
