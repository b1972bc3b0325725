"""Quality rules: a threshold table compiled into Spark projections.

The main path is DataFrame functions only. :func:`measures` derives the
counts of one text, :data:`RULES` states lower and upper bounds of ratios
over them, and :func:`compile_rules` turns such a table into one boolean
column. Nothing is shuffled: every row is judged on its own text. Repeated
windows of words are told by 64-bit digests that nothing confirms: two different
windows of one text share one with a chance of n^2 / 2^65 for n windows.

A very long text is judged whole, in the row's own arrays: some six of them, of
a word, a line or a window each, so a row takes a few times its text in memory.
Defined results: a null or empty text has zero words, so every count is 0
and the minimum word count rejects it. Repeated rows are judged alike and
both returned. Extra columns of the input, whatever their names, are passed
through by :func:`keep_good` and ignored by :func:`judge`. An empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates words, symbol characters, window width.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

#: A share of stop words says something from so many words on.
SHARE_WORDS = 30

# Frequent function words of the four languages served.
STOP_WORDS = (
    "a an and are as at be by de der die das den des du el en er es et ist "
    "for from he in is it its la las le les los mit nicht no nous of on or "
    "ou par pas plus pour que qui se sich sie sur that the this to un und "
    "una une von was wer with y zu"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep a text while ``low <= measure <= high`` (an absent bound is open).
    A null measure (such as a ratio over nothing) passes."""

    measure: str
    low: float | None = None
    high: float | None = None


#: The operator's own thresholds, on top of the base rules of the contract.
RULES = (
    Rule("n_words", 10, None),
    Rule("mean_word_chars", 2.0, 20.0),
    Rule("symbols_per_word", None, 0.25),
    Rule("stop_word_share", 0.02, None),  # null, so passed, below SHARE_WORDS words
    Rule("dup_line_share", None, 0.5),
    Rule("repeat_word_share", None, 0.2),
)


def measures(text: Column, frame: DataFrame) -> DataFrame:
    """``frame`` plus one struct column ``__m`` holding the measures of
    ``text``. The steps are stacked projections: each array is built once
    and read by the next step from its own column."""
    body = F.coalesce(text.cast("string"), F.lit(""))
    words = F.array_remove(F.split(body, SPACE_CLASS), "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD_CLASS))
    step = frame.withColumns({"__w": words, "__l": lines, "__b": body})

    def digest(i: Column) -> Column:
        return F.xxhash64(*[F.get(F.col("__w"), i + k) for k in range(WINDOW)])

    n = F.size("__w")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), digest))
    step = step.withColumn("__h", windows)
    # Only a text with a repeated window needs their places.
    ordered = F.when(
        F.size("__h") > F.size(F.array_distinct("__h")),
        F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    step = step.withColumn("__s", ordered)
    repeated = F.filter("__s", lambda e, k: (
        e["h"].eqNullSafe(F.get(F.col("__s"), k - 1)["h"])
        | e["h"].eqNullSafe(F.get(F.col("__s"), k + 1)["h"])))
    step = step.withColumn("__p", F.sort_array(F.transform(repeated, lambda e: e["i"])))
    # least() skips the null before the first start, which so counts in full.
    covered = F.aggregate(
        F.transform("__p", lambda p, j: F.least(F.lit(WINDOW), p - F.get(F.col("__p"), j - 1))),
        F.lit(0).cast("long"), lambda total, x: total + x)
    step = step.withColumn("__c", F.struct(
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.regexp_count("__b", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size("__l").cast("long").alias("n_lines"),
        F.size(F.filter("__w", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    ))
    c = F.col("__c")
    share = lambda a, b: F.try_divide(c[a].cast("double"), c[b].cast("double"))
    # explode() of one struct, not a plain projection: the optimizer would push
    # a filter on the measures through projections, and so repeat their work.
    step = step.withColumn("__m", F.explode(F.array(F.struct(
        c["n_words"], c["word_chars"], c["n_symbols"], c["n_dup_lines"], c["n_repeat_words"],
        c["n_lines"], c["n_stop_words"],
        share("word_chars", "n_words").alias("mean_word_chars"),
        share("n_symbols", "n_words").alias("symbols_per_word"),
        F.when(c["n_words"] >= SHARE_WORDS, share("n_stop_words", "n_words")).alias("stop_word_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_word_share"),
    ))))
    return step.drop("__w", "__l", "__b", "__h", "__s", "__p", "__c")


def compile_rules(rules: tuple[Rule, ...], m: Column) -> Column:
    """The threshold table as one boolean column over the measures ``m``."""
    verdict = F.lit(True)
    for r in rules:
        value = m[r.measure]
        if r.low is not None:
            verdict = verdict & F.coalesce(value >= F.lit(r.low), F.lit(True))
        if r.high is not None:
            verdict = verdict & F.coalesce(value <= F.lit(r.high), F.lit(True))
    return verdict


def base_failed(m: Column) -> Column:
    """Fewer than ten words, or over a fifth of them in repeated windows."""
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: ``id_col``, the measures, ``base_failed`` and
    ``kept``."""
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
    m = F.col("__m")
    return (measures(F.col("__t"), rows)
            .withColumn("__f", base_failed(m))
            .select(F.col("__id").alias(id_col), "__m.*", F.col("__f").alias("base_failed"),
                    (~F.col("__f") & compile_rules(rules, m)).alias("kept")))


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they were."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    m = F.col("__m")
    return (measures(F.col("__row")[text_col], row)
            .where(~base_failed(m) & compile_rules(rules, m))
            .select("__row.*"))
