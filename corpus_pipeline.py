"""Corpus pipeline: quality rules, near-duplicates, personal data, packing.

``STAGES`` lists (name, function) pairs; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame that is written as Parquet and read again
as the next one's ``docs``. All but the last return the columns of the input
documents. ``run`` applies them to the ``documents`` table.

Rows with null columns, empty texts, repeated rows and extra columns go
through each stage as its operator defines: the quality rules reject a text
without words, a document without an id duplicates nothing, rows that share an
id are one document, and other columns are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablescope.llm import minhash_dedup, packing, pii, quality_rules
from tablescope.llm.runtime import show_workers
from tablescope.llm.skew import split_by_keys
from tablescope.session import materialize, materialize_observed


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 80 % of shared five-word shingles, the document
    with the smallest id stays."""
    show_workers(spark)
    found = minhash_dedup.near_duplicates(docs, words=5, percent=80)
    gone, seen = materialize_observed(found.where("not kept").select("doc_id").distinct(), n=F.count(F.lit(1)))
    # Texts move only if a filter says that their document may go.
    maybe, stay = split_by_keys(docs, gone, "doc_id", seen["n"])
    return stay.unionByName(maybe.join(gone, "doc_id", "left_anti"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    show_workers(spark)
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens, packed into sequences of at most 2048."""
    show_workers(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), special=True)


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("personal data", personal_data_stage),
    ("best-fit packing", packing_stage),
]

#: The later stages (similarity classes, a sequence tagger, packing) have no
#: SQL form; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = show_workers(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
