"""Rules that hold for the whole subpackage."""

import pathlib
import re

import corpus_pipeline
from tablescope.llm import queries

SOURCES = sorted((pathlib.Path(queries.__file__).parent).glob("*.py")) + [pathlib.Path(corpus_pipeline.__file__)]
#: What reaches the driver is bounded: lengths up to the sequence size, and
#: (state, feature value) pairs, the buckets of bitmaps of bounded size, names
#: of files of many items, and where shards of many documents begin.
BOUNDED = {"packing.py": ["histogram = {"], "chat.py": ["found = counts.groupBy"],
           "minhash_dedup.py": ["buckets = parts.collect"], "lexical.py": ["buckets = parts.collect", "tiles = written.orderBy"],
           "token_store.py": ["bounds = order.collect"]}


def test_only_bounded_rows_reach_the_driver():
    for f in SOURCES:
        for line in f.read_text().split("\n"):
            if ".collect()" in line or ".toPandas(" in line:
                assert any(line.strip().startswith(x) for x in BOUNDED.get(f.name, [])), (f.name, line)


def test_no_lost_lineage_cross_joins_or_rdds():
    for f in SOURCES:
        text = f.read_text()
        for bad in ("localCheckpoint", "crossJoin", ".rdd", "except ImportError", "except ModuleNotFoundError", "mkdtemp",
                    ".limit(", ".sample("):
            assert bad not in text, (f.name, bad)


def test_every_operator_has_its_query():
    numbers = {int(re.match(r"op(\d+)_", k).group(1)) for k in queries.QUERIES}
    assert numbers == set(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
