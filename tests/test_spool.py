"""Typing while reading: one pass over the text, values as they were."""

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablescope.sources import spool as S
from tablescope.sources.files import NA_SPELLINGS, infer_text_types, null_spellings, read_explorer_csv


def csv(folder, name, lines):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("csv"), plan.count("parquet")


def test_types_by_values(spark, tmp_out):
    path = csv(tmp_out, "x.csv", ["w,d,b,t,none,mixed,big", "1,1.5,True,a,,1,9223372036854775808", "-7,2,False,b,NA,x,1",
                                  "NA,n/a,null,NaN,NaN,True,2", "+3,1e3,True,007,,2.50,3"])
    df = read_explorer_csv(spark, path)
    assert df.schema.simpleString() == ("struct<w:bigint,d:double,b:boolean,t:string,none:double,mixed:string,big:double>")
    assert [tuple(r) for r in df.orderBy(F.col("w").asc_nulls_first()).collect()] == [
        (None, None, None, None, None, "True", 2.0), (-7, 2.0, False, "b", None, "x", 1.0),
        (1, 1.5, True, "a", None, "1", 9223372036854775808.0), (3, 1000.0, True, "007", None, "2.50", 3.0)]


def test_the_text_is_read_once(spark, tmp_out):
    path = csv(tmp_out, "x.csv", ["k,v", *[f"{i},{i / 4}" for i in range(1000)]])
    df = read_explorer_csv(spark, path)
    os.remove(path)  # no later query reads it
    assert scans(df) == (0, 1)
    found = df.where("k between 10 and 19").select("v")
    assert found.count() == 10
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(w0), GreaterThanOrEqual(w0,10)" in plan and "t0" not in plan.split("ReadSchema")[-1]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.sampled_from(["1", "-2", " 3", "+4", "0.5", "1e5", "5.", ".5", "inf", "-Infinity", "True", "False",
                                             "true", "007", "1.0", "1.50", "12d", "0x1F", "1e400", "99999999999999999999", "-0",
                                             "-0.0", "1_000", "NA", None, "", "text"])] * 3), min_size=1, max_size=6))
def test_equals_typing_by_two_passes(spark, rows):
    """Any mix of values: the same types and values as counting first, then casting."""
    df = null_spellings(spark.createDataFrame(rows, "a string, b string, c string"))
    once, twice = S.spool_text(df), infer_text_types(df)
    assert once.schema.simpleString() == twice.schema.simpleString()
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_every_spelling_of_missing(spark):
    rows = [(x, "1") for x in NA_SPELLINGS if x] + [("2", None), (None, "2")]
    df = S.spool_text(null_spellings(spark.createDataFrame(rows, "a string, b string")))
    assert df.schema.simpleString() == "struct<a:bigint,b:bigint>"
    assert df.agg(F.count("a"), F.count("b")).first() == (1, len(rows) - 1)


def test_a_spool_for_later_sessions(spark, tmp_out, monkeypatch):
    path, folder = csv(tmp_out, "x.csv", ["k,v", "1,a", "2,b"]), f"{tmp_out}/spool"
    assert read_explorer_csv(spark, path, spool=folder).count() == 2
    made = []
    monkeypatch.setattr(S, "publish", lambda *a, **k: made.append(a))
    again = read_explorer_csv(spark, path, spool=folder)  # the file is the same: nothing is parsed
    assert not made and again.schema.simpleString() == "struct<k:bigint,v:string>" and scans(again) == (0, 1)
    monkeypatch.undo()
    csv(tmp_out, "x.csv", ["k,v", "1,a", "2,b", "x,c"])
    changed = read_explorer_csv(spark, path, spool=folder)
    assert changed.schema.simpleString() == "struct<k:string,v:string>" and changed.count() == 3
    assert S.open_spool(spark, folder).count() == 3
    with pytest.raises(FileNotFoundError):
        S.open_spool(spark, tmp_out + "/nothing")


def test_few_rows(spark, tmp_out):
    empty = read_explorer_csv(spark, csv(tmp_out, "e.csv", ["a,b"]))
    assert empty.count() == 0 and empty.schema.simpleString() == "struct<a:double,b:double>"
    numbers = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert S.spool_text(numbers) is numbers
    odd = S.spool_text(spark.createDataFrame([("1", 5)], "`a.b ``c` string, n int"))
    assert odd.columns == ["a.b `c", "n"] and odd.first() == (1, 5)
