"""CSV sources, sinks and the synthetic generator."""

import os

from pyspark.sql import functions as F

from tablescope.operators.aggregate import compute_summary
from tablescope.sources.files import read_csv, read_explorer_csv
from tablescope.sources.sinks import write_csv, write_result
from tablescope.sources.synth import CATEGORIES, REGIONS, SUB_CATEGORIES, synthetic_orders


def test_csv_round_trip_with_count(spark, tmp_out):
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "id int, s string, x double")
    assert write_csv(df, f"{tmp_out}/t") == 2
    back = read_csv(spark, f"{tmp_out}/t")
    assert back.schema.simpleString() == "struct<id:int,s:string,x:double>"
    typed = read_csv(spark, [f"{tmp_out}/t"], schema="id int, s string, x double")
    assert typed.count() == 2
    assert write_result(df, f"{tmp_out}/p", "parquet", partition_by=["s"]) == 2


def test_explorer_csv_na_spellings(spark, tmp_out):
    path = os.path.join(tmp_out, "x.csv")
    with open(path, "w") as f:
        f.write("k,v,w\nNA,1.5,NaN\nn/a,2.0,3\nreal,,null\n")
    df = read_explorer_csv(spark, path)
    assert df.schema.simpleString() == "struct<k:string,v:double,w:bigint>"
    got = sorted(((r.k or ""), r.v or 0.0, r.w or 0) for r in df.collect())
    assert got == [("", 1.5, 0), ("", 2.0, 3), ("real", 0.0, 0)]


def test_synthetic_orders_shape_and_rules(spark):
    n = 20000
    df = synthetic_orders(spark, n, seed=3, num_partitions=4)
    assert df.columns == ["order_id", "customer_id", "date", "category", "sub_category", "region",
                          "quantity", "unit_price", "revenue", "discount", "rating"]
    pd = df.toPandas()
    assert len(pd) == n and pd["order_id"].tolist() == list(range(1, n + 1))
    assert set(pd["category"]) == set(CATEGORIES)
    assert set(pd["region"].dropna()) == set(REGIONS)
    assert all(s in SUB_CATEGORIES[c] for c, s in zip(pd["category"], pd["sub_category"]))
    assert pd["quantity"].between(1, 49).all() and pd["unit_price"].between(5, 500).all()
    assert ((pd["quantity"] * pd["unit_price"]).round(2) - pd["revenue"]).abs().max() < 1e-6
    assert pd["discount"].dropna().between(0, 0.3).all() and pd["rating"].dropna().between(1, 5).all()
    assert pd["customer_id"].str.fullmatch(r"CUST-\d{4}").all()
    for c in ("rating", "discount", "region"):
        assert 0.01 < pd[c].isna().mean() < 0.03, c
    assert str(pd["date"].min()) >= "2022-01-01" and str(pd["date"].max()) <= "2024-01-01"
    # deterministic for a given seed and partitioning
    again = synthetic_orders(spark, n, seed=3, num_partitions=4).agg(F.sum("revenue")).first()[0]
    assert abs(again - pd["revenue"].sum()) < 1e-3
    # default category is the first string column (customer_id)
    assert compute_summary(df).columns[0] == "customer_id"
