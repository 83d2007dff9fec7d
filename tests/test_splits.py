"""Splits, folds and the dense index."""

import math

import pytest
from pyspark.sql import functions as F

from panelforge.operators import splits as sp


def test_random_split_stable_under_repartition(spark):
    df = spark.range(5000).withColumnRenamed("id", "entity").withColumn("period", F.lit(202001))
    a = sp.random_split(df, ["entity", "period"]).where("split = 'test'")
    b = sp.random_split(df.repartition(13), ["entity", "period"]).where("split = 'test'")
    assert a.count() == b.count() and a.join(b, ["entity"], "left_anti").count() == 0
    assert a.count() == 1000


@pytest.mark.parametrize("n,share,method", [(0, 0.2, "md5"), (1, 0.2, "md5"), (7, 0.2, "xxhash64"), (4999, 0.2, "md5"), (503, 0.35, "xxhash64"), (10, 1.0, "md5"), (10, 0.0, "md5")])
def test_random_split_takes_the_smallest_hashes(spark, n, share, method):
    df = spark.range(n).selectExpr("id % 50 entity", "cast(id as int) period")
    rows = sp.random_split(df, ["entity", "period"], test_share=share, method=method).withColumn("h", sp.key_hash(["entity", "period"], 42, method)).collect()
    k = math.ceil(share * n)
    assert sorted(r.h for r in rows if r.split == "test") == sorted(r.h for r in rows)[:k] and len(rows) == n
    assert all(0 <= r.h < 1 << sp.HASH_BITS for r in rows)


def test_random_split_breaks_ties_by_key(spark, monkeypatch):
    monkeypatch.setattr(sp, "key_hash", lambda keys, *a: (F.col("entity") % 3).cast("long"))
    df = spark.range(90).selectExpr("id entity", "if(id = 45, null, 1) period").repartition(4)
    test = sorted(r.entity for r in sp.random_split(df, ["entity", "period"], test_share=0.5).where("split = 'test'").collect())
    assert test == sorted([*range(0, 90, 3), *range(1, 46, 3)])
    twice = df.unionAll(df)
    assert sp.random_split(twice, ["entity", "period"], test_share=0.5).where("split = 'test'").count() == 90
    assert sp.random_split(df.withColumn("period", F.lit(None).cast("int")), ["entity", "period"], test_share=0.5).where("split = 'test'").count() == 45


def test_chronological_split_prospective(spark):
    df = spark.createDataFrame([(199912,), (200001,), (200112,), (200201,)], "target_month int")
    got = [r["split"] for r in sp.chronological_split(df).orderBy("target_month").collect()]
    assert got == ["train", "val", "test", "prospective"]


def test_walk_forward_folds_ordered(spark):
    months = [y * 100 + m for y in range(1996, 2000) for m in range(1, 13)]
    df = spark.createDataFrame([(m,) for m in months], "target_month int")
    bounds = sp.fold_bounds(sp.walk_forward_folds(df)).orderBy("fold").collect()
    assert len(bounds) == 5 and all(r["ordered"] for r in bounds)
    assert [r["n_val"] for r in bounds] == [6, 6, 6, 6, 12]


def test_dense_index_and_kfold_sizes(spark):
    df = spark.range(103).select((F.col("id") * 7 % 103).alias("k"))
    idx = sp.dense_index(df, ["k"], num_partitions=5).collect()
    assert sorted((r["k"], r["row_index"]) for r in idx) == [(i, i) for i in range(103)]
    folds = sp.kfold(df, ["k"], k=5).groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in folds] == [21, 21, 21, 20, 20]
