import pytest

from toxiscope.operators import balance
from toxiscope.session import checkpoint_dir, cut_lineage, drop_path, path_exists, scratch_path, size_by_bytes, spread


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_checkpoint_folder_from_session(spark):
    d = checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(d.rstrip("/") + "/toxiscope/x-")
    df = cut_lineage(spark.range(10))
    assert df.count() == 10 and "ExistingRDD" in _plan(df)


def test_spread(spark):
    one = spark.range(0, 1000, numPartitions=1).withColumnRenamed("id", "doc_id")
    s = spread(one, "doc_id")
    assert "hashpartitioning(doc_id" in _plan(s) and s.count() == 1000
    many = spark.range(0, 1000, numPartitions=64)
    assert spread(many, "id") is many


def test_rebalance_entry_point(spark):
    df = spark.createDataFrame([(i, int(i < 10)) for i in range(100)], "doc_id long, toxic int")
    w = balance.rebalance(df, "toxic", "doc_id", "weight")
    assert balance.WEIGHT_COL in w.columns
    over = balance.rebalance(df, "toxic", "doc_id", "oversample")
    assert over.where("toxic = 1").count() == 90 and over.where("toxic = 0").count() == 90
    under = balance.rebalance(df, "toxic", "doc_id", "undersample")
    assert under.where("toxic = 1").count() == 10 and under.where("toxic = 0").count() < 40
    assert balance.rebalance(df, "toxic", "doc_id", "none") is df
    with pytest.raises(ValueError):
        balance.rebalance(df, "toxic", "doc_id", "bogus")


def test_scratch_folders_can_be_dropped(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert path_exists(spark, path)
    drop_path(spark, path)
    assert not path_exists(spark, path)


def test_size_by_bytes_follows_bytes_not_rows(spark):
    tiny = cut_lineage(spark.range(0, 1000, numPartitions=16))
    assert size_by_bytes(tiny).rdd.getNumPartitions() == 1
    wide = cut_lineage(spark.range(0, 64, numPartitions=64).selectExpr("id", "repeat(uuid(), 30000) AS x"))
    assert size_by_bytes(wide).rdd.getNumPartitions() >= 2
