"""Inputs are built in tasks of bounded size."""

from pyspark.sql import functions as F

from orderflow.catalog import fixtures


def test_inputs_are_cut_by_rows(spark, tmp_path, monkeypatch):
    spark.range(1000).select(F.col("id").alias("o_orderkey")).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(fixtures, "TASK_ROWS", 20)
    table = fixtures.Inputs(spark, str(tmp_path)).order_table
    assert table.rdd.getNumPartitions() >= 50 and table.distinct().count() == 1000
