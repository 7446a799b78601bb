"""Orders written as XML."""

from pyspark.sql import functions as F

from orderflow.catalog import files
from orderflow.catalog.registry import QUERIES


def test_xml_is_written_compressed(spark, tmp_path, monkeypatch):
    key = F.col("id")
    spark.range(1, 61).select(key.alias("o_orderkey"), key.alias("o_custkey"), F.to_timestamp(F.lit("2024-01-05")).alias("o_orderdate"), (key * 1.5).alias("o_totalprice"),
                              F.lit("P").alias("o_orderstatus"), F.lit("2-HIGH").alias("o_orderpriority")).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(1, 9).select(key.alias("s_suppkey"), key.alias("s_nationkey")).write.parquet(str(tmp_path / "supplier.parquet"))
    folder = tmp_path / "xml"
    monkeypatch.setattr(files, "new_folder", lambda *_: str(folder))
    assert QUERIES["q_xml_roundtrip"](spark, str(tmp_path)).select("OrderId").distinct().count() == 60
    parts = [p.name for p in folder.iterdir() if p.name.startswith("part-")]
    assert parts and all(name.endswith(".gz") for name in parts)
