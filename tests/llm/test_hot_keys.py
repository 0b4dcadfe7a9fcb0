import pytest

from galena.llm import blocks
from pyspark.sql import functions as F


def test_blocks_stay_off_the_driver(spark, monkeypatch):
    """No row of the blocks is collected: what joins them costs the driver a count, however many there are."""

    def refused(*_):
        raise AssertionError("rows in the driver's Python")

    words = spark.range(3000).select(F.col("id").alias("f"), F.lit(0).alias("pos"), F.lit(True).alias("long"), F.lit("A").alias("first"), F.col("id").alias("key"), F.lit(9.0).alias("weight"), F.lit(True).alias("own"))
    second = words.withColumns({"pos": F.lit(1), "key": F.col("f") + 10_000})
    short = words.select(F.xxhash64(F.lit("initial"), "key", "first").alias("block"))
    a = spark.range(400).select((F.col("id") % 3).alias("k"), F.col("id").alias("a"))
    for name in ("collect", "toPandas", "toArrow", "toLocalIterator"):
        monkeypatch.setattr(type(words), name, refused)
    met = blocks.spelled(words.unionByName(second), 1.0, short)
    pairs = blocks.rows_that_meet(a, a.withColumnRenamed("a", "b"), ["k"], 20)
    assert met.count() == 3000 and pairs.count() == 134 * 134 + 2 * 133 * 133


@pytest.mark.parametrize("few", [0, 10_000])
def test_many_hot_keys_lose_no_pair(spark, monkeypatch, few):
    monkeypatch.setattr(blocks, "FEW_HOT", few)
    a = spark.range(200).select((F.col("id") % 4).alias("k"), F.col("id").alias("a"))
    b = a.withColumnRenamed("a", "b")
    got = sorted(map(tuple, blocks.rows_that_meet(a, b, ["k"], 9).select("a", "b").collect()))
    assert got == sorted(map(tuple, a.join(b, "k").select("a", "b").collect()))
