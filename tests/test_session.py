from pyspark.sql import functions as F

from plotmill.session import broadcast_if_small, cut_lineage, spread


def test_lineage_is_cut_to_shared_storage(spark):
    df = cut_lineage(spark.range(5).withColumn("x", F.col("id") * 2))
    assert "Range" not in df._jdf.queryExecution().toString() and df.agg(F.sum("x")).first()[0] == 20


def test_broadcast_only_after_a_count(spark):
    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(broadcast_if_small(spark.range(10), 10)) and not hinted(broadcast_if_small(spark.range(11), 10))
    wide = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert hinted(broadcast_if_small(wide)) and not hinted(broadcast_if_small(wide, most_bytes=50_000))


def test_spread(spark):
    small = spark.range(0, 1, 1, 1)
    assert spread(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and spread(small, 0).rdd.getNumPartitions() == 1
