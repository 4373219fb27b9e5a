"""How the rearranged copy of the fingerprint query is dealt to tasks."""

from pyspark.sql import functions as F

from panelloom.workloads import registry


def test_rearranged_rows_are_dealt_by_their_size(spark):
    """It was seven tasks, however many rows there were."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "64k")
    try:
        rows = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"))
        dealt = registry.rearranged(rows).withColumn("p", F.spark_partition_id())
        assert dealt.columns == ["t", "id", "p"]
        assert len(dealt.groupBy("p").agg(F.max("t"), F.max("id")).collect()) > 7 and dealt.distinct().count() == 200_000
    finally:
        spark.conf.set(name, before)
