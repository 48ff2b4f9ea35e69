from pyspark.sql import functions as F

from scorewatch.plans import staging


def test_kept_tables_have_few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        tables = [spark.range(100).groupBy((F.col("id") % 7).alias("k")).count() for _ in range(2)]
        kept = [staging.kept(t) for t in tables]
        both = kept[0].unionByName(kept[1])
        assert both.count() == 14
        assert both.rdd.getNumPartitions() <= 2 * staging.KEPT_PARTITIONS
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        for t in kept:
            t.unpersist()
