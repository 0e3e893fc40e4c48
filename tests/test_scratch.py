"""Intermediate results leave no exchange files behind."""

from pyspark.sql import functions as F

from runlake.session import CLEANUP, materialize


def test_exchange_files_go_with_the_write(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}
    before, setting = files(), spark.conf.get(CLEANUP)
    numbers = spark.range(1000).withColumn("k", F.col("id") % 7)
    counts = materialize(numbers.groupBy("k").count().join(numbers.repartition(5, "k"), "k"), "counts")
    assert not files() - before and spark.conf.get(CLEANUP) == setting
    assert counts.count() == 1000 and counts.filter("count NOT BETWEEN 142 AND 143").count() == 0
    kept = numbers.groupBy("k").count()
    assert kept.count() == 7 and len(kept.collect()) == 7
