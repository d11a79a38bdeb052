from pyspark.sql import functions as F

from tesselex.plans import lineage


def test_written_and_cleaned(spark):
    df = lineage.written(spark.range(5).withColumn("x", F.lit("a")), "t")
    assert df.count() == 5 and df.columns == ["id", "x"]
    assert lineage.written(spark.range(5).where("false"), "t").count() == 0
    assert lineage.clean(spark) >= 2 and lineage.clean(spark) == 0
    assert lineage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
