from pyspark.sql import functions as F

from starloom.sources import partitions


def _room(spark, path):
    path = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def test_digests_of_a_partitioned_table_take_half_their_digits(spark, tmp_path):
    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), (F.col("id") % 2).alias("part"))
    partitions.create(rows, "zstd_parts", str(tmp_path), ["part"])
    try:
        partitions.replace(rows.where("part = 1"), "zstd_parts", str(tmp_path), [{"part": 1}])
        assert sorted(r["key"] for r in spark.table("zstd_parts").collect()) == sorted(r["key"] for r in rows.collect())
        # three times 10,000 keys lie there: now, and one partition as it was before
        assert _room(spark, tmp_path) < 30_000 * 45
    finally:
        spark.sql("DROP TABLE zstd_parts")
