import os

from pyspark.sql import functions as F

from folioflow.session import checkpoint_dir, cut_lineage, release


def test_cut_tables_keep_rows_and_types_and_can_be_released(spark):
    df = spark.range(10).select("id", F.array(F.struct(F.col("id").cast("string").alias("s"))).alias("a"), F.lit(None).cast("map<string,int>").alias("m"))
    cut = cut_lineage(df)
    assert cut.dtypes == df.dtypes and sorted(cut.collect()) == sorted(df.collect())
    folder = cut._cut_folder.removeprefix("file:")
    assert folder.startswith(checkpoint_dir(spark).removeprefix("file:")) and os.path.isdir(folder)
    release(cut, None, df)
    assert not os.path.exists(folder)


def test_an_empty_frame_can_be_cut(spark):
    cut = cut_lineage(spark.range(0).select("id", F.lit("x").alias("t")))
    assert cut.count() == 0 and cut.columns == ["id", "t"]
