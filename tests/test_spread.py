"""Rows that a scan leaves in few tasks are dealt anew, and nothing else changes."""

from pyspark.sql import functions as F

from tabloom.functions.attach import spread
from tabloom.plans import frames


def largest(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_one_row_group_is_dealt_over_tasks(spark, tmp_path):
    spark.range(4000).select("id", F.concat(F.lit("text "), F.col("id")).alias("t")).coalesce(1).write.parquet(f"{tmp_path}/one")
    df = spark.read.parquet(f"{tmp_path}/one")
    assert largest(df) == 4000
    dealt = spread(df, 100)
    assert largest(dealt) < 400
    assert sorted(dealt.collect()) == sorted(df.collect())


def test_small_and_empty_frames_stay(spark):
    df = spark.range(50).coalesce(1)
    assert spread(df, 100) is df
    assert spread(df.where("id < 0"), 100).count() == 0


def test_shares_count_characters(spark, tmp_path):
    texts = ["", "ABC def 123", "\U0001d400\U0001d400A é, .", "   ", "x" * 50 + "Y9;"]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["doc_id"]: r for r in frames.raw_doc_features(spark, str(tmp_path), False).collect()}
    for i, t in enumerate(texts):
        n = max(len(t), 1)
        assert got[i]["upper_share"] == sum("A" <= c <= "Z" for c in t) / n
        assert got[i]["digit_share"] == sum("0" <= c <= "9" for c in t) / n
        assert got[i]["space_share"] == sum(c in " \t\n" for c in t) / n
        assert got[i]["symbol_share"] == sum(not (c.isalnum() or c in " .,;:!?") for c in t) / n


def test_features_of_many_files_are_read_by_as_many_tasks_as_there_are_cores(spark, tmp_path):
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("Text "), F.col("id")).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(8).cast("long").alias("n_chars"))
    rows.repartition(30).write.parquet(f"{tmp_path}/documents.parquet")
    rows.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", 1 << 27)
    try:
        df = frames.doc_features(spark, str(tmp_path))
        assert frames.raw_doc_features(spark, str(tmp_path)).rdd.getNumPartitions() > 8
        assert df.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism and df.count() == 400
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
