"""A layout by partition: files follow the size of a value, no row is lost, nulls are a value."""

from pathlib import Path

from pyspark.sql import functions as F

from tidemark.sources import io


def test_files_follow_the_size(spark, tmp_path):
    rows = spark.range(1200).select("id", F.when(F.col("id") < 1000, 1).when(F.col("id") < 1100, 2).alias("year"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else parts as small as these share a task
    try:
        assert io.write_partitions(rows, str(tmp_path / "y"), "year", ["id"], rows_a_file=100) == 10
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = {p.name: len(list(p.glob("*.parquet"))) for p in Path(tmp_path, "y").iterdir() if p.is_dir()}
    assert files["year=2"] == files["year=__HIVE_DEFAULT_PARTITION__"] == 1 and 1 < files["year=1"] <= 10
    back = spark.read.parquet(str(tmp_path / "y"))
    assert sorted(back.columns) == ["id", "year"] and sorted(map(tuple, back.select("id", "year").collect())) == sorted(map(tuple, rows.collect()))


def test_an_empty_table(spark, tmp_path):
    assert io.write_partitions(spark.createDataFrame([], "id int, year int"), str(tmp_path / "e"), "year", ["id"]) == 1
