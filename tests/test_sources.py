import pytest
from pyspark.sql import functions as F

from tabloom.sources import tables as src


def test_ratio_boundaries():
    assert [src.test_ratio(n) for n in (100, 1000, 1001, 2000)] == [0.1, 0.1, 0.2, 0.2]


def test_csv_reads_types_and_missing_tokens(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,price,name,flag\n1,2.5,ann,true\n2,NA,,false\n3,nan,N/A,true\n")
    rows = src.read_csv(spark, str(tmp_path / "t.csv")).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 2.5, "ann", True), (2, None, None, False), (3, None, None, True)]


def test_csv_with_schema_keeps_bad_cells_null(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\nq,y\n")
    rows = src.read_csv(spark, str(tmp_path / "t.csv"), "a bigint, b string").orderBy("b").collect()
    assert [tuple(r) for r in rows] == [(1, "x"), (None, "y")]


def test_missing_path(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        src.read_csv(spark, str(tmp_path / "absent.csv"))


def test_validate(spark):
    df = spark.createDataFrame([(1, 0)], "feature int, target int")
    assert src.validate(df, "target") is df
    with pytest.raises(ValueError):
        src.validate(df, "label")
    with pytest.raises(src.FileIsEmptyException):
        src.validate(df.where("feature > 5"), "target")


def test_bundle_covers_all_rows_once(spark, tmp_path):
    (tmp_path / "t.csv").write_text("feature,target\n" + "".join(f"{i},{i % 2}\n" for i in range(50)))
    b = src.load_bundle(spark, str(tmp_path / "t.csv"), "target", ["feature"])
    assert b.train.count() + b.test.count() == 50 and b.test.count() > 0
    assert b.features == []


def test_stratified_split_and_folds_are_balanced(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("y"))
    got = {(r["y"], r["split"]): r["count"] for r in src.with_stratified_split(df, "y", ["id"]).groupBy("y", "split").count().collect()}
    assert got[("a", "test")] == int(0.2 * 335) and got[("b", "test")] == int(0.2 * 668)
    sizes = src.with_folds(df, 5, ["id"], "y").groupBy("y", "fold").count().collect()
    for y in ("a", "b"):
        counts = [r["count"] for r in sizes if r["y"] == y]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(200)
    one = {r["id"] for r in src.with_split(df.coalesce(1), ["id"]).where("split = 'test'").collect()}
    many = {r["id"] for r in src.with_split(df.repartition(7), ["id"]).where("split = 'test'").collect()}
    assert one == many


def test_nan_is_missing(spark):
    df = src.normalise_nan(spark.createDataFrame([(float("nan"),), (1.0,)], "x double"))
    assert df.where("x is null").count() == 1


def test_quoted_line_breaks_stay_in_their_cell(spark, tmp_path):
    from tabloom.sources.tables import read_csv

    (tmp_path / "a.csv").write_text('n,t\n1,"x\ny"\n2,"he said ""z"""\n')
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "a.csv")).orderBy("n").collect()] == [(1, "x\ny"), (2, 'he said "z"')]


def test_more_classes_than_literals(spark, monkeypatch):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 40).alias("y"))

    def marks():
        split = src.with_stratified_split(df, "y", ["id"], 0.3)
        return {tuple(r) for r in src.with_folds(split, 4, ["id"], "y").select("id", "y", "split", "fold").collect()}

    want = marks()
    monkeypatch.setattr(src, "HOT_CLASSES", 3)
    assert marks() == want
