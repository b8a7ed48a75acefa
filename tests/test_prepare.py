import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tabloom.operators import encode, impute, power, profile, scale
from tabloom.operators.preprocess import TabularPreprocessor
from tabloom.operators.transformers import FunctionTransformer, register_function
from tabloom.streaming.score import score_stream


@pytest.fixture(scope="module")
def people(spark):
    rows = [(i, float(i % 40) if i % 9 else None, ["red", "blue", "green"][i % 3] if i % 5 else None, i % 2 == 0, "low" if i % 4 else "high") for i in range(200)]
    return spark.createDataFrame(rows, "id long, age double, colour string, member boolean, risk string")


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    assert impute.learn_mode(df, ["s"]) == {"s": "a"}


def test_constant_columns_do_not_divide_by_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    for s in ("standard", "robust", "min_max_scaler"):
        assert [r["x"] for r in scale.scale(df, s, ["x"]).collect()] == [0.0, 0.0]
    with pytest.raises(ValueError):
        scale.scale(df, "unknown", ["x"])


def test_yeo_johnson_lambda_maximises_likelihood(spark):
    rng = np.random.default_rng(1)
    x = np.exp(rng.normal(size=400)) - 0.5
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = power.fit_lambdas(df, "yeo_johnson", {"x": F.col("x")}, digits=2)["x"]

    def loglik(l):
        y = np.where(x >= 0, ((x + 1) ** l - 1) / l if l else np.log1p(x), -((1 - np.minimum(x, 0)) ** (2 - l) - 1) / (2 - l))
        return -len(x) / 2 * np.log(y.var()) + (l - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()

    grid = [round(-3 + 0.01 * i, 2) for i in range(601) if round(-3 + 0.01 * i, 2) not in (0.0, 2.0)]
    assert lam == pytest.approx(max(grid, key=loglik), abs=0.011)


def test_box_cox_rejects_zero(spark):
    with pytest.raises(ValueError):
        power.fit_lambdas(spark.createDataFrame([(0.0,), (1.0,)], "x double"), "box_cox", {"x": F.col("x")})


def test_unseen_categories(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    values = encode.categories(train, ["c"])["c"]
    new = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    got = new.select(encode.code_expr(F.col("c"), values), *encode.onehot_exprs(F.col("c"), "c", values).values()).collect()
    assert [tuple(r) for r in got] == [(0, 1, 0), (-1, 0, 0), (-1, 0, 0)]


def test_large_category_set_gets_sparse_vector(spark, monkeypatch):
    df = spark.range(30).select(F.concat(F.lit("k"), "id").alias("c"))
    monkeypatch.setattr(encode, "categories", lambda *_a, **_k: {"c": None})
    out = encode.onehot(df, "c")
    assert out.select("c_onehot").first()[0].size == 30
    codes = {r["c"]: r["c_code"] for r in encode.ordinal(df, "c").collect()}
    assert sorted(codes, key=codes.get) == sorted(codes)


def test_out_of_fold_target_ignores_own_fold(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 0.0), ("a", 1, 1.0), ("b", 0, 1.0)], "c string, fold int, y double")
    got = {(r["c"], r["fold"]): r["c_target"] for r in encode.target_oof(df, "c", "y").collect()}
    assert got == {("a", 0): 0.5, ("a", 1): 1.0, ("b", 0): 0.75}


def test_preprocessor_shapes_persists_and_streams(spark, people, tmp_path):
    prep = TabularPreprocessor(inputCols=["age", "colour", "member", "risk"], keepCols=["id"], outputCol="features")
    model = Pipeline(stages=[prep]).fit(people)
    names = model.stages[0].feature_names
    assert names == ["age", "colour_blue", "colour_green", "colour_red", "member", "risk"]
    want = model.transform(people).select("id", *names).orderBy("id").collect()
    assert all(v is not None for r in want for v in r)
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert again.transform(people).select("id", *names).orderBy("id").collect() == want
    people.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(people.schema).parquet(str(tmp_path / "in"))
    q = score_stream(again, stream, str(tmp_path / "out"), str(tmp_path / "ck"), ["id", *names])
    assert q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect() == want


def test_nothing_left_is_an_error(spark):
    df = spark.range(50).select("id")
    with pytest.raises(ValueError):
        TabularPreprocessor(inputCols=["id"]).fit(df)


def test_function_transformer(spark):
    register_function("double", lambda c: c * 2)
    out = FunctionTransformer(inputCols=["x"], function="double").transform(spark.createDataFrame([(2.0,)], "x double"))
    assert out.first()["x"] == 4.0


def test_iterative_imputation_recovers_a_line(spark):
    df = spark.range(100).select("id", F.col("id").cast("double").alias("a"), F.when(F.col("id") % 4 > 0, F.col("id") * 2.0 + 1).alias("b"))
    got = {r["id"]: r["b"] for r in impute.impute_iterative(df, ["b"], ["a"], ["id"], rounds=1).collect()}
    assert got == pytest.approx({i: 2.0 * i + 1 for i in range(100)}, abs=1e-6)


def test_learned_tables_give_what_literals_give(spark, tmp_path, monkeypatch):
    rows = [(i, f"k.{i % 23:02d}", ["low", "medium", "high", "extra high"][i % 4] if i % 7 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, code string, risk string")
    new = df.unionAll(spark.createDataFrame([(900, "unseen", "unseen"), (901, None, None)], df.schema))
    cols = ["code", "risk"]

    def fitted(encodings, out):
        prep = TabularPreprocessor(inputCols=cols, keepCols=["id"], encodings=encodings, outputCol=out)
        return Pipeline(stages=[prep]).fit(df)

    def rows_of(model, *names):
        return model.transform(new).select("id", *names).orderBy("id").collect()

    literal = {e: fitted(e, "features") for e in ("onehot", "declared")}
    wide = rows_of(fitted("onehot", ""), *[f"`{n}`" for n in literal["onehot"].stages[0].feature_names])
    want = {e: [r["features"].toArray().tolist() for r in rows_of(m, "features")] for e, m in literal.items()}
    monkeypatch.setattr(encode, "LITERAL_CATEGORIES", 3)
    monkeypatch.setattr(profile, "ORDER_ARRAY_LIMIT", 1)
    for e, m in literal.items():
        table = fitted(e, "features")
        assert any("table" in s for s in table.stages[0].steps)
        assert table.stages[0].feature_names == m.stages[0].feature_names
        table.write().save(str(tmp_path / e))
        again = PipelineModel.load(str(tmp_path / e))
        assert str(tmp_path) in next(s["table"] for s in again.stages[0].steps if "table" in s)
        assert [r["features"].toArray().tolist() for r in rows_of(again, "features")] == want[e]
    assert rows_of(fitted("onehot", ""), *[f"`{n}`" for n in literal["onehot"].stages[0].feature_names]) == wide


def test_more_categories_than_literals_stay_apart(spark):
    df = spark.range(3003).select("id", F.format_string("k%04d", F.col("id") % 1001).alias("c"))
    model = TabularPreprocessor(inputCols=["c"], keepCols=["id"], outputCol="v").fit(df)
    got = {r["id"]: r["v"] for r in model.transform(df).collect()}
    assert {v.size for v in got.values()} == {1001}
    assert all(v.toArray().nonzero()[0].tolist() == [i % 1001] for i, v in got.items())
