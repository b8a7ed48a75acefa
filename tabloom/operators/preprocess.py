"""The whole preparation of a table as one Estimator.

``fit`` profiles the table and learns every fill, transform, scale and code.  The fitted model is a list of
literals, so ``transform`` is one projection that runs the same on batch and streaming frames.  Category sets beyond
``encode.LITERAL_CATEGORIES`` are learned tables in the shared folder instead, attached by a skew-safe join and stored
with the model; codes, frequencies and one-hot features are the same either way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.attach import attach
from tabloom.functions.running import dense_codes
from tabloom.functions.scalars import nan_to_null, trimmed_lower
from tabloom.operators import encode, impute, power, rules
from tabloom.operators.profile import column_facts, facts_frame, ident, ordinal_codes
from tabloom.operators.scale import learn_scaler, scaled
from tabloom.session import shared_folder

#: most one-hot features of one column as columns of their own; the vector in ``outputCol`` has no such bound
WIDE_COLUMNS = 20_000


class _PrepParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to prepare", TypeConverters.toListString)
    keepCols = Param(Params._dummy(), "keepCols", "columns passed through untouched", TypeConverters.toListString)
    mode = Param(Params._dummy(), "mode", "typing mode: effective or strict", TypeConverters.toString)
    encodings = Param(
        Params._dummy(), "encodings", "onehot (high-cardinality categories fall back to one-hot) or declared",
        TypeConverters.toString,
    )
    outputCol = Param(Params._dummy(), "outputCol", "assembled vector column; empty for none", TypeConverters.toString)
    plan = Param(Params._dummy(), "plan", "learned steps as JSON", TypeConverters.toString)


class TabularPreprocessor(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the preparation of ``inputCols`` from their profile."""

    @keyword_only
    def __init__(self, *, inputCols=None, keepCols=None, mode="effective", encodings="onehot", outputCol=""):
        super().__init__()
        self._setDefault(keepCols=[], mode="effective", encodings="onehot", outputCol="")
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)

    def _fit(self, df: DataFrame) -> TabularPreprocessorModel:
        steps = learn_steps(
            df, self.getOrDefault("inputCols"), self.getOrDefault("mode"), self.getOrDefault("encodings")
        )
        model = TabularPreprocessorModel()
        return model._set(
            plan=json.dumps(steps),
            keepCols=self.getOrDefault("keepCols"),
            outputCol=self.getOrDefault("outputCol"),
        )


class _TablesWriter(DefaultParamsWriter):
    """Params, and the learned tables beside them."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        for i, s in enumerate(self.instance.steps):
            if "table" in s:
                self.sparkSession.read.parquet(s["table"]).write.parquet(f"{path}/tables/{i}")


class _TablesReader(DefaultParamsReader):
    def load(self, path: str) -> TabularPreprocessorModel:
        model = super().load(path)
        steps = [{**s, "table": f"{path}/tables/{i}"} if "table" in s else s for i, s in enumerate(model.steps)]
        return model._set(plan=json.dumps(steps))


class TabularPreprocessorModel(Model, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """The learned steps.

    Without ``outputCol`` every one-hot feature is a column (an error beyond ``WIDE_COLUMNS``).  With it, the features
    of literal steps are columns too and all features, sparse for learned tables, are in the vector.
    """

    def __init__(self):
        super().__init__()
        self._setDefault(keepCols=[], outputCol="", plan="[]")

    def write(self) -> _TablesWriter:
        return _TablesWriter(self)

    @classmethod
    def read(cls) -> _TablesReader:
        return _TablesReader(cls)

    @property
    def steps(self) -> list[dict]:
        return json.loads(self.getOrDefault("plan"))

    @property
    def feature_names(self) -> list[str]:
        """Names of all features in order; as long as the feature vector, so read only on demand."""
        return [name for s in self.steps for name in step_names(s)]

    def _transform(self, df: DataFrame) -> DataFrame:
        steps, vector = self.steps, self.getOrDefault("outputCol")
        kept = [c for c in self.getOrDefault("keepCols") if c in df.columns]
        tables = {f"_t{i}": s for i, s in enumerate(steps) if "table" in s}
        plain = {n: e for s in steps if "table" not in s for n, e in step_exprs(s).items()}
        out = df.select(
            *[ident(c) for c in kept], *[e.alias(n) for n, e in plain.items()], *[_table_key(s).alias(f"{t}_key") for t, s in tables.items()]
        )
        for t, s in tables.items():
            learned = df.sparkSession.read.parquet(s["table"])
            learned = learned.select(F.col("key").alias(f"{t}_key"), F.col("value").alias(f"{t}_value"), F.col("n").alias(f"{t}_n"))
            out = attach(out, learned, [f"{t}_key"], f"{t}_n")
            if s["op"] == "onehot_table" and vector:
                out = encode.hot_vector(out, f"{t}_value", s["width"], f"{t}_hot")
        names, inputs, final = [], [], {}
        for i, s in enumerate(steps):
            if "table" in s:
                exprs = _table_exprs(s, F.col(f"_t{i}_value"), wide=not vector)
                final |= exprs
                own = list(exprs) or [f"_t{i}_hot"]
                names += list(exprs)
            else:
                own = literal_names(s)
                final |= {n: ident(n) for n in own}
                names += own
            inputs += own
        hot = [F.col(c) for c in inputs if c not in final]
        out = out.select(*[ident(c) for c in kept], *[final[n].alias(n) for n in names], *hot)
        if vector:
            # the assembler cannot read names with a dot, as in the column of a category "a.b"
            safe = {n: f"_in{j}" if "." in n else n for j, n in enumerate(inputs)}
            out = out.withColumns({a: ident(n) for n, a in safe.items() if a != n})
            assembler = VectorAssembler(inputCols=[safe[n] for n in inputs], outputCol=vector)
            out = assembler.setHandleInvalid("keep").transform(out)
            out = out.drop(*[a for n, a in safe.items() if a != n or n not in final])
        return out


# ---- the learned steps ----------------------------------------------------------------


def learn_steps(df: DataFrame, columns: Sequence[str], mode: str, encodings: str) -> list[dict]:
    facts = facts_frame(df, column_facts(df, columns))
    decided = [r.asDict() for r in rules.decide(facts, mode).collect()]
    live = [d for d in decided if d["drop_reason"] is None and d["feature_type"] not in ("datetime", "text", "identifier")]
    if not live:
        raise ValueError("no column is left to prepare")
    rows = live[0]["n"]
    scaled_cols = [d for d in live if d["scaler"]]
    plain = {d["column"] for d in live if d["feature_type"] == "numerical" and d["subtype"] in ("binary_encoded", "cyclic")}
    moded = [
        d for d in live
        if d["column"] not in plain and not d["scaler"] and d["subtype"] != "ordinal_encoded"
    ]
    modes = impute.learn_mode(df, [d["column"] for d in moded if d["n_null"]])
    coded = [d for d in live if d["column"] not in plain and not d["scaler"] and not _is_bool_number(d)]
    values = encode.categories(df, [d["column"] for d in coded if d["cardinality"] <= encode.LITERAL_CATEGORIES])
    steps = {d["column"]: _numeric_step(d) for d in scaled_cols}
    for d in live:
        c = d["column"]
        if d["scaler"]:
            continue
        if c in plain:
            steps[c] = {"column": c, "op": "pass"}
        elif _is_bool_number(d):
            steps[c] = {"column": c, "op": "bool", "fill": modes.get(c)}
        elif d["feature_type"] == "boolean":
            steps[c] = {"column": c, "op": "code", "fill": modes.get(c), "values": values[c]}
        elif d["subtype"] == "ordinal_encoded":
            steps[c] = {"column": c, "op": "code", "fill": d["q50"], "values": values[c]}
        elif d["subtype"] == "low_cardinality_count":
            steps[c] = {"column": c, "op": "onehot", "fill": modes.get(c), "values": values[c]}
        else:
            steps[c] = _categorical_step(df, d, modes.get(c), values.get(c), encodings)
    _learn_powers(df, [s for s in steps.values() if s["op"] == "scaled"])
    for s in ("standard", "robust"):
        group = [x for x in steps.values() if x["op"] == "scaled" and x["scaler"] == s]
        if group:
            for c, pair in learn_scaler(df, s, {x["column"]: _before_scaling(x) for x in group}, rows).items():
                steps[c]["center"], steps[c]["scale"] = pair
    freq = [s for s in steps.values() if s["op"] == "lookup"]
    for s in freq:
        filled = F.coalesce(ident(s["column"]), F.lit(s["fill"])) if s["fill"] is not None else ident(s["column"])
        counts = df.groupBy(filled.alias("v")).agg(F.count(F.lit(1)).alias("n")).where(F.col("v").isNotNull()).collect()
        total = sum(r["n"] for r in counts) or 1
        s["pairs"] = [[r["v"], r["n"] / total] for r in sorted(counts, key=lambda r: r["v"])]
    order = [d["column"] for d in live]
    return [steps[c] for c in order]


def _is_bool_number(d: dict) -> bool:
    return d["feature_type"] == "boolean" and d["kind"] in ("int", "float", "bool")


def _numeric_step(d: dict) -> dict:
    fill = {"mean": d["mean"], "median": d["q50"]}[d["imputer"]]
    return {
        "column": d["column"],
        "op": "scaled",
        "fill": fill,
        "transform": d["transformation"],
        "scaler": d["scaler"],
        "lambda": None,
        "zc": 0.0,
        "zs": 1.0,
        "center": 0.0,
        "scale": 1.0,
    }


def _categorical_step(df: DataFrame, d: dict, fill, values: list | None, encodings: str) -> dict:
    c, wanted = d["column"], d["encoding"]
    filled = ident(c) if fill is None else F.coalesce(ident(c), F.lit(fill))
    if wanted == "ordinal":
        order = d["category_order"]
        if order is not None:
            return {"column": c, "op": "code_text", "fill": fill, "values": order}
        if (d["n_ordinal_matches"] or 0) >= 2:
            return _learned(ordinal_codes(df, c).select(F.col("value").alias("key"), F.col("code").alias("value"), "n"), c, "code_text_table", fill)
        if values is not None:
            return {"column": c, "op": "code", "fill": fill, "values": values}
        return _learned(_codes(df, filled), c, "code_table", fill)
    if encodings == "declared" and wanted == "frequency":
        if values is not None:
            return {"column": c, "op": "lookup", "fill": fill}
        counts = df.groupBy(filled.alias("key")).agg(F.count(F.lit(1)).alias("n")).where(F.col("key").isNotNull())
        total = df.where(filled.isNotNull()).count() or 1
        return _learned(counts.withColumn("value", F.col("n") / F.lit(float(total))), c, "lookup_table", fill)
    if values is not None:
        return {"column": c, "op": "onehot", "fill": fill, "values": values}
    return _learned(_codes(df, filled), c, "onehot_table", fill)


def _codes(df: DataFrame, filled: Column) -> DataFrame:
    return dense_codes(df.select(filled.alias("key")), "key").withColumnRenamed("code", "value")


def _learned(table: DataFrame, column: str, op: str, fill: object) -> dict:
    """A step whose ``key, value, n`` are a table in the shared folder."""
    spark = table.sparkSession
    path = f"{shared_folder(spark)}/prepare-{uuid.uuid4().hex}"
    table.select("key", "value", "n").write.parquet(path)
    return {"column": column, "op": op, "fill": fill, "table": path, "width": spark.read.parquet(path).count()}


def _table_key(s: dict) -> Column:
    c = ident(s["column"])
    c = c if s["fill"] is None else F.coalesce(c, F.lit(s["fill"]))
    return trimmed_lower(c) if s["op"] == "code_text_table" else c


def _table_exprs(s: dict, value: Column, wide: bool) -> dict[str, Column]:
    """Columns of a step whose learned value is attached; none for a one-hot that goes to the vector."""
    if s["op"] == "lookup_table":
        return {s["column"]: F.coalesce(value, F.lit(0.0))}
    if s["op"] != "onehot_table":
        return {s["column"]: F.coalesce(value, F.lit(-1)).cast("int")}
    if not wide:
        return {}
    if s["width"] > WIDE_COLUMNS:
        raise ValueError(f"{s['column']} has {s['width']} categories: set outputCol to get them as a sparse vector")
    return {n: F.coalesce((value == i).cast("int"), F.lit(0)) for i, n in enumerate(step_names(s))}


def _learn_powers(df: DataFrame, steps: list[dict]) -> None:
    todo = [s for s in steps if s["transform"] == "yeo_johnson"]
    if not todo:
        return
    lams = power.fit_lambdas(df, "yeo_johnson", {s["column"]: _filled(s) for s in todo})
    for s in todo:
        s["lambda"] = lams[s["column"]]
    z = learn_scaler(df, "standard", {s["column"]: power.yeo_johnson(_filled(s), s["lambda"]) for s in todo})
    for s in todo:
        s["zc"], s["zs"] = z[s["column"]]


def _filled(s: dict) -> Column:
    c = nan_to_null(ident(s["column"]).cast("double"))
    return c if s["fill"] is None else F.coalesce(c, F.lit(float(s["fill"])))


def _before_scaling(s: dict) -> Column:
    return scaled(power.transform_expr(s["transform"], _filled(s), s["lambda"]), s["zc"], s["zs"])


def literal_names(s: dict) -> list[str]:
    return [encode.category_name(s["column"], v) for v in s["values"]] if s["op"] == "onehot" else [s["column"]]


def step_names(s: dict) -> list[str]:
    if s["op"] != "onehot_table":
        return literal_names(s)
    rows = SparkSession.active().read.parquet(s["table"]).orderBy("value").select("key").collect()
    return [encode.category_name(s["column"], r["key"]) for r in rows]


def step_exprs(s: dict) -> dict[str, Column]:
    name = s["column"]
    c = ident(name)
    if s.get("fill") is not None and s["op"] != "scaled":
        c = F.coalesce(c, F.lit(s["fill"]))
    if s["op"] == "pass":
        return {name: ident(name)}
    if s["op"] == "bool":
        return {name: c.cast("int")}
    if s["op"] == "code":
        return {name: encode.code_expr(c, s["values"])}
    if s["op"] == "code_text":
        return {name: encode.code_expr(trimmed_lower(c), s["values"])}
    if s["op"] == "onehot":
        return encode.onehot_exprs(c, name, s["values"])
    if s["op"] == "lookup":
        table = F.create_map(*[F.lit(x) for pair in s["pairs"] for x in pair])
        return {name: F.coalesce(F.try_element_at(table, c), F.lit(0.0))}
    return {name: scaled(_before_scaling(s), s["center"], s["scale"])}
