"""Model operators: elastic net / OLS (M4), random forest (M6), boosted trees
(M7), the model call contract (M8), feature importance (M3) and persistence (K8).

Two forms of each kind:

* ``fold_model``: for walk-forwards and training windows. All folds of all
  kinds are fitted in one Spark job (``backtest.compare``); ``fit_window`` fits
  every kind on one bounded training window and gives a table of models.
* ``make_estimator`` / ``RegressionModel``: MLlib estimators, for one fit on a
  frame of any size; the executors train, the driver only sequences the fit.
  ``walk_forward_mllib`` evaluates any other MLlib estimator, one fit per fold.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.plans import backtest as bt
from tidewise.plans.ordered import IDX, add_row_index
from tidewise.plans.trees import Ensemble
from tidewise.session import cut_lineage, scratch_path

# Fixed hyper-parameters of the model configuration.
ELASTIC_NET = {"alpha": 0.01, "l1_ratio": 0.5, "max_iter": 1000}
BOOSTED = {"n_estimators": 1000, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8,
           "colsample_bytree": 0.8, "random_state": 42}
SEED = 42
# A forest's shape where none is configured: MLlib's defaults for regression.
FOREST = {"num_trees": 20, "max_depth": 5, "max_bins": 32, "column_share": 1 / 3, "seed": SEED}


def fold_model(kind: str, features: Sequence[str], **overrides) -> bt.Linear | bt.Fitted:
    """The model of a kind for ``backtest.compare`` and ``fit_window``."""
    feats = tuple(features)
    if kind == "elastic_net":
        return bt.Linear(feats, "elastic_net", **{**ELASTIC_NET, **overrides})
    if kind == "linear":
        return bt.Linear(feats, "ols")
    if kind == "random_forest":
        p = {**FOREST, **overrides}
        return bt.Fitted(lambda: Ensemble(False, p["num_trees"], p["max_depth"], column_share=p["column_share"],
                                          max_bins=p["max_bins"], seed=p["seed"], features=feats), feats)
    if kind in ("xgboost", "lightgbm"):
        p = {**BOOSTED, **overrides}
        return bt.Fitted(lambda: Ensemble(True, p["n_estimators"], p["max_depth"], p["learning_rate"], p["subsample"],
                                          p["colsample_bytree"], seed=p["random_state"], features=feats), feats)
    raise ValueError(f"unknown model kind {kind!r}")


def make_estimator(kind: str, target: str = "spot_price", features_col: str = "features", **overrides):
    """Estimator for a model kind: ``elastic_net``, ``linear``,
    ``random_forest``, ``xgboost`` / ``lightgbm`` (one boosted-tree
    operator under both names)."""
    if kind == "elastic_net":
        p = {**ELASTIC_NET, **overrides}
        return LinearRegression(featuresCol=features_col, labelCol=target, regParam=p["alpha"],
                                elasticNetParam=p["l1_ratio"], maxIter=p["max_iter"], standardization=False)
    if kind == "linear":
        return LinearRegression(featuresCol=features_col, labelCol=target, solver="normal", regParam=0.0)
    if kind == "random_forest":
        return RandomForestRegressor(featuresCol=features_col, labelCol=target, seed=overrides.get("seed", SEED),
                                     numTrees=overrides.get("num_trees", 20))
    if kind in ("xgboost", "lightgbm"):
        p = {**BOOSTED, **overrides}
        return GBTRegressor(featuresCol=features_col, labelCol=target, maxIter=p["n_estimators"],
                            maxDepth=p["max_depth"], stepSize=p["learning_rate"], subsamplingRate=p["subsample"],
                            featureSubsetStrategy=str(p["colsample_bytree"]), seed=p["random_state"])
    raise ValueError(f"unknown model kind {kind!r}")


def feature_columns(df: DataFrame, target: str, exclude: Sequence[str] = ("date",)) -> list[str]:
    """Every column but the target and the date."""
    return [c for c in df.columns if c != target and c not in exclude]


class RegressionModel:
    """M8: the model call contract - ``evaluate_model(df)`` -> {'mae',
    'rmse'}, ``train_final_model(df)``, ``.model``,
    ``get_feature_importance()``, ``save(path)``."""

    def __init__(self, kind: str, target: str = "spot_price", features: Sequence[str] | None = None,
                 date_col: str = "date", **overrides):
        self.kind, self.target, self.features, self.date_col = kind, target, features, date_col
        self.overrides = overrides
        self.model: PipelineModel | None = None

    def _stages(self, df: DataFrame) -> Pipeline:
        feats = list(self.features) if self.features else feature_columns(df, self.target, (self.date_col,))
        self.features = feats
        asm = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="error")
        return Pipeline(stages=[asm, make_estimator(self.kind, self.target, **self.overrides)])

    def evaluate_model(self, df: DataFrame, test_fraction: float = 0.2) -> dict[str, float]:
        """Time-ordered hold-out: the last ``test_fraction`` of rows (by
        date) are the test set; returns MAE and RMSE (one-row aggregate)."""
        x = cut_lineage(add_row_index(df, self.date_col))
        n = x.count()
        cut = int(n * (1 - test_fraction))
        train, test = x.filter(F.col(IDX) < cut).drop(IDX), x.filter(F.col(IDX) >= cut).drop(IDX)
        model = self._stages(df).fit(train)
        err = F.col(self.target) - F.col("prediction")
        row = model.transform(test).agg(F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse")).first()
        return {"mae": row["mae"], "rmse": row["rmse"]}

    def train_final_model(self, df: DataFrame) -> PipelineModel:
        self.model = self._stages(df).fit(df)
        return self.model

    def get_feature_importance(self) -> DataFrame:
        """M3: (feature, importance) - tree importances, or absolute
        coefficients for linear models."""
        if self.model is None:
            raise ValueError("model not trained")
        return feature_importance(self.model, self.features)

    def save(self, path: str) -> None:
        """K8: persist the fitted model stages (MLlib format) and, beside them,
        what the contract needs: kind, target, features, date column, overrides."""
        if self.model is None:
            raise ValueError("model not trained")
        self.model.write().overwrite().save(f"{path}/stages")
        facts = {"kind": self.kind, "target": self.target, "features": list(self.features), "date_col": self.date_col,
                 "overrides": self.overrides}
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/facts")

    @classmethod
    def load(cls, path: str) -> RegressionModel:
        """K8: a saved model, ready to score, explain or train again."""
        facts = json.loads(SparkSession.getActiveSession().read.text(f"{path}/facts").first()[0])
        out = cls(facts["kind"], facts["target"], facts["features"], facts["date_col"], **facts["overrides"])
        out.model = PipelineModel.load(f"{path}/stages")
        return out


def feature_importance(model, features: Sequence[str] = ()) -> DataFrame:
    """M3: importance table of a fitted pipeline, or of any object with
    ``get_feature_importance()`` (a frame, a mapping or pairs); an empty frame
    when the model has none."""
    spark = SparkSession.getActiveSession()
    if hasattr(model, "get_feature_importance"):
        got = model.get_feature_importance()
        if isinstance(got, DataFrame):
            return got
        pairs = got.items() if isinstance(got, dict) else got
        return spark.createDataFrame([(str(f), float(v)) for f, v in pairs], "feature string, importance double")
    if not hasattr(model, "stages"):
        return spark.createDataFrame([], "feature string, importance double")
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        vals = last.featureImportances.toArray().tolist()
    elif hasattr(last, "coefficients"):
        vals = [abs(v) for v in last.coefficients.toArray().tolist()]
    else:
        return spark.createDataFrame([], "feature string, importance double")
    return spark.createDataFrame(list(zip(features, [float(v) for v in vals])), "feature string, importance double")


# ------------------------------------------------- models of a training window
_NUMBERS = T.ArrayType(T.DoubleType())
MODEL_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("target", T.StringType()),
    T.StructField("features", T.ArrayType(T.StringType())), T.StructField("importance", _NUMBERS),
    T.StructField("coef", _NUMBERS), T.StructField("base", T.DoubleType()), T.StructField("max_depth", T.IntegerType()),
    T.StructField("edges", T.ArrayType(_NUMBERS)), T.StructField("column", T.ArrayType(T.ArrayType(T.ShortType()))),
    T.StructField("bin", T.ArrayType(T.ArrayType(T.IntegerType()))), T.StructField("value", T.ArrayType(_NUMBERS))])


def fit_window(df: DataFrame, models: dict[str, bt.Linear | bt.Fitted], target: str = "spot_price") -> DataFrame:
    """One row per model (MODEL_SCHEMA), each fitted on all rows of ``df``: the
    linear ones from one frame of moments, tree ensembles one group each. For a
    training window (P11), whose one row per date the parameters bound; a frame
    of any size is ``RegressionModel``'s."""
    parts = []
    linear = {n: m for n, m in models.items() if isinstance(m, bt.Linear)}
    if linear:
        cols = list(dict.fromkeys([f for m in linear.values() for f in m.features])) + [target]
        coefs = bt.solve_moments(bt.all_moments(df, cols), [], cols, linear)
        facts = df.sparkSession.createDataFrame([(n, list(m.features)) for n, m in linear.items()],
                                                "model string, features array<string>")
        slopes = F.slice("coef", 2, F.size("coef"))
        parts.append(coefs.join(F.broadcast(facts), "model").select(
            "model", F.lit(target).alias("target"), "features", F.transform(slopes, F.abs).alias("importance"), "coef",
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in MODEL_SCHEMA.fields[5:]]))
    trees = {n: m for n, m in models.items() if isinstance(m, bt.Fitted)}
    if trees:
        cols = list(dict.fromkeys([f for m in trees.values() for f in m.features])) + [target]
        rows = df.select(*cols, F.explode(F.array(*[F.lit(n) for n in trees])).alias("model"))

        def fit(pdf: pd.DataFrame) -> pd.DataFrame:
            name = pdf["model"].iloc[0]
            spec = trees[name]
            e = spec.make().fit(*spec.matrix(pdf.sort_values(cols), target))   # row order does not matter to a seed
            gains = e.get_feature_importance()
            return pd.DataFrame([{
                "model": name, "target": target, "features": list(spec.features),
                "importance": [gains[f] for f in spec.features], "coef": None, "base": e.base, "max_depth": e.max_depth,
                "edges": [x.tolist() for x in e.edges], "column": e.column.tolist(), "bin": e.bin.tolist(),
                "value": e.value.tolist()}])

        parts.append(bt.spread(rows, ["model"]).groupBy("model").applyInPandas(fit, MODEL_SCHEMA))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def save_models(models: DataFrame, path: str) -> None:
    """K8: the table of models as Parquet."""
    models.write.mode("overwrite").parquet(path)


def load_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL_SCHEMA).parquet(path)


def predict_with(models: DataFrame, df: DataFrame) -> DataFrame:
    """``df`` once per model, with ``model`` and ``prediction``. The models, whose
    size their parameters bound, travel with the tasks."""
    known = [r.asDict() for r in models.orderBy("model").collect()]

    def predict(row: dict, x: np.ndarray) -> np.ndarray:
        if row["coef"] is not None:
            return row["coef"][0] + x @ np.array(row["coef"][1:])
        e = Ensemble(True, len(row["column"]), row["max_depth"], edges=[np.array(a) for a in row["edges"]],
                     column=np.array(row["column"], np.int16), bin=np.array(row["bin"], np.int32),
                     value=np.array(row["value"]), base=row["base"])
        return e.predict(x)

    def score(batches):
        for pdf in batches:
            for row in known:
                yield pdf.assign(model=row["model"], prediction=predict(row, pdf[row["features"]].to_numpy(float)))

    return df.mapInPandas(score, T.StructType([*df.schema.fields, T.StructField("model", T.StringType()),
                                               T.StructField("prediction", T.DoubleType())]))


def importances(models: DataFrame) -> DataFrame:
    """M3 of a table of models: (model, feature, importance)."""
    return models.select("model", F.explode(F.arrays_zip("features", "importance")).alias("e")).select(
        "model", F.col("e.features").alias("feature"), F.col("e.importance").alias("importance"))


def walk_forward_mllib(
    df: DataFrame,
    make: Callable[[], object],
    features: Sequence[str],
    target: str = "spot_price",
    window: int = bt.DEFAULT_WINDOW,
    step: int = bt.DEFAULT_STEP,
    order_col: str = "date",
    model_name: str = "model",
    parallelism: int = 4,
) -> DataFrame:
    """M1 for an MLlib estimator (``make()`` returns a fresh one): one fit per
    fold on that fold's W training rows, a few folds at a time."""
    # every fold's plan starts from this frame: cut the lineage once (shared
    # checkpoint folder) so the K fold plans stay small and a lost executor
    # does not replay the whole feature computation
    x = cut_lineage(add_row_index(df, order_col))
    n = x.count()
    K = bt.fold_count(n, window, step)
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    xa = asm.transform(x)

    def one(k: int) -> DataFrame:
        lo = k * step
        train = xa.filter((F.col(IDX) >= lo) & (F.col(IDX) < lo + window))
        test = xa.filter((F.col(IDX) >= lo + window) & (F.col(IDX) < lo + window + step))
        m = make().setFeaturesCol("features").setLabelCol(target).fit(train)
        return m.transform(test).select(F.lit(model_name).alias("model"), F.lit(k).cast("long").alias("fold"),
                                        F.col(IDX).alias("idx"), order_col,
                                        F.col(target).cast("double").alias("actual"), "prediction")

    # each fold's predictions go to a partition of a table in the shared folder:
    # the result is one scan, not a union of K plans
    path = scratch_path(x.sparkSession, f"folds/{uuid.uuid4().hex}")

    def write(k: int) -> None:
        one(k).drop("fold").write.parquet(f"{path}/fold={k}")

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        list(pool.map(write, range(K)))
    schema = f"model string, idx bigint, `{order_col}` {x.schema[order_col].dataType.simpleString()}, actual double, prediction double"
    if not K:
        return x.sparkSession.createDataFrame([], schema + ", fold bigint").select(
            "model", "fold", "idx", order_col, "actual", "prediction")
    return x.sparkSession.read.schema(schema + ", fold bigint").parquet(path).select(
        "model", "fold", "idx", order_col, "actual", "prediction")
