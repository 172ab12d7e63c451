"""Composed runs: train -> evaluate -> save -> report (E4) and the feature
and backtest walkthrough (E5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.operators.impute import median_impute, window_bounds
from tidewise.operators.joins import feature_matrix
from tidewise.plans import backtest as bt
from tidewise.plans import models as md
from tidewise.plans.features import combine, storage_features, weather_features
from tidewise.plans.report import report, top_k
from tidewise.session import cut_lineage

BASELINE_KINDS = ("elastic_net", "linear", "random_forest")
TREE_KINDS = ("xgboost", "lightgbm")


def training_data(tables: dict[str, DataFrame], start: str | None = None, end: str | None = None,
                  days: int = 730, mode: str = "exact", rollup_entities: bool = False) -> DataFrame:
    """P11 -> J1 -> P10: the matrix of the training window with medians
    filled (columns that are null throughout are dropped from the features
    later, as an all-null column cannot be assembled).

    Without bounds the window ends at the last price date: that date is read
    from the price table alone, and the window bounds every side before the
    joins."""
    if start is None and end is None:
        start, end = window_bounds(tables["prices"], days)
    return median_impute(feature_matrix(tables, start, end, mode=mode, rollup_entities=rollup_entities), "spot_price")


def run_training(
    tables: dict[str, DataFrame],
    out_dir: str,
    kinds: Sequence[str] = BASELINE_KINDS + TREE_KINDS,
    window: int = bt.DEFAULT_WINDOW,
    step: int = bt.DEFAULT_STEP,
    start: str | None = None,
    end: str | None = None,
    model_overrides: dict[str, dict] | None = None,
    rollup_entities: bool = True,
    features: Sequence[str] | None = None,
) -> DataFrame:
    """Training data -> final fit of every model, saved with features and
    target (K8) -> walk-forward comparison over identical folds (M2) -> K7
    report rows (models, predictions and report are tables under ``out_dir``).
    Entities are rolled up by default: a walk-forward needs one row per date.

    All kinds share one indexed frame: the linear ones are solved from fold
    moments, all folds of all tree kinds are one grouped job, and the final fits
    are one more; nothing is fitted on the driver or fold by fold."""
    data = cut_lineage(training_data(tables, start, end, rollup_entities=rollup_entities))
    if features is None:
        non_null = data.agg(*[F.count(c).alias(c) for c in data.columns]).first().asDict()
        features = [c for c in md.feature_columns(data, "spot_price") if non_null.get(c)]
    models = {kind: md.fold_model(kind, features, **(model_overrides or {}).get(kind, {})) for kind in kinds}
    md.save_models(md.fit_window(data, models, "spot_price"), f"{out_dir}/models")
    spark = data.sparkSession
    bt.compare(data, models, "spot_price", window, step).write.mode("overwrite").parquet(f"{out_dir}/predictions")
    pred = spark.read.parquet(f"{out_dir}/predictions")
    report(bt.summary(bt.fold_metrics(pred, window, step))).write.mode("overwrite").parquet(f"{out_dir}/report")
    return spark.read.parquet(f"{out_dir}/report")


def demo(series: DataFrame, window: int = 200, step: int = 50, top: int = 10) -> dict[str, DataFrame]:
    """E5 on a daily frame with spot_price, hdd, cdd, storage, temperature,
    production: weather (E1) and storage (E2) features, combined on date (J3);
    least-squares walk-forward with the demo's window and step (M1 -> A4 ->
    A5); importance of the combined features (M3 -> O2)."""
    base = cut_lineage(series)
    wxf = weather_features(base.select("date", "temperature"))
    stf = storage_features(base.select("date", F.col("storage").alias("working_gas")))
    combined = combine({"base": base, "wx": wxf, "st": stf})
    pred = bt.walk_forward_lstsq(base, ["hdd", "cdd", "storage", "production"], "spot_price", window, step)
    metrics = bt.fold_metrics(pred, window, step)
    pipe = md.RegressionModel("random_forest", "spot_price", ["hdd", "cdd", "storage", "temperature", "production"])
    pipe.train_final_model(base)
    return {
        "features": combined,
        "fold_metrics": metrics,
        "summary": bt.summary(metrics),
        "importance": top_k(pipe.get_feature_importance(), "importance", top, tiebreak="feature"),
    }
