"""Named compositions (L1-L5): prepare, train, infer, profile, compare."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.operators import features as fe
from attrition.operators import metrics as me
from attrition.operators import models
from attrition.operators import profile as pr
from attrition.operators import rfm
from attrition.operators import split as sp
from attrition.schema import LABEL, preset
from attrition.session import ensure_checkpoint_dir
from attrition.sources import files, store


def prepare(df: DataFrame, method: str = "auto", rfm_model: rfm.RfmModel | None = None,
            store_base: str | None = None, ttl_s: float = 3600.0) -> DataFrame:
    """L1: ratio features + RFM scores (shared by train and infer).

    RFM is batch-relative by default (as in the reference) or uses frozen
    edges (``rfm_model``).  With ``store_base`` the result is materialised once
    under a fingerprint of the input and the parameters, and reused while
    younger than ``ttl_s`` (S12).
    """
    feats = fe.ratio_features(df)
    feats = rfm.apply_rfm(feats, rfm_model) if rfm_model is not None else rfm.rfm_features(feats, method=method)
    if store_base is None:
        return feats
    params = {"step": "prepare", "method": method,
              "rfm": None if rfm_model is None else rfm_model.to_dict()}
    table, _ = store.materialize(feats, store_base, params, ttl_s, source=df)
    return table


@dataclass
class TrainResult:
    model: PipelineModel
    metrics: DataFrame
    passed: bool
    version: int | None


def train(df: DataFrame, kind: str = "rf", params: dict | None = None, feature_preset: str = "F13",
          stratified: bool = True, model_base: str | None = None, name: str = "churn_model",
          gate_metric: str = "f1", gate_min: float = 0.0) -> TrainResult:
    """L2: prepare -> split -> fit -> evaluate -> quality gate -> save."""
    ensure_checkpoint_dir(df.sparkSession)
    feats = prepare(df)
    split = sp.split_stratified(feats) if stratified else sp.split_hash(feats)
    split = split.checkpoint(eager=True)  # fitted and evaluated from the same rows
    train_rows, test_rows = split.where(F.col("split") == "train"), split.where(F.col("split") == "test")
    cols = preset(feature_preset)
    pm = models.fit(train_rows, kind, params, cols)
    metrics = models.evaluate(pm, test_rows)
    value = metrics.first()[gate_metric]
    passed = value >= gate_min
    version = store.save_model(pm, model_base, name) if (passed and model_base) else None
    return TrainResult(pm, metrics, passed, version)


def infer(df: DataFrame, pm: PipelineModel, version: str | None = None, threshold: float = 0.5,
          rfm_model: rfm.RfmModel | None = None, predicted_at: dt.datetime | None = None) -> DataFrame:
    """Prepare and score with a model; customer_id, probability, decision[, version][, stamp].

    Quantiles are re-fitted on the batch unless frozen edges are given."""
    return models.score_frame(pm, prepare(df, rfm_model=rfm_model), threshold, version, predicted_at)


def infer_saved(df: DataFrame, model_base: str, name: str, out_path: str, version: int | str = "latest",
                threshold: float = 0.5, rfm_model: rfm.RfmModel | None = None, fmt: str = "parquet") -> dict:
    """L3: load a saved model by name and version, score the batch with one stamp and the
    model's version, write the predictions, and return the write's receipt."""
    pm, number = store.load_model(model_base, name, version, with_version=True)
    stamp = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    scored = infer(df, pm, f"{name}-v{number}", threshold, rfm_model, stamp)
    return files.write_predictions(scored, out_path, fmt=fmt) | {"model_version": f"{name}-v{number}"}


def profile(df: DataFrame, label: str = LABEL) -> dict[str, DataFrame]:
    """L4: every profile table."""
    return pr.profile(df, label)


def compare_runs(per_split_metrics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaderboard and best run from per-run, per-split metrics."""
    board = me.leaderboard(me.runs_table(per_split_metrics))
    return board, me.best_run(board)
