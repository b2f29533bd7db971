"""Streaming training for k-means and linear regression (ML1-ML4).

Two ways to drive the same model classes:

* ``*_foreach_batch``: a ``foreachBatch`` function for a live stream. Each
  micro-batch is one distributed aggregate; the model after batch ``b`` is
  written under ``model_dir/batch_id=b``. A new process, and a replayed batch,
  first load the newest stored model below the batch (or the initial one).
* ``*_replay``: the same updates over a table with a batch column, for
  backfills and tests.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators.kmeans import MODEL_SCHEMA, StreamingKMeansModel
from tidepool.operators.linreg import StreamingLinearModel, regression_moments
from tidepool.session import shared_dir
from tidepool.streaming.sinks import read_or_none

LINREG_SCHEMA = "batch_id bigint, n bigint, weights array<double>, intercept double"


def kmeans_replay(df: DataFrame, features: str, batch_col: str,
                  model: StreamingKMeansModel) -> DataFrame:
    """Train batch after batch in batch-id order; the model after each batch.

    The input is written once, partitioned by batch, to the shared folder, so
    each step reads only its own partition and the source is scanned once.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "kmeans-replay")
    df.select(batch_col, features).write.partitionBy(batch_col).parquet(path)
    staged = spark.read.parquet(path)
    ids = [r[0] for r in staged.select(batch_col).distinct().orderBy(batch_col).collect()]
    rows = []
    for b in ids:
        model.train_batch(staged.where(F.col(batch_col) == b), features)
        rows += model.as_rows(b)
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def linreg_replay(df: DataFrame, label: str, features: list, batch_col: str,
                  model: StreamingLinearModel) -> DataFrame:
    """All batches' moments in ONE aggregate, then the per-batch SGD in order."""
    spark = df.sparkSession
    moments = regression_moments(df, label, features, by=[batch_col]).orderBy(batch_col).collect()
    rows = []
    for m in moments:
        model.update_from_moments(m)
        rows.append((int(m[batch_col]), int(m["n"]), [float(w) for w in model.weights],
                     float(model.intercept)))
    return spark.createDataFrame(rows, LINREG_SCHEMA)


def _stored_before(spark, model_dir: str, batch_id: int) -> DataFrame | None:
    """The newest stored model of a batch below ``batch_id``; None without one."""
    models = read_or_none(spark, model_dir, basePath=model_dir)
    if models is None:
        return None
    earlier = models.where(F.col("batch_id") < batch_id)
    last = earlier.agg(F.max("batch_id")).first()[0]
    return None if last is None else earlier.where(F.col("batch_id") == last)


def _copied(model: StreamingKMeansModel) -> StreamingKMeansModel:
    out = StreamingKMeansModel.given(np.array(model.centres, copy=True), 0.0, model.decay)
    out.weights = np.array(model.weights, dtype=float, copy=True)
    return out


def _kmeans_before(spark, model_dir: str, batch_id: int, initial: StreamingKMeansModel) -> StreamingKMeansModel:
    stored = _stored_before(spark, model_dir, batch_id)
    if stored is None:
        return _copied(initial)
    rows = stored.orderBy("cluster").collect()
    m = StreamingKMeansModel.given([r["centre"] for r in rows], 0.0, initial.decay)
    m.weights = np.array([r["weight"] for r in rows])
    return m


def kmeans_foreach_batch(model: StreamingKMeansModel, features: str, model_dir: str,
                         role_col: str | None = None, predict_dir: str | None = None,
                         keep=()):
    """``foreachBatch`` trainer: update, then persist the model for this batch id.

    With ``role_col`` the stream carries training rows (``'train'``) and rows
    to score (``'test'``) together: the batch trains first, then scores its
    test rows with the updated model into ``predict_dir/batch_id=N``.
    """
    state = {"model": model, "initial": _copied(model), "last": None}

    def run(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        if state["last"] is None or batch_id <= state["last"]:  # a new process, or a replay
            state["model"] = _kmeans_before(spark, model_dir, batch_id, state["initial"])
        state["last"] = batch_id
        scoring = role_col is not None and predict_dir is not None
        if scoring:  # read once, used by the update and by the scoring
            batch_df = batch_df.persist()
        try:
            train = batch_df if role_col is None else batch_df.where(F.col(role_col) == "train")
            if not train.isEmpty():
                state["model"].train_batch(train, features)
                (spark.createDataFrame(state["model"].as_rows(batch_id), MODEL_SCHEMA).drop("batch_id")
                      .write.mode("overwrite").parquet(f"{model_dir}/batch_id={batch_id}"))
            if scoring:
                test = batch_df.where(F.col(role_col) == "test")
                (state["model"].predict(test, features).select(*keep, "cluster")
                      .write.mode("overwrite").parquet(f"{predict_dir}/batch_id={batch_id}"))
        finally:
            if scoring:
                batch_df.unpersist()

    run.state = state
    return run


def linreg_foreach_batch(model: StreamingLinearModel, label: str, features: list, model_dir: str,
                         role_col: str | None = None, predict_dir: str | None = None, keep=()):
    """``foreachBatch`` trainer for the regression model.

    With ``role_col``, ``'test'`` rows are scored after the batch's update as
    ``(*keep, label (truncated to int), label_value, prediction)``.
    """
    state = {"model": model, "last": None,
             "initial": (model.weights.copy(), model.intercept)}

    def run(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        if state["last"] is None or batch_id <= state["last"]:  # a new process, or a replay
            stored = _stored_before(spark, model_dir, batch_id)
            prev = None if stored is None else stored.first()
            weights, intercept = state["initial"] if prev is None else (prev["weights"], prev["intercept"])
            state["model"].weights, state["model"].intercept = np.array(weights, dtype=float), intercept
        state["last"] = batch_id
        scoring = role_col is not None and predict_dir is not None
        if scoring:
            batch_df = batch_df.persist()
        try:
            train = batch_df if role_col is None else batch_df.where(F.col(role_col) == "train")
            m = regression_moments(train, label, features).first()
            if m and m["n"]:
                state["model"].update_from_moments(m)
                row = [(int(batch_id), int(m["n"]), [float(w) for w in state["model"].weights],
                        float(state["model"].intercept))]
                spark.createDataFrame(row, LINREG_SCHEMA).drop("batch_id").write.mode("overwrite").parquet(
                    f"{model_dir}/batch_id={batch_id}")
            if scoring:
                test = batch_df.where(F.col(role_col) == "test")
                (test.select(*keep, F.col(label).cast("int").alias("label"),
                             F.col(label).cast("double").alias("label_value"),
                             state["model"].predict(features))
                     .write.mode("overwrite").parquet(f"{predict_dir}/batch_id={batch_id}"))
        finally:
            if scoring:
                batch_df.unpersist()

    run.state = state
    return run
