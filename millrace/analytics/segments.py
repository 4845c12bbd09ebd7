"""Customer segments: k-means in Spark ML, elbow, profiles and scoring functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.clean import relabel
from millrace.scratch import materialise
from millrace.session import task_count


def fit_segments(df: DataFrame, columns: Sequence[str], k: int, seed: int = 42, scale: bool = True) -> PipelineModel:
    """Assemble, optionally scale every column to 0..10, and cluster."""
    stages = [VectorAssembler(inputCols=list(columns), outputCol="_raw", handleInvalid="skip")]
    if scale:
        stages.append(MinMaxScaler(min=0.0, max=10.0, inputCol="_raw", outputCol="_features"))
    stages.append(KMeans(k=k, seed=seed, maxIter=30, featuresCol="_features" if scale else "_raw", predictionCol="cluster"))
    ready = materialise(df.select(*columns), "segment-input", task_count(df.sparkSession))
    return Pipeline(stages=stages).fit(ready)


def elbow(df: DataFrame, columns: Sequence[str], ks: Sequence[int], seed: int = 42) -> DataFrame:
    """Within-cluster squared distance for each number of clusters."""
    source = materialise(df.select(*columns), "elbow-input", task_count(df.sparkSession))
    prep = Pipeline(stages=[
        VectorAssembler(inputCols=list(columns), outputCol="_raw", handleInvalid="skip"),
        MinMaxScaler(min=0.0, max=10.0, inputCol="_raw", outputCol="_features"),
    ]).fit(source)
    ready = prep.transform(source).select("_features").persist()  # read once per k and iteration
    try:
        costs = [(k, float(KMeans(k=k, seed=seed, maxIter=30, featuresCol="_features").fit(ready).summary.trainingCost))
                 for k in ks]
    finally:
        ready.unpersist()
    return df.sparkSession.createDataFrame(costs, "k int, inertia double")


def assign(model: PipelineModel, df: DataFrame, names: Mapping[int, str] | None = None) -> DataFrame:
    out = model.transform(df).drop("_raw", "_features")
    return out if names is None else out.withColumn("segment", relabel("cluster", names, "other"))


def profile(assigned: DataFrame, columns: Sequence[str], by: str = "cluster") -> DataFrame:
    """Mean of each column per cluster."""
    return assigned.groupBy(by).agg(F.count("*").alias("customers"), *[F.avg(c).alias(c) for c in columns])


def centres(model: PipelineModel) -> list[list[float]]:
    return [c.tolist() for c in model.stages[-1].clusterCenters()]


def name_by_rank(model: PipelineModel, column: int, names: Sequence[str]) -> dict[int, str]:
    """Name clusters by the order of one centre coordinate, so names do not depend on numbering."""
    order = np.argsort([c[column] for c in centres(model)])
    return {int(cluster): names[rank] for rank, cluster in enumerate(order)}


def nearest_centre(points: Sequence[Sequence[float]]):
    """A vectorised function of as many columns as a centre has coordinates."""
    grid = np.asarray(points, dtype="float64")

    @F.pandas_udf("int")
    def predict(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype="float64") for c in columns])
        return pd.Series(((x[:, None, :] - grid[None, :, :]) ** 2).sum(axis=2).argmin(axis=1).astype("int32"))

    return predict


def register_model(spark: SparkSession, name: str, points: Sequence[Sequence[float]]):
    """The same function for SQL text."""
    return spark.udf.register(name, nearest_centre(points))


def probability_of_one(column: str = "probability"):
    """Class-1 probability out of a Spark ML probability vector."""
    return vector_to_array(F.col(column))[1]
