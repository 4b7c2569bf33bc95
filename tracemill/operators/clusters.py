"""Clusters of embeddings and difficulty to learn."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def perplexity(mean_loss: Column) -> Column:
    """Difficulty to learn as exp of the mean token loss of a model."""
    return F.exp(mean_loss)


def sequence_perplexity(losses: Column) -> Column:
    """Difficulty to learn of a text from the losses of its tokens; null entries (positions without a target) don't count."""
    kept = F.filter(losses, lambda x: x.isNotNull())
    total = F.aggregate(kept, F.lit(0.0), lambda acc, x: acc + x)
    return perplexity(F.try_divide(total, F.size(kept)))


def mean_pooled(states: Column, mask: Column | None = None) -> Column:
    """The mean of the states of a text's tokens (an array of equally long arrays), over those that ``mask`` keeps; null without any."""
    kept = states if mask is None else F.filter(states, lambda _, i: F.coalesce(F.get(mask, i), F.lit(False)))
    width = F.size(F.get(kept, F.lit(0)))
    mean = F.transform(F.sequence(F.lit(0), width - 1), lambda j: F.aggregate(kept, F.lit(0.0), lambda acc, x: acc + F.get(x, j)) / F.size(kept))
    return F.when((F.size(kept) > 0) & (width > 0), mean)


def _length(embedding: str) -> Column:
    """The length of an embedding of finite values; null for any other and for an empty one."""
    sound = ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when((F.size(embedding) > 0) & sound, F.size(embedding))


def _of_length(df: DataFrame, embedding: str, n: int) -> DataFrame:
    return df.filter(F.coalesce(_length(embedding) == n, F.lit(False)))


def fit_kmeans(df: DataFrame, embedding: str, k: int = 40, seed: int = 42, rounds: int = 20) -> KMeansModel | None:
    """Distributed k-means over the rows that have an embedding of the most frequent length; None if no row has."""
    n = df.agg(F.mode(_length(embedding), True)).first()[0]
    if n is None:
        return None
    rows = _of_length(df, embedding, n).select(array_to_vector(F.col(embedding).cast("array<double>")).alias("features"))
    return KMeans(k=k, seed=seed, maxIter=rounds).fit(rows)


def with_clusters(df: DataFrame, embedding: str, model: KMeansModel | None, name: str = "cluster") -> DataFrame:
    """A column with the cluster of each row; rows without an embedding that the model can place are dropped."""
    if model is None:
        return df.filter(F.col(embedding).isNotNull()).withColumn(name, F.lit(None).cast("int"))
    rows = _of_length(df, embedding, len(model.clusterCenters()[0])).withColumn("_features", array_to_vector(F.col(embedding).cast("array<double>")))
    model.setFeaturesCol("_features").setPredictionCol(name)
    return model.transform(rows).drop("_features")
