"""Spatial hotspots by K-means."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import sqrt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions.geo import usable
from casebook.functions.rates import ones, percent
from casebook.session import written

# Categories that count as violent, and the settings of the clustering.
VIOLENT = ("HOMICIDE", "ASSAULT", "BATTERY", "ROBBERY")
CLUSTERS, SEED, ITERATIONS, INIT_STEPS = 10, 42, 100, 10

POINTS_PER_TASK = 100_000


def valid_points(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Rows with usable coordinates."""
    return df.filter(usable(F.col(lat)) & usable(F.col(lon)))


@dataclass(frozen=True)
class Axis:
    """Mean and sample standard deviation of a coordinate over all rows."""

    mean: float
    deviation: float

    def scaled(self, column: str) -> str:
        """SQL for the standardised coordinate; one that does not vary becomes 0 (M2)."""
        return f"(`{column}` - {self.mean!r}D) / {self.deviation!r}D" if self.deviation else "0D"

    def unscaled(self, value: float) -> float:
        return value * self.deviation + self.mean


@dataclass(frozen=True)
class Hotspots:
    """A fitted clustering: every row with its cluster, and one profile row per cluster."""

    assigned: DataFrame
    profile: DataFrame
    model: PipelineModel
    rows: int


def place_counts(df: DataFrame, lat: str, lon: str, category: str) -> DataFrame:
    """Rows per place and category. Incident coordinates repeat, so this is far smaller than the rows,
    and a place holding a third of them is a few weighted rows."""
    return (
        valid_points(df, lat, lon)
        .groupBy(lat, lon, category)
        .agg(F.count(F.lit(1)).alias("weight"))
    )


@dataclass(frozen=True)
class Scale:
    """How many rows and places there are, and both axes weighted by the rows of a place."""

    rows: int
    places: int
    lat: Axis
    lon: Axis


def measure(places: DataFrame, lat: str, lon: str) -> Scale:
    """Two small aggregates: means first, then squares around them, which keeps all digits."""
    weight = F.col("weight")
    first = places.agg(
        F.coalesce(F.sum(weight), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("places"),
        *(F.try_divide(F.sum(F.col(c) * weight), F.sum(weight)).alias(c) for c in (lat, lon)),
    ).first()
    rows = first["rows"]

    def squares(column: str) -> Column:
        off = F.col(column) - F.lit(first[column])
        return F.coalesce(F.sum(off * off * weight), F.lit(0.0)).alias(column)

    second = places.agg(squares(lat), squares(lon)).first()
    return Scale(
        rows,
        first["places"],
        *(Axis(first[c], sqrt(second[c] / (rows - 1)) if rows > 1 else 0.0) for c in (lat, lon)),
    )


def cluster_profile(
    places: DataFrame, cluster: str, lat: str, lon: str, category: str, violent: Sequence
) -> DataFrame:
    """Size, centre of the members, distinct categories and violent share per cluster (M5)."""
    weight = F.col("weight")
    size = F.sum(weight)
    return places.groupBy(cluster).agg(
        size.alias("crime_count"),
        F.round(F.sum(F.col(lat) * weight) / size, 6).alias("avg_lat"),
        F.round(F.sum(F.col(lon) * weight) / size, 6).alias("avg_lon"),
        F.count_distinct(category).alias("unique_crime_types"),
        percent(F.sum(ones(F.col(category).isin(*violent)) * weight), size).alias("violent_crime_pct"),
    )


def hotspots(
    df: DataFrame,
    *,
    keep: Sequence[str],
    lat: str = "latitude",
    lon: str = "longitude",
    category: str = "primary_type",
    violent: Sequence = VIOLENT,
    k: int = CLUSTERS,
    seed: int = SEED,
) -> Hotspots | None:
    """Cluster rows by place; None when there are fewer valid rows than clusters (A10).

    The rows are read once to count them per place. Every iteration then runs over the weighted
    places, in which each row pulls equally. The objective is that of the single rows; the centres are a
    local optimum of it, which need not be the one a fit over single rows ends in, as the
    initial centres are drawn among places. Infinite coordinates are no places either.
    Places are hash-partitioned by their own number and sorted, so neither the layout of the input,
    the size of the cluster nor a recomputed partition changes the result.
    """
    spark = df.sparkSession
    places = written(place_counts(df, lat, lon, category), "places")
    scale = measure(places, lat, lon)
    if scale.rows < k:
        return None

    points = (
        places.repartition(1 + scale.places // POINTS_PER_TASK, lat, lon)
        .groupBy(lat, lon)
        .agg(F.sum("weight").cast("double").alias("weight"))
        .sortWithinPartitions(lat, lon)
    )
    standardise = SQLTransformer(
        statement=f"SELECT *, {scale.lat.scaled(lat)} AS _lat_z, {scale.lon.scaled(lon)} AS _lon_z FROM __THIS__"
    )
    assemble = VectorAssembler(inputCols=["_lat_z", "_lon_z"], outputCol="_features")
    # the block solver fails where initialisation finds fewer centres than k
    cluster = KMeans(
        k=k, seed=seed, maxIter=ITERATIONS, initSteps=INIT_STEPS, solver="row",
        featuresCol="_features", predictionCol="cluster_id", weightCol="weight",
    )
    model = Pipeline(stages=[standardise, assemble, cluster]).fit(points)

    centres = spark.createDataFrame(
        [
            (i, scale.lat.unscaled(float(c[0])), scale.lon.unscaled(float(c[1])), float(c[0]), float(c[1]))
            for i, c in enumerate(model.stages[-1].clusterCenters())
        ],
        "cluster_id int, model_center_lat double, model_center_lon double, "
        "model_center_lat_scaled double, model_center_lon_scaled double",
    )
    profile = (
        cluster_profile(model.transform(places), "cluster_id", lat, lon, category, violent)
        .join(F.broadcast(centres), "cluster_id")  # k rows
        .orderBy(F.desc("crime_count"), "cluster_id")
    )
    assigned = model.transform(valid_points(df, lat, lon)).select(*keep, "cluster_id")
    return Hotspots(assigned, profile, model, scale.rows)
