import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from casebook.operators.hotspots import hotspots, measure, place_counts, valid_points
from casebook.plans.reports import crime_hotspots

KEEP = ("id", "primary_type", "latitude", "longitude")


@pytest.fixture(scope="module")
def crimes(spark):
    """Five towns, one place of them holding a third of all rows, and rows without a usable place."""
    rng = np.random.default_rng(7)
    rows, kinds = [], ["HOMICIDE", "THEFT", "BATTERY", "FRAUD"]
    for i in range(3000):
        town = i % 5
        if i % 3 == 0:
            lat, lon = 41.7, -87.6
        else:
            lat, lon = 41.6 + town * 0.1 + rng.normal(0, 0.01), -87.5 - town * 0.2 + rng.normal(0, 0.01)
        rows.append((i, f"C{i}", kinds[i % 4], i % 7, round(float(lat), 3), round(float(lon), 3)))
    rows += [
        (9001, "X", "THEFT", 1, 0.0, -87.0),
        (9002, "X", "THEFT", 1, float("nan"), -87.0),
        (9003, "X", "THEFT", 1, None, -87.0),
        (9004, "X", "THEFT", 1, 41.0, 0.0),
    ]
    return spark.createDataFrame(
        rows, "id int, case_number string, primary_type string, district int, latitude double, longitude double"
    )


@pytest.fixture(scope="module")
def found(crimes):
    return hotspots(crimes, keep=KEEP, k=5)


def test_rows_without_a_place_are_left_out(crimes, found):
    assert valid_points(crimes, "latitude", "longitude").count() == 3000
    assert found.rows == found.assigned.count() == 3000
    assert found.profile.agg(F.sum("crime_count")).first()[0] == 3000


def test_places_are_fewer_than_rows(crimes):
    places = place_counts(crimes, "latitude", "longitude", "primary_type")
    assert places.count() < 2100
    assert places.agg(F.sum("weight")).first()[0] == 3000


def test_scaling_equals_the_scaler_over_single_rows(crimes):
    scale = measure(place_counts(crimes, "latitude", "longitude", "primary_type"), "latitude", "longitude")
    vectors = VectorAssembler(inputCols=["latitude", "longitude"], outputCol="v").transform(
        valid_points(crimes, "latitude", "longitude")
    )
    scaler = StandardScaler(inputCol="v", outputCol="z", withMean=True, withStd=True).fit(vectors)
    assert [scale.lat.mean, scale.lon.mean] == pytest.approx(list(scaler.mean), abs=1e-12)
    assert [scale.lat.deviation, scale.lon.deviation] == pytest.approx(list(scaler.std), abs=1e-12)
    z = np.array([r[0].toArray() for r in scaler.transform(vectors).orderBy("id").select("z").limit(50).collect()])
    ours = (
        valid_points(crimes, "latitude", "longitude").orderBy("id").limit(50)
        .select(F.expr(scale.lat.scaled("latitude")), F.expr(scale.lon.scaled("longitude")))
    )
    assert np.allclose(z, np.array(ours.collect()), atol=1e-12)


def brute_force(points, centres, rounds=100):
    """Lloyd's algorithm over single rows."""
    for _ in range(rounds):
        label = ((points[:, None, :] - centres[None]) ** 2).sum(-1).argmin(1)
        centres = np.array([points[label == c].mean(0) if (label == c).any() else centres[c] for c in range(len(centres))])
    return centres, label


def test_weighted_places_give_the_clusters_of_single_rows(found):
    """From our centres, brute force over the single rows moves nowhere and assigns every row alike."""
    rows = found.model.stages[0].transform(found.assigned).orderBy("id").collect()
    points = np.array([(r["_lat_z"], r["_lon_z"]) for r in rows])
    centres = np.array(found.model.stages[-1].clusterCenters())
    settled, label = brute_force(points, centres)
    assert np.allclose(settled, centres, atol=1e-3)
    assert (label == np.array([r["cluster_id"] for r in rows])).all()


def test_quality_is_that_of_brute_force(found):
    rows = found.model.stages[0].transform(found.assigned).collect()
    points = np.array([(r["_lat_z"], r["_lon_z"]) for r in rows])

    def cost(centres):
        return ((points[:, None, :] - centres[None]) ** 2).sum(-1).min(1).sum()

    rng = np.random.default_rng(0)
    best = min(cost(brute_force(points, points[rng.choice(len(points), 5, replace=False)])[0]) for _ in range(10))
    assert cost(np.array(found.model.stages[-1].clusterCenters())) <= best * 1.05


def test_centres_are_coordinates(found):
    for row in found.profile.collect():
        assert row.model_center_lat == pytest.approx(row.avg_lat, abs=1e-4)
        assert row.model_center_lon == pytest.approx(row.avg_lon, abs=1e-4)
        assert abs(row.model_center_lat_scaled) < 10


def test_profile_describes_the_members(found):
    members = {
        r.cluster_id: r
        for r in found.assigned.groupBy("cluster_id").agg(
            F.count("*").alias("n"),
            F.count_distinct("primary_type").alias("types"),
            F.round(F.avg("latitude"), 6).alias("lat"),
            F.round(F.sum(F.when(F.col("primary_type").isin("HOMICIDE", "BATTERY"), 1).otherwise(0)) * 100.0 / F.count("*"), 2)
            .alias("violent"),
        ).collect()
    }
    profile = found.profile.collect()
    assert [r.crime_count for r in profile] == sorted((r.crime_count for r in profile), reverse=True)
    for row in profile:
        m = members[row.cluster_id]
        assert (row.crime_count, row.unique_crime_types, row.violent_crime_pct) == (m.n, m.types, m.violent)
        assert row.avg_lat == pytest.approx(m.lat, abs=2e-6)


def test_layout_of_the_input_does_not_matter(crimes, found):
    again = hotspots(crimes.orderBy(F.rand(3)).repartition(11), keep=KEEP, k=5)
    ours = {r.id: r.cluster_id for r in found.assigned.collect()}
    assert {r.id: r.cluster_id for r in again.assigned.collect()} == ours


def test_model_can_be_stored(found, tmp_path):
    found.model.save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    rows = found.assigned.select(*KEEP)
    assert {r.id: r.cluster_id for r in loaded.transform(rows).collect()} == {
        r.id: r.cluster_id for r in found.assigned.collect()
    }


def test_fewer_rows_than_clusters_give_nothing(crimes):
    assert crime_hotspots(crimes.filter("id < 4 or id > 9000"), k=10) == {}
    assert crime_hotspots(crimes.filter("id > 9000"), k=1) == {}


def test_fewer_places_than_clusters(crimes):
    found = hotspots(crimes.filter("id % 3 = 0 and id < 9000"), keep=KEEP, k=10)
    assert found.profile.count() == 1
    assert found.assigned.select("cluster_id").distinct().count() == 1
