import os
import subprocess
import sys
import uuid

import duckdb
import pytest

from casebook.plans import job
from casebook.plans.job import input_paths, main, run
from casebook.plans.manifest import Manifest, fingerprint
from casebook.session import drop_scratch, scratch, scratch_folder, written
from casebook.sinks.jdbc import JdbcTarget, write_table
from casebook.sources.csv import MissingInput
from incident_files import crimes_sql, write_files

TABLES = {
    "yearly_trends", "monthly_trends", "monthly_trends_by_year", "hourly_trends", "day_of_week_trends",
    "arrest_rate_by_crime_type", "arrest_rate_by_district", "arrest_rate_by_race", "arrest_rate_by_race_detailed",
    "crimes_join_arrests", "crimes_join_stations", "crime_hotspots_kmeans", "crimes_with_clusters",
    "correlation_violence_arrest_by_district", "crime_station_distance_by_district",
    "correlation_offenders_crime_by_block",
}


@pytest.fixture(scope="module")
def done(spark, small, tmp_path_factory):
    """The whole job on files made from the test tables, into an embedded database."""
    folder = str(tmp_path_factory.mktemp("inputs"))
    write_files(small, folder)
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    target = JdbcTarget(
        f"jdbc:derby:memory:job_{uuid.uuid4().hex};create=true",
        {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"},
        connections=2,
    )
    report = run(spark, input_paths(folder), lambda df, name: write_table(df, name, target))
    return report, target


@pytest.fixture(scope="module")
def sql(small):
    connection = duckdb.connect()
    connection.execute(f"create table crimes as {crimes_sql(small)}")
    for name in ("lineitem", "events", "customer", "nation"):
        connection.execute(f"create view {name} as select * from '{small}/{name}.parquet'")
    connection.execute("""
        create view arrests as select 'C' || l_orderkey as case_number,
            case l_returnflag when 'N' then 'WHITE' when 'A' then 'BLACK' end as race from lineitem
    """)
    return lambda text: set(connection.execute(text).fetchall())


def test_all_tables_are_written(spark, done):
    report, target = done
    assert set(report.rows) == TABLES
    for name, rows in report.rows.items():
        assert target.count(spark, name) == rows > 0


def test_profiles(done):
    profiles = done[0].profiles
    assert profiles["crimes"]["rows_in"] == 1500
    assert profiles["crimes"]["missing_required"] == 30
    assert profiles["police_stations"]["kept"] == 25
    assert all(p["malformed"] == 0 for p in profiles.values())


@pytest.mark.parametrize(
    "name, columns, expected",
    [
        (key + "_trends", [key, "total_crimes", "total_arrests"],
         f"select {column}, count(*), sum(arrest::int) from crimes group by 1")
        for key, column in (("hour", "hour"), ("month", "month"), ("day_of_week", "day_of_week"))
    ],
)
def test_trends(spark, done, sql, name, columns, expected):
    name = {"hour_trends": "hourly_trends", "month_trends": "monthly_trends"}.get(name, name)
    actual = done[1].read(spark, name).select(*columns).collect()
    assert set(map(tuple, actual)) == sql(expected)


CHECKS = {
    "yearly_trends": """
        select year, count(*), sum(arrest::int), round(sum(arrest::int)*100e0/count(*), 2) from crimes group by 1""",
    "monthly_trends_by_year": "select year, month, count(*), sum(arrest::int) from crimes group by 1, 2",
    "arrest_rate_by_crime_type": """
        select primary_type, count(*), sum(arrest::int), round(sum(arrest::int)*100e0/count(*), 2)
        from crimes group by 1""",
    "arrest_rate_by_district": """
        select district, count(*), sum(arrest::int), round(sum(arrest::int)*100e0/count(*), 2)
        from crimes group by 1""",
    "arrest_rate_by_race": "select race, count(*) from arrests group by 1",
    "arrest_rate_by_race_detailed": """
        select race, count(*), sum(arrest::int), round(sum(arrest::int)*100e0/count(*), 2)
        from crimes join (select distinct * from arrests where race is not null) using (case_number) group by 1""",
    "correlation_violence_arrest_by_district": """
        with v as (select user_id % 28 as district, count(*) as n from events where event_type <> 'click' group by 1),
             c as (select district, count(*) as t, sum(arrest::int) as a from crimes group by 1),
             j as (select coalesce(c.district, v.district) as district, coalesce(t, 0) as t, coalesce(a, 0) as a,
                          coalesce(n, 0) as n from c full join v on c.district = v.district)
        select district, t, a, n, case when t = 0 then 0 else round(a*1e0/t, 4) end,
               case when t = 0 then 0 else round(n*1e0/t, 4) end, case when t > 0 then round(n*1000e0/t, 2) end from j""",
    "correlation_offenders_crime_by_block": """
        with o as (select lpad(cast(c_custkey % 60 as varchar), 3, '0') as block_key, count(*) as n
                   from customer group by 1)
        select c.block_key, count(*), max(coalesce(n, 0)) from crimes c left join o on c.block_key = o.block_key
        group by 1""",
    "crime_station_distance_by_district": """
        with s as (select case when n_nationkey < 24 then 41.6e0 + n_nationkey/100e0 end as lat,
                          -87.9e0 + n_nationkey/100e0 as lon, n_nationkey as k from nation),
             d as (select district, (latitude-lat)*111000e0 as dy,
                          (longitude-lon)*111000e0*cos(radians(latitude)) as dx
                   from crimes left join s on district = k)
        select district, round(avg(round(sqrt(dx*dx+dy*dy), 2)), 2), count(*) from d group by 1""",
}


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_table_agrees_with_sql(spark, done, sql, name):
    assert set(map(tuple, done[1].read(spark, name).collect())) == sql(CHECKS[name])


def test_joined_tables(spark, done, sql):
    report, target = done
    assert {(report.rows["crimes_join_arrests"],)} == sql("select count(*) from crimes join arrests using (case_number)")
    joined = target.read(spark, "crimes_join_arrests")
    assert joined.columns == [
        "case_number", "date", "primary_type", "description", "arrest", "domestic", "district", "ward",
        "community_area", "latitude", "longitude", "year", "month", "hour", "day_of_week", "arrest_date", "race",
        "charge_1_description", "charge_1_type", "charge_1_class", "charges_description", "charges_type",
        "charges_class",
    ]
    assert joined.select("description").distinct().collect()[0][0] == 'said "hi", left'
    stations = target.read(spark, "crimes_join_stations")
    assert stations.columns == [
        "case_number", "date", "primary_type", "arrest", "district", "latitude", "longitude", "year",
        "district_name", "station_address", "station_lat", "station_lon", "phone", "zip",
    ]
    assert {(report.rows["crimes_join_stations"],)} == sql("select count(*) from crimes")
    pairs = stations.select("district", "district_name", "station_address", "zip").distinct().collect()
    assert set(map(tuple, pairs)) == sql("""
        select distinct district, n_name, n_nationkey || ' Example Ave' || chr(10), '0' || (6000 + n_nationkey)
        from crimes left join nation on district = n_nationkey
    """)


def test_hotspots(spark, done, sql):
    report, target = done
    assert {(report.rows["crimes_with_clusters"],)} == sql("select count(*) from crimes where latitude <> 0")
    profile = target.read(spark, "crime_hotspots_kmeans")
    assert profile.columns[:8] == [
        "cluster_id", "crime_count", "avg_lat", "avg_lon", "unique_crime_types", "violent_crime_pct",
        "model_center_lat", "model_center_lon",
    ]
    assert report.rows["crime_hotspots_kmeans"] == 10
    assert {(profile.agg({"crime_count": "sum"}).first()[0],)} == sql("select count(*) from crimes where latitude <> 0")


def test_correlations(done, sql):
    correlations = done[0].correlations
    assert set(correlations) == {"correlation_violence_arrest_by_district", "correlation_offenders_crime_by_block"}
    for name, (x, y) in {
        "correlation_violence_arrest_by_district": ("c6", "c5"), "correlation_offenders_crime_by_block": ("c2", "c3"),
    }.items():
        width = 7 if "district" in name else 3
        names = ", ".join(f"c{i}" for i in range(1, width + 1))
        (expected,) = sql(f"select corr({x}, {y}) from ({CHECKS[name]}) t({names})")
        assert correlations[name] == pytest.approx(expected[0], abs=1e-9)


def test_a_stopped_run_goes_on_at_the_next_table(spark, small, tmp_path, monkeypatch, done):
    """Nothing staged is parsed again and nothing written is written again; other inputs begin anew."""
    inputs, folder = tmp_path / "inputs", str(tmp_path / "run")
    inputs.mkdir()
    write_files(small, str(inputs))
    written_tables, parsed = [], []
    load = job.load_csv
    monkeypatch.setattr(job, "load_csv", lambda spark, path, spec, **rest: parsed.append(spec.name) or load(spark, path, spec, **rest))

    def write(df, name):
        if len(written_tables) == stop:
            raise RuntimeError("stopped")
        written_tables.append(name)
        return df.count()

    for stop, stopped in ((9, True), (10, True), (None, False)):
        if stopped:
            with pytest.raises(RuntimeError, match="stopped"):
                run(spark, input_paths(str(inputs)), write, manifest=Manifest(spark, folder))
        else:
            report = run(spark, input_paths(str(inputs)), write, manifest=Manifest(spark, folder))
    assert len(written_tables) == len(set(written_tables)) == len(TABLES) and len(parsed) == len(set(parsed)) == 5
    assert report.rows == done[0].rows and report.profiles == done[0].profiles
    assert report.correlations == pytest.approx(done[0].correlations)
    manifest = Manifest(spark, folder)
    assert manifest.facts("result-yearly_trends") == {"rows": report.rows["yearly_trends"]}
    manifest.begin("other inputs")
    assert manifest.facts("result-yearly_trends") is None and not os.path.exists(manifest.table("crimes"))
    manifest.clear()
    assert not os.path.exists(folder)


def test_changed_inputs_have_another_fingerprint(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1")
    first = fingerprint(spark, [str(tmp_path)])
    assert fingerprint(spark, [str(tmp_path)]) == first
    (tmp_path / "b.csv").write_text("2")
    assert fingerprint(spark, [str(tmp_path)]) != first


def test_the_program_leaves_what_a_failed_run_finished(spark, small, tmp_path, monkeypatch):
    """And nothing when it ends."""
    (tmp_path / "inputs").mkdir()
    write_files(small, str(tmp_path / "inputs"))
    shared = tmp_path / "shared"
    monkeypatch.setattr(job, "shared_folder", lambda spark: str(shared))
    monkeypatch.setattr(job, "build_session", lambda: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    monkeypatch.setattr(job, "drop_scratch", lambda spark: None)
    for name, value in {"PG_URL": "jdbc:postgresql://nowhere/db", "DATA_DIR": str(tmp_path / "inputs")}.items():
        monkeypatch.setenv(name, value)
    calls = []

    def write(df, name, target):
        calls.append(name)
        if len(calls) == 3:
            raise RuntimeError("no database")
        return df.count()

    monkeypatch.setattr(job, "write_table", write)
    with pytest.raises(RuntimeError):
        main()
    [left] = (shared / "casebook" / "runs").iterdir()
    assert (left / "result-yearly_trends.json").exists()
    assert main() == 0 and len(calls) == len(TABLES) + 1
    assert not left.exists()


def test_missing_inputs_stop_the_job(spark, tmp_path):
    with pytest.raises(MissingInput) as error:
        run(spark, input_paths(str(tmp_path)), lambda df, name: 0)
    assert all(path in str(error.value) for path in input_paths(str(tmp_path)).values())


def test_database_address_is_required(monkeypatch):
    monkeypatch.delenv("PG_URL", raising=False)
    assert main() == 1


def test_scratch_can_be_dropped(spark, tmp_path, monkeypatch):
    assert scratch_folder(spark).endswith(spark.sparkContext.applicationId)
    monkeypatch.setattr("casebook.session.scratch_folder", lambda spark: f"file://{tmp_path}/scratch")
    written(spark.range(3), "kept")
    assert os.listdir(tmp_path) == ["scratch"]
    drop_scratch(spark)
    assert os.listdir(tmp_path) == []


def test_scratch_goes_when_work_fails(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("casebook.session.scratch_folder", lambda spark: f"file://{tmp_path}/scratch")
    with pytest.raises(ZeroDivisionError), scratch(spark):
        written(spark.range(3), "left")
        assert os.listdir(tmp_path) == ["scratch"]
        1 / 0
    assert os.listdir(tmp_path) == []


def test_preview_is_logged(spark, small, tmp_path, caplog):
    write_files(small, str(tmp_path))
    with caplog.at_level("INFO", logger="casebook"):
        run(spark, input_paths(str(tmp_path)), lambda df, name: 1, preview=2)
    assert sum(m.startswith("yearly_trends: Row(") for m in caplog.messages) == 2


def test_job_as_a_program_names_all_missing_files(tmp_path):
    done = subprocess.run(
        [sys.executable, "-m", "casebook"],
        cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
        env={**os.environ, "DATA_DIR": str(tmp_path), "OUTPUT_DIR": str(tmp_path), "PG_URL": "jdbc:postgresql://nowhere/db"},
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert done.returncode == 1
    assert all(path in done.stderr for path in input_paths(str(tmp_path)).values())
