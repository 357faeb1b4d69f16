"""The result tables of the job, from stand-ins that bear the job's column names, beside their SQL.

Orders stand in for crimes, lines for arrests, nations for stations and customers for the other two.
Every query runs the function that writes the table in the job, over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.operators.distance import distance_by_key
from casebook.operators.joining import attach_dimension
from casebook.plans import reports
from casebook.plans.checks import (
    CUSTOMER_PLACE,
    ORACLE_SQL,
    STATION_PLACE,
    as_sql,
    check,
    jdbc_target,
    join_facts_events,
    selected,
    table,
)
from casebook.session import scratch_path
from casebook.sinks.jdbc import JdbcTarget, write_table
from casebook.sources.csv import RAW_LINE, load_csv
from casebook.sources.specs import DatasetSpec

# Ten far apart places with a small spread around each, so that any right clustering is the same.
CRIMES = {
    "id": "cast(o_orderkey as int)",
    "case_number": "concat('C', cast(o_orderkey as string))",
    "date": "o_orderdate",
    "primary_type": """case o_orderkey % 5 when 0 then 'HOMICIDE' when 1 then 'ASSAULT' when 2 then 'THEFT'
                       when 3 then 'BURGLARY' end""",
    "description": "o_orderpriority",
    "arrest": "o_orderstatus = 'F'",
    "domestic": "o_orderstatus = 'P'",
    "district": "case when o_custkey % 31 < 30 then cast(o_custkey % 31 as int) end",
    "ward": "cast(o_custkey % 50 as int)",
    "community_area": "cast(o_custkey % 77 as int)",
    "latitude": "10e0 + (o_orderkey % 10) * 7 + (o_orderkey % 13) / 1000e0",
    "longitude": "-80e0 + ((o_orderkey % 10) * 3 % 10) * 11 + (o_orderkey % 17) / 1000e0",
    "year": "cast(year(o_orderdate) as int)",
    "month": "cast(month(o_orderdate) as int)",
    "hour": "cast(o_orderkey % 24 as int)",
    "day_of_week": "cast(o_orderkey % 7 + 1 as int)",
    "block": "concat(case when o_orderkey % 4 = 0 then '' else cast(o_orderkey % 60 as string) end, 'XX S WOOD ST')",
}
ARRESTS = {
    "case_number": "concat('C', cast(l_orderkey as string))",
    "arrest_date": "l_shipdate",
    "race": "case l_linenumber % 4 when 0 then null when 1 then 'A' when 2 then l_returnflag else 'B' end",
    "charge_1_description": "l_linestatus",
    "charge_1_type": "l_returnflag",
    "charge_1_class": "cast(l_linenumber as string)",
    "charges_description": "concat(l_linestatus, l_returnflag)",
    "charges_type": "l_returnflag",
    "charges_class": "cast(null as string)",
}
STATIONS = {
    "district_clean": "n_nationkey",
    "district_name": "n_name",
    "address": "concat(n_name, ' AVE')",
    "latitude": "20e0 + n_nationkey / 10e0",
    "longitude": "-60e0 + n_nationkey / 20e0",
    "phone": "cast(n_regionkey as string)",
    "zip": "concat('0', cast(n_nationkey as string))",
}
VIOLENCE = {"district": "cast(c_custkey % 40 as int)"}
OFFENDERS = {"block": "concat(cast(c_custkey % 90 as string), 'XX N OAK')"}

STAND_INS = f"""
with c as (select {as_sql(CRIMES)} from orders), a as (select {as_sql(ARRESTS)} from lineitem),
     s as (select {as_sql(STATIONS)} from nation), v as (select {as_sql(VIOLENCE)} from customer),
     o as (select {as_sql(OFFENDERS)} from customer)
"""


def crimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selected(table(spark, sf_dir, "orders"), CRIMES)


def arrests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selected(table(spark, sf_dir, "lineitem"), ARRESTS)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selected(table(spark, sf_dir, "nation"), STATIONS)


def job_query(name: str, sql: str, tables) -> None:
    """Register one result table of the job under ``job_<name>``."""

    def query(spark, sf_dir):
        return tables(spark, sf_dir)[name]

    query.__name__ = f"job_{name}"
    check(STAND_INS + sql)(query)


def trends(spark, sf_dir):
    return reports.crime_trends(reports.time_counts(crimes(spark, sf_dir)))


COUNTS = "count(*) as {total}, sum(case when arrest then 1 else 0 end) as total_arrests"
RATE = "round(sum(case when arrest then 1 else 0 end)*100e0/count(*),2) as arrest_rate_pct"


def counted(keys: str, total: str, rate: bool) -> str:
    whole = f"select {keys}, {COUNTS.format(total=total)}" + (f", {RATE}" if rate else "") + f" from c group by {keys}"
    return f"select * replace (cast(total_arrests as bigint) as total_arrests) from ({whole})"


job_query("yearly_trends", counted("year", "total_crimes", True), trends)
job_query("monthly_trends", counted("month", "total_crimes", False), trends)
job_query("monthly_trends_by_year", counted("year, month", "total_crimes", False), trends)
job_query("hourly_trends", counted("hour", "total_crimes", False), trends)
job_query("day_of_week_trends", counted("day_of_week", "total_crimes", False), trends)


def rates(spark, sf_dir):
    facts = crimes(spark, sf_dir)
    return reports.arrest_rates(reports.place_counts(facts), facts, arrests(spark, sf_dir))


job_query("arrest_rate_by_crime_type", counted("primary_type", "total_incidents", True), rates)
job_query("arrest_rate_by_district", counted("district", "total_incidents", True), rates)
job_query("arrest_rate_by_race", "select race, count(*) as total_arrests from a group by race", rates)
job_query(
    "arrest_rate_by_race_detailed",
    f"""select race, count(*) as total_crime_incidents,
               cast(sum(case when arrest then 1 else 0 end) as bigint) as total_arrests, {RATE}
        from c join (select distinct case_number, race from a where race is not null) using (case_number) group by race""",
    rates,
)


def joins(spark, sf_dir):
    return reports.dataset_joins(crimes(spark, sf_dir), arrests(spark, sf_dir), stations(spark, sf_dir))


job_query(
    "crimes_join_arrests",
    f"""select case_number, {", ".join(reports.CRIME_COLUMNS)}, {", ".join(reports.ARREST_COLUMNS)}
        from c join a using (case_number)""",
    joins,
)
job_query(
    "crimes_join_stations",
    f"""select {", ".join("c." + name for name in reports.CRIME_COLUMNS_FOR_STATIONS)},
               {", ".join(f"s.{name} as {alias}" for name, alias in reports.STATION_COLUMNS.items())}
        from c left join s on c.district = s.district_clean""",
    joins,
)


def clusters(spark, sf_dir):
    """The tables of the clustering with clusters numbered by the latitude of their centres, ten rows."""
    found = reports.crime_hotspots(crimes(spark, sf_dir))
    profile = found["crime_hotspots_kmeans"]
    number = F.row_number().over(Window.orderBy("model_center_lat")) - 1
    names = profile.select(F.col("cluster_id").alias("found_id"), number.alias("number"))

    def renamed(df: DataFrame) -> DataFrame:
        joined = df.join(F.broadcast(names), F.col("cluster_id") == F.col("found_id"))
        return joined.withColumn("cluster_id", F.col("number")).drop("found_id", "number")

    centres = [c for c in profile.columns if c.startswith("model_center")]
    rounded = renamed(profile).withColumns({c: F.round(c, 6) for c in centres})
    return {"crime_hotspots_kmeans": rounded, "crimes_with_clusters": renamed(found["crimes_with_clusters"])}


HOTSPOTS_SQL = """
, z as (select avg(latitude) as mlat, stddev_samp(latitude) as dlat, avg(longitude) as mlon, stddev_samp(longitude) as dlon from c),
g as (select cast(id % 10 as int) as cluster_id, count(*) as crime_count, avg(latitude) as lat, avg(longitude) as lon,
             count(distinct primary_type) as unique_crime_types,
             round(sum(case when primary_type in ('HOMICIDE','ASSAULT') then 1 else 0 end)*100e0/count(*),2) as violent_crime_pct
      from c group by id % 10)
select cluster_id, crime_count, round(lat,6) as avg_lat, round(lon,6) as avg_lon, unique_crime_types, violent_crime_pct,
       round(lat,6) as model_center_lat, round(lon,6) as model_center_lon,
       round((lat-mlat)/dlat,6) as model_center_lat_scaled, round((lon-mlon)/dlon,6) as model_center_lon_scaled
from g, z
"""
ASSIGNED_SQL = "select id, case_number, primary_type, district, latitude, longitude, cast(id % 10 as int) as cluster_id from c"
job_query("crime_hotspots_kmeans", HOTSPOTS_SQL, clusters)
job_query("crimes_with_clusters", ASSIGNED_SQL, clusters)


def comparisons(spark, sf_dir):
    facts = crimes(spark, sf_dir)
    return reports.correlations(
        reports.place_counts(facts), facts, selected(table(spark, sf_dir, "customer"), VIOLENCE), stations(spark, sf_dir),
        selected(table(spark, sf_dir, "customer"), OFFENDERS),
    )


job_query(
    "correlation_violence_arrest_by_district",
    """, f as (select district, count(*) as total_crimes, cast(sum(case when arrest then 1 else 0 end) as bigint) as total_arrests
              from c group by district),
       w as (select district, count(*) as violence_incidents from v group by district),
       j as (select coalesce(f.district, w.district) as district, coalesce(total_crimes,0) as total_crimes,
                    coalesce(total_arrests,0) as total_arrests, coalesce(violence_incidents,0) as violence_incidents
             from f full join w on f.district = w.district)
       select *, case when total_crimes=0 then 0e0 else round(total_arrests*1e0/total_crimes,4) end as arrest_rate,
              case when total_crimes=0 then 0e0 else round(violence_incidents*1e0/total_crimes,4) end as violence_rate,
              round(violence_incidents*1000e0/nullif(total_crimes,0),2) as violence_per_1000 from j""",
    comparisons,
)
job_query(
    "crime_station_distance_by_district",
    """, d as (select c.district, (c.latitude-s.latitude)*111000e0 as dy,
                     (c.longitude-s.longitude)*111000e0*cos(radians(c.latitude)) as dx
              from c left join s on c.district = s.district_clean)
       select district, round(avg(round(sqrt(dx*dx+dy*dy),2)),2) as avg_dist_to_station_m, count(*) as crime_count
       from d group by district""",
    comparisons,
)
job_query(
    "correlation_offenders_crime_by_block",
    """, x as (select regexp_extract(block,'^(\\d+)',1) as block_key, count(*) as crime_count from c group by 1),
       y as (select regexp_extract(block,'^(\\d+)',1) as block_key, count(*) as offender_count from o group by 1)
       select x.block_key, crime_count, coalesce(offender_count,0) as offender_count
       from x left join y on x.block_key = y.block_key""",
    comparisons,
)


# ---------------------------------------------------------------- the same results by other ways


@check(ORACLE_SQL["join_facts_dimension"])
def join_facts_dimension_shuffled(spark, sf_dir):
    """The dimension join for a dimension too large to broadcast."""
    facts = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("case_number"), F.col("c_nationkey").alias("district"), F.col("c_acctbal").alias("amount")
    )
    nations = table(spark, sf_dir, "nation").withColumn("district_clean", F.col("n_nationkey") + 5)
    return attach_dimension(facts, nations, "district", "district_clean", {"n_name": "district_name"}, max_bytes=0)


@check(ORACLE_SQL["station_distance"])
def station_distance_shuffled(spark, sf_dir):
    """Distances with the stations joined by shuffle."""
    return distance_by_key(
        selected(table(spark, sf_dir, "customer"), CUSTOMER_PLACE), selected(table(spark, sf_dir, "nation"), STATION_PLACE),
        "district", "district_clean", max_bytes=0,
    )


@check(ORACLE_SQL["join_facts_events"])
def jdbc_join_roundtrip(spark, sf_dir):
    """The fact-event join through a database with two connections at most, appended in halves, read by ranges."""
    found = jdbc_target(spark)
    target = JdbcTarget(found.url, found.properties, 2)
    joined = join_facts_events(spark, sf_dir)
    write_table(joined.filter("case_number % 2 = 0"), "joined", target)
    write_table(joined.filter("case_number % 2 = 1"), "joined", target, mode="append")
    read = target.read(spark, "joined", "case_number", 4)
    return read.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("event_date", "arrest_date")})


# Orders in process open a quote that nothing closes; urgent ones hold a line break.
OPEN_LINE = {
    "value": """concat(cast(o_orderkey as string), ',',
                  case when o_orderstatus = 'P' then '"5 in pipe' when o_orderpriority = '1-URGENT' then '"two\nlines"'
                       else o_orderpriority end, ',', o_orderstatus)""",
}
OPEN_FILE = DatasetSpec(
    name="open_file", file_name="open", headers=("ID", "NOTE", "STATUS"), has_header=False,
    conversions={"id": lambda text: text.try_cast("bigint")},
)


@check("""
select o_orderkey as id, o_orderstatus = 'P' as malformed,
       case when o_orderstatus = 'P' then null when o_orderpriority = '1-URGENT' then concat('two', chr(10), 'lines')
            else o_orderpriority end as note
from orders
""")
def csv_unclosed_quote(spark, sf_dir):
    """Every order as a row, though some lines open a quote that never closes, between records of two lines."""
    path = scratch_path(spark, "open_csv")
    selected(table(spark, sf_dir, "orders"), OPEN_LINE).write.text(path)
    loaded = load_csv(spark, path, OPEN_FILE)
    raw = loaded.malformed.select(F.regexp_extract(RAW_LINE, r"^(\d+),", 1).cast("bigint").alias("raw_id"))
    rows = loaded.rows.join(raw, F.col("id") == F.col("raw_id"), "left")
    malformed = F.col("raw_id").isNotNull()
    return rows.select("id", malformed.alias("malformed"), F.when(~malformed, F.col("note")).alias("note"))


@check(STAND_INS + HOTSPOTS_SQL)
def kmeans_hotspots(spark, sf_dir):
    return clusters(spark, sf_dir)["crime_hotspots_kmeans"]


@check(STAND_INS + ASSIGNED_SQL)
def kmeans_assign(spark, sf_dir):
    return clusters(spark, sf_dir)["crimes_with_clusters"]
