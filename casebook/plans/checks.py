"""The operators on the test tables, each beside the SQL it must agree with.

The test tables hold no incident data, so orders, lines, events and customers stand in for it.
Every query reads whole tables. Where an operator needs messy input, the mess is an expression
over the table's rows, written once in SQL that both engines understand.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.functions import casts
from casebook.functions.cleaning import upper_category
from casebook.functions.rates import ones
from casebook.operators import hotspots as clusters
from casebook.operators.correlation import keyed_correlation
from casebook.operators.counting import (
    count_by,
    distinct_pairs,
    flag_counts,
    flag_counts_by_event_category,
    preview,
    rate_table,
    row_profile,
)
from casebook.operators.distance import distance_by_key
from casebook.operators.hotspots import Hotspots, valid_points
from casebook.operators.joining import attach_dimension, join_events
from casebook.plans import reports
from casebook.session import is_local, scratch_path, written
from casebook.sinks.jdbc import JdbcTarget, write_table
from casebook.sources.csv import (
    KEPT,
    RAW_LINE,
    ROW_STATE,
    any_value,
    clean_columns,
    load_csv,
    row_state,
    state_counts,
)
from casebook.sources.specs import DatasetSpec

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def check(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL where there is one."""

    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql:
            ORACLE_SQL[query.__name__] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def selected(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """SQL expressions under names; the same dictionary goes into the oracle through ``as_sql``."""
    return df.select(*(F.expr(sql).alias(name) for name, sql in columns.items()))


def as_sql(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} as {name}" for name, sql in columns.items())


# ---------------------------------------------------------------- trends and rates


def order_trend(spark: SparkSession, sf_dir: str, keys: dict[str, Column], rate: str | None = None) -> DataFrame:
    counts = flag_counts(
        table(spark, sf_dir, "orders"),
        [column.alias(name) for name, column in keys.items()],
        F.col("o_orderstatus") == "F",
    )
    return rate_table(
        counts, list(keys), total="total_crimes", flagged="total_arrests", rate=rate
    ).orderBy(*keys)


def event_trend(spark: SparkSession, sf_dir: str, name: str, key: Column) -> DataFrame:
    counts = flag_counts(table(spark, sf_dir, "events"), [key.alias(name)], F.col("event_type") == "error")
    return rate_table(counts, [name], total="total_crimes", flagged="total_arrests").orderBy(name)


YEARLY_SQL = """
select cast(year(o_orderdate) as integer) as year, count(*) as total_crimes,
       cast(sum(case when o_orderstatus='F' then 1 else 0 end) as bigint) as total_arrests,
       round(sum(case when o_orderstatus='F' then 1 else 0 end)*100e0/count(*),2) as arrest_rate_pct
from orders group by 1
"""


@check(YEARLY_SQL)
def yearly_trends(spark, sf_dir):
    return order_trend(spark, sf_dir, {"year": F.year("o_orderdate")}, rate="arrest_rate_pct")


@check("""
select cast(month(o_orderdate) as integer) as month, count(*) as total_crimes,
       cast(sum(case when o_orderstatus='F' then 1 else 0 end) as bigint) as total_arrests
from orders group by 1
""")
def monthly_trends(spark, sf_dir):
    return order_trend(spark, sf_dir, {"month": F.month("o_orderdate")})


@check("""
select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month, count(*) as total_crimes,
       cast(sum(case when o_orderstatus='F' then 1 else 0 end) as bigint) as total_arrests
from orders group by 1,2
""")
def monthly_trends_by_year(spark, sf_dir):
    return order_trend(spark, sf_dir, {"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})


@check("""
select cast(hour(ts) as integer) as hour, count(*) as total_crimes,
       cast(sum(case when event_type='error' then 1 else 0 end) as bigint) as total_arrests
from events group by 1
""")
def hourly_trends(spark, sf_dir):
    return event_trend(spark, sf_dir, "hour", F.hour("ts"))


@check("""
select cast(dayofweek(ts)+1 as integer) as day_of_week, count(*) as total_crimes,
       cast(sum(case when event_type='error' then 1 else 0 end) as bigint) as total_arrests
from events group by 1
""")
def day_of_week_trends(spark, sf_dir):
    return event_trend(spark, sf_dir, "day_of_week", F.dayofweek("ts"))


@check("""
with c as (select cast(year(ts) as integer) as year, cast(month(ts) as integer) as month,
                  cast(hour(ts) as integer) as hour, cast(dayofweek(ts)+1 as integer) as day_of_week,
                  case when event_type='error' then 1 else 0 end as arrest from events)
select 'year' as trend, year as key, count(*) as total_crimes, cast(sum(arrest) as bigint) as total_arrests
from c group by year
union all select 'month', month, count(*), cast(sum(arrest) as bigint) from c group by month
union all select 'hour', hour, count(*), cast(sum(arrest) as bigint) from c group by hour
union all select 'day_of_week', day_of_week, count(*), cast(sum(arrest) as bigint) from c group by day_of_week
""")
def shared_trends(spark, sf_dir):
    """The trends of the batch job: rolled up from one pass over the rows, not one pass each."""
    crimes = table(spark, sf_dir, "events").select(
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.hour("ts").alias("hour"),
        F.dayofweek("ts").alias("day_of_week"),
        (F.col("event_type") == "error").alias("arrest"),
    )
    trends = reports.crime_trends(written(reports.time_counts(crimes), "time_counts"))
    parts = [
        trends[name].select(F.lit(key).alias("trend"), F.col(key).alias("key"), "total_crimes", "total_arrests")
        for key, name in (
            ("year", "yearly_trends"),
            ("month", "monthly_trends"),
            ("hour", "hourly_trends"),
            ("day_of_week", "day_of_week_trends"),
        )
    ]
    return reduce(DataFrame.unionByName, parts)


@check("""
select o_orderpriority as primary_type, count(*) as total_incidents,
       cast(sum(case when o_orderstatus='F' then 1 else 0 end) as bigint) as total_arrests,
       round(sum(case when o_orderstatus='F' then 1 else 0 end)*100e0/count(*),2) as arrest_rate_pct
from orders group by 1
""")
def rate_by_type(spark, sf_dir):
    counts = flag_counts(
        table(spark, sf_dir, "orders"),
        [F.col("o_orderpriority").alias("primary_type")],
        F.col("o_orderstatus") == "F",
    )
    return rate_table(
        counts, ["primary_type"], total="total_incidents", flagged="total_arrests", rate="arrest_rate_pct"
    ).orderBy(F.desc("total_incidents"))


@check("""
select l_suppkey as district, count(*) as total_incidents,
       cast(sum(case when l_returnflag='R' then 1 else 0 end) as bigint) as total_arrests,
       round(sum(case when l_returnflag='R' then 1 else 0 end)*100e0/count(*),2) as arrest_rate_pct
from lineitem group by 1
""")
def rate_by_district(spark, sf_dir):
    counts = flag_counts(
        table(spark, sf_dir, "lineitem"), [F.col("l_suppkey").alias("district")], F.col("l_returnflag") == "R"
    )
    return rate_table(
        counts, ["district"], total="total_incidents", flagged="total_arrests", rate="arrest_rate_pct"
    ).orderBy("district")


@check("select nullif(l_returnflag,'N') as race, count(*) as total_arrests from lineitem group by 1")
def count_by_category(spark, sf_dir):
    race = F.nullif(F.col("l_returnflag"), F.lit("N")).alias("race")
    return count_by(table(spark, sf_dir, "lineitem"), [race], "total_arrests").orderBy(F.desc("total_arrests"))


@check("""
select c.l_returnflag as race, count(*) as total_crime_incidents,
       cast(sum(case when o.o_orderstatus='F' then 1 else 0 end) as bigint) as total_arrests,
       round(sum(case when o.o_orderstatus='F' then 1 else 0 end)*100e0/count(*),2) as arrest_rate_pct
from orders o left join (select distinct l_orderkey, l_returnflag from lineitem) c on o.o_orderkey=c.l_orderkey
where c.l_returnflag is not null group by 1
""")
def rate_by_joined_category(spark, sf_dir):
    facts = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "case_number")
    events = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("case_number"), F.col("l_returnflag").alias("race")
    )
    counts = flag_counts_by_event_category(facts, events, "case_number", "race", F.col("o_orderstatus") == "F")
    return rate_table(
        counts, ["race"], total="total_crime_incidents", flagged="total_arrests", rate="arrest_rate_pct"
    ).orderBy(F.desc("total_crime_incidents"))


@check("select distinct l_orderkey, nullif(l_returnflag,'N') as race from lineitem where nullif(l_returnflag,'N') is not null")
def distinct_categories(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.nullif(F.col("l_returnflag"), F.lit("N")).alias("race")
    )
    return distinct_pairs(lines, "l_orderkey", "race")


@check("""
select l_suppkey as district, count(*) as total_incidents
from lineitem group by 1 order by total_incidents desc, district limit 5
""")
def top_preview(spark, sf_dir):
    counts = count_by(table(spark, sf_dir, "lineitem"), [F.col("l_suppkey").alias("district")], "total_incidents")
    return preview(counts, 5, F.desc("total_incidents"), "district")


# ---------------------------------------------------------------- joins


@check("""
select o.o_orderkey as case_number, o.o_orderdate as event_date, o.o_orderpriority as primary_type,
       l.l_returnflag as race, l.l_shipdate as arrest_date, l.l_linenumber as charge_no
from orders o join lineitem l on o.o_orderkey=l.l_orderkey
""")
def join_facts_events(spark, sf_dir):
    facts = table(spark, sf_dir, "orders").withColumnsRenamed(
        {"o_orderkey": "case_number", "o_orderdate": "event_date", "o_orderpriority": "primary_type"}
    )
    events = table(spark, sf_dir, "lineitem").withColumnsRenamed(
        {"l_orderkey": "case_number", "l_returnflag": "race", "l_shipdate": "arrest_date", "l_linenumber": "charge_no"}
    )
    return join_events(
        facts, events, "case_number", ["event_date", "primary_type"], ["race", "arrest_date", "charge_no"]
    )


# Nation keys are moved up by five, so that the first five customer nations find no match.
@check("""
select c.c_custkey as case_number, c.c_nationkey as district, c.c_acctbal as amount, n.n_name as district_name
from customer c left join nation n on c.c_nationkey = n.n_nationkey + 5
""")
def join_facts_dimension(spark, sf_dir):
    facts = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("case_number"),
        F.col("c_nationkey").alias("district"),
        F.col("c_acctbal").alias("amount"),
    )
    stations = table(spark, sf_dir, "nation").withColumn("district_clean", F.col("n_nationkey") + 5)
    return attach_dimension(facts, stations, "district", "district_clean", {"n_name": "district_name"})


# Supplier nations are moved up by three, so that each side of the outer join lacks keys of the other.
DISTRICT_SQL = """
with f as (select c_nationkey as district, count(*) as total_crimes,
                  cast(sum(case when c_acctbal<0 then 1 else 0 end) as bigint) as total_arrests
           from customer group by 1),
     v as (select s_nationkey+3 as district, count(*) as violence_incidents from supplier group by 1),
     j as (select coalesce(f.district, v.district) as district, coalesce(total_crimes,0) as total_crimes,
                  coalesce(total_arrests,0) as total_arrests, coalesce(violence_incidents,0) as violence_incidents
           from f full outer join v on f.district=v.district),
     r as (select district, total_crimes, total_arrests, violence_incidents,
                  case when total_crimes=0 then 0e0 else round(total_arrests*1e0/total_crimes,4) end as arrest_rate,
                  case when total_crimes=0 then 0e0 else round(violence_incidents*1e0/total_crimes,4) end as violence_rate,
                  case when total_crimes=0 then null else round(violence_incidents*1000e0/total_crimes,2) end as violence_per_1000
           from j)
"""


@check(DISTRICT_SQL + "select * from r")
def district_rates(spark, sf_dir):
    customers = flag_counts(
        table(spark, sf_dir, "customer"), [F.col("c_nationkey").alias("district")], F.col("c_acctbal") < 0
    )
    crimes = rate_table(customers, ["district"], total="total_crimes", flagged="total_arrests")
    violence = count_by(
        table(spark, sf_dir, "supplier"), [(F.col("s_nationkey") + 3).alias("district")], "violence_incidents"
    )
    return reports.district_comparison(crimes, violence)


# Rounded, so that the order of summation does not show.
@check(DISTRICT_SQL + "select round(corr(violence_rate, arrest_rate),6) as pearson_r from r")
def district_corr(spark, sf_dir):
    r = keyed_correlation(district_rates(spark, sf_dir), "violence_rate", "arrest_rate")
    return r.select(F.round("pearson_r", 6).alias("pearson_r"))


@check("""
with l as (select l_suppkey, sum(l_quantity) as x, case when l_suppkey < 0 then 1e0 else 0e0 end as y
           from lineitem group by l_suppkey)
select case when stddev_pop(x)*stddev_pop(y) = 0 then null else corr(x, y) end as pearson_r from l
""")
def constant_corr(spark, sf_dir):
    """A column that does not vary has no correlation; the result is null, not a failed job."""
    keyed = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.sum("l_quantity").alias("x"))
        .withColumn("y", F.when(F.col("l_suppkey") < 0, 1.0).otherwise(0.0))
    )
    return keyed_correlation(keyed, "x", "y")


@check("""
with l as (select l_suppkey, sum(case when l_suppkey % 3 > 0 then l_quantity end) as x,
                  sum(case when l_suppkey % 5 > 0 then l_extendedprice end) as y
           from lineitem group by l_suppkey)
select round(corr(x, y),6) as pearson_r from l
""")
def sparse_corr(spark, sf_dir):
    """Pairs that lack either value take no part, in the deviations of the other value neither."""
    keyed = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.when(F.col("l_suppkey") % 3 > 0, F.col("l_quantity"))).alias("x"),
        F.sum(F.when(F.col("l_suppkey") % 5 > 0, F.col("l_extendedprice"))).alias("y"),
    )
    return keyed_correlation(keyed, "x", "y").select(F.round("pearson_r", 6).alias("pearson_r"))


# ---------------------------------------------------------------- places

CUSTOMER_PLACE = {
    "district": "c_nationkey",
    "latitude": "41.6e0 + (c_custkey % 400) / 1000e0",
    "longitude": "-87.9e0 + (c_custkey % 700) / 1000e0",
}
STATION_PLACE = {
    "district_clean": "n_nationkey + 5",
    "latitude": "41.6e0 + n_nationkey / 100e0",
    "longitude": "-87.9e0 + n_nationkey / 50e0",
}


@check(f"""
with p as (select {as_sql(CUSTOMER_PLACE)} from customer),
     s as (select {as_sql(STATION_PLACE)} from nation),
     d as (select p.district, (p.latitude-s.latitude)*111000e0 as dy,
                  (p.longitude-s.longitude)*111000e0*cos(radians(p.latitude)) as dx
           from p left join s on p.district=s.district_clean)
select district, round(avg(round(sqrt(dx*dx+dy*dy),2)),2) as avg_dist_to_station_m, count(*) as crime_count
from d group by 1
""")
def station_distance(spark, sf_dir):
    return distance_by_key(
        selected(table(spark, sf_dir, "customer"), CUSTOMER_PLACE),
        selected(table(spark, sf_dir, "nation"), STATION_PLACE),
        "district",
        "district_clean",
    )


UNSURE_PLACE = {
    "c_custkey": "c_custkey",
    "latitude": """case c_mktsegment when 'BUILDING' then 0e0 when 'MACHINERY' then cast('NaN' as double)
                   when 'HOUSEHOLD' then null when 'FURNITURE' then
                     case c_custkey % 3 when 0 then cast('Infinity' as double) when 1 then cast('-Infinity' as double) else c_acctbal end
                   else c_acctbal end""",
    "longitude": "case when c_acctbal < 0 then null else c_acctbal end",
}


@check(f"""
with p as (select {as_sql(UNSURE_PLACE)} from customer)
select * from p where latitude is not null and longitude is not null
  and isfinite(latitude) and isfinite(longitude) and latitude <> 0 and longitude <> 0
""")
def valid_coordinates(spark, sf_dir):
    return valid_points(selected(table(spark, sf_dir, "customer"), UNSURE_PLACE), "latitude", "longitude")


# Two digits from 10 to 49 are block numbers here; all other events share the key "".
EVENT_BLOCK = '"k": ([1-4][0-9])'
OFFENDER_BLOCK = {
    "block": """case when c_mktsegment = 'BUILDING' then c_mktsegment
                else concat('"k": ', cast(c_nationkey + 30 as string)) end""",
}
PREFIX_SQL = f"""
with c as (select regexp_extract(props,'{EVENT_BLOCK}',1) as block_key, count(*) as crime_count from events group by 1),
     b as (select {as_sql(OFFENDER_BLOCK)} from customer),
     o as (select regexp_extract(block,'{EVENT_BLOCK}',1) as block_key, count(*) as offender_count from b group by 1),
     j as (select c.block_key, crime_count, coalesce(offender_count,0) as offender_count
           from c left join o on c.block_key=o.block_key)
"""


@check(PREFIX_SQL + "select * from j")
def prefix_density(spark, sf_dir):
    return reports.prefix_density(
        table(spark, sf_dir, "events").select(F.col("props").alias("block")),
        selected(table(spark, sf_dir, "customer"), OFFENDER_BLOCK),
        pattern=EVENT_BLOCK,
    )


@check(PREFIX_SQL + "select round(corr(crime_count, offender_count),6) as pearson_r from j")
def prefix_corr(spark, sf_dir):
    r = keyed_correlation(prefix_density(spark, sf_dir), "crime_count", "offender_count")
    return r.select(F.round("pearson_r", 6).alias("pearson_r"))


@check("""
select label as cluster_id, count(*) as crime_count, round(avg(cast(embedding[1] as double)),6) as avg_lat,
       round(avg(cast(embedding[2] as double)),6) as avg_lon, count(distinct vec_id%7) as unique_crime_types,
       round(sum(case when vec_id%7 in (0,1) then 1 else 0 end)*100e0/count(*),2) as violent_crime_pct
from embeddings group by 1
""")
def cluster_profile(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("cluster_id"),
        F.col("embedding")[0].cast("double").alias("lat"),
        F.col("embedding")[1].cast("double").alias("lon"),
        (F.col("vec_id") % 7).alias("kind"),
        F.lit(1).alias("weight"),
    )
    return clusters.cluster_profile(vectors, "cluster_id", "lat", "lon", "kind", (0, 1))


def part_hotspots(spark: SparkSession, sf_dir: str) -> Hotspots:
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_type").alias("primary_type"),
        F.col("p_size").cast("double").alias("latitude"),
        F.col("p_retailprice").alias("longitude"),
    )
    found = clusters.hotspots(
        parts,
        keep=("p_partkey", "primary_type", "latitude", "longitude"),
        violent=("ECONOMY", "PROMO"),
    )
    if found is None:
        raise ValueError("fewer parts than clusters")
    return found


@check("""
select count(*) as rows_valid, count(*) as rows_assigned, count(*) as rows_profiled,
       cast(0 as bigint) as not_nearest, cast(0 as bigint) as off_centre
from part where p_size <> 0 and p_retailprice <> 0
""")
def kmeans_invariants(spark, sf_dir):
    """What must hold for any clustering: no row is lost, every row sits at its nearest centre, and
    every centre is the mean of its members (to a hundredth of a standard deviation)."""
    found = part_hotspots(spark, sf_dir)
    centres = [(float(lat), float(lon)) for lat, lon in found.model.stages[-1].clusterCenters()]
    own = F.col("cluster_id") + 1
    squares = F.array(
        *((F.col("_lat_z") - lat) * (F.col("_lat_z") - lat) + (F.col("_lon_z") - lon) * (F.col("_lon_z") - lon)
          for lat, lon in centres)
    )
    standardise = found.model.stages[0]
    per_cluster = (
        standardise.transform(found.assigned)
        .groupBy("cluster_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(ones(F.element_at(squares, own) > F.array_min(squares) + 1e-9)).alias("not_nearest"),
            F.avg("_lat_z").alias("lat"),
            F.avg("_lon_z").alias("lon"),
        )
    )
    drift = F.greatest(
        *(
            F.abs(F.col(axis) - F.element_at(F.array(*(F.lit(centre[i]) for centre in centres)), own))
            for i, axis in enumerate(("lat", "lon"))
        )
    )
    sizes = found.profile.select("cluster_id", "crime_count")
    return per_cluster.join(sizes, "cluster_id", "left").agg(
        F.lit(found.rows).cast("bigint").alias("rows_valid"),
        F.sum("n").alias("rows_assigned"),
        F.sum("crime_count").alias("rows_profiled"),
        F.sum("not_nearest").alias("not_nearest"),
        F.sum(ones(drift > 0.01)).alias("off_centre"),
    )


# ---------------------------------------------------------------- cleaning and typing

NO_VALUE_SQL = "('','NULL','null','NA','N/A','#N/A','None','NONE')"

DIRTY_TEXT = {
    "id": "o_orderkey",
    "s": """case o_orderkey % 9
              when 0 then concat('  ', o_orderpriority, ' ') when 1 then 'N/A' when 2 then 'none'
              when 3 then '   ' when 4 then 'NULL' when 5 then '#N/A ' when 6 then concat(o_orderpriority, chr(9))
              when 7 then null else o_orderpriority end""",
    "r": "concat(' ', lower(o_orderpriority), '  ')",
}


@check(f"""
with d as (select {as_sql(DIRTY_TEXT)} from orders)
select id, case when trim(s) in {NO_VALUE_SQL} then null else trim(s) end as s, upper(trim(r)) as r from d
""")
def clean_strings(spark, sf_dir):
    cleaned = clean_columns(selected(table(spark, sf_dir, "orders"), DIRTY_TEXT))
    return cleaned.withColumn("r", upper_category(F.col("r")))


DIRTY_VALUES = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "flag": "case l_linenumber when 1 then 'TRUE' when 2 then 'false' when 3 then null when 4 then 'yes' else 'true' end",
    "district": """case l_returnflag when 'R' then 'Headquarters' when 'A' then concat('0', cast(l_suppkey as string))
                   else concat('x', cast(l_suppkey as string)) end""",
    "height": """case l_linenumber when 1 then cast(cast(l_quantity as int) as string)
                   when 2 then concat('5', lpad(cast(cast(l_quantity as int) as string), 2, '0'))
                   when 3 then concat('10', lpad(cast(cast(l_quantity as int) as string), 2, '0'))
                   when 4 then 'ab9' when 5 then null
                   else concat('6', lpad(cast(cast(l_quantity as int) as string), 2, '0')) end""",
    "number": """case l_linenumber when 1 then 'n.a.' when 2 then concat(' ', cast(l_extendedprice as string), ' ')
                   when 3 then concat('-', cast(l_extendedprice as string)) when 4 then concat(cast(l_extendedprice as string), 'e1')
                   when 5 then '' when 6 then '1,000' else cast(l_extendedprice as string) end""",
    "whole": """case l_linenumber when 1 then '2147483648' when 2 then '-2147483648'
                  when 3 then concat(' ', cast(l_suppkey as string), ' ') when 4 then '' when 5 then '12a'
                  when 6 then null else cast(l_suppkey as string) end""",
}


@check(f"""
with d as (select {as_sql(DIRTY_VALUES)} from lineitem)
select l_orderkey, l_linenumber, coalesce(lower(flag)='true', false) as arrest,
       case when district='Headquarters' then 0 else try_cast(district as integer) end as district_clean,
       case when length(height)=3
              then try_cast(substring(height,1,1) as integer)*12+try_cast(substring(height,2,2) as integer)
            when length(height)=4
              then try_cast(substring(height,1,2) as integer)*12+try_cast(substring(height,3,2) as integer)
            else try_cast(height as integer) end as height_inches,
       try_cast(number as double) as amount, try_cast(whole as integer) as whole
from d
""")
def typed_casts(spark, sf_dir):
    return selected(table(spark, sf_dir, "lineitem"), DIRTY_VALUES).select(
        "l_orderkey",
        "l_linenumber",
        casts.is_word(F.col("flag"), "true").alias("arrest"),
        casts.label_code(F.col("district"), "Headquarters", 0).alias("district_clean"),
        casts.feet_inches(F.col("height")).alias("height_inches"),
        casts.to_double(F.col("number")).alias("amount"),
        casts.to_int(F.col("whole")).alias("whole"),
    )


# What stands in place of a date in one event of eleven each; the others have a date that can be read.
UNREADABLE_MOMENTS = ("02/30/2020 10:00:00 AM", "01/02/2020 13:00:00 PM", "2020-01-02 10:00:00", "", None)
UNREADABLE_DAYS = ("13/01/2020", "02/29/2021", "2020-01-02", "", None)


def unless_unreadable(texts: tuple[str | None, ...], readable: Column) -> Column:
    for place, text in enumerate(texts):
        readable = F.when(F.col("event_id") % 11 == place, F.lit(text)).otherwise(readable)
    return readable


@check("""
select event_id,
       case when event_id % 11 >= 5 then strptime(strftime(ts,'%m/%d/%Y %I:%M:%S %p'),'%m/%d/%Y %I:%M:%S %p') end as parsed,
       case when event_id % 11 >= 5 then cast(ts as date) end as day,
       case when (event_type = 'error' and event_id % 13 <> 0) or event_id % 11 >= 5 then cast(year(ts) as integer) end as year
from events
""")
def parse_timestamps(spark, sf_dir):
    """Dates as text and back, or null if they can't be read; the year comes from its own column for
    errors, and from the date where that is blank or unreadable."""
    year = F.when(F.col("event_id") % 13 == 0, "n.a.").when(F.col("event_type") == "error", F.date_format("ts", "yyyy"))
    texts = table(spark, sf_dir, "events").select(
        "event_id",
        unless_unreadable(UNREADABLE_MOMENTS, F.date_format("ts", casts.TIMESTAMP_PATTERN)).alias("moment"),
        unless_unreadable(UNREADABLE_DAYS, F.date_format("ts", casts.DATE_PATTERN)).alias("day"),
        year.otherwise("").alias("year"),
    )
    parsed = texts.select(
        "event_id",
        casts.to_timestamp(F.col("moment")).alias("moment"),
        casts.to_day(F.col("day")).alias("day"),
        casts.to_int(F.col("year")).alias("year"),
    )
    return parsed.select(
        "event_id",
        F.col("moment").cast("timestamp_ntz").alias("parsed"),
        "day",
        casts.year_or_from(F.col("year"), F.col("moment")).alias("year"),
    )


GAPS = {
    "id": "o_orderkey",
    "case_number": "nullif(o_orderpriority, '1-URGENT')",
    "district": "nullif(o_orderstatus, 'P')",
}


@check(f"""
with d as (select {as_sql(GAPS)} from orders)
select * from d where case_number is not null and district is not null
""")
def required_columns(spark, sf_dir):
    rows = selected(table(spark, sf_dir, "orders"), GAPS)
    return rows.filter(row_state(~any_value([F.col("id")]), ["case_number", "district"]) == KEPT)


@check(f"""
with d as (select {as_sql(GAPS)} from orders)
select count(*) as rows_in,
       cast(sum(case when case_number is null and district is null then 1 else 0 end) as bigint) as all_null,
       cast(sum(case when (case_number is null) <> (district is null) then 1 else 0 end) as bigint) as missing_required,
       cast(sum(case when case_number is not null and district is not null then 1 else 0 end) as bigint) as kept
from d
""")
def load_profile(spark, sf_dir):
    required = ["case_number", "district"]
    rows = selected(table(spark, sf_dir, "orders"), GAPS).select(*required)
    state = row_state(~any_value(F.col(c) for c in required), required)
    return row_profile(rows.withColumn(ROW_STATE, state), state_counts())


# ---------------------------------------------------------------- sources and sinks

ORDERS_FILE = DatasetSpec(
    name="orders_file",
    file_name="orders",
    headers=("O OrderKey", "O-Status", "O Total.Price", "O-Order Date"),
    conversions={
        "o_orderkey": lambda text: text.try_cast("bigint"),
        "o_totalprice": casts.to_double,
        "o_order_date": casts.to_timestamp,
    },
    required=("o_orderkey",),
)


def write_csv(df: DataFrame, name: str) -> str:
    """A CSV file as other programs write it: quotes doubled, values untouched."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


@check("select o_orderkey, o_orderstatus as o_status, o_totalprice, o_orderdate as o_order_date from orders")
def csv_roundtrip(spark, sf_dir):
    """Orders as a CSV file with untidy headers, read back in parallel splits."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.date_format("o_orderdate", casts.TIMESTAMP_PATTERN)
    )
    path = write_csv(orders.toDF(*ORDERS_FILE.headers), "orders_csv")
    rows = load_csv(spark, path, ORDERS_FILE).rows
    return rows.withColumn("o_order_date", F.col("o_order_date").cast("timestamp_ntz"))


DOCUMENTS_FILE = DatasetSpec(
    name="documents_file",
    file_name="documents",
    headers=("DOC-ID", "TEXT", "LANG"),
    conversions={"doc_id": lambda text: text.try_cast("bigint")},
    required=("doc_id",),
)


@check(f"""
select doc_id, case when trim(text) in {NO_VALUE_SQL} then null else trim(text) end as text, lang from documents
""")
def csv_multiline_roundtrip(spark, sf_dir):
    """Documents with line breaks and quotes inside their text, as a CSV file and back."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return load_csv(spark, write_csv(documents.toDF(*DOCUMENTS_FILE.headers), "documents_csv"), DOCUMENTS_FILE).rows


# Orders in process lose their last field, urgent ones gain a field.
UNEVEN_LINE = {
    "value": """concat(cast(o_orderkey as string), ',', o_orderstatus,
                  case when o_orderstatus = 'P' then '' else concat(',', o_orderpriority) end,
                  case when o_orderpriority = '1-URGENT' then ',x,y' else '' end)""",
}
UNEVEN_FILE = DatasetSpec(
    name="uneven_file",
    file_name="uneven",
    headers=("ID", "STATUS", "PRIORITY"),
    has_header=False,
)


@check(f"""
select {as_sql(UNEVEN_LINE)}, cast(o_orderkey as string) as id, o_orderstatus as status,
       case when o_orderstatus <> 'P' then o_orderpriority when o_orderpriority = '1-URGENT' then 'x' end as priority
from orders
where o_orderstatus = 'P' or o_orderpriority = '1-URGENT'
""")
def csv_malformed(spark, sf_dir):
    """Raw lines of rows with too few or too many fields, beside what could be read of them."""
    path = scratch_path(spark, "uneven_csv")
    selected(table(spark, sf_dir, "orders"), UNEVEN_LINE).write.text(path)
    return load_csv(spark, path, UNEVEN_FILE).malformed.select(F.col(RAW_LINE).alias("value"), "id", "status", "priority")


def jdbc_target(spark: SparkSession) -> JdbcTarget:
    """The database named by ``spark.casebook.jdbc.url``; in local mode without that setting, the
    embedded one that comes with Spark, which only this process can see."""
    url = spark.conf.get("spark.casebook.jdbc.url", None)
    if url:
        return JdbcTarget(url)
    if not is_local(spark):
        raise RuntimeError("set spark.casebook.jdbc.url: executors cannot reach an embedded database")
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    return JdbcTarget(
        f"jdbc:derby:memory:casebook_{uuid.uuid4().hex};create=true",
        {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"},
    )


@check(YEARLY_SQL.replace("\nfrom orders", ",\n       count(*) over () as rows_written\nfrom orders"))
def jdbc_roundtrip(spark, sf_dir):
    """Yearly trends through a database, with the row count taken during the write."""
    target = jdbc_target(spark)
    rows = write_table(yearly_trends(spark, sf_dir), "Yearly-Trends", target)
    return target.read(spark, "yearly_trends").withColumn("rows_written", F.lit(rows).cast("bigint"))
