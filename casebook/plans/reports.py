"""The five analyses over the cleaned datasets, each a set of named result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions.cleaning import leading_number
from casebook.functions.rates import per_thousand, ratio_or_zero
from casebook.operators.correlation import keyed_correlation
from casebook.operators.counting import (
    count_by,
    flag_counts,
    flag_counts_by_event_category,
    rate_table,
    roll_up,
)
from casebook.operators.distance import distance_by_key
from casebook.operators.hotspots import hotspots
from casebook.operators.joining import attach_dimension, join_events, zero_fill_join

Tables = dict[str, DataFrame]

TIME_KEYS = ("year", "month", "hour", "day_of_week")
PLACE_KEYS = ("primary_type", "district")


def time_counts(crimes: DataFrame) -> DataFrame:
    """Counts on the finest time key: one pass over the crimes serves all five trends."""
    return flag_counts(crimes, TIME_KEYS, F.col("arrest"))


def place_counts(crimes: DataFrame) -> DataFrame:
    """Counts by type and district: one pass serves the rates by either and the district comparison."""
    return flag_counts(crimes, PLACE_KEYS, F.col("arrest"))


def crime_trends(counts: DataFrame) -> Tables:
    """Crimes and arrests over time, from ``time_counts`` (A1, A2, O1)."""

    def trend(*keys: str, rate: str | None = None) -> DataFrame:
        table = rate_table(
            roll_up(counts, keys), keys, total="total_crimes", flagged="total_arrests", rate=rate
        )
        return table.orderBy(*keys)

    # Fixed values here and in the functions below: names of the result tables.
    return {
        "yearly_trends": trend("year", rate="arrest_rate_pct"),
        "monthly_trends": trend("month"),
        "monthly_trends_by_year": trend("year", "month"),
        "hourly_trends": trend("hour"),
        "day_of_week_trends": trend("day_of_week"),
    }


def arrest_rates(counts: DataFrame, crimes: DataFrame, arrests: DataFrame) -> Tables:
    """Arrest rates by type and district from ``place_counts``, and by race (A2-A4, O2)."""

    def rates(table: DataFrame, key: str, total: str) -> DataFrame:
        return rate_table(table, [key], total=total, flagged="total_arrests", rate="arrest_rate_pct")

    by_race = flag_counts_by_event_category(crimes, arrests, "case_number", "race", F.col("arrest"))
    return {
        "arrest_rate_by_crime_type": rates(
            roll_up(counts, ["primary_type"]), "primary_type", "total_incidents"
        ).orderBy(F.desc("total_incidents")),
        "arrest_rate_by_district": rates(
            roll_up(counts, ["district"]), "district", "total_incidents"
        ).orderBy("district"),
        "arrest_rate_by_race": count_by(arrests, ["race"], "total_arrests").orderBy(F.desc("total_arrests")),
        "arrest_rate_by_race_detailed": rates(by_race, "race", "total_crime_incidents").orderBy(
            F.desc("total_crime_incidents")
        ),
    }


# Columns of the two joined tables.
CRIME_COLUMNS = (
    "date", "primary_type", "description", "arrest", "domestic", "district", "ward",
    "community_area", "latitude", "longitude", "year", "month", "hour", "day_of_week",
)
ARREST_COLUMNS = (
    "arrest_date", "race", "charge_1_description", "charge_1_type", "charge_1_class",
    "charges_description", "charges_type", "charges_class",
)
CRIME_COLUMNS_FOR_STATIONS = (
    "case_number", "date", "primary_type", "arrest", "district", "latitude", "longitude", "year",
)
STATION_COLUMNS = {
    "district_name": "district_name",
    "address": "station_address",
    "latitude": "station_lat",
    "longitude": "station_lon",
    "phone": "phone",
    "zip": "zip",
}


def dataset_joins(crimes: DataFrame, arrests: DataFrame, stations: DataFrame) -> Tables:
    """Crimes with their arrests, and crimes with the station of their district."""
    return {
        "crimes_join_arrests": join_events(crimes, arrests, "case_number", CRIME_COLUMNS, ARREST_COLUMNS),
        "crimes_join_stations": attach_dimension(
            crimes.select(*CRIME_COLUMNS_FOR_STATIONS), stations, "district", "district_clean", STATION_COLUMNS
        ),
    }


def crime_hotspots(crimes: DataFrame, k: int = 10) -> Tables:
    """Clusters of crimes and their profile; no tables when there are fewer located crimes than clusters."""
    keep = ("id", "case_number", "primary_type", "district", "latitude", "longitude")
    found = hotspots(crimes, keep=keep, k=k)
    if found is None:
        return {}
    return {"crime_hotspots_kmeans": found.profile, "crimes_with_clusters": found.assigned}


def district_comparison(crimes: DataFrame, violence: DataFrame) -> DataFrame:
    """Arrest and violence rates side by side for every district either table knows."""
    joined = zero_fill_join(
        crimes, violence, "district", ("total_crimes", "total_arrests", "violence_incidents"), "outer"
    )
    crimes_total, incidents = F.col("total_crimes"), F.col("violence_incidents")
    return joined.select(
        "*",
        ratio_or_zero(F.col("total_arrests"), crimes_total).alias("arrest_rate"),
        ratio_or_zero(incidents, crimes_total).alias("violence_rate"),
        per_thousand(incidents, crimes_total).alias("violence_per_1000"),
    )


def prefix_density(
    crimes: DataFrame, offenders: DataFrame, *, block: str = "block", pattern: str = r"^(\d+)",
    drop_unmatched: bool = False,
) -> DataFrame:
    """Crimes and offenders per block number.

    Blocks without a number share the key ``""``, unless ``drop_unmatched`` leaves them out.
    """

    def counts(df: DataFrame, name: str) -> DataFrame:
        keyed = df.filter(F.col(block).isNotNull()).select(leading_number(F.col(block), pattern).alias("block_key"))
        if drop_unmatched:
            keyed = keyed.filter(F.col("block_key") != "")
        return count_by(keyed, ["block_key"], name)

    return zero_fill_join(
        counts(crimes, "crime_count"), counts(offenders, "offender_count"), "block_key", ["offender_count"], "left"
    )


def correlations(
    counts: DataFrame, crimes: DataFrame, violence: DataFrame, stations: DataFrame, offenders: DataFrame
) -> Tables:
    """District rates from ``place_counts``, distance to the own-district station, offender density."""
    by_district = rate_table(
        roll_up(counts, ["district"]), ["district"], total="total_crimes", flagged="total_arrests"
    )
    return {
        "correlation_violence_arrest_by_district": district_comparison(
            by_district, count_by(violence, ["district"], "violence_incidents")
        ),
        "crime_station_distance_by_district": distance_by_key(crimes, stations, "district", "district_clean"),
        "correlation_offenders_crime_by_block": prefix_density(crimes, offenders),
    }


# The column pairs whose correlation is reported with a table.
CORRELATED = {
    "correlation_violence_arrest_by_district": ("violence_rate", "arrest_rate"),
    "correlation_offenders_crime_by_block": ("crime_count", "offender_count"),
}


def correlation_of(name: str, table: DataFrame) -> DataFrame:
    """The one-row correlation that belongs to a result table."""
    return keyed_correlation(table, *CORRELATED[name])
