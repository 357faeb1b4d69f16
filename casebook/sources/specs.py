"""Declarations of the five input datasets."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.functions import casts
from casebook.functions.cleaning import snake_case, upper_category

Conversion = Callable[[Column], Column]


@dataclass(frozen=True)
class DatasetSpec:
    """What a CSV file holds and how its text becomes typed columns.

    ``headers``     header texts in file order; columns bind by position
    ``conversions`` column name -> typed expression over cleaned text
    ``reads``       the text column a conversion reads, where that is not its own name
    ``derived``     column name -> expression over the typed columns
    ``required``    a row lacking one of these is dropped
    ``breaks``      headers of the columns whose quoted fields may hold line breaks; None for all
    """

    name: str
    file_name: str
    headers: tuple[str, ...]
    conversions: Mapping[str, Conversion] = field(default_factory=dict)
    reads: Mapping[str, str] = field(default_factory=dict)
    derived: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    breaks: tuple[str, ...] | None = None
    has_header: bool = True

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(snake_case(h) for h in self.headers)


def _all(conversion: Conversion, *names: str) -> dict[str, Conversion]:
    return dict.fromkeys(names, conversion)


# Fixed values from here on: header texts, file names, flag words and required columns of the inputs.

CRIMES = DatasetSpec(
    name="crimes",
    file_name="crimes.csv",
    headers=(
        "ID", "Case Number", "Date", "Block", "IUCR", "Primary Type", "Description",
        "Location Description", "Arrest", "Domestic", "Beat", "District", "Ward", "Community Area",
        "FBI Code", "X Coordinate", "Y Coordinate", "Year", "Updated On", "Latitude", "Longitude",
        "Location",
    ),
    conversions={
        "date": casts.to_timestamp,
        **_all(partial(casts.is_word, word="true"), "arrest", "domestic"),
        **_all(casts.to_int, "id", "beat", "district", "ward", "community_area", "year"),
        **_all(casts.to_double, "x_coordinate", "y_coordinate", "latitude", "longitude"),
    },
    derived={
        "year": lambda: casts.year_or_from(F.col("year"), F.col("date")),
        "month": lambda: F.month("date"),
        "hour": lambda: F.hour("date"),
        "day_of_week": lambda: F.dayofweek("date"),
    },
    required=("case_number", "district"),
    breaks=(),
)

ARRESTS = DatasetSpec(
    name="arrests",
    file_name="arrests.csv",
    headers=(
        "CB_NO", "CASE NUMBER", "ARREST DATE", "RACE",
        "CHARGE 1 STATUTE", "CHARGE 1 DESCRIPTION", "CHARGE 1 TYPE", "CHARGE 1 CLASS",
        "CHARGE 2 STATUTE", "CHARGE 2 DESCRIPTION", "CHARGE 2 TYPE", "CHARGE 2 CLASS",
        "CHARGE 3 STATUTE", "CHARGE 3 DESCRIPTION", "CHARGE 3 TYPE", "CHARGE 3 CLASS",
        "CHARGE 4 STATUTE", "CHARGE 4 DESCRIPTION", "CHARGE 4 TYPE", "CHARGE 4 CLASS",
        "CHARGES STATUTE", "CHARGES DESCRIPTION", "CHARGES TYPE", "CHARGES CLASS",
    ),
    conversions={"arrest_date": casts.to_timestamp, "race": upper_category},
    required=("case_number",),
    breaks=(),
)

STATIONS = DatasetSpec(
    name="police_stations",
    file_name="Police_Stations_20260420.csv",
    headers=(
        "DISTRICT", "DISTRICT NAME", "ADDRESS", "CITY", "STATE", "ZIP", "WEBSITE", "PHONE", "FAX",
        "TTY", "X COORDINATE", "Y COORDINATE", "LATITUDE", "LONGITUDE", "LOCATION",
    ),
    conversions={
        "district_clean": partial(casts.label_code, label="Headquarters", code=0),
        **_all(casts.to_double, "x_coordinate", "y_coordinate", "latitude", "longitude"),
    },
    reads={"district_clean": "district"},
    breaks=("ADDRESS", "LOCATION"),
)

VIOLENCE = DatasetSpec(
    name="violence",
    file_name="violence_reduction.csv",
    headers=(
        "CASE_NUMBER", "DATE", "BLOCK", "VICTIMIZATION_PRIMARY", "INCIDENT_PRIMARY",
        "GUNSHOT_INJURY_I", "UNIQUE_ID", "ZIP_CODE", "WARD", "COMMUNITY_AREA",
        "STREET_OUTREACH_ORGANIZATION", "AREA", "DISTRICT", "BEAT", "AGE", "SEX", "RACE",
        "VICTIMIZATION_FBI_CD", "INCIDENT_FBI_CD", "VICTIMIZATION_FBI_DESCR", "INCIDENT_FBI_DESCR",
        "VICTIMIZATION_IUCR_CD", "INCIDENT_IUCR_CD", "VICTIMIZATION_IUCR_SECONDARY",
        "INCIDENT_IUCR_SECONDARY", "HOMICIDE_VICTIM_FIRST_NAME", "HOMICIDE_VICTIM_MI",
        "HOMICIDE_VICTIM_LAST_NAME", "MONTH", "DAY_OF_WEEK", "HOUR", "LOCATION_DESCRIPTION",
        "STATE_HOUSE_DISTRICT", "STATE_SENATE_DISTRICT", "UPDATED", "LATITUDE", "LONGITUDE",
        "LOCATION",
    ),
    conversions={
        "date": casts.to_timestamp,
        "gunshot_injury_i": partial(casts.is_word, word="YES"),
        **_all(
            casts.to_int, "district", "beat", "ward", "community_area", "age", "month",
            "day_of_week", "hour", "state_house_district", "state_senate_district",
        ),
        **_all(casts.to_double, "latitude", "longitude"),
    },
    required=("case_number", "district"),
    breaks=(),
)

OFFENDERS = DatasetSpec(
    name="sex_offenders",
    file_name="sex_offenders.csv",
    headers=(
        "LAST", "FIRST", "BLOCK", "GENDER", "RACE", "BIRTH DATE", "HEIGHT", "WEIGHT", "VICTIM MINOR",
    ),
    conversions={
        "birth_date": casts.to_day,
        "height_inches": casts.feet_inches,
        "weight": casts.to_int,
        "victim_minor": partial(casts.is_word, word="Y"),
        **_all(upper_category, "gender", "race"),
    },
    reads={"height_inches": "height"},
)

DATASETS = (CRIMES, ARRESTS, STATIONS, VIOLENCE, OFFENDERS)
