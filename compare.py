"""The whole job twice: recomputing every action from the CSV files, and as built. Prints one JSON line.

In the first shape a file is parsed by one task, each dataset is counted before and after cleaning,
and each result is counted and then written, all from the files. Results are discarded in both.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile

from pyspark.sql import Observation
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "tests"))

from bench import SF_DIR, discard, seconds, session
from casebook.plans import reports
from casebook.plans.job import input_paths, run
from casebook.sources.csv import KEPT, NOT_ROWS, RAW_LINE, ROW_STATE, typed_rows
from casebook.sources.specs import DATASETS
from incident_files import write_files


def recompute_every_action(spark, paths) -> None:
    data = {}
    for spec in DATASETS:
        schema = ", ".join(f"`{name}` string" for name in (*spec.headers, RAW_LINE))
        reader = spark.read.schema(schema).options(header=True, multiLine=True, escape='"', columnNameOfCorruptRecord=RAW_LINE)
        raw = reader.csv(paths[spec.name])
        rows = typed_rows(raw, spec).filter(F.col(ROW_STATE) == KEPT).drop(*NOT_ROWS)
        raw.count()
        rows.count()
        data[spec.name] = rows
    crimes, arrests, stations, violence, offenders = (data[spec.name] for spec in DATASETS)
    times, places = reports.time_counts(crimes), reports.place_counts(crimes)
    for tables in (
        reports.crime_trends(times),
        reports.arrest_rates(places, crimes, arrests),
        reports.dataset_joins(crimes, arrests, stations),
        reports.crime_hotspots(crimes),
        reports.correlations(places, crimes, violence, stations, offenders),
    ):
        for name, table in tables.items():
            if name in reports.CORRELATED:
                reports.correlation_of(name, table).first()
            table.count()
            discard(table)


def as_built(spark, paths) -> None:
    def write(df, name):
        passed = Observation()
        discard(df.observe(passed, F.count(F.lit(1)).alias("rows")))
        return passed.get["rows"]

    run(spark, paths, write)


def main() -> None:
    spark = session()
    folder = tempfile.mkdtemp(prefix="casebook-compare-")
    write_files(SF_DIR, folder)
    paths = input_paths(folder)
    result = {}
    for _ in range(2):
        result["recompute_every_action"] = seconds(lambda: recompute_every_action(spark, paths))
        result["as_built"] = seconds(lambda: as_built(spark, paths))
    spark.stop()
    print(json.dumps({"metric": "whole job, second run", "unit": "sec", "input": os.path.basename(SF_DIR), **result}))


if __name__ == "__main__":
    main()
