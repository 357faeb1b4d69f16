"""The batch job: five CSV files in, sixteen JDBC tables out."""

from __future__ import annotations

import hashlib
import logging
import os
import sys
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from casebook.plans import reports
from casebook.plans.manifest import Manifest, fingerprint
from casebook.session import build_session, drop_scratch, scratch_path, shared_folder, written
from casebook.sinks.jdbc import JdbcTarget, write_table
from casebook.sources.csv import Loaded, MissingInput, load_csv, require_paths, staged_rows
from casebook.sources.specs import DATASETS, DatasetSpec

log = logging.getLogger("casebook")

Writer = Callable[[DataFrame, str], int]


@dataclass
class JobReport:
    """Ingest counts per dataset, rows per result table, and the correlation values."""

    profiles: dict[str, dict[str, int]] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    correlations: dict[str, float | None] = field(default_factory=dict)


def input_paths(data_dir: str) -> dict[str, str]:
    return {spec.name: f"{data_dir.rstrip('/')}/{spec.file_name}" for spec in DATASETS}


def ingest(spark: SparkSession, path: str, spec: DatasetSpec, manifest: Manifest) -> Loaded:
    """A dataset as the run staged it, or parsed and staged now."""
    stage, marker = manifest.table(spec.name), f"input-{spec.name}"
    noted = manifest.facts(marker)
    if noted is not None:
        return staged_rows(spark, stage, noted["profile"])
    loaded = load_csv(spark, path, spec, stage=stage)
    manifest.finish(marker, profile=loaded.profile)
    return loaded


def run(
    spark: SparkSession, paths: Mapping[str, str], write: Writer, *, k: int = 10, preview: int = 0,
    manifest: Manifest | None = None,
) -> JobReport:
    """Ingest every dataset, compute the five analyses and hand each table to ``write`` once.

    ``preview`` logs that many first rows of each table, at the price of computing them again. With a
    ``manifest`` a run that was stopped goes on where it was: inputs that are staged are not parsed, and tables
    that are written not computed again, as long as the input files are the same. Its caller clears it
    when the run is done.
    """
    report = JobReport()
    require_paths(spark, paths.values())
    manifest = manifest or Manifest(spark, scratch_path(spark, "run"))
    manifest.begin(f"k={k};{fingerprint(spark, paths.values())}")

    data = {}
    for spec in DATASETS:
        loaded = ingest(spark, paths[spec.name], spec, manifest)
        data[spec.name] = loaded.rows
        report.profiles[spec.name] = loaded.profile
        log.info("%s: %s", spec.name, loaded.profile)
    crimes, arrests, stations, violence, offenders = (data[spec.name] for spec in DATASETS)

    def emit(name: str, table: DataFrame) -> dict:
        facts = {}
        pair = reports.CORRELATED.get(name)
        if pair:
            table = written(table, name)
            facts["correlation"] = reports.correlation_of(name, table).first()[0]
            log.info("pearson r of %s and %s: %s", *pair, facts["correlation"])
        for row in table.take(preview) if preview else ():
            log.info("%s: %s", name, row)
        rows = write(table, name)
        log.info("%s: %s rows", name, rows)
        return manifest.finish(f"result-{name}", rows=rows, **facts)

    def analyse(name: str, make: Callable[[], reports.Tables]) -> None:
        """The tables of one analysis, which is not begun where all of them are written."""
        finished = manifest.facts(f"analysis-{name}")
        names = finished["tables"] if finished else make_and_emit(make)
        if not finished:
            manifest.finish(f"analysis-{name}", tables=names)
        for table in names:
            noted = manifest.facts(f"result-{table}")
            report.rows[table] = noted["rows"]
            if table in reports.CORRELATED:
                report.correlations[table] = noted["correlation"]

    def make_and_emit(make: Callable[[], reports.Tables]) -> list[str]:
        tables = make()
        for name, table in tables.items():
            if manifest.facts(f"result-{name}") is None:
                emit(name, table)
        return list(tables)

    def times() -> DataFrame:
        return manifest.staged("time_counts", lambda: reports.time_counts(crimes))

    def places() -> DataFrame:
        return manifest.staged("place_counts", lambda: reports.place_counts(crimes))

    def hotspots() -> reports.Tables:
        located = reports.crime_hotspots(crimes, k)
        if not located:
            log.warning("fewer located crimes than clusters (%s): no hotspot tables", k)
        return located

    analyse("trends", lambda: reports.crime_trends(times()))
    analyse("rates", lambda: reports.arrest_rates(places(), crimes, arrests))
    analyse("joins", lambda: reports.dataset_joins(crimes, arrests, stations))
    analyse("hotspots", hotspots)
    analyse("correlations", lambda: reports.correlations(places(), crimes, violence, stations, offenders))
    return report


def main() -> int:
    """Run with ``DATA_DIR``, ``OUTPUT_DIR``, ``PG_URL``, ``PG_USER``, ``JDBC_CONNECTIONS``, ``PREVIEW_ROWS`` and
    ``RUN_ID`` from the environment.

    A run that fails leaves what it finished under its RUN_ID, by default one for these inputs and this database,
    and the next run of that id goes on from there. A run that ends leaves nothing.
    """
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    try:
        url = os.environ["PG_URL"]
    except KeyError:
        log.error("set PG_URL to the JDBC address of the result database")
        return 1
    connections = os.environ.get("JDBC_CONNECTIONS")
    bound = int(connections) if connections else None
    target = JdbcTarget.postgres(url, os.environ.get("PG_USER", "postgres"), bound)

    spark = build_session()
    output = os.environ.get("OUTPUT_DIR")
    if output and spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.sparkContext.setCheckpointDir(f"{output.rstrip('/')}/_checkpoints")
    data_dir = os.environ.get("DATA_DIR", "/data")
    default_id = hashlib.sha256(f"{data_dir} {url}".encode()).hexdigest()[:16]
    try:
        manifest = Manifest(spark, f"{shared_folder(spark)}/casebook/runs/{os.environ.get('RUN_ID', default_id)}")
        run(
            spark,
            input_paths(data_dir),
            lambda df, name: write_table(df, name, target),
            preview=int(os.environ.get("PREVIEW_ROWS", "0")),
            manifest=manifest,
        )
        manifest.clear()
    except MissingInput as error:
        log.error("%s", error)
        return 1
    finally:
        drop_scratch(spark)
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
