"""Daily jobs from the command line, for `spark-submit` with the package in `--py-files`."""

from __future__ import annotations

import argparse
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession

from tidegauge import rules, schemas
from tidegauge.plans import imports, reports
from tidegauge.session import SETTINGS, shared_folder
from tidegauge.sinks import tables
from tidegauge.sources import tree_source


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidegauge", description=__doc__)
    parser.add_argument("--base", required=True, help="folder of all tables")
    jobs = parser.add_subparsers(dest="job", required=True)
    jobs.add_parser("init", help="create all tables anew, empty")
    sites = jobs.add_parser("sites", help="import networks and studies")
    sites.add_argument("--sites", required=True, help="JSON array of sites")
    subjects = jobs.add_parser("subjects", help="import the study metadata files")
    subjects.add_argument("--strict", action="store_true", help="stop at the first bad row")
    subjects.add_argument("--numbers", default="", help="notes kept as numbers: Age=int,Score=double")
    files = jobs.add_parser("files", help="crawl the tree into the catalogue")
    files.add_argument("--hash", dest="hash_algorithm", help="also hash contents, for example md5")
    files.add_argument("--keep", action="store_true", help="merge into the catalogue")
    listing = jobs.add_parser("list", help="files of a study, subject, flags or modality, not stored")
    for name in ("study", "subject", "modality"):
        listing.add_argument(f"--{name}", dest=name if name == "modality" else f"{name}_id")
    for name in ("protected", "raw"):
        listing.add_argument(f"--{name}", action=argparse.BooleanOptionalAction, default=None)
    for job in (subjects, files, listing):
        job.add_argument("--roots", required=True, help="comma-separated data roots, in priority order")
    statistics = jobs.add_parser("statistics", help="append a snapshot")
    for job in (files, statistics):
        job.add_argument("--run", type=datetime.fromisoformat, default=None, help="time of the run")
    report = jobs.add_parser("report", help="compare the two newest snapshots")
    report.add_argument("--networks", default=",".join(rules.NETWORKS))
    recruitment = jobs.add_parser("recruitment", help="consented and recruited subjects")
    recruitment.add_argument("--networks", default=",".join(rules.NETWORKS))
    recruitment.add_argument("--as-of", type=date.fromisoformat, default=None)
    for name, columns in reports.RECRUITMENT.items():
        recruitment.add_argument(f"--{name}", required=True, help=f"table with {', '.join(columns)}")
    chart = jobs.add_parser("chart", help="growth series of one modality")
    chart.add_argument("modality")
    chart.add_argument("--network")
    chart.add_argument("--days", type=int, default=rules.DEFAULT_DAYS)
    chart.add_argument("--as-of", type=date.fromisoformat, default=None)
    return parser


def utc(value: datetime | None = None) -> datetime:
    """A time without zone that means UTC: now, a time with a zone converted, any other as it is."""
    value = value or datetime.now(UTC)
    return value if value.tzinfo is None else value.astimezone(UTC).replace(tzinfo=None)


def _log(spark: SparkSession, base: str, job: str, run: datetime, totals: dict[str, int]) -> None:
    """The totals of a run, as they were counted while it wrote."""
    text = ", ".join(f"{count} {what}" for what, count in totals.items())
    message = spark.createDataFrame([(text,)], "message string")
    tables.append_log(message, f"{base}/logs", job, run)


def _print(rows: DataFrame) -> None:
    """Reports and charts are short by construction: lines per network, points per day."""
    for row in rows.toLocalIterator():
        print(*row, sep="\t")


def main(arguments: list[str] | None = None) -> None:
    options = _parser().parse_args(arguments)
    builder = SparkSession.builder.appName(f"tidegauge-{options.job}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    base = options.base.rstrip("/")
    run = utc(getattr(options, "run", None))
    if options.job == "init":
        tables.recreate_tables(spark, base)
    elif options.job == "sites":
        _log(spark, base, options.job, run, imports.import_sites(spark, options.sites, base))
    elif options.job == "subjects":
        numbers = dict(pair.rsplit("=", 1) for pair in options.numbers.split(",") if pair)
        found = imports.import_subjects(spark, options.roots, base, options.strict, numbers)
        _log(spark, base, options.job, run, found)
    elif options.job == "files":
        work = shared_folder(spark, f"crawl-{run:%Y%m%dT%H%M%S%f}")
        found = imports.import_catalog(
            spark, options.roots, base, work, run, not options.keep, options.hash_algorithm
        )
        _log(spark, base, options.job, run, found)
    elif options.job == "list":
        study = tables.read_table(spark, f"{base}/study", schemas.STUDY)
        asked = {k: getattr(options, k) for k in ("study_id", "subject_id", "modality")}
        asked |= {"is_protected": options.protected, "is_raw": options.raw}
        found = tree_source.list_files(spark, study, options.roots, **asked)
        _print(found.select("path", "size_bytes", "problem"))
    elif options.job == "statistics":
        _log(spark, base, options.job, run, imports.compute_statistics(spark, base, run))
    elif options.job == "report":
        lines, found = reports.notification(spark, base, tuple(options.networks.split(",")))
        _print(lines.select("text"))
        _log(spark, base, options.job, run, found)
    elif options.job == "recruitment":
        names = {name: getattr(options, name) for name in reports.RECRUITMENT}
        as_of, networks = options.as_of or run.date(), tuple(options.networks.split(","))
        lines, found = reports.recruitment_report(spark, base, names, as_of, networks)
        _print(lines.select("text"))
        _log(spark, base, options.job, run, found)
    elif options.job == "chart":
        as_of = options.as_of or run.date()
        _print(
            reports.flow_chart(spark, base, as_of, options.days, options.modality, options.network)
        )


if __name__ == "__main__":
    main()
