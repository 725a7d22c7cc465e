"""Growth series, comparisons and messages on hand-made snapshots."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegauge import schemas
from tidegauge.operators import delta, flow, recruitment, snapshots
from tidegauge.plans.reports import snapshot_pair

T1, T2, T3 = (dt.datetime(2024, 1, d, 6) for d in (5, 6, 7))
MB = 1048576


def stats(spark, *rows):
    """(study, modality, protected, raw, count, size in MB, time) rows as statistics."""
    full = [
        (s, "S1", raw, prot, m, n, float(size), size * MB, t, t.date())
        for s, m, prot, raw, n, size, t in rows
    ]
    return spark.createDataFrame(full, StructType(schemas.VOLUME_STATISTICS.fields[:10]))


@pytest.fixture
def study(spark):
    rows = [("A1", "", None, None, "N1"), ("A2", "", None, None, "N1"), ("B1", "", None, None, "N2")]
    return spark.createDataFrame(rows, schemas.STUDY)


def series(rows, *columns):
    return [tuple(r[c] for c in columns) for r in rows.orderBy(snapshots.TS).collect()]


def test_differences_follow_the_snapshots(spark, study):
    rows = stats(spark, *[("A1", "mri", True, True, n, n, t) for n, t in ((3, T1), (5, T2), (4, T3))])
    found = flow.flow_series(rows, study, dt.date(2024, 1, 8), modality="mri", network="N1")
    assert series(found, "files_count_diff", "files_size_mb_diff") == [(None, None), (2, 2.0), (-1, -1.0)]
    saturday = [r for r in found.collect() if r["day"] == dt.date(2024, 1, 6)][0]
    assert saturday["band_start"] == dt.datetime(2024, 1, 5, 12) and saturday["label"] == "MRI"


def test_two_runs_of_a_day_stay_two_points(spark, study):
    noon = T1.replace(hour=12, microsecond=7)
    rows = stats(spark, ("A1", "mri", True, True, 3, 3, T1), ("A1", "mri", True, True, 4, 4, noon))
    found = flow.flow_series(rows, study, dt.date(2024, 1, 5), network="N1")
    assert series(found, "day", "files_count_diff") == [(T1.date(), None), (T1.date(), 1)]


def test_series_start_within_the_trailing_days(spark, study):
    rows = stats(spark, *[("A1", "mri", True, True, n, n, t) for n, t in ((3, T1), (5, T2), (9, T3))])
    found = flow.flow_series(rows, study, dt.date(2024, 1, 8), days=2, network="N1")
    assert series(found, snapshots.TS, "files_count_diff") == [(T2, None), (T3, 4)]


def test_networks_and_their_total(spark, study):
    rows = stats(
        spark,
        ("A1", "mri", True, True, 1, 1, T1),
        ("A2", "mri", True, True, 2, 2, T1),
        ("B1", "mri", True, True, 4, 4, T1),
        ("??", "mri", True, True, 8, 8, T1),
        ("A1", "mri", True, False, 100, 100, T1),
        ("A1", "interviews", False, False, 16, 16, T1),
        ("A1", "interviews", True, True, 100, 100, T1),
    )
    found = {(r["network_id"], r["modality"]): r["files_count"] for r in flow.flow_totals(rows, study).collect()}
    assert found == {
        ("N1", "mri"): 3,
        ("N2", "mri"): 4,
        ("AllNetworks", "mri"): 15,
        ("N1", "interviews"): 16,
        ("AllNetworks", "interviews"): 16,
    }
    alone = {(r["modality"]): r["files_count"] for r in flow.flow_totals_all(rows).collect()}
    assert alone == {"mri": 15, "interviews": 16}


def test_unknown_modality_has_no_chart(spark, study):
    with pytest.raises(ValueError):
        flow.flow_series(stats(spark), study, dt.date(2024, 1, 8), modality="phone_sensor")


def test_earlier_snapshots(spark):
    rows = stats(spark, *[("A1", "mri", True, True, 1, 1, t) for t in (T1, T2, T2, T3)])
    steps = [snapshots.nth_previous_snapshot(rows, T3, k).collect() for k in (0, 1, 2)]
    assert [[r[0] for r in s] for s in steps] == [[T2], [T1], []]
    assert snapshot_pair(rows) == (T3, T2)
    with pytest.raises(ValueError):
        snapshot_pair(rows.where(F.col(snapshots.TS) == F.lit(str(T1)).cast("timestamp_ntz")))


def test_earlier_snapshot_of_each_threshold(spark):
    """Against counting, with many thresholds on one day, equal times, none, and days without either."""
    import random

    rng = random.Random(4)
    first = dt.datetime(2024, 1, 1)
    moments = sorted({first + dt.timedelta(hours=rng.randint(0, 24 * 40) // 7 * 7) for _ in range(30)})
    hot = first + dt.timedelta(days=12)
    asked = [(i, hot + dt.timedelta(minutes=rng.randint(0, 1439))) for i in range(300)]
    asked += [(i, first + dt.timedelta(hours=rng.randint(-99, 24 * 50))) for i in range(300, 400)]
    asked += [(400 + i, moment) for i, moment in enumerate(moments)] + [(999, None)]
    runs = spark.createDataFrame([(m,) for m in moments * 2], f"{snapshots.TS} timestamp_ntz")
    table = spark.createDataFrame(asked, f"id int, {snapshots.TS} timestamp_ntz")
    found = snapshots.earlier_snapshot_of_each(table, runs, snapshots.TS, offsets=3).collect()
    want = []
    for i, at in asked:
        earlier = [m for m in moments if at is not None and m < at][::-1]
        want += [(i, at, k, earlier[k] if k < len(earlier) else None) for k in range(3)]
    assert sorted(map(str, (tuple(r) for r in found))) == sorted(map(str, want))
    none = snapshots.earlier_snapshot_of_each(table, runs.where("false"), snapshots.TS, offsets=2)
    assert none.count() == 2 * len(asked) and none.where("earlier_snapshot is not null").count() == 0


@pytest.mark.parametrize(
    "now, before, change, missing, alert",
    [
        (10, 7, 3, False, False),
        (7, 10, -3, False, False),
        (10, 10, 0, False, True),
        (10, None, 10, False, False),
        (None, 7, -7, True, False),
        (None, None, 0, True, True),
    ],
)
def test_delta_cases(spark, study, now, before, change, missing, alert):
    rows = [("A1", "mri", True, True, n, n, t) for n, t in ((now, T2), (before, T1)) if n is not None]
    modalities = spark.createDataFrame([("mri",)], "modality string")
    report = delta.delta_report(stats(spark, *rows), study, modalities, T2, T1, networks=("N1",))
    found = report.collect()
    assert [(r["delta_files"], r["delta_size_mb"], r["current_missing"]) for r in found] == [
        (change, float(change), missing)
    ]
    assert delta.flow_alert(report).first()["issue_detected"] is alert


def test_zero_on_a_sub_type_does_not_alert(spark, study):
    rows = stats(
        spark,
        ("A1", "phone", True, True, 9, 9, T2),
        ("A1", "phone", True, True, 7, 7, T1),
        ("A1", "phone_sensor", True, True, 4, 4, T2),
        ("A1", "phone_sensor", True, True, 4, 4, T1),
    )
    modalities = spark.createDataFrame([("phone",)], "modality string")
    report = delta.delta_report(rows, study, modalities, T2, T1, networks=("N1",))
    assert report.where("is_stalled").count() == 2
    assert delta.flow_alert(report).first()["issue_detected"] is False


def test_same_size_with_more_files_alerts(spark, study):
    rows = stats(spark, ("A1", "mri", True, True, 9, 5, T2), ("A1", "mri", True, True, 7, 5, T1))
    modalities = spark.createDataFrame([("mri",)], "modality string")
    report = delta.delta_report(rows, study, modalities, T2, T1, networks=("N1",))
    assert delta.flow_alert(report).first()["issue_detected"] is True


def test_message(spark, study):
    rows = stats(
        spark,
        ("A1", "phone", True, True, 1234, 3, T2),
        ("A1", "phone_sensor", True, True, 1200, 2, T2),
        ("A1", "interviews", False, False, 5, 1, T2),
        ("A1", "interviews", False, False, 5, 1, T1),
    )
    modalities = spark.createDataFrame([("phone",), ("interviews",)], "modality string")
    report = delta.delta_report(rows, study, modalities, T2, T1, networks=("N1",))
    lines = delta.report_lines(report, T2, T1, networks=("N1",))
    ordered = lines.orderBy("section", "network_order", "modality_order", "sub_order").collect()
    assert [(r["kind"], r["indent"], r["text"]) for r in ordered] == [
        (
            "title",
            0,
            "Comparing <!date^1704520800^{date_short} {time}|2024-01-06 06:00:00 UTC> to "
            "<!date^1704434400^{date_short} {time}|2024-01-05 06:00:00 UTC>.",
        ),
        ("network", 0, "N1"),
        ("bullet", 0, "interviews - 0 files (0 Bytes) - (GENERAL, processed)"),
        ("bullet", 0, "phone - 1,234 files (3.0 MiB) "),
        ("bullet", 1, "sensor - 1,200 files (2.0 MiB) "),
        ("bullet", 1, "activity - 0 files (0 Bytes) "),
        ("warning", 0, "*Potential Data-Flow issue detected!*"),
        ("info", 0, "Only includes *PROTECTED* and *raw* files"),
    ]


def test_recruitment_shows_zeros(spark):
    status = spark.createDataFrame([("S1", "recruited"), ("S2", "screening")], "subject_id string, recruitment_status string")
    subjects = spark.createDataFrame([("S1", "AB"), ("S2", "AB")], "id string, site_id string")
    sites = spark.createDataFrame(
        [("AB", "Ab", None, None, "N1")],
        "id string, site_name string, site_country string, site_country_code string, network_id string",
    )
    filters = spark.createDataFrame([("S1", "CHR"), ("S2", "CHR")], "subject string, cohort string")
    joined = recruitment.recruitment_join(status, subjects, sites, filters)
    counts = recruitment.recruitment_counts(joined, ("N1", "N2"), ("CHR", "HC"))
    found = {(r["network_id"], r["cohort"]): (r["consented"], r["recruited"]) for r in counts.collect()}
    assert found == {("N1", "CHR"): (2, 1), ("N1", "HC"): (0, 0), ("N2", "CHR"): (0, 0), ("N2", "HC"): (0, 0)}
    lines = recruitment.recruitment_lines(counts, F.lit(dt.date(2024, 8, 20)))
    texts = [r["text"] for r in lines.orderBy("network_order", "cohort_order", "line_order").collect()]
    assert texts[:5] == ["Recruitment Status as of August 20, 2024", "N1", "CHR", "Consented: 2", "Recruited: 1"]
    assert texts.count("N2") == 1 and len(texts) == 1 + 2 + 4 * 3
