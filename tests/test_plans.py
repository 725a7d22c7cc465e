"""Physical plans: what is pruned, pushed down, broadcast and split."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from suite import dimensions, files, flows
from tidegauge.operators import delta, flow, lookups, snapshots, upsert
from tidegauge.plans.reports import snapshot_pair


def plan(rows):
    rows.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")
    rows.collect()
    return rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_files_are_never_broadcast(frames):
    """Customers, orders and files grow with the data: only studies and networks are broadcast."""
    text = plan(files.volume_statistics(frames))
    assert text.count("SortMergeJoin") == 2
    assert text.count("BroadcastHashJoin") == 2
    assert "Python" not in text


def test_statistics_combine_before_the_shuffle(frames):
    text = plan(files.volume_statistics(frames))
    shuffle = text.index("hashpartitioning(study_id")
    assert "partial_count(1)" in text[shuffle:]
    assert text.index("Generate inline") < shuffle


def test_rollup_expands_only_reduced_rows(frames):
    from tidegauge.operators.statistics import summary_rollup

    text = plan(summary_rollup(frames.files_base()))
    below = text[text.index("Expand") :]
    assert "HashAggregate" in below


def test_only_needed_columns_are_read(frames):
    text = plan(lookups.all_modalities(frames.files_base()))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


def read_files(rows):
    """Files that the scans of a plan would open."""
    return {path.rsplit("/", 1)[0].split("/data/")[-1] for path in rows.inputFiles()}


def test_comparison_reads_two_snapshots_only(frames):
    """The folders of two runs are listed; no others, and no file rows for the modalities."""
    runs = frames.runs()
    latest, previous = snapshot_pair(runs)
    folders = {r["folder"]: r[snapshots.TS] for r in runs.collect()}
    text = plan(flows.report(frames))
    assert "lineitem" not in text and "l_orderkey" not in text
    found = read_files(frames.snapshots(runs.where(F.col(snapshots.TS).isin(latest, previous))))
    assert {folders[f] for f in found} == {latest, previous} and len(folders) > 20


def test_snapshots_are_found_in_the_index(frames):
    """No data file and no footer of the history is opened to find snapshots."""
    runs = frames.runs()
    for rows in (
        snapshots.latest_snapshot(runs),
        snapshots.earlier_snapshots(runs, dt.datetime(2001, 12, 1), depth=2),
        snapshots.nth_previous_snapshot(runs, dt.datetime(2001, 12, 1), 1),
    ):
        assert all("/index/" in path for path in rows.inputFiles())
    found = snapshots.earlier_snapshots(runs, dt.datetime(2001, 12, 1), depth=2).collect()
    assert [r[1] for r in found] == [dt.datetime(2001, 11, 1), dt.datetime(2001, 10, 1)]


def test_thresholds_are_joined_not_sorted(frames):
    """Windows run over days and snapshots; the thresholds' rows meet no window and no sort for one."""
    orders = frames.table("orders").selectExpr("o_orderkey", "o_orderdate AS moment")
    rows = snapshots.earlier_snapshot_of_each(orders, frames.runs(), "moment", offsets=2)
    text = plan(rows)
    below = [part.split("Window")[0] for part in text.split("\n") if "Window" in part]
    assert below and "Window [row_number" in text
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert not any("o_orderkey" in line for line in windows)


def test_series_prune_by_date_and_push_flags(frames):
    text = plan(flow.flow_series(frames.snapshots(), frames.study(), dt.date(2001, 12, 1), days=60))
    scan = [line for line in text.splitlines() if "FileScan" in line and "files_count" in line][0]
    assert "snapshot_date" in scan[scan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "interviews" in scan[scan.index("PushedFilters") :].split("ReadSchema")[0]


def test_bucketed_tables_are_joined_without_a_shuffle(frames):
    text = plan(files.catalog_files_join(frames))
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_clustered_tables_are_made_of_one_shuffle_by_path(frames, monkeypatch):
    """The rows of files are joined and shuffled once for both tables."""
    from suite.frames import Frames

    made, whole = [], Frames.files
    monkeypatch.setattr(Frames, "files", lambda f: made.append(f) or whole(f))
    assert files.catalog_files_join(frames).count() == frames.files_base().count()
    assert len(made) == 1


def test_stored_modalities_read_no_file_rows(frames):
    for rows in (lookups.all_modalities(frames.groups()), lookups.subject_modalities(frames.groups())):
        assert all("/sums/" in path for path in rows.inputFiles())


def rows_of_scan(rows):
    """Rows that the scan hands on, whatever the filter above it keeps."""
    rows.collect()
    leaf = rows._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().get("numOutputRows").get().value()


def test_tag_lookup_skips_row_groups(spark, frames, tmp_path):
    """Of a catalogue in small row groups only those are read that hold an asked tag, path or subject."""
    from tidegauge import schemas
    from tidegauge.sinks import tables

    rows = tables.read_table(spark, frames.stored_catalog(), schemas.CATALOG_WIDE)
    rare = rows.withColumn(
        "redcap_instance",
        F.when(F.col("subject_id") == rows.select(F.min("subject_id")).first()[0], F.lit("RARE-x")),
    )
    path = f"{tmp_path}/catalog"
    options = {**schemas.CATALOG_OPTIONS, "parquet.block.size": "16384", "parquet.page.size.row.check.min": "10"}
    tables.upsert_buckets(
        rare, path, ["file_path"], schemas.CATALOG_WIDE, 4, True,
        order_by=schemas.CATALOG_ORDER, sums=tables.GROUPS, options=options,
    )
    stored = tables.read_table(spark, path, schemas.CATALOG_WIDE)
    tagged = lookups.tag_filter(tables.read_groups(spark, path), "redcap_instance", "RARE")
    found = stored.where(tagged).select("file_path", "redcap_instance")
    want = rare.where("redcap_instance is not null").count()
    assert "In(redcap_instance" in plan(found) or "EqualTo(redcap_instance" in plan(found)
    assert want == found.count() > 0
    total = stored.count()
    assert rows_of_scan(found) < total / 4
    one = stored.select("file_path").first()[0]
    assert rows_of_scan(stored.where(F.col("file_path") == one).select("file_path")) < total / 4
    none = lookups.tag_filter(tables.read_groups(spark, path), "redcap_instance", "nothing")
    assert stored.where(none).count() == 0


def test_comparison_scans_statistics_once(frames):
    text = plan(flows.report(frames))
    scans = [line for line in text.splitlines() if "FileScan" in line and "files_count" in line]
    assert len(scans) == 1


def test_last_row_per_key_is_limited_before_the_shuffle(frames):
    text = plan(dimensions.dedupe_latest(frames))
    assert "WindowGroupLimit" in text[text.index("Exchange") :]


def test_means_share_one_pass(frames):
    assert "ReusedExchange" in plan(dimensions.relative_mean(frames))


@pytest.mark.parametrize("how", ["catalog", "upsert"])
def test_hot_keys_are_split(spark, how):
    """A key with a third of all rows is spread over tasks, and nothing is lost."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        rows = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("S"), F.col("id") % 500)).alias("subject_id"),
            F.lit("AB").alias("study_id"),
            F.lit("mri").alias("modality"),
            F.col("id").alias("size_bytes"),
        )
        wanted = spark.range(500).select(
            F.lit("AB").alias("study_id"),
            F.when(F.col("id") == 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("id"))).alias("subject_id"),
            F.lit("mri").alias("modality"),
        )
        if how == "catalog":
            result = lookups.files_for(rows, wanted.hint("merge"))
            expected = rows.where("subject_id <> 'S0'").count()
        else:
            result = upsert.upsert(rows.drop("modality"), wanted.drop("modality").withColumn("size_bytes", F.lit(0).cast("bigint")), ["study_id", "subject_id"])
            expected = rows.where("subject_id = 'S0'").count() + 500
        text = plan(result)
        assert "skew=true" in text
        assert result.count() == expected
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_lookup_skips_files_of_the_ordered_catalogue(spark, frames, tmp_path):
    from tidegauge import schemas
    from tidegauge.sinks import tables

    catalog = frames.files().select("study_id", "subject_id", "modality", "file_path", "size_bytes")
    tables.publish(catalog, f"{tmp_path}/catalog", order_by=schemas.CATALOG_ORDER)
    stored = tables.read_table(spark, f"{tmp_path}/catalog")
    one = stored.select("study_id", "subject_id", "modality").first()
    rows = lookups.subject_files(stored, *one)
    text = plan(rows)
    assert all(f"EqualTo({c},{v})" in text for c, v in zip(("study_id", "subject_id", "modality"), one))
    assert rows.select(F.input_file_name()).distinct().count() <= 2
    assert rows.count() == catalog.where(F.struct("study_id", "subject_id", "modality") == F.struct(*map(F.lit, one))).count()


def test_empty_network_list_needs_no_join(spark):
    modalities = spark.createDataFrame([("phone",), ("mri",)], "modality string")
    text = plan(delta.report_skeleton(modalities, ("N1", "N2")))
    assert "Join" not in text and "CartesianProduct" not in text
