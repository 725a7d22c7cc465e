"""Writing tables."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegauge import schemas
from tidegauge.operators import upsert
from tidegauge.sinks import parts, tables, versions


def networks(spark, *names):
    return spark.createDataFrame([(n,) for n in names], schemas.NETWORKS)


def names(rows):
    return sorted(r[0] for r in rows.collect())


def test_publish_replaces_and_keeps_the_old_version_readable(spark, tmp_path):
    path = f"{tmp_path}/networks"
    assert names(tables.read_table(spark, path, schemas.NETWORKS)) == []
    tables.publish(networks(spark, "a"), path)
    old = tables.read_table(spark, path)
    # A new version may be computed from the one it replaces.
    tables.publish(old.union(networks(spark, "b")), path)
    assert names(old) == ["a"]
    assert names(tables.read_table(spark, path)) == ["a", "b"]


def test_unfinished_versions_are_not_read(spark, tmp_path):
    path = f"{tmp_path}/networks"
    tables.publish(networks(spark, "a"), path)
    (tmp_path / "networks/v00000002").mkdir()
    assert names(tables.read_table(spark, path)) == ["a"]
    assert tables.publish(networks(spark, "b"), path) == 3


def test_write_modes(spark, tmp_path):
    path = f"{tmp_path}/networks"
    tables.write_table(networks(spark, "a"), path, "append")
    tables.write_table(networks(spark, "b"), path, "append")
    assert names(tables.read_table(spark, path)) == ["a", "b"]
    tables.write_table(networks(spark, "c"), path, "replace")
    assert names(tables.read_table(spark, path)) == ["c"]
    with pytest.raises(FileExistsError):
        tables.write_table(networks(spark, "d"), path, "fail")
    with pytest.raises(ValueError):
        tables.write_table(networks(spark, "d"), path, "overwrite")


def test_insert_only(spark, tmp_path):
    path = f"{tmp_path}/networks"
    tables.insert_table(networks(spark, "a"), path, ["network_id"], schemas.NETWORKS)
    tables.insert_table(networks(spark, "b"), path, ["network_id"], schemas.NETWORKS)
    for bad in (("b",), ("c", "c")):
        with pytest.raises(ValueError):
            tables.insert_table(networks(spark, *bad), path, ["network_id"], schemas.NETWORKS)
    assert names(tables.read_table(spark, path)) == ["a", "b"]


def test_upsert_is_idempotent(spark, tmp_path):
    path, key = f"{tmp_path}/t", ["k"]
    schema = spark.createDataFrame([(1, "a")], "k int, v string").schema
    tables.publish(spark.createDataFrame([(1, "a"), (2, "b")], schema), path)
    new = spark.createDataFrame([(2, "B"), (3, "C")], schema)
    for _ in range(2):
        tables.upsert_table(new, path, key, schema)
        found = sorted(tuple(r) for r in tables.read_table(spark, path).collect())
        assert found == [(1, "a"), (2, "B"), (3, "C")]


def test_last_of_equal_keys_wins(spark):
    rows = spark.createDataFrame([(1, i, f"v{i}") for i in range(100)] + [(2, 0, "x")], "k int, s int, v string")
    found = sorted(tuple(r) for r in upsert.dedupe_latest(rows, ["k"], ["s"]).collect())
    assert found == [(1, 99, "v99"), (2, 0, "x")]


def stats(spark, count):
    row = ("AB", "S1", True, True, "phone", count, float(count), count * 1048576)
    return spark.createDataFrame([row], StructType(schemas.VOLUME_STATISTICS.fields[:8]))


def test_snapshots_append_and_repeat(spark, tmp_path):
    path = f"{tmp_path}/volume_statistics"
    first, second = dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 1, 18, 0, 0, 1)
    tables.append_snapshots(tables.with_run(stats(spark, 1), first), path)
    tables.append_snapshots(tables.with_run(stats(spark, 2), second), path)
    tables.append_snapshots(tables.with_run(stats(spark, 3), second), path)
    stored = tables.read_table(spark, path, schemas.VOLUME_STATISTICS)
    found = sorted((r["statistics_timestamp"], r["files_count"], r["snapshot_date"]) for r in stored.collect())
    day = dt.date(2024, 1, 1)
    assert found == [(first, 1, day), (second, 3, day)]


def test_a_run_without_its_row_is_not_read(spark, tmp_path):
    """Data of a run is written first, the row that makes it count last."""
    from tidegauge.sinks import parts

    path, first = f"{tmp_path}/volume_statistics", dt.datetime(2024, 1, 1, 6)
    assert tables.read_runs(spark, path).count() == tables.read_snapshots(spark, path).count() == 0
    totals = tables.append_snapshots(tables.with_run(stats(spark, 1), first), path)
    assert totals == {"rows": 1, "files": 1}
    later = tables.with_run(stats(spark, 9), dt.datetime(2024, 1, 2, 6))
    parts.fill_parts(later, path, tables.SNAPSHOT_PARTITIONS, notes={"statistics_timestamp": F.max("statistics_timestamp")})
    for rows in (tables.read_snapshots(spark, path), tables.read_table(spark, path, schemas.VOLUME_STATISTICS)):
        assert [r["files_count"] for r in rows.collect()] == [1]
    assert [r["statistics_timestamp"] for r in tables.read_runs(spark, path).collect()] == [first]
    assert len(list((tmp_path / "volume_statistics/data").iterdir())) == 2
    assert len(parts.remove_unnamed(spark, path)) == 1
    assert tables.read_snapshots(spark, path).count() == 1


def test_a_history_stores_what_stays_once(spark, tmp_path):
    """Rows that hold for many runs are stored once, and read in every run that they hold for."""
    path = f"{tmp_path}/volume_statistics"
    month = [dt.datetime(2024, m, 1) for m in range(1, 13)]
    spans = [("a", 0, 11, 7), ("b", 0, 3, 1), ("b", 4, 11, 2), ("c", 5, 9, 4)]
    rows = spark.createDataFrame(
        [("s", u, False, True, "mri", n, n / 2, n, month[i], month[j]) for u, i, j, n in spans],
        "study_id string, subject_id string, is_raw boolean, is_protected boolean, modality string, "
        "files_count bigint, files_size_mb double, size_bytes bigint, since timestamp_ntz, "
        "statistics_timestamp timestamp_ntz",
    )
    assert tables.append_history(rows, path, "1 month", "yyyyMMdd") == {"rows": 4, "files": 14}
    assert spark.read.parquet(f"{path}/data").count() == 4
    want = sorted((month[m], u, n) for u, i, j, n in spans for m in range(i, j + 1))

    def seen(stored):
        assert stored.where("run_id <> date_format(statistics_timestamp, 'yyyyMMdd')").count() == 0
        assert stored.where("snapshot_date <> date(statistics_timestamp)").count() == 0
        return sorted((r["statistics_timestamp"], r["subject_id"], r["files_count"]) for r in stored.collect())

    assert seen(tables.read_snapshots(spark, path)) == want
    assert seen(tables.read_table(spark, path, schemas.VOLUME_STATISTICS)) == want
    runs = tables.read_runs(spark, path)
    counted = {r["statistics_timestamp"]: r["rows"] for r in runs.collect()}
    assert counted == {m: sum(1 for w in want if w[0] == m) for m in month}
    some = runs.where(F.col("snapshot_date").isin(month[2].date(), month[6].date()))
    assert seen(tables.read_snapshots(spark, path, some)) == [w for w in want if w[0] in (month[2], month[6])]
    newest = tables.read_snapshots(spark, path, runs.where(F.col("snapshot_date") >= month[10].date()))
    assert {"2024-12-01"} == {f.split("snapshot_date=")[1][:10] for f in newest.inputFiles()}
    # A run that is written again takes its place only, whatever was stored with it; another one is added.
    between = dt.datetime(2024, 3, 15)
    for run in (month[3], between):
        tables.append_snapshots(
            tables.with_run(stats(spark, 9), run).withColumn("run_id", F.lit(run.strftime("%Y%m%d"))), path
        )
    left = seen(tables.read_snapshots(spark, path))
    assert [w for w in left if w[0] not in (month[3], between)] == [w for w in want if w[0] != month[3]]
    assert [(w[0], w[2]) for w in left if w[0] in (month[3], between)] == [(between, 9), (month[3], 9)]


def bucket_files(path):
    return {f.name: f for f in path.rglob("bucket=*/*.parquet") if "offered" not in str(f)}


def numbered(spark, rows, value):
    return spark.createDataFrame([(f"k{i}", value) for i in rows], "k string, v string")


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    path, key = f"{tmp_path}/t", ["k"]
    old, schema = numbered(spark, range(400), "old"), numbered(spark, [0], "x").schema
    assert tables.upsert_buckets(old, path, key, schema, 16, True)["rows"] == 400
    table = tables.read_table(spark, path, schema)
    before = set(table.inputFiles())
    totals = tables.upsert_buckets(numbered(spark, [3, 1000], "new"), path, key, schema, 16)
    found = {r["k"]: r["v"] for r in tables.read_table(spark, path, schema).collect()}
    assert len(found) == 401 and found["k3"] == found["k1000"] == "new" and found["k4"] == "old"
    after = set(tables.read_table(spark, path, schema).inputFiles())
    assert len(before & after) >= 14 and len(after) == len(before) and totals["rows"] < 80
    # The version that was read before still can be read.
    assert table.where("v = 'new'").count() == 0 and table.count() == 400
    # The same again changes nothing, and the number of buckets stays.
    tables.upsert_buckets(numbered(spark, [3, 1000], "new"), path, key, schema, 99)
    assert {r["k"]: r["v"] for r in tables.read_table(spark, path, schema).collect()} == found


def test_a_task_sorts_one_bucket_only(spark, tmp_path):
    """Buckets are as many as the rows ask for, and no task gets two of them, first written or merged."""
    from tidegauge.sinks import parts

    assert parts.buckets_for(1) == 8 and parts.buckets_for(216_000_000) >= 500
    path, key, rows = f"{tmp_path}/t", ["k"], numbered(spark, range(4000), "old")
    for write, replace in enumerate((True, False)):
        tables.upsert_buckets(rows, path, key, rows.schema, 16, replace)
        files = tables.read_table(spark, path, rows.schema).inputFiles()
        tasks = {f.rsplit("/part-", 1)[1].split("-")[0] for f in files}
        assert len(files) == len(tasks) == 16, write


def test_refused_rows_leave_nothing_on_disk(spark, tmp_path):
    path, key = tmp_path / "t", ["k"]
    rows = numbered(spark, range(100), "old")
    counted = tables.parts.Sums(["v"])
    tables.upsert_buckets(rows, str(path), key, rows.schema, 8, True, sums=counted)
    before = set(path.rglob("*.parquet"))
    parent = {("v",): spark.createDataFrame([("new",)], "v string")}
    for new, more in ((rows.unionByName(rows), {}), (rows, {"parents": parent})):
        with pytest.raises(tables.KeyViolation):
            tables.upsert_buckets(new, str(path), key, rows.schema, 8, True, sums=counted, **more)
    with pytest.raises(tables.KeyViolation):
        tables.publish(rows.unionByName(rows), f"{path}/plain", rules=tables.Rules(key))
    assert set(path.rglob("*.parquet")) == before
    assert tables.read_table(spark, str(path), rows.schema).count() == 100
    # Rows offered to a merge go once it is done.
    tables.upsert_buckets(numbered(spark, [1], "new"), str(path), key, rows.schema, 8, sums=counted)
    assert not list(path.glob("data/offered=*"))


def test_sums_follow_the_buckets(spark, tmp_path):
    from tidegauge.sinks import parts

    path, key, sums = f"{tmp_path}/t", ["k"], parts.Sums(["v"])
    schema = numbered(spark, [0], "x").schema

    def counted():
        return {r["v"]: r["files"] for r in sums.read(spark, path, schema).collect()}

    assert counted() == {}
    tables.upsert_buckets(numbered(spark, range(50), "a"), path, key, schema, 8, sums=sums)
    assert counted() == {"a": 50}
    tables.upsert_buckets(numbered(spark, range(40, 60), "b"), path, key, schema, 8, sums=sums)
    assert counted() == {"a": 40, "b": 20}
    tables.upsert_buckets(numbered(spark, range(40), "c"), path, key, schema, 8, sums=sums)
    assert counted() == {"b": 20, "c": 40}
    tables.upsert_buckets(numbered(spark, [], "c"), path, key, schema, 8, sums=sums)
    assert counted() == {"b": 20, "c": 40}
    tables.upsert_buckets(numbered(spark, [1], "d"), path, key, schema, 8, True, sums=sums)
    assert counted() == {"d": 1}


def test_versions_that_break_a_rule_stay_invisible(spark, tmp_path):
    path, rules = f"{tmp_path}/networks", tables.Rules(["network_id"])
    tables.publish(networks(spark, "a"), path, rules=rules)
    with pytest.raises(tables.KeyViolation, match="network_id given again") as broken:
        tables.publish(networks(spark, "b", "b", "b", "c"), path, rules=rules)
    assert broken.value.counts == {"network_id given again": 2}
    assert names(tables.read_table(spark, path)) == ["a"]
    studies = spark.createDataFrame([(s, s, None, None, n) for s, n in (("S", "a"), ("T", "z"))], schemas.STUDY)
    known = tables.read_table(spark, path)
    with pytest.raises(tables.KeyViolation, match="no parent for network_id"):
        tables.upsert_table(studies, f"{tmp_path}/study", ["study_id"], schemas.STUDY, parents={("network_id",): known})
    assert not tables.exists(spark, f"{tmp_path}/study")
    assert tables.publish(networks(spark, "b"), path, rules=rules) == 3
    assert names(tables.read_table(spark, path)) == ["b"]


def test_buckets_that_break_a_rule_stay_invisible(spark, tmp_path):
    from tidegauge.sinks import parts

    path, key, schema = f"{tmp_path}/t", ["k"], numbered(spark, [0], "x").schema
    more = {"sums": parts.Sums(["v"]), "parents": {("v",): numbered(spark, [0], "a").select("v")}}
    tables.upsert_buckets(numbered(spark, range(9), "a"), path, key, schema, 8, **more)
    for bad, rule in ((numbered(spark, [1, 1, 12], "a"), "k given again"), (numbered(spark, [1, 12], "b"), "no parent for v")):
        with pytest.raises(tables.KeyViolation, match=rule):
            tables.upsert_buckets(bad, path, key, schema, 8, **more)
        assert tables.read_table(spark, path, schema).where("v = 'a'").count() == 9
        assert [tuple(r) for r in more["sums"].read(spark, path, schema).collect()] == [("a", 9)]


def test_empty_writes_are_counted(spark, tmp_path):
    none = networks(spark)
    version, found = tables.publish_counted(
        none, f"{tmp_path}/n", rules=tables.Rules(["network_id"]), totals={"most": F.max(F.length("network_id"))}
    )
    assert (version, found) == (1, {"rows": 0, "most": 0}) and tables.exists(spark, f"{tmp_path}/n")
    some = tables.publish_counted(networks(spark, "abc", "d"), f"{tmp_path}/n", totals={"most": F.max(F.length("network_id"))})
    assert some == (2, {"rows": 2, "most": 3})


def test_totals_are_taken_while_writing(spark, tmp_path):
    """Rows are computed once: the counter of the tasks that make them goes no further."""
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            calls.add(len(batch))
            yield batch

    rows = spark.range(500, numPartitions=4).mapInPandas(count, "id long")
    _, found = tables.publish_counted(rows, f"{tmp_path}/ids", totals={"sum": F.sum("id")})
    assert found == {"rows": 500, "sum": 124750} and calls.value == 500


def test_clustered_tables_are_read_by_other_catalogues(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = numbered(spark, range(60), "a")
    tables.publish_clustered(rows, path, ["k"], 4)
    tables.publish_clustered(rows.where("k < 'k2'"), path, ["k"], 4)
    name = tables._clustered_name(f"{path}/v00000002")
    assert spark.catalog.tableExists(name)
    # As in another application, whose catalogue does not know the table.
    spark.sql(f"DROP TABLE {name}")
    again = tables.read_clustered(spark, path)
    assert again.count() == rows.where("k < 'k2'").count()
    text = again.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text


def test_recreate_tables(spark, tmp_path):
    base = f"{tmp_path}/tables"
    tables.publish(networks(spark, "a"), f"{base}/networks")
    tables.recreate_tables(spark, base)
    for name, schema in schemas.TABLES.items():
        assert tables.read_table(spark, f"{base}/{name}", schema).count() == 0
        assert tables.exists(spark, f"{base}/{name}")


def test_a_repeated_log_entry_is_stored_once(spark, tmp_path):
    path, run = f"{tmp_path}/logs", dt.datetime(2024, 1, 1)
    message = spark.createDataFrame([("Found 3 files",)], "message string")
    tables.append_log(message, path, "import", run)
    tables.append_log(message, path, "import", run)
    rows = tables.read_table(spark, path, schemas.LOGS).collect()
    assert [(r["log_message"], r["log_timestamp"]) for r in rows] == [("Found 3 files", run)]


def test_equal_messages_of_a_run_are_all_stored(spark, tmp_path):
    path, run = f"{tmp_path}/logs", dt.datetime(2024, 1, 1)
    messages = spark.createDataFrame([("same",), ("same",), ("other",)], "message string")
    for _ in range(2):
        tables.append_log(messages, path, "import", run)
    rows = tables.read_table(spark, path, schemas.LOGS)
    assert sorted(r["log_message"] for r in rows.collect()) == ["other", "same", "same"]


def test_run_times_are_utc(spark):
    from tidegauge.__main__ import utc
    from tidegauge.operators.snapshots import ntz

    aware = dt.datetime.fromisoformat("2024-01-01T23:00:00-05:00")
    assert utc(aware) == dt.datetime(2024, 1, 2, 4) and utc(dt.datetime(2024, 1, 1)) == dt.datetime(2024, 1, 1)
    assert abs(utc() - dt.datetime.now(dt.UTC).replace(tzinfo=None)) < dt.timedelta(seconds=5)
    assert spark.range(1).select(ntz(aware)).first()[0] == dt.datetime(2024, 1, 2, 4)


def test_snapshots_of_another_day_are_refused(spark, tmp_path):
    rows = tables.with_run(stats(spark, 1), dt.datetime(2024, 1, 2, 6))
    moved = rows.withColumn("snapshot_date", F.lit(dt.date(2024, 1, 3)))
    with pytest.raises(Exception, match="not the day"):
        tables.append_snapshots(moved, f"{tmp_path}/statistics")


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffle_files():
        names = kept.getAllFiles().mkString("\n").split("\n")
        return {name.rsplit("/", 1)[-1] for name in names if "/shuffle_" in name}

    before = shuffle_files()
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))
    assert tables.step(rows, f"{tmp_path}/step").count() == 7
    # Only the count that read it may have left some; those of the write go in the background.
    shuffles = lambda: {f.split("_")[1] for f in shuffle_files() - before}
    waited = 0
    while len(shuffles()) > 1 and waited < 100:
        time.sleep(0.1)
        waited += 1
    assert len(shuffles()) <= 1


def test_slices_are_shuffled_one_at_a_time(spark, tmp_path):
    """A step, a history and a filled table are the same in slices, and no slice waits for the shuffles of another."""
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffle_files():
        names = kept.getAllFiles().mkString("\n").split("\n")
        return {name.rsplit("/", 1)[-1] for name in names if "/shuffle_" in name}

    rows = spark.range(1000).select("id", (F.col("id") % 70).alias("k"))
    before, left = shuffle_files(), []

    def summed():
        for own in versions.slices_of(rows, 3, "k"):
            own = own.groupBy("k").agg(F.sum("id").alias("n"))
            yield own
            deadline = time.time() + 10
            while shuffle_files() - before and time.time() < deadline:
                time.sleep(0.1)
            left.append(len(shuffle_files() - before))

    found = tables.step(summed(), f"{tmp_path}/step")
    assert left == [0, 0, 0]
    assert sorted(map(tuple, found.collect())) == [(k, sum(range(k, 1000, 70))) for k in range(70)]


def test_a_table_filled_in_pieces_is_the_same(spark, tmp_path):
    key, schema = ["k"], numbered(spark, [0], "x").schema
    sums = parts.Sums(["v"])
    pieces = [numbered(spark, range(i, 100, 3), f"v{i}") for i in range(3)]
    whole, path = pieces[0].unionByName(pieces[1]).unionByName(pieces[2]), f"{tmp_path}/t"
    for _ in range(2):  # a replaced table too
        assert tables.upsert_buckets(pieces, path, key, schema, 8, True, sums=sums)["rows"] == 100
        found = parts.read_parts(spark, path, schema, columns=["bucket"])
        assert sorted(found.drop("bucket").collect()) == sorted(whole.collect())
        assert found.where(parts.bucket_of(key, 8) != F.col("bucket")).count() == 0
        assert sorted(map(tuple, sums.read(spark, path, schema).collect())) == [("v0", 34), ("v1", 33), ("v2", 33)]
        assert sum(r["rows"] for r in parts.read_index(spark, path).collect()) == 100
    # Pieces merged into the table; then some of which two have keys in common.
    again = [numbered(spark, [i, 100 + i], "new") for i in range(2)]
    tables.upsert_buckets(again, path, key, schema, 8, sums=sums)
    assert tables.read_table(spark, path, schema).where("v = 'new'").count() == 4
    named = {f.name for f in (tmp_path / "t/data").iterdir()}
    for replace in (True, False):
        with pytest.raises(tables.KeyViolation):
            tables.upsert_buckets([*again, again[1]], path, key, schema, 8, replace, sums=sums)
    assert tables.read_table(spark, path, schema).count() == 102
    assert not [f for f in (tmp_path / "t/data").rglob("*.parquet") if f.relative_to(tmp_path / "t/data").parts[0] not in named]


def test_frames_in_slices_are_the_same(spark, tmp_path, monkeypatch):
    """Months of subjects whose orders fall in several slices add up; keys that are null or given twice count as before."""
    from compare import DATA
    from suite import frames

    for name in ("lineitem", "orders", "customer", "nation", "region"):
        given = spark.read.parquet(f"{DATA}/{name}.parquet")
        if name in ("lineitem", "orders"):
            number = "l_orderkey" if name == "lineitem" else "o_orderkey"
            given = given.where(f"{number} % 5 = 0")
            odd = given.limit(40).withColumn(number, F.lit(None).cast(given.schema[number].dataType))
            given = given.unionByName(given.limit(20) if name == "orders" else odd)
        given.write.parquet(f"{tmp_path}/in/{name}.parquet")
    f = frames.Frames(spark, f"{tmp_path}/in")

    def made(slices):
        monkeypatch.setattr(frames.Frames, "file_slices", lambda self: slices)
        monkeypatch.setattr(frames.Frames, "scratch", lambda self, name: f"{tmp_path}/{slices}/{name}")
        history = f.spark.read.parquet(f"{f._snapshots_path()}/data")
        return [
            sorted(map(str, rows.collect()))
            for rows in (f.snapshots(), f.runs().drop("folder"), history.drop("attempt"))
        ]

    assert made(1) == made(4) and len(made(1)[0]) > 1000


def test_made_columns_are_not_shuffled(spark, tmp_path):
    """What follows from few columns is made behind the shuffle, and rows are merged the same."""
    path, key = f"{tmp_path}/t", ["k"]

    def made(rows):
        return rows.withColumn("k", F.concat(F.lit("k"), "i")).withColumn("wide", F.repeat("k", 50))

    old = spark.range(400).select(F.col("id").alias("i"), F.lit("old").alias("v"))
    new = old.where("i < 3 or i > 395").withColumn("v", F.lit("new"))
    schema = made(old).select("k", "wide", "v").schema
    text = parts._placed(old, key, schema, 16, made)._jdf.queryExecution().executedPlan().toString()
    above, below = text.split("Exchange", 1)
    assert "wide#" in above and "wide#" not in below and "repeat" not in below
    for rows, replace in ((old, True), (new, False)):
        tables.upsert_buckets(rows, path, key, schema, 16, replace, made=made)
    found = tables.read_table(spark, path, schema).collect()
    want = {(f"k{i}", f"k{i}" * 50, "new" if i < 3 or i > 395 else "old") for i in range(400)}
    assert set(map(tuple, found)) == want and len(found) == 400
    for folder in tmp_path.rglob("bucket=*"):
        number = int(folder.name.split("=")[1])
        own = spark.read.parquet(str(folder)).where(parts.bucket_of(key, 16) != number)
        assert own.count() == 0


def test_entries_of_parts_are_counted_once(spark, tmp_path):
    """The index and the reader of new parts need no second scan of them, and no row is sorted for it."""
    rows = numbered(spark, range(20), "a").withColumn("day/part", (F.substring("k", 2, 2).cast("int") % 3))
    entries, found = parts.fill_parts(
        rows, f"{tmp_path}/t", ["day/part"], notes={"last": F.max("k")}
    )
    assert found == {"rows": 20} and entries.inputFiles() == []
    told = sorted((r["day/part"], r["rows"], r["last"]) for r in entries.collect())
    assert told == [(0, 7, "k9"), (1, 7, "k7"), (2, 6, "k8")]
    for row in entries.collect():
        assert len(list((tmp_path / "t" / "data" / row["folder"]).glob("*.parquet"))) > 0


def test_history_makes_the_size_in_mb(spark, tmp_path):
    month = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame(
        [("A", "S1", True, True, "mri", 3, 3 << 19, month, month)],
        "study_id string, subject_id string, is_raw boolean, is_protected boolean, modality string, "
        "files_count bigint, size_bytes bigint, since timestamp_ntz, statistics_timestamp timestamp_ntz",
    )
    tables.append_history(rows, str(tmp_path), "1 month", "yyyyMMdd")
    assert [r["files_size_mb"] for r in tables.read_snapshots(spark, str(tmp_path)).collect()] == [1.5]


def test_sizes_in_mb_that_follow_are_not_stored(spark, tmp_path):
    """A history stores what cannot be made of its other columns, and gives a size in MB that it was given."""
    month = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame(
        [("A", "S1", True, True, "mri", 3, 3 << 19, month, month), ("A", "S2", True, True, "mri", 1, None, month, month)],
        "study_id string, subject_id string, is_raw boolean, is_protected boolean, modality string, "
        "files_count bigint, size_bytes bigint, since timestamp_ntz, statistics_timestamp timestamp_ntz",
    )
    for name, given, want in (
        ("follows", rows, [("S1", 1.5), ("S2", None)]),
        ("slices", (rows.where(f"subject_id = '{s}'") for s in ("S1", "S2")), [("S1", 1.5), ("S2", None)]),
        ("given", rows.withColumn("files_size_mb", F.lit(7.0)), [("S1", 7.0), ("S2", 7.0)]),
    ):
        tables.append_history(given, f"{tmp_path}/{name}", "1 month", "yyyyMMdd")
        stored = spark.read.parquet(f"{tmp_path}/{name}/data").columns
        assert ("files_size_mb" in stored) == (name == "given")
        found = tables.read_snapshots(spark, f"{tmp_path}/{name}").select("subject_id", "files_size_mb").collect()
        assert sorted(map(tuple, found)) == want


def test_counts_of_a_slice_go_before_the_next(spark, tmp_path):
    """Pieces dealt anew by subject: each row comes once, equal keys in one slice, and what was read is deleted."""
    from tidegauge.sinks import versions

    pieces = [spark.range(i, 300, 3).selectExpr("id % 40 AS k", "id", "if(id % 7 = 0, null, id) AS v") for i in range(3)]
    folder, seen, held = f"{tmp_path}/dealt", [], []
    for own in versions.dealt_anew((p for p in pieces), folder, 4, "k"):
        held.append(len(list((tmp_path / "dealt").glob("_slice=*"))))
        seen.append([tuple(r) for r in own.collect()])
    assert held == [4, 3, 2, 1] and not list((tmp_path / "dealt").glob("_slice=*"))
    assert sorted(r[1] for rows in seen for r in rows) == list(range(300))
    assert sum(len({r[0] for r in rows}) for rows in seen) == 40
    nothing = versions.dealt_anew([pieces[0].where("false")], f"{tmp_path}/none", 2, "k")
    assert [own.count() for own in nothing] == [0, 0]


def _numbered(spark, keys, value):
    return spark.createDataFrame([(k, value) for k in keys], "k int, v string")


def test_merges_in_pieces_equal_whole_ones(spark, tmp_path):
    schema = _numbered(spark, [1], "a").schema

    def filled(name, cut):
        path = str(tmp_path / name)
        tables.upsert_buckets(cut(_numbered(spark, range(60), "old")), path, ["k"], schema, 8, replace=True)
        found = tables.upsert_buckets(cut(_numbered(spark, range(40, 70), "new")), path, ["k"], schema, 8)
        assert tables.upsert_buckets(cut(_numbered(spark, range(0), "no")), path, ["k"], schema, 8) == {"rows": 0}
        assert [p.name for p in (tmp_path / name / "data").iterdir() if p.name.startswith("offered")] == []
        parts = tables.read_slices(spark, path, schema, 3)
        buckets = [{r[0] for r in p.select(F.pmod(F.xxhash64("k"), F.lit(8))).collect()} for p in parts]
        assert not (buckets[0] & buckets[1] or buckets[0] & buckets[2] or buckets[1] & buckets[2])
        return found, sorted(map(tuple, tables.read_table(spark, path, schema).collect())), sum(p.count() for p in parts)

    whole = filled("whole", lambda rows: rows)
    assert whole[1] == [(k, "old" if k < 40 else "new") for k in range(70)] and whole[2] == 70
    assert filled("pieces", lambda rows: [rows.where(f"k % 3 = {i}") for i in range(3)]) == whole


@pytest.mark.parametrize("replace", [False, True])
def test_refused_pieces_are_counted_and_not_kept(spark, tmp_path, monkeypatch, replace):
    path, schema = str(tmp_path / "t"), _numbered(spark, [1], "a").schema
    tables.upsert_buckets(_numbered(spark, range(50), "old"), path, ["k"], schema, 8, replace=True)
    written, fill = [], versions.fill
    monkeypatch.setattr(versions, "fill", lambda *args, **more: written.append(1) or fill(*args, **more))
    twice = _numbered(spark, [*range(40), *range(40)], "new")
    pieces = [twice.where(f"k % 4 = {i}") for i in range(4)]
    with pytest.raises(tables.KeyViolation) as refused:
        tables.upsert_buckets(pieces, path, ["k"], schema, 8, replace=replace)
    # All slices are counted, the first is written, and its rows go.
    assert refused.value.counts == {"k given again": 40} and len(written) == 1
    named = {r["folder"].split("/")[0] for r in parts.read_index(spark, path).collect()}
    for folder in (tmp_path / "t" / "data").iterdir():
        assert folder.name in named or not list(folder.rglob("*.parquet"))
    assert tables.read_table(spark, path, schema).where("v = 'old'").count() == 50
