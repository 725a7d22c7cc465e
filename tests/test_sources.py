"""Scans over small trees and files written by hand."""

import datetime as dt
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from tidegauge import schemas
from tidegauge.plans import imports
from tidegauge.sources import queries, sites_json, study_csv, tree


def put(path, content=b"x", mtime=1_700_000_000):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)
    os.utime(path, (mtime, mtime))


@pytest.fixture
def study(spark):
    rows = [("AB", "Ab", None, None, "PRO net"), ("CD", "Cd", None, None, "PRO net"), ("EF", "Ef", None, None, "X")]
    return spark.createDataFrame(rows, schemas.STUDY)


@pytest.fixture
def subjects(spark):
    day = dt.date(2022, 1, 1)
    rows = [("AB", "S1", True, day, "{}"), ("CD", "S1", True, day, "{}"), ("EF", "S9", True, day, "{}")]
    return spark.createDataFrame(rows, schemas.SUBJECTS)


@pytest.fixture
def roots(tmp_path):
    """AB below the second root only, CD below both (the first counts), EF nowhere."""
    one, two = tmp_path / "one", tmp_path / "two"
    phone = two / "PROTECTED/Pro netAB/raw/S1/phone"
    put(phone / "a b.csv", b"12345")
    put(phone / ".hid.json")
    put(phone / "_x")
    put(phone / "empty", b"")
    put(phone / "pct%20é.txt")
    put(phone / "d.csv.lock")
    put(phone / "deep/er/u_sensor_1.json")
    put(phone.parent / "beside.txt")
    put(two / "GENERAL/Pro netAB/processed/S1/interviews/i.mp4")
    put(tmp_path / "elsewhere/linked.bin", b"123")
    put(tmp_path / "elsewhere/more/not_entered.bin")
    (phone / "link_to_file").symlink_to(tmp_path / "elsewhere/linked.bin")
    (phone / "link_to_dir").symlink_to(tmp_path / "elsewhere/more")
    (phone / "dangling").symlink_to(tmp_path / "gone")
    (phone.parent / "linked_modality").symlink_to(tmp_path / "elsewhere")
    put(one / "PROTECTED/Pro netCD/raw/S1/mri/first.zip")
    put(two / "PROTECTED/Pro netCD/raw/S1/mri/second.zip")
    put(two / "GENERAL/Pro netCD/raw/S1/mri/general_second.zip")
    return f"{one},{two}"


def test_roots_in_priority_order(spark, study, roots):
    existing = tree.existing_study_dirs(tree.split_roots(spark, roots))
    resolved = tree.resolve_roots(study, existing)
    one, two = roots.split(",")
    found = {r["study_id"]: r["root"] for r in resolved.collect()}
    assert found == {"AB": two, "CD": one, "EF": None}
    assert [r["study_id"] for r in tree.unresolved_studies(resolved).collect()] == ["EF"]


def expected_files(roots):
    """What a recursive walk of each modality directory finds, as Python's own globbing sees it."""
    from pathlib import Path

    one, two = roots.split(",")
    starts = [
        Path(two, "PROTECTED/Pro netAB/raw/S1"),
        Path(two, "GENERAL/Pro netAB/processed/S1"),
        Path(one, "PROTECTED/Pro netCD/raw/S1"),
    ]
    return {
        (str(path), modality.name, path.stat().st_size)
        for start in starts
        for modality in start.iterdir()
        if modality.is_dir()
        for path in modality.rglob("*")
        if path.is_file()
    }


@pytest.mark.parametrize("per_task", [1, 1000])
def test_crawl_finds_what_a_walk_finds(spark, study, subjects, roots, tmp_path, per_task):
    resolved = tree.resolve_roots(study, tree.existing_study_dirs(tree.split_roots(spark, roots)))
    starts = tree.subject_directories(subjects, resolved)
    entries = tree.list_tree(starts, f"{tmp_path}/work{per_task}", dirs_per_task=per_task)
    found = tree.stat_entries(entries, files_per_task=per_task).collect()
    assert {(r["path"], r["modality"], r["size_bytes"]) for r in found} == expected_files(roots)
    assert all(r["problem"] is None for r in found)


def test_catalog_rows(spark, study, subjects, roots, tmp_path):
    found = tree.crawl(subjects, study, roots, f"{tmp_path}/work", hash_algorithm="md5")
    run = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert [r["study_id"] for r in found.where("problem IS NOT NULL").collect()] == ["EF"]
    rows = {r["file_name"]: r for r in imports.catalog_rows(found, run).collect()}
    sensor = rows["u_sensor_1.json"]
    assert sensor["metadata"] == '{"mindlamp_type":"sensor"}'
    assert (sensor["study_id"], sensor["subject_id"], sensor["modality"]) == ("AB", "S1", "phone")
    assert sensor["m_time"] == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert sensor["extracted_timestamp"] == run
    assert rows["a b.csv"]["md5"] == hashlib.md5(b"12345").hexdigest()
    assert rows["d.csv.lock"]["file_type"] == ".csv"
    assert rows["empty"]["file_size_mb"] == 0.0
    assert rows["pct%20é.txt"]["file_type"] == ".txt"


def test_crawl_without_any_study_directory(spark, study, subjects, tmp_path):
    found = tree.crawl(subjects, study, str(tmp_path / "nothing"), f"{tmp_path}/work").collect()
    assert {(r["study_id"], r["problem"]) for r in found} == {
        (s, "no study directory") for s in ("AB", "CD", "EF")
    }
    assert imports.catalog_rows(spark.createDataFrame(found, tree.FOUND), dt.datetime(2024, 1, 1)).count() == 0


def test_object_stores_are_refused(spark, study):
    with pytest.raises(ValueError):
        tree.split_roots(spark, "/data/a,s3a://bucket/b")
    with pytest.raises(ValueError):
        study_csv.candidate_files(study, "s3a://bucket/b")


def test_hashing_is_split_by_bytes():
    assert tree.hash_tasks(20_000, 20_000 << 30, 20_000, 4 << 30) == 5_000
    assert tree.hash_tasks(100_000, 0, 20_000, 4 << 30) == 5
    assert tree.hash_tasks(0, 0, 20_000, 4 << 30) == 1


def test_hashing_reports_what_vanished(spark, tmp_path):
    put(tmp_path / "there", b"abc")
    rows = [
        ("AB", "S1", True, True, "mri", f"{tmp_path}/there", 3, 1_700_000_000_000_001, None, None),
        ("AB", "S1", True, True, "mri", f"{tmp_path}/gone", 3, 1, None, None),
        ("AB", "S1", True, True, "mri", f"{tmp_path}/there", None, None, None, "unreadable"),
    ]
    found = tree.hash_files(spark.createDataFrame(rows, tree.FOUND), "md5").collect()
    assert {(r["m_time_micros"], r["md5"], r["problem"]) for r in found} == {
        (1_700_000_000_000_001, "900150983cd24fb0d6963f7d28e17f72", None),
        (1, None, "vanished"),
        (None, None, "unreadable"),
    }


def test_vanished_directories_are_reported(spark, tmp_path):
    """A start directory is a guess and may be absent; one found by listing may not."""
    import pandas as pd

    names = ["study_id", "subject_id", "is_protected", "is_raw", "modality", "path"]
    gone = [("AB", "S1", True, True, modality, f"{tmp_path}/gone") for modality in (None, "mri")]
    batch = pd.DataFrame(gone, columns=names, dtype=object)
    listed = pd.concat(tree._list_level(iter([batch])))
    assert [(r.modality, r.kind) for r in listed.itertuples()] == [("mri", tree.VANISHED)]


def test_vanished_files_are_reported(spark, study, subjects, roots, tmp_path):
    resolved = tree.resolve_roots(study, tree.existing_study_dirs(tree.split_roots(spark, roots)))
    entries = tree.list_tree(tree.subject_directories(subjects, resolved), f"{tmp_path}/work")
    one = roots.split(",")[0]
    os.remove(f"{one}/PROTECTED/Pro netCD/raw/S1/mri/first.zip")
    problems = [r["problem"] for r in tree.stat_entries(entries).collect() if r["problem"]]
    assert problems == ["vanished"]


@pytest.fixture
def metadata(tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    put(
        two / "PROTECTED/Pro netAB/Pro netAB_metadata.csv",
        "Subject ID,Active,Consent,Study,Age,Note\n"
        "S1,1,2022-01-05,X,21,hello\n"
        "S2,0,2022-1-5,X,,\n"
        "S3,,2022-01-05,X,30,x\n"
        "S4,1,2022-13-05,X,1,x\n"
        "\n"
        "S1,0,2022-02-01,X,NA,\n".encode(),
    )
    put(
        one / "PROTECTED/Pro netCD/Pro netCD_metadata.csv",
        'Study,"Why, not",Subject ID,Consent,Active,Why\nX,"two\nlines ""q""",S1,2022-03-04,2,b\n'.encode(),
    )
    put(two / "PROTECTED/Pro netCD/Pro netCD_metadata.csv", b"Subject ID,Active,Consent,Study\nZ,1,2022-01-01,X\n")
    return f"{one},{two}"


def test_study_files(spark, study, metadata, tmp_path):
    subjects, quarantine, missing = imports.load_subjects(study, metadata, f"{tmp_path}/work")
    found = {(r["study_id"], r["subject_id"]): r for r in subjects.collect()}
    assert set(found) == {("AB", "S1"), ("AB", "S2"), ("CD", "S1")}
    last = found["AB", "S1"]
    assert (last["is_active"], last["consent_date"], last["optional_notes"]) == (False, dt.date(2022, 2, 1), "{}")
    plain = found["AB", "S2"]
    assert (plain["is_active"], plain["consent_date"], plain["optional_notes"]) == (False, dt.date(2022, 1, 5), "{}")
    other = found["CD", "S1"]
    assert other["is_active"] is True
    assert json.loads(other["optional_notes"]) == {"Why": "b", "Why, not": 'two\nlines "q"'}
    assert [(r["subject_id"], r["consent_text"]) for r in quarantine.collect()] == [("S4", "2022-13-05")]
    assert [tuple(r) for r in missing.collect()] == [("EF", None, "no metadata file")]


def test_number_notes(spark, study, metadata, tmp_path):
    subjects, _, _ = imports.load_subjects(study, metadata, f"{tmp_path}/work", {"Age": "int"})
    rows = spark.read.parquet(f"{tmp_path}/work/rows")
    notes = {r["optional_notes"] for r in rows.where("study_id = 'AB'").collect()}
    assert '{"Age":21,"Note":"hello"}' in notes


def test_odd_study_files_lose_nothing(spark, study, tmp_path):
    """Clashing names, ragged and short rows, parts with other column orders, a lacking column."""
    home = tmp_path / "PROTECTED"
    put(
        home / "Pro netAB/Pro netAB_metadata.csv/part-0.csv",
        b'age,Age,study_id,path,Subject ID,Active,Consent,Study\n'
        b'1,2,x,p,S1,1,2022-01-05,X\n"1,5",2,x,p,S2,1,2022-01-05,X,tail\n1,,,,S3,0,2022-01-06,X,,\n',
    )
    put(
        home / "Pro netAB/Pro netAB_metadata.csv/part-1.csv",
        b"Consent,Active,Study,Subject ID,Score,Kind\n2022-01-07,1,X,S1,7\n2022-01-08,1,X,S4,NA,\"a,b\"\n",
    )
    put(home / "Pro netCD/Pro netCD_metadata.csv", b"Subject ID,Active,Study\nS1,1,X\n")
    subjects, quarantine, problems = imports.load_subjects(
        study, f"{tmp_path}//", f"{tmp_path}/work", {"Score": "int"}
    )
    found = {r["subject_id"]: (r["consent_date"].day, r["optional_notes"]) for r in subjects.collect()}
    assert found == {"S1": (7, '{"Score":7}'), "S4": (8, '{"Kind":"a,b"}')}
    bad = {r["subject_id"]: (r["problem"], r["row_text"]) for r in quarantine.collect()}
    assert bad == {
        "S2": ("more fields than the header", '"1,5",2,x,p,S2,1,2022-01-05,X,tail'),
        "S3": ("more fields than the header", "1,,,,S3,0,2022-01-06,X,,"),
    }
    told = sorted((r["study_id"], r["problem"]) for r in problems.collect())
    assert told == [("CD", "missing column: Consent"), ("EF", "no metadata file")]


def test_strict_import_stops_before_subjects(spark, study, tmp_path):
    from tidegauge import schemas
    from tidegauge.sinks import tables

    put(tmp_path / "PROTECTED/Pro netAB/Pro netAB_metadata.csv", b"Subject ID,Active,Consent,Study\nS1,1,2022-01-05,X\n")
    put(tmp_path / "PROTECTED/Pro netCD/Pro netCD_metadata.csv", b"Subject ID,Active,Study\nS1,1,X\n")
    base = f"{tmp_path}/tables"
    tables.publish(study, f"{base}/study")
    with pytest.raises(ValueError, match="missing column"):
        imports.import_subjects(spark, str(tmp_path), base, strict=True)
    assert not tables.exists(spark, f"{base}/subjects")
    imports.import_subjects(spark, str(tmp_path), base)
    assert tables.read_table(spark, f"{base}/subjects", schemas.SUBJECTS).count() == 1
    assert tables.read_table(spark, f"{base}/study_problems").count() == 2
    assert tables.read_table(spark, f"{base}/subject_quarantine").count() == 0


def test_site_import_can_be_repeated_after_a_failure(spark, tmp_path):
    from tidegauge.sinks import tables

    base = f"{tmp_path}/tables"
    site = {"id": "AB", "name": "Ab", "country": "", "country_code": "DE", "network": "P"}
    twice = [site, {**site, "network": "Q"}]
    (tmp_path / "sites.json").write_text(json.dumps(twice))
    with pytest.raises(ValueError, match="duplicate keys"):
        imports.import_sites(spark, f"{tmp_path}/sites.json", base)
    assert not tables.exists(spark, f"{base}/networks")
    (tmp_path / "more.json").write_text(json.dumps([site]))
    tables.publish(spark.createDataFrame([("P",)], "network_id string"), f"{base}/networks")
    imports.import_sites(spark, f"{tmp_path}/more.json", base)
    assert tables.read_table(spark, f"{base}/networks").collect() == [("P",)]
    assert tables.read_table(spark, f"{base}/study").count() == 1


@pytest.fixture
def small_splits(spark):
    """Files are read in parts of so many bytes."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = [spark.conf.get(name) for name in names]

    def cut(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    def restore():
        for name, value in zip(names, old):
            spark.conf.set(name, value)

    cut.restore = restore
    yield cut
    restore()


def put_study(home, content, study="AB"):
    put(home / f"PROTECTED/Pro net{study}/Pro net{study}_metadata.csv", content)


HEAD = "Subject ID,Active,Consent,Study,Note\n"


def loaded(study, home, name="work"):
    return imports.load_subjects(study, str(home), f"{home}/{name}")


def test_large_study_file_is_split(spark, study, tmp_path, small_splits):
    """A file with line breaks inside quotes is read in several tasks; the last line still wins."""
    import csv
    import io

    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(HEAD.strip().split(","))
    for i in range(2000):
        writer.writerow([f"S{i % 500}", 1, "2022-01-05", "X", f'{i}\n"{i}"\n\n,' if i % 3 else f"{i}"])
    put_study(tmp_path, out.getvalue().encode())
    small_splits(8192)
    subjects, bad, problems = loaded(study, tmp_path)
    lines = spark.read.parquet(f"{tmp_path}/work/lines")
    assert lines.select("block").distinct().count() > 5
    notes = {r["subject_id"]: json.loads(r["optional_notes"])["Note"] for r in subjects.collect()}
    want = {f"S{i % 500}": (f'{i}\n"{i}"\n\n,' if i % 3 else f"{i}") for i in range(1500, 2000)}
    assert notes == want and bad.count() == 0
    assert sorted(r["study_id"] for r in problems.collect()) == ["CD", "EF"]


def test_only_broken_records_are_brought_together(spark, study, tmp_path):
    """Lines of a file are shuffled as part of a block; only those of broken records by record."""
    put_study(tmp_path, (HEAD + "".join(f"S{i},1,2022-01-05,X,plain\n" for i in range(300))).encode())
    loaded(study, tmp_path)
    from tidegauge.sources import csv_records

    lines = spark.read.parquet(f"{tmp_path}/work/lines")
    report = spark.read.parquet(f"{tmp_path}/work/report")
    assert [tuple(r) for r in report.select("breaks", "problem").collect()] == [(False, None)]
    records = csv_records.read_records(lines, report)
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and records.count() == 300
    # The narrow pass that finds where blocks begin reads no text.
    narrow = csv_records.read_blocks(lines)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in narrow


def test_records_equal_the_csv_module(spark, tmp_path, small_splits):
    """Random files with quotes and line breaks anywhere, cut anywhere."""
    import csv
    import io
    import random

    from tidegauge.sources import csv_records

    rng = random.Random(6)
    bits = ["a", "b,", ",", '"', '""', '"x,\n"', "\n", ',"', '",', '"\n', "é", " ", '5" x', '\n\n']
    paths, want = [], {}
    for n in range(40):
        text = "head,er\n" + "".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))
        path = tmp_path / f"f{n}.csv"
        put(path, text.encode())
        paths.append(str(path))
        rows = [r for r in csv.reader(open(path, encoding="utf-8", newline="")) if r]
        # A row behind an open quote becomes part of it.
        more = list(csv.reader(io.StringIO(text + "\nEND,x,y\n", newline="")))
        closed = more[-1] == ["END", "x", "y"]
        # Single cells of blanks and quotes may or may not be a blank line.
        want[str(path)] = (closed, [len(r) for r in rows[1:] if len(r) > 1 or r[0].strip(' \n"')])
    small_splits(64)
    csv_records.read_lines(spark, paths).coalesce(8).write.parquet(f"{tmp_path}/lines")
    small_splits.restore()
    lines = spark.read.parquet(f"{tmp_path}/lines")
    csv_records.file_report(lines).write.parquet(f"{tmp_path}/report")
    report = spark.read.parquet(f"{tmp_path}/report")
    problems = {r["path"]: r["problem"] for r in report.collect()}
    found = {}
    records = csv_records.read_records(lines, report)
    counted = records.withColumn("n", csv_records.field_count(F.col("text")))
    for r in counted.where("n > 1 or trim(both ' \\n\"' from text) <> ''").collect():
        found.setdefault(r["path"], []).append(((r["block"], r["line"]), r["n"]))
    odd = 0
    for path, (closed, rows) in want.items():
        if '"' in open(path, encoding="utf-8").read().replace('""', ""):
            odd += 1
        if closed:
            assert problems[path] is None
            assert [n for _, n in sorted(found.get(path, []))] == rows, open(path).read()
        else:
            assert problems[path] == csv_records.NOT_CLOSED and path not in found
    assert odd > 20 and sum(closed for closed, _ in want.values()) > 10


def test_unclosed_quotes_and_other_encodings_are_problems(spark, study, tmp_path, small_splits):
    """Files that cannot be read to their end give no rows, and all others still load."""
    one, two = f"{HEAD}S1,1,2022-01-05,X,a\n", f"S3,1,2022-01-05,X,c\nS4,1,2022-01-05,X,d\n"
    put_study(tmp_path, f'{one}S2,1,2022-01-05,X,"open\n{two}'.encode())
    # Behind what is read of a header.
    filler = "".join(f"T{i},1,2022-01-05,X,{'z' * 2000}\n" for i in range(600))
    put_study(tmp_path, (one + filler).encode() + b"S9,1,2022-01-05,X,\xe9\n", "CD")
    put(tmp_path / "PROTECTED/XEF/XEF_metadata.csv", (one + two).encode())
    subjects, bad, problems = loaded(study, tmp_path)
    told = sorted((r["study_id"], r["problem"]) for r in problems.collect())
    assert told == [("AB", "a quote is not closed"), ("CD", "not UTF-8 text")]
    assert sorted((r["study_id"], r["subject_id"]) for r in subjects.collect()) == [
        ("EF", "S1"), ("EF", "S3"), ("EF", "S4"),
    ]
    small_splits(16384)
    again, _, problems = loaded(study, tmp_path, "again")
    assert again.count() == 3 and problems.count() == 2
    base = f"{tmp_path}/tables"
    from tidegauge.sinks import tables

    tables.publish(study, f"{base}/study")
    with pytest.raises(ValueError, match="not closed|not UTF-8"):
        imports.import_subjects(spark, str(tmp_path), base, strict=True)


def test_headers_that_cannot_be_read(spark, study, tmp_path):
    put_study(tmp_path, "Subject ID,Active,Consent,Study,né\nS1,1,2022-01-05,X,é\n".encode("latin-1"))
    put_study(tmp_path, b"Subject ID,Active,Consent,Study\nS1,1,2022-01-05,X\n", "CD")
    folder = tmp_path / "PROTECTED/XEF/XEF_metadata.csv"
    folder.mkdir(parents=True)
    (folder / "part-0").mkdir()
    subjects, _, problems = loaded(study, tmp_path)
    told = {r["study_id"]: r["problem"] for r in problems.collect()}
    assert told == {"AB": "not UTF-8 text", "EF": "Is a directory"}
    assert [r["study_id"] for r in subjects.collect()] == ["CD"]


def test_roots_with_characters_of_patterns(spark, study, tmp_path):
    home = tmp_path / "a[bc]{d}*?+ %41"
    put_study(home, f"{HEAD}S1,1,2022-01-05,X,n\r\nS2,1,2022-01-05,X,\"m\r\nm\"\r\n".encode())
    subjects, _, _ = imports.load_subjects(study, str(home), f"{tmp_path}/work")
    notes = {r["subject_id"]: json.loads(r["optional_notes"])["Note"] for r in subjects.collect()}
    assert notes == {"S1": "n", "S2": "m\r\nm"}


def test_column_names():
    assert study_csv._column_names(["a", "", "a", "b", "a"]) == ["a", "Unnamed: 1", "a.1", "b", "a.2"]


def test_sites(spark, tmp_path):
    sites = [
        {"id": "AB", "name": "O'Neil", "country": "", "country_code": "DE", "network": "P"},
        {"id": "CD", "name": "Cd", "country": "NULL", "country_code": "US", "network": "P"},
    ]
    (tmp_path / "sites.json").write_text(json.dumps(sites, indent=2))
    base = f"{tmp_path}/tables"
    imports.import_sites(spark, f"{tmp_path}/sites.json", base)
    from tidegauge.sinks import tables

    rows = {r["study_id"]: r for r in tables.read_table(spark, f"{base}/study").collect()}
    assert rows["AB"]["study_name"] == "O'Neil"
    assert rows["AB"]["study_country"] is None and rows["AB"]["study_country_code"] == "DE"
    assert rows["CD"]["study_country"] is None
    assert tables.read_table(spark, f"{base}/networks").collect() == [("P",)]
    with pytest.raises(ValueError, match="duplicate keys"):
        imports.import_sites(spark, f"{tmp_path}/sites.json", base)
    assert sites_json.read_sites(spark, f"{tmp_path}/sites.json").count() == 2


def test_sql_access(spark, frames):
    queries.register({"study": frames.study()})
    rows = queries.run_sql(spark, "SELECT network_id FROM study WHERE study_id = :id", id="NATION_1")
    assert queries.fetch_value(rows) == "AMERICA"
    assert queries.fetch_value(rows.where(F.lit(False))) is None
