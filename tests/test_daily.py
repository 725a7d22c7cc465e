"""The whole daily chain twice over a tree that grows."""

import datetime as dt
import json
import os

from tidegauge import schemas
from tidegauge.plans import imports, reports
from tidegauge.sinks import tables


def put(path, size):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"x" * size)


def test_two_days(spark, tmp_path):
    root, base = tmp_path / "root", f"{tmp_path}/tables"
    sites = [{"id": "AB", "name": "Ab", "country": "X", "country_code": "XX", "network": "ProNET"}]
    (tmp_path / "sites.json").write_text(json.dumps(sites))
    home = root / "PROTECTED/PronetAB"
    home.mkdir(parents=True)
    (home / "PronetAB_metadata.csv").write_text("Subject ID,Active,Consent,Study\nS1,1,2022-01-05,AB\n")
    put(home / "raw/S1/phone/u_sensor_1.json", 2048)
    put(home / "raw/S1/mri/m.zip", 1024)

    imports.import_sites(spark, f"{tmp_path}/sites.json", base)
    days = [dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 2, 6)]
    for number, run in enumerate(days):
        if number:
            put(home / "raw/S1/phone/u_sensor_2.json", 1536)
        found = imports.import_subjects(spark, str(root), base, strict=True)
        assert found == {"subjects": 1, "quarantine": 0, "problems": 0}
        work = f"{tmp_path}/work{number}"
        found = imports.import_catalog(spark, str(root), base, work, run)
        assert found == {"files": 2 + number, "bytes": 3072 + 1536 * number, "problems": 0}
        found = imports.compute_statistics(spark, base, run)
        assert found == {"rows": 3, "files": 3 + 2 * number}

    assert tables.read_table(spark, f"{base}/file_catalog", schemas.CATALOG_WIDE).count() == 3
    lines, found = reports.notification(spark, base, networks=("ProNET", "PRESCIENT"))
    # Every modality of PRESCIENT stands still, and mri of ProNET.
    assert found["stalled"] == 3 and found["rows"] == lines.where("kind = 'bullet'").count()
    texts = [r["text"] for r in lines.collect()]
    assert "phone - 1 files (1.5 KiB) " in texts
    assert "sensor - 1 files (1.5 KiB) " in texts
    assert "mri - 0 files (0 Bytes) " in texts
    assert texts[-2] == "*Potential Data-Flow issue detected!*"

    chart = reports.flow_chart(spark, base, dt.date(2024, 1, 2), modality="phone", network="pronet")
    points = [(r["day"], r["files_count_diff"]) for r in chart.orderBy("day").collect()]
    assert points == [(dt.date(2024, 1, 1), None), (dt.date(2024, 1, 2), 1)]


def test_upsert_import_keeps_files_that_are_gone(spark, tmp_path):
    root, base = tmp_path / "root", f"{tmp_path}/tables"
    tables.publish(spark.createDataFrame([("AB", "Ab", None, None, "N")], schemas.STUDY), f"{base}/study")
    subject = [("AB", "S1", True, dt.date(2022, 1, 1), "{}")]
    tables.publish(spark.createDataFrame(subject, schemas.SUBJECTS), f"{base}/subjects")
    first, second = root / "PROTECTED/NAB/raw/S1/mri/1", root / "PROTECTED/NAB/raw/S1/mri/2"
    put(first, 10)
    run = dt.datetime(2024, 1, 1)
    imports.import_catalog(spark, str(root), base, f"{tmp_path}/w1", run, replace_existing=False)
    os.remove(first)
    put(second, 20)
    imports.import_catalog(spark, str(root), base, f"{tmp_path}/w2", run, replace_existing=False)
    rows = tables.read_table(spark, f"{base}/file_catalog").collect()
    assert sorted((r["file_name"], r["size_bytes"]) for r in rows) == [("1", 10), ("2", 20)]
    imports.import_catalog(spark, str(root), base, f"{tmp_path}/w3", run)
    assert tables.read_table(spark, f"{base}/file_catalog").count() == 1


def test_command_line(spark, tmp_path, capsys):
    from tidegauge.__main__ import main

    root, base = tmp_path / "root", f"{tmp_path}/tables"
    sites = [{"id": "AB", "name": "Ab", "country": "X", "country_code": "XX", "network": "PRESCIENT"}]
    (tmp_path / "sites.json").write_text(json.dumps(sites))
    home = root / "PROTECTED/PrescientAB"
    put(home / "raw/S1/eeg/e.eeg.lock", 1024)
    lines = "Subject ID,Active,Consent,Study\nS1,1,2022-01-05,AB\nS2,1,soon,AB\n"
    (home / "PrescientAB_metadata.csv").write_text(lines)
    main(["--base", base, "init"])
    main(["--base", base, "sites", "--sites", f"{tmp_path}/sites.json"])
    main(["--base", base, "subjects", "--roots", str(root)])
    for day in ("2024-01-01T06:00:00", "2024-01-02T06:00:00"):
        main(["--base", base, "files", "--roots", str(root), "--run", day, "--hash", "md5"])
        main(["--base", base, "statistics", "--run", day])
    main(["--base", base, "report"])
    main(["--base", base, "list", "--roots", str(root), "--subject", "S1", "--modality", "eeg", "--raw"])
    status = [("S1", "recruited"), ("S2", "screening")]
    frames = {
        "status": spark.createDataFrame(status, "subject_id string, recruitment_status string"),
        "subjects": spark.createDataFrame([("S1", "AB"), ("S2", "AB")], "id string, site_id string"),
        "sites": spark.createDataFrame(
            [("AB", "Ab", "X", "PRESCIENT", "XX")],
            "id string, site_name string, site_country string, network_id string, site_country_code string",
        ),
        "filters": spark.createDataFrame([("S1", "CHR"), ("S2", "CHR")], "subject string, cohort string"),
    }
    named = []
    for name, rows in frames.items():
        # One of them is a plain file, the others are stored by this package.
        if name == "sites":
            rows.write.parquet(f"{tmp_path}/{name}")
        else:
            tables.publish(rows, f"{tmp_path}/{name}")
        named += [f"--{name}", f"{tmp_path}/{name}"]
    main(["--base", base, "recruitment", "--as-of", "2024-08-20", *named])
    main(["--base", base, "chart", "eeg", "--network", "prescient", "--as-of", "2024-01-02"])
    shown = capsys.readouterr().out
    assert "eeg - 0 files (0 Bytes) " in shown and "Potential Data-Flow issue" in shown
    assert "2024-01-02" in shown
    assert f"{home}/raw/S1/eeg/e.eeg.lock\t1024\tNone" in shown
    assert "Recruitment Status as of August 20, 2024" in shown
    assert shown[shown.index("PRESCIENT\nCHR") :].startswith("PRESCIENT\nCHR\nConsented: 2\nRecruited: 1\n")
    log = tables.read_table(spark, f"{base}/logs", schemas.LOGS)
    messages = sorted((r["log_module"], r["log_message"]) for r in log.collect())
    # Totals of every job that writes, as counted in the tasks that wrote.
    assert messages == sorted(
        [
            ("sites", "1 networks, 1 studies"),
            ("subjects", "1 subjects, 1 quarantine, 0 problems"),
            ("files", "1 files, 1024 bytes, 0 problems"),
            ("statistics", "1 rows, 1 files"),
            ("statistics", "1 rows, 1 files"),
            ("files", "1 files, 1024 bytes, 0 problems"),
            ("report", "2 rows, 2 stalled"),
            ("recruitment", "4 rows, 2 consented, 1 recruited"),
        ]
    )
    hashed = tables.read_table(spark, f"{base}/file_catalog").first()
    assert len(hashed["md5"]) == 32 and hashed["file_type"] == ".eeg"


def test_unchanged_files_are_not_hashed_again(spark, tmp_path, monkeypatch):
    """A file whose size and time are those of the last catalogue keeps its hash, unless it changed."""
    root, base = tmp_path / "root", f"{tmp_path}/tables"
    tables.publish(spark.createDataFrame([("AB", "Ab", None, None, "N")], schemas.STUDY), f"{base}/study")
    subject = [("AB", "S1", True, dt.date(2022, 1, 1), "{}")]
    tables.publish(spark.createDataFrame(subject, schemas.SUBJECTS), f"{base}/subjects")
    home = root / "PROTECTED/NAB/raw/S1/mri"
    for name in ("same", "grown", "touched", "sneaky"):
        put(home / name, 10)
        os.utime(home / name, (1_700_000_000, 1_700_000_000))
    run = dt.datetime(2024, 1, 1)

    def hashes(work, algorithm="md5"):
        imports.import_catalog(spark, str(root), base, f"{tmp_path}/{work}", run, hash_algorithm=algorithm)
        return {r["file_name"]: r["md5"] for r in tables.read_table(spark, f"{base}/file_catalog").collect()}

    first = hashes("w1")
    put(home / "grown", 11)
    (home / "touched").write_bytes(b"y" * 10)
    # Same size and time, other content: taken over, which shows that the file was not read.
    (home / "sneaky").write_bytes(b"z" * 10)
    os.utime(home / "sneaky", (1_700_000_000, 1_700_000_000))
    second = hashes("w2")
    changed = {name for name in first if first[name] != second[name]}
    assert changed == {"grown", "touched"}
    # Another algorithm reads all of them.
    third = hashes("w3", "sha1")
    assert all(len(h) == 40 for h in third.values()) and len(set(third.values())) == 4
