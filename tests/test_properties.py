"""Relations that must hold between results, also on skewed data."""

import random

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import quality, statistics


def test_statistics_add_up_to_the_catalogue(frames):
    files = frames.files()
    rows = statistics.volume_statistics(files, frames.tags())
    main = rows.where(~F.col("modality").contains("_")).agg(F.sum("files_count"), F.sum("size_bytes")).first()
    whole = files.agg(F.count(F.lit(1)), F.sum("size_bytes")).first()
    assert tuple(main) == tuple(whole)


def test_sub_types_do_not_exceed_their_parent(frames):
    rows = statistics.volume_statistics(frames.files(), frames.tags())
    keys = ["study_id", "subject_id", "is_protected", "is_raw"]
    parts = rows.where(F.col("modality").contains("_"))
    parts = parts.groupBy(*keys, F.split("modality", "_")[0].alias("modality")).agg(
        F.sum("files_count").alias("part")
    )
    joined = parts.join(rows, [*keys, "modality"], "left")
    assert joined.where("files_count IS NULL OR part > files_count").count() == 0
    assert joined.count() > 0


def test_differences_add_up(frames):
    from suite.flows import diffs

    found = diffs(frames).groupBy("network_id", "modality").agg(
        F.sum("files_count_diff").alias("grown"),
        (F.max_by("files_count", "statistics_timestamp") - F.min_by("files_count", "statistics_timestamp")).alias("ends"),
    )
    assert found.where("grown <> ends").count() == 0


def test_good_load_has_no_orphans_and_no_duplicates(frames):
    files, subjects, study = frames.files(), frames.subjects(), frames.study()
    assert quality.fk_orphans(subjects, study, ["study_id"]).count() == 0
    assert quality.fk_orphans(files, subjects, ["study_id", "subject_id"]).count() == 0
    assert quality.pk_duplicates(files, ["file_path"]).count() == 0
    assert quality.pk_duplicates(subjects, ["study_id", "subject_id"]).count() == 0


@pytest.fixture
def skewed(spark):
    """One subject owns a third of all files; sizes are such that float sums would differ."""
    rng = random.Random(7)
    rows = []
    for i in range(6000):
        subject = "HOT" if i % 3 == 0 else f"S{rng.randrange(200)}"
        modality = rng.choice(["phone", "surveys", "mri"])
        names = {"phone": ["_sensor_", "_activity_", "_x_"], "surveys": [".UPENN_nda", ".Pronet", ".Prescient"]}
        name = f"f{rng.choice(names.get(modality, ['']))}{i}.json" if modality == "phone" else f"{i}{rng.choice(names.get(modality, ['']))}.json"
        rows.append(("AB", subject, modality, rng.random() < 0.7, rng.random() < 0.7, name, rng.randrange(1, 2**40)))
    ddl = "study_id string, subject_id string, modality string, is_protected boolean, is_raw boolean, file_name string, size_bytes bigint"
    return rows, spark.createDataFrame(rows, ddl)


def test_statistics_equal_brute_force_on_a_hot_subject(skewed):
    from tidegauge.functions.paths import tag_columns

    rows, table = skewed
    expected: dict[tuple, list[int]] = {}
    for study, subject, modality, protected, raw, name, size in rows:
        labels = [modality]
        if protected and raw and modality == "phone":
            labels += [f"phone_{s}" for s in ("sensor", "activity") if f"_{s}_" in name]
        if protected and raw and modality == "surveys":
            labels += ["surveys_UPENN"] if name.endswith("UPENN_nda.json") else ["surveys_MGB"]
        for label in labels:
            total = expected.setdefault((study, subject, label, protected, raw), [0, 0])
            total[0] += 1
            total[1] += size
    found = statistics.volume_statistics(table, tag_columns("file_name", "modality", "is_protected", "is_raw"))
    keys = statistics.STAT_KEYS
    assert {tuple(r[k] for k in keys): [r["files_count"], r["size_bytes"]] for r in found.collect()} == expected


def test_tags_from_json_give_the_same_statistics(skewed):
    from tidegauge.functions.paths import tag_columns, tag_json

    _, table = skewed
    tags = tag_columns("file_name", "modality", "is_protected", "is_raw")
    stored = table.withColumn("metadata", tag_json(tags))
    a = statistics.volume_statistics(table, tags)
    b = statistics.volume_statistics(stored)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rollup_levels_agree(spark, frames):
    rows = statistics.summary_rollup(frames.files_base()).cache()
    totals = {r["level"]: r["n"] for r in rows.groupBy("level").agg(F.sum("files_count").alias("n")).collect()}
    rows.unpersist()
    assert set(totals) == {0, 1, 3, 7, 15} and len(set(totals.values())) == 1
