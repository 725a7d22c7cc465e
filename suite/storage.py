"""Checks of scans and writes: trees, study files and tables that Spark makes from the test tables."""

from __future__ import annotations

import os
from collections.abc import Iterator
from datetime import datetime
from uuid import uuid4

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.check import Check
from suite.dimensions import typed
from suite.files import run_counts
from suite.frames import ROOT, SUBJECT_ID, Frames
from suite.sql import sql
from tidegauge import schemas
from tidegauge.functions.paths import study_dir
from tidegauge.operators import quality, statistics, upsert
from tidegauge.plans import imports
from tidegauge.sinks import tables
from tidegauge.sources import tree, tree_source

RUN = datetime(2024, 2, 3, 4, 5, 6, 789000)
CUTS = (datetime(1998, 7, 1), datetime(2002, 1, 1))


def fresh(f: Frames, name: str) -> str:
    """A new folder for the tables of one query run."""
    return f.scratch(f"{name}-{uuid4().hex[:12]}")


def mounted(folder: str) -> str:
    """Path of a shared folder as tasks see it in the file system."""
    return tree.check_mounted(folder.removeprefix("file://").removeprefix("file:"))


# --- trees and study files made from the tables -----------------------------
def _write_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content, seconds in zip(batch["path"], batch["content"], batch["seconds"]):
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path, "w", encoding="utf-8") as file:
                file.write(content)
            os.utime(path, (seconds, seconds))
        yield pd.DataFrame({"written": [len(batch)]})


def file_tree(f: Frames) -> str:
    """Every catalogue file as a small real file, made once per application."""
    root = mounted(f.scratch("tree/root"))
    done = f.scratch("tree/done")
    if not tables.exists(f.spark, done):
        files = f.files().select(
            F.replace("file_path", F.lit(ROOT), F.lit(root)).alias("path"),
            F.col("k").alias("content"),
            F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01'"), F.col("m_time")).alias("seconds"),
        )
        tables.publish(files.mapInPandas(_write_files, "written bigint"), done)
    return root


def _write_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    task = TaskContext.get().partitionId()
    for number, batch in enumerate(batches):
        for (folder, header), lines in batch.groupby(["folder", "header"]):
            os.makedirs(folder, exist_ok=True)
            coding = "latin-1" if header.endswith("é") else "utf-8"
            with open(f"{folder}/part-{task:05d}-{number:05d}.csv", "w", encoding=coding) as file:
                file.write("\n".join([header, *lines["line"], ""]))
        yield pd.DataFrame({"written": [len(batch)]})


def _write_whole_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by file; a file is begun anew by the task that holds its rows."""
    begun = set()
    for batch in batches:
        for path, lines in batch.groupby("path"):
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path, "a" if path in begun else "w", encoding="utf-8", newline="") as file:
                head = [] if path in begun else ["Subject ID,Active,Consent,Study,Note,Size"]
                file.write("".join(f"{line}\r\n" for line in [*head, *lines["line"]]))
            begun.add(path)
        yield pd.DataFrame({"written": [len(batch)]})


def study_files(f: Frames) -> str:
    """Study metadata files; most subjects have an outdated line before their final one.

    Studies with an odd number have other columns, one of them with a comma in its name.
    A study file is a folder of CSV parts, so that no task has to write a whole study.
    """
    root = mounted(f.scratch("studies/root"))
    done = f.scratch("studies/done")
    if not tables.exists(f.spark, done):
        study = f.study().select(
            "study_id",
            study_dir("network_id", "study_id").alias("dir"),
            (F.col("study_country_code").cast("int") % 2 == 0).alias("plain"),
        )
        rows = typed(f).join(study, "study_id")
        age = "CASE WHEN c_custkey % 3 <> 0 THEN cast(c_custkey % 90 AS string) ELSE '' END"
        lines = rows.selectExpr(
            f"concat('{root}/PROTECTED/', dir, '/', dir, '_metadata.csv') AS folder",
            """CASE WHEN plain THEN 'Subject ID,Active,Consent,Study,Segment'
            ELSE 'Subject ID,"Note, long",Age,Active,Consent,Study' END AS header""",
            f"""concat(CASE WHEN c_mktsegment = 'FURNITURE' THEN ''
                WHEN plain THEN concat_ws(',', `Subject ID`, 0, '2020-01-01', study_id, 'old\\n')
                ELSE concat_ws(',', `Subject ID`, '"old, too"', 1, '0', '2020-01-01', concat(study_id, '\\n')) END,
                CASE WHEN plain THEN concat_ws(',', `Subject ID`, Active, Consent, Study, c_mktsegment)
                ELSE concat_ws(',', `Subject ID`, c_mktsegment, {age}, Active, Consent, Study) END) AS line""",
        )
        tables.publish(lines.mapInPandas(_write_lines, "written bigint"), done)
    return root


# Nations whose study files cannot be used: a lacking column, no file, a quote that is never
# closed, and text in another encoding.
NO_COLUMN, NO_FILE, OPEN_QUOTE, OTHER_CODE = 0, 4, 10, 15


def odd_study_files(f: Frames) -> str:
    """Study files as they should not be, some as above; in the others names clash, some rows have a
    field too many and some lack the last ones.
    """
    root = mounted(f.scratch("odd-studies/root"))
    done = f.scratch("odd-studies/done")
    if not tables.exists(f.spark, done):
        study = f.study().select("study_id", study_dir("network_id", "study_id").alias("dir"))
        rows = f.customers().withColumnRenamed("n_name", "study_id").join(study, "study_id")
        lines = rows.where(f"c_nationkey <> {NO_FILE}").selectExpr(
            f"concat('{root}/PROTECTED/', dir, '/', dir, '_metadata.csv') AS folder",
            f"""CASE c_nationkey WHEN {NO_COLUMN} THEN 'Subject ID,Active,Study'
            WHEN {OPEN_QUOTE} THEN 'Subject ID,Active,Consent,Study,"age'
            WHEN {OTHER_CODE} THEN 'Subject ID,Active,Consent,Study,né'
            ELSE 'Subject ID,Active,Consent,Study,age,Age,study_id,Score' END AS header""",
            f"""concat_ws(',', {SUBJECT_ID}, int(c_acctbal > 0),
                CASE WHEN c_nationkey <> {NO_COLUMN} THEN '2021-01-02' END, study_id,
                CASE WHEN c_nationkey = {NO_COLUMN} THEN NULL
                WHEN c_nationkey IN ({OPEN_QUOTE}, {OTHER_CODE}) OR c_mktsegment = 'HOUSEHOLD'
                THEN cast(c_custkey % 90 AS string)
                ELSE concat_ws(',', c_custkey % 90, c_mktsegment, concat('x', c_custkey), c_custkey * 3) END,
                CASE WHEN c_mktsegment = 'FURNITURE'
                    AND c_nationkey NOT IN ({NO_COLUMN}, {OPEN_QUOTE}, {OTHER_CODE}) THEN 'tail' END) AS line""",
        )
        tables.publish(lines.mapInPandas(_write_lines, "written bigint"), done)
    return root


def whole_study_files(f: Frames) -> str:
    """One file a study, with line breaks, commas and quotes in quoted notes, and quotes in plain cells."""
    root = mounted(f.scratch("whole-studies/root"))
    done = f.scratch("whole-studies/done")
    if not tables.exists(f.spark, done):
        study = f.study().select("study_id", study_dir("network_id", "study_id").alias("dir"))
        rows = f.customers().withColumnRenamed("n_name", "study_id").join(study, "study_id")
        long = "repeat(concat(c_mktsegment, ' '), 40)"
        lines = rows.selectExpr(
            f"concat('{root}/PROTECTED/', dir, '/', dir, '_metadata.csv') AS path",
            "c_custkey AS number",
            f"""concat_ws(',', {SUBJECT_ID}, int(c_acctbal > 0), '2021-01-02', study_id,
                CASE c_custkey % 3 WHEN 0 THEN {long} WHEN 1
                THEN concat('"', {long}, ',\\n\\n""quoted"",\\n"') ELSE concat('"', {long}, '"') END,
                CASE c_custkey % 4 WHEN 0 THEN concat(c_custkey, '" wide') ELSE '' END) AS line""",
        )
        whole = lines.repartition("path").sortWithinPartitions("path", "number")
        tables.publish(whole.mapInPandas(_write_whole_files, "written bigint"), done)
    return root


def split_study_file(f: Frames) -> DataFrame:
    """Whole files read in parts far smaller than a file: a session of its own has the setting."""
    base, root = fresh(f, "split"), whole_study_files(f)
    own = Frames(f.spark.newSession(), f.folder)
    some = max(1024, own.table("customer").count() * 10)
    own.spark.conf.set("spark.sql.files.maxPartitionBytes", str(some))
    own.spark.conf.set("spark.sql.files.openCostInBytes", "1")
    subjects, _, _ = imports.load_subjects(own.study(), root, f"{base}/work")
    tables.publish(subjects, f"{base}/subjects")
    parts = f.spark.read.parquet(f"{base}/work/lines").agg(
        (F.count_distinct("path", "block") > F.count_distinct("path")).alias("in_parts")
    )
    return tables.read_table(f.spark, f"{base}/subjects").withColumn("in_parts", parts.scalar())


def odd_subjects(f: Frames) -> DataFrame:
    """The subjects of such files, with numbers kept as numbers."""
    work = fresh(f, "import")
    subjects, _, _ = imports.load_subjects(f.study(), odd_study_files(f), work, {"Score": "bigint"})
    return subjects


def subject_quarantine(f: Frames) -> DataFrame:
    """Rows of the stored quarantine."""
    base, root = fresh(f, "import"), odd_study_files(f)
    tables.publish(f.study(), f"{base}/study")
    imports.import_subjects(f.spark, root, base)
    stored = tables.read_table(f.spark, f"{base}/subject_quarantine")
    return stored.select("study_id", "subject_id", "problem", "row_text")


def study_problems(f: Frames) -> DataFrame:
    """Studies that cannot be read, from the stored table; a study may have many parts."""
    base, root = fresh(f, "import"), odd_study_files(f)
    tables.publish(f.study(), f"{base}/study")
    imports.import_subjects(f.spark, root, base)
    return tables.read_table(f.spark, f"{base}/study_problems").select("study_id", "problem").distinct()


def schema_orphans(f: Frames) -> DataFrame:
    """Every foreign key of the schema, over tables whose parents lack some rows."""
    return quality.schema_orphans(
        {
            "networks": f.table("region").where("r_regionkey > 0").selectExpr("r_name AS network_id"),
            "study": f.study().where("cast(study_country_code AS int) % 5 <> 4"),
            "subjects": f.subjects().where("is_active"),
            "file_catalog": f.files_base(),
            "volume_statistics": f.snapshots(),
        }
    )


def crawl_files(f: Frames) -> DataFrame:
    root = file_tree(f)
    found = tree.crawl(f.subjects(), f.study(), root, fresh(f, "crawl"))
    return found.select(
        "study_id",
        "subject_id",
        "modality",
        "is_protected",
        "is_raw",
        F.replace("path", F.lit(root), F.lit(ROOT)).alias("file_path"),
        "size_bytes",
        "m_time_micros",
    )


def crawl_subject(f: Frames) -> DataFrame:
    """Listings of parts of the tree: the subject with most files, one pair of flags, one modality."""
    root, files = file_tree(f), f.files_base()
    most = files.groupBy("study_id", "subject_id").agg(F.count("*").alias("n"))
    study, subject = most.orderBy(F.desc("n"), "study_id", "subject_id").first()[:2]
    asked = {
        "subject": {"study_id": study, "subject_id": subject},
        "flags": {"is_protected": False, "is_raw": True},
        "modality": {"study_id": study, "is_protected": True, "is_raw": True, "modality": "mri"},
    }
    parts = [
        tree_source.list_files(f.spark, f.study(), root, **what).withColumn("asked", F.lit(name))
        for name, what in asked.items()
    ]
    found = statistics.union_results(*parts)
    return found.select(
        "asked",
        "study_id",
        "subject_id",
        "modality",
        "is_protected",
        "is_raw",
        F.replace("path", F.lit(root), F.lit(ROOT)).alias("file_path"),
        "size_bytes",
        "m_time_micros",
    )


def import_catalog(f: Frames) -> DataFrame:
    """The whole import into stored tables, with content hashes, read back."""
    base, root = fresh(f, "import"), file_tree(f)
    subjects = f.subjects().withColumn("optional_notes", F.lit("{}")).drop("note")
    tables.publish(f.study(), f"{base}/study")
    tables.publish(subjects.select(*schemas.SUBJECTS.names), f"{base}/subjects")
    imports.import_catalog(f.spark, root, base, fresh(f, "crawl"), RUN, hash_algorithm="md5")
    stored = tables.read_table(f.spark, f"{base}/file_catalog", schemas.CATALOG_WIDE)
    return stored.withColumn("file_path", F.replace("file_path", F.lit(root), F.lit(ROOT)))


def load_subjects(f: Frames) -> DataFrame:
    subjects, _, _ = imports.load_subjects(f.study(), study_files(f), fresh(f, "import"))
    return subjects


def import_subjects(f: Frames) -> DataFrame:
    """Study files merged into a table that holds every customer as an inactive subject."""
    base, root = fresh(f, "import"), study_files(f)
    before = f.subjects().select(
        "study_id",
        "subject_id",
        F.lit(False).alias("is_active"),
        "consent_date",
        F.lit('{"from":"before"}').alias("optional_notes"),
    )
    tables.publish(f.study(), f"{base}/study")
    tables.publish(before, f"{base}/subjects")
    imports.import_subjects(f.spark, root, base)
    return tables.read_table(f.spark, f"{base}/subjects", schemas.SUBJECTS)


def load_sites(f: Frames) -> DataFrame:
    """Nations written as one JSON array of sites, then imported; the array is one file by definition."""
    base = fresh(f, "sites")
    site = F.struct(
        F.col("study_id").alias("id"),
        F.col("study_name").alias("name"),
        F.coalesce("study_country", F.lit("")).alias("country"),
        F.col("study_country_code").alias("country_code"),
        F.col("network_id").alias("network"),
    )
    f.study().agg(F.to_json(F.collect_list(site)).alias("value")).write.text(f"{base}/json")
    imports.import_sites(f.spark, f"{base}/json", base)
    return tables.read_table(f.spark, f"{base}/study", schemas.STUDY)


# --- tables -----------------------------------------------------------------
def append_snapshot(f: Frames) -> DataFrame:
    """Two recounts of the catalogue appended, the second one twice."""
    path = fresh(f, "statistics")
    for cut in (*CUTS, CUTS[-1]):
        known = f.files().where(F.col("m_time") < F.lit(cut.isoformat(sep=" ")).cast("timestamp_ntz"))
        stats = tables.with_run(statistics.volume_statistics(known, f.tags()), cut)
        tables.append_snapshots(stats.select(*schemas.VOLUME_STATISTICS.names), path)
    return tables.read_table(f.spark, path, schemas.VOLUME_STATISTICS)


def upsert_subjects(f: Frames) -> DataFrame:
    """Customers as subjects, then suppliers with the same number merged in."""
    path, key = fresh(f, "subjects"), schemas.PRIMARY_KEYS["subjects"]
    tables.publish(
        f.subjects().withColumnRenamed("note", "optional_notes").select(*schemas.SUBJECTS.names), path
    )
    suppliers = f.table("supplier").join(f.table("nation"), F.expr("s_nationkey = n_nationkey"))
    tables.upsert_table(
        suppliers.selectExpr(
            "n_name AS study_id",
            "concat('S', cast(s_suppkey AS string)) AS subject_id",
            "s_acctbal > 0 AS is_active",
            "date'2021-01-01' AS consent_date",
            "s_name AS optional_notes",
        ),
        path,
        key,
        schemas.SUBJECTS,
    )
    return tables.read_table(f.spark, path, schemas.SUBJECTS)


def upsert_files(f: Frames) -> DataFrame:
    """Files up to a date in buckets of the path, then files from an earlier date on with doubled size."""
    path, key = fresh(f, "files"), schemas.PRIMARY_KEYS["files"]
    rows, buckets = f.file_rows(), f.file_buckets()
    schema = f.files().select("file_path", "file_name", "size_bytes", "m_time").schema
    existing = rows.where("m_time < timestamp_ntz'1999-01-01'")
    new = rows.where("m_time >= timestamp_ntz'1998-01-01'").withColumnRenamed("size_bytes", "first_size")

    def doubled(own: DataFrame) -> DataFrame:
        """The path tells the first size, the row twice as much."""
        named = f.named(own.withColumn("size_bytes", F.col("first_size")))
        return named.withColumn("size_bytes", F.col("first_size") * 2)

    tables.upsert_buckets(existing, path, key, schema, buckets, replace=True, made=f.named)
    tables.upsert_buckets(new, path, key, schema, buckets, made=doubled)
    return tables.read_table(f.spark, path, schema)


def rejected_versions(f: Frames) -> DataFrame:
    """Writes that break a key or lack parents, how many rows did so, and what can be read afterwards."""
    base, key = fresh(f, "rejected"), schemas.PRIMARY_KEYS["subjects"]
    subjects = f.subjects().withColumnRenamed("note", "optional_notes").select(*schemas.SUBJECTS.names)
    some = f.study().where("cast(study_country_code AS int) % 5 <> 4")
    twice = f.table("orders").join(f.customers(), F.expr("o_custkey = c_custkey")).selectExpr(
        "n_name AS study_id",
        f"{SUBJECT_ID} AS subject_id",
        "true AS is_active",
        "date'2021-01-01' AS consent_date",
        "'{}' AS optional_notes",
    )
    tables.publish(subjects, f"{base}/subjects", rules=tables.Rules(key, {("study_id",): f.study()}))
    catalog = f.stored_catalog()
    # In slices of buckets, of which one is shuffled at a time.
    rows = tables.read_slices(f.spark, catalog, schemas.CATALOG_WIDE, f.file_slices())
    active = f.subjects().where("is_active")
    parent = {("study_id", "subject_id"): active}
    path_key = schemas.PRIMARY_KEYS["file_catalog"]

    def refused(write) -> list[tuple[str, int]]:
        try:
            write()
        except tables.KeyViolation as broken:
            return list(broken.counts.items())
        return []

    def buckets(new: list[DataFrame], **more):
        return tables.upsert_buckets(
            new, f"{base}/catalog", path_key, schemas.CATALOG_WIDE, f.file_buckets(), sums=tables.GROUPS, **more
        )

    raw = [own.where("is_raw") for own in rows]
    buckets(raw, replace=True)
    found = {
        "subjects": refused(lambda: tables.publish(twice, f"{base}/subjects", rules=tables.Rules(key))),
        "studies": refused(
            lambda: tables.publish(
                subjects, f"{base}/subjects", rules=tables.Rules(key, {("study_id",): some})
            )
        ),
        "catalog": refused(lambda: buckets([a.unionByName(b) for a, b in zip(rows, raw, strict=True)])),
        "owners": refused(lambda: buckets(rows, parents=parent)),
    }
    left = {
        name: tables.read_table(f.spark, f"{base}/{name}").agg(F.count(F.lit(1)).alias("readable"))
        for name in ("subjects", "catalog")
    }
    told = [(name, rule, n) for name, rules in found.items() for rule, n in rules]
    return statistics.union_results(
        f.spark.createDataFrame(told, "attempt string, rule string, rows bigint"),
        *[rows.select(F.lit(name).alias("attempt"), F.lit("readable").alias("rule"), F.col("readable").alias("rows"))
          for name, rows in left.items()],
    )


def insert_conflicts(f: Frames) -> DataFrame:
    """Orders offered as new subjects to a table of active ones."""
    active = f.subjects().where("is_active").select("subject_id")
    offered = f.table("orders").selectExpr("concat('S', cast(o_custkey AS string)) AS subject_id")
    return upsert.insert_conflicts(active, offered, ["subject_id"])


def reload_catalog(f: Frames) -> DataFrame:
    """Old files published, then replaced by the whole catalogue."""
    path = fresh(f, "catalog")
    catalog = f.catalog().withColumn("extracted_timestamp", F.lit(None).cast("timestamp_ntz"))
    catalog = catalog.select(*schemas.FILE_CATALOG.names)
    tables.publish(catalog.where(F.col("is_raw")), path)
    tables.publish(catalog, path, order_by=schemas.CATALOG_ORDER)
    return tables.read_table(f.spark, path, schemas.FILE_CATALOG).drop("extracted_timestamp")


def write_modes(f: Frames) -> DataFrame:
    """Orders written by status: replaced, appended twice, and refused once."""
    path = fresh(f, "orders")
    orders = f.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    tables.write_table(orders, path, "fail")
    tables.write_table(orders.where("o_orderstatus = 'F'"), path, "replace")
    tables.write_table(orders.where("o_orderstatus = 'O'"), path, "append")
    tables.write_table(orders.where("o_orderstatus = 'P'"), path, "append")
    refused = False
    try:
        tables.write_table(orders, path, "fail")
    except FileExistsError:
        refused = True
    return tables.read_table(f.spark, path).withColumn("refused", F.lit(refused))


def empty_tables(f: Frames) -> DataFrame:
    """Row counts of filled tables before and after they are created anew."""
    base = fresh(f, "tables")
    subjects = f.subjects().withColumnRenamed("note", "optional_notes")
    catalog = f.catalog().select("study_id", "subject_id", "file_path", "is_raw", "is_protected", "modality")
    tables.publish(f.study(), f"{base}/study")
    tables.publish(f.study().select("network_id").distinct(), f"{base}/networks")
    tables.publish(subjects.select(*schemas.SUBJECTS.names), f"{base}/subjects")
    tables.publish(catalog, f"{base}/file_catalog")

    def counts(name: str) -> DataFrame:
        now = {t: tables.read_table(f.spark, f"{base}/{t}", s) for t, s in schemas.TABLES.items()}
        return statistics.run_counts(**now).withColumnRenamed("found", name)

    before = counts("rows_before")
    tables.recreate_tables(f.spark, base)
    return before.join(counts("rows_after"), "what")


def job_log(f: Frames) -> DataFrame:
    path = fresh(f, "logs")
    messages = run_counts(f).select(
        F.concat(F.lit("Found "), F.col("found").cast("string"), F.lit(" "), F.col("what")).alias("message")
    )
    tables.append_log(messages, path, "import", RUN)
    return tables.read_table(f.spark, path, schemas.LOGS).drop("log_id")


_RUN_SQL = "timestamp '2024-02-03 04:05:06.789'"
_SNAPSHOT_SQL = """SELECT study_id, subject_id, is_raw, is_protected, modality, count(*) AS files_count,
    sum(size_bytes)::bigint / 1048576.0::double AS files_size_mb, sum(size_bytes)::bigint AS size_bytes,
    timestamp '{0}' AS statistics_timestamp, date '{0}' AS snapshot_date,
    '{1}T000000000000' AS run_id FROM labelled WHERE m_time < timestamp '{0}' GROUP BY ALL"""

CHECKS = {
    "crawl_files": Check(
        crawl_files,
        sql(
            """SELECT study_id, subject_id, modality, is_protected, is_raw, file_path,
            strlen(k)::bigint AS size_bytes, epoch_us(m_time) AS m_time_micros FROM cat""",
            "cat",
        ),
    ),
    "crawl_subject": Check(
        crawl_subject,
        sql(
            """SELECT asked, study_id, subject_id, modality, is_protected, is_raw, file_path,
            strlen(k)::bigint AS size_bytes, epoch_us(m_time) AS m_time_micros
            FROM cat, (SELECT study_id AS s, subject_id AS u FROM cat GROUP BY ALL
                       ORDER BY count(*) DESC, s, u LIMIT 1), (VALUES ('subject'), ('flags'), ('modality')) AS a(asked)
            WHERE CASE asked WHEN 'subject' THEN study_id = s AND subject_id = u
            WHEN 'flags' THEN NOT is_protected AND is_raw
            ELSE study_id = s AND is_protected AND is_raw AND modality = 'mri' END""",
            "cat",
        ),
    ),
    "import_catalog": Check(
        import_catalog,
        sql(
            f"""SELECT study_id, subject_id, file_path, is_raw, is_protected, modality,
            {_RUN_SQL} AS extracted_timestamp, CASE WHEN tag IS NULL THEN '{{}}'
            WHEN modality = 'phone' THEN concat('{{"mindlamp_type":"', tag, '"}}')
            ELSE concat('{{"redcap_instance":"', tag, '"}}') END AS metadata,
            CASE WHEN modality = 'phone' THEN tag END AS mindlamp_type,
            CASE WHEN modality <> 'phone' THEN tag END AS redcap_instance, file_name,
            CASE WHEN modality IN ('phone', 'surveys') THEN '.json' WHEN modality = 'mri' THEN '.zip'
            WHEN modality = 'eeg' THEN '.eeg' WHEN file_name LIKE '%.tar.gz' THEN '.gz'
            WHEN file_name LIKE '%.csv' THEN '.csv' ELSE '' END AS file_type,
            strlen(k) / 1048576.0::double AS file_size_mb, m_time, md5(k) AS md5,
            strlen(k)::bigint AS size_bytes FROM cat""",
            "cat",
        ),
    ),
    "load_subjects": Check(load_subjects, sql("SELECT * FROM loaded", "loaded")),
    "import_subjects": Check(
        import_subjects,
        sql(
            """SELECT * FROM loaded UNION ALL
            SELECT study_id, subject_id, false, consent_date, '{"from":"before"}' FROM adp_subjects
            ANTI JOIN loaded USING (study_id, subject_id)""",
            "loaded",
            "adp_subjects",
        ),
    ),
    "odd_subjects": Check(
        odd_subjects,
        """SELECT n_name AS study_id, concat('S', c_custkey::varchar) AS subject_id, c_acctbal > 0 AS is_active,
        date '2021-01-02' AS consent_date,
        CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN concat('{"age":"', (c_custkey % 90)::varchar, '"}')
        ELSE concat('{"Age":"', c_mktsegment, '","Score":', (c_custkey * 3)::varchar, ',"age":"',
                    (c_custkey % 90)::varchar, '","study_id":"x', c_custkey::varchar, '"}') END AS optional_notes
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        WHERE c_nationkey NOT IN (0, 4, 10, 15) AND c_mktsegment <> 'FURNITURE'""",
    ),
    "subject_quarantine": Check(
        subject_quarantine,
        """SELECT n_name AS study_id, concat('S', c_custkey::varchar) AS subject_id,
        'more fields than the header' AS problem,
        concat_ws(',', concat('S', c_custkey::varchar), (c_acctbal > 0)::int::varchar, '2021-01-02', n_name,
            (c_custkey % 90)::varchar, c_mktsegment, concat('x', c_custkey::varchar), (c_custkey * 3)::varchar,
            'tail') AS row_text
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        WHERE c_nationkey NOT IN (0, 4, 10, 15) AND c_mktsegment = 'FURNITURE'""",
    ),
    "study_problems": Check(
        study_problems,
        """SELECT n_name AS study_id, CASE WHEN n_nationkey = 4 OR n_nationkey NOT IN (SELECT c_nationkey FROM customer)
        THEN 'no metadata file' WHEN n_nationkey = 0 THEN 'missing column: Consent'
        WHEN n_nationkey = 10 THEN 'a quote is not closed' ELSE 'not UTF-8 text' END AS problem FROM nation
        WHERE n_nationkey IN (0, 4, 10, 15) OR n_nationkey NOT IN (SELECT c_nationkey FROM customer)""",
    ),
    "split_study_file": Check(
        split_study_file,
        r"""SELECT n_name AS study_id, concat('S', c_custkey::varchar) AS subject_id, c_acctbal > 0 AS is_active,
        date '2021-01-02' AS consent_date,
        concat('{"Note":"', repeat(concat(c_mktsegment, ' '), 40),
            CASE WHEN c_custkey % 3 = 1 THEN ',\n\n\"quoted\",\n' ELSE '' END, '"',
            CASE WHEN c_custkey % 4 = 0 THEN concat(',"Size":"', c_custkey::varchar, '\" wide"') ELSE '' END, '}')
            AS optional_notes, true AS in_parts
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "schema_orphans": Check(
        schema_orphans,
        sql(
            """SELECT 'study' AS child, 'networks' AS parent, count(DISTINCT n_regionkey) AS orphan_keys,
            count(*) AS orphan_rows FROM nation WHERE n_regionkey = 0 AND n_nationkey % 5 <> 4
            UNION ALL SELECT 'subjects', 'study', count(DISTINCT c_nationkey), count(*) FROM customer
            WHERE c_acctbal > 0 AND c_nationkey % 5 = 4
            UNION ALL SELECT 'file_catalog', 'subjects', count(DISTINCT subject_id), count(*) FROM cat
            ANTI JOIN (SELECT * FROM adp_subjects WHERE is_active) USING (study_id, subject_id)
            UNION ALL SELECT 'volume_statistics', 'subjects', count(DISTINCT subject_id), count(*) FROM stats
            ANTI JOIN (SELECT * FROM adp_subjects WHERE is_active) USING (study_id, subject_id)""",
            "cat",
            "stats",
            "adp_subjects",
        ),
    ),
    "load_sites": Check(load_sites, sql("SELECT * FROM adp_study", "adp_study")),
    "append_snapshot": Check(
        append_snapshot,
        sql(
            f"{_SNAPSHOT_SQL.format('1998-07-01', '19980701')} UNION ALL "
            f"{_SNAPSHOT_SQL.format('2002-01-01', '20020101')}",
            "labelled",
        ),
    ),
    "upsert_subjects": Check(
        upsert_subjects,
        sql(
            """WITH new AS (SELECT n_name AS study_id, concat('S', s_suppkey::varchar) AS subject_id,
            s_acctbal > 0 AS is_active, date '2021-01-01' AS consent_date, s_name AS optional_notes
            FROM supplier JOIN nation ON s_nationkey = n_nationkey)
            SELECT * FROM new UNION ALL
            SELECT study_id, subject_id, is_active, consent_date, note FROM adp_subjects
            ANTI JOIN new USING (study_id, subject_id)""".replace("WITH new AS", "SELECT * FROM (WITH new AS", 1) + ")",
            "adp_subjects",
        ),
    ),
    "upsert_files": Check(
        upsert_files,
        sql(
            """SELECT file_path, file_name, CASE WHEN m_time >= timestamp '1998-01-01' THEN size_bytes * 2
            ELSE size_bytes END AS size_bytes, m_time FROM cat""",
            "cat",
        ),
    ),
    "rejected_versions": Check(
        rejected_versions,
        sql(
            """SELECT 'subjects' AS attempt, 'study_id, subject_id given again' AS rule,
            count(*) - count(DISTINCT o_custkey) AS rows FROM orders SEMI JOIN customer ON o_custkey = c_custkey
            UNION ALL SELECT 'studies', 'no parent for study_id', count(*) FROM customer WHERE c_nationkey % 5 = 4
            UNION ALL SELECT 'catalog', 'file_path given again', count(*) FROM cat WHERE is_raw
            UNION ALL SELECT 'owners', 'no parent for study_id, subject_id', count(*) FROM cat
            ANTI JOIN (SELECT * FROM adp_subjects WHERE is_active) USING (study_id, subject_id)
            UNION ALL SELECT 'subjects', 'readable', count(*) FROM customer
            UNION ALL SELECT 'catalog', 'readable', count(*) FROM cat WHERE is_raw""",
            "cat",
            "adp_subjects",
        ),
    ),
    "insert_conflicts": Check(
        insert_conflicts,
        sql(
            """SELECT concat('S', o_custkey::varchar) AS subject_id, count(*) AS offered,
            bool_or(o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)) AS "exists"
            FROM orders GROUP BY o_custkey HAVING offered > 1 OR "exists" """
        ),
    ),
    "reload_catalog": Check(
        reload_catalog,
        sql(
            """SELECT study_id, subject_id, file_path, is_raw, is_protected, modality,
            CASE WHEN tag IS NULL THEN '{}' WHEN modality = 'phone' THEN concat('{"mindlamp_type":"', tag, '"}')
            ELSE concat('{"redcap_instance":"', tag, '"}') END AS metadata FROM cat""",
            "cat",
        ),
    ),
    "write_modes": Check(
        write_modes,
        "SELECT o_orderkey, o_custkey, o_orderstatus, true AS refused FROM orders",
    ),
    "empty_tables": Check(
        empty_tables,
        """SELECT what, rows_before, 0::bigint AS rows_after FROM (
        SELECT 'logs' AS what, 0::bigint AS rows_before
        UNION ALL SELECT 'volume_statistics', 0
        UNION ALL SELECT 'networks', count(DISTINCT n_regionkey) FROM nation
        UNION ALL SELECT 'study', count(*) FROM nation
        UNION ALL SELECT 'subjects', count(*) FROM customer
        UNION ALL SELECT 'file_catalog', count(*) FROM lineitem)""",
    ),
    "job_log": Check(
        job_log,
        f"""SELECT 'import' AS log_module, message AS log_message, {_RUN_SQL} AS log_timestamp FROM (
        SELECT concat('Found ', count(*)::varchar, ' files') AS message FROM lineitem
        UNION ALL SELECT concat('Found ', count(*)::varchar, ' subjects') FROM customer
        UNION ALL SELECT concat('Found ', count(DISTINCT n_regionkey)::varchar, ' networks') FROM nation)""",
    ),
}
