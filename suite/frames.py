"""The given test tables seen as catalogue, dimensions and snapshots.

region = network, nation = study, customer = subject, lineitem row = file, order
priority = modality, order and line status = flags, ship date = modification time,
extended price in cents = size in bytes.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge import schemas
from tidegauge.functions.paths import tag_columns, tag_json
from tidegauge.functions.values import bytes_to_mb
from tidegauge.operators.statistics import STAT_KEYS, volume_statistics
from tidegauge.session import shared_folder
from tidegauge.sinks import parts, tables, versions

NETWORKS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
COHORTS = ("CHR", "HC")
ROOT = "/data/root"

SUBJECT_ID = "concat('S', cast(c_custkey AS string))"
EVENT_CENTS = "cast(round(value * 100) AS bigint)"

MODALITY = """CASE o_orderpriority WHEN '1-URGENT' THEN 'phone' WHEN '2-HIGH' THEN 'surveys'
    WHEN '3-MEDIUM' THEN 'mri' WHEN '4-NOT SPECIFIED' THEN 'eeg' ELSE 'interviews' END"""

FILE_CENTS = "cast(round(l_extendedprice * 100) AS bigint)"

FILE_NUMBERS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

FILE_KEY = f"""concat_ws('-', {", ".join(f"cast({number} AS string)" for number in FILE_NUMBERS)},
    replace(cast(cast(m_time AS date) AS string), '-', ''), cast(size_bytes AS string))"""

FILE_NAME = """CASE modality
    WHEN 'phone' THEN concat('u_', CASE rf WHEN 'A' THEN 'sensor' WHEN 'N' THEN 'activity'
                                   ELSE 'other' END, '_', k, '.json')
    WHEN 'surveys' THEN concat('s_', k, '.', CASE rf WHEN 'A' THEN 'UPENN_nda' WHEN 'N' THEN 'Pronet'
                                             ELSE 'Prescient' END, '.json')
    WHEN 'mri' THEN concat('m_', k, '.zip')
    WHEN 'eeg' THEN concat('e_', k, CASE rf WHEN 'A' THEN '.eeg.lock' ELSE '.eeg' END)
    ELSE concat('i_', k, CASE rf WHEN 'A' THEN '.tar.gz' WHEN 'N' THEN '.csv' ELSE '' END) END"""

FILE_PATH = f"""concat_ws('/', '{ROOT}', CASE WHEN is_protected THEN 'PROTECTED' ELSE 'GENERAL' END,
    concat(upper(substr(network_id, 1, 1)), lower(substr(network_id, 2)), study_id),
    CASE WHEN is_raw THEN 'raw' ELSE 'processed' END, subject_id, modality, file_name)"""

# File rows are shuffled in slices of so many, up to the second number of slices, each with its own scan.
_SLICE_ROWS, _MOST_SLICES = 1_000_000, 16

_schemas: dict[str, object] = {}


@dataclass(frozen=True)
class Frames:
    """Lazy frames over one folder of test tables."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        """A given table; its schema is read from the file only once."""
        path = f"{self.folder}/{name}.parquet"
        reader = self.spark.read
        if path in _schemas:
            return reader.schema(_schemas[path]).parquet(path)
        found = reader.parquet(path)
        _schemas[path] = found.schema
        return found

    # --- dimensions ---------------------------------------------------------
    def study(self) -> DataFrame:
        nations = self.table("nation").join(
            self.table("region"), F.expr("n_regionkey = r_regionkey")
        )
        return nations.selectExpr(
            "n_name AS study_id",
            "n_name AS study_name",
            "nullif(cast(n_nationkey AS string), '0') AS study_country",
            "cast(n_nationkey AS string) AS study_country_code",
            "r_name AS network_id",
        )

    def customers(self) -> DataFrame:
        return self.table("customer").join(
            self.table("nation"), F.expr("c_nationkey = n_nationkey")
        )

    def subjects(self) -> DataFrame:
        return self.customers().selectExpr(
            "n_name AS study_id",
            f"{SUBJECT_ID} AS subject_id",
            "c_acctbal > 0 AS is_active",
            "date_add(date'2020-01-01', cast(c_custkey % 1000 AS int)) AS consent_date",
            "c_mktsegment AS note",
        )

    def recruitment_status(self) -> DataFrame:
        return self.table("customer").selectExpr(
            f"{SUBJECT_ID} AS subject_id",
            "CASE WHEN c_acctbal > 0 THEN 'recruited' ELSE 'screening' END AS recruitment_status",
        )

    def recruitment_filters(self) -> DataFrame:
        return self.table("customer").selectExpr(
            f"{SUBJECT_ID} AS subject",
            "CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE') THEN 'CHR' "
            "ELSE 'HC' END AS cohort",
        )

    def site_subjects(self) -> DataFrame:
        return self.customers().selectExpr(f"{SUBJECT_ID} AS id", "n_name AS site_id")

    def sites(self) -> DataFrame:
        return self.study().selectExpr(
            "study_id AS id",
            "study_name AS site_name",
            "study_country AS site_country",
            "study_country_code AS site_country_code",
            "network_id",
        )

    # --- files --------------------------------------------------------------
    def file_slices(self) -> int:
        """In how many slices large steps over all files are made."""
        return max(1, min(_MOST_SLICES, -(-self.table("lineitem").count() // _SLICE_ROWS)))

    def file_rows(self, number: int = 0, slices: int = 1) -> DataFrame:
        """Files with the numbers that their key is made of; all of them, or a slice by order.

        Orders meet their subject first, so the file rows are shuffled for one join only, with the few
        bytes that files need.

        Customers, orders and files all grow with the data, so these two joins
        are merge joins whatever the sizes: they spill, and a hot key is split by
        the skew join. Studies and networks are left to Spark's size check.
        """
        subject = self.customers().join(
            self.table("region"), F.expr("n_regionkey = r_regionkey")
        )
        placed, items = self.table("orders"), self.table("lineitem")
        if slices > 1:
            own = F.pmod(F.xxhash64(F.col("order").cast("bigint")), F.lit(slices)) == number
            placed, items = (
                rows.withColumn("order", F.col(key)).where(own).drop("order")
                for rows, key in ((placed, "o_orderkey"), (items, "l_orderkey"))
            )
        orders = (
            placed.join(subject.hint("merge"), F.expr("o_custkey = c_custkey"))
            .selectExpr(
                "o_orderkey",
                "r_name AS network_id",
                "n_name AS study_id",
                f"{SUBJECT_ID} AS subject_id",
                f"{MODALITY} AS modality",
                "o_orderstatus <> 'P' AS is_protected",
            )
        )
        items = items.selectExpr(
            *FILE_NUMBERS,
            "l_linestatus = 'O' AS is_raw",
            "l_returnflag AS rf",
            f"{FILE_CENTS} AS size_bytes",
            "l_shipdate AS m_time",
        )
        return items.join(orders.hint("merge"), F.expr("l_orderkey = o_orderkey")).select(
            "network_id",
            "study_id",
            "subject_id",
            "modality",
            "is_protected",
            "is_raw",
            "rf",
            "size_bytes",
            "m_time",
            *FILE_NUMBERS,
        )

    def files_base(self) -> DataFrame:
        return self.file_rows().selectExpr("*", f"{FILE_KEY} AS k").drop(*FILE_NUMBERS)

    def named(self, rows: DataFrame) -> DataFrame:
        """Adds key, name and path to rows of files."""
        keyed = rows.selectExpr("*", f"{FILE_KEY} AS k")
        return keyed.selectExpr("*", f"{FILE_NAME} AS file_name").selectExpr("*", f"{FILE_PATH} AS file_path")

    def files(self, number: int = 0, slices: int = 1) -> DataFrame:
        """The file catalogue with path, name and size; all of it, or a slice by order."""
        return self.named(self.file_rows(number, slices)).drop("rf", *FILE_NUMBERS)

    def tags(self) -> dict[str, Column]:
        return tag_columns("file_name", "modality", "is_protected", "is_raw")

    def catalog(self, files: DataFrame | None = None) -> DataFrame:
        """Placement of files, with the tags as JSON."""
        return (self.files() if files is None else files).select(
            "study_id",
            "subject_id",
            "file_path",
            "is_raw",
            "is_protected",
            "modality",
            tag_json(self.tags()).alias("metadata"),
        )

    def file_sizes(self, files: DataFrame | None = None) -> DataFrame:
        return (self.files() if files is None else files).select(
            "file_path", "file_name", "size_bytes", bytes_to_mb("size_bytes").alias("file_size_mb"), "m_time"
        )

    # --- snapshots ----------------------------------------------------------
    def monthly_counts(self, number: int = 0, slices: int = 1) -> DataFrame:
        """Files of each subject by the month that they are from; those of a slice of the files add up."""
        month = F.trunc(F.col("m_time").cast("date"), "month")
        counted = volume_statistics(
            self.files(number, slices).withColumn("month", month), self.tags(), [*STAT_KEYS, "month"]
        )
        return counted.drop("files_size_mb")

    def monthly_statistics(self, counted: DataFrame | None = None) -> DataFrame:
        """Full recounts per subject at the start of every month, from the second month on.

        Files are counted once per month (`counted`, of all slices); running sums over the few monthly rows
        of a group give the recounts. A group has no row before its first file. A recount
        holds from `since` until the month before the group's next files.
        """
        keys = STAT_KEYS
        counted = self.monthly_counts() if counted is None else counted
        # One shuffle for these sums and the running ones.
        counted = counted.repartition(*keys).groupBy(*keys, "month").agg(
            F.sum("files_count").alias("files_count"), F.sum("size_bytes").alias("size_bytes")
        )
        last_file = self.table("lineitem").agg(F.max("l_shipdate")).scalar()
        last_month = F.trunc(last_file.cast("date"), "month")
        over = Window.partitionBy(*keys).orderBy("month")
        until = F.coalesce(F.add_months(F.lead("month").over(over), -1), last_month)
        return (
            counted.select(
                *keys,
                "month",
                F.sum("files_count").over(over).alias("files_count"),
                F.sum("size_bytes").over(over).alias("size_bytes"),
                until.alias("until"),
            )
            .where("month IS NOT NULL AND until IS NOT NULL")
            .select(
                "study_id",
                "subject_id",
                "is_raw",
                "is_protected",
                "modality",
                "files_count",
                "size_bytes",
                F.add_months("month", 1).cast("timestamp_ntz").alias("since"),
                F.add_months("until", 1).cast("timestamp_ntz").alias("statistics_timestamp"),
            )
        )

    def scratch(self, name: str) -> str:
        """A folder for written tables of this application and these test tables."""
        return shared_folder(self.spark, f"{self.folder.strip('/').replace('/', '-')}/{name}")

    def _snapshots_path(self) -> str:
        """The monthly recounts as the stored statistics, each stored once for the runs it holds for."""
        path = self.scratch("snapshots")
        if not tables.exists(self.spark, path):
            # In slices of files, then of subjects, so that the shuffles of one slice only are on disk; the counts of a
            # slice of subjects go as soon as its recounts are stored.
            steps, n = self.scratch(f"months-{uuid4().hex[:12]}"), self.file_slices()
            counted = (self.monthly_counts(i, n) for i in range(n))
            subjects = versions.dealt_anew(counted, f"{steps}/counted", n, "study_id", "subject_id")
            tables.append_history(map(self.monthly_statistics, subjects), path, "1 month", "yyyyMMdd")
            versions.delete(self.spark, steps)
        return path

    def runs(self) -> DataFrame:
        return tables.read_runs(self.spark, self._snapshots_path())

    def snapshots(self, runs: DataFrame | None = None) -> DataFrame:
        return tables.read_snapshots(self.spark, self._snapshots_path(), runs)

    # --- the stored catalogue -----------------------------------------------
    def stored_catalog(self) -> str:
        """Path of the catalogue in buckets of the path, with tags as columns and counts beside it."""
        path = self.scratch("catalog")
        if not tables.exists(self.spark, path):
            n = self.file_slices()
            tables.upsert_buckets(
                [self.file_rows(i, n) for i in range(n)],
                path,
                schemas.PRIMARY_KEYS["file_catalog"],
                schemas.CATALOG_WIDE,
                self.file_buckets(),
                replace=True,
                order_by=schemas.CATALOG_ORDER,
                sums=tables.GROUPS,
                options=schemas.CATALOG_OPTIONS,
                made=self.catalog_rows,
            )
        return path

    def catalog_rows(self, rows: DataFrame) -> DataFrame:
        """Adds what the wide catalogue says of files beside what their rows hold."""
        return self.named(rows).withColumns(
            {
                "extracted_timestamp": F.lit(None).cast("timestamp_ntz"),
                "metadata": tag_json(self.tags()),
                **self.tags(),
                "file_type": F.lit(""),
                "file_size_mb": bytes_to_mb("size_bytes"),
                "md5": F.lit(None).cast("string"),
            }
        )

    def file_buckets(self) -> int:
        return parts.buckets_for(self.table("lineitem").count())

    def groups(self) -> DataFrame:
        """Files by study, subject and modality, as kept beside the stored catalogue."""
        return tables.read_groups(self.spark, self.stored_catalog())

    # --- daily series -------------------------------------------------------
    def daily(self) -> DataFrame:
        """Daily increments per subject and modality."""
        events = self.table("events").selectExpr(
            "cast(user_id AS string) AS subject_id",
            "event_type AS modality",
            "cast(ts AS date) AS snapshot_date",
            f"{EVENT_CENTS} AS cents",
        )
        return events.groupBy("subject_id", "modality", "snapshot_date").agg(
            F.count(F.lit(1)).alias("files_count"), F.sum("cents").alias("size_bytes")
        )

    def daily_statistics(self) -> DataFrame:
        """Daily recounts per subject and modality; a user is the customer of the same number.

        Days without events repeat the last recount, so a running series has no gaps.
        """
        keys = ["study_id", "subject_id", "modality"]
        users = self.customers().selectExpr(
            "c_custkey AS user_id", "n_name AS study_id", f"{SUBJECT_ID} AS subject_id"
        )
        events = self.table("events")
        per_user = events.selectExpr(
            "user_id", "event_type AS modality", "cast(ts AS date) AS day", f"{EVENT_CENTS} AS cents"
        )
        per_user = per_user.groupBy("user_id", "modality", "day").agg(
            F.count(F.lit(1)).alias("n"), F.sum("cents").alias("b")
        )
        daily = per_user.join(users, "user_id")
        last_day = events.agg(F.max("ts")).scalar().cast("date")
        over = Window.partitionBy(*keys).orderBy("day")
        until = F.coalesce(F.date_sub(F.lead("day").over(over), 1), last_day)
        return (
            daily.select(
                *keys,
                "day",
                F.sum("n").over(over).alias("files_count"),
                F.sum("b").over(over).alias("size_bytes"),
                until.alias("until"),
            )
            .withColumn("snapshot_date", F.explode(F.sequence("day", "until", F.expr("interval 1 day"))))
            .select(
                *keys,
                F.lit(True).alias("is_protected"),
                F.lit(True).alias("is_raw"),
                "files_count",
                "size_bytes",
                "snapshot_date",
                F.col("snapshot_date").cast("timestamp_ntz").alias("statistics_timestamp"),
            )
        )
