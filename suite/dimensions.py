"""Checks of dimension lookups, scalar functions and integrity rules."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.check import Check
from suite.frames import COHORTS, NETWORKS, Frames
from suite.sql import sql
from tidegauge.functions import paths, text, times, values
from tidegauge.operators import lookups, quality, recruitment, statistics, upsert
from tidegauge.sources import queries, sites_json, tree

# Customers as typed lines of study metadata; the SQL side has the same in `typed`.
ACTIVE = """CASE WHEN c_mktsegment = 'FURNITURE' AND c_acctbal < 0 THEN 'unknown'
    WHEN c_acctbal > 0 THEN '1' ELSE '0' END"""
CONSENT = """CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 0 THEN '2022-13-05'
    ELSE concat('2021-', cast(c_custkey % 12 + 1 AS string), '-', cast(c_custkey % 28 + 1 AS string)) END"""
STUDY = "CASE WHEN c_acctbal > 9000 THEN 'NA' ELSE n_name END"


def typed(f: Frames) -> DataFrame:
    return f.customers().selectExpr(
        "n_name AS study_id",
        "concat('S', cast(c_custkey AS string)) AS `Subject ID`",
        f"{ACTIVE} AS Active",
        f"{CONSENT} AS Consent",
        f"{STUDY} AS Study",
        "c_custkey",
        "c_mktsegment",
    )


def resolve_roots(f: Frames) -> DataFrame:
    """Study directories under two roots, as far as suppliers and customers put them there."""
    roots = tree.split_roots(f.spark, "/data/a,/data/b")
    study = f.study().select("study_id", paths.study_dir("network_id", "study_id").alias("study_dir"))
    holders = (
        f.table("supplier")
        .where("s_acctbal > 5000")
        .selectExpr("s_nationkey AS key", "'/data/a' AS root")
        .union(
            f.table("customer")
            .where("c_mktsegment = 'MACHINERY' AND c_acctbal > 8500")
            .selectExpr("c_nationkey AS key", "'/data/b' AS root")
        )
        .distinct()
    )
    named = f.table("nation").selectExpr("n_nationkey AS key", "n_name AS study_id")
    existing = holders.join(named, "key").join(study, "study_id").join(roots, "root")
    found = tree.resolve_roots(f.study(), existing.select("pos", "root", "study_dir"))
    return tree.with_study_root(found, is_protected=False)


def fk_orphans(f: Frames) -> DataFrame:
    """Events of users without an active subject, and active subjects without an event."""
    subjects = f.subjects().where("is_active").select("subject_id")
    events = f.table("events").selectExpr("concat('S', cast(user_id AS string)) AS subject_id")
    a = quality.fk_orphans(events, subjects, ["subject_id"])
    b = quality.fk_orphans(subjects, events.distinct(), ["subject_id"])
    return a.select(F.lit("events").alias("child"), "*").unionByName(
        b.select(F.lit("subjects").alias("child"), "*")
    )


def sql_access(f: Frames) -> DataFrame:
    """SQL text with named parameters over registered tables."""
    queries.register({"tracked_study": f.study(), "tracked_subjects": f.subjects()})
    return queries.run_sql(
        f.spark,
        """SELECT network_id, count(*) AS subjects FROM tracked_subjects JOIN tracked_study USING (study_id)
        WHERE consent_date >= :since AND is_active GROUP BY network_id""",
        since=date(2021, 1, 1),
    )


def network_label(f: Frames) -> DataFrame:
    return f.study().select(
        "study_id",
        text.sentence_case("network_id").alias("label"),
        paths.study_dir("network_id", "study_id").alias("study_dir"),
        paths.metadata_file("network_id", "study_id").alias("metadata_file"),
    )


def network_normalise(f: Frames) -> DataFrame:
    """Customers typed a network name in several ways."""
    typed_name = F.expr(
        "CASE c_mktsegment WHEN 'MACHINERY' THEN 'pronet' WHEN 'BUILDING' THEN 'prescient' "
        "WHEN 'AUTOMOBILE' THEN 'ProNET' ELSE c_mktsegment END"
    )
    return f.table("customer").select("c_custkey", text.normalise_network(typed_name).alias("network_id"))


def sentinel_nulls(f: Frames) -> DataFrame:
    country = F.expr(
        "CASE c_mktsegment WHEN 'MACHINERY' THEN '' WHEN 'BUILDING' THEN 'NULL' "
        "WHEN 'AUTOMOBILE' THEN 'nan' WHEN 'FURNITURE' THEN 'The NULL case' ELSE c_mktsegment END"
    )
    return f.table("customer").select(
        "c_custkey",
        text.null_if_any(country, ("", "NULL")).alias("country"),
        text.null_if_any(country, ("", "NULL", "nan")).alias("country_or_nan"),
    )


def camel_tokens(f: Frames) -> DataFrame:
    word = F.expr("concat(replace(initcap(p_name), ' ', ''), p_type, replace(p_brand, '#', 'X'), 'aB')")
    return f.table("part").select(
        "p_partkey", F.array_join(text.camel_tokens(word), " ").alias("tokens")
    )


_CAMEL_WORD = """concat(array_to_string(list_transform(string_split(p_name, ' '),
    lambda w: concat(upper(w[1]), lower(w[2:]))), ''), p_type, replace(p_brand, '#', 'X'), 'aB')"""


def consent_dates(f: Frames) -> DataFrame:
    variants = F.expr(
        """CASE c_mktsegment WHEN 'MACHINERY' THEN cast(cast('2020-01-01' AS date) + cast(c_custkey % 1000 AS int) AS string)
        WHEN 'BUILDING' THEN concat('2021-', cast(c_custkey % 14 AS string), '-', cast(c_custkey % 32 AS string))
        WHEN 'AUTOMOBILE' THEN concat('21-1-', cast(c_custkey % 28 + 1 AS string))
        WHEN 'FURNITURE' THEN concat('2021-02-', cast(c_custkey % 31 AS string), ' ')
        ELSE concat('2021-2-', cast(c_custkey % 31 AS string)) END"""
    )
    return f.table("customer").select(
        "c_custkey", times.parse_date(variants).alias("consent_date")
    )


def seconds_of_day(f: Frames) -> DataFrame:
    return f.table("events").select("event_id", times.seconds_of_day("ts").alias("seconds"))


def date_token(f: Frames) -> DataFrame:
    return f.table("events").select("event_id", times.date_token("ts").alias("token"))


def date_labels(f: Frames) -> DataFrame:
    return f.subjects().select(
        "study_id",
        "subject_id",
        times.long_date("consent_date").alias("long_text"),
        times.short_date("consent_date").alias("short_text"),
    )


def axis_labels(f: Frames) -> DataFrame:
    """Labels over the value range of each user, as many as the user has event types."""
    ranges = f.table("events").groupBy("user_id").agg(
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.count_distinct("event_type").cast("int").alias("n"),
    )
    labels = times.axis_labels("low", F.col("high") * 10, F.col("n") + 1)
    return ranges.select("user_id", F.array_join(labels, " ").alias("labels"))


def content_hash(f: Frames) -> DataFrame:
    return f.table("documents").select(
        "doc_id",
        *[values.content_hash("text", a).alias(a) for a in ("md5", "sha1", "sha256")],
    )


def active_flag(f: Frames) -> DataFrame:
    flag = F.expr(
        "CASE c_mktsegment WHEN 'MACHINERY' THEN cast(c_acctbal AS string) WHEN 'BUILDING' THEN 'yes' "
        "WHEN 'AUTOMOBILE' THEN cast(c_custkey % 3 AS string) WHEN 'FURNITURE' THEN '0.0' ELSE '' END"
    )
    return f.table("customer").select("c_custkey", values.nonzero_flag(flag).alias("is_active"))


def optional_notes(f: Frames) -> DataFrame:
    notes = f.table("customer").selectExpr(
        "c_custkey",
        "CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS Note",
        "CASE WHEN c_custkey % 2 = 0 THEN cast(c_custkey % 90 AS string) END AS Age",
        "CASE WHEN c_custkey % 3 = 0 THEN 'NaN' ELSE cast(c_custkey % 7 AS string) END AS Score",
    )
    packed = values.pack_json(["Age", "Note", "Score"], {"Age": "bigint", "Score": "double"})
    return notes.select("c_custkey", packed.alias("optional_notes"))


def required_fields(f: Frames) -> DataFrame:
    return quality.required_fields(typed(f)).select("study_id", F.col("`Subject ID`").alias("subject_id"))


def unknown_modalities(f: Frames) -> DataFrame:
    """Files and events together; the event types have no chart."""
    files = f.files_base().select("modality")
    events = f.table("events").select(F.col("event_type").alias("modality"))
    return quality.unknown_modalities(files.unionByName(events))


def dedupe_latest(f: Frames) -> DataFrame:
    """The last event of every user, by time and then by id."""
    events = f.table("events").select("user_id", "event_id", "ts", "event_type")
    return upsert.dedupe_latest(events, ["user_id"], ["ts", "event_id"])


def relative_mean(f: Frames) -> DataFrame:
    events = f.table("events").selectExpr(
        "event_type", "user_id", "cast(round(value * 100) AS bigint) AS cents"
    )
    return statistics.relative_mean(events, "event_type", "user_id", "cents")


def _joined(f: Frames) -> DataFrame:
    return recruitment.recruitment_join(
        f.recruitment_status(), f.site_subjects(), f.sites(), f.recruitment_filters()
    )


def _counts(f: Frames) -> DataFrame:
    return recruitment.recruitment_counts(_joined(f), NETWORKS, COHORTS)


def recruitment_lines(f: Frames) -> DataFrame:
    last = f.table("events").agg(F.max("ts")).scalar().cast("date")
    return recruitment.recruitment_lines(_counts(f), last)


_COUNTS_SQL = """SELECT (dense_rank() OVER (ORDER BY network_id) - 1)::int AS network_order, network_id,
    (dense_rank() OVER (ORDER BY cohort) - 1)::int AS cohort_order, cohort, count(*) AS consented,
    count(*) FILTER (WHERE recruitment_status = 'recruited') AS recruited
    FROM recruited GROUP BY network_id, cohort"""

CHECKS = {
    "sql_access": Check(
        sql_access,
        sql(
            """SELECT network_id, count(*) AS subjects FROM adp_subjects JOIN adp_study USING (study_id)
            WHERE consent_date >= date '2021-01-01' AND is_active GROUP BY network_id""",
            "adp_subjects",
            "adp_study",
        ),
    ),
    "list_studies": Check(
        lambda f: lookups.list_studies(f.study()),
        sql("SELECT study_id FROM adp_study ORDER BY study_id", "adp_study"),
    ),
    "study_network": Check(
        lambda f: lookups.study_network(f.study()),
        sql("SELECT study_id, network_id FROM adp_study", "adp_study"),
    ),
    "list_subjects": Check(
        lambda f: lookups.list_subjects(f.subjects()),
        sql("SELECT study_id, subject_id FROM adp_subjects ORDER BY subject_id", "adp_subjects"),
    ),
    "subject_study": Check(
        lambda f: lookups.subject_study(f.subjects()),
        sql("SELECT subject_id, study_id FROM adp_subjects", "adp_subjects"),
    ),
    "networks_from_sites": Check(
        lambda f: sites_json.network_rows(f.sites(), "network_id"),
        sql("SELECT DISTINCT network_id FROM adp_study", "adp_study"),
    ),
    "resolve_roots": Check(
        resolve_roots,
        sql(
            """SELECT study_id, network_id, study_dir, root,
            CASE WHEN root IS NOT NULL THEN concat(root, '/GENERAL/', study_dir) END AS study_root FROM
            (SELECT study_id, network_id,
            concat(upper(substr(network_id, 1, 1)), lower(substr(network_id, 2)), study_id) AS study_dir,
            CASE WHEN study_country_code::int IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) THEN '/data/a'
                 WHEN study_country_code::int IN (SELECT c_nationkey FROM customer
                      WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 8500) THEN '/data/b' END AS root
            FROM adp_study)""",
            "adp_study",
        ),
    ),
    "subjects_with_data": Check(
        lambda f: quality.subjects_with_data(f.subjects(), f.files_base()).drop("note"),
        sql(
            """SELECT study_id, subject_id, is_active, consent_date, is_protected, is_raw
            FROM adp_subjects JOIN (SELECT DISTINCT study_id, subject_id, is_protected, is_raw FROM files_base)
            USING (study_id, subject_id)""",
            "adp_subjects",
            "files_base",
        ),
    ),
    "subjects_without_data": Check(
        lambda f: quality.subjects_without_data(f.subjects(), f.files_base()).drop("note"),
        sql(
            """SELECT study_id, subject_id, is_active, consent_date, is_protected, is_raw
            FROM (SELECT * FROM adp_subjects, (VALUES (true, true), (true, false), (false, true), (false, false))
              t(is_protected, is_raw))
            ANTI JOIN files_base USING (study_id, subject_id, is_protected, is_raw)""",
            "adp_subjects",
            "files_base",
        ),
    ),
    "fk_orphans": Check(
        fk_orphans,
        sql(
            """SELECT 'events' AS child, concat('S', user_id::varchar) AS subject_id, count(*) AS rows FROM events
            WHERE concat('S', user_id::varchar) NOT IN (SELECT subject_id FROM adp_subjects WHERE is_active)
            GROUP BY ALL
            UNION ALL SELECT 'subjects', subject_id, count(*) FROM adp_subjects
            WHERE is_active AND subject_id NOT IN (SELECT concat('S', user_id::varchar) FROM events)
            GROUP BY ALL""",
            "adp_subjects",
        ),
    ),
    "network_label": Check(
        network_label,
        sql(
            """SELECT study_id, label, concat(label, study_id) AS study_dir,
            concat(label, study_id, '_metadata.csv') AS metadata_file FROM
            (SELECT *, concat(upper(network_id[1]), lower(network_id[2:])) AS label FROM adp_study)""",
            "adp_study",
        ),
    ),
    "network_normalise": Check(
        network_normalise,
        """SELECT c_custkey, CASE WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'ProNET'
        WHEN c_mktsegment = 'BUILDING' THEN 'PRESCIENT' ELSE c_mktsegment END AS network_id FROM customer""",
    ),
    "sentinel_nulls": Check(
        sentinel_nulls,
        """SELECT c_custkey, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'nan' WHEN c_mktsegment = 'FURNITURE'
        THEN 'The NULL case' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'HOUSEHOLD' END AS country,
        CASE WHEN c_mktsegment = 'FURNITURE' THEN 'The NULL case'
        WHEN c_mktsegment = 'HOUSEHOLD' THEN 'HOUSEHOLD' END AS country_or_nan FROM customer""",
    ),
    # The separator `~` takes the place of look-ahead: it splits a run of capitals
    # before its last letter, which either starts the next word or is dropped.
    "camel_tokens": Check(
        camel_tokens,
        f"""SELECT p_partkey, lower(array_to_string(regexp_extract_all(
        regexp_replace(regexp_replace(word, '([A-Z]+)([A-Z][a-z])', '\\1~\\2', 'g'),
                       '([A-Z]*)[A-Z]([^A-Za-z~])', '\\1~\\2', 'g'),
        '[A-Z][a-z]+|[A-Z]+'), ' ')) AS tokens
        FROM (SELECT p_partkey, {_CAMEL_WORD} AS word FROM part)""",
    ),
    "consent_dates": Check(
        consent_dates,
        """SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN date '2020-01-01' + (c_custkey % 1000)::int
        WHEN 'BUILDING' THEN try_cast(printf('2021-%02d-%02d', c_custkey % 14, c_custkey % 32) AS date)
        WHEN 'HOUSEHOLD' THEN try_cast(printf('2021-02-%02d', c_custkey % 31) AS date) END AS consent_date
        FROM customer""",
    ),
    "date_labels": Check(
        date_labels,
        sql(
            """SELECT study_id, subject_id, strftime(consent_date, '%B %d, %Y') AS long_text,
            strftime(consent_date, '%b %d') AS short_text FROM adp_subjects""",
            "adp_subjects",
        ),
    ),
    "date_token": Check(
        date_token,
        """SELECT event_id, concat('<!date^', floor(epoch(ts))::bigint::varchar, '^{date_short} {time}|',
        strftime(ts, '%Y-%m-%d %H:%M:%S'), ' UTC>') AS token FROM events""",
    ),
    "seconds_of_day": Check(
        seconds_of_day,
        """SELECT event_id, (extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60)::double
        + (extract(microsecond FROM ts) / 1000000::double) AS seconds FROM events""",
    ),
    "axis_labels": Check(
        axis_labels,
        """SELECT user_id, string_agg(printf('%02d:%02d', floor(moment / 60)::int,
        floor(moment - floor(moment / 60) * 60)::int), ' ' ORDER BY i) AS labels
        FROM (SELECT user_id, i, low + i * ((high - low) / n) AS moment FROM
              (SELECT user_id, min(value) AS low, max(value) * 10 AS high, count(DISTINCT event_type) AS n
               FROM events GROUP BY user_id), range(6) r(i) WHERE i <= n)
        GROUP BY user_id""",
    ),
    "content_hash": Check(
        content_hash,
        "SELECT doc_id, md5(text) AS md5, sha1(text) AS sha1, sha256(text) AS sha256 FROM documents",
    ),
    "active_flag": Check(
        active_flag,
        """SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN c_acctbal <> 0
        WHEN 'AUTOMOBILE' THEN c_custkey % 3 <> 0 WHEN 'FURNITURE' THEN false END AS is_active FROM customer""",
    ),
    "optional_notes": Check(
        optional_notes,
        """SELECT c_custkey, concat('{', concat_ws(',',
        CASE WHEN c_custkey % 2 = 0 THEN concat('"Age":', (c_custkey % 90)::varchar) END,
        CASE WHEN c_acctbal > 0 THEN concat('"Note":"', c_mktsegment, '"') END,
        CASE WHEN c_custkey % 3 <> 0 THEN concat('"Score":', (c_custkey % 7)::varchar, '.0') END),
        '}') AS optional_notes FROM customer""",
    ),
    "required_fields": Check(
        required_fields,
        sql("SELECT study_id, subject_id FROM typed WHERE study <> 'NA'", "typed"),
    ),
    "unknown_modalities": Check(
        unknown_modalities,
        "SELECT event_type AS modality, count(*) AS files_count FROM events GROUP BY event_type",
    ),
    "dedupe_latest": Check(
        dedupe_latest,
        """SELECT user_id, event_id, ts, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    ),
    "relative_mean": Check(
        relative_mean,
        """SELECT event_type, user_id, entity_mean, group_mean, entity_mean - group_mean AS relative_mean FROM
        (SELECT event_type, user_id, sum(cents)::bigint::double / count(*) AS entity_mean,
         (sum(sum(cents)) OVER g)::bigint::double / (sum(count(*)) OVER g)::bigint AS group_mean FROM
         (SELECT event_type, user_id, cast(round(value * 100) AS bigint) AS cents FROM events)
         GROUP BY event_type, user_id WINDOW g AS (PARTITION BY event_type))""",
    ),
    "recruitment_join": Check(
        _joined,
        sql(
            """SELECT subject_id, recruitment_status, site_id, site_name, site_country, network_id,
            site_country_code, cohort FROM recruited""",
            "recruited",
        ),
    ),
    "recruitment_counts": Check(_counts, sql(_COUNTS_SQL, "recruited")),
    "recruitment_lines": Check(
        recruitment_lines,
        sql(
            f"""SELECT network_order, cohort_order, line_order, indent, text FROM ({_COUNTS_SQL}) c,
            LATERAL (SELECT 0 AS line_order, 0 AS indent, concat('Recruitment Status as of ',
                        (SELECT strftime(max(ts), '%B %d, %Y') FROM events)) AS text,
                        c.network_order = 0 AND c.cohort_order = 0 AS shown
                     UNION ALL SELECT 1, 0, c.network_id, c.cohort_order = 0
                     UNION ALL SELECT 2, 0, c.cohort, true
                     UNION ALL SELECT 3, 1, concat('Consented: ', c.consented::varchar), true
                     UNION ALL SELECT 4, 1, concat('Recruited: ', c.recruited::varchar), true) l
            WHERE shown""",
            "recruited",
        ),
    ),
}
