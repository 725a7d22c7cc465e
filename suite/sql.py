"""Building blocks of the SQL side: the same views of the test tables, for DuckDB."""

from __future__ import annotations

SCOPE = """((modality = 'interviews' AND NOT is_protected AND NOT is_raw)
    OR (modality <> 'interviews' AND is_protected AND is_raw))"""

MB = "1048576.0::DOUBLE"

# name -> (needs, body)
_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "adp_study": (
        (),
        """SELECT n_name AS study_id, n_name AS study_name,
        nullif(cast(n_nationkey AS varchar), '0') AS study_country,
        cast(n_nationkey AS varchar) AS study_country_code, r_name AS network_id
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
    "adp_subjects": (
        (),
        """SELECT n_name AS study_id, concat('S', cast(c_custkey AS varchar)) AS subject_id,
        c_acctbal > 0 AS is_active, date '2020-01-01' + cast(c_custkey % 1000 AS int) AS consent_date,
        c_mktsegment AS note
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "adp_recruitment": (
        (),
        """SELECT concat('S', cast(c_custkey AS varchar)) AS subject_id,
        CASE WHEN c_acctbal > 0 THEN 'recruited' ELSE 'screening' END AS recruitment_status,
        CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE') THEN 'CHR' ELSE 'HC' END AS cohort
        FROM customer""",
    ),
    "recruited": (
        ("adp_recruitment", "adp_subjects", "adp_study"),
        """SELECT r.subject_id, r.recruitment_status, r.cohort, s.study_id AS site_id,
        t.study_name AS site_name, t.study_country AS site_country, t.network_id,
        t.study_country_code AS site_country_code
        FROM adp_recruitment r JOIN adp_subjects s ON r.subject_id = s.subject_id
        JOIN adp_study t ON s.study_id = t.study_id""",
    ),
    "files_base": (
        (),
        """SELECT r_name AS network_id, n_name AS study_id,
        concat('S', cast(c_custkey AS varchar)) AS subject_id,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 'phone' WHEN o_orderpriority = '2-HIGH' THEN 'surveys'
             WHEN o_orderpriority = '3-MEDIUM' THEN 'mri' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'eeg'
             ELSE 'interviews' END AS modality,
        o_orderstatus <> 'P' AS is_protected, l_linestatus = 'O' AS is_raw, l_returnflag AS rf,
        cast(round(l_extendedprice * 100) AS bigint) AS size_bytes, l_shipdate AS m_time,
        concat_ws('-', l_orderkey::varchar, l_linenumber::varchar, l_partkey::varchar, l_suppkey::varchar,
                  strftime(l_shipdate, '%Y%m%d'), cast(round(l_extendedprice * 100) AS bigint)::varchar) AS k
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "files_named": (
        ("files_base",),
        """SELECT *, CASE
        WHEN modality = 'phone' AND rf = 'A' THEN concat('u_sensor_', k, '.json')
        WHEN modality = 'phone' AND rf = 'N' THEN concat('u_activity_', k, '.json')
        WHEN modality = 'phone' THEN concat('u_other_', k, '.json')
        WHEN modality = 'surveys' AND rf = 'A' THEN concat('s_', k, '.UPENN_nda.json')
        WHEN modality = 'surveys' AND rf = 'N' THEN concat('s_', k, '.Pronet.json')
        WHEN modality = 'surveys' THEN concat('s_', k, '.Prescient.json')
        WHEN modality = 'mri' THEN concat('m_', k, '.zip')
        WHEN modality = 'eeg' AND rf = 'A' THEN concat('e_', k, '.eeg.lock')
        WHEN modality = 'eeg' THEN concat('e_', k, '.eeg')
        WHEN rf = 'A' THEN concat('i_', k, '.tar.gz')
        WHEN rf = 'N' THEN concat('i_', k, '.csv')
        ELSE concat('i_', k) END AS file_name
        FROM files_base""",
    ),
    "cat": (
        ("files_named",),
        """SELECT * EXCLUDE (rf), CASE
        WHEN NOT (is_protected AND is_raw) THEN NULL
        WHEN modality = 'phone' AND rf = 'A' THEN 'sensor'
        WHEN modality = 'phone' AND rf = 'N' THEN 'activity'
        WHEN modality = 'surveys' AND rf = 'A' THEN 'UPENN'
        WHEN modality = 'surveys' AND rf = 'N' THEN 'MGB-Pronet'
        WHEN modality = 'surveys' THEN 'MGB-Prescient' END AS tag,
        concat(upper(substr(network_id, 1, 1)), lower(substr(network_id, 2)), study_id) AS study_dir,
        concat_ws('/', '/data/root', CASE WHEN is_protected THEN 'PROTECTED' ELSE 'GENERAL' END,
                  concat(upper(substr(network_id, 1, 1)), lower(substr(network_id, 2)), study_id),
                  CASE WHEN is_raw THEN 'raw' ELSE 'processed' END, subject_id, modality, file_name) AS file_path
        FROM files_named""",
    ),
    # Every file once under its modality, and again under its sub-type.
    "labelled": (
        ("cat",),
        """SELECT * FROM cat UNION ALL
        SELECT * REPLACE (concat(modality, '_', CASE WHEN tag LIKE 'MGB%' THEN 'MGB' ELSE tag END) AS modality)
        FROM cat WHERE tag IS NOT NULL""",
    ),
    "volumes": (
        ("labelled",),
        """SELECT study_id, subject_id, modality, is_protected, is_raw, count(*) AS files_count,
        sum(size_bytes)::bigint AS size_bytes, sum(size_bytes)::bigint / 1048576.0::double AS files_size_mb
        FROM labelled GROUP BY ALL""",
    ),
    "cuts": (
        (),
        """SELECT unnest(generate_series(date_trunc('month', min(l_shipdate)) + interval 1 month,
        date_trunc('month', max(l_shipdate)) + interval 1 month, interval 1 month))::timestamp AS cut
        FROM lineitem""",
    ),
    "stats": (
        ("labelled", "cuts"),
        """SELECT study_id, subject_id, modality, is_protected, is_raw, cut AS statistics_timestamp,
        sum(n)::bigint AS files_count, sum(b)::bigint AS size_bytes
        FROM (SELECT study_id, subject_id, modality, is_protected, is_raw, date_trunc('month', m_time) AS month,
                     count(*) AS n, sum(size_bytes) AS b FROM labelled GROUP BY ALL)
        JOIN cuts ON month < cut
        GROUP BY ALL""",
    ),
    "daily_stats": (
        (),
        """SELECT study_id, subject_id, modality, true AS is_protected, true AS is_raw,
        moment AS statistics_timestamp, count(*)::bigint AS files_count, sum(cents)::bigint AS size_bytes
        FROM (SELECT n_name AS study_id, concat('S', c_custkey::varchar) AS subject_id, event_type AS modality, ts, cast(round(value * 100) AS bigint) AS cents
              FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey)
        JOIN (SELECT unnest(generate_series(min(ts)::date::timestamp, max(ts)::date::timestamp, interval 1 day)) AS moment
              FROM events) ON ts::date <= moment
        GROUP BY ALL""",
    ),
    "totals": (
        ("stats", "adp_study"),
        f"""SELECT coalesce(network_id, 'AllNetworks') AS network_id, modality, statistics_timestamp,
        sum(files_count)::bigint AS files_count, sum(size_bytes)::bigint AS size_bytes
        FROM stats JOIN adp_study USING (study_id) WHERE {SCOPE}
        GROUP BY GROUPING SETS ((network_id, modality, statistics_timestamp), (modality, statistics_timestamp))""",
    ),
    "diffs": (
        ("totals",),
        f"""SELECT network_id, modality, statistics_timestamp, files_count,
        size_bytes / {MB} AS files_size_mb,
        files_count - lag(files_count) OVER w AS files_count_diff,
        size_bytes - lag(size_bytes) OVER w AS size_bytes_diff,
        (size_bytes - lag(size_bytes) OVER w) / {MB} AS files_size_mb_diff
        FROM totals WINDOW w AS (PARTITION BY network_id, modality ORDER BY statistics_timestamp)""",
    ),
    "moments": (
        ("stats",),
        """SELECT max(statistics_timestamp) AS latest,
        max(statistics_timestamp) FILTER (WHERE statistics_timestamp < (SELECT max(statistics_timestamp) FROM stats))
        AS previous FROM stats""",
    ),
    "skeleton": (
        ("cat", "adp_study"),
        """SELECT network_order, network_id, parent, sub_order, indent, modality, name FROM
        (SELECT DISTINCT network_id, (dense_rank() OVER (ORDER BY network_id) - 1)::int AS network_order FROM adp_study) n,
        (SELECT modality AS parent, 0 AS sub_order, 0 AS indent, modality, modality AS name
           FROM (SELECT DISTINCT modality FROM cat)
         UNION ALL SELECT * FROM (VALUES
           ('phone', 1, 1, 'phone_sensor', 'sensor'), ('phone', 2, 1, 'phone_activity', 'activity'),
           ('surveys', 1, 1, 'surveys_UPENN', 'UPENN'), ('surveys', 2, 1, 'surveys_MGB', 'MGB')) v
           WHERE col0 IN (SELECT modality FROM cat)) m""",
    ),
    "delta": (
        ("skeleton", "stats", "moments", "adp_study"),
        f"""SELECT s.*, files_now, files_before, bytes_now, bytes_before,
        coalesce(files_now, 0) - coalesce(files_before, 0) AS delta_files,
        coalesce(bytes_now, 0) - coalesce(bytes_before, 0) AS delta_bytes,
        files_now IS NULL AS current_missing,
        CASE WHEN s.parent = 'interviews' THEN '- (GENERAL, processed)' ELSE '' END AS qualifier
        FROM skeleton s LEFT JOIN
        (SELECT network_id, modality,
           sum(files_count) FILTER (WHERE statistics_timestamp = latest)::bigint AS files_now,
           sum(files_count) FILTER (WHERE statistics_timestamp = previous)::bigint AS files_before,
           sum(size_bytes) FILTER (WHERE statistics_timestamp = latest)::bigint AS bytes_now,
           sum(size_bytes) FILTER (WHERE statistics_timestamp = previous)::bigint AS bytes_before
         FROM stats, moments, adp_study WHERE stats.study_id = adp_study.study_id AND {SCOPE}
           AND statistics_timestamp IN (latest, previous) GROUP BY network_id, modality) t
        ON s.network_id = t.network_id AND s.modality = t.modality""",
    ),
    # Study metadata lines as they would be typed into the study files.
    "typed": (
        (),
        """SELECT n_name AS study_id, n_nationkey, concat('S', c_custkey::varchar) AS subject_id,
        CASE WHEN c_mktsegment = 'FURNITURE' AND c_acctbal < 0 THEN 'unknown'
             WHEN c_acctbal > 0 THEN '1' ELSE '0' END AS active,
        CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 0 THEN '2022-13-05'
             ELSE concat('2021-', (c_custkey % 12 + 1)::varchar, '-', (c_custkey % 28 + 1)::varchar) END AS consent,
        CASE WHEN c_acctbal > 9000 THEN 'NA' ELSE n_name END AS study,
        c_mktsegment AS segment, c_custkey, c_acctbal,
        c_acctbal > 9000 AS is_dropped,
        c_acctbal < 0 AND c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') AS is_bad
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "loaded": (
        ("typed",),
        """SELECT study_id, subject_id, active = '1' AS is_active,
        CASE WHEN NOT is_bad THEN try_strptime(consent, '%Y-%m-%d')::date END AS consent_date,
        CASE WHEN n_nationkey % 2 = 0 THEN concat('{"Segment":"', segment, '"}')
             WHEN c_custkey % 3 = 0 THEN concat('{"Note, long":"', segment, '"}')
             ELSE concat('{"Age":"', (c_custkey % 90)::varchar, '","Note, long":"', segment, '"}') END AS optional_notes
        FROM typed WHERE NOT is_dropped AND NOT is_bad
        UNION ALL SELECT study_id, subject_id, false, date '2020-01-01',
        CASE WHEN n_nationkey % 2 = 0 THEN '{"Segment":"old"}' ELSE '{"Age":"1","Note, long":"old, too"}' END
        FROM typed WHERE (is_dropped OR is_bad) AND segment <> 'FURNITURE'""",
    ),
}


def sql(body: str, *needs: str) -> str:
    """A statement over the named views, which are placed in front of it as WITH parts."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in _VIEWS[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    parts = ",\n".join(f"{name} AS ({_VIEWS[name][1]})" for name in order)
    return f"WITH {parts}\n{body}" if parts else body


def binary_size(column: str) -> str:
    """SQL text of a byte count in binary units."""
    cases = [
        f"WHEN abs({column}) = 1 THEN concat({column}::varchar, ' Byte')",
        f"WHEN abs({column}) < 1024 THEN concat({column}::varchar, ' Bytes')",
    ]
    units = ["KiB", "MiB", "GiB", "TiB", "PiB"]
    for power, unit in enumerate(units, start=1):
        value = f"printf('%.1f {unit}', {column}::double / {1024**power}.0::double)"
        limit = 1024 ** (power + 1)
        cases.append(f"WHEN abs({column}) < {limit} THEN {value}")
    return f"CASE {' '.join(cases)} END"
