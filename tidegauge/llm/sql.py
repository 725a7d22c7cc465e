"""SQL of the queries that SQL can express, written for DuckDB."""

from __future__ import annotations

from tidegauge.llm import license

_PLAIN = r"""regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
_SPACED = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _license() -> str:
    known = license.shapes(license.TEMPLATES, license.TELLING, license.BARRED, license.THRESHOLD)
    sets = ", ".join(
        f"('{label}', {_list(own)}, {need}, {width}, {_list(tell)}::VARCHAR[], {_list(bar)}::VARCHAR[])"
        for label, (own, need, width, tell, bar) in known.items()
    )
    places = " || ".join(
        f"""list_transform(list_filter(range(len(w)), lambda i: {" AND ".join(
            f"w[i + {j + 1}] = '{word}'" for j, word in enumerate(phrase.split())
        )}), lambda i: {{'start': i, 'label': '{label}'}})"""
        for phrase, label in license.PHRASES.items()
    )
    return f"""
    WITH docs AS (SELECT doc_id, {_PLAIN.format("text")} AS w FROM documents),
    base AS (SELECT doc_id, len(w) AS n_words, {places} AS places FROM docs),
    templates(label, words, need, width, telling, barred) AS (VALUES {sets}),
    likely AS (
        SELECT * FROM docs, templates
        WHERE len(list_intersect(list_distinct(w), words)) >= need AND list_has_all(w, telling)
    ),
    blocks AS (
        SELECT doc_id, label, words, need, telling, barred, list_distinct(w[i : i + width - 1]) AS held
        FROM (SELECT *, unnest(list_filter(range(1, len(w) + 1), lambda i: list_contains(words, w[i]))) AS i FROM likely)
    ),
    matched AS (
        SELECT doc_id, label, max(len(list_intersect(held, words)) / len(words)) AS containment
        FROM blocks
        WHERE len(list_intersect(held, words)) >= need AND list_has_all(held, telling)
            AND NOT list_has_any(held, barred)
        GROUP BY doc_id, label
    ),
    best AS (
        SELECT doc_id, list(label) AS labels, max(containment) AS score FROM matched GROUP BY doc_id
    )
    SELECT doc_id, n_words, len(places)::BIGINT AS n_base,
        list_min(list_transform(places, lambda p: p.start)) AS first_word,
        list_max(list_transform(places, lambda p: p.start)) AS last_word,
        coalesce(list_aggregate(list_sort(list_distinct(list_transform(places, lambda p: p.label))),
            'string_agg', ','), '') AS base_labels,
        coalesce(list_aggregate(list_sort(list_distinct(
            list_transform(places, lambda p: p.label) || coalesce(labels, []))), 'string_agg', ','), '')
            AS labels,
        coalesce(score, 0.0)::DOUBLE AS score
    FROM base LEFT JOIN best USING (doc_id)"""


_TOP_K = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e
        FROM embeddings
        WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
            list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
        FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id
        WHERE q.vec_id % 100 = 0
    )
    SELECT query_id, rank::INTEGER AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
    WHERE rank <= 10"""

_DECONTAMINATION = f"""
    WITH items AS (SELECT item_id, {_PLAIN.format("text")} AS w FROM benchmark),
    sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
    windows AS (
        SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS win
        FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM sized)
    ),
    docs AS (SELECT doc_id, {_PLAIN.format("text")} AS w FROM documents),
    lengths AS (SELECT DISTINCT n FROM windows),
    places AS (
        SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS win
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, lengths WHERE len(w) >= n)
    ),
    hits AS (SELECT doc_id, item_id, s, p.n FROM places AS p JOIN windows USING (n, win)),
    words AS (
        SELECT doc_id, count(DISTINCT k) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS k FROM hits) GROUP BY doc_id
    ),
    found AS (
        SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)"""

# Sources are capped in the order of what a share would have to be to reach their cap.
_MIXING = f"""
    WITH docs AS (
        SELECT doc_id, source, len({_SPACED.format("text")})::BIGINT AS size,
            ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS ticket
        FROM documents
    ),
    sources AS (
        SELECT source, source_size,
            [5, 2, 1][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::BIGINT] AS weight
        FROM (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source)
    ),
    steps AS (
        SELECT *, 3 * source_size / weight AS full_at,
            sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS rest,
            sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS shares
        FROM sources
        WINDOW before AS (ORDER BY 3 * source_size / weight, source
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ),
    share AS (
        SELECT rest, shares FROM steps WHERE rest::DOUBLE / shares <= full_at ORDER BY full_at LIMIT 1
    ),
    targets AS (
        SELECT source, source_size, least(3.0 * source_size,
            weight::DOUBLE * (SELECT rest FROM share)::DOUBLE / (SELECT shares FROM share)::DOUBLE) AS target
        FROM sources
    ),
    plan AS (
        SELECT source, source_size, target,
            CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies
        FROM targets
    ),
    running AS (
        SELECT d.doc_id, d.size, source_size, target, copies, target - copies * source_size AS budget,
            sum(d.size) OVER (PARTITION BY d.source ORDER BY ticket) AS upto,
            sum(d.size) OVER (PARTITION BY d.source, ticket) AS own
        FROM docs AS d JOIN plan AS p ON d.source IS NOT DISTINCT FROM p.source
    )
    SELECT doc_id, size, source_size, target,
        (size * least(3, copies + CASE WHEN upto <= budget
            OR (upto - own <= budget AND 2 * (budget - (upto - own)) >= own) THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM running"""

_SUBSTRINGS = f"""
    WITH docs AS (SELECT doc_id, {_SPACED.format("text")} AS w FROM documents),
    windows AS (
        SELECT doc_id, s, array_to_string(w[s : s + 19], ' ') AS win
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM docs WHERE len(w) >= 20)
    ),
    later AS (
        SELECT doc_id, s
        FROM (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, s) AS r FROM windows)
        WHERE r > 1
    ),
    gone AS (
        SELECT doc_id, list(DISTINCT k) AS ks
        FROM (SELECT doc_id, unnest(range(s, s + 20)) AS k FROM later) GROUP BY doc_id
    ),
    words AS (
        SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM docs
    ),
    kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t
        FROM words LEFT JOIN gone USING (doc_id)
        WHERE ks IS NULL OR NOT list_contains(ks, k)
        GROUP BY doc_id
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ks), 0)::BIGINT AS n_removed,
        sha256(coalesce(t, '')) AS kept_sha256
    FROM docs LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_WARC = """
    WITH p AS (
        SELECT page_id, sha256(coalesce(html, '')) AS payload_digest,
            octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes
        FROM pages
    ),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
    FROM f"""

_NEGATIVES = """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
            list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
        FROM v AS a JOIN v AS c ON a.vec_id <> c.vec_id
        WHERE a.vec_id % 100 = 0
    ),
    positives AS (
        SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
    )
    SELECT * FROM (
        SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
            row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER
                AS rank
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
    )
    WHERE rank <= 5"""


def _conversations() -> str:
    """Steps back from the last row; a state's value is (cost, letters, repaired lines), least first."""
    states = range(4)  # nothing yet, after system, after user, after assistant
    made = (2, 2, 3, 2)
    kept = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})

    def value(cost: str, letters: str, lines: str) -> str:
        return f"{{'c': ({cost})::BIGINT, 'a': {letters}, 't': {lines}}}"

    def before(v: str, cost: str, letter: str, line: str | None) -> str:
        lines = f"list_concat([{line}], {v}.t)" if line else f"{v}.t"
        return value(f"{v}.c + {cost}", f"'{letter}' || {v}.a", lines)

    def least(options: list[str]) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    def named(q: int) -> str:
        return "user" if made[q] == 2 else "assistant"

    own = []
    for q in states:
        changed = before(f"v{made[q]}", "3 + cut", "R", f"'{named(q)}:' || text")
        keep = " ".join(
            f"WHEN '{initial}' THEN {before(f'v{to}', 'cut', 'K', "role || ':' || text")}"
            for initial, to in kept[q].items()
        )
        deleted = before(f"v{q}", "4", "D", None)
        stays = f"CASE WHEN gone THEN NULL ELSE {changed} END"
        as_is = f"CASE WHEN gone THEN NULL ELSE CASE left(role, 1) {keep} END END"
        own.append(f"list_sort(list_filter([{deleted}, {stays}, {as_is}], lambda x: x IS NOT NULL))[1] AS w{q}")
    once = [least([f"w{q}", before(f"w{made[q]}", "3", "I", f"'{named(q)}:'")]) + f" AS x{q}" for q in states]
    twice = [least([f"w{q}", before(f"x{made[q]}", "3", "I", f"'{named(q)}:'")]) + f" AS y{q}" for q in states]
    none = "CAST([] AS VARCHAR[])"
    ends = [
        value("0", "''", none),
        value("6", "'II'", "['user:', 'assistant:']"),
        value("3", "'I'", "['assistant:']"),
        value("0", "''", none),
    ]
    eight = "CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])"
    return f"""
    WITH RECURSIVE given AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS key
        FROM conversations
    ),
    checked AS (
        SELECT *, xor(4294967295::BIGINT, list_reduce(
            list_concat([4294967295::BIGINT], list_transform(key, lambda x: unicode(x)::BIGINT)),
            lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], {eight}),
                lambda d, k: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384::BIGINT) ELSE d >> 1 END)
        )) % 20 AS kind
        FROM given
    ),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
            unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM checked
    ),
    ordered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i
        FROM damaged
    ),
    marked AS (
        SELECT conv_id, i, turn, role, text, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
            row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
            NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open,
            lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
        FROM ordered
    ),
    rows AS (
        SELECT *, blank OR again AS gone, CASE WHEN open AND NOT (blank OR again) THEN 3 ELSE 0 END AS cut
        FROM marked
    ),
    counts AS (
        SELECT conv_id, max(i) AS n,
            coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
            count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
            count(*) FILTER (cut > 0) AS truncated,
            count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM rows GROUP BY conv_id
    ),
    back AS (
        SELECT conv_id, n AS i, {", ".join(f"{e} AS v{q}" for q, e in enumerate(ends))} FROM counts
        UNION ALL
        SELECT conv_id, i - 1, y0, y1, y2, y3
        FROM (SELECT *, {", ".join(twice)} FROM (SELECT *, {", ".join(once)} FROM (
            SELECT b.conv_id, b.i, {", ".join(own)}
            FROM back AS b JOIN rows AS r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i
        )))
    ),
    best AS (SELECT conv_id, v0 FROM back WHERE i = 0)
    SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
        coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
        coalesce(illegal, 0) AS illegal, coalesce(v0.c, 0) AS cost, coalesce(v0.a, '') AS audit,
        sha256(coalesce(array_to_string(v0.t, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) AS e
    LEFT JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
    LEFT JOIN best AS b ON b.conv_id IS NOT DISTINCT FROM e.conv_id"""


SQL: dict[str, str] = {
    "op2_license_scan": _license(),
    "op3_top_k": _TOP_K,
    "op6_decontamination": _DECONTAMINATION,
    "op7_mixing": _MIXING,
    "op8_substring_dedup": _SUBSTRINGS,
    "op9_warc": _WARC,
    "op11_hard_negatives": _NEGATIVES,
    "op13_conversation_repair": _conversations(),
}
