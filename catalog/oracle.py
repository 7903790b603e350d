"""The same results in plain SQL over the same tables.

The SQL takes another way than the operators: missing values come from generating the whole
range of each key and removing what is there, order from window functions over whole keys,
and JSON from DuckDB's own functions.
"""

LISTING_LIMIT = 1000
RUN_DATE = "2024-01-30"


def _numbered_gaps(source: str) -> str:
    """CTEs for distinct pairs, statistics and gaps of the CTE ``source(partition, offset)``."""
    return f"""
    pairs AS (SELECT DISTINCT partition, "offset" FROM {source}),
    stats AS (
        SELECT partition, count(*) AS distinct_offset_count, min("offset") AS min_offset, max("offset") AS max_offset,
               max("offset") - min("offset") + 1 AS span, max("offset") - min("offset") + 1 AS expected_count,
               max("offset") - min("offset") + 1 - count(*) AS missing_offset_count,
               max("offset") - min("offset") + 1 - count(*) > 0 AS has_gaps
        FROM pairs GROUP BY partition),
    candidates AS (SELECT partition, unnest(range(min_offset, max_offset + 1)) AS missing_offset FROM stats),
    holes AS (
        SELECT c.partition, c.missing_offset,
               row_number() OVER (PARTITION BY c.partition ORDER BY c.missing_offset) AS nth
        FROM candidates c ANTI JOIN pairs x ON c.partition = x.partition AND c.missing_offset = x."offset"),
    following AS (
        SELECT partition, "offset", lead("offset") OVER (PARTITION BY partition ORDER BY "offset") AS next_offset
        FROM pairs),
    gaps AS (
        SELECT partition, "offset" + 1 AS gap_start, next_offset - 1 AS gap_end, next_offset - "offset" - 1 AS gap_size
        FROM following WHERE next_offset > "offset" + 1)
    """


LINES = f"""
WITH lines AS (SELECT l_linenumber AS partition, l_orderkey AS "offset" FROM lineitem),
{_numbered_gaps("lines")}
"""


def _listed(limit: int) -> str:
    """Text list of the first missing values per key."""
    return f"""
    (SELECT partition, '[' || string_agg(CAST(missing_offset AS VARCHAR), ',' ORDER BY missing_offset) || ']' AS listed
     FROM holes WHERE nth <= {limit} GROUP BY partition)
    """


def _ledger(landed_filter: str = "true") -> str:
    """CTEs of the ledger derived from ``events``, down to parsed metadata rows."""
    return f"""
WITH ev AS (
    SELECT *, CAST(event_id % 4 AS INTEGER) AS p, event_id // 4 AS o,
           event_type = 'signup' AND user_id % 10 = 0 AS to_canary,
           event_type = 'error' AND user_id % 10 = 1 AS to_dead_letter,
           event_id % 1000 BETWEEN 400 AND 439 AS lost
    FROM events),
landed AS (
    SELECT event_id, ts, event_type,
           CASE WHEN event_id % 211 = 0 THEN NULL
                WHEN event_id % 223 = 0 THEN '{{bad-json'
                WHEN event_id % 227 = 0 THEN '{{"offset":' || o || '}}'
                WHEN event_id % 229 = 0 THEN '{{"partition":' || p || '}}'
                WHEN event_id % 233 = 0 THEN '{{"partition":"abc","offset":' || o || '}}'
                WHEN event_id % 239 = 0 THEN '{{"partition":' || p || ',"offset":"xyz"}}'
                ELSE '{{"partition":' || p || ',"offset":' || o || '}}' END AS m
    FROM ev WHERE NOT to_canary AND NOT to_dead_letter AND NOT lost),
fields AS (
    SELECT *, CASE WHEN json_valid(m) THEN trim(json_extract_string(m, '$.partition')) END AS pt,
           CASE WHEN json_valid(m) THEN trim(json_extract_string(m, '$.offset')) END AS ot
    FROM landed WHERE {landed_filter}),
parsed AS (
    SELECT *, CASE WHEN regexp_matches(pt, '^[0-9]+$') THEN try_cast(pt AS INTEGER) END AS pv,
           CASE WHEN regexp_matches(ot, '^[0-9]+$') THEN try_cast(ot AS BIGINT) END AS ov,
           m IS NULL AS missing_metadata,
           m IS NOT NULL AND NOT json_valid(m) AS malformed_json,
           coalesce(json_valid(m), false) AS well_formed
    FROM fields),
judged AS (
    SELECT *, well_formed AND pt IS NULL AS missing_partition,
           well_formed AND ot IS NULL AS missing_offset,
           well_formed AND pt IS NOT NULL AND pv IS NULL AS non_numeric_partition,
           well_formed AND ot IS NOT NULL AND ov IS NULL AS non_numeric_offset,
           well_formed AND pv IS NOT NULL AND ov IS NOT NULL AS valid
    FROM parsed),
quality AS (
    SELECT count(*) AS eligible_row_count,
           count(*) FILTER (missing_metadata) AS missing_metadata_count,
           count(*) FILTER (malformed_json) AS malformed_json_count,
           count(*) FILTER (missing_partition) AS missing_partition_count,
           count(*) FILTER (missing_offset) AS missing_offset_count,
           count(*) FILTER (non_numeric_partition) AS non_numeric_partition_count,
           count(*) FILTER (non_numeric_offset) AS non_numeric_offset_count,
           count(*) FILTER (NOT valid) AS invalid_row_count,
           count(*) FILTER (valid) AS valid_offset_row_count
    FROM judged),
good AS (SELECT pv AS partition, ov AS "offset", m AS metadata_json FROM judged WHERE valid),
{_numbered_gaps("good")},
canary AS (
    SELECT 'canary' AS kind, 'events-canary' AS side_topic, 'events' AS source_topic, p AS source_partition,
           o AS source_offset, CAST(NULL AS VARCHAR) AS failure_event_id, CAST(NULL AS VARCHAR) AS reason_msg,
           CAST(NULL AS VARCHAR) AS exception, event_id, 0 AS copy
    FROM ev WHERE to_canary),
dead_letter AS (
    SELECT 'dead_letter' AS kind, 'events-dlq' AS side_topic, 'events' AS source_topic, p AS source_partition,
           o AS source_offset, 'evt-' || event_id AS failure_event_id,
           CASE WHEN event_id % 3 <> 0 THEN 'reason ' || (event_id % 5) END AS reason_msg,
           CASE WHEN event_id % 5 <> 0 THEN 'IllegalStateException' END AS exception, event_id, copies.copy
    FROM ev, (VALUES (0), (1)) AS copies(copy)
    WHERE to_dead_letter AND (copies.copy = 0 OR event_id % 7 = 0)),
keys AS (
    SELECT 'events' AS source_topic, partition AS source_partition, missing_offset AS source_offset
    FROM holes),
classified AS (
    SELECT *, NOT in_canary AND NOT in_dead_letter AS unresolved FROM (
        SELECT k.*,
               EXISTS (SELECT 1 FROM canary c WHERE c.source_partition = k.source_partition
                       AND c.source_offset = k.source_offset) AS in_canary,
               EXISTS (SELECT 1 FROM dead_letter d WHERE d.source_partition = k.source_partition
                       AND d.source_offset = k.source_offset) AS in_dead_letter
        FROM keys k)),
matched AS (
    SELECT kind, side_topic, source_topic, source_partition, source_offset, failure_event_id, reason_msg, exception
    FROM dead_letter d
    WHERE EXISTS (SELECT 1 FROM keys k WHERE k.source_partition = d.source_partition
                  AND k.source_offset = d.source_offset)),
summary AS (
    SELECT 'events' AS source_topic,
           (SELECT count(*) FROM classified) AS total_missing_offset_count,
           (SELECT count(*) FROM classified) AS bounded_missing_offset_count,
           (SELECT count(*) FROM classified WHERE unresolved) AS bounded_unresolved_count,
           (SELECT count(*) FROM classified WHERE in_canary) AS canary_explained_count,
           (SELECT count(*) FROM classified WHERE in_dead_letter) AS dead_letter_explained_count,
           (SELECT count(*) FROM classified WHERE unresolved) AS unresolved_count,
           (SELECT count(failure_event_id) FROM matched) AS dead_letter_failure_event_id_count,
           (SELECT count(reason_msg) FROM matched) AS dead_letter_reason_msg_count,
           (SELECT count(exception) FROM matched) AS dead_letter_exception_count,
           (SELECT count(*) FROM canary) AS canary_record_count,
           (SELECT count(*) FROM dead_letter) AS dead_letter_record_count,
           (SELECT count(*) FROM stats WHERE has_gaps) AS raw_gap_partition_count,
           false AS missing_offsets_truncated),
gap_reason AS (
    SELECT CASE WHEN raw_gap_partition_count = 0 THEN NULL
                WHEN unresolved_count > 0 THEN
                    'unresolved offset gaps after side-topic reconciliation: raw_gap_partition_count='
                    || raw_gap_partition_count || ' unresolved_count=' || unresolved_count
           END AS gap_reason FROM summary),
invalid_reason AS (
    SELECT CASE WHEN invalid_row_count > 0
                THEN 'invalid metadata rows detected: invalid_row_count=' || invalid_row_count END AS invalid_reason
    FROM quality),
message AS (
    SELECT CASE WHEN raw_gap_partition_count = 0 THEN 'no gaps detected'
                WHEN unresolved_count > 0 THEN 'unresolved offsets present but fail_on_gaps=false'
                ELSE 'side-topic reconciliation resolved all bounded missing offsets' END AS pass_message FROM summary),
verdict AS (
    SELECT CAST(gap_reason IS NOT NULL OR invalid_reason IS NOT NULL AS INTEGER) AS code,
           coalesce(invalid_reason || '; ' || gap_reason, invalid_reason, gap_reason, pass_message) AS reason,
           true AS fail_on_gaps, invalid_row_count, raw_gap_partition_count, true AS side_topic_enabled,
           canary_explained_count, dead_letter_explained_count, unresolved_count, total_missing_offset_count,
           bounded_unresolved_count, bounded_missing_offset_count, missing_offsets_truncated
    FROM gap_reason, invalid_reason, message, quality, summary)
"""


LEDGER = _ledger()
OLD_LEDGER = _ledger(f"CAST(ts AS DATE) <> DATE '{RUN_DATE}'")

KEY = "source_topic, source_partition, source_offset"
RECORD = f"kind, side_topic, {KEY}, failure_event_id, reason_msg, exception"

BUCKETS = """
(SELECT bucket, source_topic, side_topic, source_partition AS partition, source_offset AS "offset"
 FROM (SELECT 'canary_explained' AS bucket, 'events-canary' AS side_topic, * FROM classified WHERE in_canary
       UNION ALL SELECT 'dead_letter_explained', 'events-dlq', * FROM classified WHERE in_dead_letter
       UNION ALL SELECT 'unresolved', NULL, * FROM classified WHERE unresolved))
"""


def _branch(landed: str, side: bool, fail_on_gaps: bool = True) -> str:
    """The verdict row on the events for which ``landed`` holds, all without defects."""
    counters = """
        (SELECT count(*) FROM missed WHERE to_canary) AS canary_explained_count,
        (SELECT count(*) FROM missed WHERE to_dead_letter) AS dead_letter_explained_count,
        (SELECT count(*) FROM missed WHERE NOT to_canary AND NOT to_dead_letter) AS unresolved_count,
        (SELECT count(*) FROM missed) AS total_missing_offset_count,
        (SELECT count(*) FROM missed WHERE NOT to_canary AND NOT to_dead_letter) AS bounded_unresolved_count,
        (SELECT count(*) FROM missed) AS bounded_missing_offset_count, false AS missing_offsets_truncated
    """
    if not side:
        names = ["canary_explained", "dead_letter_explained", "unresolved", "total_missing_offset", "bounded_unresolved", "bounded_missing_offset"]
        counters = ", ".join(f"CAST(NULL AS BIGINT) AS {name}_count" for name in names)
        counters += ", CAST(NULL AS BOOLEAN) AS missing_offsets_truncated"
    return f"""
WITH ev AS (
    SELECT CAST(event_id % 4 AS INTEGER) AS p, event_id // 4 AS o,
           event_type = 'signup' AND user_id % 10 = 0 AS to_canary,
           event_type = 'error' AND user_id % 10 = 1 AS to_dead_letter,
           event_id % 1000 BETWEEN 400 AND 439 AS lost
    FROM events),
ends AS (SELECT p, min(o) AS low, max(o) AS high FROM ev WHERE {landed} GROUP BY p),
missed AS (SELECT ev.* FROM ev JOIN ends USING (p) WHERE NOT ({landed}) AND o BETWEEN low AND high),
facts AS (
    SELECT 0::BIGINT AS invalid_row_count, (SELECT count(DISTINCT p) FROM missed) AS raw_gap_partition_count,
           {str(side).lower()} AS side_topic_enabled, {counters})
SELECT CASE WHEN raw_gap_partition_count = 0 OR NOT {fail_on_gaps} THEN 0 WHEN NOT side_topic_enabled THEN 1
            WHEN unresolved_count > 0 THEN 1 ELSE 0 END AS code,
       CASE WHEN raw_gap_partition_count = 0 THEN 'no gaps detected'
            WHEN NOT side_topic_enabled AND {fail_on_gaps} THEN
                'offset gaps detected: gap_partition_count=' || raw_gap_partition_count
            WHEN NOT side_topic_enabled THEN 'offset gaps detected but fail_on_gaps=false'
            WHEN unresolved_count > 0 THEN
                'unresolved offset gaps after side-topic reconciliation: raw_gap_partition_count='
                || raw_gap_partition_count || ' unresolved_count=' || unresolved_count
            ELSE 'side-topic reconciliation resolved all bounded missing offsets' END AS reason,
       {fail_on_gaps} AS fail_on_gaps, *
FROM facts
"""


TRUNCATED = """
SELECT 1 AS code,
       'missing offsets truncated after side-topic reconciliation: unresolved offsets may remain beyond materialized limit'
       || '; raw_gap_partition_count=' || raw_gap_partition_count || ' bounded_missing_offset_count=0'
       || ' missing_offsets_truncated=true unresolved_count=' || unresolved_count AS reason,
       true AS fail_on_gaps, invalid_row_count, raw_gap_partition_count, true AS side_topic_enabled,
       canary_explained_count, dead_letter_explained_count, unresolved_count, total_missing_offset_count,
       CAST(0 AS BIGINT) AS bounded_unresolved_count, CAST(0 AS BIGINT) AS bounded_missing_offset_count, true AS missing_offsets_truncated
FROM quality, summary
"""

LISTING = """
WITH named AS (
    SELECT '/lake/root_' || (o_orderkey % 2) AS root, strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderkey
    FROM orders),
listing AS (
    SELECT DISTINCT root,
           CASE o_orderkey % 50 WHEN 0 THEN 'timestampcolumn=' || d || 'x'
                                WHEN 1 THEN 'timestampcolumn_backup=' || d
                                WHEN 2 THEN 'timestampcolumn=' || d[1:5] || '13-99'
                                ELSE 'timestampcolumn=' || d END AS name,
           o_orderkey % 50 <> 3 AS is_dir
    FROM named),
dated AS (
    SELECT root, root || '/' || name AS path, name, is_dir,
           CASE WHEN is_dir AND starts_with(name, 'timestampcolumn=')
                     AND regexp_full_match(name[17:], '[0-9]{4}-[0-9]{2}-[0-9]{2}')
                THEN try_cast(name[17:] AS DATE) END AS partition_date
    FROM listing),
partitions AS (
    SELECT *, CASE WHEN NOT is_dir OR NOT starts_with(name, 'timestampcolumn=') THEN 'non_matching'
                   WHEN partition_date IS NULL THEN 'invalid_date'
                   WHEN partition_date = DATE '1998-08-02' THEN 'skipped_run_date'
                   ELSE 'eligible' END AS status
    FROM dated)
"""


def _event_ids(condition: str) -> str:
    return LEDGER + f"SELECT event_id FROM judged WHERE {condition}"


ORACLE = {
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "distinct_offsets": LINES + 'SELECT partition, "offset" FROM pairs',
    "duplicate_summary": LINES
    + """SELECT (SELECT count(*) FROM lines) AS normalized_offset_row_count,
                (SELECT count(*) FROM pairs) AS distinct_partition_offset_count,
                (SELECT count(*) FROM lines) - (SELECT count(*) FROM pairs) AS duplicate_offset_row_count""",
    "partition_gap_stats": LINES + "SELECT * FROM stats",
    "gap_partitions": LINES
    + "SELECT partition, missing_offset_count, min_offset, max_offset FROM stats WHERE has_gaps",
    "next_offset": LINES + "SELECT * FROM following",
    "gap_intervals": LINES + "SELECT * FROM gaps",
    "prior_missing": LINES
    + """SELECT *, CAST(coalesce(sum(gap_size) OVER (PARTITION BY partition ORDER BY gap_start
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS prior_missing_count FROM gaps""",
    "missing_offsets": LINES + "SELECT partition, missing_offset FROM holes",
    "missing_offsets_limited": LINES + f"SELECT partition, missing_offset FROM holes WHERE nth <= {LISTING_LIMIT}",
    "ordered_missing": LINES + "SELECT partition, missing_offset FROM holes ORDER BY partition, missing_offset",
    "gap_report": LINES + "SELECT * FROM stats LEFT JOIN gaps USING (partition)",
    "missing_offsets_zero": LINES
    + """SELECT partition, CAST(0 AS BIGINT) AS listed, missing_offset_count > 0 AS missing_offsets_truncated
         FROM stats""",
    "truncation_flag": LINES
    + f"""SELECT partition, missing_offset_count, missing_offset_count > {LISTING_LIMIT} AS truncated
         FROM stats WHERE has_gaps""",
    "stats_with_report": LINES
    + f"""SELECT stats.*, coalesce(listed, '[]') AS missing_offsets, CAST(5 AS BIGINT) AS missing_offsets_limit,
                 missing_offset_count > 5 AS missing_offsets_truncated
          FROM stats LEFT JOIN {_listed(5)} USING (partition)""",
    "format_offsets": LINES + "SELECT partition, '[' || gap_start || ',' || gap_end || ']' AS offsets FROM gaps",
    "ordered_output": LINES
    + f"""SELECT partition, missing_offset_count, coalesce(listed, '[]') AS missing_offsets
          FROM stats LEFT JOIN {_listed(5)} USING (partition) ORDER BY partition""",
    "quoted_column": LEDGER + "SELECT event_id, m AS metadata FROM landed",
    "parse_metadata": LEDGER + "SELECT event_id, pt AS partition_text, ot AS offset_text FROM parsed",
    "numeric_guard": """
        WITH texts AS (
            SELECT event_id, unnest([CAST(event_id AS VARCHAR), '  ' || user_id || ' ', '-' || event_id,
                                     event_id || '99999999999', event_type, '']) AS text FROM events)
        SELECT event_id, text,
               CASE WHEN regexp_matches(trim(text), '^[0-9]+$') THEN try_cast(trim(text) AS INTEGER) END AS as_int,
               CASE WHEN regexp_matches(trim(text), '^[0-9]+$') THEN try_cast(trim(text) AS BIGINT) END AS as_bigint
        FROM texts""",
    "is_missing_metadata": _event_ids("missing_metadata"),
    "is_malformed_json": _event_ids("malformed_json"),
    "is_missing_partition": _event_ids("missing_partition"),
    "is_missing_offset": _event_ids("missing_offset"),
    "is_non_numeric_partition": _event_ids("non_numeric_partition"),
    "is_non_numeric_offset": _event_ids("non_numeric_offset"),
    "is_invalid": _event_ids("NOT valid"),
    "is_valid": _event_ids("valid"),
    "count_when": LEDGER
    + """SELECT event_type, count(*) FILTER (NOT valid) AS invalid_rows, count(*) FILTER (valid) AS valid_rows
         FROM judged GROUP BY event_type""",
    "metadata_quality": LEDGER + "SELECT * FROM quality",
    "normalize_offsets": LEDGER + "SELECT * FROM good",
    "input_guards": LEDGER
    + """SELECT eligible_row_count > 0 AS has_rows, valid_offset_row_count > 0 AS has_valid_rows FROM quality""",
    "explained_by": LEDGER + f"SELECT {KEY} FROM classified WHERE in_dead_letter",
    "unresolved": LEDGER + f"SELECT {KEY} FROM classified WHERE unresolved",
    "set_difference": LEDGER + f"SELECT {KEY} FROM classified WHERE NOT in_canary",
    "classify_missing": LEDGER + "SELECT * FROM classified",
    "unresolved_runs": LEDGER
    + """SELECT partition, min(missing_offset) AS gap_start, max(missing_offset) AS gap_end, count(*) AS gap_size
         FROM (SELECT source_partition AS partition, source_offset AS missing_offset,
                      source_offset - row_number() OVER (PARTITION BY source_partition ORDER BY source_offset) AS run
               FROM classified WHERE unresolved)
         GROUP BY partition, run""",
    "matched_records": LEDGER + "SELECT * FROM matched",
    "dead_letter_fields": LEDGER
    + """SELECT count(failure_event_id) AS failure_event_id_count, count(reason_msg) AS reason_msg_count,
                count(exception) AS exception_count FROM matched""",
    "bucket_offsets": LEDGER + f"SELECT * FROM {BUCKETS}",
    "ordered_buckets": LEDGER + f'SELECT * FROM {BUCKETS} ORDER BY partition, "offset", bucket',
    "bucket_counts": LEDGER
    + f"""SELECT bucket, source_topic, side_topic, partition, count(*) AS offset_count FROM {BUCKETS} GROUP BY ALL""",
    "reconciliation_summary": LEDGER + "SELECT * FROM summary",
    "reconcile_side_topics": LEDGER + "SELECT * FROM summary",
    "gap_verdict": LEDGER + "SELECT gap_reason IS NOT NULL AS failed, gap_reason AS reason FROM gap_reason",
    "invalid_rows_verdict": LEDGER
    + "SELECT invalid_reason IS NOT NULL AS failed, invalid_reason AS reason FROM invalid_reason",
    "final_verdict": LEDGER + "SELECT * FROM verdict",
    "final_verdict_resolved": _branch("NOT to_canary AND NOT to_dead_letter", True),
    "final_verdict_gaps_only": _branch("NOT lost", False),
    "final_verdict_gaps_allowed": _branch("NOT lost", False, fail_on_gaps=False),
    "final_verdict_clean": _branch("true", True),
    "final_verdict_truncated": LEDGER + TRUNCATED,
    "pass_message": LEDGER + "SELECT pass_message FROM message",
    "check_continuity": OLD_LEDGER + "SELECT * FROM verdict",
    "classify_partitions": LISTING + "SELECT root, path, name, is_dir, status, partition_date FROM partitions",
    "eligible_paths": LISTING + "SELECT DISTINCT path FROM partitions WHERE status = 'eligible'",
    "ordered_eligible": LISTING
    + "SELECT DISTINCT partition_date, path FROM partitions WHERE status = 'eligible' ORDER BY partition_date, path",
    "scan_summary": LISTING
    + """SELECT r.root, s.status, count(p.path) AS path_count
         FROM (SELECT DISTINCT root FROM partitions UNION SELECT '/lake/root_2') r,
              (VALUES ('eligible'), ('skipped_run_date'), ('invalid_date'), ('non_matching')) AS s(status)
         LEFT JOIN partitions p ON p.root = r.root AND p.status = s.status GROUP BY r.root, s.status""",
    "scan_roots": LEDGER
    + """SELECT DISTINCT CASE event_id % 2 WHEN 0 THEN 'root_a' ELSE 'root_b' END AS root,
                'timestampcolumn=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS name, true AS is_dir FROM landed
         UNION ALL SELECT 'root_a', '_SUCCESS', false UNION ALL SELECT 'root_b', '_SUCCESS', false""",
    "read_eligible": OLD_LEDGER + "SELECT event_id, m AS cactus__metadata FROM fields",
    "source_file": OLD_LEDGER
    + """SELECT CASE event_id % 2 WHEN 0 THEN 'root_a' ELSE 'root_b' END || '/timestampcolumn='
                || CAST(CAST(ts AS DATE) AS VARCHAR) AS directory, count(*) AS rows
         FROM fields GROUP BY 1""",
    "cross_root_union": OLD_LEDGER + "SELECT * FROM stats",
    "persist_normalized": OLD_LEDGER
    + """SELECT pv AS partition, ov AS "offset", m AS metadata_json,
                CASE event_id % 2 WHEN 0 THEN 'root_a' ELSE 'root_b' END || '/timestampcolumn='
                || CAST(CAST(ts AS DATE) AS VARCHAR) AS source_file
         FROM judged WHERE valid""",
    "reload_normalized": OLD_LEDGER + "SELECT * FROM stats",
    "publish_side_topic": LEDGER
    + """SELECT side_topic AS topic, CAST(event_id AS VARCHAR) AS key, event_id % 3 AS partition,
                event_id * 2 + copy AS "offset", '4F626A01' AS magic FROM dead_letter""",
    "publish_canary": LEDGER
    + """SELECT side_topic AS topic, CAST(event_id AS VARCHAR) AS key, event_id % 3 AS partition,
                event_id * 2 AS "offset", '4F626A01' AS magic FROM canary""",
    "read_side_topic": LEDGER
    + 'SELECT side_topic AS topic, event_id % 3 AS partition, event_id * 2 AS "offset" FROM canary',
    "decode_side_topic": LEDGER
    + f"""SELECT {RECORD}, side_topic AS kafka_topic, event_id * 2 + copy AS kafka_offset,
                 CAST(NULL AS VARCHAR) AS decode_error
          FROM (SELECT * FROM canary UNION ALL SELECT * FROM dead_letter)""",
    "decoded_record_count": LEDGER
    + """SELECT side_topic, kind, count(*) AS decoded_record_count
         FROM (SELECT side_topic, kind FROM canary UNION ALL SELECT side_topic, kind FROM dead_letter)
         GROUP BY side_topic, kind
         UNION ALL SELECT 'events-empty', 'canary', 0""",
    "synth_ledger": """
        SELECT CASE WHEN event_id % 53 = 0 THEN '{bad-json'
                    ELSE '{"partition":' || (event_id % 3) || ',"offset":' || (event_id // 3) || '}'
               END AS cactus__metadata,
               'orders' AS topic, 'payload-' || event_id AS payload, 'north' AS region,
               DATE '2026-07-01' + CAST(event_id // 400 AS INTEGER) AS timestampcolumn
        FROM events, (VALUES (0), (1)) AS copies(copy)
        WHERE event_id % 101 <> 0 AND (copies.copy = 0 OR event_id % 17 = 0)""",
}
