"""DuckDB SQL equivalents of the catalog queries (the correctness oracle).

The SQL re-derives everything from the ``events`` table with its own
statements: the dirty-Bronze rules, validation, first-wins dedup (a
row_number window), features, the content hash text and every aggregate.
Column names equal the Spark outputs.
"""

from __future__ import annotations

from tidemark.plans import catalog as C


def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _ts(iso: str) -> str:
    return "TIMESTAMP '" + iso.replace("T", " ").replace("Z", "") + "'"


RUN_TS = _ts(C.RUN_TS)
CONFIG_TYPES = _in_list(C.DEFAULT_TYPE_FILTER)

# Payload JSON text exactly as Spark prints a Variant (keys sorted, compact).
_PAYLOAD = """
    CASE ptype
      WHEN 'PushEvent' THEN '{"commits":[' || array_to_string(list_transform(range(k % 5),
          lambda i: '{"message":"commit ' || i || '","sha":"sha' || event_id || '-' || i || '"}'), ',')
          || '],"ref":"refs/heads/main","size":' || k || '}'
      WHEN 'PullRequestEvent' THEN '{"action":"' || (CASE WHEN k % 2 = 0 THEN 'opened' ELSE 'closed' END)
          || '","pull_request":{"additions":' || k || ',"deletions":' || (k % 7) || ',"merged":'
          || (CASE WHEN k % 3 = 0 THEN 'true' ELSE 'false' END) || ',"state":"'
          || (CASE WHEN k % 2 = 0 THEN 'open' ELSE 'closed' END) || '"}}'
      WHEN 'IssuesEvent' THEN '{"action":"' || (CASE WHEN k % 2 = 0 THEN 'opened' ELSE 'closed' END)
          || '","issue":{"labels":[' || array_to_string(list_transform(range(k % 3),
          lambda i: '{"name":"l' || i || '"}'), ',') || '],"state":"'
          || (CASE WHEN k % 2 = 0 THEN 'open' ELSE 'closed' END) || '"}}'
      WHEN 'WatchEvent' THEN '{"action":"started"}'
      ELSE '{}'
    END"""

BASE_CTES = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
cp AS (
  SELECT *, 0 AS copy FROM ev
  UNION ALL SELECT *, 1 AS copy FROM ev WHERE event_id % 10 = 0
  UNION ALL SELECT *, 2 AS copy FROM ev WHERE event_id % 25 = 0
),
typed AS (
  SELECT *,
    CASE WHEN copy = 1 THEN (CASE WHEN (event_id // 10) % 2 = 0 THEN 'WatchEvent' ELSE 'PushEvent' END)
         ELSE CASE event_type WHEN 'click' THEN 'PushEvent' WHEN 'view' THEN 'WatchEvent'
                WHEN 'signup' THEN 'PullRequestEvent' WHEN 'purchase' THEN 'IssuesEvent'
                WHEN 'error' THEN (['CommitCommentEvent', 'PullRequestReviewEvent', 'CreateEvent',
                                    'ForkEvent'])[event_id % 4 + 1] END
    END AS ptype,
    'org' || (k % 10) || '/repo' || k AS rname
  FROM cp
),
bronze AS (
  SELECT
    CASE WHEN event_id % 131 <> 0 THEN CAST(event_id AS VARCHAR) END AS id,
    CASE WHEN event_id % 97 <> 0 AND event_id % 103 <> 0 THEN ptype END AS type,
    CASE WHEN event_id % 149 = 0 OR event_id % 151 = 0 THEN NULL
         WHEN event_id % 101 = 0 THEN 'not-a-timestamp'
         WHEN event_id % 67 = 0 THEN strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S') || '+05:30'
         WHEN event_id % 1009 = 0 THEN strftime(ts + INTERVAL 2557 DAY, '%Y-%m-%dT%H:%M:%SZ')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS created_at,
    CASE WHEN event_id % 149 = 0 OR event_id % 151 = 0 OR event_id % 101 = 0 THEN NULL
         WHEN event_id % 67 <> 0 AND event_id % 1009 = 0 THEN date_trunc('second', ts) + INTERVAL 2557 DAY
         ELSE date_trunc('second', ts) END AS created_ts,
    event_id % 61 <> 0 AS has_payload,
    event_id % 149 = 0 AS created_absent,
    event_id % 89 = 0 AS repo_absent,
    event_id % 97 = 0 AS type_absent,
    event_id % 89 <> 0 AND event_id % 107 <> 0 AS has_repo,
    CASE WHEN has_repo AND event_id % 109 <> 0 THEN CAST(k AS BIGINT) END AS repo_id,
    CASE WHEN has_repo AND event_id % 113 <> 0 AND event_id % 127 <> 0 THEN rname END AS repo_name,
    CASE WHEN has_repo AND k % 2 = 0 THEN 'https://code.example/repos/' || rname END AS repo_url,
    event_id % 109 = 0 AS repo_id_absent, event_id % 113 = 0 AS repo_name_absent, event_id % 127 = 0 AS repo_name_null,
    user_id AS actor_id,
    CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 59 = 0 THEN '' ELSE 'user' || user_id END AS actor_login,
    CASE WHEN event_id % 61 <> 0 THEN {_PAYLOAD} END AS payload_json,
    rname AS source_repo,
    strftime(ts, '%Y-%m-%d') AS _batch_id,
    CASE copy WHEN 1 THEN event_id + 1000000000 WHEN 2 THEN event_id + 2000000000 ELSE event_id END AS _arrival_seq,
    array_to_string(list_filter([CASE WHEN event_id % 97 = 0 THEN 'type' END,
                                 CASE WHEN event_id % 149 = 0 THEN 'created_at' END,
                                 CASE WHEN event_id % 89 = 0 THEN 'repo' END,
                                 CASE WHEN has_repo AND event_id % 109 = 0 THEN 'repo.id' END,
                                 CASE WHEN has_repo AND event_id % 113 = 0 THEN 'repo.name' END],
                                lambda x: x IS NOT NULL), ',') AS absent_keys,
    k, ptype
  FROM typed
),
req AS (
  SELECT *, CASE WHEN id IS NULL THEN 'null_id'
                 WHEN type_absent THEN 'missing_type' WHEN type IS NULL THEN 'null_type'
                 WHEN created_absent THEN 'missing_created_at'
                 WHEN repo_absent THEN 'missing_repo' WHEN NOT has_repo THEN 'repo_not_object'
                 WHEN repo_id_absent THEN 'missing_repo_id' WHEN repo_name_absent THEN 'missing_repo_name'
                 WHEN repo_name_null THEN 'null_repo_name' END AS req_reason
  FROM bronze
)"""

# Cleaned + enriched rows from a row source ``src`` (validated Bronze rows).
def _silver_from(src: str) -> str:
    return f"""
  SELECT *,
    activity_category_ AS activity_category,
    event_type IN ('PushEvent', 'PullRequestEvent', 'IssuesEvent', 'CommitCommentEvent') AS is_active_contribution,
    CASE WHEN event_hour >= 6 AND event_hour < 12 THEN 'morning'
         WHEN event_hour >= 12 AND event_hour < 18 THEN 'afternoon'
         WHEN event_hour >= 18 AND event_hour < 24 THEN 'evening' ELSE 'night' END AS time_of_day,
    md5(content_head || '"event_id":"' || event_id || '",' || content_tail) AS _content_hash,
    md5(content_head || content_tail) AS _content_hash_no_id
  FROM (
    SELECT *,
      '{{"actor_id":' || COALESCE(CAST(actor_id AS VARCHAR), 'null')
        || ',"actor_login":' || COALESCE('"' || actor_login || '"', 'null')
        || ',"created_at":"' || strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f')
        || '","event_date":"' || strftime(created_at, '%Y-%m-%d')
        || '","event_hour":' || hour(created_at) || ',' AS content_head,
      '"event_type":"' || event_type || '","payload":' || payload_json || ',"repo_id":' || repo_id
        || ',"repo_name":"' || repo_name || '","repo_url":"' || repo_url || '"}}' AS content_tail,
      CAST(created_at AS DATE) AS event_date, CAST(hour(created_at) AS INTEGER) AS event_hour,
      CASE WHEN contains(event_type, 'Push') OR contains(event_type, 'Commit') THEN 'code_change'
           WHEN contains(event_type, 'PullRequest') OR contains(event_type, 'Review') THEN 'code_review'
           WHEN contains(event_type, 'Issue') THEN 'issue_management'
           WHEN contains(event_type, 'Create') OR contains(event_type, 'Delete') THEN 'repository_admin'
           ELSE 'other' END AS activity_category_,
      CASE WHEN event_type = 'PushEvent' THEN CASE WHEN has_payload THEN k ELSE 0 END END AS push_size,
      CASE WHEN event_type = 'PushEvent' THEN CASE WHEN has_payload THEN 'refs/heads/main' ELSE '' END END AS push_ref,
      CASE WHEN event_type = 'PushEvent' THEN CASE WHEN has_payload THEN k % 5 ELSE 0 END END AS push_commits_count,
      CASE WHEN event_type = 'PullRequestEvent' AND has_payload THEN (CASE WHEN k % 2 = 0 THEN 'opened' ELSE 'closed' END) END AS pr_action,
      CASE WHEN event_type = 'PullRequestEvent' AND has_payload THEN (CASE WHEN k % 2 = 0 THEN 'open' ELSE 'closed' END) END AS pr_state,
      CASE WHEN event_type = 'PullRequestEvent' THEN has_payload AND k % 3 = 0 END AS pr_merged,
      CASE WHEN event_type = 'PullRequestEvent' THEN CASE WHEN has_payload THEN k ELSE 0 END END AS pr_additions,
      CASE WHEN event_type = 'PullRequestEvent' THEN CASE WHEN has_payload THEN k % 7 ELSE 0 END END AS pr_deletions,
      CASE WHEN event_type = 'IssuesEvent' AND has_payload THEN (CASE WHEN k % 2 = 0 THEN 'opened' ELSE 'closed' END) END AS issue_action,
      CASE WHEN event_type = 'IssuesEvent' AND has_payload THEN (CASE WHEN k % 2 = 0 THEN 'open' ELSE 'closed' END) END AS issue_state,
      CASE WHEN event_type = 'IssuesEvent' THEN list_slice(['l0', 'l1'], 1, CASE WHEN has_payload THEN k % 3 ELSE 0 END) END AS issue_labels,
      CASE WHEN event_type = 'WatchEvent' AND has_payload THEN 'started' END AS watch_action
    FROM (
      SELECT id AS event_id, type AS event_type,
        COALESCE(created_ts, {RUN_TS}) AS created_at, created_ts IS NULL AS _ts_fallback,
        repo_id, repo_name, COALESCE(repo_url, '') AS repo_url, actor_id, actor_login,
        COALESCE(payload_json, '{{}}') AS payload_json, has_payload,
        source_repo, _batch_id, _arrival_seq, k
      FROM {src}
    ) c0
  ) c1"""


def _first_wins(src: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY _arrival_seq) AS rn FROM {src}
  ) r WHERE rn = 1"""


SILVER_TAIL = f""",
valid AS (SELECT * FROM req WHERE req_reason IS NULL),
surv AS ({_first_wins('valid')}),
silver AS ({_silver_from('surv')})"""
SILVER_CTES = BASE_CTES + SILVER_TAIL

LABELED_CTES = BASE_CTES + f""",
firsts AS (SELECT id, min(_arrival_seq) AS _arrival_seq, true AS is_first FROM req
           WHERE req_reason IS NULL GROUP BY id),
labeled AS (
  SELECT r.*, CASE WHEN r.req_reason IS NOT NULL THEN r.req_reason
                   WHEN f.is_first IS NULL THEN 'duplicate'
                   WHEN NOT COALESCE(r.type IN ({{types}}), false) THEN 'type_filtered' END AS reason
  FROM req r LEFT JOIN firsts f ON r.id = f.id AND r._arrival_seq = f._arrival_seq
)"""


def with_silver(select: str) -> str:
    return f"WITH {SILVER_CTES}\n{select}"


def with_labeled(select: str, types: str | None = CONFIG_TYPES) -> str:
    ctes = LABELED_CTES.replace("{types}", types) if types else LABELED_CTES.replace(
        "WHEN NOT COALESCE(r.type IN ({types}), false) THEN 'type_filtered' ", "")
    return f"WITH {ctes}\n{select}"


def _top_k(src: str, key: str, k: int) -> str:
    return f"""SELECT {key}, event_type, event_count, rank FROM (
  SELECT {key}, event_type, event_count,
         CAST(row_number() OVER (PARTITION BY {key} ORDER BY event_count DESC, event_type ASC) AS INTEGER) AS rank
  FROM (SELECT {key}, event_type, count(*) AS event_count FROM {src} GROUP BY {key}, event_type) t
) r WHERE rank <= {k}"""


FLAT = """event_id, event_type, created_at, repo_id, repo_name, repo_url, actor_id, actor_login,
  event_date, event_hour, _ts_fallback, source_repo, _batch_id, _arrival_seq"""

_LOGIN = "NULLIF(actor_login, '')"

_REPO_METRICS = f"""SELECT repo_name, count(*) AS total_events, count(DISTINCT {_LOGIN}) AS unique_contributors,
  count(*) FILTER (WHERE is_active_contribution) AS active_contributions,
  min(created_at) AS first_event, max(created_at) AS last_event,
  round(100.0 * count(*) FILTER (WHERE is_active_contribution) / count(*), 1) AS engagement_rate
FROM silver GROUP BY repo_name"""

_CONTRIB_METRICS = f"""SELECT actor_login, count(*) AS total_contributions, count(DISTINCT repo_name) AS repos_count,
  max(created_at) AS last_activity
FROM silver WHERE {_LOGIN} IS NOT NULL GROUP BY actor_login"""

_NUMERIC = ("event_hour", "repo_id", "actor_id", "push_size", "push_commits_count",
            "pr_additions", "pr_deletions")
_NULLCOLS = ("event_id", "event_type", "created_at", "repo_id", "repo_name", "repo_url",
             "actor_id", "actor_login", "event_date", "event_hour", "push_size", "push_ref",
             "push_commits_count", "pr_action", "pr_state", "pr_merged", "pr_additions",
             "pr_deletions", "issue_action", "issue_state", "watch_action",
             "activity_category", "is_active_contribution", "time_of_day")


def _describe() -> str:
    parts = []
    for c in _NUMERIC:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS column_name, count({x}) AS count, round(avg({x}), 6) AS mean,
  round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min,
  round(quantile_cont({x}, 0.25), 6) AS p25, round(quantile_cont({x}, 0.5), 6) AS p50,
  round(quantile_cont({x}, 0.75), 6) AS p75, round(max({x}), 6) AS max FROM silver""")
    return with_silver("\nUNION ALL\n".join(parts))


def _null_profile() -> str:
    parts = [f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM silver"
             for c in _NULLCOLS]
    return with_silver("\nUNION ALL\n".join(parts))


def _heatmap() -> str:
    cols = ",\n  ".join(f"count(*) FILTER (WHERE event_hour = {h}) AS h{h:02d}" for h in range(24))
    return with_silver(f"""SELECT dayname(created_at) AS day_name, CAST(isodow(created_at) AS INTEGER) AS day_rank,
  {cols}
FROM silver GROUP BY 1, 2""")


_RUN1_SILVER = SILVER_CTES.replace(
    "valid AS (SELECT * FROM req WHERE req_reason IS NULL)",
    f"valid AS (SELECT * FROM req WHERE req_reason IS NULL AND _batch_id <= '{C.RUN1_LAST_BATCH}')")

_INCREMENTAL_CTES = _RUN1_SILVER + f""",
wm AS (SELECT source_repo, max(created_at) FILTER (WHERE NOT _ts_fallback) AS watermark,
              count(*) AS records_processed FROM silver GROUP BY source_repo),
newb AS (
  SELECT q.* FROM req q LEFT JOIN wm ON q.source_repo = wm.source_repo
  WHERE q.req_reason IS NULL AND (wm.watermark IS NULL
        OR q.created_ts IS NULL OR q.created_ts > wm.watermark)
),
surv2 AS ({_first_wins('newb')}),
silver2 AS ({_silver_from('surv2')})"""

_RUNS_CTES = with_labeled("", None)[len("WITH "):] + f""",
agg AS (
  SELECT source_repo, _batch_id, count(*) AS raw_rows,
    count(*) FILTER (WHERE reason IS NULL) AS records_processed,
    count(*) FILTER (WHERE reason IS NOT NULL AND reason NOT IN ('duplicate', 'type_filtered')) AS rejected
  FROM labeled GROUP BY source_repo, _batch_id
),
runs AS (
  SELECT source_repo || '@' || _batch_id AS run_id, source_repo, _batch_id,
    CAST(CAST(_batch_id AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY + raw_rows * INTERVAL 1 MINUTE AS start_time,
    CAST(CAST(_batch_id AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY + raw_rows * INTERVAL 1 MINUTE
      + to_microseconds(CAST(round(1.0 + raw_rows * 0.25, 3) * 1000000 AS BIGINT)) AS end_time,
    round(1.0 + raw_rows * 0.25, 3) AS duration_seconds,
    records_processed,
    CASE WHEN rejected > 0 THEN 'failed' ELSE 'success' END AS status,
    CASE WHEN rejected > 0 THEN 'rejected ' || rejected || ' rows' END AS error
  FROM agg
)"""

_STREAM_VALID = BASE_CTES + f""",
valid AS (SELECT * FROM req WHERE req_reason IS NULL),
surv AS ({_first_wins('valid')}),
sv AS (SELECT id AS event_id, type AS event_type, repo_name, created_ts,
         COALESCE(created_ts, {RUN_TS}) AS event_time,
         CASE WHEN CAST(id AS BIGINT) % 101 = 0 OR CAST(id AS BIGINT) % 149 = 0 OR CAST(id AS BIGINT) % 151 = 0
              THEN 0 ELSE CAST(substr(_batch_id, 9, 2) AS INTEGER) * 3 % 5 END AS file
       FROM surv)"""

# Landing files: the same events, with a broken line after some of them.
_LANDING_CTES = LABELED_CTES.replace("{types}", CONFIG_TYPES) + """,
broken AS (SELECT rname AS source_repo, '{"id": "' || event_id || '", broken' AS raw
           FROM typed WHERE copy = 0 AND event_id % 500 = 1)"""


def _run_ctes(changed: bool = False) -> str:
    """Labels, Silver rows and watermarks of the three incremental runs, or of
    them with the second one as it is sent again."""
    more = """ AND NOT eid % 30 = 9
       UNION ALL SELECT * FROM ev0 WHERE dom > 20 AND eid % 70 = 5""" if changed else ""
    less = " AND NOT eid % 30 = 9" if changed else ""
    out = BASE_CTES + """,
ev0 AS (SELECT *, _arrival_seq % 1000000000 AS eid, CAST(substr(_batch_id, 9, 2) AS INTEGER) AS dom FROM req),
r1 AS (SELECT * FROM ev0 WHERE dom <= 10 AND NOT eid % 40 = 7),
r2 AS (SELECT * FROM ev0 WHERE dom > 10 AND dom <= 20""" + more + """
       UNION ALL SELECT * REPLACE (CAST(CAST(_batch_id AS DATE) AS TIMESTAMP) + INTERVAL 252 HOUR AS created_ts,
                                   _arrival_seq + 3000000000 AS _arrival_seq)
       FROM ev0 WHERE dom <= 10 AND eid % 50 = 3""" + less + """),
r3 AS (SELECT * FROM ev0 WHERE dom > 20 OR (dom <= 10 AND eid % 40 = 7)),
w0 AS (SELECT source_repo, created_ts AS watermark FROM ev0 WHERE false)"""
    for k, batch in enumerate(C.testdata.BATCHES, 1):
        seen = " UNION ALL ".join(f"SELECT id FROM s{j}" for j in range(1, k)) or "SELECT id FROM ev0 WHERE false"
        out += f""",
m{k} AS (SELECT r.* EXCLUDE (_batch_id), '{batch}' AS _batch_id,
    CASE WHEN r.req_reason IS NOT NULL THEN r.req_reason WHEN r.created_ts <= w.watermark THEN 'late' END AS reason1
  FROM r{k} r LEFT JOIN w{k - 1} w ON r.source_repo = w.source_repo),
f{k} AS (SELECT id, min(_arrival_seq) AS first_seq FROM m{k} WHERE reason1 IS NULL GROUP BY id),
l{k} AS (SELECT m.*, CASE WHEN m.reason1 IS NOT NULL THEN m.reason1
      WHEN f.first_seq <> m._arrival_seq THEN 'duplicate'
      WHEN NOT COALESCE(m.type IN ({CONFIG_TYPES}), false) THEN 'type_filtered'
      WHEN m.id IN ({seen}) THEN 'already_in_silver' END AS reason
  FROM m{k} m LEFT JOIN f{k} f ON m.id = f.id),
s{k} AS (SELECT * FROM l{k} WHERE reason IS NULL),
w{k} AS (SELECT source_repo, max(watermark) AS watermark FROM (
    SELECT * FROM w{k - 1} UNION ALL SELECT source_repo, created_ts AS watermark FROM s{k}) x GROUP BY source_repo)"""
    return out + """,
labels AS (SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3),
kept AS (SELECT * FROM labels WHERE reason IS NULL)"""


_RUN_CTES = _run_ctes()
_RUN_TABLE = """(VALUES (TIMESTAMP '2024-02-01 00:00:00', 's1'), (TIMESTAMP '2024-02-02 00:00:00', 's2'),
  (TIMESTAMP '2024-02-03 00:00:00', 's3'), (TIMESTAMP '2024-02-04 00:00:00', 'failed')) t(start_time, what)"""
_RUN_ROWS = f"""runs AS (SELECT start_time, start_time + INTERVAL 2 MINUTE AS end_time, 120.0::DOUBLE AS duration_seconds,
  CASE what WHEN 's1' THEN (SELECT count(*) FROM s1) WHEN 's2' THEN (SELECT count(*) FROM s2)
            WHEN 's3' THEN (SELECT count(*) FROM s3) ELSE 0 END AS records_processed,
  CASE what WHEN 'failed' THEN 'failed' ELSE 'success' END AS status, what = 'failed' AS has_error
  FROM {_RUN_TABLE})"""


def with_runs(select: str) -> str:
    return f"WITH {_RUN_CTES}\n{select}"


def _run_silver(k: int) -> str:
    return f"(SELECT * FROM ({_silver_from(f's{k}')}) x)"


def _document() -> str:
    time = "'%Y-%m-%dT%H:%M:%S'"
    return with_runs(f""", silver AS ({_silver_from('s3')}),
repos AS ({_REPO_METRICS}), people AS ({_CONTRIB_METRICS})
SELECT 'summary' AS section, 'all' AS key, '{{"total_events":' || count(*) || ',"calculation_timestamp":"'
    || strftime({RUN_TS}, {time}) || '"}}' AS value FROM silver
UNION ALL SELECT 'event_types', event_type, '{{"event_count":' || count(*) || '}}' FROM silver GROUP BY event_type
UNION ALL SELECT 'repos', repo_name, '{{"total_events":' || total_events || ',"unique_contributors":'
    || unique_contributors || ',"active_contributions":' || active_contributions || ',"first_event":"'
    || strftime(first_event, {time}) || '","last_event":"' || strftime(last_event, {time}) || '"}}' FROM repos
UNION ALL SELECT 'contributors', actor_login, '{{"total_contributions":' || total_contributions || ',"repos_count":'
    || repos_count || ',"last_activity":"' || strftime(last_activity, {time}) || '"}}' FROM people
UNION ALL SELECT 'daily', CAST(event_date AS VARCHAR), '{{"event_count":' || count(*) || ',"active_repos_count":'
    || count(DISTINCT repo_name) || '}}' FROM silver GROUP BY event_date
UNION ALL SELECT 'top_repos', CAST(n AS VARCHAR), '{{"repo_name":"' || repo_name || '","total_events":'
    || total_events || '}}' FROM (SELECT *, row_number() OVER (ORDER BY total_events DESC, repo_name) AS n FROM repos) a
  WHERE n <= 10
UNION ALL SELECT 'top_contributors', CAST(n AS VARCHAR), '{{"actor_login":"' || actor_login
    || '","total_contributions":' || total_contributions || '}}'
  FROM (SELECT *, row_number() OVER (ORDER BY total_contributions DESC, actor_login) AS n FROM people) b
  WHERE n <= 10""").replace("\n, silver AS", ",\nsilver AS", 1)


# Spark types of the flat Silver columns, in order.
_FLAT_TYPES = (("event_id", "string"), ("event_type", "string"), ("created_at", "timestamp_ntz"),
               ("repo_id", "bigint"), ("repo_name", "string"), ("repo_url", "string"), ("actor_id", "bigint"),
               ("actor_login", "string"), ("event_date", "date"), ("event_hour", "int"),
               ("_ts_fallback", "boolean"), ("source_repo", "string"), ("_batch_id", "string"),
               ("_arrival_seq", "bigint"))

_FILTER_REPOS = _in_list(C.FILTER_REPOS)

SQL: dict[str, str] = {
    "bronze_rows": f"""WITH {BASE_CTES}
SELECT id, type, created_at, repo_id, repo_name, repo_url, actor_id, actor_login, payload_json,
  source_repo, _batch_id, _arrival_seq, absent_keys, 'testdata_events' AS _source,
  {RUN_TS} AS ingestion_timestamp, 'events' AS _file FROM bronze""",
    "bronze_source_counts": f"""WITH {BASE_CTES}
SELECT source_repo, count(*) AS raw_events, count(DISTINCT id) AS distinct_ids,
  count(DISTINCT _batch_id) AS batches FROM bronze GROUP BY source_repo""",
    "silver_clean": with_silver(f"SELECT {FLAT} FROM silver"),
    "silver_type_filtered": with_silver(
        f"SELECT event_id, event_type, _arrival_seq FROM silver WHERE event_type IN ({CONFIG_TYPES})"),
    "silver_quarantine": with_labeled(
        "SELECT id AS event_id, type, _batch_id, _arrival_seq, reason AS reject_reason FROM labeled WHERE reason IS NOT NULL"),
    "batch_quality_stats": with_labeled("""SELECT _batch_id, count(*) AS total,
  count(*) FILTER (WHERE reason IS NULL) AS valid, count(*) FILTER (WHERE reason IS NOT NULL) AS filtered,
  count(*) FILTER (WHERE reason IS NOT NULL AND reason NOT IN ('duplicate', 'type_filtered')) AS invalid,
  count(*) FILTER (WHERE reason = 'duplicate') AS duplicates,
  count(*) FILTER (WHERE reason = 'type_filtered') AS type_filtered
FROM labeled GROUP BY _batch_id"""),
    "reject_reasons": with_labeled(
        "SELECT reason AS reject_reason, count(*) AS n_rows FROM labeled WHERE reason IS NOT NULL GROUP BY reason"),
    "dedup_first_wins": with_silver("SELECT id AS event_id, type AS event_type, _arrival_seq FROM surv"),
    "duplicate_rows": with_silver("""SELECT v.id AS event_id, v.type AS event_type, v._arrival_seq
FROM valid v ANTI JOIN surv s ON v.id = s.id AND v._arrival_seq = s._arrival_seq"""),
    "content_hash": with_silver("SELECT event_id, _content_hash FROM silver"),
    "dedup_content_hash": with_silver(f"""SELECT event_id, event_type, _arrival_seq, _content_hash FROM (
  SELECT *, row_number() OVER (PARTITION BY _content_hash ORDER BY _arrival_seq) AS rn
  FROM ({_silver_from('valid')}) a
) b WHERE rn = 1"""),
    "duplicate_count": f"""WITH {BASE_CTES}
SELECT count(*) AS n_rows, count(DISTINCT id) + max(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS n_keys,
  count(*) - count(DISTINCT id) - max(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS n_duplicates FROM bronze""",
    "silver_push_features": with_silver(
        "SELECT event_id, push_size, push_ref, push_commits_count FROM silver WHERE event_type = 'PushEvent'"),
    "silver_pr_features": with_silver("""SELECT event_id, pr_action, pr_state, pr_merged, pr_additions, pr_deletions
FROM silver WHERE event_type = 'PullRequestEvent'"""),
    "silver_issue_features": with_silver("""SELECT event_id, issue_action, issue_state,
  array_to_string(issue_labels, ',') AS issue_labels, CAST(len(issue_labels) AS INTEGER) AS n_labels
FROM silver WHERE event_type = 'IssuesEvent'"""),
    "silver_enriched": with_silver("""SELECT event_id, event_type, activity_category, is_active_contribution,
  time_of_day, dayname(created_at) AS day_name, watch_action FROM silver"""),
    "event_type_counts": with_silver("SELECT event_type, count(*) AS event_count FROM silver GROUP BY event_type"),
    "repo_metrics": with_silver(_REPO_METRICS),
    "repo_top_types": with_silver(_top_k("silver", "repo_name", 5)),
    "contributor_metrics": with_silver(_CONTRIB_METRICS),
    "contributor_repos": with_silver(
        f"SELECT DISTINCT actor_login, repo_name FROM silver WHERE {_LOGIN} IS NOT NULL"),
    "contributor_top_types": with_silver(
        _top_k(f"(SELECT * FROM silver WHERE {_LOGIN} IS NOT NULL)", "actor_login", 3)),
    "daily_series": with_silver("""SELECT event_date, count(*) AS event_count,
  count(DISTINCT repo_name) AS active_repos_count FROM silver GROUP BY event_date"""),
    "daily_top_types": with_silver(_top_k("silver", "event_date", 3)),
    "hourly_series": with_silver("""SELECT strftime(created_at, '%Y-%m-%dT%H') AS hour_key, count(*) AS event_count
FROM silver GROUP BY 1"""),
    "hourly_types": with_silver("""SELECT strftime(created_at, '%Y-%m-%dT%H') AS hour_key, event_type,
  count(*) AS event_count FROM silver GROUP BY 1, 2"""),
    "activity_totals": with_silver("""SELECT count(*) AS total_events,
  count(*) FILTER (WHERE is_active_contribution) AS active_contributions FROM silver"""),
    "activity_category": with_silver(
        "SELECT activity_category, count(*) AS event_count FROM silver GROUP BY activity_category"),
    "time_of_day": with_silver("SELECT time_of_day, count(*) AS event_count FROM silver GROUP BY time_of_day"),
    "push_metrics": with_silver("""SELECT total_pushes, total_commits,
  round(total_commits / total_pushes, 6) AS avg_commits_per_push FROM (
  SELECT count(*) AS total_pushes, CAST(sum(COALESCE(push_commits_count, 0)) AS BIGINT) AS total_commits
  FROM silver WHERE event_type = 'PushEvent') t WHERE total_pushes > 0"""),
    "pr_metrics": with_silver("""SELECT * FROM (SELECT count(*) AS total_prs,
  count(*) FILTER (WHERE COALESCE(pr_merged, false)) AS merged_prs
  FROM silver WHERE event_type = 'PullRequestEvent') t WHERE total_prs > 0"""),
    "pr_actions": with_silver("""SELECT pr_action, count(*) AS event_count FROM silver
WHERE event_type = 'PullRequestEvent' GROUP BY pr_action"""),
    "activity_single_pass": with_silver("""SELECT count(*) AS total_events,
  count(*) FILTER (WHERE is_active_contribution) AS active_contributions,
  count(*) FILTER (WHERE event_type = 'PushEvent') AS total_pushes,
  CAST(sum(CASE WHEN event_type = 'PushEvent' THEN COALESCE(push_commits_count, 0) END) AS BIGINT) AS total_commits,
  count(*) FILTER (WHERE event_type = 'PullRequestEvent') AS total_prs,
  count(*) FILTER (WHERE event_type = 'PullRequestEvent' AND COALESCE(pr_merged, false)) AS merged_prs
FROM silver"""),
    "metrics_summary": with_silver(f"SELECT count(*) AS total_events, {RUN_TS} AS calculation_timestamp FROM silver"),
    "type_by_date": with_silver(
        "SELECT event_type, event_date, count(*) AS event_count FROM silver GROUP BY event_type, event_date"),
    "top_repos": with_silver(f"""SELECT *, CAST(row_number() OVER (ORDER BY total_events DESC, repo_name ASC) AS INTEGER) AS rank
FROM ({_REPO_METRICS}) m ORDER BY total_events DESC, repo_name ASC LIMIT {C.TOP_N}"""),
    "top_contributors": with_silver(f"""SELECT *, CAST(row_number() OVER (ORDER BY total_contributions DESC, actor_login ASC) AS INTEGER) AS rank
FROM ({_CONTRIB_METRICS}) m ORDER BY total_contributions DESC, actor_login ASC LIMIT {C.TOP_N}"""),
    "latest_event_per_repo": with_silver("""SELECT repo_name, event_id, event_type, created_at FROM (
  SELECT repo_name, event_id, event_type, created_at,
    row_number() OVER (PARTITION BY repo_name ORDER BY created_at DESC, event_id DESC) AS rn FROM silver
) t WHERE rn = 1"""),
    "null_profile": _null_profile(),
    "numeric_profile": _describe(),
    "shape_profile": with_silver("SELECT count(*) AS n_rows, 36 AS n_columns FROM silver"),
    "date_span": with_silver("""SELECT min(created_at) AS min_created_at, max(created_at) AS max_created_at,
  CAST(floor((epoch_us(max(created_at)) - epoch_us(min(created_at))) / 86400000000) AS BIGINT) AS span_days
FROM silver"""),
    "sample_rows": with_silver(f"SELECT {FLAT} FROM silver ORDER BY _arrival_seq LIMIT 5"),
    "filtered_events": with_silver(f"""SELECT event_id, event_type, repo_name, created_at FROM silver
WHERE event_type IN ({_in_list(C.FILTER_TYPES)}) AND repo_name IN ({_FILTER_REPOS})
  AND created_at >= {_ts(C.FILTER_START + 'T00:00:00Z')} AND created_at <= {_ts(C.FILTER_END + 'T00:00:00Z')}"""),
    "adhoc_repo_stats": with_silver("""SELECT repo_name, count(event_id) AS event_count,
  count(DISTINCT actor_login) AS actor_nunique, min(created_at) AS first_event, max(created_at) AS last_event
FROM silver GROUP BY repo_name"""),
    "adhoc_contributor_stats": with_silver("""SELECT a.actor_login, a.event_count, a.repo_nunique, m.event_type AS modal_event_type
FROM (SELECT actor_login, count(event_id) AS event_count, count(DISTINCT repo_name) AS repo_nunique
      FROM silver WHERE actor_login IS NOT NULL GROUP BY actor_login) a
JOIN (SELECT actor_login, event_type FROM (
        SELECT actor_login, event_type,
          row_number() OVER (PARTITION BY actor_login ORDER BY count(*) DESC, event_type ASC) AS rn
        FROM silver WHERE actor_login IS NOT NULL GROUP BY actor_login, event_type) t WHERE rn = 1) m
  ON a.actor_login = m.actor_login"""),
    "hour_distribution": with_silver("SELECT event_hour, count(*) AS event_count FROM silver GROUP BY event_hour"),
    "daily_trends": with_silver("""SELECT CAST(created_at AS DATE) AS event_date, count(event_id) AS event_count,
  count(DISTINCT repo_name) AS repo_nunique, count(DISTINCT actor_login) AS actor_nunique
FROM silver GROUP BY 1"""),
    "hour_floor_series": with_silver(
        "SELECT date_trunc('hour', created_at) AS hour_start, count(*) AS event_count FROM silver GROUP BY 1"),
    "weekday_hour_heatmap": _heatmap(),
    "type_share": with_silver("""SELECT event_type, event_count,
  round(100.0 * event_count / sum(event_count) OVER (), 4) AS share_pct
FROM (SELECT event_type, count(*) AS event_count FROM silver GROUP BY event_type) t"""),
    "contribution_histogram": with_silver(f"""SELECT bin, count(*) AS contributors,
  round(lo + (bin - 1) * (hi - lo) / 20, 6) AS bin_lower, round(lo + bin * (hi - lo) / 20, 6) AS bin_upper
FROM (
  SELECT lo, hi, CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor((x - lo) * 20 / (hi - lo)) + 1, 20) END AS INTEGER) AS bin
  FROM (SELECT total_contributions AS x FROM ({_CONTRIB_METRICS}) c) p,
       (SELECT min(total_contributions) AS lo, max(total_contributions) AS hi FROM ({_CONTRIB_METRICS}) c2) r
) b GROUP BY bin, lo, hi"""),
    "kpis": with_silver(f"""SELECT count(*) AS total_events, count(DISTINCT repo_name) AS repos,
  count(DISTINCT {_LOGIN}) AS contributors, count(DISTINCT event_type) AS event_types FROM silver"""),
    "filtered_summary": with_silver(f"""SELECT event_type, count(*) AS event_count,
  (SELECT count(*) FROM f) AS total_events, (SELECT count(DISTINCT repo_name) FROM f) AS repos,
  (SELECT count(DISTINCT actor_login) FROM f) AS contributors
FROM f GROUP BY event_type""").replace(
        "\nSELECT event_type, count(*)",
        f",\nf AS (SELECT * FROM silver WHERE event_type IN ({_in_list(C.SUMMARY_TYPES)}) "
        f"AND repo_name IN ({_FILTER_REPOS}))\nSELECT event_type, count(*)", 1),
    "distinct_repos": with_silver("SELECT DISTINCT repo_name FROM silver"),
    "date_spine": with_silver("""SELECT CAST(d AS DATE) AS event_date FROM (
  SELECT unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 DAY)) AS d FROM silver) t"""),
    "peak_hour": with_silver("""SELECT
  (SELECT event_hour FROM silver GROUP BY event_hour ORDER BY count(*) DESC, event_hour ASC LIMIT 1) AS peak_hour,
  (SELECT time_of_day FROM silver GROUP BY time_of_day ORDER BY count(*) DESC, time_of_day ASC LIMIT 1) AS peak_time_of_day"""),
    "key_insights": with_silver(f""", t1 AS (SELECT event_type, count(*) AS n FROM silver GROUP BY event_type
  ORDER BY n DESC, event_type ASC LIMIT 1),
r1 AS (SELECT * FROM ({_REPO_METRICS}) r ORDER BY total_events DESC, repo_name ASC LIMIT 1),
c1 AS (SELECT * FROM ({_CONTRIB_METRICS}) c ORDER BY total_contributions DESC, actor_login ASC LIMIT 1)
SELECT (SELECT count(*) FROM silver) AS total_events,
  (SELECT count(DISTINCT repo_name) FROM silver) AS n_repos,
  (SELECT count(*) FROM ({_CONTRIB_METRICS}) c) AS n_contributors,
  (SELECT event_type FROM t1) AS top_event_type, (SELECT n FROM t1) AS top_event_type_count,
  round(100.0 * (SELECT n FROM t1) / (SELECT count(*) FROM silver), 1) AS top_event_type_pct,
  (SELECT repo_name FROM r1) AS top_repo, (SELECT total_events FROM r1) AS top_repo_events,
  (SELECT unique_contributors FROM r1) AS top_repo_contributors,
  (SELECT actor_login FROM c1) AS top_contributor,
  (SELECT total_contributions FROM c1) AS top_contributor_contributions,
  (SELECT repos_count FROM c1) AS top_contributor_repos""").replace("\n, t1 AS", ",\nt1 AS", 1),
    "batch_date_range": with_silver("""SELECT _batch_id, min(created_at) AS min_created_at,
  max(created_at) AS max_created_at FROM silver GROUP BY _batch_id"""),
    "watermark_by_source": f"WITH {_RUN1_SILVER}\n" + """SELECT source_repo,
  max(created_at) FILTER (WHERE NOT _ts_fallback) AS watermark, count(*) AS records_processed
FROM silver GROUP BY source_repo""",
    "incremental_new_rows": f"WITH {_INCREMENTAL_CTES}\n"
        "SELECT event_id, source_repo, _batch_id, created_at FROM silver2",
    "anti_join_new_events": f"WITH {_INCREMENTAL_CTES}\n"
        "SELECT event_id, event_type, _batch_id FROM silver2 ANTI JOIN silver USING (event_id)",
    "committed_events": "WITH " + _RUNS_CTES + SILVER_TAIL + """
SELECT s.event_id, s._batch_id FROM silver s SEMI JOIN (SELECT source_repo, _batch_id FROM runs
  WHERE status = 'success') r ON s.source_repo = r.source_repo AND s._batch_id = r._batch_id""",
    "run_log": f"WITH {_RUNS_CTES}\nSELECT * FROM runs",
    "run_health": f"WITH {_RUNS_CTES}\n" + """SELECT source_repo, count(*) AS n_runs,
  arg_max(status, end_time) AS last_status, arg_max(duration_seconds, end_time) AS last_duration_seconds,
  round(100.0 * count(*) FILTER (WHERE status = 'success') / count(*), 1) AS success_rate_pct
FROM runs GROUP BY source_repo""",
    "freshness": f"WITH {_RUNS_CTES}\n" + f"""SELECT source_repo, last_success_end,
  CAST(floor((epoch_us({_ts(C.FRESHNESS_AS_OF)}) - epoch_us(last_success_end)) / 60000000) AS BIGINT) AS minutes_since_success,
  COALESCE(floor((epoch_us({_ts(C.FRESHNESS_AS_OF)}) - epoch_us(last_success_end)) / 60000000) > 60, true) AS is_stale,
  (epoch_us({_ts(C.FRESHNESS_AS_OF)}) - epoch_us(last_end)) / 3600000000 > 24 AS no_run_in_window
FROM (SELECT source_repo, max(end_time) FILTER (WHERE status = 'success') AS last_success_end,
        max(end_time) AS last_end FROM runs GROUP BY source_repo) t""",
    "run_trend": f"WITH {_RUNS_CTES}\n" + """SELECT source_repo, run_id, start_time, duration_seconds,
  lag(duration_seconds) OVER w AS prev_duration_seconds,
  round(avg(duration_seconds) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS trailing_avg_seconds,
  round(duration_seconds - lag(duration_seconds) OVER w, 6) AS duration_change
FROM runs WINDOW w AS (PARTITION BY source_repo ORDER BY start_time, run_id)""",
    "error_alerts": f"WITH {_RUNS_CTES}\n" + """SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end,
  n_failed, n_runs FROM (
  SELECT time_bucket(INTERVAL 5 MINUTE, end_time, TIMESTAMP '1970-01-01') AS window_start,
    count(*) FILTER (WHERE status = 'failed') AS n_failed, count(*) AS n_runs
  FROM runs GROUP BY 1) t WHERE n_failed > 5""",
    "retention_plan": with_silver(f""", parts AS (
  SELECT 'bronze' AS layer, _batch_id, count(*) AS row_count FROM bronze GROUP BY _batch_id
  UNION ALL SELECT 'silver' AS layer, _batch_id, count(*) AS row_count FROM silver GROUP BY _batch_id
)
SELECT layer, _batch_id, age_days,
  CASE WHEN layer = 'bronze' AND age_days >= 365 THEN 'expire'
       WHEN layer = 'bronze' AND age_days >= 90 THEN 'archive'
       WHEN layer = 'silver' AND age_days >= 180 THEN 'archive' ELSE 'keep' END AS action, row_count
FROM (SELECT *, CAST(date_diff('day', CAST(_batch_id AS DATE), DATE '{C.RETENTION_AS_OF[:10]}') AS INTEGER) AS age_days
      FROM parts) p""").replace("\n, parts AS", ",\nparts AS", 1),
    "stream_dedup": f"WITH {BASE_CTES}\n"
        "SELECT DISTINCT id AS event_id, _batch_id FROM req WHERE req_reason IS NULL",
    "stream_dedup_state": f"WITH {BASE_CTES}\n"
        "SELECT DISTINCT id AS event_id, _batch_id FROM req WHERE req_reason IS NULL",
    "stream_state_windows": f"WITH {_STREAM_VALID}\n" + """SELECT window_start, window_start + INTERVAL 25 MINUTE AS window_end,
  event_type, count(*) AS event_count FROM (
  SELECT time_bucket(INTERVAL 10 MINUTE, event_time, TIMESTAMP '1970-01-01') - o * INTERVAL 10 MINUTE AS window_start,
         event_time, event_type FROM sv, (SELECT unnest([0, 1, 2]) AS o) offs) t
WHERE event_time < window_start + INTERVAL 25 MINUTE GROUP BY window_start, event_type""",
    "stream_hourly_counts": f"WITH {_STREAM_VALID}\n" + """SELECT date_trunc('hour', event_time) AS window_start,
  date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end, count(*) AS event_count FROM sv GROUP BY 1""",
    "stream_daily_distinct_repos": f"WITH {_STREAM_VALID}\n" + """SELECT CAST(event_time AS DATE) AS event_date,
  count(DISTINCT repo_name) AS active_repos_count FROM sv GROUP BY 1""",
    "stream_sliding_counts": f"WITH {_STREAM_VALID}\n" + """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end,
  count(*) AS event_count FROM (
  SELECT time_bucket(INTERVAL 15 MINUTE, event_time, TIMESTAMP '1970-01-01') - o * INTERVAL 15 MINUTE AS window_start
  FROM sv, (SELECT unnest([0, 1, 2, 3]) AS o) offs) t GROUP BY window_start""",
    "stream_late_rows": f"WITH {_STREAM_VALID}" + """,
high AS (SELECT a.f AS file, (SELECT max(created_ts) FROM sv b WHERE b.file < a.f) AS high
         FROM (SELECT unnest(range(5)) AS f) a)
SELECT s.event_id, s.event_time FROM sv s JOIN high h ON s.file = h.file
WHERE s.created_ts < h.high - INTERVAL 1 HOUR""",
    "stream_hourly_type_counts": f"WITH {_STREAM_VALID}\n" + """SELECT date_trunc('hour', event_time) AS window_start,
  date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS event_count
FROM sv GROUP BY 1, 3""",
    "landing_bronze": f"WITH {_LANDING_CTES}\n" + """SELECT id, type, created_at, repo_id, repo_name, repo_url,
  actor_id, actor_login, COALESCE(payload_json, 'null') AS payload_json, source_repo, absent_keys,
  'true' AS unknown_field_or_raw FROM bronze
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, source_repo, '_corrupt_record', raw FROM broken""",
    "landing_odd_files": """WITH e AS (SELECT event_id, event_id % 7 AS kind, '{"id": "' || event_id || '"}' AS t FROM events)
SELECT event_id, CASE WHEN kind IN (0, 4) THEN CAST(event_id AS VARCHAR) WHEN kind = 6 THEN 'x' END AS id,
  CASE kind WHEN 1 THEN '[' || t || '] trailing' WHEN 2 THEN t || t WHEN 3 THEN '[' || t
            WHEN 5 THEN '[' || t || ']' || chr(10) || '[' || t || ']' END AS rejected FROM e
UNION ALL SELECT event_id, NULL, '# comment' FROM e WHERE kind = 4""",
    "landing_source_counts": f"WITH {_LANDING_CTES}\n" + """SELECT source_repo, count(*) AS raw_events,
  count(*) FILTER (WHERE bad) AS corrupt_rows, count(DISTINCT id) AS distinct_ids
FROM (SELECT source_repo, id, false AS bad FROM bronze UNION ALL SELECT source_repo, NULL, true FROM broken) x
GROUP BY source_repo""",
    "landing_silver": with_silver("SELECT event_id, event_type, created_at, source_repo FROM silver"),
    "landing_quarantine": f"WITH {_LANDING_CTES}\n" + """SELECT id AS event_id, type, source_repo, reason AS reject_reason
FROM labeled WHERE reason IS NOT NULL
UNION ALL SELECT NULL, NULL, source_repo, 'corrupt_record' FROM broken""",
    "incremental_run_bronze": with_runs("SELECT id, _batch_id, _arrival_seq FROM labels"),
    "incremental_run_silver": with_runs(
        f"SELECT id AS event_id, type AS event_type, _batch_id, COALESCE(created_ts, {RUN_TS}) AS created_at FROM kept"),
    "incremental_rerun_silver": f"WITH {_run_ctes(True)}\n"
        f"SELECT id AS event_id, type AS event_type, _batch_id, COALESCE(created_ts, {RUN_TS}) AS created_at FROM kept",
    "incremental_rerun_quarantine": f"WITH {_run_ctes(True)}\n" + """SELECT id AS event_id, type, _batch_id, _arrival_seq,
  reason AS reject_reason FROM labels WHERE reason IS NOT NULL""",
    "incremental_run_quarantine": with_runs("""SELECT id AS event_id, type, _batch_id, _arrival_seq,
  reason AS reject_reason FROM labels WHERE reason IS NOT NULL"""),
    "incremental_run_quality": with_runs("""SELECT _batch_id, count(*) AS total,
  count(*) FILTER (WHERE reason IS NULL) AS valid, count(*) FILTER (WHERE reason IS NOT NULL) AS filtered,
  count(*) FILTER (WHERE reason IS NOT NULL AND reason NOT IN
                   ('late', 'duplicate', 'type_filtered', 'already_in_silver')) AS invalid,
  count(*) FILTER (WHERE reason = 'late') AS late, count(*) FILTER (WHERE reason = 'duplicate') AS duplicates,
  count(*) FILTER (WHERE reason = 'type_filtered') AS type_filtered,
  count(*) FILTER (WHERE reason = 'already_in_silver') AS already_in_silver FROM labels GROUP BY _batch_id"""),
    "incremental_run_watermarks": with_runs("SELECT source_repo, watermark FROM w3"),
    "global_watermark": with_runs("SELECT max(watermark) AS watermark FROM w3"),
    "layer_latest": with_runs("SELECT id AS event_id, _batch_id FROM s3"),
    "layer_as_of": with_runs("SELECT id AS event_id, _batch_id FROM kept WHERE _batch_id <= '2024-01-20'"),
    "gold_read_latest": with_runs(f""", silver AS ({_silver_from('s3')})
SELECT *, CAST(row_number() OVER (ORDER BY total_events DESC, repo_name ASC) AS INTEGER) AS rank
FROM ({_REPO_METRICS}) m ORDER BY total_events DESC, repo_name ASC LIMIT 10""").replace(
        "\n, silver AS", ",\nsilver AS", 1),
    "gold_latest_repo_metrics": with_runs(f""", silver AS ({_silver_from('s3')})
SELECT *, '2024-01-30' AS _batch_id FROM ({_REPO_METRICS}) m""").replace("\n, silver AS", ",\nsilver AS", 1),
    "gold_history_daily": with_runs("\nUNION ALL ".join(f"""SELECT event_date, count(*) AS event_count,
  count(DISTINCT repo_name) AS active_repos_count, '{b}' AS _batch_id FROM {_run_silver(k)} GROUP BY event_date"""
                                                       for k, b in enumerate(C.testdata.BATCHES, 1))),
    "pipeline_stats": with_runs("""SELECT 'failed' AS status, true AS error_kept,
  TIMESTAMP '2024-02-03 00:01:00' AS last_success, (SELECT max(watermark) FROM w3) AS last_processed,
  4 + (SELECT count(DISTINCT source_repo) FROM s1) + (SELECT count(DISTINCT source_repo) FROM s2)
    + (SELECT count(DISTINCT source_repo) FROM s3) AS control_rows"""),
    "status_summary": with_runs(f"""SELECT true AS data_available, (SELECT count(*) FROM s3) AS total_events,
  {RUN_TS} AS last_update, 'failed' AS last_run_status"""),
    "run_history": with_runs(f", {_RUN_ROWS} SELECT * FROM runs").replace("\n, runs AS", ",\nruns AS", 1),
    "pipeline_health": with_runs(f""", {_RUN_ROWS} SELECT 'events' AS pipeline, count(*) AS n_runs,
  75.0::DOUBLE AS success_rate_pct, 'failed' AS last_run_status, 120.0::DOUBLE AS last_duration_seconds,
  CAST(sum(records_processed) AS BIGINT) AS records_run, 'failed' AS checkpoint_status,
  (SELECT count(*) FROM kept) AS records_committed, (SELECT max(watermark) FROM w3) AS last_watermark
FROM runs""").replace("\n, runs AS", ",\nruns AS", 1),
    "run_metrics_daily": with_runs(f""", {_RUN_ROWS} SELECT CAST(start_time AS DATE) AS run_date, count(*) AS n_runs,
  count(*) FILTER (WHERE status <> 'success') AS n_failed,
  round(100.0 * count(*) FILTER (WHERE status = 'success') / count(*), 1) AS success_rate_pct,
  CAST(sum(records_processed) AS BIGINT) AS records_processed, avg(duration_seconds) AS avg_duration_seconds
FROM runs GROUP BY 1""").replace("\n, runs AS", ",\nruns AS", 1),
    "retention_of_batches": with_runs(f"""SELECT _batch_id, age_days, layer,
  CASE WHEN layer = 'bronze' AND age_days >= 365 THEN 'expire' WHEN layer = 'bronze' AND age_days >= 90 THEN 'archive'
       WHEN layer = 'silver' AND age_days >= 180 THEN 'archive' ELSE 'keep' END AS action, row_count
FROM (SELECT _batch_id, layer, row_count,
        CAST(date_diff('day', CAST(_batch_id AS DATE), DATE '{C.RETENTION_AS_OF[:10]}') AS INTEGER) AS age_days
      FROM (SELECT _batch_id, 'bronze' AS layer, count(*) AS row_count FROM labels GROUP BY 1
            UNION ALL SELECT _batch_id, 'silver', count(*) FROM kept GROUP BY 1) a) b"""),
    "retention_applied": with_runs("""SELECT _batch_id, count(*) AS row_count,
  CASE WHEN _batch_id = '2024-01-10' THEN 'archive' ELSE 'keep' END AS place FROM labels GROUP BY _batch_id"""),
    "daily_series_ordered": with_silver("""SELECT event_date, count(*) AS event_count,
  count(DISTINCT repo_name) AS active_repos_count, CAST(rank() OVER (ORDER BY event_date) AS INTEGER) AS position
FROM silver GROUP BY event_date"""),
    "hourly_series_ordered": with_silver("""SELECT hour_key, event_count,
  CAST(rank() OVER (ORDER BY hour_key) AS INTEGER) AS position FROM (
  SELECT strftime(created_at, '%Y-%m-%dT%H') AS hour_key, count(*) AS event_count FROM silver GROUP BY 1) t"""),
    "event_type_distribution": with_silver("""SELECT event_type, event_count,
  CAST(row_number() OVER (ORDER BY event_count DESC, event_type) AS INTEGER) AS position FROM (
  SELECT event_type, count(*) AS event_count FROM silver GROUP BY event_type) t"""),
    "time_of_day_ordered": with_silver("""SELECT time_of_day, count(*) AS event_count, CAST(row_number() OVER (
  ORDER BY list_position(['morning', 'afternoon', 'evening', 'night'], time_of_day)) AS INTEGER) AS position
FROM silver GROUP BY time_of_day"""),
    "repo_head_15": with_silver("""SELECT *, CAST(row_number() OVER (ORDER BY event_count DESC, repo_name) AS INTEGER) AS rank
FROM (SELECT repo_name, count(event_id) AS event_count, count(DISTINCT actor_login) AS actor_nunique,
        min(created_at) AS first_event, max(created_at) AS last_event FROM silver GROUP BY repo_name) t
ORDER BY event_count DESC, repo_name LIMIT 15"""),
    "contributor_head_10": with_silver("""SELECT a.actor_login, a.event_count, a.repo_nunique,
  (SELECT event_type FROM silver s WHERE s.actor_login = a.actor_login GROUP BY event_type
   ORDER BY count(*) DESC, event_type LIMIT 1) AS modal_event_type, a.rank
FROM (SELECT actor_login, count(event_id) AS event_count, count(DISTINCT repo_name) AS repo_nunique,
        CAST(row_number() OVER (ORDER BY count(event_id) DESC, actor_login) AS INTEGER) AS rank
      FROM silver WHERE actor_login IS NOT NULL GROUP BY actor_login) a WHERE a.rank <= 10"""),
    "shape_types": "SELECT * FROM (VALUES " + ", ".join(
        f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(_FLAT_TYPES)) + ") t(position, column_name, data_type)",
    "silver_not_in_future": f"WITH {BASE_CTES},\nvalid AS (SELECT * FROM req WHERE req_reason IS NULL "
        f"AND NOT COALESCE(created_ts > {RUN_TS}, false)),\nsurv AS ({_first_wins('valid')})\n"
        "SELECT id AS event_id, type AS event_type, _arrival_seq FROM surv",
    "dedup_content_no_id": with_silver(f"""SELECT event_id, event_type, _arrival_seq, _content_hash_no_id AS _content_hash
FROM (SELECT *, row_number() OVER (PARTITION BY _content_hash_no_id ORDER BY _arrival_seq) AS rn
      FROM ({_silver_from('valid')}) a) b WHERE rn = 1"""),
}

# -- queries over the runs that reuse the statements above -------------------------

_EPOCHS = {b: f"e{k:010d}" for k, b in enumerate(C.testdata.BATCHES)}


def _body(name: str) -> str:
    """The statement of a query over ``silver``, without its CTEs."""
    return SQL[name][len(f"WITH {SILVER_CTES}\n"):]


def _over(rows: str, select: str, ctes: str = _RUN_CTES) -> str:
    return f"WITH {ctes},\nsilver AS ({_silver_from(rows)})\n{select}"


# Gold table: its columns that are texts or dates in JSON, in the document's order.
_QUOTED = ("event_type", "event_date", "repo_name", "actor_login", "hour_key")
SQL["metrics_document_lines"] = _document() + "".join(
    "\nUNION ALL SELECT '" + section + "', "
    + (" || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in key) if isinstance(key, tuple)
       else f"CAST({key} AS VARCHAR)" if key else "'all'") + ", '{' || "
    + " || ',' || ".join(f"""'"{c}":' || """ + (f"""'"' || CAST({c} AS VARCHAR) || '"'""" if c in _QUOTED
                                               else f"CAST({c} AS VARCHAR)") for c in values)
    + f" || '}}' FROM ({_body(table)}) t_{section}"
    for section, table, key, values in C.export.SECTIONS[7:])

SQL |= {f"gold_alltime_{t}": _over("kept", _body(t)) for t in C.ALLTIME}
SQL |= {f"gold_alltime_rerun_{t}": _over("kept", _body(t), _run_ctes(True)) for t in C.ALLTIME_RERUN}
SQL["gold_csv_repo_metrics"] = SQL["gold_latest_repo_metrics"]
SQL["stream_layers_silver"] = SQL["incremental_run_silver"].replace("_batch_id, COALESCE", "CASE _batch_id " + " ".join(
    f"WHEN '{b}' THEN '{e}'" for b, e in _EPOCHS.items()) + " END AS _batch_id, COALESCE")
SQL["stream_layers_gold"] = SQL["gold_latest_repo_metrics"].replace(
    "'2024-01-30' AS _batch_id FROM", f"'{_EPOCHS['2024-01-30']}' AS _batch_id FROM")
SQL["stream_layers_control"] = with_runs("\nUNION ALL ".join(
    f"SELECT '{e}' AS _batch_id, 'success' AS status, (SELECT count(*) FROM s{k}) AS records_processed"
    for k, e in enumerate(_EPOCHS.values(), 1)) + f"""
UNION ALL SELECT 'e{C.STOPPED_EPOCH:010d}', 'failed', 0""")
SQL["stream_daily_sketches"] = SQL["stream_daily_distinct_repos"].replace(
    "AS active_repos_count FROM", "AS active_repos_count, true AS within_bound FROM")
SQL["layers_bundle"] = _over("s3", """SELECT 'events' AS table_name, (SELECT count(*) FROM kept) AS n_rows
UNION ALL SELECT 'quarantine', count(*) FROM labels WHERE reason IS NOT NULL
UNION ALL SELECT 'quality', 3 UNION ALL SELECT 'run_history', 4
UNION ALL SELECT 'control', 4 + (SELECT count(DISTINCT source_repo) FROM s1)
  + (SELECT count(DISTINCT source_repo) FROM s2) + (SELECT count(DISTINCT source_repo) FROM s3)
UNION ALL SELECT 'gold_summary', 1""" + "".join(
    f"\nUNION ALL SELECT 'gold_{t}', count(*) FROM ({_body(t)}) t_{t}" for t in (
        "event_type_counts", "type_by_date", "repo_metrics", "repo_top_types", "contributor_metrics",
        "contributor_repos", "contributor_top_types", "daily_series", "daily_top_types", "hourly_series",
        "hourly_types", "activity_totals", "activity_category", "time_of_day", "push_metrics", "pr_metrics",
        "pr_actions", "top_repos", "top_contributors")))

SQL["silver_lineage"] = with_silver(f"""SELECT event_id, 'testdata_events' AS _source, 'events' AS _file, {RUN_TS} AS ingestion_timestamp,
  {RUN_TS} AS transformation_timestamp FROM silver""")
SQL["dedup_identical"] = "SELECT DISTINCT * EXCLUDE (_arrival_seq) FROM (" + SQL["bronze_rows"] + ") b"


def _kind(column: str) -> str:
    cases = " ".join(f"WHEN regexp_full_match({column}, '{p}') THEN '{k}'" for k, p in C.profile.KIND_PATTERNS)
    return f"CASE WHEN {column} IS NULL THEN 'null' WHEN {column} = '' THEN 'empty' {cases} ELSE 'text' END"


SQL["bronze_value_kinds"] = f"WITH {BASE_CTES}\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{'bigint' if c.endswith('_id') else 'string'}' AS data_type, "
    + (f"CASE WHEN {c} IS NULL THEN 'null' ELSE 'value' END" if c.endswith("_id") else _kind(c))
    + " AS kind, count(*) AS n FROM bronze GROUP BY 3" for c in C.KIND_COLUMNS)

SQL["stream_error_alerts"] = SQL["error_alerts"]
_FIRST, *_KEPT = C.testdata.BATCHES
SQL["retention_run"] = with_runs(f""",
n AS (SELECT _batch_id, count(*) AS bronze, count(*) FILTER (WHERE reason IS NULL) AS silver FROM labels GROUP BY 1),
at_first AS (SELECT unnest(['stopped', 'finished']) AS stage)
SELECT stage, 'bronze' AS place, _batch_id, bronze AS row_count FROM n, at_first WHERE _batch_id <> '{_FIRST}'
UNION ALL SELECT stage, 'silver', _batch_id, silver FROM n, at_first
UNION ALL SELECT stage, 'bronze_archive', _batch_id, bronze FROM n, at_first WHERE _batch_id = '{_FIRST}'
UNION ALL SELECT stage, 'bronze_files', _batch_id, bronze FROM n, at_first WHERE stage = 'stopped' OR _batch_id <> '{_FIRST}'
UNION ALL SELECT 'later', 'bronze_archive', _batch_id, bronze FROM n WHERE _batch_id <> '{_FIRST}'
UNION ALL SELECT 'later', 'silver_archive', _batch_id, silver FROM n""").replace("\n,\nn AS", ",\nn AS", 1)
