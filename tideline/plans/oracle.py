"""DuckDB oracles: the expected answers computed straight from ``events``.

The oracle shares no code with the Spark side: it restates the fixture
rules (FIXTURES.md section 3) in SQL and applies the documented semantics
(attributes win, inclusive bounds, first-match reasons) without decoding
anything.
"""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"
MIN_T = "TIMESTAMP '2024-01-05 00:00:00'"
MAX_T = "TIMESTAMP '2024-01-25 00:00:00'"

FX = f"""fx AS (
  SELECT event_id AS e, ts, user_id, event_type, value, props,
         concat('m', event_id) AS messageId,
         strftime(ts + to_seconds(event_id % 7), {ISO}) AS publishTime,
         CASE WHEN event_id % 13 <> 0 THEN concat('o', event_id % 5) END AS origin,
         CASE WHEN event_id % 13 = 0 AND event_id % 4 = 0 THEN 'raw' ELSE event_type END AS m_event_type,
         CASE WHEN event_id % 4 = 0 THEN 'raw' ELSE event_type END AS p_event_type,
         CASE WHEN event_id % 97 = 0 THEN 'bad_json' WHEN event_id % 101 = 0 THEN 'not_object'
              WHEN event_id % 89 = 0 THEN 'no_event_time' WHEN event_id % 83 = 0 THEN 'bad_event_time' END AS bad,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         concat('"event_id":', event_id, ',"user_id":', user_id, ',"event_type":"',
                CASE WHEN event_id % 4 = 0 THEN 'raw' ELSE event_type END,
                '","value":', CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), ',"props":', props, '}}') AS body
  FROM events)"""

TXT = f"""txt AS (
  SELECT *, CASE WHEN e % 97 = 0 THEN substr(full_text, 1, length(full_text) // 2)
                 WHEN e % 101 = 0 THEN '[1,2]'
                 WHEN e % 89 = 0 THEN concat('{{', body)
                 WHEN e % 83 = 0 THEN concat('{{"ts":"not a time",', body)
                 ELSE full_text END AS data
  FROM (SELECT *, concat('{{"ts":"', strftime(ts, {ISO}), '",', body) AS full_text FROM fx))"""

ENV = """env AS (
  SELECT *, concat('a', e, '-', delivery) AS ackId FROM (
    SELECT *, 0 AS delivery FROM txt UNION ALL SELECT *, 1 AS delivery FROM txt WHERE e % 10 = 0))"""


def thrown_case(conds: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r in conds) + " END"


DEFAULT_BOUNDS = [(f"ts < {MIN_T}", "before_minimum_time"), (f"ts > {MAX_T}", "after_maximum_time")]


def cls(conds=None) -> str:
    """Deduplicated messages with disposition and reason under time conditions."""
    conds = DEFAULT_BOUNDS if conds is None else conds
    thrown = thrown_case(conds) if conds else "CAST(NULL AS VARCHAR)"
    return f"""cls AS (
  SELECT *, CASE WHEN bad IS NOT NULL THEN 'unparseable' WHEN ({thrown}) IS NOT NULL THEN 'thrown_away'
                 ELSE 'processed' END AS disposition,
            COALESCE(bad, {thrown}) AS reason,
            CASE WHEN bad IS NULL THEN ts END AS tts
  FROM txt)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = with_ctes(FX, TXT)
BASE_ENV = with_ctes(FX, TXT, ENV)
BASE_CLS = with_ctes(FX, TXT, cls())


def base_cls(conds) -> str:
    return with_ctes(FX, TXT, cls(conds))


# Batch messages: rows of events e with e // 3 = g; g % 7 = 0 adds a null row.
BATCH = f"""{with_ctes(FX)}, ev AS (
  SELECT concat('b', e // 3) AS messageId, CAST(e % 3 AS INTEGER) AS pos, e AS event_id, ts, user_id,
         event_type, concat('o', (e // 3) % 5) AS origin, value, 'processed' AS disposition,
         CAST(NULL AS VARCHAR) AS reason
  FROM fx),
nulls AS (
  SELECT concat('b', e // 3) AS messageId, CAST(count(*) AS INTEGER) AS pos, CAST(NULL AS BIGINT) AS event_id,
         CAST(NULL AS TIMESTAMP) AS ts, CAST(NULL AS BIGINT) AS user_id, CAST(NULL AS VARCHAR) AS event_type,
         CAST(NULL AS VARCHAR) AS origin, CAST(NULL AS DOUBLE) AS value, 'thrown_away' AS disposition,
         'null_row' AS reason
  FROM fx GROUP BY e // 3 HAVING (e // 3) % 7 = 0),
brows AS (SELECT * FROM ev UNION ALL SELECT * FROM nulls)
"""

PROCESSED = "disposition = 'processed'"
