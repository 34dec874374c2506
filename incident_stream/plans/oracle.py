"""The registered queries in DuckDB's SQL, over the given tables and not over record lines."""

from __future__ import annotations

CODES = """
codes AS (
  SELECT regexp_replace(lpad(CAST(n_nationkey AS VARCHAR), 4, '0'), '^0+', '') AS IUCR,
         n_name AS category,
         CASE WHEN n_regionkey IN (0, 1) THEN 'I' ELSE 'N' END AS index_code
  FROM nation
)"""

CODES_TWICE = """
codes AS (
  SELECT regexp_replace(lpad(CAST(n_nationkey AS VARCHAR), 4, '0'), '^0+', '') AS IUCR,
         n_name AS category,
         CASE WHEN n_regionkey IN (0, 1) THEN 'I' ELSE 'N' END AS index_code
  FROM nation
  UNION ALL
  SELECT regexp_replace(CAST(n_nationkey AS VARCHAR), '^0+', ''), n_name,
         CASE WHEN n_regionkey IN (0, 1) THEN 'I' ELSE 'N' END
  FROM nation WHERE n_nationkey % 5 = 0
)"""

EVENTS = """
records AS (
  SELECT CAST(event_id AS VARCHAR) AS ID,
         regexp_replace(lpad(CAST(event_id % 30 AS VARCHAR), 4, '0'), '^0+', '') AS IUCR,
         CASE WHEN event_type = 'purchase' THEN 'True' ELSE 'False' END AS Arrest,
         CASE WHEN event_type = 'error' THEN 'True' ELSE 'False' END AS Domestic,
         CASE WHEN user_id % 25 <> 0 THEN CAST(user_id % 25 AS DOUBLE) END AS District,
         CAST(date_trunc('second', ts) AS TIMESTAMP) AS event_time
  FROM events
)"""

ORDERS = """
records AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS ID,
         regexp_replace(lpad(CAST(o_orderkey % 30 AS VARCHAR), 4, '0'), '^0+', '') AS IUCR,
         CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END AS Arrest,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'True' ELSE 'False' END AS Domestic,
         CASE WHEN o_custkey % 25 <> 0 THEN CAST(o_custkey % 25 AS DOUBLE) END AS District,
         CAST(date_trunc('second', o_orderdate) AS TIMESTAMP) AS event_time
  FROM orders
)"""

UNDATED = """
records AS (
  SELECT CAST(event_id AS VARCHAR) AS ID,
         regexp_replace(lpad(CAST(event_id % 30 AS VARCHAR), 4, '0'), '^0+', '') AS IUCR,
         CASE WHEN event_type = 'purchase' THEN 'True' ELSE 'False' END AS Arrest,
         CASE WHEN event_type = 'error' THEN 'True' ELSE 'False' END AS Domestic,
         CASE WHEN user_id % 25 <> 0 THEN CAST(user_id % 25 AS DOUBLE) END AS District,
         CASE WHEN event_id % 10 <> 0 THEN CAST(date_trunc('second', ts) AS TIMESTAMP) END
           AS event_time
  FROM events
)"""

DIRTY = """
kinds AS (
  SELECT *, event_id % 10 AS kind, event_id % 20 = 9 AS blank,
         lpad(CAST(event_id % 30 AS VARCHAR), 4, '0') AS raw
  FROM events
),
records AS (
  SELECT CASE WHEN NOT blank THEN CAST(event_id AS VARCHAR) END AS ID,
         CASE WHEN blank THEN NULL WHEN kind = 3 THEN ' ' || raw || ' ' WHEN kind = 4 THEN ',1'
              ELSE regexp_replace(raw, '^0+', '') END AS IUCR,
         CASE WHEN blank OR kind = 8 THEN NULL
              WHEN kind = 5 AND event_type = 'purchase' THEN 'true'
              WHEN kind = 5 THEN 'false'
              WHEN event_type = 'purchase' THEN 'True' ELSE 'False' END AS Arrest,
         CASE WHEN blank OR kind = 8 THEN NULL
              WHEN event_type = 'error' THEN 'True' ELSE 'False' END AS Domestic,
         CASE WHEN blank OR kind IN (1, 8) THEN NULL WHEN kind = 2 THEN 7.0::DOUBLE
              WHEN user_id % 25 <> 0 THEN CAST(user_id % 25 AS DOUBLE) END AS District,
         CASE WHEN blank THEN NULL
              WHEN kind = 7 THEN CAST(date_trunc('day', ts) AS TIMESTAMP)
              ELSE CAST(date_trunc('second', ts) AS TIMESTAMP) END AS event_time
  FROM kinds
)"""

ENRICHED = """
enriched AS (
  SELECT r.IUCR, ID, Arrest, Domestic, coalesce(District, -1.0::DOUBLE) AS District, event_time,
         coalesce(strftime(event_time, '%Y-%m'), 'UNKNOWN_MONTH') AS year_month,
         coalesce(category, 'UNKNOWN') AS category, index_code
  FROM records r LEFT JOIN codes c ON r.IUCR = c.IUCR
)"""

COUNTS = """count(*) AS total_crimes,
         count(*) FILTER (Arrest = 'True') AS arrests,
         count(*) FILTER (Domestic = 'True') AS domestics,
         count(*) FILTER (index_code = 'I') AS fbi_indexed"""

MONTHLY = f"""
monthly AS (
  SELECT year_month, category, District, {COUNTS}
  FROM enriched GROUP BY year_month, category, District
)"""

WINDOW30 = f"""
window30 AS (
  SELECT span AS window_start, strftime(span, '%Y-%m') AS year_month, category, District, {COUNTS}
  FROM (
    SELECT *, time_bucket(INTERVAL 30 DAYS, event_time, TIMESTAMP '1970-01-01') AS span
    FROM enriched WHERE event_time IS NOT NULL
  )
  GROUP BY span, category, District
)"""


def _anomalies(days: int, percent: float) -> str:
    return f"""
placed AS (
  SELECT time_bucket(INTERVAL 1 DAY, event_time, TIMESTAMP '1970-01-01')
           - to_days(CAST(back AS INTEGER)) AS window_start, District, index_code
  FROM enriched, range({days}) AS shift(back)
  WHERE event_time IS NOT NULL
),
counted AS (
  SELECT window_start, window_start + INTERVAL {days} DAYS AS window_end, District,
         count(*) FILTER (index_code = 'I') AS fbi_indexed, count(*) AS total_crimes
  FROM placed GROUP BY window_start, District
),
anomalies AS (
  SELECT window_start, window_end, District, fbi_indexed, total_crimes,
         round(fbi_indexed / total_crimes * 100.0::DOUBLE, 2) AS pct_fbi
  FROM counted WHERE fbi_indexed / total_crimes * 100.0::DOUBLE >= {percent}
)"""


def _with(*parts: str, final: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + final


PARSED = """SELECT ID, IUCR, Arrest, Domestic, District, event_time,
  strftime(event_time, '%Y-%m') AS year_month FROM records"""

STORED_MONTHLY = """SELECT year_month, category, CAST(District AS INTEGER) AS district,
  total_crimes, arrests, domestics, fbi_indexed FROM monthly"""

WINDOW30_ROWS = """SELECT year_month, category, District, total_crimes, arrests, domestics,
  fbi_indexed FROM window30"""


def _closed(days: int) -> str:
    return f"window_end <= (SELECT max(event_time) FROM records) - INTERVAL {days} DAYS"


def _stored_anomalies(days: int) -> str:
    return f"""SELECT window_start, window_end, CAST(District AS INTEGER) AS district, fbi_indexed,
  total_crimes, pct_fbi FROM anomalies WHERE {_closed(days)}"""


def _monthly(*records: str) -> str:
    return _with(*records, ENRICHED, MONTHLY, final="SELECT * FROM monthly")


def _window30(records: str) -> str:
    return _with(CODES, records, ENRICHED, WINDOW30, final=WINDOW30_ROWS)


def _flagged(records: str, days: int = 7, percent: float = 40.0) -> str:
    found = _anomalies(days, percent)
    return _with(CODES, records, ENRICHED, found, final="SELECT * FROM anomalies")


CARRIED = """
carried AS (SELECT IUCR, count(*) AS records FROM records GROUP BY IUCR)"""

LATE_AGAIN = """
late AS (
  SELECT * FROM records
  UNION ALL
  SELECT * FROM records
  WHERE event_time < (SELECT date_trunc('day', min(event_time)) + INTERVAL 1 DAY FROM records)
)"""

UPSERTED = _with(
    CODES,
    ORDERS,
    ENRICHED,
    MONTHLY,
    final="""SELECT year_month, category, CAST(District AS INTEGER) AS district,
      CASE WHEN arrests > 0 THEN arrests ELSE total_crimes END AS total_crimes, arrests,
      CASE WHEN arrests > 0 THEN both_flags ELSE domestics END AS domestics,
      CASE WHEN arrests > 0 THEN both_indexed ELSE fbi_indexed END AS fbi_indexed
      FROM monthly JOIN (
        SELECT year_month, category, District,
          count(*) FILTER (Arrest = 'True' AND Domestic = 'True') AS both_flags,
          count(*) FILTER (Arrest = 'True' AND index_code = 'I') AS both_indexed
        FROM enriched GROUP BY ALL
      ) USING (year_month, category, District)""",
)

SQL: dict[str, str] = {
    "code_table": _with(
        CODES,
        EVENTS,
        CARRIED,
        final="""SELECT IUCR, category, index_code, records
          FROM codes LEFT JOIN carried USING (IUCR)""",
    ),
    "normalized_codes": """
        SELECT raw_code, regexp_replace(raw_code, '^0+', '') AS code, count(*) AS n
        FROM (SELECT lpad(CAST(event_id % 30 AS VARCHAR), 4, '0') AS raw_code FROM events)
        GROUP BY raw_code""",
    "duplicated_codes": _with(
        CODES_TWICE,
        EVENTS,
        CARRIED,
        final="""SELECT IUCR, copies, records FROM (
            SELECT IUCR, count(*) AS copies FROM codes GROUP BY IUCR HAVING count(*) > 1
          ) LEFT JOIN carried USING (IUCR)""",
    ),
    "parsed_records": _with(EVENTS, final=PARSED),
    "parsed_dirty_records": _with(DIRTY, final=PARSED),
    "enriched_records": _with(CODES, EVENTS, ENRICHED, final="SELECT * FROM enriched"),
    "enriched_records_orders": _with(CODES, ORDERS, ENRICHED, final="SELECT * FROM enriched"),
    "enriched_dirty_records": _with(CODES, DIRTY, ENRICHED, final="SELECT * FROM enriched"),
    "enriched_by_shuffle": _with(CODES, EVENTS, ENRICHED, final="SELECT * FROM enriched"),
    "monthly_aggregates_events": _monthly(CODES, EVENTS),
    "monthly_aggregates_orders": _monthly(CODES, ORDERS),
    "monthly_aggregates_dirty": _monthly(CODES, DIRTY),
    "monthly_with_duplicate_codes": _monthly(CODES_TWICE, EVENTS),
    "window30_aggregates_events": _window30(EVENTS),
    "window30_aggregates_orders": _window30(ORDERS),
    "anomalies_7d_40_events": _flagged(EVENTS),
    "anomalies_7d_40_orders": _flagged(ORDERS),
    "anomalies_1d_40": _flagged(EVENTS, days=1),
    "anomalies_1d_40_orders": _flagged(ORDERS, days=1),
    "anomalies_7d_0": _flagged(EVENTS, percent=0),
    "anomalies_7d_0_orders": _flagged(ORDERS, percent=0),
    "anomalies_30d_33": _flagged(ORDERS, days=30, percent=33.0),
    "anomalies_dirty": _flagged(DIRTY, days=2, percent=30.0),
    "null_event_time": _flagged(UNDATED, percent=0),
    "null_event_time_monthly": _monthly(CODES, UNDATED),
    "null_event_time_window30": _window30(UNDATED),
    "stream_anomalies_closed": _with(
        CODES, EVENTS, ENRICHED, _anomalies(7, 40.0), final=_stored_anomalies(7)
    ),
    "stream_anomalies_all_closed": _with(
        CODES, EVENTS, ENRICHED, _anomalies(7, 0), final=_stored_anomalies(7)
    ),
    "stream_late_dropped": _with(
        CODES, EVENTS, ENRICHED, _anomalies(7, 0), final=_stored_anomalies(7)
    ),
    "stream_window30_closed": _with(
        CODES,
        EVENTS,
        ENRICHED,
        WINDOW30,
        final="""SELECT year_month, category, CAST(District AS INTEGER) AS district, total_crimes,
          arrests, domestics, fbi_indexed, window_start FROM window30
          WHERE window_start + INTERVAL 30 DAYS
            <= (SELECT max(event_time) FROM records) - INTERVAL 1 DAY""",
    ),
    "stream_monthly_upsert": _with(CODES, EVENTS, ENRICHED, MONTHLY, final=STORED_MONTHLY),
    "stream_monthly_late_counted": _with(
        CODES,
        EVENTS,
        LATE_AGAIN,
        ENRICHED.replace("records r", "late r"),
        MONTHLY,
        final=STORED_MONTHLY,
    ),
    "stream_two_queries": _with(
        CODES,
        EVENTS,
        ENRICHED,
        MONTHLY,
        _anomalies(3, 30.0),
        final=f"""SELECT 'aggregates' AS result, year_month AS period, category,
            CAST(District AS INTEGER) AS district, total_crimes, fbi_indexed FROM monthly
          UNION ALL
          SELECT 'anomalies', strftime(window_start, '%Y-%m-%d'), 'ALL', CAST(District AS INTEGER),
            total_crimes, fbi_indexed FROM anomalies WHERE {_closed(3)}""",
    ),
    "publish_roundtrip": _with(EVENTS, final=PARSED),
    "publish_beside_folders": _with(EVENTS, final=PARSED),
    "publish_resumed": _with(EVENTS, final=PARSED),
    "stream_anomalies_30d": _with(
        CODES, EVENTS, ENRICHED, _anomalies(30, 0), final=_stored_anomalies(30)
    ),
    "stream_anomalies_two_settings": _with(
        CODES, EVENTS, ENRICHED, _anomalies(3, 60.0), final=_stored_anomalies(3)
    ),
    "stream_rejected_rows": _with(
        EVENTS,
        final="""SELECT CASE WHEN half THEN 'rejected' ELSE 'stored' END AS place,
            CASE WHEN half THEN CAST(ID AS BIGINT) % 25 + 0.5::DOUBLE
              ELSE coalesce(District, -1.0) END AS district,
            count(*) AS records
          FROM (SELECT *, CAST(ID AS BIGINT) % 50 = 0 AS half FROM records) GROUP BY ALL""",
    ),
    "results_readback": _with(CODES, EVENTS, ENRICHED, MONTHLY, final=STORED_MONTHLY),
    "results_readback_recreated": _monthly(CODES, EVENTS),
    "results_readback_upserted": UPSERTED,
    "results_readback_folded": UPSERTED,
    "results_read_while_folding": UPSERTED,
}

# The same counts, kept without state.
SQL["stream_monthly_added"] = SQL["stream_monthly_upsert"]
SQL["stream_monthly_late_added"] = SQL["stream_monthly_late_counted"]

