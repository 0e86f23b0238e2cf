"""The same queries as SQL for another engine (DuckDB) on the same tables.

Written from the definitions, not from the operators: facts are always the full
left join, latest rows come from a max-date join or a row number over all rows,
and running totals from one plain window.
"""

from __future__ import annotations

from dayfold.plans.registry import ABSENT_KEY, FIRST_KEYS, KEY, PANEL_DAYS

DIM = """
people AS (
  SELECT c_nationkey, CAST(10000 * count(*) AS BIGINT) AS Population
  FROM customer GROUP BY c_nationkey
),
dim AS (
  SELECT n_nationkey AS ordinal, n_name AS Country,
         'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS ISO_Alpha,
         CAST(n_nationkey AS DOUBLE) * 5 - 60 AS Latitude,
         CAST(n_nationkey AS DOUBLE) * 14 - 170 AS Longitude,
         coalesce(Population, 0) AS Population
  FROM nation LEFT JOIN people ON c_nationkey = n_nationkey
)"""

FACT = (
    "WITH"
    + DIM
    + """,
base AS (
  SELECT CAST(l_shipdate AS DATE) AS Date, dim.*,
         CAST(l_quantity AS INTEGER) AS Confirmed,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS Deaths,
         CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS Recoveries,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey
  LEFT JOIN dim ON dim.ordinal = s_nationkey
),
fact AS (
  SELECT *, (Confirmed - Recoveries) / greatest(CAST(1 AS DOUBLE), Population / CAST(100000 AS DOUBLE))
         AS Active_Per_100k
  FROM base
)"""
)

LAST = """,
last_row AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY Country
      ORDER BY Date DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn
    FROM fact WHERE Country IS NOT NULL) WHERE rn = 1
)"""

SNAPSHOT = """,
snap AS (
  SELECT Country, ISO_Alpha, Latitude, Longitude,
         CAST(sum(Confirmed) AS BIGINT) AS confirmed, CAST(sum(Deaths) AS BIGINT) AS deaths,
         CAST(sum(Recoveries) AS BIGINT) AS recoveries, avg(Active_Per_100k) AS active_per_100k
  FROM fact JOIN (SELECT Country AS k, max(Date) AS d FROM fact GROUP BY 1) ON k = Country AND d = Date
  GROUP BY 1, 2, 3, 4
)"""

DAILY = """,
daily AS (
  SELECT Date, CAST(sum(Confirmed) AS BIGINT) AS daily_confirmed,
         CAST(sum(Deaths) AS BIGINT) AS daily_deaths,
         CAST(sum(Recoveries) AS BIGINT) AS daily_recoveries
  FROM fact GROUP BY Date
)"""

MONTHLY = """,
monthly AS (
  SELECT Country, strftime(Date, '%Y-%m') AS month,
         CAST(sum(Confirmed) AS BIGINT) AS monthly_confirmed
  FROM fact GROUP BY 1, 2
)"""

TIMELINES = """,
timeline AS (
  SELECT Country, Date, daily_confirmed,
         CAST(sum(daily_confirmed) OVER (
           PARTITION BY Country ORDER BY Date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative
  FROM (SELECT Country, Date, CAST(sum(Confirmed) AS BIGINT) AS daily_confirmed
        FROM fact GROUP BY 1, 2)
)"""

SITES = (
    "WITH"
    + DIM
    + f""",
span AS (SELECT max(CAST(l_shipdate AS DATE)) AS as_of FROM lineitem),
days AS (SELECT CAST(range AS INTEGER) AS day_index FROM range({PANEL_DAYS})),
panel AS (
  SELECT s_suppkey AS ordinal, s_name AS Site, ISO_Alpha, Latitude, Longitude, Population,
         day_index, CAST(as_of - ({PANEL_DAYS} - 1) + day_index AS DATE) AS Date
  FROM supplier JOIN dim ON dim.ordinal = s_nationkey CROSS JOIN days CROSS JOIN span
)"""
)


def _summary(where_from: str, active: str, recoveries: str = "Recoveries") -> str:
    return f"""
  SELECT c AS total_confirmed, d AS total_deaths, r AS total_recoveries, a AS total_active,
         round(CASE WHEN c <> 0 THEN CAST(r AS DOUBLE) / c ELSE 0 END, 6) AS recovery_rate,
         round(CASE WHEN c <> 0 THEN CAST(a AS DOUBLE) / c ELSE 0 END, 6) AS active_rate
  FROM (SELECT CAST(sum(Confirmed) AS BIGINT) AS c, CAST(sum(Deaths) AS BIGINT) AS d,
               CAST(sum({recoveries}) AS BIGINT) AS r, CAST(sum({active}) AS BIGINT) AS a
        FROM {where_from})"""


def _human(x: str) -> str:
    x = f"CAST({x} AS DOUBLE)"
    return f"""CASE
    WHEN abs({x}) < 1000 THEN format('{{:.1f}}', {x})
    WHEN abs({x} / 1000) < 1000 THEN format('{{:.1f}}K', {x} / 1000)
    WHEN abs({x} / 1000 / 1000) < 1000 THEN format('{{:.1f}}M', {x} / 1000 / 1000)
    WHEN abs({x} / 1000 / 1000 / 1000) < 1000 THEN format('{{:.1f}}B', {x} / 1000 / 1000 / 1000)
    ELSE format('{{:.1f}}T', {x} / 1000 / 1000 / 1000 / 1000) END"""


def _headline(source: str) -> str:
    return f"""
SELECT CASE WHEN a > 0.12 THEN 'HIGH' WHEN a > 0.05 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
       {_human("c")} AS global_cases, {_human("d")} AS deaths, {_human("r")} AS recovered
FROM (SELECT sum(Confirmed) AS c, sum(Deaths) AS d, sum(Recoveries) AS r,
             CAST(sum(Confirmed - Recoveries) AS DOUBLE) / sum(Confirmed) AS a FROM {source})"""


def _map(source: str) -> str:
    return f"""
SELECT Country AS name, Latitude AS lat, Longitude AS lon, confirmed AS size,
       round(active_per_100k, 6) AS color,
       format('{{:.2f}}', Latitude) AS lat_label, format('{{:.2f}}', Longitude) AS lon_label,
       format('{{:,}}', confirmed) AS size_label, format('{{:.1f}}', active_per_100k) AS color_label
FROM {source}"""


_TREND = (
    FACT
    + DAILY
    + """
SELECT *, CAST(sum(daily_confirmed) OVER (ORDER BY Date ROWS UNBOUNDED PRECEDING) AS BIGINT)
       AS cumulative_confirmed FROM daily ORDER BY Date"""
)

_SNAPSHOT = (
    FACT
    + SNAPSHOT
    + """
SELECT Country, ISO_Alpha, Latitude, Longitude, confirmed, deaths, recoveries,
       round(active_per_100k, 6) AS active_per_100k
FROM snap ORDER BY confirmed DESC, Country"""
)

_FACT_COLUMNS = (
    "Date, Country, ISO_Alpha, Latitude, Longitude, Confirmed, Deaths, Recoveries, Active_Per_100k"
)

_DELTA = (
    FACT
    + DAILY
    + """
SELECT Date, daily_confirmed,
       daily_confirmed - lag(daily_confirmed) OVER (ORDER BY Date) AS delta_confirmed
FROM daily ORDER BY Date"""
)

_EXTENT = "count(*) AS fact_rows, min(Date) AS first_date, max(Date) AS latest_date"

ORACLE: dict[str, str] = {
    "fact_rows": FACT + f" SELECT {_FACT_COLUMNS} FROM fact",
    "dim_dedup": """
SELECT min(c_custkey) AS ordinal, c_nationkey, arg_max(c_name, c_custkey) AS c_name,
       arg_max(c_acctbal, c_custkey) AS c_acctbal, arg_max(c_mktsegment, c_custkey) AS c_mktsegment
FROM customer GROUP BY c_nationkey""",
    "first_n_keys": FACT
    + f"""
SELECT Date, Country, Confirmed, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM fact
WHERE Country IN (SELECT n_name FROM nation ORDER BY n_nationkey LIMIT {FIRST_KEYS})""",
    "calendar_panel": SITES
    + " SELECT Date, day_index, Site, ISO_Alpha, Latitude, Longitude FROM panel",
    "truncated_margins": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       greatest(0, CAST(trunc(l_extendedprice * l_discount - CAST(40 AS DOUBLE) * l_quantity) AS BIGINT))
       AS margin
FROM lineitem""",
    "per_capita_rate": FACT
    + """
SELECT Date, Country, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       Confirmed - Recoveries AS active, Active_Per_100k AS rate,
       format('{:.1f}', Active_Per_100k) AS rate_label FROM fact""",
    "global_summary_all": FACT + _summary("fact", "Confirmed - Recoveries"),
    "global_summary_latest": FACT + LAST + _summary("last_row", "Confirmed - Recoveries"),
    "global_summary_optional_cols": FACT
    + LAST
    + f"""
SELECT 'no_recoveries' AS variant, * FROM ({_summary("last_row", "Confirmed", "0")})
UNION ALL
SELECT 'active_given' AS variant, * FROM ({_summary("last_row", "Confirmed - Deaths")})""",
    "daily_totals": FACT + DAILY + " SELECT * FROM daily ORDER BY Date",
    "latest_date_by_key": FACT + " SELECT Country, max(Date) AS latest_date FROM fact WHERE Country IS NOT NULL GROUP BY 1",
    "stored_latest_dates": FACT
    + f" SELECT Country, {_EXTENT} FROM fact WHERE Country IS NOT NULL GROUP BY Country",
    "stored_extent": FACT
    + f" SELECT {_EXTENT}, count(*) = 0 AS is_empty FROM fact WHERE Country IS NOT NULL",
    "monthly_totals": FACT + MONTHLY + " SELECT * FROM monthly ORDER BY Country, month",
    "key_list": FACT + " SELECT DISTINCT Country FROM fact WHERE Country IS NOT NULL ORDER BY Country",
    "latest_rows": FACT
    + f"""
SELECT {_FACT_COLUMNS}, l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM fact JOIN (SELECT Country AS k, max(Date) AS d FROM fact GROUP BY 1) ON k = Country AND d = Date""",
    "region_snapshot": _SNAPSHOT,
    "region_snapshot_rollup": _SNAPSHOT,
    "stored_snapshot": _SNAPSHOT,
    "region_snapshot_one_row": FACT
    + LAST
    + """
SELECT Country, ISO_Alpha, Latitude, Longitude, Confirmed AS confirmed,
       Active_Per_100k AS active_per_100k FROM last_row ORDER BY Country""",
    "global_trend": _TREND,
    "global_trend_two_pass": _TREND,
    "global_trend_in_ranges": _TREND,
    "key_timeline": FACT
    + TIMELINES
    + f" SELECT * FROM timeline WHERE Country = '{KEY}' ORDER BY Date",
    "all_key_timelines": FACT + TIMELINES + " SELECT * FROM timeline ORDER BY Country, Date",
    "timeline_labels": FACT
    + TIMELINES
    + f"""
SELECT Country, Date, {_human("cumulative")} AS short,
       {_human("cumulative * CAST(1000000 AS DOUBLE)")} AS short_scaled,
       format('{{:,}}', cumulative) AS long FROM timeline""",
    "monthly_growth": FACT
    + MONTHLY
    + """
SELECT Country, month, monthly_confirmed, previous_confirmed,
       round(CASE WHEN previous_confirmed <> 0 THEN
         (monthly_confirmed - previous_confirmed) * CAST(100 AS DOUBLE) / previous_confirmed END, 6)
       AS growth_pct
FROM (SELECT *, lag(monthly_confirmed) OVER (PARTITION BY Country ORDER BY month)
             AS previous_confirmed FROM monthly)
ORDER BY Country, month""",
    "daily_delta": _DELTA,
    "daily_delta_in_ranges": _DELTA,
    "headline_kpis": FACT + _headline("fact"),
    "headline_kpis_latest": FACT + LAST + _headline("last_row"),
    "map_points": FACT + SNAPSHOT + _map("snap"),
    "map_points_one_row": FACT
    + LAST
    + _map(
        "(SELECT Country, Latitude, Longitude, Confirmed AS confirmed, "
        "Active_Per_100k AS active_per_100k FROM last_row)"
    ),
    "key_detail": FACT
    + SNAPSHOT
    + f"""
SELECT Country, format('{{:,}}', confirmed) AS total_cases,
       format('{{:.1f}}', active_per_100k) AS active_per_100k,
       format('{{:.2f}}', Latitude) AS latitude, format('{{:.2f}}', Longitude) AS longitude
FROM snap WHERE Country = '{KEY}' ORDER BY confirmed DESC LIMIT 1""",
    "top10_keys": FACT
    + SNAPSHOT
    + """
SELECT Country, confirmed, round(active_per_100k, 6) AS active_per_100k,
       format('{:,}', confirmed) AS label
FROM snap ORDER BY confirmed DESC, Country LIMIT 10""",
    "global_active_per_100k": FACT
    + SNAPSHOT
    + """
SELECT CAST(a AS BIGINT) AS total_active, CAST(p AS BIGINT) AS total_population,
       round(a / greatest(CAST(1 AS DOUBLE), p / CAST(100000 AS DOUBLE)), 6) AS active_per_100k
FROM (SELECT coalesce(sum(active), 0) AS a, coalesce(sum(Population), 0) AS p
      FROM (SELECT Country, sum(confirmed - recoveries) AS active FROM snap GROUP BY 1)
      LEFT JOIN dim USING (Country))""",
    "emptiness": FACT
    + f"""
SELECT 'facts' AS table_name, count(*) = 0 AS is_empty FROM fact
UNION ALL SELECT 'key_facts', count(*) = 0 FROM fact WHERE Country = '{KEY}'
UNION ALL SELECT 'absent_key_facts', count(*) = 0 FROM fact WHERE Country = '{ABSENT_KEY}'""",
}
