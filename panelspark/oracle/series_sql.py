"""DuckDB SQL of the queries in ``plans.series``: recursion, ASOF joins and self-joins
instead of pointers, stacked windows and bitmaps."""

from __future__ import annotations

from panelspark.oracle.jobs_sql import OWN
from panelspark.oracle.panels_sql import panel_ctes

_COUNTED = """
       COUNT(DISTINCT CASE WHEN r.new_cases IS NOT NULL THEN r.location END) AS reporting_cases,
       COUNT(DISTINCT CASE WHEN r.new_deaths > 0 THEN r.location END) AS reporting_deaths,
       COUNT(DISTINCT CASE WHEN r.new_cases >= 500 THEN r.location END) AS large_days"""

ROLLING_DISTINCT = f"""
WITH {OWN}, last_days AS (SELECT DISTINCT date FROM own)
SELECT d.date, {_COUNTED}
FROM last_days d JOIN own r ON r.date BETWEEN d.date - 6 AND d.date
GROUP BY d.date
"""

MONTHLY_DISTINCT = f"""
WITH {OWN}, r AS (SELECT *, CAST(date_trunc('month', date) AS DATE) AS month FROM own)
SELECT r.continent, r.month, {_COUNTED}
FROM r GROUP BY GROUPING SETS ((r.continent, r.month), (r.continent))
"""

PANEL_JOIN_CHECKED = """
WITH sold AS (
    SELECT n.n_name AS location, CAST(o.o_orderdate AS DATE) AS date, COUNT(*) AS copies,
           CAST(SUM(CAST(floor(o.o_totalprice / 100) AS BIGINT)) AS BIGINT) AS amount
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
    GROUP BY 1, 2
), covered AS (
    SELECT location, date, COUNT(*) AS copies, MAX(new_vaccinations) AS new_vaccinations
    FROM vax_panel WHERE continent IS NOT NULL GROUP BY 1, 2
)
SELECT s.location, s.date, s.copies * v.copies AS joined_rows, s.copies AS left_copies, v.copies AS right_copies,
       s.amount * v.copies AS amount, v.new_vaccinations
FROM sold s JOIN covered v ON s.location = v.location AND s.date = v.date
"""

ASOF_REPORTS = """
WITH d AS (SELECT location, date, new_cases FROM deaths_panel WHERE continent IS NOT NULL AND new_cases IS NOT NULL),
v AS (SELECT location, date, total_vaccinations FROM vax_panel WHERE continent IS NOT NULL AND new_vaccinations IS NOT NULL)
SELECT d.location, d.date, d.new_cases, v.date AS matched_date, v.total_vaccinations
FROM d ASOF LEFT JOIN v ON d.location = v.location AND d.date >= v.date
"""


def asof_nation_coverage(tolerance: int) -> str:
    """Suppliers' reports (the panels of this query) against the nations' panel."""
    nations = panel_ctes("nation")
    for name in ("ps_ent", "ps_orders", "ps_days", "ps_grid", "ps_cases_daily", "ps_cases_nation", "ps_cases_all",
                 "deaths_panel", "ps_vax_daily", "ps_vax_run", "vax_panel"):
        nations = nations.replace(name, f"n_{name}")
    return f"""
WITH {nations.strip()},
d AS (SELECT continent AS nation, location, date, new_cases FROM deaths_panel
      WHERE continent IS NOT NULL AND new_cases IS NOT NULL),
v AS (SELECT location AS nation, date, total_vaccinations FROM n_vax_panel
      WHERE continent IS NOT NULL AND new_vaccinations IS NOT NULL),
m AS (SELECT d.*, v.date AS found, v.total_vaccinations AS total
      FROM d ASOF LEFT JOIN v ON d.nation = v.nation AND d.date >= v.date)
SELECT nation, location, date, new_cases, CASE WHEN date - found <= {tolerance} THEN found END AS matched_date,
       CASE WHEN date - found <= {tolerance} THEN total END AS total_vaccinations
FROM m
"""


SPACED_PEAKS = f"""
WITH RECURSIVE {OWN}, n AS (
    SELECT location, date, new_cases, ROW_NUMBER() OVER (PARTITION BY location ORDER BY date) AS rn
    FROM own WHERE new_cases IS NOT NULL
), peaks AS (
    SELECT a.location, a.date, a.new_cases
    FROM n a LEFT JOIN n b ON b.location = a.location AND b.rn = a.rn - 1
    LEFT JOIN n c ON c.location = a.location AND c.rn = a.rn + 1
    WHERE (b.rn IS NULL OR a.new_cases > b.new_cases) AND (c.rn IS NULL OR a.new_cases >= c.new_cases)
), taken AS (
    SELECT location, MIN(date) AS date, 1 AS place FROM peaks GROUP BY location
    UNION ALL
    SELECT t.location, MIN(p.date), ANY_VALUE(t.place) + 1
    FROM taken t JOIN peaks p ON p.location = t.location AND p.date >= t.date + 14
    GROUP BY t.location
)
SELECT t.location, t.date, p.new_cases, CAST(t.place AS BIGINT) AS peak_number
FROM taken t JOIN peaks p ON p.location = t.location AND p.date = t.date
"""

SEASONAL_PATTERNS = f"""
WITH {OWN}, n AS (
    SELECT location, date, coalesce(new_cases, 0) AS x,
           ROW_NUMBER() OVER (PARTITION BY location ORDER BY date) AS rn, COUNT(*) OVER (PARTITION BY location) AS days
    FROM own
), trends AS (
    SELECT location, date, x,
           CASE WHEN rn > 3 AND rn <= days - 3
                THEN CAST(SUM(x) OVER (PARTITION BY location ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS DOUBLE) / 7
           END AS weekly,
           CASE WHEN rn > 182 AND rn <= days - 182
                THEN CAST(SUM(x) OVER (PARTITION BY location ORDER BY date ROWS BETWEEN 182 PRECEDING AND 182 FOLLOWING) AS DOUBLE) / 365
           END AS yearly
    FROM n
), ratios AS (
    SELECT location, 'weekday' AS pattern, CAST(isodow(date) AS INTEGER) AS position, x / NULLIF(weekly, 0) AS ratio FROM trends
    UNION ALL
    SELECT location, 'month', CAST(month(date) AS INTEGER), x / NULLIF(yearly, 0) FROM trends
), means AS (
    SELECT location, pattern, position, COUNT(*) AS days, AVG(ratio) AS mean
    FROM ratios WHERE ratio IS NOT NULL GROUP BY 1, 2, 3
)
SELECT location, pattern, position, days,
       ROUND(mean / NULLIF(AVG(mean) OVER (PARTITION BY location, pattern), 0), 6) AS seasonal_index
FROM means
"""

COVERAGE_RUNS = f"""
WITH {OWN}, r AS (SELECT location, date, new_cases FROM own WHERE new_cases IS NOT NULL),
starts AS (
    SELECT location, date FROM r a
    WHERE NOT EXISTS (SELECT 1 FROM r b WHERE b.location = a.location AND b.date = a.date - 1)
), placed AS (
    SELECT r.location, r.date, r.new_cases, s.date AS run_start
    FROM r ASOF JOIN starts s ON r.location = s.location AND r.date >= s.date
), found AS (
    SELECT location, run_start, MAX(date) AS run_end, COUNT(*) AS days, CAST(SUM(new_cases) AS BIGINT) AS reported_sum
    FROM placed GROUP BY location, run_start
)
SELECT a.location, a.run_start, a.run_end, a.days, CAST(a.run_start - b.run_end - 1 AS BIGINT) AS gap_before, a.reported_sum
FROM found a ASOF LEFT JOIN found b ON a.location = b.location AND a.run_start > b.run_start
"""

LAG_PROFILE = f"""
WITH {OWN}, n AS (
    SELECT location, new_cases, new_deaths, ROW_NUMBER() OVER (PARTITION BY location ORDER BY date) AS rn
    FROM own WHERE new_cases IS NOT NULL
), c AS (
    SELECT a.location, CAST(a.rn - b.rn AS INTEGER) AS lag, COUNT(*) AS pairs,
           ROUND(CORR(CAST(a.new_deaths AS DOUBLE), CAST(b.new_cases AS DOUBLE)), 6) AS c
    FROM n a JOIN n b ON b.location = a.location AND b.rn BETWEEN a.rn - 28 AND a.rn
    WHERE a.new_deaths IS NOT NULL GROUP BY 1, 2
), usable AS (SELECT * FROM c WHERE pairs >= 30 AND c IS NOT NULL AND NOT isnan(c)),
best AS (SELECT location, MAX(c) AS c FROM usable GROUP BY location)
SELECT u.location, MIN(CASE WHEN u.c = best.c THEN lag END) AS best_lag, best.c AS best_correlation,
       MAX(CASE WHEN lag = 0 THEN u.c END) AS correlation_at_0, COUNT(*) AS lags
FROM usable u JOIN best ON best.location = u.location GROUP BY u.location, best.c
"""

CSV_QUARANTINE = f"""
WITH {OWN}, n AS (
    SELECT *, (date - DATE '1970-01-01') % 50 AS m FROM own
), s AS (
    SELECT n.*, CASE m WHEN 1 THEN 'n/a' WHEN 2 THEN '' ELSE CAST(date AS VARCHAR) END AS d,
           CASE m WHEN 3 THEN '12.5' WHEN 4 THEN 'many' WHEN 5 THEN '7.0' ELSE coalesce(CAST(new_cases AS VARCHAR), '') END AS x
    FROM n
), w AS (
    SELECT s.*, continent || ',' || location || ',' || d || ',' || population || ',' || coalesce(CAST(total_cases AS VARCHAR), '')
                || ',' || x || ',' || coalesce(CAST(total_deaths AS VARCHAR), '') || ','
                || coalesce(CAST(new_deaths AS VARCHAR), '') AS line
    FROM s
)
SELECT CASE WHEN m = 7 THEN 'cut' ELSE continent END AS continent, CASE WHEN m = 7 THEN 'short' ELSE location END AS location,
       CASE WHEN m NOT IN (1, 2, 7) THEN date END AS date, CASE WHEN m <> 7 THEN population END AS population,
       CASE WHEN m <> 7 THEN total_cases END AS total_cases,
       CASE WHEN m IN (3, 4, 7) THEN NULL WHEN m = 5 THEN 7 ELSE new_cases END AS new_cases,
       CASE WHEN m <> 7 THEN total_deaths END AS total_deaths, CASE WHEN m <> 7 THEN new_deaths END AS new_deaths,
       CASE m WHEN 6 THEN 'malformed' WHEN 7 THEN 'malformed' WHEN 1 THEN 'invalid date' WHEN 2 THEN 'missing date'
              WHEN 3 THEN 'invalid new_cases' WHEN 4 THEN 'invalid new_cases' END AS problem,
       CASE m WHEN 6 THEN line || ',extra' WHEN 7 THEN 'cut,short' ELSE line END AS raw
FROM w
"""
