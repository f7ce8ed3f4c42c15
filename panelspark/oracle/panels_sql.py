"""DuckDB SQL that derives the same two panels as ``sources.panels``.

The oracle only sees the base tables as views, so every oracle query starts
with these CTEs. Sums are cast back to BIGINT (DuckDB widens SUM(BIGINT) to
HUGEINT) and divisions use NULLIF (DuckDB returns inf/NaN, Spark ANSI would
raise) so types and values line up with the Spark side.
"""

_ENTITIES = {
    "nation": """
    SELECT n.n_nationkey AS k, n.n_name AS location, r.r_name AS continent
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "supplier": """
    SELECT s.s_suppkey AS k, s.s_name AS location, n.n_name AS continent
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
}

_CASES_DAILY = {
    "nation": """
    SELECT c.c_nationkey AS k, o.day AS date,
           CAST(SUM(CAST(floor(o.o_totalprice / 100) AS BIGINT)) AS BIGINT) AS new_cases,
           CAST(SUM(CASE WHEN o.o_orderstatus = 'F' THEN CAST(floor(o.o_totalprice / 1000) AS BIGINT) ELSE 0 END)
                AS BIGINT) AS new_deaths
    FROM ps_orders o JOIN customer c ON o.o_custkey = c.c_custkey
    GROUP BY c.c_nationkey, o.day""",
    "supplier": """
    SELECT l.l_suppkey AS k, CAST(l.l_shipdate AS DATE) AS date,
           CAST(SUM(CAST(floor(l.l_extendedprice / 100) AS BIGINT)) AS BIGINT) AS new_cases,
           CAST(SUM(CASE WHEN l.l_linestatus = 'F' THEN CAST(floor(l.l_extendedprice / 1000) AS BIGINT) ELSE 0 END)
                AS BIGINT) AS new_deaths
    FROM lineitem l
    GROUP BY l.l_suppkey, CAST(l.l_shipdate AS DATE)""",
}

_VAX_SOURCE = {
    "nation": ("s.s_nationkey", "lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey"),
    "supplier": ("l.l_suppkey", "lineitem l"),
}

_PANEL_CTES = """
ps_ent AS ({entities}
),
ps_orders AS (
    SELECT o_custkey, o_totalprice, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders
),
ps_days AS (
    SELECT day FROM ps_orders UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem
),
ps_grid AS (
    SELECT k, location, continent, CAST(d AS DATE) AS date
    FROM (
        SELECT e.k, e.location, e.continent,
               unnest(generate_series(CAST((SELECT MIN(day) FROM ps_days) AS TIMESTAMP),
                                      CAST((SELECT MAX(day) FROM ps_days) AS TIMESTAMP),
                                      INTERVAL 1 DAY)) AS d
        FROM ps_ent e
    ) g
),
ps_cases_daily AS ({cases_daily}
),
ps_cases_nation AS (
    SELECT g.continent, g.location, g.date,
           CAST(1000000 * (g.k % 25 + 1) + CASE WHEN g.k % 25 % 5 = 0 THEN 1000 * (year(g.date) - 1995) ELSE 0 END
                AS BIGINT) AS population,
           CAST(SUM(d.new_cases) OVER run AS BIGINT) AS total_cases,
           d.new_cases,
           CAST(SUM(d.new_deaths) OVER run AS BIGINT) AS total_deaths,
           d.new_deaths
    FROM ps_grid g LEFT JOIN ps_cases_daily d ON g.k = d.k AND g.date = d.date
    WINDOW run AS (PARTITION BY g.location ORDER BY g.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
ps_cases_all AS (
    SELECT * FROM ps_cases_nation
    UNION ALL
    SELECT CAST(NULL AS VARCHAR) AS continent, continent AS location, date,
           CAST(SUM(population) AS BIGINT), CAST(SUM(total_cases) AS BIGINT), CAST(SUM(new_cases) AS BIGINT),
           CAST(SUM(total_deaths) AS BIGINT), CAST(SUM(new_deaths) AS BIGINT)
    FROM ps_cases_nation
    GROUP BY continent, date
),
deaths_panel AS (
    SELECT continent, location, date, population, total_cases, new_cases, total_deaths, new_deaths,
           CAST(new_deaths AS DOUBLE) * 1000000 / NULLIF(population, 0) AS new_deaths_per_million,
           CAST(total_deaths AS DOUBLE) * 1000000 / NULLIF(population, 0) AS total_deaths_per_million
    FROM ps_cases_all
),
ps_vax_daily AS (
    SELECT {vax_key} AS k, CAST(l.l_shipdate AS DATE) AS date,
           CAST(SUM(CAST(floor(l.l_quantity) AS BIGINT)) AS BIGINT) AS q,
           CAST(SUM(CASE WHEN l.l_returnflag = 'N' THEN CAST(floor(l.l_quantity) AS BIGINT) ELSE 0 END) AS BIGINT) AS f,
           CAST(SUM(CASE WHEN l.l_returnflag = 'R' THEN CAST(floor(l.l_quantity) AS BIGINT) ELSE 0 END) AS BIGINT) AS b
    FROM {vax_from}
    GROUP BY {vax_key}, CAST(l.l_shipdate AS DATE)
),
ps_vax_run AS (
    SELECT g.k % 25 AS k, g.continent, g.location, g.date, d.q,
           CAST(SUM(d.q) OVER run AS BIGINT) AS rq,
           CAST(SUM(d.f) OVER run AS BIGINT) AS rf,
           CAST(SUM(d.b) OVER run AS BIGINT) AS rb,
           CAST(SUM(d.f) OVER (PARTITION BY g.location) AS BIGINT) AS tf
    FROM ps_grid g LEFT JOIN ps_vax_daily d ON g.k = d.k AND g.date = d.date
    WINDOW run AS (PARTITION BY g.location ORDER BY g.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
vax_panel AS (
    SELECT continent, location, date,
           CAST(1000000 * (k + 1) AS BIGINT) AS population,
           CASE WHEN q IS NOT NULL THEN rq END AS total_vaccinations,
           CASE WHEN q IS NOT NULL THEN rf + rb END AS people_vaccinated,
           CASE WHEN q IS NOT NULL THEN rf END AS people_fully_vaccinated,
           CASE WHEN q IS NOT NULL THEN rb END AS total_boosters,
           q AS new_vaccinations,
           CASE WHEN q IS NOT NULL THEN CAST(rf AS DOUBLE) * (40 + 2 * k) / NULLIF(tf, 0) END
               AS people_fully_vaccinated_per_hundred,
           CASE WHEN q IS NOT NULL AND k % 4 <> 3 THEN CAST(rb AS DOUBLE) * (40 + 2 * k) / NULLIF(2 * tf, 0) END
               AS total_boosters_per_hundred,
           CASE WHEN k % 6 <> 5 THEN CAST(1000 * (k + 1) AS DOUBLE) END AS gdp_per_capita,
           CASE WHEN k % 10 <> 9 THEN CAST(45 + 2 * k AS DOUBLE) / 100 END AS human_development_index
    FROM ps_vax_run
)
"""


def panel_ctes(grain: str = "nation") -> str:
    vax_key, vax_from = _VAX_SOURCE[grain]
    return _PANEL_CTES.format(
        entities=_ENTITIES[grain], cases_daily=_CASES_DAILY[grain], vax_key=vax_key, vax_from=vax_from
    )


PANEL_CTES = panel_ctes("nation")


def with_panels(sql: str, grain: str = "nation") -> str:
    """Prefix an oracle query with the panel CTEs of ``grain``.

    ``sql`` is either a plain SELECT or a ``WITH ...`` query; in the latter
    case its CTEs are appended after the panel CTEs.
    """
    ctes = panel_ctes(grain).strip()
    body = sql.strip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + ctes + ",\n" + body[15:]
    if body[:5].upper() == "WITH ":
        return "WITH " + ctes + ",\n" + body[5:]
    return "WITH " + ctes + "\n" + body
