"""Plain-SQL definitions of the stand-in tables, for the DuckDB oracle.

Each string is a list of CTE bodies (no leading WITH) mirroring
``sources.standin`` and ``plans.weather`` step by step; ``with_ctes`` puts the
ones a query needs in front of its final SELECT.
"""

from __future__ import annotations

from stratocast.schemas import COMPASS_OTHERWISE, COMPASS_SECTORS


def compass_sql(col: str) -> str:
    whens = " ".join(
        f"WHEN {col} >= {low} AND {col} <= {high} THEN '{name}'" for name, low, high in COMPASS_SECTORS
    )
    return f"CASE {whens} ELSE '{COMPASS_OTHERWISE}' END"


def rnd(expr: str) -> str:
    """Rounding to whole numbers."""
    return f"round({expr}, 0)"


def mean(expr: str) -> str:
    """Rounded mean of a compensated sum."""
    return rnd(f"fsum({expr}) / count({expr})")


def fahrenheit(col: str) -> str:
    return f"(({col} - 273.15) * 9 / 5 + 32)"


CTE = {
    "cities": """cities AS (
  SELECT n_name AS city, r_name AS country,
         CAST(n_nationkey AS DOUBLE) AS latitude, CAST(r_regionkey AS DOUBLE) AS longitude
  FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    "order_city": """order_city AS (
  SELECT o_orderkey, o_orderdate, o_totalprice, n_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)""",
    "line_readings": """line_readings AS (
  SELECT o_orderdate AS datetime, n_name AS city, l_extendedprice AS temperature,
         l_quantity AS humidity, l_discount * 100 AS wind_speed
  FROM lineitem JOIN order_city ON l_orderkey = o_orderkey)""",
    "order_readings": """order_readings AS (
  SELECT o_orderdate AS datetime, n_name AS city, o_orderkey AS seq,
         o_totalprice AS pressure, o_totalprice % 360 AS wind_direction
  FROM order_city)""",
    "d_temperature": f"""d_temperature AS (
  SELECT CAST(datetime AS DATE) AS date, city,
         {mean(fahrenheit('temperature'))} AS temperature,
         {rnd('min(' + fahrenheit('temperature') + ')')} AS min_temperature,
         {rnd('max(' + fahrenheit('temperature') + ')')} AS max_temperature
  FROM line_readings GROUP BY CAST(datetime AS DATE), city)""",
    "d_humidity": f"""d_humidity AS (
  SELECT CAST(datetime AS DATE) AS date, city,
         {mean('humidity')} AS humidity, {rnd('min(humidity)')} AS min_humidity,
         {rnd('max(humidity)')} AS max_humidity
  FROM line_readings GROUP BY CAST(datetime AS DATE), city)""",
    "d_wind_speed": f"""d_wind_speed AS (
  SELECT CAST(datetime AS DATE) AS date, city,
         {mean('wind_speed')} AS wind_speed, {rnd('min(wind_speed)')} AS min_wind_speed,
         {rnd('max(wind_speed)')} AS max_wind_speed
  FROM line_readings GROUP BY CAST(datetime AS DATE), city)""",
    "d_pressure": f"""d_pressure AS (
  SELECT CAST(datetime AS DATE) AS date, city,
         {mean('pressure')} AS pressure, {rnd('min(pressure)')} AS min_pressure,
         {rnd('max(pressure)')} AS max_pressure
  FROM order_readings GROUP BY CAST(datetime AS DATE), city)""",
    "d_direction": f"""d_direction AS (
  SELECT CAST(datetime AS DATE) AS date, city,
         arg_min({compass_sql('wind_direction')}, seq) AS wind_direction
  FROM order_readings GROUP BY CAST(datetime AS DATE), city)""",
    "fact_direction": """fact_direction AS (
  SELECT t.date, c.country, t.city, c.latitude, c.longitude,
         t.temperature, p.pressure, h.humidity, w.wind_speed, d.wind_direction
  FROM cities c
  JOIN d_temperature t ON t.city = c.city
  JOIN d_pressure p ON t.city = p.city AND t.date = p.date
  JOIN d_humidity h ON p.city = h.city AND p.date = h.date
  JOIN d_wind_speed w ON w.city = h.city AND w.date = h.date
  JOIN d_direction d ON w.city = d.city AND w.date = d.date
  WHERE c.country IN ('AMERICA', 'EUROPE'))""",
    "fact_range": """fact_range AS (
  SELECT t.date, t.city, c.country, c.latitude, c.longitude,
         t.max_temperature, t.min_temperature, t.temperature,
         p.max_pressure, p.min_pressure, p.pressure,
         h.max_humidity, h.min_humidity, w.max_wind_speed, h.humidity,
         w.min_wind_speed, w.wind_speed
  FROM cities c
  JOIN d_temperature t ON t.city = c.city
  JOIN d_pressure p ON t.city = p.city AND t.date = p.date
  JOIN d_humidity h ON p.city = h.city AND p.date = h.date
  JOIN d_wind_speed w ON w.city = h.city AND w.date = h.date
  WHERE c.country IN ('AMERICA', 'EUROPE'))""",
}

_DEPS = {
    "cities": [],
    "order_city": [],
    "line_readings": ["order_city"],
    "order_readings": ["order_city"],
    "d_temperature": ["line_readings"],
    "d_humidity": ["line_readings"],
    "d_wind_speed": ["line_readings"],
    "d_pressure": ["order_readings"],
    "d_direction": ["order_readings"],
    "fact_direction": ["cities", "d_temperature", "d_pressure", "d_humidity", "d_wind_speed", "d_direction"],
    "fact_range": ["cities", "d_temperature", "d_pressure", "d_humidity", "d_wind_speed"],
}


def with_ctes(names: list[str], select: str, extra: list[str] | None = None, recursive: bool = False) -> str:
    """``WITH [RECURSIVE] <needed CTEs in dependency order>, <extra> <select>``."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [CTE[n] for n in order] + list(extra or [])
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + select
