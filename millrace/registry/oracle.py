"""The same results as plain SQL over the sample tables, for an independent engine."""

from __future__ import annotations

from millrace.sources import seeds


def _r(value: str, places: int) -> str:
    return f"round({value}, {places})"


def _sum(value: str, places: int = 6) -> str:
    return f"round(sum(CAST({value} AS DOUBLE)), {places})"


def _avg(value: str) -> str:
    return f"round(avg(CAST({value} AS DOUBLE)), 6)"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


# -- sales -------------------------------------------------------------------
HEADER = """
header AS (
  SELECT o_orderkey AS sid, o_orderdate AS odate, c_nationkey AS terr,
         CASE o_orderstatus WHEN 'F' THEN 5 ELSE 1 END AS status, o_orderpriority = '5-LOW' AS online
  FROM orders JOIN customer ON c_custkey = o_custkey)"""
DETAIL = """
detail AS (
  SELECT l_orderkey AS sid, l_linenumber AS line, l_partkey AS pid, CAST(l_quantity AS INTEGER) AS qty,
         l_extendedprice / l_quantity AS price, l_extendedprice * (1 - l_discount) AS total,
         CAST(price AS DECIMAL(18,8)) AS exact_price, CAST(total AS DECIMAL(18,4)) AS exact_total
  FROM lineitem)"""
TERRITORY = """
territory AS (
  SELECT n_nationkey AS terr, n_name AS tname, r_name AS country FROM nation JOIN region ON r_regionkey = n_regionkey)"""
PRODUCTS = """
brand AS (
  SELECT DISTINCT CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER) AS sub, p_brand AS sname FROM part),
products AS (
  SELECT p_partkey AS pid, p_name AS pname, 'PN-' || p_partkey AS pnumber,
         CAST(p_retailprice AS DECIMAL(10,2)) AS list_price,
         CAST(round(p_retailprice * (CAST(0.3 AS DOUBLE) + p_size / CAST(100 AS DOUBLE)), 2) AS DECIMAL(10,2)) AS cost,
         coalesce('Type' || (sub % 6), 'N/A') AS category, coalesce(sname, 'N/A') AS subcategory
  FROM part LEFT JOIN brand ON sname = p_brand AND p_size % 10 <> 0
  WHERE p_retailprice > 0)"""
LINES = """
lines AS (
  SELECT sid, line, CAST(odate AS DATE) AS oday, pid, qty, price, total, exact_price, exact_total, terr, tname, country, online
  FROM header JOIN territory USING (terr) JOIN detail USING (sid) WHERE status = 5)"""
SUMMARY = f"""
summary AS (
  SELECT pid AS "ProductID", pname AS "ProductName", pnumber AS "ProductNumber", category AS "Category",
         subcategory AS "Subcategory", terr AS "TerritoryID", tname AS "TerritoryName", country AS "CountryRegionCode",
         {_r(_sum("total"), 2)} AS "TotalRevenue", CAST(sum(qty) AS BIGINT) AS "TotalQty",
         {_r(_avg("price"), 2)} AS "AvgUnitPrice",
         CAST(list_price AS DOUBLE) AS "ListPrice", CAST(cost AS DOUBLE) AS "StandardCost",
         round(CAST(list_price AS DOUBLE) - CAST(cost AS DOUBLE), 2) AS "Margin",
         round((CAST(list_price AS DOUBLE) - CAST(cost AS DOUBLE)) / CAST(list_price AS DOUBLE) * CAST(100 AS DOUBLE), 2) AS "MarginPct",
         max(oday) AS newest
  FROM lines JOIN products USING (pid)
  GROUP BY pid, pname, pnumber, category, subcategory, terr, tname, country, list_price, cost)"""
SALES = _with(HEADER, DETAIL, TERRITORY, PRODUCTS, LINES, SUMMARY)
# price averages and percentages of the decimal flavour, rounded once on whole cents
PG_SUMMARY = """
SELECT pid AS "ProductID", pname AS "ProductName", pnumber AS "ProductNumber", category AS "Category",
       subcategory AS "Subcategory", terr AS "TerritoryID", tname AS "TerritoryName", country AS "CountryRegionCode",
       CAST(sum(CAST(exact_total AS DECIMAL(12,2))) AS DOUBLE) AS "TotalRevenue", CAST(sum(qty) AS BIGINT) AS "TotalQty",
       ((2 * sum(CAST(CAST(exact_price AS DECIMAL(10,2)) * 100 AS BIGINT)) + count(*)) // (2 * count(*))) / CAST(100 AS DOUBLE) AS "AvgUnitPrice",
       CAST(list_price AS DOUBLE) AS "ListPrice", CAST(cost AS DOUBLE) AS "StandardCost",
       CAST(list_price - cost AS DOUBLE) AS "Margin",
       ((20000 * CAST((list_price - cost) * 100 AS BIGINT) + CAST(list_price * 100 AS BIGINT))
          // (2 * CAST(list_price * 100 AS BIGINT))) / CAST(100 AS DOUBLE) AS "MarginPct"
FROM lines JOIN products USING (pid)
WHERE NOT online
GROUP BY pid, pname, pnumber, category, subcategory, terr, tname, country, list_price, cost"""
REVENUE = _sum('"TotalRevenue"', 2)
SUMMARY_COLUMNS = "* EXCLUDE (newest)"
SIX_COUNTS = [
    ("sales_order_header", "(SELECT count(*) FROM orders JOIN customer ON c_custkey = o_custkey)", 5),
    ("sales_order_detail", "(SELECT count(*) FROM lineitem)", 6),
    ("sales_territory", "(SELECT count(*) FROM nation)", 3),
    ("product", "(SELECT count(*) FROM part)", 6),
    ("product_subcategory", "(SELECT count(DISTINCT p_brand) FROM part)", 3),
    ("product_category", "(SELECT count(DISTINCT CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER) % 6) FROM part)", 2),
]


def _six(prefix: str = "", validation: bool = False) -> str:
    rows = []
    for name, count, columns in SIX_COUNTS:
        extra = f", 'OK' AS status, CAST({columns} AS INTEGER) AS column_count" if validation else ""
        rows.append(f"SELECT '{prefix}{name}' AS \"table\", CAST({count} AS BIGINT) AS row_count{extra}")
    return "\nUNION ALL ".join(rows)


HEADER_OUT = (
    'sid AS "SalesOrderID", strftime(odate, \'%Y-%m-%d %H:%M:%S\') AS "OrderDate", terr AS "TerritoryID", '
    'status AS "Status", online AS "OnlineOrderFlag"'
)

SALES_SQL = {
    "silver_stg_sales_orders": SALES
    + """SELECT sid AS "SalesOrderID", line AS "SalesOrderDetailID", CAST(oday AS VARCHAR) AS "OrderDate", pid AS "ProductID",
    qty AS "OrderQty", price AS "UnitPrice", total AS "LineTotal", terr AS "TerritoryID",
    tname AS "TerritoryName", country AS "CountryRegionCode" FROM lines""",
    "pg_stg_sales_orders": SALES
    + """SELECT sid AS "SalesOrderID", line AS "SalesOrderDetailID", CAST(oday AS VARCHAR) AS "OrderDate", pid AS "ProductID",
    qty AS "OrderQty", CAST(CAST(exact_price AS DECIMAL(10,2)) AS DOUBLE) AS "UnitPrice",
    CAST(CAST(exact_total AS DECIMAL(12,2)) AS DOUBLE) AS "LineTotal", terr AS "TerritoryID",
    tname AS "TerritoryName", country AS "CountryRegionCode" FROM lines WHERE NOT online""",
    "silver_stg_products": _with(PRODUCTS)
    + """SELECT pid AS "ProductID", pname AS "ProductName", pnumber AS "ProductNumber", CAST(list_price AS DOUBLE) AS "ListPrice",
    CAST(cost AS DOUBLE) AS "StandardCost", category AS "Category", subcategory AS "Subcategory" FROM products""",
    "silver_trf_sales_summary": SALES + f"SELECT {SUMMARY_COLUMNS} FROM summary",
    "pg_trf_sales_summary": SALES + PG_SUMMARY,
    "gold_fact_sales_performance": SALES
    + f"""SELECT {SUMMARY_COLUMNS}, newest || ' 00:00:00' AS "LoadTimestamp", '2024-01-01' AS "BatchDate" FROM summary""",
    "export_gold": SALES + f"""SELECT {SUMMARY_COLUMNS}, '2024-01-01' AS "BatchDate" FROM summary""",
    "sales_preview": SALES + f"""SELECT {SUMMARY_COLUMNS} FROM summary ORDER BY "ProductID", "TerritoryID" LIMIT 20""",
    "sales_top10_products": SALES
    + f"""SELECT "ProductName", "Category", "Subcategory", {REVENUE} AS "TotalRevenue", CAST(sum("TotalQty") AS BIGINT) AS "TotalQty"
    FROM summary GROUP BY ALL ORDER BY 4 DESC NULLS LAST, 1, 2, 3 LIMIT 10""",
    "sales_by_territory": SALES
    + f"""SELECT "TerritoryName", "CountryRegionCode", {REVENUE} AS "TotalRevenue",
    CAST(sum("TotalQty") AS BIGINT) AS "TotalQty", count(DISTINCT "ProductID") AS "TotalProducts"
    FROM summary GROUP BY ALL ORDER BY 3 DESC NULLS LAST, 1""",
    "sales_top5_per_territory": SALES
    + """, placed AS (SELECT *, rank() OVER (PARTITION BY "TerritoryName" ORDER BY "TotalRevenue" DESC NULLS LAST) AS place FROM summary)
    SELECT "TerritoryName", "ProductName", "Category", "TotalRevenue", "TotalQty", CAST(place AS INTEGER) AS "RankInTerritory"
    FROM placed WHERE place <= 5 ORDER BY 1, 6, 2""",
    "sales_margin_by_category": SALES
    + f"""SELECT "Category", "Subcategory", {_r(_avg('"MarginPct"'), 2)} AS "AvgMarginPct", {_r(_avg('"Margin"'), 2)} AS "AvgMargin",
    {_r(REVENUE, 2)} AS "TotalRevenue", CAST(sum("TotalQty") AS BIGINT) AS "TotalQty"
    FROM summary GROUP BY ALL ORDER BY 3 DESC NULLS LAST, 1, 2""",
    "sales_high_margin_low_qty": SALES
    + f"""SELECT "ProductName", "Category", "Subcategory", CAST(sum("TotalQty") AS BIGINT) AS "TotalQty",
    {_avg('"MarginPct"')} AS "AvgMarginPct", {REVENUE} AS "TotalRevenue"
    FROM summary GROUP BY ALL HAVING {_avg('"MarginPct"')} > 40 AND sum("TotalQty") < 100 ORDER BY 5 DESC, 1, 2, 3""",
    "sales_category_share": SALES
    + f""", per AS (SELECT "Category" AS cat, {REVENUE} AS rev FROM summary GROUP BY 1)
    SELECT cat AS "Category", rev AS "CategoryRevenue",
    round(rev * CAST(100 AS DOUBLE) / (SELECT {_sum('rev', 2)} FROM per), 2) AS "RevenueSharePct" FROM per ORDER BY 2 DESC, 1""",
    "sales_audit": SALES + """SELECT max(newest) || ' 00:00:00' AS "LastLoadTime", count(*) AS "TotalRows" FROM summary""",
    "ingest_all_tables": _six(),
    "bronze_views_count": _six("bronze_"),
    "raw_validation_summary": _six(validation=True),
    "bronze_scan_dt": _with(HEADER) + f"SELECT {HEADER_OUT}, '2024-01-02' AS dt FROM header WHERE NOT online",
    "raw_roundtrip": _with(HEADER)
    + f"""SELECT {HEADER_OUT}, '2024-01-02' AS dt FROM header
    UNION ALL SELECT {HEADER_OUT}, '2024-01-01' AS dt FROM header WHERE status = 5""",
}

# -- weather -----------------------------------------------------------------
def _literal(value) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"CAST({value} AS DOUBLE)"
    return f"'{value}'" if isinstance(value, str) else str(value)


def _values(rows: list[tuple]) -> str:
    """Numbered rows of a seed list."""
    return ", ".join(f"({', '.join(_literal(v) for v in (i, *row))})" for i, row in enumerate(rows, 1))


LOCATION = f"""
place AS (
  SELECT * FROM (VALUES {_values(seeds.LOCATIONS)})
  AS t(location_id, location_key, city_name, province, island, region_type, climate_zone, latitude, longitude, elevation_m))"""


def _kind(agg: str, kind: str) -> str:
    return f"{agg}(value) FILTER (WHERE event_type = '{kind}')"


def _bronze(name: str, run_date: str = "2024-01-30", days: str = "true") -> str:
    return f"""
{name} AS (
  SELECT location_key, DATE '{run_date}' AS run_date, CAST(ts AS DATE) AS obs_date, max(ts) AS extracted_at,
         8 + {_kind("max", "view")} / 6 AS temp_max, {_kind("min", "click")} AS temp_min,
         8 + {_kind("max", "view")} / 6 + 2 AS apparent_temp_max, {_kind("max", "error")} - 60 AS precip_sum,
         {_kind("max", "signup")} / 4 AS windspeed_max, 100 - {_kind("min", "purchase")} AS humidity_max,
         strftime(min(ts), '%Y-%m-%dT%H:%M') AS sunrise, strftime(max(ts), '%Y-%m-%dT%H:%M') AS sunset,
         {_kind("max", "error")} / 40 AS uv_index_max, min(value) AS evapotranspiration,
         CAST(floor(max(value) / 5) AS INTEGER) AS weathercode,
         'weather/raw/daily/' || location_key || '/{run_date}.json' AS source_file
  FROM events JOIN place ON location_id = user_id % 15 + 1
  WHERE {days}
  GROUP BY location_key, CAST(ts AS DATE))"""


BRONZE = _bronze("bronze")
EARLY = _bronze("early", "2024-01-20", "CAST(ts AS DATE) <= DATE '2024-01-20'")
LATE = _bronze("late", "2024-01-30", "CAST(ts AS DATE) >= DATE '2024-01-15'")
TWO_RUNS = f"{EARLY.strip()},\n{LATE.strip()},\nbronze AS (SELECT * FROM early UNION ALL SELECT * FROM late)"
HOURLY = f"""
hourly AS (
  SELECT location_key, DATE '2024-01-30' AS run_date, date_trunc('hour', ts) AS hour_timestamp, max(ts) AS extracted_at,
         {_kind("max", "view")} / 4 AS temperature_2m, {_kind("max", "error")} - 60 AS precipitation,
         {_kind("max", "signup")} / 4 AS windspeed_10m, 100 - {_kind("min", "purchase")} AS humidity_2m,
         {_kind("max", "view")} / 4 + 1 AS apparent_temp, {_kind("min", "click")} AS precip_prob,
         max(value) - 20 AS cloudcover, min(value) / 100 AS soil_moisture,
         'weather/raw/hourly/' || location_key || '/2024-01-30.json' AS source_file
  FROM events JOIN place ON location_id = user_id % 15 + 1
  GROUP BY location_key, date_trunc('hour', ts))"""
CALENDAR = """
  CAST(extract(year FROM {d}) AS INTEGER) AS year, CAST(extract(month FROM {d}) AS INTEGER) AS month,
  CAST(extract(quarter FROM {d}) AS INTEGER) AS quarter,
  CAST(extract(dow FROM {d}) AS INTEGER) AS day_of_week, CAST(extract(week FROM {d}) AS INTEGER) AS week_of_year,
  CASE WHEN extract(month FROM {d}) BETWEEN 4 AND 10 THEN 'Kemarau' ELSE 'Hujan' END AS season,
  (['Puncak Hujan', 'Puncak Hujan', 'Akhir Hujan', 'Akhir Hujan', 'Awal Kemarau', 'Awal Kemarau', 'Puncak Kemarau',
    'Puncak Kemarau', 'Puncak Kemarau', 'Awal Hujan', 'Awal Hujan', 'Puncak Hujan'])[extract(month FROM {d})] AS monsoon_phase,
  {d} >= DATE '2026-04-01' AS is_el_nino_period, extract(month FROM {d}) BETWEEN 7 AND 9 AS is_peak_dry,
  extract(month FROM {d}) % 12 < 3 AS is_peak_wet"""
SILVER = f"""
checked AS (
  SELECT *, CASE WHEN temp_max BETWEEN 10 AND 50 THEN temp_max END AS warm,
         CASE WHEN temp_min BETWEEN 5 AND 45 THEN temp_min END AS cool FROM bronze),
silver AS (
  SELECT location_key, obs_date, run_date, round(warm, 2) AS temp_max_c, round(cool, 2) AS temp_min_c,
         round((coalesce(warm, 30) + coalesce(cool, 25)) / 2, 2) AS temp_avg_c,
         round(coalesce(apparent_temp_max, temp_max, 30), 2) AS apparent_temp_max_c,
         round(greatest(coalesce(precip_sum, 0), 0), 2) AS precip_mm,
         round(greatest(coalesce(windspeed_max, 0), 0), 2) AS windspeed_kmh,
         round(least(greatest(coalesce(humidity_max, 70), 0), 100), 2) AS humidity_pct,
         coalesce(uv_index_max, 0) AS uv_index_max, coalesce(evapotranspiration, 0) AS evapotranspiration, weathercode,
         CAST(round((extract(month FROM obs_date) - 1) / CAST(3 AS DOUBLE) + 1) AS INTEGER) AS quarter_rounded,
         {CALENDAR.format(d="obs_date")}
  FROM checked)"""
GOLD = """
indexed AS (
  SELECT *,
         round(greatest(0, 1 - precip_mm / 20) * CAST(0.5 AS DOUBLE)
               + least(1, greatest(0, (coalesce(temp_max_c, 30) - 28) / 12)) * CAST(0.3 AS DOUBLE)
               + greatest(0, 1 - humidity_pct / 100) * CAST(0.2 AS DOUBLE), 4) AS drought_index,
         round(coalesce(temp_max_c, 30) / 40 * CAST(0.35 AS DOUBLE) + (100 - humidity_pct) / 100 * CAST(0.4 AS DOUBLE)
               + windspeed_kmh / 80 * CAST(0.25 AS DOUBLE), 4) AS fire_weather_idx,
         round(coalesce(apparent_temp_max_c, temp_max_c, 30), 2) AS heat_index
  FROM silver),
counted AS (
  SELECT *, row_number() OVER w AS n, count(*) FILTER (WHERE precip_mm >= 1) OVER w AS wet
  FROM indexed WINDOW w AS (PARTITION BY location_key, run_date ORDER BY obs_date ROWS UNBOUNDED PRECEDING)),
gold AS (
  SELECT c.*, location_id, island, city_name, province,
         CAST(CASE WHEN precip_mm < 1 THEN n - wet ELSE 0 END AS INTEGER) AS dry_day_streak,
         CAST(CASE WHEN precip_mm < 1 THEN row_number() OVER (PARTITION BY c.location_key, run_date, wet ORDER BY obs_date)
              - (wet > 0)::INTEGER ELSE 0 END AS INTEGER) AS dry_day_streak_true,
         CASE WHEN drought_index > 0.3 THEN round(greatest(0, drought_index * CAST(0.6 AS DOUBLE)
              + greatest(0, (temp_avg_c - 30) / 10) * CAST(0.4 AS DOUBLE)), 4) ELSE 0 END AS crop_stress_score,
         CASE WHEN precip_mm < 1 THEN 'CLEAR' WHEN precip_mm < 5 THEN 'DRIZZLE' WHEN precip_mm < 20 THEN 'LIGHT_RAIN'
              WHEN precip_mm < 50 THEN 'MODERATE_RAIN' WHEN precip_mm < 100 THEN 'HEAVY_RAIN'
              WHEN precip_mm < 150 THEN 'VERY_HEAVY' ELSE 'EXTREME_RAIN' END AS condition_label,
         greatest(CASE WHEN precip_mm >= 150 THEN 3 WHEN precip_mm >= 100 THEN 2 WHEN precip_mm >= 50 THEN 1 ELSE 0 END,
                  CASE WHEN drought_index >= 0.75 THEN 3 WHEN drought_index >= 0.55 THEN 2 WHEN drought_index >= 0.35 THEN 1 ELSE 0 END,
                  CASE WHEN fire_weather_idx >= 0.75 THEN 3 WHEN fire_weather_idx >= 0.55 THEN 2 WHEN fire_weather_idx >= 0.35 THEN 1 ELSE 0 END) AS level,
         (['R_LOW', 'R_MODERATE', 'R_HIGH', 'R_EXTREME'])[level + 1] AS risk_code,
         (['RENDAH', 'SEDANG', 'TINGGI', 'EKSTREM'])[level + 1] AS risk_category,
         (['GREEN', 'YELLOW', 'ORANGE', 'RED'])[level + 1] AS alert_color,
         precip_mm >= 100 OR coalesce(temp_max_c, 0) > 38 OR fire_weather_idx > 0.7 AS is_extreme_weather,
         drought_index >= 0.55 AS is_drought_alert, precip_mm >= 100 AS is_flood_alert, fire_weather_idx >= 0.55 AS is_fire_alert
  FROM counted c LEFT JOIN place p ON p.location_key = c.location_key)"""
WEATHER = _with(LOCATION, BRONZE, SILVER, GOLD)
ISLAND = f"""
islands AS (
  SELECT island, obs_date, run_date, count(*) AS city_count,
         {_r(_avg("temp_max_c"), 2)} AS avg_temp_max_c, {_r(_avg("temp_min_c"), 2)} AS avg_temp_min_c,
         {_r(_sum("precip_mm"), 2)} AS total_precip_mm, round(max(precip_mm), 2) AS max_precip_mm,
         {_r(_avg("humidity_pct"), 2)} AS avg_humidity_pct, {_r(_avg("windspeed_kmh"), 2)} AS avg_windspeed_kmh,
         {_r(_avg("drought_index"), 4)} AS avg_drought_index, round(max(drought_index), 4) AS max_drought_index,
         {_r(_avg("fire_weather_idx"), 4)} AS avg_fire_idx, round(max(fire_weather_idx), 4) AS max_fire_idx,
         count(*) FILTER (WHERE level = 0) AS cities_rendah, count(*) FILTER (WHERE level = 1) AS cities_sedang,
         count(*) FILTER (WHERE level = 2) AS cities_tinggi, count(*) FILTER (WHERE level = 3) AS cities_ekstrem,
         bool_or(is_fire_alert) AS has_fire_alert, bool_or(is_drought_alert) AS has_drought_alert,
         bool_or(is_flood_alert) AS has_flood_alert, bool_or(is_extreme_weather) AS has_extreme_weather
  FROM gold GROUP BY island, obs_date, run_date)"""
DATES = f"""
dates AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_id, full_date,
         CAST(extract(doy FROM full_date) AS INTEGER) AS day_of_year, {CALENDAR.format(d="full_date")}
  FROM (SELECT CAST(unnest(range(DATE '2024-01-01', DATE '2031-01-01', INTERVAL 1 DAY)) AS DATE) AS full_date))"""
CONDITION = f"""
condition AS (
  SELECT * FROM (VALUES {_values(seeds.CONDITIONS)})
  AS t(condition_id, condition_code, condition_label, precip_category, is_extreme, has_thunder, risk_multiplier))"""
RISK = f"""
risk AS (
  SELECT * FROM (VALUES {_values(seeds.RISK_LEVELS)})
  AS t(risk_id, risk_code, risk_category, risk_score, flood_risk, drought_risk, wildfire_risk, heat_risk,
       mitigation_action, alert_color))"""
FACT_SELECT = """
SELECT location_id, date_id, condition_id, risk_id, temp_max_c, temp_min_c, temp_avg_c, precip_mm, windspeed_kmh, humidity_pct,
       apparent_temp_max_c AS apparent_temp_max, drought_index, dry_day_streak, heat_index, fire_weather_idx, crop_stress_score,
       is_extreme_weather, is_drought_alert, is_flood_alert, is_fire_alert, CAST(run_date AS VARCHAR) AS run_date,
       'open-meteo-via-minio-gold' AS source_api
FROM (SELECT *, row_number() OVER (PARTITION BY location_key, obs_date ORDER BY run_date DESC) AS age FROM gold) g
JOIN dates ON full_date = obs_date JOIN condition ON condition_code = g.condition_label JOIN risk ON risk.risk_code = g.risk_code
WHERE age = 1"""
KEY = "location_key, CAST(run_date AS VARCHAR) AS run_date, CAST(obs_date AS VARCHAR) AS obs_date"
MEASURES = "temp_max, temp_min, precip_sum, windspeed_max, humidity_max"
SILVER_OUT = "* REPLACE (CAST(obs_date AS VARCHAR) AS obs_date, CAST(run_date AS VARCHAR) AS run_date)"
GOLD_OUT = """location_key, location_id, CAST(obs_date AS VARCHAR) AS obs_date, CAST(run_date AS VARCHAR) AS run_date,
temp_max_c, temp_min_c, temp_avg_c, apparent_temp_max_c, precip_mm, windspeed_kmh, humidity_pct, uv_index_max, drought_index,
fire_weather_idx, heat_index, crop_stress_score, dry_day_streak, dry_day_streak_true, condition_label, risk_category, risk_code,
alert_color, is_extreme_weather, is_drought_alert, is_flood_alert, is_fire_alert, season, monsoon_phase, is_el_nino_period,
is_peak_dry, is_peak_wet"""
BRONZE_COLUMNS = f"""{KEY}, temp_max, temp_min, apparent_temp_max, precip_sum, windspeed_max, humidity_max, sunrise, sunset,
uv_index_max, evapotranspiration, weathercode, source_file"""
HOURLY_COLUMNS = """location_key, CAST(run_date AS VARCHAR) AS run_date, strftime(hour_timestamp, '%Y-%m-%d %H:%M:%S') AS hour_timestamp,
temperature_2m, precipitation, windspeed_10m, humidity_2m, apparent_temp, precip_prob, cloudcover, soil_moisture, source_file"""
EXTRACTED = "strftime(extracted_at, '%Y-%m-%d %H:%M:%S') AS extracted_at"
REPORT = """
report AS (
  SELECT location_key, city_name, alert_color, temp_max_c, precip_mm, drought_index, fire_weather_idx, risk_category,
         is_fire_alert, is_drought_alert, is_extreme_weather,
         concat_ws(' ', CASE WHEN is_fire_alert THEN '[KARHUTLA]' END, CASE WHEN is_drought_alert THEN '[KEKERINGAN]' END,
                   CASE WHEN is_extreme_weather THEN '[EKSTREM]' END) AS flags
  FROM gold WHERE run_date = DATE '2024-01-30' AND obs_date = (SELECT max(obs_date) FROM gold))"""
FOUND = """
found AS (
  SELECT DISTINCT location_key, CASE event_type WHEN 'error' THEN 'daily' ELSE 'hourly' END AS resolution, CAST(ts AS DATE) AS day
  FROM events JOIN place ON location_id = user_id % 15 + 1 WHERE event_type IN ('error', 'signup'))"""
def _check(name: str, value: str, passed: str, source: str) -> str:
    return f"SELECT '{name}' AS \"check\", {value} {passed} AS passed, CAST({value} AS VARCHAR) AS detail FROM {source}"


def _checks(*rows: str) -> str:
    return "\nUNION ALL ".join(rows)


def _duplicates(name: str, keys: str, source: str) -> str:
    return _check(name, "count(*)", "= 0", f"(SELECT 1 FROM {source} GROUP BY {keys} HAVING count(*) > 1)")


WEATHER_SQL = {
    "dim_location": _with(LOCATION)
    + """SELECT place.*, 'Asia/Jakarta' AS timezone, true AS is_active, count(event_id) AS observations
    FROM place LEFT JOIN events ON user_id % 15 + 1 = location_id GROUP BY ALL""",
    "dim_date": _with(DATES)
    + """SELECT dates.* REPLACE (CAST(full_date AS VARCHAR) AS full_date), count(event_id) AS observations
    FROM dates LEFT JOIN events ON CAST(ts AS DATE) = dates.full_date GROUP BY ALL""",
    "dim_weather_condition": _with(LOCATION, BRONZE, SILVER, GOLD, CONDITION)
    + """SELECT c.*,
    (SELECT count(*) FROM gold g WHERE g.condition_label = c.condition_code) AS days FROM condition c""",
    "dim_risk_level": _with(LOCATION, BRONZE, SILVER, GOLD, RISK)
    + """SELECT r.*, (SELECT count(*) FROM gold g WHERE g.risk_code = r.risk_code) AS days FROM risk r""",
    "bronze_weather_daily": _with(LOCATION, BRONZE) + f"SELECT {BRONZE_COLUMNS}, {EXTRACTED} FROM bronze",
    "bronze_weather_hourly": _with(LOCATION, HOURLY) + f"SELECT {HOURLY_COLUMNS}, {EXTRACTED} FROM hourly",
    "landing_daily_documents": _with(LOCATION, BRONZE) + f"SELECT {BRONZE_COLUMNS} FROM bronze",
    "landing_hourly_documents": _with(LOCATION, HOURLY) + f"SELECT {HOURLY_COLUMNS} FROM hourly",
    "silver_weather_daily": _with(LOCATION, BRONZE, SILVER) + f"SELECT {SILVER_OUT} FROM silver",
    "silver_weather_hourly": _with(LOCATION, HOURLY)
    + """SELECT location_key, CAST(run_date AS VARCHAR) AS run_date, strftime(hour_timestamp, '%Y-%m-%d %H:%M:%S') AS hour_timestamp,
    round(CASE WHEN temperature_2m BETWEEN 0 AND 50 THEN temperature_2m END, 2) AS temperature_c,
    round(greatest(coalesce(precipitation, 0), 0), 3) AS precipitation_mm, round(greatest(coalesce(windspeed_10m, 0), 0), 2) AS windspeed_kmh,
    round(least(greatest(coalesce(humidity_2m, 70), 0), 100), 2) AS humidity_pct,
    round(coalesce(apparent_temp, temperature_2m, 28), 2) AS apparent_temp_c,
    round(least(greatest(coalesce(precip_prob, 0), 0), 100), 2) AS precip_prob_pct,
    round(least(greatest(coalesce(cloudcover, 0), 0), 100), 2) AS cloudcover_pct,
    round(greatest(coalesce(soil_moisture, 0), 0), 4) AS soil_moisture,
    strftime(hour_timestamp, '%Y-%m-%d') AS obs_date, CAST(extract(hour FROM hour_timestamp) AS INTEGER) AS obs_hour FROM hourly""",
    "gold_weather_daily": WEATHER + f"SELECT {GOLD_OUT} FROM gold",
    "gold_island_daily": _with(LOCATION, BRONZE, SILVER, GOLD, ISLAND) + f"SELECT {SILVER_OUT} FROM islands",
    "gold_island_ranking": _with(LOCATION, BRONZE, SILVER, GOLD, ISLAND)
    + """SELECT island, CAST(obs_date AS VARCHAR) AS obs_date, city_count, max_drought_index, max_fire_idx, cities_ekstrem
    FROM islands ORDER BY max_drought_index DESC NULLS LAST, island, 2""",
    "gold_alert_dashboard": WEATHER
    + """SELECT location_key, city_name, province, island, CAST(obs_date AS VARCHAR) AS obs_date, temp_max_c, precip_mm, drought_index,
    fire_weather_idx, dry_day_streak, risk_category, alert_color, is_fire_alert, is_drought_alert, is_flood_alert, is_extreme_weather,
    season, monsoon_phase, is_el_nino_period
    FROM gold WHERE obs_date = (SELECT max(obs_date) FROM gold) ORDER BY level DESC, drought_index DESC, location_key""",
    "gold_daily_report": _with(LOCATION, BRONZE, SILVER, GOLD, REPORT) + "SELECT * FROM report",
    "gold_high_risk": _with(LOCATION, BRONZE, SILVER, GOLD, REPORT)
    + "SELECT * FROM report WHERE risk_category IN ('TINGGI', 'EKSTREM')",
    "fact_weather_daily": _with(LOCATION, TWO_RUNS, SILVER, GOLD, DATES, CONDITION, RISK) + FACT_SELECT,
    "upsert_replace": _with(LOCATION, TWO_RUNS, SILVER, GOLD, DATES, CONDITION, RISK) + FACT_SELECT,
    "dry_day_streak_true": _with(
        LOCATION,
        EARLY,
        _bronze("later", "2024-01-30", "CAST(ts AS DATE) > DATE '2024-01-20'"),
        "bronze AS (SELECT * FROM early UNION ALL SELECT * FROM later)",
        SILVER,
        """carry AS (  -- a stored streak goes on only where the next run starts on the very next day
  SELECT location_key, min(obs_date) FILTER (WHERE run_date = DATE '2024-01-30')
         - max(obs_date) FILTER (WHERE run_date = DATE '2024-01-20') = 1 AS joined FROM silver GROUP BY 1),
series AS (
  SELECT silver.*, CASE WHEN joined THEN DATE '2024-01-20' ELSE run_date END AS chain FROM silver JOIN carry USING (location_key)),
marked AS (
  SELECT *, count(*) FILTER (WHERE precip_mm >= 1) OVER (PARTITION BY location_key, chain ORDER BY obs_date ROWS UNBOUNDED PRECEDING) AS wet
  FROM series)""",
    )
    + """SELECT location_key, CAST(obs_date AS VARCHAR) AS obs_date, CAST(run_date AS VARCHAR) AS run_date, precip_mm,
    CAST(CASE WHEN precip_mm < 1 THEN count(*) FILTER (WHERE precip_mm < 1)
      OVER (PARTITION BY location_key, chain, wet ORDER BY obs_date ROWS UNBOUNDED PRECEDING) ELSE 0 END AS INTEGER) AS dry_day_streak_true
    FROM marked""",
    "prev_day_streak": WEATHER
    + """SELECT g.location_key, CAST(g.obs_date AS VARCHAR) AS obs_date, g.dry_day_streak, coalesce(b.dry_day_streak, 0) AS prev_streak
    FROM gold g LEFT JOIN gold b ON b.location_key = g.location_key AND b.obs_date + 1 = g.obs_date""",
    "dq_bronze": _with(LOCATION, BRONZE)
    + _checks(
        _check("city_coverage", "count(DISTINCT location_key)", ">= 15", "bronze"),
        _check("rows_without_measures", "count(*)", "= 0", "bronze WHERE coalesce(temp_max, temp_min, precip_sum) IS NULL"),
    ),
    "dq_silver": _with(LOCATION, BRONZE, SILVER)
    + _checks(
        _check("city_coverage", "count(DISTINCT location_key)", ">= 10", "silver"),
        _check("temperature_out_of_range", "count(*)", "= 0", "silver WHERE temp_max_c < 10 OR temp_max_c > 50"),
        _check("missing_obs_date", "count(*)", "= 0", "silver WHERE obs_date IS NULL"),
    ),
    "dq_gold": WEATHER
    + _checks(
        _check("city_coverage", "count(DISTINCT location_key)", ">= 10", "gold"),
        _check("missing_risk", "count(*)", "= 0", "gold WHERE risk_category IS NULL"),
        _check("drought_out_of_range", "count(*)", "= 0", "gold WHERE drought_index < 0 OR drought_index > 1"),
        _check("el_nino_flag_wrong", "count(*)", "= 0", "gold WHERE obs_date >= DATE '2026-04-01' AND NOT is_el_nino_period"),
    ),
    "dq_unique_keys": _with(HEADER, DETAIL, TERRITORY, PRODUCTS, LINES, SUMMARY, LOCATION, BRONZE, SILVER, GOLD)
    + _checks(
        _duplicates("fact_sales_performance", '"ProductID", "TerritoryID"', "summary"),
        _duplicates("gold_weather_daily", "location_key, obs_date, run_date", "gold"),
        _duplicates("sales_order_detail", "sid, line", "detail"),
    ),
    "upsert_ignore": _with(LOCATION, BRONZE)
    + f"SELECT {KEY}, {MEASURES.replace('temp_max,', 'temp_max + CASE WHEN obs_date <= DATE %s THEN 100 ELSE 0 END AS temp_max,' % repr('2024-01-20'), 1)} FROM bronze b",
    "versioned_upsert": """SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) = 1""",
    "surrogate_numbers": """SELECT row_number() OVER (ORDER BY c_nationkey >= 12, c_custkey) AS customer_no, c_custkey, c_nationkey FROM customer""",
    "keys_enforced": """WITH turn AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_partkey, l_suppkey, l_quantity) AS turn FROM lineitem)
    SELECT CASE WHEN turn = 1 THEN 'published' ELSE 'key repeated' END AS reason, count(*) AS lines,
    CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, CAST(sum(l_orderkey) AS BIGINT) AS sum_l_orderkey,
    CAST(sum(l_linenumber) AS BIGINT) AS sum_l_linenumber, CAST(sum(l_partkey) AS BIGINT) AS sum_l_partkey,
    CAST(sum(l_suppkey) AS BIGINT) AS sum_l_suppkey FROM turn GROUP BY 1""",
    "run_ledger": _with(LOCATION, TWO_RUNS)
    + """SELECT 'bronze_weather_daily' AS "table", CAST(run_date AS VARCHAR) AS run,
    CASE WHEN run_date = DATE '2024-01-20' THEN 'open' ELSE 'done' END AS state,
    CASE WHEN run_date = DATE '2024-01-20' THEN 'changed' ELSE 'first' END AS source,
    CASE WHEN run_date = DATE '2024-01-20' THEN NULL ELSE count(*) END AS rows, count(*) AS stored FROM bronze GROUP BY run_date""",
    "asof_last_event": """WITH kinds AS (SELECT *, event_type = (SELECT min(event_type) FROM events) AS asks FROM events),
    found AS (SELECT user_id, ts, max(struct_pack(a := event_id, b := event_type)) AS v FROM kinds WHERE NOT asks GROUP BY ALL)
    SELECT e.event_id, e.user_id, e.event_type, strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS ts,
    strftime(f.ts, '%Y-%m-%d %H:%M:%S') AS last_ts, f.v.a AS last_event_id, f.v.b AS last_event_type
    FROM (SELECT * FROM kinds WHERE asks) e ASOF LEFT JOIN found f ON e.user_id = f.user_id AND e.ts > f.ts""",
    "order_price_rank": "SELECT o_orderkey, o_totalprice, rank() OVER (ORDER BY o_totalprice DESC NULLS LAST) AS price_rank FROM orders",
    "replace_partition": _with(LOCATION, TWO_RUNS, SILVER)
    + f"SELECT {KEY}, precip_mm FROM silver WHERE run_date = DATE '2024-01-30' OR precip_mm < 1",
    "incremental_unprocessed": _with(LOCATION, BRONZE)
    + f"SELECT {KEY}, {MEASURES} FROM bronze b WHERE b.obs_date > DATE '2024-01-20'",
    "stream_landing_to_bronze": _with(LOCATION, BRONZE) + f"SELECT {KEY}, {MEASURES} FROM bronze",
    "stream_bronze_to_silver": _with(LOCATION, TWO_RUNS, SILVER) + f"SELECT {SILVER_OUT} FROM silver",
    "landing_named_objects": _with(LOCATION, BRONZE) + f"SELECT {BRONZE_COLUMNS} FROM bronze",
    "landing_missing_files": _with(LOCATION, FOUND)
    + """SELECT location_key, resolution, CAST(day AS VARCHAR) AS run_date,
    'weather/raw/' || resolution || '/' || location_key || '/' || CAST(day AS VARCHAR) || '.json' AS object_key
    FROM (SELECT location_key, resolution, day FROM place, (VALUES ('daily'), ('hourly')) r(resolution),
          (SELECT CAST(unnest(range(lo, hi + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day
           FROM (SELECT CAST(min(day) AS TIMESTAMP) AS lo, CAST(max(day) AS TIMESTAMP) AS hi FROM found))
          EXCEPT SELECT * FROM found)""",
    "landing_manifest": _with(LOCATION, FOUND)
    + """SELECT CAST(day AS VARCHAR) AS run_date, CAST(15 AS BIGINT) AS total_locations, 2 * count(*) OVER (PARTITION BY day) AS files_ingested,
    CAST(1 AS INTEGER) AS parts, 'completed' AS status, location_key,
    'weather/raw/daily/' || location_key || '/' || CAST(day AS VARCHAR) || '.json' AS object_key, CAST(1 AS BIGINT) AS days_returned
    FROM found WHERE resolution = 'daily'""",
}

# -- facts without a pipeline ------------------------------------------------
HR = """
hr AS (
  SELECT c_name AS "FullName", 'Title ' || (c_nationkey % 5) AS "JobTitle", c_mktsegment AS "DepartmentName",
         round(10 + (c_acctbal + 1000) / 200, 2) AS "LatestPayRate", (c_custkey * 37 % 200) / CAST(10 AS DOUBLE) AS "TenureYears",
         coalesce(kinds = 5, false) AS "IsMover"
  FROM customer LEFT JOIN (SELECT o_custkey, count(DISTINCT o_orderpriority) AS kinds FROM orders GROUP BY 1) ON o_custkey = c_custkey)"""
VENDOR = f"""
measured AS (
  SELECT l_suppkey, count(*) AS n, count(*) FILTER (WHERE abs(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE)) <= 1350) AS timely,
         sum(abs(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE))) AS days, max(o_orderdate) AS newest,
         {_avg("(l_extendedprice / l_quantity)")} AS price
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1),
rated AS (
  SELECT l_suppkey AS "VendorID", s_name AS "VendorName", n AS "TotalOrders", round(timely * CAST(100 AS DOUBLE) / n, 2) AS "OnTimeRate",
         round(CAST(days AS DOUBLE) / n, 1) AS "AvgLeadTimeDays", round(price - 4750, 2) AS "AvgPriceVariance", newest
  FROM measured JOIN supplier ON s_suppkey = l_suppkey),
vendor AS (
  SELECT *, round(greatest(0, least(100, 60 - "AvgPriceVariance" / 10 + ("OnTimeRate" - CAST(79.5 AS DOUBLE)))), 2) AS "VendorScore" FROM rated)"""
RFM = f"""
spent AS (
  SELECT o_custkey, max(o_orderdate) AS newest, count(*) AS orders, {_sum("o_totalprice", 2)} AS money FROM orders GROUP BY 1),
scored AS (
  SELECT c_name AS "CustomerName", n_name AS "TerritoryName", CAST(DATE '2001-08-02' - CAST(newest AS DATE) AS INTEGER) AS "Recency",
         orders AS "Frequency", money AS "Monetary", newest,
         CASE WHEN "Recency" <= 70 THEN 5 WHEN "Recency" <= 170 THEN 4 WHEN "Recency" <= 333 THEN 3 WHEN "Recency" <= 715 THEN 2 ELSE 1 END AS "R_Score",
         CASE WHEN orders >= 14 THEN 5 WHEN orders >= 12 THEN 4 WHEN orders >= 10 THEN 3 WHEN orders >= 8 THEN 2 ELSE 1 END AS "F_Score",
         CASE WHEN money >= 3.6e6 THEN 5 WHEN money >= 3.0e6 THEN 4 WHEN money >= 2.4e6 THEN 3 WHEN money >= 1.8e6 THEN 2 ELSE 1 END AS "M_Score"
  FROM spent JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
rfm AS (
  SELECT *, "R_Score" + "F_Score" + "M_Score" AS "RFM_Score",
         CASE WHEN "RFM_Score" >= 12 THEN 'Champions' WHEN "RFM_Score" >= 9 THEN 'Loyal' WHEN "RFM_Score" >= 6 THEN 'At Risk' ELSE 'Lost' END AS "Segment"
  FROM scored)"""


def _mean(column: str, places: int, alias: str) -> str:
    return f'{_r(_avg(chr(34) + column + chr(34)), places)} AS "{alias}"'


def _spread(column: str, suffix: str) -> str:
    return (
        f'{_mean(column, 2, "Avg" + suffix)}, round(min("{column}"), 2) AS "Min{suffix}", round(max("{column}"), 2) AS "Max{suffix}"'
    )


_SEGMENTS = ", ".join(
    f"""count(*) FILTER (WHERE "Segment" = '{s}') AS "{s.replace(' R', 'R')}\"""" for s in ("Champions", "Loyal", "At Risk", "Lost")
)
LOADED = "strftime(max(newest), '%Y-%m-%d %H:%M:%S') AS \"LastLoadTime\""

REPORT_SQL = {
    "hr_tenure_by_dept": _with(HR)
    + f'SELECT "DepartmentName", count(*) AS "TotalKaryawan", {_spread("TenureYears", "TenureYears")} FROM hr GROUP BY 1 ORDER BY 3 DESC',
    "hr_top5_pay": _with(HR)
    + """SELECT "FullName", "JobTitle", "DepartmentName", "LatestPayRate", "TenureYears",
    CAST(rank() OVER (PARTITION BY "DepartmentName" ORDER BY "LatestPayRate" DESC NULLS LAST) AS INTEGER) AS "RankInDept"
    FROM hr ORDER BY "LatestPayRate" DESC NULLS LAST, "FullName" LIMIT 5""",
    "hr_mover_pct": _with(HR)
    + """SELECT "DepartmentName", count(*) AS "TotalKaryawan", count(*) FILTER (WHERE "IsMover") AS "TotalMover",
    round(count(*) FILTER (WHERE "IsMover") * CAST(100 AS DOUBLE) / count(*), 2) AS "MoverPct" FROM hr GROUP BY 1""",
    "hr_pay_by_bracket": _with(HR)
    + f"""SELECT CASE WHEN "TenureYears" >= 15 THEN '15+ tahun' WHEN "TenureYears" >= 10 THEN '10-15 tahun'
    WHEN "TenureYears" >= 5 THEN '5-10 tahun' ELSE '0-5 tahun' END AS "TenureBracket",
    count(*) AS "JumlahKaryawan", {_spread("LatestPayRate", "PayRate")} FROM hr GROUP BY 1 ORDER BY min("TenureYears")""",
    "hr_jobtitle_distribution": _with(HR)
    + f"""SELECT "DepartmentName", "JobTitle", count(*) AS "JumlahKaryawan", {_mean("LatestPayRate", 2, "AvgPayRate")},
    {_mean("TenureYears", 2, "AvgTenure")} FROM hr GROUP BY 1, 2""",
    "hr_long_tenure_low_pay": _with(HR)
    + f"""SELECT "FullName", "DepartmentName", "JobTitle", "TenureYears", "LatestPayRate" FROM hr
    WHERE "TenureYears" > 10 AND "LatestPayRate" < (SELECT {_avg('"LatestPayRate"')} FROM hr)""",
    "vendor_ranking": _with(VENDOR)
    + """SELECT rank() OVER (ORDER BY "VendorScore" DESC NULLS LAST) AS "Rank", "VendorName", "TotalOrders", "OnTimeRate", "AvgLeadTimeDays",
    "AvgPriceVariance", "VendorScore" FROM vendor""",
    "vendor_shipmethod_compare": _with(VENDOR)
    + f"""SELECT l_returnflag AS "ShipMethodName", count(DISTINCT l_suppkey) AS "JumlahVendor", {_mean("OnTimeRate", 2, "AvgOnTimeRate")},
    {_mean("VendorScore", 2, "AvgVendorScore")}, {_mean("AvgLeadTimeDays", 1, "AvgLeadTime")}
    FROM vendor JOIN lineitem ON l_suppkey = "VendorID" GROUP BY 1""",
    "vendor_price_status": _with(VENDOR)
    + """SELECT "VendorName", "AvgPriceVariance", "OnTimeRate", "VendorScore",
    (['Lebih murah dari Standard ✓', 'Sama dengan Standard', 'Lebih mahal dari Standard ✗'])[CAST(sign("AvgPriceVariance") AS INTEGER) + 2] AS "PriceStatus"
    FROM vendor""",
    "vendor_best_of_both": _with(VENDOR)
    + """SELECT "VendorName", "OnTimeRate", "AvgPriceVariance", "VendorScore", "TotalOrders" FROM vendor
    WHERE "OnTimeRate" >= 80 AND "AvgPriceVariance" < 10""",
    "vendor_performance_bands": _with(VENDOR)
    + f"""SELECT CASE WHEN "VendorScore" < 40 THEN 'Poor (<40)' WHEN "VendorScore" < 60 THEN 'Fair (40-59)'
    WHEN "VendorScore" < 80 THEN 'Good (60-79)' ELSE 'Excellent (80+)' END AS "PerformanceCategory",
    count(*) AS "JumlahVendor", {_mean("OnTimeRate", 2, "AvgOnTimeRate")}, {_mean("AvgLeadTimeDays", 1, "AvgLeadTime")} FROM vendor GROUP BY 1""",
    "vendor_audit": _with(VENDOR)
    + f"""SELECT {LOADED}, count(*) AS "TotalVendor", {_mean("VendorScore", 2, "AvgScoreKeseluruhan")} FROM vendor""",
    "rfm_top10_champions": _with(RFM)
    + """SELECT "CustomerName", "TerritoryName", "Recency", "Frequency", "Monetary", "RFM_Score", "Segment" FROM rfm
    WHERE "Segment" = 'Champions' ORDER BY "RFM_Score" DESC, "Monetary" DESC, "CustomerName" LIMIT 10""",
    "rfm_segment_distribution": _with(RFM)
    + f"""SELECT "Segment", count(*) AS "JumlahCustomer", round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM rfm), 2) AS "PctDariTotal",
    {_mean("Monetary", 2, "AvgMonetary")}, {_mean("Frequency", 1, "AvgFrequency")}, {_mean("Recency", 0, "AvgRecencyDays")} FROM rfm GROUP BY 1""",
    "rfm_territory_profile": _with(RFM)
    + f"""SELECT "TerritoryName", count(*) AS "TotalCustomer", {_mean("Recency", 0, "AvgRecency")}, {_mean("Frequency", 1, "AvgFrequency")},
    {_mean("Monetary", 2, "AvgMonetary")}, {_mean("RFM_Score", 2, "AvgRFMScore")}, {_SEGMENTS} FROM rfm GROUP BY 1""",
    "rfm_winback": _with(RFM)
    + f"""SELECT "CustomerName", "TerritoryName", "Recency" AS "RecencyDays", "Frequency", "Monetary", "Segment" FROM rfm
    WHERE "Recency" > 365 AND "Monetary" > (SELECT {_avg('"Monetary"')} FROM rfm)""",
    "rfm_champions_pct": _with(RFM)
    + f"""SELECT "TerritoryName", {_mean("RFM_Score", 2, "AvgRFMScore")}, {_mean("R_Score", 2, "AvgR")}, {_mean("F_Score", 2, "AvgF")},
    {_mean("M_Score", 2, "AvgM")}, round(count(*) FILTER (WHERE "Segment" = 'Champions') * CAST(100 AS DOUBLE) / count(*), 2) AS "ChampionsPct"
    FROM rfm GROUP BY 1""",
    "rfm_heatmap": _with(RFM)
    + f"""SELECT "R_Score", "F_Score", count(*) AS "JumlahCustomer", {_mean("Monetary", 2, "AvgMonetary")},
    {_mean("RFM_Score", 2, "AvgRFMScore")} FROM rfm GROUP BY 1, 2""",
    "rfm_audit": _with(RFM)
    + f"""SELECT {LOADED}, count(*) AS "TotalCustomer", count(DISTINCT "TerritoryName") AS "TotalTerritory", {_SEGMENTS} FROM rfm""",
}


def all_sql() -> dict[str, str]:
    return {**SALES_SQL, **WEATHER_SQL, **REPORT_SQL}
