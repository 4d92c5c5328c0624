"""SQL counterparts of the registered queries, written without looking at the operators.

``VIEWS`` are the domain inputs of FIXTURES.md and common steps; ``with_views`` puts
those a query needs in front of it.
"""

from __future__ import annotations

import re

from checks.raw_lines import DWELLING_WIDTHS, dwelling_modulus
from parcelstats.reference_data import SPECIAL_COMPLEXES

TMK = "CAST(2000000000000 + zs * 10000000000 + cplx * 10000 + unit AS BIGINT)"
RESIDENTIAL = "('owner-occupied', 'non-owner-occupied', 'tvr-strh', 'long-term-rental')"


def region_of(key: str) -> str:
    zone = f"CAST(SUBSTRING(CAST({key} AS VARCHAR), 2, 2) AS BIGINT)"
    return f"""CASE WHEN {zone} IN (41, 42, 43, 44, 45, 46, 47, 48) THEN 'West Maui'
      WHEN {zone} BETWEEN 31 AND 38 THEN 'Central Maui'
      WHEN {zone} BETWEEN 22 AND 29 THEN 'Upcountry'
      WHEN {zone} IN (21, 39) THEN 'South Maui'
      WHEN {zone} BETWEEN 11 AND 19 THEN 'East Maui'
      WHEN {zone} BETWEEN 50 AND 59 THEN 'Molokai'
      WHEN {zone} = 49 THEN 'Lanai' END"""


VIEWS = {
    "parcel_key": """
  SELECT p_partkey, CAST(FLOOR(p_partkey / 4) AS BIGINT) AS cplx, p_partkey % 4 AS unit,
    CASE CAST(FLOOR(p_partkey / 4) AS BIGINT) % 13
      WHEN 0 THEN 11 WHEN 1 THEN 14 WHEN 2 THEN 21 WHEN 3 THEN 23 WHEN 4 THEN 26 WHEN 5 THEN 31
      WHEN 6 THEN 38 WHEN 7 THEN 39 WHEN 8 THEN 43 WHEN 9 THEN 45 WHEN 10 THEN 49 WHEN 11 THEN 51
      ELSE 60 END AS zs,
    p_size, p_retailprice FROM part""",
    "assessments": f"""
  SELECT {TMK} AS tmk,
    CASE p_size % 6 WHEN 0 THEN 'owner-occupied' WHEN 1 THEN 'non-owner-occupied' WHEN 2 THEN 'tvr-strh'
      WHEN 3 THEN 'long-term-rental' WHEN 4 THEN 'owner-occupied' ELSE 'commercial' END AS tax_rate_class,
    CASE WHEN p_partkey % 10 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(FLOOR(p_retailprice * 1000) AS BIGINT) END
      AS assessed_building_value,
    CAST(FLOOR(p_retailprice * 500) AS BIGINT) AS assessed_land_value,
    CAST(p_size * 1000 AS BIGINT) AS building_exemption
  FROM parcel_key
  UNION ALL
  SELECT {TMK}, 'non-owner-occupied', CAST(FLOOR(p_retailprice * 1000) AS BIGINT),
    CAST(FLOOR(p_retailprice * 500) AS BIGINT), CAST(p_size * 1000 AS BIGINT)
  FROM parcel_key WHERE p_partkey % 97 = 0
  UNION ALL
  SELECT CAST(p_partkey AS BIGINT), 'owner-occupied', CAST(1 AS BIGINT), CAST(1 AS BIGINT), CAST(1 AS BIGINT)
  FROM parcel_key WHERE p_partkey % 101 = 0""",
    "prior_assessments": """
  SELECT CASE WHEN tmk % 9 = 0 THEN tmk * 10 + 1 ELSE tmk END AS tmk,
    assessed_building_value + 1000 AS assessed_building_value, assessed_land_value, building_exemption
  FROM assessments""",
    "dwellings": f"""
  SELECT CAST({TMK} + CASE WHEN k.p_partkey % 11 = 0 THEN 5000 ELSE 0 END AS BIGINT) AS tmk,
    CASE WHEN l_orderkey % 101 = 0 THEN CAST(100 AS BIGINT) ELSE CAST(200 + l_quantity * 40 AS BIGINT) END
      AS sf_of_living_area,
    CAST(1960 + l_orderkey % 70 AS BIGINT) AS year_built,
    CAST((l_orderkey + l_linenumber) % 5 AS BIGINT) AS bed_rooms,
    CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE CAST(k.cplx % 3 AS BIGINT) END AS condo_type
  FROM lineitem JOIN parcel_key k ON l_partkey = k.p_partkey""",
    "owners": f"""
  SELECT {TMK} AS tmk,
    CASE WHEN c_nationkey = 7 THEN NULL WHEN c_nationkey < 6 THEN CAST(96753 AS BIGINT)
      ELSE CAST(90000 + c_nationkey AS BIGINT) END AS mailing_zip1
  FROM customer JOIN parcel_key k ON k.p_partkey = c_custkey
  UNION ALL
  SELECT {TMK}, CAST(80000 + c_nationkey AS BIGINT)
  FROM customer JOIN parcel_key k ON k.p_partkey = c_custkey WHERE c_custkey % 5 = 0""",
    "sales": """
  SELECT CAST(k.zs * 10000000000 + k.cplx * 10000 + k.unit AS BIGINT) AS parid,
    CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 50 = 0 THEN '1900-01-01'
         ELSE SUBSTRING(CAST(o_orderdate AS VARCHAR), 1, 10) END AS saledate,
    SUBSTRING(CAST(o_orderdate AS VARCHAR), 1, 10) AS recorddate,
    CAST(FLOOR(o_totalprice) AS BIGINT) AS price,
    o_orderpriority AS instruno,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS landcourt_no,
    CAST(o_orderkey % 7 AS VARCHAR) AS cert_no
  FROM (SELECT *, o_custkey AS pk FROM orders
        UNION ALL SELECT *, o_custkey + 1 FROM orders WHERE o_orderkey % 20 = 0) o
  JOIN parcel_key k ON k.p_partkey = o.pk""",
    "tract_income": """
  SELECT CASE c_custkey % 6 WHEN 0 THEN '1980' WHEN 1 THEN '1990' WHEN 2 THEN '2000' WHEN 3 THEN '2006-2010'
      WHEN 4 THEN '2011-2015' ELSE '2016-2020' END AS year,
    CASE WHEN c_nationkey = 3 AND c_custkey % 7 = 0 THEN 'Alaska' ELSE 'Hawaii' END AS state,
    30000 + (c_nationkey + 1) * 100 + c_custkey % 4 AS tracta,
    CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE CAST(20000 + FLOOR(c_acctbal * 5) + c_custkey % 1000 AS INT) END
      AS b79aa
  FROM customer""",
    "tract_population": """
  SELECT CASE c_custkey % 5 WHEN 0 THEN '1980' WHEN 1 THEN '1990' WHEN 2 THEN '2000' WHEN 3 THEN '2010'
      ELSE '2020' END AS year,
    CASE WHEN c_nationkey = 10 THEN 'Alaska' ELSE 'Hawaii' END AS state,
    30000 + (c_nationkey + 1) * 100 + c_custkey % 4 AS tracta,
    CAST(SUM(100 + c_custkey % 400) AS INT) AS av0aa
  FROM customer GROUP BY 1, 2, 3""",
    "county_income": """
  SELECT year, state, CASE WHEN tracta % 4 = 0 THEN 'Maui County' ELSE 'Kauai County' END AS county,
    MAX(b79aa) AS b79aa
  FROM tract_income GROUP BY 1, 2, 3""",
    "year_index": """
  SELECT CAST(n_nationkey + 25 * r_regionkey AS BIGINT) AS i
  FROM nation CROSS JOIN region""",
    "cpi": """
  SELECT CAST(1980 + i AS BIGINT) AS year, CAST(80 + i * 4 + i % 5 AS DOUBLE) AS cpi FROM year_index""",
    "fred_state": """
  SELECT CAST(1984 + i AS VARCHAR) || '-01-01' AS observation_date,
    CAST(25000 + i * 1500 + (i % 4) * 250 AS VARCHAR) AS median_household_income
  FROM year_index""",
    "fred_county": """
  SELECT CAST(1989 + i AS VARCHAR) || '-01-01' AS observation_date,
    CASE WHEN i % 3 = 0 AND i < 11 THEN '.' ELSE CAST(31000 + i * 1450 + (i % 3) * 400 AS VARCHAR) END
      AS median_household_income
  FROM year_index""",
    "special_complexes": """
  SELECT DISTINCT zs * 1000000 + cplx AS tmk_sub FROM parcel_key WHERE p_size <= 10""",
    # Steps
    "parcels": f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY tmk ORDER BY tax_rate_class NULLS FIRST,
      assessed_building_value NULLS FIRST, assessed_land_value NULLS FIRST, building_exemption NULLS FIRST) AS rn
    FROM assessments WHERE LENGTH(CAST(tmk AS VARCHAR)) = 13 AND tax_rate_class IN {RESIDENTIAL})
  WHERE rn = 1""",
    "cards": """
  SELECT tmk, CASE WHEN sf_of_living_area >= 200 THEN sf_of_living_area END AS sf_of_living_area, year_built,
    bed_rooms, condo_type > 0 AS is_condo,
    CASE WHEN condo_type > 0 THEN 'Condo' ELSE 'Single Family Home' END AS home_type
  FROM dwellings""",
    "main_cards": """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY tmk ORDER BY sf_of_living_area DESC NULLS FIRST,
      year_built NULLS FIRST, bed_rooms NULLS FIRST, is_condo NULLS FIRST) AS rn FROM cards)
  WHERE rn = 1""",
    "base": f"""
  SELECT p.*, c.* EXCLUDE (tmk), {region_of("p.tmk")} AS region
  FROM parcels p JOIN main_cards c ON p.tmk = c.tmk""",
    "sales_clean": """
  SELECT * FROM (
    SELECT CAST('2' || CAST(parid AS VARCHAR) AS BIGINT) AS tmk,
      CASE WHEN TRY_CAST(SUBSTRING(saledate, 1, 4) AS BIGINT) = 1900
             THEN TRY_CAST(SUBSTRING(recorddate, 1, 4) AS BIGINT)
           ELSE COALESCE(TRY_CAST(SUBSTRING(saledate, 1, 4) AS BIGINT),
                         TRY_CAST(SUBSTRING(recorddate, 1, 4) AS BIGINT)) END AS sale_year,
      price, saledate, recorddate, instruno, landcourt_no, cert_no
    FROM sales)
  WHERE price > 20000 AND sale_year >= 1984 AND sale_year <= 2024""",
    "sold": """
  SELECT * EXCLUDE (rn) FROM (
    SELECT s.*, s.sale_year AS year, b.region, b.is_condo, b.home_type, ROW_NUMBER() OVER (
      PARTITION BY saledate, price, recorddate, instruno, landcourt_no, cert_no ORDER BY s.tmk) AS rn
    FROM sales_clean s JOIN base b ON s.tmk = b.tmk)
  WHERE rn = 1""",
    "priced": """
  SELECT sold.*, CAST(ROUND(price / c.cpi * (SELECT cpi FROM cpi WHERE year = 2023)) AS BIGINT) AS adj_price
  FROM sold LEFT JOIN cpi c ON sold.year = c.year""",
    "tracts": """
  SELECT * FROM (VALUES (30100, 'East Maui'), (30200, 'Upcountry'), (30300, 'Upcountry'), (30301, 'Upcountry'),
    (30302, 'South Maui'), (30303, 'South Maui'), (30304, 'Upcountry'), (30305, 'Upcountry'),
    (30306, 'South Maui'), (30307, 'South Maui'), (30400, 'Upcountry'), (30500, 'Upcountry'),
    (30600, 'Upcountry'), (30700, 'South Maui'), (30800, 'Central Maui'), (30900, 'Central Maui'),
    (31000, 'Central Maui'), (31100, 'Central Maui'), (31200, 'Central Maui'), (31300, 'Central Maui'),
    (31400, 'West Maui'), (31500, 'West Maui'), (31600, 'Lanai'), (31700, 'Molokai'), (31800, 'Molokai'),
    (31900, 'Upcountry'), (32000, 'West Maui')) AS t(code, name)""",
    "income_regions": """
  SELECT year, tracta, median_household_income, COALESCE(t.name, b.name) AS region FROM (
    SELECT CAST(CASE WHEN year LIKE '%-%' THEN REGEXP_EXTRACT(year, '-([0-9]+)$', 1) ELSE year END AS BIGINT) AS year,
      tracta, b79aa AS median_household_income
    FROM tract_income WHERE state = 'Hawaii') i
  LEFT JOIN tracts t ON i.tracta = t.code
  LEFT JOIN tracts b ON i.tracta // 100 * 100 = b.code
  WHERE COALESCE(t.name, b.name) IS NOT NULL""",
    "county_years": """
  SELECT CAST(CASE WHEN year LIKE '%-%' THEN REGEXP_EXTRACT(year, '-([0-9]+)$', 1) ELSE year END AS BIGINT) AS year,
    b79aa AS median_household_income
  FROM county_income WHERE state = 'Hawaii' AND county = 'Maui County'""",
}


def _medians(is_condo: str) -> str:
    return f"""
  SELECT CASE WHEN GROUPING(region) = 1 THEN 'Maui County' ELSE region END AS region, year,
    CAST(TRUNC(MEDIAN(price)) AS BIGINT) AS price, CAST(TRUNC(MEDIAN(adj_price)) AS BIGINT) AS adj_price,
    COUNT(*) AS count
  FROM priced WHERE is_condo = {is_condo} GROUP BY GROUPING SETS ((region, year), (year))"""


VIEWS["sfh_medians"] = _medians("FALSE")
VIEWS["condo_medians"] = _medians("TRUE")


def _income_medians(base_year: int) -> str:
    return f"""
  SELECT year, region, ARG_MIN(adj, rn) AS adj_median_household_income FROM (
    SELECT *, (running - w / 2) / total AS position,
      ROW_NUMBER() OVER (PARTITION BY year, region ORDER BY adj NULLS FIRST, w) AS rn
    FROM (
      SELECT year, region, adj, w, SUM(w) OVER (PARTITION BY year, region) AS total,
        SUM(w) OVER (PARTITION BY year, region ORDER BY adj NULLS FIRST, w
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
      FROM (
        SELECT i.year, i.region, p.av0aa AS w,
          CAST(ROUND(i.median_household_income / c.cpi * (SELECT cpi FROM cpi WHERE year = {base_year})) AS BIGINT) AS adj
        FROM income_regions i
        LEFT JOIN (SELECT * FROM tract_population WHERE state = 'Hawaii') p
          ON i.year = CAST(p.year AS BIGINT) AND i.tracta = p.tracta
        LEFT JOIN cpi c ON i.year = c.year)))
  WHERE position >= 0.5 GROUP BY year, region"""


def _county_adjusted(base_year: int) -> str:
    return f"""
  SELECT y.year, 'Maui County' AS region,
    CAST(ROUND(y.median_household_income / c.cpi * (SELECT cpi FROM cpi WHERE year = {base_year})) AS BIGINT)
      AS adj_median_household_income, CAST(y.median_household_income AS BIGINT) AS median_household_income
  FROM county_years y LEFT JOIN cpi c ON y.year = c.year"""


VIEWS["region_income_2020"] = _income_medians(2020)
VIEWS["region_income_2023"] = _income_medians(2023)
VIEWS["county_income_2020"] = _county_adjusted(2020)
VIEWS["county_income_2023"] = _county_adjusted(2023)
VIEWS["reference"] = """
  SELECT r.year, CAST(ROUND(r.income / c.cpi * (SELECT cpi FROM cpi WHERE year = 2023)) AS BIGINT) AS ref FROM (
    SELECT CAST(SUBSTRING(observation_date, 1, 4) AS BIGINT) AS year,
      TRY_CAST(median_household_income AS BIGINT) AS income
    FROM fred_state WHERE CAST(SUBSTRING(observation_date, 1, 4) AS BIGINT) < 2000
    UNION ALL
    SELECT CAST(SUBSTRING(observation_date, 1, 4) AS BIGINT), TRY_CAST(median_household_income AS BIGINT)
    FROM fred_county WHERE CAST(SUBSTRING(observation_date, 1, 4) AS BIGINT) >= 2000) r
  LEFT JOIN cpi c ON r.year = c.year"""


def interpolated(known: str, reference: str, position: str, group: str, value: str, ref: str) -> str:
    """Interpolation between the known points by self joins, without window frames."""
    return f"""
  SELECT g.{position}, g.{group}, CAST(ROUND(COALESCE(k.ratio,
      lo.ratio + (hi.ratio - lo.ratio) * (CAST(g.{position} - lo.{position} AS DOUBLE) / (hi.{position} - lo.{position})),
      lo.ratio, hi.ratio) * r.{ref}) AS BIGINT) AS {value}
  FROM (SELECT {position}, {group} FROM (SELECT UNNEST(RANGE(MIN(p), MAX(p) + 1)) AS {position} FROM (
          SELECT {position} AS p FROM {known} UNION ALL SELECT {position} FROM {reference}))
        CROSS JOIN (SELECT DISTINCT {group} FROM {known})) g
  JOIN {reference} r ON g.{position} = r.{position}
  LEFT JOIN known_ratio k ON k.{group} = g.{group} AND k.{position} = g.{position}
  LEFT JOIN known_ratio lo ON lo.{group} = g.{group} AND lo.{position} = (
    SELECT MAX({position}) FROM known_ratio x WHERE x.{group} = g.{group} AND x.{position} <= g.{position})
  LEFT JOIN known_ratio hi ON hi.{group} = g.{group} AND hi.{position} = (
    SELECT MIN({position}) FROM known_ratio x WHERE x.{group} = g.{group} AND x.{position} >= g.{position})"""


VIEWS["known_income"] = """
  SELECT year, region, adj_median_household_income AS adj FROM region_income_2023
  UNION ALL SELECT year, region, adj_median_household_income FROM county_income_2023"""
VIEWS["known_ratio_income"] = """
  SELECT k.year, k.region, CAST(k.adj AS DOUBLE) / r.ref AS ratio FROM known_income k
  JOIN reference r ON k.year = r.year WHERE k.adj IS NOT NULL AND r.ref IS NOT NULL"""
# The two inputs span the same years as the reference or fewer, so that one grid serves both.
VIEWS["every_year"] = interpolated(
    "known_income", "reference", "year", "region", "adj_median_household_income", "ref"
).replace("known_ratio", "known_ratio_income")
VIEWS["income_interpolated"] = """
  SELECT e.year, e.region, e.adj_median_household_income,
    CAST(ROUND(e.adj_median_household_income / (SELECT cpi FROM cpi WHERE year = 2023) * c.cpi) AS BIGINT)
      AS median_household_income
  FROM every_year e LEFT JOIN cpi c ON e.year = c.year WHERE e.region <> 'Lanai' OR e.year >= 1990"""
VIEWS["hourly_points"] = """
  SELECT CAST(FLOOR(EPOCH(ts) / 3600) AS BIGINT) AS hour, event_type, CAST(ROUND(value * 100) AS BIGINT) AS cents
  FROM events"""
VIEWS["hourly_reference"] = """
  SELECT hour, CAST(SUM(cents) * 100 // COUNT(*) AS BIGINT) AS mean FROM hourly_points GROUP BY hour"""
VIEWS["hourly_known"] = """
  SELECT hour, event_type, CAST(SUM(cents) * 100 // COUNT(*) AS BIGINT) AS mean
  FROM hourly_points GROUP BY hour, event_type"""
VIEWS["known_ratio"] = """
  SELECT k.hour, k.event_type, CAST(k.mean AS DOUBLE) / NULLIF(r.mean, 0) AS ratio
  FROM hourly_known k JOIN hourly_reference r ON k.hour = r.hour WHERE r.mean <> 0"""


def with_views(body: str, views: dict[str, str] = VIEWS) -> str:
    """``body`` behind the views it uses, directly or through other views."""

    def used(text: str) -> set[str]:
        names = set(re.findall(r"[a-z_0-9]+", text))
        return {v for v in views if v in names}

    needed: set[str] = set()
    waiting = used(body)
    while waiting:
        name = waiting.pop()
        needed.add(name)
        waiting |= used(views[name]) - needed - {name}
    ordered: list[str] = []

    def place(name: str) -> None:
        if name in ordered:
            return
        for other in sorted(used(views[name]) - {name}):
            place(other)
        ordered.append(name)

    for name in sorted(needed):
        place(name)
    ctes = [f"{name} AS ({views[name]})" for name in ordered]
    if body.startswith(STEPS):
        ctes.append("")
        body = body.removeprefix(STEPS)
    return f"WITH {', '.join(ctes)}{body}" if ctes else body


def fixed_width_dwellings() -> str:
    columns = ["CAST(2000000000000 + l_partkey AS VARCHAR) AS tmk"]
    for i, (name, width) in list(enumerate(DWELLING_WIDTHS.items()))[1:]:
        number = f"(l_orderkey * {i + 3} + l_linenumber * 7 + {i}) % {dwelling_modulus(width)}"
        value = f"CAST({number} AS VARCHAR)"
        if name == "building_grade":
            value = f"CASE WHEN l_orderkey % 97 = 0 THEN 'B+' ELSE {value} END"
        if name == "percent_complete":
            value = f"CAST({number} + 1 AS VARCHAR) || '.5'"
        columns.append(f"{value} AS {name}")
    return f"SELECT {', '.join(columns)} FROM lineitem"


# Marks a body that goes on with steps of its own.
STEPS = "\n, "

BODIES = {
    "median_sales_sfh": "SELECT * FROM sfh_medians",
    "median_sales_condo": "SELECT * FROM condo_medians",
    "affordable_sales": """
SELECT home_type, CASE WHEN GROUPING(region) = 1 THEN 'Maui County' ELSE region END AS region, year,
  CAST(ARG_MIN(thresh, r2) AS BIGINT) AS affordability_thresh, COUNT(*) AS total_count,
  COUNT(*) FILTER (price <= thresh) AS affordable_count,
  ROUND(CAST(COUNT(*) FILTER (price <= thresh) AS DOUBLE) / COUNT(*) * 100, 1) AS pct_affordable
FROM (SELECT s.home_type, s.region, s.region AS r2, s.year, s.price, i.median_household_income * 5 AS thresh
      FROM sold s JOIN income_interpolated i ON s.region = i.region AND s.year = i.year)
GROUP BY GROUPING SETS ((home_type, region, year), (home_type, year))""",
    "construction_by_decade": """
, recent AS (SELECT *, year_built // 10 * 10 AS decade FROM base WHERE year_built >= 1970 AND year_built <= 2023),
ranges AS (SELECT decade, CAST(MIN(year_built) AS VARCHAR) || '-' || CAST(MAX(year_built) AS VARCHAR) AS decade_desc,
    MAX(year_built) - MIN(year_built) + 1 AS num_years FROM recent GROUP BY decade),
by_region AS (SELECT region, decade, home_type, COUNT(*) AS n, MEDIAN(sf_of_living_area) AS m
    FROM recent GROUP BY region, decade, home_type),
by_county AS (SELECT decade, home_type, COUNT(*) AS n_all, MEDIAN(sf_of_living_area) AS m_all
    FROM recent GROUP BY decade, home_type),
grid AS (SELECT * FROM (SELECT DISTINCT region FROM recent) CROSS JOIN (SELECT DISTINCT decade FROM recent)
    CROSS JOIN (SELECT DISTINCT home_type FROM recent)),
block1 AS (SELECT g.region, g.decade, g.home_type, COALESCE(b.n, 0) AS n, b.m, c.n_all, c.m_all FROM grid g
    LEFT JOIN by_region b ON g.region = b.region AND g.decade = b.decade AND g.home_type = b.home_type
    LEFT JOIN by_county c ON g.decade = c.decade AND g.home_type = c.home_type),
block3 AS (SELECT 'Maui County' AS region, decade, home_type, n_all AS n, m_all AS m, n_all, m_all FROM by_county),
blocks AS (SELECT * FROM block1
    UNION ALL SELECT region, decade, 'All Homes', SUM(n), NULL, COALESCE(SUM(n_all), 0), NULL FROM block1 GROUP BY region, decade
    UNION ALL SELECT * FROM block3
    UNION ALL SELECT region, decade, 'All Homes', SUM(n), NULL, COALESCE(SUM(n_all), 0), NULL FROM block3 GROUP BY region, decade)
SELECT home_type, b.decade, decade_desc, region, CAST(n // num_years AS BIGINT) AS decade_yearly_avg,
  CAST(n_all // num_years AS BIGINT) AS decade_yearly_avg_all_regions,
  ROUND(CAST(n AS DOUBLE) / n_all * 100, 1) AS decade_region_pct, m AS sqft_median, m_all AS sqft_median_all_regions,
  ROUND(m / m_all * 100, 1) AS sqft_median_region_pct
FROM blocks b LEFT JOIN ranges r ON b.decade = r.decade""",
    "condo_profile": """
, marked AS (SELECT b.*, CAST(SUBSTRING(CAST(tmk AS VARCHAR), 2, 8) AS BIGINT) IN (SELECT tmk_sub FROM special_complexes)
    AS special, CAST(SUBSTRING(CAST(tmk AS VARCHAR), 2, 2) AS BIGINT) AS z FROM base b WHERE is_condo),
labelled AS (
  SELECT *, 'west-south-maui-minatoya-condos' AS label FROM marked
    WHERE special AND (z BETWEEN 41 AND 48 OR z IN (21, 39))
  UNION ALL SELECT *, 'west-south-maui-non-minatoya-condos' FROM marked
    WHERE NOT special AND (z BETWEEN 41 AND 48 OR z IN (21, 39)) AND tax_rate_class IN ('owner-occupied', 'long-term-rental')
  UNION ALL SELECT *, 'central-maui-condos' FROM marked
    WHERE z BETWEEN 31 AND 38 AND tax_rate_class IN ('owner-occupied', 'long-term-rental'))
SELECT l.name AS "desc", COUNT(label) AS total_count, CAST(TRUNC(MEDIAN(year_built)) AS INT) AS median_year_built,
  CAST(TRUNC(MEDIAN(assessed_building_value) FILTER (assessed_building_value > 0)) AS BIGINT) AS median_assessed_building_value,
  {shares}
FROM (VALUES ('west-south-maui-minatoya-condos'), ('west-south-maui-non-minatoya-condos'), ('central-maui-condos')) AS l(name)
LEFT JOIN labelled ON l.name = label GROUP BY l.name""",
    "household_income": """
SELECT r.year, r.region, r.adj_median_household_income,
  CAST(ROUND(r.adj_median_household_income / (SELECT cpi FROM cpi WHERE year = 2020) * c.cpi) AS BIGINT) AS median_household_income
FROM region_income_2020 r LEFT JOIN cpi c ON r.year = c.year WHERE r.region <> 'Lanai' OR r.year >= 1990
UNION ALL SELECT year, region, adj_median_household_income, median_household_income FROM county_income_2020""",
    "household_income_interpolated": "SELECT * FROM income_interpolated",
    "price_to_income": """
SELECT m.region, m.year, ROUND(CAST(m.adj_price AS DOUBLE) / i.adj_median_household_income, 1) AS price_to_income_ratio,
  m.adj_price, i.adj_median_household_income
FROM sfh_medians m JOIN income_interpolated i ON m.region = i.region AND m.year = i.year""",
    "fixed_width_assessments": f"""
SELECT CAST({TMK} AS VARCHAR) AS tmk, CAST(2000 + p_size % 25 AS VARCHAR) AS parcel_year,
  CAST(p_size % 7 AS VARCHAR) AS land_class,
  CASE p_size % 15 WHEN 0 THEN 'timeshare' WHEN 1 THEN 'non-owner-occupied' WHEN 2 THEN 'apartment'
    WHEN 3 THEN 'commercial' WHEN 4 THEN 'industrial' WHEN 5 THEN 'agricultural' WHEN 6 THEN 'conservation'
    WHEN 7 THEN 'hotel/resort' WHEN 8 THEN '' WHEN 9 THEN 'owner-occupied' WHEN 10 THEN 'commercialized-res'
    WHEN 11 THEN 'tvr-strh' WHEN 12 THEN 'long-term-rental' END AS tax_rate_class,
  CAST(CAST(FLOOR(p_retailprice * 500) AS BIGINT) AS VARCHAR) AS assessed_land_value,
  CASE WHEN p_size % 3 = 0 THEN '0' ELSE CAST(p_size * 10 AS VARCHAR) END AS land_exemption,
  CASE WHEN p_partkey % 10 = 0 THEN '0' ELSE CAST(CAST(FLOOR(p_retailprice * 1000) AS BIGINT) AS VARCHAR) END
    AS assessed_building_value,
  CAST(p_size * 1000 AS VARCHAR) AS building_exemption
FROM parcel_key""",
    "fixed_width_dwellings": fixed_width_dwellings(),
    "fixed_width_owners": """
SELECT CAST(2000000000000 + c_custkey AS VARCHAR) AS tmk,
  c_name || '| é “' || c_mktsegment || '”' AS owner, c_mktsegment AS owner_type, '0' AS co_mailing_address,
  LTRIM(CAST(c_custkey AS VARCHAR) || ' Main St| Apt €' || CAST(c_nationkey AS VARCHAR), '0') AS mailing_street_address,
  'Kihei| HI ' || CAST(90000 + c_nationkey AS VARCHAR) AS mailing_city_state_zip, 'Kihei' AS mailing_city_name,
  'HI' AS mailing_state, CAST(90000 + c_nationkey AS VARCHAR) AS mailing_zip1,
  CAST(c_custkey % 10000 AS VARCHAR) AS mailing_zip2, CASE WHEN c_nationkey = 7 THEN '0' ELSE 'USA' END AS country
FROM customer""",
    "fixed_width_sales": """
SELECT LTRIM(CAST(o_orderkey AS VARCHAR), '0') AS parid, LTRIM(STRFTIME(o_orderdate, '%d-%b-%y'), '0') AS saledate,
  CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE LTRIM(STRFTIME(o_orderdate, '%d-%b-%y'), '0') END AS recorddate,
  CAST(CAST(FLOOR(o_totalprice) AS BIGINT) AS VARCHAR) AS price, o_orderpriority AS instruno,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS landcourt_no,
  CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_orderkey % 7 AS VARCHAR) END AS cert_no,
  'Peña| “' || o_orderstatus || '”| Trust' AS seller,
  CASE WHEN o_orderkey % 1000 = 0 THEN '' ELSE CAST(o_orderkey % 1000 AS VARCHAR) END AS book,
  CASE WHEN o_orderkey % 100 = 0 THEN '' ELSE CAST(o_orderkey % 100 AS VARCHAR) END AS page,
  'Buyer ' || CAST(o_custkey AS VARCHAR) AS buyer, '' AS note, 'A|B' AS source,
  CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE CAST(o_orderkey % 10 AS VARCHAR) END AS cd,
  CASE WHEN o_orderkey % 5 = 0 THEN '0' ELSE 'r' || CAST(o_orderkey AS VARCHAR) END AS remark
FROM orders""",
    "valid_parcel_key": "SELECT * FROM assessments WHERE LENGTH(CAST(tmk AS VARCHAR)) = 13",
    "first_per_key": """
SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY tmk ORDER BY tax_rate_class, assessed_building_value,
  assessed_land_value, building_exemption) AS rn FROM assessments) WHERE rn = 1""",
    "largest_per_key": "SELECT * FROM main_cards",
    "bundle_dedupe": """
SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY saledate, price, recorddate, instruno, landcourt_no, cert_no ORDER BY tmk) AS rn FROM sales_clean) WHERE rn = 1""",
    "inflation_adjust": """
SELECT o.o_orderkey, YEAR(o_orderdate) AS year, CAST(FLOOR(o_totalprice) AS BIGINT) AS amount,
  CAST(ROUND(CAST(FLOOR(o_totalprice) AS BIGINT) / c.cpi * (SELECT cpi FROM cpi WHERE year = 2023)) AS BIGINT) AS adj_amount
FROM orders o LEFT JOIN cpi c ON YEAR(o_orderdate) = c.year""",
    "inflation_roundtrip": """
SELECT o_orderkey, year, adj_amount, CAST(ROUND(adj_amount / (SELECT cpi FROM cpi WHERE year = 2023) * cpi) AS BIGINT) AS amount
FROM (SELECT o_orderkey, YEAR(o_orderdate) AS year, c.cpi,
        CAST(ROUND(CAST(FLOOR(o_totalprice) AS BIGINT) / c.cpi * (SELECT cpi FROM cpi WHERE year = 2023)) AS BIGINT) AS adj_amount
      FROM orders LEFT JOIN cpi c ON YEAR(o_orderdate) = c.year)""",
    "zone_region": f"""
SELECT tmk, z AS zone_section, z IN (45, 46) AS is_lahaina, z BETWEEN 41 AND 48 AS is_west_maui,
  z BETWEEN 31 AND 38 AS is_central_maui, z BETWEEN 22 AND 29 AS is_upcountry, z IN (21, 39) AS is_south_maui,
  z BETWEEN 11 AND 19 AS is_east_maui, z BETWEEN 50 AND 59 AS is_molokai, z = 49 AS is_lanai, {region_of("tmk")} AS region
FROM (SELECT tmk, CAST(SUBSTRING(CAST(tmk AS VARCHAR), 2, 2) AS BIGINT) AS z FROM assessments
      WHERE LENGTH(CAST(tmk AS VARCHAR)) = 13)""",
    "tract_region": "SELECT year, CAST(tracta AS BIGINT) AS tracta, median_household_income, region FROM income_regions",
    "weighted_median_generic": """
SELECT flag, year, ARG_MIN(price, rn) AS price FROM (
  SELECT *, (running - w / 2) / total AS position, ROW_NUMBER() OVER (PARTITION BY flag, year ORDER BY price, w) AS rn FROM (
    SELECT l_returnflag AS flag, YEAR(l_shipdate) AS year, l_extendedprice AS price, l_quantity AS w,
      SUM(l_quantity) OVER (PARTITION BY l_returnflag, YEAR(l_shipdate)) AS total,
      SUM(l_quantity) OVER (PARTITION BY l_returnflag, YEAR(l_shipdate) ORDER BY l_extendedprice, l_quantity
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM lineitem))
WHERE position >= 0.5 GROUP BY flag, year""",
    "median_generic": """
SELECT CASE WHEN GROUPING(flag) = 1 THEN 'all' ELSE flag END AS flag, year, CAST(TRUNC(MEDIAN(price)) AS BIGINT) AS price,
  CAST(TRUNC(MEDIAN(quantity)) AS BIGINT) AS quantity, COUNT(*) AS count
FROM (SELECT l_returnflag AS flag, YEAR(l_shipdate) AS year, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS price,
        CAST(l_quantity AS BIGINT) AS quantity FROM lineitem)
GROUP BY GROUPING SETS ((flag, year), (year))""",
    "interpolate_generic": interpolated(
        "hourly_known", "hourly_reference", "hour", "event_type", "mean", "mean"
    ),
    "median_of_times": """
SELECT CASE WHEN GROUPING(event_type) = 1 THEN 'all' ELSE event_type END AS event_type,
  CAST(TRUNC(MEDIAN(EPOCH_US(ts))) AS BIGINT) AS micros, COUNT(*) AS rows
FROM events GROUP BY GROUPING SETS ((event_type), ())""",
    "weighted_median_of_times": """
SELECT users, ARG_MIN(micros, rn) AS micros FROM (
  SELECT *, (running - w / 2) / total AS position, ROW_NUMBER() OVER (PARTITION BY users ORDER BY micros, w) AS rn FROM (
    SELECT users, micros, w, SUM(w) OVER (PARTITION BY users) AS total,
      SUM(w) OVER (PARTITION BY users ORDER BY micros, w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
    FROM (SELECT CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE CAST(user_id % 5 AS VARCHAR) END AS users,
            EPOCH_US(ts) AS micros, (user_id % 8) / 8 AS w FROM events)))
WHERE position >= 0.5 GROUP BY users""",
    "interpolate_segments": interpolated(
        "hourly_known", "hourly_reference", "hour", "event_type", "mean", "mean"
    ),
    "csv_files_by_name": """
, file1 AS (SELECT o_orderkey % 13 = 0 AS short, o_orderkey AS order_key,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(FLOOR(o_totalprice) AS BIGINT) END AS total_price,
    STRFTIME(o_orderdate, '%Y-%m-%d') AS order_date, o_orderpriority || ', "x"' AS priority FROM orders)
SELECT order_key, total_price, CASE WHEN NOT short THEN order_date END AS order_date,
  CASE WHEN NOT short THEN priority END AS priority FROM file1
UNION ALL SELECT order_key, CASE WHEN NOT short THEN total_price END,
  CASE WHEN NOT short THEN order_date END, priority FROM file1""",
    "complex_names": """
, listed AS ({complexes}),
moved AS (SELECT DISTINCT {moved} AS tmk FROM assessments)
SELECT tmk, name IS NOT NULL AS is_special, name AS complex_name FROM moved
LEFT JOIN listed ON CAST(SUBSTRING(CAST(tmk AS VARCHAR), 2, 8) AS BIGINT) = code
WHERE LENGTH(CAST(tmk AS VARCHAR)) = 13""",
    "dense_grid_generic": """
, counts AS (SELECT n_name AS nation, o_orderpriority AS priority, YEAR(o_orderdate) AS year, COUNT(*) AS orders
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3)
SELECT nation, priority, year, COALESCE(orders, 0) AS orders
FROM (SELECT DISTINCT nation FROM counts) CROSS JOIN (SELECT DISTINCT priority FROM counts)
  CROSS JOIN (SELECT DISTINCT year FROM counts) LEFT JOIN counts USING (nation, priority, year)""",
    "owner_rollup": """
SELECT tmk, MAX(mailing_zip1) AS mailing_zip, COALESCE(BOOL_OR(mailing_zip1 IN (96708, 96713, 96729, 96732, 96733, 96742,
  96748, 96753, 96757, 96761, 96763, 96767, 96768, 96770, 96779, 96784, 96788, 96790, 96793)), FALSE) AS is_maui_owner
FROM owners GROUP BY tmk""",
    "ppsf_resident": """
SELECT tmk, tax_rate_class, sf_of_living_area, assessed_building_value,
  CASE WHEN sf_of_living_area > 0 THEN ROUND(CAST(assessed_building_value AS DOUBLE) / sf_of_living_area) END AS ppsf,
  CASE WHEN tax_rate_class IN ('owner-occupied', 'long-term-rental') THEN 'Resident' ELSE 'Non-Resident' END AS resident_type
FROM base""",
    "parcel_enriched": f"""
, pairs AS (
  SELECT a.tmk, a.tax_rate_class, p.assessed_building_value, p.assessed_land_value, p.building_exemption,
    c.sf_of_living_area, c.year_built, c.bed_rooms, c.is_condo, c.home_type, o.mailing_zip, o.is_maui_owner,
    CASE WHEN c.sf_of_living_area > 0 THEN ROUND(CAST(p.assessed_building_value AS DOUBLE) / c.sf_of_living_area) END AS ppsf,
    ROW_NUMBER() OVER (PARTITION BY a.tmk ORDER BY a.tax_rate_class, p.assessed_building_value NULLS FIRST,
      p.assessed_land_value NULLS FIRST, p.building_exemption NULLS FIRST, c.sf_of_living_area DESC NULLS FIRST,
      c.year_built NULLS FIRST, c.bed_rooms NULLS FIRST, c.is_condo NULLS FIRST) AS rn
  FROM assessments a
  LEFT JOIN (SELECT * FROM prior_assessments WHERE LENGTH(CAST(tmk AS VARCHAR)) = 13) p ON a.tmk = p.tmk
  JOIN cards c ON a.tmk = c.tmk
  LEFT JOIN ({{owner_rollup}}) o ON a.tmk = o.tmk
  WHERE LENGTH(CAST(a.tmk AS VARCHAR)) = 13 AND a.tax_rate_class IN {RESIDENTIAL})
SELECT tmk, ARG_MIN(tax_rate_class, rn) AS tax_rate_class, MAX(sf_of_living_area) AS sf_of_living_area, MAX(ppsf) AS ppsf,
  BOOL_OR(is_maui_owner) AS is_maui_owner, {{firsts}}, {region_of("tmk")} AS region,
  CAST(SUBSTRING(CAST(tmk AS VARCHAR), 2, 2) AS BIGINT) AS zone_section,
  CASE WHEN ARG_MIN(tax_rate_class, rn) IN ('owner-occupied', 'long-term-rental') THEN 'Resident' ELSE 'Non-Resident' END
    AS resident_type
FROM pairs GROUP BY tmk""",
    "csv_normalised_roundtrip": """
SELECT o_orderkey AS order_key, o_orderstatus AS order_status, o_totalprice AS "total_price_(usd)",
  o_orderpriority AS priority, SUBSTRING(CAST(o_orderdate AS VARCHAR), 1, 10) AS order_date
FROM orders""",
}


def _shares() -> str:
    conditions = {
        "pct_0br": "bed_rooms = 0",
        "pct_1br": "bed_rooms = 1",
        "pct_2br": "bed_rooms = 2",
        "pct_3br": "bed_rooms = 3",
        "pct_oo": "tax_rate_class = 'owner-occupied'",
        "pct_ltr": "tax_rate_class = 'long-term-rental'",
        "pct_noo": "tax_rate_class = 'non-owner-occupied'",
        "pct_tvr": "tax_rate_class = 'tvr-strh'",
    }
    return ",\n  ".join(
        f"ROUND(CAST(NULLIF(COUNT(*) FILTER ({c}), 0) AS DOUBLE) / COUNT(label) * 100, 1) AS {name}"
        for name, c in conditions.items()
    )


def _firsts() -> str:
    # MIN over the row of rank 1, because ARG_MIN would pass over a null value.
    names = [
        "assessed_building_value", "assessed_land_value", "building_exemption", "year_built",
        "bed_rooms", "is_condo", "home_type", "mailing_zip",
    ]
    return ", ".join(f"MIN({n}) FILTER (rn = 1) AS {n}" for n in names)


def moved_into_complexes() -> str:
    codes = ", ".join(str(code) for code in sorted(SPECIAL_COMPLEXES))
    sub = "tmk // 10000 % 100000000"
    code = f"CAST([{codes}][{sub} % {len(SPECIAL_COMPLEXES)} + 1] AS BIGINT)"
    return (
        f"CASE WHEN LENGTH(CAST(tmk AS VARCHAR)) = 13 AND {sub} % 3 <> 0"
        f" THEN 2000000000000 + {code} * 10000 + tmk % 10000 ELSE tmk END"
    )


def profile_in_complexes() -> str:
    """The profile of condominiums over parcels moved into the built-in complexes."""
    views = dict(VIEWS)
    for name in ("assessments", "dwellings"):
        views[name] = f"SELECT * REPLACE ({moved_into_complexes()} AS tmk) FROM ({VIEWS[name]})"
    rows = ", ".join(f"({code})" for code in SPECIAL_COMPLEXES)
    views["special_complexes"] = f"SELECT * FROM (VALUES {rows}) AS t(tmk_sub)"
    return with_views(BODIES["condo_profile"].replace("{shares}", _shares()), views)


def complexes() -> str:
    rows = ", ".join("({}, '{}')".format(code, name.replace("'", "''")) for code, name in SPECIAL_COMPLEXES.items())
    return f"SELECT * FROM (VALUES {rows}) AS t(code, name)"


#: Columns whose values are texts or fractions; all others are whole numbers.
TEXTS = {
    "assessments": ["tax_rate_class"],
    "dwellings": ["building_grade"],
    "owners": [
        "owner", "owner_type", "mailing_street_address", "mailing_city_state_zip",
        "mailing_city_name", "mailing_state", "country",
    ],
    "sales": [
        "saledate", "recorddate", "instruno", "seller", "buyer", "note", "source", "remark",
    ],
}
FRACTIONS = {"dwellings": ["percent_complete"]}


def ingested(kind: str) -> str:
    """The fields of an extract in the types that all their values have."""
    doubles = FRACTIONS.get(kind, [])
    others = ", ".join([*TEXTS[kind], *doubles])
    kept = "".join(f", {c}" for c in TEXTS[kind]) + "".join(f", CAST({c} AS DOUBLE) AS {c}" for c in doubles)
    whole = f"CAST(NULLIF(COLUMNS(* EXCLUDE ({others})), '') AS BIGINT)"
    return f"SELECT {whole}{kept} FROM ({BODIES[f'fixed_width_{kind}']})"


def oracle_sql() -> dict[str, str]:
    result = {}
    for name, body in BODIES.items():
        body = body.replace("{shares}", _shares()).replace("{firsts}", _firsts())
        body = body.replace("{owner_rollup}", BODIES["owner_rollup"])
        body = body.replace("{moved}", moved_into_complexes()).replace("{complexes}", complexes())
        result[name] = with_views(body)
    result["condo_profile_built_in"] = profile_in_complexes()
    for name in ("price_to_income", "affordable_sales"):
        result[f"{name}_from_files"] = result[name]
    for kind in TEXTS:
        result[f"ingest_{kind}"] = with_views(ingested(kind))
    return result
