"""One deterministic listing view over the star schema, in Spark and as the SQL of the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


_SELECT = """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS external_id,
  l_partkey AS property_id, l_suppkey AS s_key, l_shipdate AS scraped_at, l_extendedprice AS price_egp,
  l_quantity AS area_m2, CAST(p_size % 6 AS DOUBLE) AS rooms, CAST(1 + p_size % 3 AS DOUBLE) AS baths,
  p_type AS property_type, n_name AS city, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_name END AS neighbourhood,
  r_name AS province, CAST(22 AS DOUBLE) + CAST(s_suppkey * 37 % 970 AS DOUBLE) / 100 AS lat,
  CAST(24 AS DOUBLE) + CAST(l_partkey * 53 % 1320 AS DOUBLE) / 100 AS lng,
  p_name || ' B' || CAST(l_suppkey % 20 AS STRING) || CASE l_partkey % 6 WHEN 0 THEN ' roof' WHEN 1 THEN ' garden'
    WHEN 2 THEN ' ground floor' WHEN 3 THEN ' sea view' WHEN 4 THEN ' phase 3' ELSE '' END AS title,
  CASE WHEN l_returnflag = 'R' THEN 'stale' ELSE 'active' END AS status
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey
  JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""
TABLES = ("lineitem", "part", "supplier", "nation", "region")

#: The ties of several scrapes of one advertisement.
TIES = ("property_id", "s_key", "price_egp")

SQL = "lv AS (" + _SELECT.format(**{t: t for t in TABLES}).replace("AS STRING", "AS VARCHAR") + ")"
LATEST_SQL = SQL + ", ad AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY external_id ORDER BY scraped_at DESC, property_id, s_key, price_egp) AS n_ FROM lv) WHERE n_ = 1)"
LOCATION_SQL = "loc AS (SELECT row_number() OVER (ORDER BY city NULLS FIRST, neighbourhood NULLS FIRST) AS id, city, neighbourhood, province FROM (SELECT city, neighbourhood, min(province) AS province FROM lv GROUP BY city, neighbourhood))"


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    return spark.sql(_SELECT, **frames)


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brickwork.operators.silver import latest as newest

    return newest(listings(spark, sf_dir), "external_id", "scraped_at", list(TIES))




