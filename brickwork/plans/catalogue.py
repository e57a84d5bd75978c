"""The registered queries of the listings engine, and the SQL each is compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickwork.config import MatchConfig, ModelConfig, QualityLimits
from brickwork.functions import documents, text
from brickwork.functions.geo import haversine
from brickwork.operators import aggregates, analysis, audit, matching, model, resolve, silver, vectors
from brickwork.plans import cases
from brickwork.plans import listing_view as lv
from brickwork.sources import tables

QUERIES: dict = {**cases.QUERIES}
ORACLES: dict[str, str] = {**cases.ORACLES}


def query(sql: str | None):
    """Registers a query under its function's name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(f"""WITH {lv.SQL}, p AS (SELECT *, price_egp / area_m2 AS m2 FROM lv WHERE price_egp <> 0 AND area_m2 <> 0),
b AS (SELECT quantile_cont(m2, 0.01) AS lo, quantile_cont(m2, 0.99) AS hi FROM p)
SELECT city, neighbourhood, count(*) AS n, sum(CASE WHEN m2 < lo OR m2 > hi THEN 1 ELSE 0 END) AS outliers, round(avg(m2), 4) AS avg_m2 FROM p, b GROUP BY city, neighbourhood""")
def price_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = aggregates.price_outliers(lv.listings(spark, sf_dir), "price_egp")
    return rows.where("price_per_m2 IS NOT NULL").groupBy("city", "neighbourhood").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_outlier").alias("outliers"), F.round(F.avg("price_per_m2"), 4).alias("avg_m2"))


@query("""WITH i AS (SELECT user_id, CAST(ts AS DATE) AS day, event_id, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) AS r FROM events WHERE event_id % 2 = 1),
e AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_id % 2 = 0)
SELECT i.user_id, i.day, i.event_id FROM i WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM e WHERE e.user_id = i.user_id AND e.day = i.day)""")
def bronze_insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "event_id")
    return tables.absent(e.where("event_id % 2 = 1"), e.where("event_id % 2 = 0"), ["user_id", "day"], [F.asc("event_id")])


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events) WHERE r = 1")
def silver_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.latest(_read(spark, sf_dir, "events"), "user_id", "ts", ["event_id"]).select("user_id", "event_id", "event_type", "value")


@query("""WITH e AS (SELECT *, event_id % 2 AS half FROM events), h AS (SELECT *, row_number() OVER (PARTITION BY half, user_id ORDER BY ts DESC, event_id) AS r FROM e)
SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, half) AS k FROM h WHERE r = 1) WHERE k = 1""")
def silver_conditional_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events").select("user_id", "event_id", "value", "ts")
    halves = [silver.latest(e.where(F.col("event_id") % 2 == i), "user_id", "ts", ["event_id"]) for i in (0, 1)]
    return tables.newest(halves[0], halves[1], ["user_id"], "ts", []).drop("ts")


@query("""SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 2 DESC, ts DESC, event_id) AS k FROM events) WHERE k = 1""")
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events").select("user_id", "event_id", "value", "ts")
    halves = [silver.latest(e.where(F.col("event_id") % 2 == i), "user_id", "ts", ["event_id"]) for i in (0, 1)]
    return tables.upserted(halves[0], halves[1], ["user_id"]).drop("ts")


@query("""SELECT o_orderkey, CASE WHEN n IS NULL THEN o_totalprice ELSE n END AS o_totalprice FROM orders LEFT JOIN (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) ON l_orderkey = o_orderkey""")
def bulk_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = _read(spark, sf_dir, "lineitem").where("l_returnflag = 'A'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.round(F.sum("l_extendedprice"), 2).alias("o_totalprice"))
    return tables.updated(_read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), new, "o_orderkey", ["o_totalprice"])


_LIMITS = QualityLimits(price_low=2000, price_high=60000, area_high=45, rooms_high=4)


@query(f"""WITH {lv.SQL} SELECT reason, count(*) AS n FROM (SELECT CASE WHEN price_egp < 2000 THEN 'price_suspiciously_low' WHEN price_egp > 60000 THEN 'price_suspiciously_high' WHEN area_m2 > 45 THEN 'area_suspiciously_large'
WHEN rooms > 4 THEN 'rooms_suspiciously_high' WHEN NOT (lat BETWEEN 22.0 AND 31.7 AND lng BETWEEN 24.7 AND 36.9) THEN 'coordinates_outside_egypt' END AS reason FROM lv) GROUP BY reason""")
def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lv.listings(spark, sf_dir).select(silver.rejection_reason(_LIMITS).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.locations(lv.listings(spark, sf_dir), spark.createDataFrame([], "id bigint, city string, neighbourhood string, province string"))


@query(f"WITH {lv.SQL}, {lv.LOCATION_SQL} SELECT id, city, neighbourhood, province FROM loc")
def location_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dim(spark, sf_dir)


@query(f"WITH {lv.SQL}, {lv.LOCATION_SQL} SELECT loc.id AS location_id, count(*) AS n, round(sum(area_m2), 2) AS area FROM lv JOIN loc ON lv.city = loc.city AND lv.neighbourhood IS NOT DISTINCT FROM loc.neighbourhood GROUP BY loc.id")
def location_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.located(lv.listings(spark, sf_dir), _dim(spark, sf_dir)).groupBy("location_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("area_m2"), 2).alias("area"))


_GROUPS = f"""WITH {lv.LATEST_SQL}, {lv.LOCATION_SQL}, h AS (SELECT ad.*, loc.id AS location_id FROM ad JOIN loc ON ad.city = loc.city AND ad.neighbourhood IS NOT DISTINCT FROM loc.neighbourhood),
g AS (SELECT row_number() OVER (ORDER BY location_id, property_type, rooms) AS id, * FROM (SELECT DISTINCT location_id, property_type, rooms FROM h))"""


def _groups(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    here = resolve.located(lv.latest(spark, sf_dir), _dim(spark, sf_dir))
    return here, analysis.groups(here, spark.createDataFrame([], "id bigint, location_id bigint, property_type string, rooms double"))


@query(_GROUPS + " SELECT id, location_id, property_type, rooms FROM g")
def analysis_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _groups(spark, sf_dir)[1]


@query(_GROUPS + " SELECT external_id, g.id AS analysis_property_id, 1.0::DOUBLE AS confidence, CASE WHEN g.id > 100 THEN 'new' ELSE 'scored_match' END AS method FROM h JOIN g USING (location_id, property_type, rooms)")
def analysis_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    here, groups = _groups(spark, sf_dir)
    return analysis.matches(here, groups, 100, "run").drop("run_id")


_SIGNALS = """s AS (SELECT *, CASE WHEN t LIKE '%roof%' THEN 'roof' WHEN t LIKE '%garden%' THEN 'garden' WHEN t LIKE '%ground floor%' THEN 'ground' END AS floor_type, CASE WHEN t LIKE '%sea view%' THEN 'sea' END AS view_type,
nullif(regexp_extract(t, 'phase\\s*(\\w+)', 1), '') AS phase, upper(nullif(regexp_extract(t, '(^|[^a-zA-Z0-9])([a-zA-Z][0-9]{1,3})([^a-zA-Z0-9]|$)', 2), '')) AS building,
t LIKE '%garden%' AS has_garden, t LIKE '%ground floor%' AS is_ground FROM (SELECT *, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) AS t FROM ad))"""
_ALL = ["floor_type", "view_type", "phase", "building", "has_garden", "is_ground"]


def _signalled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.with_signals(lv.latest(spark, sf_dir))


@query(f"WITH {lv.LATEST_SQL}, {_SIGNALS} SELECT floor_type, view_type, phase, building, has_garden, is_ground, count(*) AS n FROM s GROUP BY ALL")
def title_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signalled(spark, sf_dir).groupBy(*_ALL).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {lv.LATEST_SQL}, {_SIGNALS} SELECT property_id, coalesce(array_to_string(list_sort(list_distinct(list(building))), ','), '') AS buildings, coalesce(array_to_string(list_sort(list_distinct(list(phase))), ','), '') AS phases,
bool_or(has_garden) AS has_garden, bool_or(is_ground) AS is_ground FROM s GROUP BY property_id""")
def signals_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = resolve.signal_sets(_signalled(spark, sf_dir), "property_id")
    return sets.select("property_id", F.array_join("c_buildings", ",").alias("buildings"), F.array_join("c_phases", ",").alias("phases"), F.col("c_garden").alias("has_garden"), F.col("c_ground").alias("is_ground"))



@query("""WITH s AS (SELECT s_suppkey, s_nationkey, CAST(22 AS DOUBLE) + CAST(s_suppkey * 37 % 970 AS DOUBLE) / 100 AS lat, CAST(24 AS DOUBLE) + CAST(s_suppkey * 53 % 1320 AS DOUBLE) / 100 AS lng FROM supplier)
SELECT a.s_suppkey AS a, b.s_suppkey AS b, round(2 * 6371000.0 * asin(sqrt(least(1.0, sin(radians(b.lat - a.lat) / 2) * sin(radians(b.lat - a.lat) / 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * sin(radians(b.lng - a.lng) / 2) * sin(radians(b.lng - a.lng) / 2)))), 2) AS metres
FROM s a JOIN s b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey""")
def haversine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    s = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", (F.lit(22.0) + (key * 37 % 970).cast("double") / 100).alias("lat"), (F.lit(24.0) + (key * 53 % 1320).cast("double") / 100).alias("lng"))
    a, b = s.alias("a"), s.alias("b")
    return a.join(b, (F.col("a.s_nationkey") == F.col("b.s_nationkey")) & (F.col("a.s_suppkey") < F.col("b.s_suppkey"))).select(F.col("a.s_suppkey").alias("a"), F.col("b.s_suppkey").alias("b"), F.round(haversine(F.col("a.lat"), F.col("a.lng"), F.col("b.lat"), F.col("b.lng")), 2).alias("metres"))


_PAIRS = f"""WITH {lv.LATEST_SQL}, {_SIGNALS}, d AS (SELECT a.external_id AS external_id, c.external_id AS candidate, a.area_m2 AS area, c.area_m2 AS c_area, a.price_egp AS price, c.price_egp AS c_price, a.floor_type AS f, c.floor_type AS cf, a.view_type AS v, c.view_type AS cv, a.phase AS ph, c.phase AS cph, a.building AS bu, c.building AS cbu,
2 * 6371000.0 * asin(sqrt(least(1.0, sin(radians(c.lat - a.lat) / 2) * sin(radians(c.lat - a.lat) / 2) + cos(radians(a.lat)) * cos(radians(c.lat)) * sin(radians(c.lng - a.lng) / 2) * sin(radians(c.lng - a.lng) / 2)))) AS dist
FROM s a JOIN s c ON a.property_id = c.property_id AND a.external_id > c.external_id),
e AS (SELECT *, CASE WHEN greatest(area, c_area) <= 100 THEN 0.05::DOUBLE ELSE 0.03::DOUBLE END AS tol, abs(area - c_area) / greatest(c_area, 1.0) AS ag, abs(price - c_price) / greatest(price, c_price) AS pg FROM d),
r AS (SELECT *, CASE WHEN ag > tol THEN 'area' WHEN pg > 0.5 THEN 'price' WHEN f <> cf OR ph <> cph OR bu <> cbu THEN 'title' WHEN dist > 1000 THEN 'distance' WHEN dist < 5 AND ph IS NULL AND bu IS NULL THEN 'same_pin' END AS reject FROM e),
q AS (SELECT external_id, candidate, reject, CASE WHEN reject IS NULL THEN (40 + 20 * greatest(0.0, 1 - ag / tol) + 10 * greatest(0.0, 1 - dist / 50) + 15 * greatest(0.0, 1 - pg / 0.15::DOUBLE) + 15 * CASE WHEN v <> cv THEN 0.4 ELSE 1.0 END) / 100 END AS confidence FROM r)"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ads = _signalled(spark, sf_dir)
    empty = F.array().cast("array<string>")
    one = lambda c: F.when(F.col(c).isNull(), empty).otherwise(F.array(c))
    cand = ads.select(F.col("property_id").alias("c_id"), F.col("external_id").alias("candidate"), F.col("property_type").alias("c_property_type"), F.col("rooms").alias("c_rooms"), F.col("area_m2").alias("c_area_m2"), F.col("lat").alias("c_lat"), F.col("lng").alias("c_lng"), F.col("price_egp").alias("c_price_egp"), one("floor_type").alias("c_floors"), one("view_type").alias("c_views"), one("phase").alias("c_phases"), one("building").alias("c_buildings"), F.col("has_garden").alias("c_garden"), F.col("is_ground").alias("c_ground"))
    return ads.join(cand, (ads["property_id"] == cand["c_id"]) & (ads["external_id"] > cand["candidate"]))


@query(_PAIRS + " SELECT external_id, candidate, reject, round(confidence, 5) AS confidence FROM q")
def score_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.scored(_pairs(spark, sf_dir)).select("external_id", "candidate", "reject", F.round("confidence", 5).alias("confidence"))


@query(_PAIRS + ", k AS (SELECT *, row_number() OVER (PARTITION BY external_id ORDER BY confidence DESC, candidate) AS n FROM q WHERE confidence >= 0.6) SELECT external_id, candidate, round(confidence, 5) AS confidence FROM k WHERE n = 1")
def best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.best(_pairs(spark, sf_dir), "external_id", "candidate", MatchConfig(threshold=0.6)).select("external_id", "candidate", F.round("confidence", 5).alias("confidence"))


_RESOLVE = f"""WITH RECURSIVE {lv.LATEST_SQL}, {lv.LOCATION_SQL}, {_SIGNALS},
a AS (SELECT s.*, loc.id AS location_id, row_number() OVER (PARTITION BY loc.id, property_type, rooms ORDER BY scraped_at, external_id) AS k FROM s JOIN loc ON s.city = loc.city AND s.neighbourhood IS NOT DISTINCT FROM loc.neighbourhood),
r AS (SELECT location_id, property_type, rooms, k, [struct_pack(o := external_id, m2 := area_m2, la := lat, ln := lng, pr := price_egp, f := [floor_type], v := [view_type], p := [phase], b := [building])] AS props, external_id, external_id AS founder, 1.0::DOUBLE AS confidence, 'new' AS method FROM a WHERE k = 1
UNION ALL
SELECT location_id, property_type, rooms, k,
  CASE WHEN best >= 0.8 THEN list_transform(props, lambda x, i: CASE WHEN i = spot THEN struct_pack(o := x.o, m2 := x.m2, la := x.la, ln := x.ln, pr := x.pr, f := list_append(x.f, floor_type), v := list_append(x.v, view_type), p := list_append(x.p, phase), b := list_append(x.b, building)) ELSE x END)
    ELSE list_append(props, struct_pack(o := external_id, m2 := area_m2, la := lat, ln := lng, pr := price_egp, f := [floor_type], v := [view_type], p := [phase], b := [building])) END,
  external_id, CASE WHEN best >= 0.8 THEN props[spot].o ELSE external_id END, CASE WHEN best >= 0.8 THEN best ELSE 1.0 END, CASE WHEN best >= 0.8 THEN 'scored_match' ELSE 'new' END
FROM (SELECT *, list_max(scores) AS best, list_position(scores, list_max(scores)) AS spot FROM (
  SELECT a.*, r.props, list_transform(r.props, lambda x: CASE
    WHEN abs(a.area_m2 - x.m2) / greatest(x.m2, 1.0) > 0.05::DOUBLE OR abs(a.price_egp - x.pr) / greatest(a.price_egp, x.pr) > 0.5 THEN 0.0
    WHEN (list_count(x.f) > 0 AND a.floor_type IS NOT NULL AND NOT list_contains(x.f, a.floor_type)) OR (list_count(x.p) > 0 AND a.phase IS NOT NULL AND NOT list_contains(x.p, a.phase)) OR (list_count(x.b) > 0 AND a.building IS NOT NULL AND NOT list_contains(x.b, a.building)) THEN 0.0
    WHEN METRES > 1000 OR (METRES < 5 AND a.phase IS NULL AND a.building IS NULL) THEN 0.0
    ELSE (25.0 + 15.0 + 20.0 * greatest(0.0, 1 - abs(a.area_m2 - x.m2) / greatest(x.m2, 1.0) / 0.05::DOUBLE) + 10.0 * greatest(0.0, 1 - METRES / 50) + 15.0 * greatest(0.0, 1 - abs(a.price_egp - x.pr) / greatest(a.price_egp, x.pr) / 0.15::DOUBLE)
      + 15.0 * CASE WHEN list_count(x.v) > 0 AND a.view_type IS NOT NULL AND NOT list_contains(x.v, a.view_type) THEN 0.4 ELSE 1.0 END) / 100 END::DOUBLE) AS scores
  FROM r JOIN a ON a.location_id = r.location_id AND a.property_type = r.property_type AND a.rooms = r.rooms AND a.k = r.k + 1) q) t)
SELECT external_id, CAST(NULL AS BIGINT) AS property_id, founder, round(confidence, 6) AS confidence, method FROM r"""
_METRES = "(2 * 6371000.0 * asin(sqrt(least(1.0, sin(radians(x.la - a.lat) / 2) * sin(radians(x.la - a.lat) / 2) + cos(radians(a.lat)) * cos(radians(x.la)) * sin(radians(x.ln - a.lng) / 2) * sin(radians(x.ln - a.lng) / 2)))))"


@query(_RESOLVE.replace("METRES", _METRES))
def resolve_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    ads = resolve.located(lv.latest(spark, sf_dir), _dim(spark, sf_dir))
    none = spark.createDataFrame([], "property_id bigint, location_id bigint, property_type string, rooms double, area_m2 double, c_lat double, c_lng double, c_price_egp double, c_floors array<string>, c_views array<string>, c_phases array<string>, c_buildings array<string>, c_garden boolean, c_ground boolean")
    return resolve.matched(resolve.with_signals(ads), none).withColumn("confidence", F.round("confidence", 6))


@query(f"""WITH {lv.LATEST_SQL}, {_SIGNALS}, g AS (SELECT property_id, coalesce(building, '') AS g_building, coalesce(phase, '') AS g_phase, count(*) AS n, min(external_id) AS f FROM s GROUP BY ALL)
SELECT property_id, g_building, g_phase, n, CAST(row_number() OVER (PARTITION BY property_id ORDER BY n DESC, f) AS INTEGER) AS group_rank FROM g""")
def split_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resolve.split_groups(_signalled(spark, sf_dir).select("property_id", "external_id", *_ALL))
    return rows.groupBy("property_id", "g_building", "g_phase", "group_rank").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey AS external_id FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def stale_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = _read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("external_id"))
    return resolve.stale(_read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("external_id")), seen)


@query("SELECT user_id, event_id, ts, value FROM (SELECT *, round(value) AS v, lag(round(value)) OVER w AS p, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, round(value))) WHERE n = 1 OR v IS DISTINCT FROM p")
def price_history_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events").withColumn("rounded", F.round("value"))
    return resolve.price_changes(e, "user_id", "ts", "rounded").select("user_id", "event_id", "ts", "value")


@query(f"WITH {lv.LATEST_SQL} SELECT property_id, min(CASE WHEN status = 'active' AND price_egp <> 0 THEN price_egp END) AS current_price_egp FROM ad GROUP BY property_id")
def min_active_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.min_active_price(lv.latest(spark, sf_dir).withColumnRenamed("price_egp", "current_price_egp"))


_STORE = f"""WITH {lv.LATEST_SQL}, {lv.LOCATION_SQL}, h AS (SELECT ad.*, loc.id AS location_id FROM ad JOIN loc ON ad.city = loc.city AND ad.neighbourhood IS NOT DISTINCT FROM loc.neighbourhood),
p AS (SELECT property_id, min(location_id) AS location_id, min(property_type) AS property_type, min(rooms) AS rooms, min(area_m2) AS area_m2, min(CASE WHEN status = 'active' THEN price_egp END) AS price FROM h GROUP BY property_id),
m AS (SELECT *, CASE WHEN price <> 0 AND area_m2 <> 0 THEN price / area_m2 END AS m2 FROM p), v AS (SELECT location_id, avg(m2) AS a FROM m GROUP BY location_id),
l AS (SELECT property_id, count(*) AS k, min(scraped_at) AS f FROM h WHERE status = 'active' AND price_egp <> 0 GROUP BY property_id),
t AS (SELECT property_id, title FROM (SELECT *, row_number() OVER (PARTITION BY property_id ORDER BY scraped_at DESC, external_id) AS r FROM h WHERE status = 'active' AND price_egp <> 0) WHERE r = 1)"""


def _store(spark: SparkSession, sf_dir: str) -> DataFrame:
    ads = tables.checkpoint(resolve.located(lv.latest(spark, sf_dir), dim := tables.checkpoint(_dim(spark, sf_dir))).withColumn("current_price_egp", F.col("price_egp")).withColumn("first_seen_at", F.col("scraped_at")).withColumn("last_seen_at", F.col("scraped_at")))
    for c in ("url", "furnishing_status", "completion_status", "agency_name"):
        ads = ads.withColumn(c, F.lit(None).cast("string"))
    ads = ads.withColumn("photo_count", F.lit(0))
    price = aggregates.min_active_price(ads)
    props = ads.groupBy("property_id").agg(*[F.min(c).alias(c) for c in ("location_id", "property_type", "rooms", "area_m2", "baths")]).join(price, "property_id").withColumnRenamed("property_id", "id")
    return aggregates.feature_store(aggregates.price_outliers(props), ads, dim, F.lit("1999-01-01 12:00:00").cast("timestamp"))


@query(_STORE + """ SELECT m.property_id, property_type, rooms, area_m2, city, neighbourhood, province, price AS price_egp, round(m2, 4) AS price_per_m2, title AS representative_title, CAST(coalesce(k, 0) AS INTEGER) AS active_listing_count,
round(a, 4) AS neighbourhood_avg_price_per_m2, CAST(floor(date_diff('second', f, TIMESTAMP '1999-01-01 12:00:00') / 86400) AS INTEGER) AS days_on_market FROM m LEFT JOIN v USING (location_id) LEFT JOIN l USING (property_id) LEFT JOIN t USING (property_id) LEFT JOIN loc ON loc.id = m.location_id""")
def feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _store(spark, sf_dir)
    return rows.select("property_id", "property_type", "rooms", "area_m2", "city", "neighbourhood", "province", "price_egp", F.round("price_per_m2", 4).alias("price_per_m2"), "representative_title", "active_listing_count", F.round("neighbourhood_avg_price_per_m2", 4).alias("neighbourhood_avg_price_per_m2"), "days_on_market")


@query(f"""WITH {lv.SQL} SELECT k AS dedup_key, count(*) AS n FROM (SELECT concat_ws('|', coalesce(city, ''), coalesce(neighbourhood, ''), coalesce(property_type, ''), CASE WHEN rooms <> 0 THEN CAST(rooms AS VARCHAR) ELSE '' END, CAST(CAST(round_even(area_m2 / 10, 0) * 10 AS BIGINT) AS VARCHAR)) AS k FROM lv) GROUP BY k""")
def dedup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lv.listings(spark, sf_dir).select(documents.dedup_key().alias("dedup_key")).groupBy("dedup_key").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {lv.LATEST_SQL} SELECT external_id, concat(property_type, CASE WHEN rooms <> 0 THEN ' with ' || CAST(CAST(rooms AS BIGINT) AS VARCHAR) || ' rooms' ELSE '' END, ' and ', CAST(CAST(baths AS BIGINT) AS VARCHAR), ' bathrooms, ', CAST(CAST(area_m2 AS BIGINT) AS VARCHAR), ' square meters. Located in ',
concat_ws(', ', neighbourhood, city, province), '. Status: Semi-Furnished furnishing. Listed by Agency. On market for 14 days. URL: http://x/', external_id) AS document FROM ad""")
def document_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lv.latest(spark, sf_dir)
    for c, v in (("furnishing_status", "semi-furnished"), ("completion_status", None), ("agency_name", "Agency"), ("representative_title", None)):
        rows = rows.withColumn(c, F.lit(v).cast("string"))
    rows = rows.withColumn("url", F.concat(F.lit("http://x/"), "external_id")).withColumn("days_on_market", F.lit(14)).withColumn("is_outlier", F.lit(False))
    rows = rows.withColumn("price_egp", F.lit(None).cast("double")).withColumn("price_per_m2", F.lit(None).cast("double")).withColumn("neighbourhood_avg_price_per_m2", F.lit(None).cast("double"))
    return rows.select("external_id", documents.document().alias("document"))


@query("SELECT o_orderkey AS property_id FROM orders WHERE NOT (o_orderkey % 3 = 0) OR (o_orderkey % 5 - 2) < 0")
def changed_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("property_id"), F.col("o_orderdate").alias("computed_at"))
    v = o.where("property_id % 3 = 0").select("property_id", F.expr("timestampadd(DAY, CAST(property_id % 5 - 2 AS INT), computed_at)").alias("embedded_at"))
    return vectors.changed(o, v).select("property_id")


def _probe(spark: SparkSession, sf_dir: str) -> list[float]:
    return list(_read(spark, sf_dir, "embeddings").where("vec_id = 0").first()["embedding"])


_COSINE = "WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 0), s AS (SELECT vec_id, label, list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(e AS DOUBLE[])) AS score FROM embeddings, q)"


@query(_COSINE + " SELECT vec_id, round(score, 6) AS score FROM s ORDER BY s.score DESC, vec_id LIMIT 10")
def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_k(_read(spark, sf_dir, "embeddings"), _probe(spark, sf_dir), 10).select("vec_id", F.round("score", 6).alias("score"))


@query(_COSINE + ", d AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS n FROM s) SELECT vec_id, label, round(score, 6) AS score FROM d WHERE n = 1 ORDER BY d.score DESC, vec_id LIMIT 5")
def cosine_topk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_k(_read(spark, sf_dir, "embeddings"), _probe(spark, sf_dir), 5, by="label").select("vec_id", "label", F.round("score", 6).alias("score"))


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lv.latest(spark, sf_dir).withColumn("price_per_m2", F.col("price_egp") / F.col("area_m2")).withColumn("active_listing_count", (F.col("property_id") % 7 + 1).cast("int")).withColumn("is_outlier", F.col("property_id") % 50 == 0)
    return rows.withColumn("rooms", F.when(F.col("property_id") % 11 != 0, F.col("rooms")))


_TRAIN = f"""WITH {lv.LATEST_SQL}, r AS (SELECT external_id, property_id, property_type, city, neighbourhood, CASE WHEN property_id % 11 <> 0 THEN rooms END AS rooms, baths, area_m2, price_egp, price_egp / area_m2 AS m2, property_id % 7 + 1 AS k FROM ad WHERE property_id % 50 <> 0 AND price_egp > 0),
b AS (SELECT property_type, quantile_cont(m2, 0.005) AS a1, quantile_cont(m2, 0.995) AS a2, quantile_cont(area_m2, 0.005) AS b1, quantile_cont(area_m2, 0.995) AS b2 FROM r GROUP BY 1),
c AS (SELECT r.* FROM r JOIN b USING (property_type) WHERE m2 BETWEEN a1 AND a2 AND area_m2 BETWEEN b1 AND b2)"""


@query(_TRAIN + " SELECT property_type, count(*) AS n, round(sum(price_egp), 1) AS total FROM c GROUP BY property_type")
def segment_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.clean(_training(spark, sf_dir)).groupBy("property_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("price_egp"), 1).alias("total"))


@query(_TRAIN + """, m AS (SELECT property_type, median(rooms) AS mr FROM c GROUP BY 1) SELECT external_id, coalesce(rooms, mr) AS rooms, coalesce(area_m2 / nullif(coalesce(rooms, mr), 0), area_m2) AS area_per_room, coalesce(baths / nullif(coalesce(rooms, mr), 0), 0) AS bath_to_room_ratio,
round(ln(1 + k), 6) AS active_listing_count_log, CASE WHEN neighbourhood IS NULL THEN 0 ELSE 1 END AS neighbourhood_is_known, coalesce(neighbourhood, 'Unknown') AS neighbourhood FROM c JOIN m USING (property_type)""")
def engineer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = model.clean(_training(spark, sf_dir))
    done = model.engineered(model.imputed(rows, *model.medians(rows)))
    return done.select("external_id", "rooms", "area_per_room", "bath_to_room_ratio", F.round("active_listing_count_log", 6).alias("active_listing_count_log"), "neighbourhood_is_known", "neighbourhood")


_STATS = _TRAIN + ", n AS (SELECT city, neighbourhood, avg(price_egp / area_m2) AS p, avg(k) AS k FROM c GROUP BY 1, 2), y AS (SELECT city, avg(p) AS p, avg(k) AS k FROM n GROUP BY 1), a AS (SELECT avg(p) AS p, avg(k) AS k FROM n)"


@query(_STATS + " SELECT city, neighbourhood, round(p, 4) AS price, round(k, 4) AS listings FROM n")
def neighbourhood_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = model.neighbourhood_stats(model.clean(_training(spark, sf_dir)))
    return s.select("city", "neighbourhood", F.round("neighbourhood_avg_price_per_m2", 4).alias("price"), F.round("active_listing_count", 4).alias("listings"))


@query(_STATS + " SELECT city, round(p, 4) AS price, round(k, 4) AS listings FROM y")
def city_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = model.city_stats(model.neighbourhood_stats(model.clean(_training(spark, sf_dir))))
    return s.select("city", F.round("city_avg", 4).alias("price"), F.round("city_count", 4).alias("listings"))


@query(_STATS + """, q AS (SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'Nowhere' ELSE n_name END AS city, CASE WHEN s_suppkey % 3 = 0 THEN 'Elsewhere' ELSE s_name END AS neighbourhood FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, round(coalesce(n.p, y.p, a.p), 4) AS price, round(coalesce(CASE WHEN n.p IS NULL THEN y.k ELSE n.k END, a.k), 4) AS listings FROM q LEFT JOIN n ON q.city = n.city AND q.neighbourhood IS NOT DISTINCT FROM n.neighbourhood LEFT JOIN y ON q.city = y.city, a""")
def fallback_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _read(spark, sf_dir, "supplier").join(_read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.when(F.col("s_suppkey") % 5 == 0, "Nowhere").otherwise(F.col("n_name")).alias("city"), F.when(F.col("s_suppkey") % 3 == 0, "Elsewhere").otherwise(F.col("s_name")).alias("neighbourhood"))
    out = model.with_market(q, tables.checkpoint(model.neighbourhood_stats(model.clean(_training(spark, sf_dir)))))
    return out.select("s_suppkey", F.round("neighbourhood_avg_price_per_m2", 4).alias("price"), F.round("active_listing_count", 4).alias("listings"))


@query(f"WITH {lv.LATEST_SQL}, g AS (SELECT property_id, count(*) AS n FROM ad GROUP BY 1) SELECT count(*) AS total, count_if(n = 1) AS single, count_if(n > 1) AS merged, CAST(sum(n) AS BIGINT) AS listings, round(avg(n), 6) AS mean, max(n) AS most FROM g")
def merge_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.merge_overview(lv.latest(spark, sf_dir)).withColumn("mean", F.round("mean", 6)).withColumn("total", F.col("total"))


@query(f"WITH {lv.LATEST_SQL} SELECT property_id, count(*) AS n FROM ad GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, property_id LIMIT 10")
def top_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.top_merged(lv.latest(spark, sf_dir))


@query(f"WITH {lv.LATEST_SQL} SELECT size, count(*) AS groups FROM (SELECT count(*) AS size FROM ad GROUP BY city, neighbourhood, property_type, rooms) GROUP BY size")
def group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.group_sizes(lv.latest(spark, sf_dir), ["city", "neighbourhood", "property_type", "rooms"])


@query(f"WITH {lv.SQL} SELECT neighbourhood, count(*) AS n FROM lv GROUP BY 1 ORDER BY n DESC, neighbourhood NULLS LAST LIMIT 15")
def most_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.most_common(lv.listings(spark, sf_dir), "neighbourhood", 15)


@query("SELECT 'orders' AS layer, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'supplier', count(*) FROM supplier")
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.layer_counts({t: _read(spark, sf_dir, t) for t in ("orders", "lineitem", "part", "supplier")})


@query(f"WITH {lv.SQL} SELECT 'city' AS name, count_if(city IS NULL) AS missing, count(DISTINCT city) AS different FROM lv UNION ALL SELECT 'neighbourhood', count_if(neighbourhood IS NULL), count(DISTINCT neighbourhood) FROM lv UNION ALL SELECT 'rooms', count_if(rooms IS NULL), count(DISTINCT rooms) FROM lv")
def missing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.missing(lv.listings(spark, sf_dir), ["city", "neighbourhood", "rooms"])


@query("SELECT CAST(CASE WHEN l_extendedprice < 0 THEN 0 WHEN l_extendedprice >= 120000 THEN 81 ELSE floor(l_extendedprice / 1500) + 1 END AS BIGINT) AS bin, count(*) AS n FROM lineitem GROUP BY 1")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.histogram(_read(spark, sf_dir, "lineitem"), "l_extendedprice", 0.0, 120000.0)


@query(f"WITH {lv.SQL} SELECT property_type, round(quantile_cont(price_egp / area_m2, 0.25), 4) AS q1, round(quantile_cont(price_egp / area_m2, 0.5), 4) AS q2, round(quantile_cont(price_egp / area_m2, 0.75), 4) AS q3 FROM lv GROUP BY 1")
def boxplot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audit.box(lv.listings(spark, sf_dir).withColumn("m2", F.col("price_egp") / F.col("area_m2")), "m2", "property_type")
    return rows.select("property_type", *[F.round(c, 4).alias(c) for c in ("q1", "q2", "q3")])


@query(None)
def train_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _training(spark, sf_dir).withColumn("computed_at", F.lit("")).withColumn("days_on_market", F.lit(1)).withColumn("neighbourhood_avg_price_per_m2", F.col("price_per_m2") * 0 + 2000.0).withColumn("property_id", F.col("property_id").cast("bigint"))
    fitted = model.train(rows, ModelConfig())
    return fitted.predict(rows.select("external_id", "property_type", "city", "neighbourhood", "rooms", "baths", "area_m2"))
