"""Queries over made-up cases that the star schema's listing view has not got: raw hits, Arabic titles, every gate and reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brickwork.functions import documents, text
from brickwork.operators import audit, matching, model, resolve, silver
from brickwork.plans import listing_view as lv
from brickwork.sources import tables

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return put


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _literal(x: object) -> str:
    return "NULL" if x is None else "TRUE" if x is True else "FALSE" if x is False else str(x) if isinstance(x, int | float) else "'" + str(x).replace("'", "''") + "'"


def _values(rows: list[tuple]) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(map(_literal, (i, *r))) + ")" for i, r in enumerate(rows)) + ")"


def _pick(rows: list[tuple], at: int, number: Column, kind: str) -> Column:
    """The at-th field of the row that number chooses."""
    return F.element_at(F.array(*[F.lit(r[at]).cast(kind) for r in rows]), (number % len(rows) + 1).cast("int"))


@query("""SELECT CASE WHEN o_orderkey % 5 = 0 THEN CAST(nullif(o_orderkey, 0) AS VARCHAR) ELSE 'e-' || o_orderkey END AS external_id, 'http://x/' || CASE WHEN o_orderkey % 5 = 0 THEN CAST(nullif(o_orderkey, 0) AS VARCHAR) ELSE 'e-' || o_orderkey END AS url,
'title ' || o_custkey AS title, o_totalprice AS price_egp, CAST(o_custkey % 6 AS DOUBLE) AS rooms, 'T' || (o_custkey % 6) AS property_type, 'c' || (o_custkey % 25) AS city, CASE WHEN o_custkey % 4 <> 0 THEN 'n' || (o_custkey % 97) END AS neighbourhood,
CAST(NULL AS VARCHAR) AS province, 30.5::DOUBLE AS lat, CASE WHEN o_orderkey % 7 = 0 THEN TIMESTAMP '2001-02-03 04:05:06' ELSE CAST(o_orderdate AS TIMESTAMP) END AS scraped_at FROM orders""")
def silver_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON lines of orders, parsed and flattened."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    named = lambda kind, name: F.struct(F.lit(kind).alias("type"), name.alias("name"))
    place = F.filter(F.array(named("city", F.concat(F.lit("c"), cust % 25)), named("neighbourhood", F.when(cust % 4 != 0, F.concat(F.lit("n"), cust % 97)))), lambda x: x["name"].isNotNull())
    stamp = F.when(key % 7 == 0, "no time").otherwise(F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss'Z'"))
    hit = F.struct(key.alias("id"), F.when(key % 5 == 0, "").otherwise(F.concat(F.lit("e-"), key)).alias("externalID"), F.concat(F.lit("title "), cust).alias("title"), F.col("o_totalprice").alias("price"), (cust % 6).cast("double").alias("rooms"), place.alias("location"), F.array(F.struct(F.lit("Any").alias("name")), F.struct(F.concat(F.lit("T"), cust % 6).alias("name"))).alias("category"), F.struct(F.lit(30.5).alias("lat")).alias("geography"), stamp.alias("_scraped_at"))
    lines = _read(spark, sf_dir, "orders").select(F.to_json(hit).alias("value"), F.lit("f").alias("file"), F.lit("2001-02-03 04:05:06").cast("timestamp").alias("file_time"))
    flat = silver.flatten(tables.parsed_hits(lines), "http://x/{external_id}")
    return flat.select("external_id", "url", "title", "price_egp", "rooms", "property_type", "city", "neighbourhood", "province", "lat", "scraped_at")


#: price, area, rooms, lat, lng, and the reason to reject them.
REASONS = [
    (None, None, 2.0, 30.0, 31.0, "missing_price_and_area"), (0.0, 100.0, 2.0, 30.0, 31.0, "missing_price"), (1e6, -1.0, 2.0, 30.0, 31.0, "missing_area"), (5e3, 100.0, 2.0, 30.0, 31.0, "price_suspiciously_low"),
    (6e8, 100.0, 2.0, 30.0, 31.0, "price_suspiciously_high"), (1e6, 2e4, 2.0, 30.0, 31.0, "area_suspiciously_large"), (1e6, 100.0, -1.0, 30.0, 31.0, "negative_rooms"), (1e6, 100.0, 25.0, 30.0, 31.0, "rooms_suspiciously_high"),
    (1e6, 100.0, 2.0, 51.5, -0.1, "coordinates_outside_egypt"), (1e6, 100.0, 2.0, 51.5, None, None), (1e4, 1e4, 20.0, 22.0, 36.9, None), (5e8, 100.0, None, None, None, None), (None, 2e4, -1.0, 0.0, 0.0, "missing_price"),
]


@query(f"SELECT reason, count(*) AS n FROM events JOIN {_values([r[-1:] for r in REASONS])} v(i, reason) ON event_id % {len(REASONS)} = i GROUP BY reason")
def every_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("price_egp", "area_m2", "rooms", "lat", "lng")
    rows = _read(spark, sf_dir, "events").select(*[_pick(REASONS, i, F.col("event_id"), "double").alias(c) for i, c in enumerate(names)])
    return rows.select(silver.rejection_reason().alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


#: A title and its floor, view, phase, building, garden and ground floor.
TITLES = [
    ("Ｐｅｎｔｈｏｕｓｅ  sea view Ｂ１２", "penthouse", "sea", None, "B12", False, False), ("دوبلكس للبيع فيو لاجون", "duplex", "lagoon", None, None, False, False), ("روف في مدينتي B6", "roof", None, None, "B6", False, False),
    ("شقة أرضي بجاردن مرحلة 7", "garden", None, "7", None, True, True), ("شقة ارضى", "ground", None, None, None, False, True), ("كورنر golf", "corner", "golf", None, None, False, False),
    ("دور متكرر كلوب هاوس", "typical", "club", None, None, False, False), ("landscape zone 4", None, "landscape", "4", None, False, False), ("شقة بالبى ٣", None, None, None, "B٣", False, False),
    ("Block B6", None, None, "b6", "B6", False, False), ("150 m² apartment", None, None, None, "M2", False, False), (None, None, None, None, None, False, False), ("ناصية البحر", "corner", "sea", None, None, False, False),
    ("شَقَّة  رُوف", "roof", None, None, None, False, False), ("المرحلة الأولى club house", None, "club", "الأولى", None, False, False),
]
_SIGNALS = ("floor_type", "view_type", "phase", "building", "has_garden", "is_ground")


@query(f"SELECT {', '.join(_SIGNALS)}, count(*) AS n FROM events JOIN {_values([r[1:] for r in TITLES])} v(i, {', '.join(_SIGNALS)}) ON event_id % {len(TITLES)} = i GROUP BY ALL")
def every_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "events").select(_pick(TITLES, 0, F.col("event_id"), "string").alias("title"))
    return resolve.with_signals(rows).groupBy(*_SIGNALS).agg(F.count(F.lit(1)).alias("n"))


#: title, furnishing, completion, price, price a square metre, the neighbourhood's, outlier, and the whole document.
DOCUMENTS = [
    ("شقة ارضي بجاردن B6", "furnished", "ready", 3e6, 25000.0, 20000.0, True, "شقة ارضي بجاردن B6 — وحدة: أرضي بجاردن، بلوك B6، مفروش، جاهز للتسليم Apartment with 3 rooms and 2 bathrooms, 150 square meters. Located in Maadi, Cairo. Status: Furnished furnishing, Ready status. Listed at 3,000,000 EGP. That's about 25,000 EGP per square meter. (25% above neighbourhood average of 20,000 EGP/m²). Note: this price is a statistical outlier compared to similar properties."),
    ("روف فيو بحر مرحلة 2", "semi-furnished", "off-plan", 1500000.5, 15000.0, 20000.0, False, "روف فيو بحر مرحلة 2 — وحدة: روف، فيو بحر، مرحلة 2، نصف مفروش، تحت الإنشاء / على الخريطة Apartment with 3 rooms and 2 bathrooms, 150 square meters. Located in Maadi, Cairo. Status: Semi-Furnished furnishing, Off-Plan status. Listed at 1,500,000 EGP. That's about 15,000 EGP per square meter. (25% below neighbourhood average of 20,000 EGP/m²)."),
    ("شقة", None, "", 0.0, 20500.0, 20000.0, None, "شقة Apartment with 3 rooms and 2 bathrooms, 150 square meters. Located in Maadi, Cairo. That's about 20,500 EGP per square meter."),
    (None, "unfurnished", None, None, None, None, False, "Apartment with 3 rooms and 2 bathrooms, 150 square meters. Located in Maadi, Cairo. Status: Unfurnished furnishing."),
]


@query(f"SELECT n_nationkey, document FROM nation JOIN {_values([r[-1:] for r in DOCUMENTS])} v(i, document) ON n_nationkey % {len(DOCUMENTS)} = i")
def every_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {"representative_title": "string", "furnishing_status": "string", "completion_status": "string", "price_egp": "double", "price_per_m2": "double", "neighbourhood_avg_price_per_m2": "double", "is_outlier": "boolean"}
    fixed = {"property_type": F.lit("Apartment"), "rooms": F.lit(3.0), "baths": F.lit(2.0), "area_m2": F.lit(150.0), "neighbourhood": F.lit("Maadi"), "city": F.lit("Cairo"), "province": F.lit(None).cast("string"), "agency_name": F.lit(""), "url": F.lit(None).cast("string"), "days_on_market": F.lit(None).cast("int")}
    rows = _read(spark, sf_dir, "nation").select("n_nationkey", *[_pick(DOCUMENTS, i, F.col("n_nationkey"), kind).alias(c) for i, (c, kind) in enumerate(kinds.items())], *[v.alias(c) for c, v in fixed.items()])
    return rows.select("n_nationkey", documents.document().alias("document"))


_GATES = """WITH e AS (SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN 'شاليهات' ELSE 'Apartment' END AS kind, CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(60 + event_id % 260 AS DOUBLE) END AS area, CAST(60 + event_id % 260 AS DOUBLE) * (1 + CAST(event_id % 9 - 4 AS DOUBLE) / 100) AS c_area,
CASE WHEN event_id % 4 = 0 THEN NULL ELSE 30.0::DOUBLE END AS lat, 30.0::DOUBLE + CAST(event_id % 11 AS DOUBLE) / 25000 + CASE WHEN event_id % 37 = 0 THEN 0.02::DOUBLE ELSE 0 END AS c_lat, CASE WHEN event_id % 13 = 0 THEN 0.0::DOUBLE ELSE 1000000.0::DOUBLE END AS price, 1000000.0::DOUBLE * (1 + CAST(event_id % 17 - 4 AS DOUBLE) / 15) AS c_price,
CASE event_id % 6 WHEN 0 THEN 'roof' WHEN 1 THEN 'garden' END AS f, CASE event_id % 5 WHEN 0 THEN 'sea' WHEN 1 THEN 'club' END AS v, CASE WHEN event_id % 7 = 0 THEN 'B1' END AS b, CASE event_id % 8 WHEN 0 THEN ['roof', 'garden'] WHEN 1 THEN ['garden'] ELSE CAST([] AS VARCHAR[]) END AS cf, CASE event_id % 10 WHEN 0 THEN ['golf', 'sea'] WHEN 5 THEN ['sea'] WHEN 1 THEN ['landscape'] ELSE CAST([] AS VARCHAR[]) END AS cv,
CASE WHEN event_id % 14 = 0 THEN ['B1', 'B2'] WHEN event_id % 14 = 7 THEN ['B2'] ELSE CAST([] AS VARCHAR[]) END AS cb, event_id % 12 = 3 AS twice FROM events),
d AS (SELECT *, lat IS NOT NULL AS coords, 6371000.0 * radians(abs(c_lat - lat)) AS dist, abs(area - c_area) / greatest(c_area, 1.0) AS ag, price <> 0 AS priced, CASE WHEN price <> 0 THEN abs(price - c_price) / greatest(price, c_price) END AS pg FROM e),
t AS (SELECT *, CASE WHEN NOT coords OR greatest(area, c_area) <= 100 THEN 0.05::DOUBLE WHEN greatest(area, c_area) <= 200 THEN 0.03::DOUBLE ELSE 0.02::DOUBLE END AS tol FROM d),
r AS (SELECT *, CASE WHEN area IS NULL THEN 'no_area' WHEN ag > tol THEN 'area' WHEN priced AND pg > 0.5 THEN 'price'
  WHEN (f IS NOT NULL AND len(cf) > 0 AND NOT list_contains(cf, f)) OR (b IS NOT NULL AND len(cb) > 0 AND NOT list_contains(cb, b)) OR (twice AND list_contains(cf, 'roof')) THEN 'title'
  WHEN kind = 'شاليهات' AND v = 'sea' AND list_contains(cv, 'golf') THEN 'view' WHEN coords AND dist > 1000 THEN 'distance' WHEN coords AND dist < 5 AND b IS NULL THEN 'same_pin' END AS reject FROM t)
SELECT id, reject, CASE WHEN reject IS NULL THEN round((40 + 20 * greatest(0.0, 1 - ag / tol) + 10 * CASE WHEN coords THEN greatest(0.0, 1 - dist / 50) ELSE 0.5 END + 15 * CASE WHEN priced THEN greatest(0.0, 1 - pg / 0.15::DOUBLE) ELSE 0.5 END
  + 15 * CASE WHEN v IS NOT NULL AND len(cv) > 0 AND NOT list_contains(cv, v) THEN 0.4 ELSE 1.0 END) / 100, 5) END AS confidence FROM r"""


@query(_GATES)
def every_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with signal sets of several values, missing coordinates and prices, all three area tolerances and the view gate."""
    i = F.col("event_id")
    sets = lambda cases: F.coalesce(*[F.when(c, F.array(*map(F.lit, v))) for c, v in cases], F.array().cast("array<string>"))
    whole = (60 + i % 260).cast("double")
    pairs = _read(spark, sf_dir, "events").select(
        i.alias("id"), F.when(i % 3 == 0, "شاليهات").otherwise("Apartment").alias("property_type"), F.lit(2.0).alias("rooms"), F.when(i % 41 != 0, whole).alias("area_m2"), (whole * (1 + (i % 9 - 4).cast("double") / 100)).alias("c_area_m2"),
        F.when(i % 4 != 0, 30.0).alias("lat"), F.lit(31.0).alias("lng"), (F.lit(30.0) + (i % 11).cast("double") / 25000 + F.when(i % 37 == 0, 0.02).otherwise(0.0)).alias("c_lat"), F.lit(31.0).alias("c_lng"),
        F.when(i % 13 == 0, 0.0).otherwise(1e6).alias("price_egp"), (F.lit(1e6) * (1 + (i % 17 - 4).cast("double") / 15)).alias("c_price_egp"), F.when(i % 6 == 0, "roof").when(i % 6 == 1, "garden").alias("floor_type"), F.when(i % 5 == 0, "sea").when(i % 5 == 1, "club").alias("view_type"),
        F.lit(None).cast("string").alias("phase"), F.when(i % 7 == 0, "B1").alias("building"), (i % 12 == 3).alias("has_garden"), (i % 12 == 3).alias("is_ground"), sets([(i % 8 == 0, ["roof", "garden"]), (i % 8 == 1, ["garden"])]).alias("c_floors"),
        sets([(i % 10 == 0, ["golf", "sea"]), (i % 10 == 5, ["sea"]), (i % 10 == 1, ["landscape"])]).alias("c_views"), F.array().cast("array<string>").alias("c_phases"), sets([(i % 14 == 0, ["B1", "B2"]), (i % 14 == 7, ["B2"])]).alias("c_buildings"), F.lit(False).alias("c_garden"), F.lit(False).alias("c_ground"),
    )
    pairs = pairs.withColumn("c_property_type", F.col("property_type")).withColumn("c_rooms", F.col("rooms"))
    return matching.scored(pairs).select("id", "reject", F.round("confidence", 5).alias("confidence"))


@query("""WITH p AS (SELECT l_extendedprice AS y, (1 + l_extendedprice) * (0.9 + 0.05 * (l_linenumber % 5)) - 1 AS p FROM lineitem)
SELECT 'mae' AS metric, round(avg(abs(y - p)), 2) AS value FROM p UNION ALL SELECT 'rmse', round(sqrt(avg((y - p) * (y - p))), 2) FROM p UNION ALL SELECT 'r2', round(1 - sum((y - p) * (y - p)) / (SELECT sum((y - m) * (y - m)) FROM p, (SELECT avg(y) AS m FROM p)), 2) FROM p UNION ALL SELECT 'mape', round(avg(abs((y - p) / y)), 2) FROM p""")
def error_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "lineitem").select(F.log1p("l_extendedprice").alias("log_price"), (F.log1p("l_extendedprice") + F.log(0.9 + 0.05 * (F.col("l_linenumber") % 5))).alias("prediction"))
    return spark.createDataFrame([(k, round(float(v), 2)) for k, v in model.metrics(rows).items()], "metric string, value double")


@query(f"WITH {lv.SQL} SELECT 'price_egp' AS name, count(price_egp) AS n, round(avg(price_egp), 4) AS mean, round(stddev(price_egp), 2) AS std, min(price_egp) AS least, round(quantile_cont(price_egp, 0.25), 4) AS q1, round(quantile_cont(price_egp, 0.5), 4) AS q2, round(quantile_cont(price_egp, 0.75), 4) AS q3, max(price_egp) AS most FROM lv")
def describe_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = audit.describe(lv.listings(spark, sf_dir), ["price_egp"])
    return d.select("name", F.col("count").alias("n"), F.round("mean", 4).alias("mean"), F.round("std", 2).alias("std"), F.col("min").alias("least"), *[F.round(q, 4).alias(q) for q in ("q1", "q2", "q3")], F.col("max").alias("most"))


@query(f"WITH {lv.LATEST_SQL} SELECT count(*) AS groups, count_if(n = 1) AS alone, round(count_if(n = 1) / count(*), 6) AS share FROM (SELECT count(*) AS n FROM ad GROUP BY city, neighbourhood, property_type, rooms)")
def singleton_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.singleton_share(lv.latest(spark, sf_dir), ["city", "neighbourhood", "property_type", "rooms"]).withColumn("share", F.round("share", 6))


@query("SELECT c_custkey, 'db://user:***@host/' || c_custkey AS url, 'http://plain/' || c_custkey AS plain FROM customer")
def url_redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return _read(spark, sf_dir, "customer").select("c_custkey", text.redact(F.concat(F.lit("db://user:p"), key, F.lit("w@host/"), key)).alias("url"), text.redact(F.concat(F.lit("http://plain/"), key)).alias("plain"))


@query(f"""WITH {lv.SQL}, old AS (SELECT n_nationkey + 500 AS id, n_name AS city, CAST(NULL AS VARCHAR) AS neighbourhood, 'kept' AS province FROM nation WHERE n_nationkey % 2 = 0),
new AS (SELECT city, neighbourhood, min(province) AS province FROM lv WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.city = lv.city AND old.neighbourhood IS NOT DISTINCT FROM lv.neighbourhood) GROUP BY 1, 2)
SELECT * FROM old UNION ALL SELECT (SELECT max(id) FROM old) + row_number() OVER (ORDER BY city NULLS FIRST, neighbourhood NULLS FIRST), city, neighbourhood, province FROM new""")
def location_ids_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New places get the next ids, known ones keep theirs."""
    old = _read(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select((F.col("n_nationkey") + 500).cast("bigint").alias("id"), F.col("n_name").alias("city"), F.lit(None).cast("string").alias("neighbourhood"), F.lit("kept").alias("province"))
    return resolve.locations(lv.listings(spark, sf_dir), old)


@query("""WITH r AS (SELECT c_custkey, c_nationkey, c_custkey % 5 AS fold, c_acctbal AS y FROM customer), a AS (SELECT avg(y) AS m FROM r)
SELECT c_custkey, round(coalesce((SELECT avg(o.y) FROM r o WHERE o.c_nationkey = r.c_nationkey AND o.fold <> r.fold), (SELECT m FROM a)), 4) AS encoded FROM r""")
def target_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of a category that leave out the row's own fold."""
    rows = _read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("y"), (F.col("c_custkey") % 5).alias("__fold"))
    return model.out_of_fold(rows, ["nation"], "y").select("c_custkey", F.round("te_nation", 4).alias("encoded"))
