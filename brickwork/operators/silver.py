"""Cleaned, validated, latest state of each advertisement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brickwork.config import QualityLimits
from brickwork.sources import tables


def flatten(hits: DataFrame, url_template: str = "") -> DataFrame:
    """Silver columns of raw hits (raw_data, hit)."""
    h = F.col("hit")
    named = lambda kind: F.get(F.filter(h["location"], lambda x: x["type"] == kind), F.lit(0))["name"]
    key = tables.external_id(h["externalID"], h["id"])
    return hits.select(
        key.alias("external_id"),
        (F.replace(F.lit(url_template), F.lit("{external_id}"), key) if url_template else F.lit(None).cast("string")).alias("url"),
        h["title"].alias("title"),
        h["purpose"].alias("purpose"),
        h["price"].alias("price_egp"),
        h["downPayment"].alias("down_payment_egp"),
        h["rooms"].alias("rooms"),
        h["baths"].alias("baths"),
        h["area"].alias("area_m2"),
        h["plotArea"].alias("plot_area_m2"),
        F.try_element_at(h["category"], F.lit(-1))["name"].alias("property_type"),
        named("city").alias("city"),
        named("neighbourhood").alias("neighbourhood"),
        named("province").alias("province"),
        h["geography"]["lat"].alias("lat"),
        h["geography"]["lng"].alias("lng"),
        h["furnishingStatus"].alias("furnishing_status"),
        h["completionStatus"].alias("completion_status"),
        h["agency"]["name"].alias("agency_name"),
        h["photoCount"].alias("photo_count"),
        tables.scraped_at(h["_scraped_at"], hits).alias("scraped_at"),
    )


def rejection_reason(limits: QualityLimits | None = None) -> Column:
    """The first reason to reject a silver row; null if it is valid."""
    q = limits or QualityLimits()
    price, area, rooms, lat, lng = (F.col(c) for c in ("price_egp", "area_m2", "rooms", "lat", "lng"))
    no_price, no_area = F.coalesce(price <= 0, F.lit(True)), F.coalesce(area <= 0, F.lit(True))
    return (
        F.when(no_price & no_area, "missing_price_and_area")
        .when(no_price, "missing_price")
        .when(no_area, "missing_area")
        .when(price < q.price_low, "price_suspiciously_low")
        .when(price > q.price_high, "price_suspiciously_high")
        .when(area > q.area_high, "area_suspiciously_large")
        .when(rooms < 0, "negative_rooms")
        .when(rooms > q.rooms_high, "rooms_suspiciously_high")
        .when(lat.isNotNull() & lng.isNotNull() & ~(lat.between(*q.lat) & lng.between(*q.lng)), "coordinates_outside_egypt")
    )


def latest(df: DataFrame, key: str, stamp: str, ties: list[str]) -> DataFrame:
    return tables.first_per(df.where(F.col(key).isNotNull()), [key], [F.desc(stamp), *map(F.asc, ties)])


def build(existing: DataFrame, hits: DataFrame, limits: QualityLimits, url_template: str = "") -> tuple[DataFrame, DataFrame]:
    """(silver after the upsert, counts by rejection reason). The latest row of each key is validated."""
    flat = latest(flatten(hits, url_template), "external_id", "scraped_at", ["url", "title", "price_egp"])
    judged = flat.withColumn("reason", rejection_reason(limits))
    good = judged.where("reason IS NULL").drop("reason")
    reasons = judged.where("reason IS NOT NULL").groupBy("reason").count()
    return tables.newest(existing, good, ["external_id"], "scraped_at", []), reasons
