"""Reports on merges, groups, missing values and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickwork.operators.aggregates import group_quantiles


def merge_overview(listings: DataFrame, key: str = "property_id") -> DataFrame:
    sizes = listings.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("n") == 1).alias("single"), F.count_if(F.col("n") > 1).alias("merged"), F.coalesce(F.sum("n"), F.lit(0)).alias("listings"), F.avg("n").alias("mean"), F.max("n").alias("most"))


def top_merged(listings: DataFrame, n: int = 10, key: str = "property_id") -> DataFrame:
    """The n properties of most listings: a report's limit."""
    return listings.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(F.desc("n"), F.asc(key)).limit(n)


def write_merged(listings: DataFrame, properties: DataFrame, locations: DataFrame, path: str, n: int = 10) -> None:
    """The top merged properties with their place and each of their listings, as CSV with a header."""
    p = properties.select(F.col("id").alias("property_id"), "location_id", "property_type", "rooms", "area_m2", "lat", "lng")
    place = locations.select(F.col("id").alias("location_id"), "neighbourhood", "city")
    rows = merged_listings(listings, n).select("property_id", F.col("external_id").alias("listing_external_id"), F.col("title").alias("listing_title"), F.col("current_price_egp").alias("listing_price_egp"), F.col("agency_name").alias("listing_agency"), F.col("first_seen_at").alias("listing_first_seen_at"))
    found = rows.join(p, "property_id").join(place, "location_id", "left").drop("location_id")
    found.coalesce(1).sortWithinPartitions("property_id", "listing_external_id").write.mode("overwrite").option("header", True).csv(path)


def merged_listings(listings: DataFrame, n: int = 10) -> DataFrame:
    """The listings of the top merged properties, for a CSV."""
    return listings.join(F.broadcast(top_merged(listings, n).select("property_id")), "property_id")


def group_sizes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """How many groups have each size."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("groups"))


def singleton_share(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row: groups, those of one row, and their share; null without groups."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(F.count(F.lit(1)).alias("groups"), F.count_if(F.col("size") == 1).alias("alone")).withColumn("share", F.try_divide("alone", "groups"))


def most_common(rows: DataFrame, key: str, n: int) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(key)).limit(n)


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: missing values and distinct ones, in one pass."""
    stats = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in columns], *[F.count_distinct(c).alias(f"d_{c}") for c in columns])
    return stats.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"m_{c}").alias("missing"), F.col(f"d_{c}").alias("different")) for c in columns])).alias("x")).select("x.*")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per numeric column: count, mean, standard deviation, least, quartiles and most."""
    out = None
    for c in columns:
        named = df.select(F.lit(c).alias("name"), F.col(c).cast("double").alias("v"))
        stats = named.groupBy("name").agg(F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
        q = group_quantiles(named, "name", "v", [0.25, 0.5, 0.75])
        one = stats.join(q, "name", "left").select("name", "count", "mean", "std", "min", *[F.get("q", F.lit(i)).alias(f"q{i + 1}") for i in range(3)], "max")
        out = one if out is None else out.unionByName(one)
    return out


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int = 80) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(F.width_bucket(F.col(column), F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def box(df: DataFrame, column: str, by: str) -> DataFrame:
    """Quartiles of a column by group; groups without values have no row."""
    return group_quantiles(df, by, column, [0.25, 0.5, 0.75]).select(by, F.get("q", F.lit(0)).alias("q1"), F.get("q", F.lit(1)).alias("q2"), F.get("q", F.lit(2)).alias("q3"))


def sample(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """n rows, the same each time: a sampling operator's limit."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key)).limit(n)
