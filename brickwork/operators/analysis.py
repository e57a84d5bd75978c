"""Dashboard groups: one per (location, type, rooms)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickwork.sources import tables

KEY = ["location_id", "property_type", "rooms"]


def groups(located: DataFrame, existing: DataFrame) -> DataFrame:
    """The groups with new ones added under the next ids."""
    new = tables.absent(located.select(KEY), existing, KEY, [F.lit(1)])
    base = existing.agg(F.max("id")).first()[0] or 0
    return existing.unionByName(tables.with_ids(new, KEY, base))


def matches(located: DataFrame, all_groups: DataFrame, known: int, run_id: str) -> DataFrame:
    """A match of each advertisement with its group; ids over `known` are of this run."""
    g = all_groups.alias("g")
    joined = located.join(g, [located[k].eqNullSafe(F.col(f"g.{k}")) for k in KEY])
    return joined.select(F.lit(run_id).alias("run_id"), "external_id", F.col("g.id").alias("analysis_property_id"), F.lit(1.0).alias("confidence"), F.when(F.col("g.id") > known, "new").otherwise("scored_match").alias("method"))
