"""Incremental ingestion with Structured Streaming: each trigger takes what is new and stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brickwork.config import EngineConfig
from brickwork.operators import silver
from brickwork.plans import gold
from brickwork.sources import tables


def hits(spark: SparkSession, folder: str, archive: str | None = None) -> DataFrame:
    """A stream of JSON-line files; read files go to the archive folder if one is named."""
    reader = spark.readStream.format("text")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return tables.parsed_hits(reader.load(folder).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_modification_time").alias("file_time")))


def ingest(spark: SparkSession, folder: str, cfg: EngineConfig, run_id: str, archive: str | None = None, resolve: bool = False) -> StreamingQuery:
    """Bronze append without repeats, then the silver upsert, for every file not seen before; with resolve also the matching.

    A micro-batch that is tried again changes nothing: what is there is left out, and matching takes only advertisements that are no listings yet.
    """
    store = tables.Store(spark, cfg.root)

    def batch(df: DataFrame, _: int) -> None:
        df = df.persist()
        existing = store.read("bronze_listings")
        store.append("bronze_listings", bronze_rows(df, existing, cfg.source, run_id))
        merged, _reasons = silver.build(store.read("silver_listings"), df, cfg.limits, cfg.url_template)
        store.write("silver_listings", merged)
        if resolve:
            gold.resolved(store, cfg)
        df.unpersist()

    return hits(spark, folder, archive).writeStream.foreachBatch(batch).option("checkpointLocation", f"{cfg.root}/_stream").trigger(availableNow=True).start()


def bronze_rows(df: DataFrame, existing: DataFrame, source: str, run_id: str) -> DataFrame:
    """The rows of hits that bronze hasn't got, by (external_id, scraped_at)."""
    h = F.col("hit")
    rows = df.select(tables.external_id(h["externalID"], h["id"]).alias("external_id"), F.lit(source).alias("source"), "raw_data", tables.scraped_at(h["_scraped_at"], df).alias("scraped_at"), F.current_timestamp().alias("ingested_at"), F.lit(run_id).alias("run_id"))
    return tables.absent(rows.where("external_id IS NOT NULL"), existing, ["external_id", "scraped_at"], [F.asc("raw_data")])


def unique(stream: DataFrame, keys: list[str], stamp: str, delay: str = "1 day") -> DataFrame:
    """Each key once within the delay, with bounded state."""
    return stream.withWatermark(stamp, delay).dropDuplicatesWithinWatermark(keys)
