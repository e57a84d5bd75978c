"""The stages in order, each recorded in pipeline_runs."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickwork.config import EngineConfig
from brickwork.operators import aggregates, analysis, resolve, silver, vectors
from brickwork.plans import gold
from brickwork.sources import tables
from brickwork.streaming.incremental import bronze_rows

log = logging.getLogger(__name__)


def new_run_id() -> str:
    return uuid.uuid4().hex[:12]


@contextmanager
def stage(store: tables.Store, run_id: str, name: str) -> Iterator[dict]:
    """Records the stage's duration, outcome and stats; a failure is recorded and raised."""
    began, stats, status, error = datetime.now(UTC), {}, "success", None
    try:
        yield stats
    except Exception as e:
        status, error = "failed", str(e)[:500]
        raise
    finally:
        try:
            row = [(run_id, name, began, datetime.now(UTC), status, json.dumps(stats), error)]
            store.append("pipeline_runs", store.spark.createDataFrame(row, store.read("pipeline_runs").schema))
            log.info("stage %s: %s", name, status, extra={"run_id": run_id, "stage": name, "status": status})
        except Exception:
            log.exception("stage %s could not be recorded", name)


def run_pipeline(spark: SparkSession, cfg: EngineConfig, raw_dir: str, embed: vectors.Embedder | None = None) -> str:
    """Bronze, silver, gold, features, groups and vectors; returns the run's id. The first failure ends the run.

    A run takes the files that no run has taken to silver, and archives them where cfg.archive names a folder.
    """
    store, run_id = tables.Store(spark, cfg.root), new_run_id()
    with stage(store, run_id, "bronze") as stats:
        files = store.pending(raw_dir)
        if not files and not store.exists("processed_files"):
            raise FileNotFoundError(f"{raw_dir} has no files")
        hits = tables.read_hits(spark, [f[0] for f in files]) if files else tables.parsed_hits(spark.createDataFrame([], "value string, file string, file_time timestamp"))
        stats["files"] = len(files)
        if files:
            store.append("bronze_listings", bronze_rows(hits, store.read("bronze_listings"), cfg.source, run_id))
        stats["rows"] = store.read("bronze_listings").count()
    with stage(store, run_id, "silver") as stats:
        if files:
            merged, reasons = silver.build(store.read("silver_listings"), hits, cfg.limits, cfg.url_template)
            store.write("silver_listings", merged)
            stats["rejected"] = {r["reason"]: r["count"] for r in reasons.collect()}
            done = spark.createDataFrame([(name, time, run_id, datetime.now(UTC)) for _, name, time in files], store.read("processed_files").schema)
            store.append("processed_files", done)
            if cfg.archive:
                stats["archived"] = store.archive([f[0] for f in files], cfg.archive)
        stats["rows"] = store.read("silver_listings").count()
    with stage(store, run_id, "gold") as stats:
        stats["properties"] = gold.resolved(store, cfg)
        current, dim = store.read("silver_listings"), store.read("locations")
    with stage(store, run_id, "features") as stats:
        rows = aggregates.feature_store(store.read("properties"), store.read("listings"), dim)
        stats["rows"] = store.write("property_features", rows).count()
    with stage(store, run_id, "analysis") as stats:
        here = resolve.located(current, dim)
        before = store.read("analysis_properties")
        known = before.agg(F.max("id")).first()[0] or 0
        groups = store.write("analysis_properties", analysis.groups(here, before))
        found = analysis.matches(here, groups, known, run_id)
        # keyed by this run's id, so that no row can be there yet
        stats["rows"] = store.append("property_analysis_matches", found).count()
    with stage(store, run_id, "vectors") as stats:
        build_vectors(store, cfg, embed)
        stats["rows"] = store.read("property_vectors").count()
    return run_id


def build_vectors(store: tables.Store, cfg: EngineConfig, embed: vectors.Embedder | None = None, refresh: bool = True) -> DataFrame:
    old = store.read("property_vectors")
    todo = vectors.changed(store.read("property_features"), old, refresh)
    new = tables.checkpoint(vectors.embedded(todo, embed or vectors.hashing_embedder(cfg.vector_size), cfg.vector_size))
    return store.write("property_vectors", tables.upserted(old, new, ["property_id"]))
