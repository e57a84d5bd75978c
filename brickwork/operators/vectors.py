"""Documents, embeddings and exact cosine search."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brickwork.functions import documents

Embedder = Callable[[list[str]], np.ndarray]
BATCH = 64


def hashing_embedder(size: int) -> Embedder:
    """Offline default: hashed words with signs, of unit length."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), size), np.float32)
        for i, t in enumerate(texts):
            for w in re.findall(r"\w+", t.lower()):
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                out[i, h % size] += 1.0 if h >> 63 else -1.0
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    return embed


def changed(features: DataFrame, vectors: DataFrame, refresh: bool = True) -> DataFrame:
    """The features that have no vector, or with refresh one that is older."""
    v = vectors.select("property_id", "embedded_at", F.lit(True).alias("__has"))
    joined = features.join(v, "property_id", "left")
    old = F.col("computed_at").isNull() | (F.col("computed_at") > F.col("embedded_at"))
    return joined.where(F.col("__has").isNull() | (old if refresh else F.lit(False))).drop("embedded_at", "__has")


def embedded(features: DataFrame, embed: Embedder, size: int) -> DataFrame:
    """property_vectors of features; the embedder is called in batches and must give a row of `size` for each text."""
    rows = features.select("property_id", documents.document().alias("document_text"), F.current_timestamp().alias("embedded_at"), documents.dedup_key().alias("dedup_key"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), BATCH):
                part = b.iloc[at : at + BATCH].copy()
                for attempt in range(3):
                    try:
                        found = embed(part["document_text"].tolist())
                        break
                    except OSError:
                        if attempt == 2:
                            raise
                if found.shape != (len(part), size):
                    raise ValueError(f"embedder gave {found.shape}, not {(len(part), size)}")
                part["embedding"] = list(found)
                yield part[["property_id", "document_text", "embedding", "embedded_at", "dedup_key"]]

    return rows.mapInPandas(run, "property_id bigint, document_text string, embedding array<float>, embedded_at timestamp, dedup_key string")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(_dot(a, b), F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))


def top_k(vectors: DataFrame, query: list[float], k: int, key: str = "vec_id", vector: str = "embedding", by: str | None = None) -> DataFrame:
    """The k rows nearest to the query; with `by` only the nearest of each value of that column counts."""
    literal = F.array(*[F.lit(float(x)) for x in query])
    scored = vectors.withColumn("score", cosine(F.col(vector), literal))
    if by:
        w = Window.partitionBy(by).orderBy(F.desc("score"), F.asc(key))
        scored = scored.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    return scored.orderBy(F.desc("score"), F.asc(key)).limit(k)
