"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has a bit per dimension: 1 where the value is positive. Codes are cut into m even segments
of at most 16 bits, each indexed by its value. In round r, a query asks its segments for the values at
distance r from its own. With all segments asked, all codes within m * (r + 1) - 1 bits have been met: one
that is nearer differs by at most r bits in some segment. With the first a + 1 segments asked, and all in the
rounds before, those within m * r + a bits have: one that is nearer differs by at most r bits in one of these, or
by less than r in another. So a query whose k-th verified distance is d asks no more than d - m * r + 1 segments, and
is done when d is covered; codes farther than d are dropped where they meet. Radii 0 and 1 are one round.

Equal codes are one entry with the k least ids, which is all that a top-k with ties by id can use.
Defined results: null vectors and ids are left out; a null component is 0; vectors of different
lengths are filled with zero bits; ties go to the smaller id; a query is its own nearest row; with
fewer than k rows all are returned; repeated rows are found each; further columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brickwork.llm import common as C

#: A word of a code: a long's bits.
WORD = 64


@dataclass(frozen=True)
class SearchConfig:
    k: int = 10
    every: int = 100


def coded(rows: DataFrame, vector: str, bits: int, cuts: list[int], *names: str) -> DataFrame:
    """names, code (the signs in longs, 64 dimensions each) and segments (the bits between cuts as numbers)."""
    signs = rows.select(*names, F.transform(F.concat(F.transform(F.col(vector), lambda x: F.coalesce(x, F.lit(0)) > 0), F.array_repeat(F.lit(False), bits - F.size(vector))), lambda x: x.cast("long")).alias("signs"))

    def number(a: int, b: int) -> Column:
        return F.aggregate(F.reverse(F.slice("signs", a + 1, b - a)), F.lit(0).cast("long"), lambda n, x: F.shiftleft(n, 1).bitwiseOR(x))

    words = F.array(*[number(a, min(a + WORD, bits)) for a in range(0, bits, WORD)])
    return signs.select(*names, words.alias("code"), F.array(*[number(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]).alias("segments"))


def segment_cuts(codes: int, bits: int) -> list[int]:
    """The edges of even segments of somewhat less than log2(codes) bits, so that few values of a radius meet some codes each; at most 16 bits, so that they can be enumerated."""
    m = -(-bits // min(16, max(4, round(math.log2(max(codes, 2))) - 2)))
    return [bits * s // m for s in range(m + 1)]


def search(vectors: DataFrame, queries: DataFrame, cfg: SearchConfig | None = None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, neighbour_id and distance: the k rows of vectors nearest to each row of queries."""
    cfg = cfg or SearchConfig()
    rows, asking = (x.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector")) for x in (vectors, queries))
    n, bits = rows.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    bits = max(bits or 0, asking.agg(F.max(F.size("vector"))).first()[0] or 0, 1)
    cuts = segment_cuts(n, bits)
    m, width = len(cuts) - 1, max(b - a for a, b in zip(cuts, cuts[1:], strict=False))
    entries = C.checkpoint(coded(rows, "vector", bits, cuts, "id").transform(_distinct, cfg.k))
    asked = C.checkpoint(coded(asking, "vector", bits, cuts, "id").withColumnsRenamed({"id": "query_id", "code": "q"}))
    index = C.checkpoint(entries.select("code", "ids", F.posexplode("segments").alias("segment", "value")))
    open_ = asked.select("q", "segments", F.lit(None).cast("int").alias("bound")).distinct()
    apart = sum((F.bit_count(F.get("q", F.lit(i)).bitwiseXOR(F.get("code", F.lit(i)))) for i in range(-(-bits // WORD))), F.lit(0))
    best = None
    done: list[DataFrame] = []
    for r in range(1, max(width, 1) + 1):
        radii = (0, 1) if r == 1 else (r,)
        probes = open_.mapInArrow(lambda batches, radii=radii: _probes(batches, radii, cuts), "q array<long>, bound int, segment int, value long")
        near = (probes["segment"] == index["segment"]) & (probes["value"] == index["value"]) & (apart <= F.coalesce("bound", F.lit(bits)))
        met = probes.join(index, near).select("q", apart.alias("distance"), "code", "ids").dropDuplicates(["q", "code"])
        best = met if best is None else best.unionByName(met).dropDuplicates(["q", "code"])
        best = C.checkpoint(_nearest(best, cfg.k))
        # the k-th distance counts the ids of equal codes
        reach = best.groupBy("q").agg(F.sum(F.size("ids")).alias("n"), F.max("distance").alias("kth"))
        now = open_.select("q", "segments", F.least(F.lit(m * (r + 1) - 1), "bound").alias("covered")).join(reach, "q", "left")
        now = C.checkpoint(now.select("q", "segments", F.when(F.col("n") >= cfg.k, F.col("kth")).alias("bound"), "covered"))
        closed = now.where(F.col("bound") <= F.col("covered")).select("q")
        done.append(best.join(closed, "q"))
        open_ = now.where(F.coalesce(F.col("bound") > F.col("covered"), F.lit(True))).drop("covered")
        best = best.join(closed, "q", "left_anti")
        if open_.isEmpty():
            break
    found = done[0]
    for more in [*done[1:], best]:
        found = found.unionByName(more)
    flat = found.select("q", "distance", F.explode("ids").alias("neighbour_id"))
    ordered = flat.groupBy("q").agg(F.slice(F.sort_array(F.collect_list(F.struct("distance", "neighbour_id"))), 1, cfg.k).alias("x"))
    out = asked.join(ordered, "q").select("query_id", F.posexplode("x").alias("rank", "x"))
    return out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "x.neighbour_id", F.col("x.distance").cast("int").alias("distance"))


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """(code, segments, ids): the k least ids of each code. k is a limit of the feature; Spark applies it before the shuffle too."""
    w = Window.partitionBy("code").orderBy("id")
    return rows.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k).groupBy("code").agg(F.first("segments").alias("segments"), F.sort_array(F.collect_list("id")).alias("ids"))


def _nearest(rows: DataFrame, k: int) -> DataFrame:
    """Of each query, the codes that the k nearest ids come from, no more than k."""
    w = Window.partitionBy("q").orderBy("distance", F.get("ids", F.lit(0)), "code")
    before = F.sum(F.size("ids")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    # ids of equal distance interleave, so codes as far as the k-th stay
    ranked = rows.withColumn("before", F.coalesce(before, F.lit(0))).withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= k).drop("before", "rank")


def _probes(batches: Iterator[pa.RecordBatch], radii: tuple[int, ...], cuts: list[int]) -> Iterator[pa.RecordBatch]:
    """The segment values at the radii from each query's; of a query with a bound, in the segments that it needs."""
    sizes = [b - a for a, b in zip(cuts, cuts[1:], strict=False)]
    masks = {bits: np.array([sum(1 << b for b in c) for r in radii for c in combinations(range(bits), r)], np.int64) for bits in set(sizes)}
    for b in batches:
        for i, (segments, bound) in enumerate(zip(b.column("segments").to_pylist(), b.column("bound").to_pylist(), strict=True)):
            n = len(sizes) if bound is None else min(len(sizes), bound - len(sizes) * radii[-1] + 1)
            value = np.concatenate([masks[size] ^ own for size, own in zip(sizes[:n], segments[:n], strict=True)])
            segment = np.repeat(np.arange(n, dtype=np.int32), [len(masks[size]) for size in sizes[:n]])
            row = pa.array([i] * len(value))
            yield pa.RecordBatch.from_arrays([b.column("q").take(row), b.column("bound").take(row), pa.array(segment), pa.array(value)], names=["q", "bound", "segment", "value"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = C.table(spark, sf_dir, "embeddings")
    cfg = SearchConfig()
    return search(vectors, vectors.where(F.col("vec_id") % cfg.every == 0), cfg)


#: The same by comparing each query with every row.
ORACLE = """
WITH c AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS b FROM embeddings),
p AS (SELECT q.vec_id AS query_id, v.vec_id AS neighbour_id, CAST(list_sum(list_transform(list_zip(q.b, v.b), lambda z: CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END)) AS INTEGER) AS distance
      FROM c q, c v WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, neighbour_id, distance FROM r WHERE rank <= 10
"""
