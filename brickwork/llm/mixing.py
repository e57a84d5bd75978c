"""Mixing sources to target weights by entropy balancing.

A document's rate is exp(lambda * size / mean size of its source), at most MOST; the dual variable of
each source's token constraint is found by Newton steps, held between bisection bounds, whose sums
Spark takes over the counts of equal sizes. Documents of one source and size have one rate, and so are
a class: from large sizes to small, each class gets a whole number of copies, and takes on what rounding
has left over so far. Inside a class the first documents, by doc_id and text, get one copy more than the
others. Classes of over `block` documents are dealt by hash into parts that round apart (each is off by
less than one document).

Defined results: a null text has size 0; documents of size 0 are taken once each, with no words; a null
source is a source of its own, last in order; sources without words have target 0; rows that repeat
and rows without doc_id are documents each; further columns are kept by `mix`, whatever their names; an
empty table gives no rows. One row a source (and a row a source and size of its open ones to each Newton
step's sums) is planned with; a source's classes, at most as many as its largest document has words, are
rounded in one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brickwork.llm import common as C

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3
#: A list of so many sources, or classes, is small enough to broadcast: under 20 MB.
BROADCAST_SOURCES = 200_000


@dataclass(frozen=True)
class MixConfig:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    block: int = 500
    #: Newton steps and bisections that a balance may take; more raise.
    steps: int = 200
    tolerance: float = 1e-7


def targets(sizes: list[int], weights: tuple[float, ...]) -> list[float]:
    """Shares of all sizes by weight, none above MOST times its size."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out, full = [0.0] * len(sizes), [False] * len(sizes)
    while True:
        left = sum(sizes) - sum(MOST * s for s, f in zip(sizes, full, strict=True) if f)
        total = sum(x for x, f in zip(w, full, strict=True) if not f)
        out = [float(MOST * s) if f else left * x / total for s, x, f in zip(sizes, w, full, strict=True)]
        above = [not f and t > MOST * s for s, t, f in zip(sizes, out, full, strict=True)]
        if not any(above):
            return out
        full = [f or a for f, a in zip(full, above, strict=True)]


def _plan(equal: DataFrame, cfg: MixConfig) -> list[tuple]:
    """(source, source_size, target, mean, lambda, number) of each source of (source, size, n). One row a source comes to the driver."""
    found = equal.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size"), F.sum("n").alias("n")).collect()
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["size"]) for r in found]
    goal = targets(sizes, cfg.weights) if found else []
    mean = [s / r["n"] if s else 1.0 for s, r in zip(sizes, found, strict=True)]
    dual = [0.0] * len(found)
    low: list[float | None] = [None] * len(found)
    high: list[float | None] = [None] * len(found)
    open_ = {i for i in range(len(found)) if sizes[i] and goal[i] < MOST * sizes[i]}
    steps = 0
    while open_:
        if (steps := steps + 1) > cfg.steps:
            raise ArithmeticError(f"{len(open_)} sources are not balanced after {cfg.steps} steps")
        now = equal.sparkSession.createDataFrame([(found[i]["source"], mean[i], dual[i], i) for i in sorted(open_)], "s string, mean double, dual double, i int")
        z = F.col("size") / F.col("mean")
        rate = F.exp(F.least(F.col("dual") * z, F.lit(50.0)))
        words = F.col("size") * F.col("n")
        joined = equal.join(F.broadcast(now) if len(open_) <= BROADCAST_SOURCES else now, equal["source"].eqNullSafe(now["s"]))
        sums = joined.groupBy("i").agg(F.sum(words * F.least(rate, F.lit(float(MOST)))).alias("f"), F.sum(F.when(rate < MOST, words * z * rate).otherwise(0.0)).alias("d"))
        for r in sums.collect():
            i, gap = r["i"], r["f"] - goal[r["i"]]
            if abs(gap) <= cfg.tolerance * max(goal[i], 1.0):
                open_.discard(i)
                continue
            if gap < 0:
                low[i] = dual[i]
            else:
                high[i] = dual[i]
            reach = max(1.0, 2 * abs(dual[i]))
            step = -gap / r["d"] if r["d"] > 0 else math.copysign(reach, -gap)
            to = dual[i] + max(-reach, min(reach, step))
            if low[i] is not None and high[i] is not None and not low[i] < to < high[i]:
                to = (low[i] + high[i]) / 2
            dual[i] = to
    return [(r["source"], sizes[i], goal[i], mean[i], dual[i], i) for i, r in enumerate(found)]


CLASS = "s string, z long, n long, k long, source_size long, target double, rate double"


def _classes(sized: DataFrame, cfg: MixConfig) -> DataFrame:
    """CLASS of each source and size of (source, size): its n documents, their k copies together, the source's plan and the rate."""
    equal = C.checkpoint(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    plan = _plan(equal, cfg)
    by_source = equal.sparkSession.createDataFrame(plan, "s string, source_size long, target double, mean double, dual double, i int")
    joined = equal.join(F.broadcast(by_source) if len(plan) <= BROADCAST_SOURCES else by_source, equal["source"].eqNullSafe(by_source["s"]))
    full = F.col("target") >= MOST * F.col("source_size")
    rate = F.when((F.col("size") > 0) & full, float(MOST)).otherwise(F.least(F.exp(F.least(F.col("dual") * F.col("size") / F.col("mean"), F.lit(50.0))), F.lit(float(MOST))))
    rows = joined.select("s", F.col("size").alias("z"), "n", "source_size", "target", rate.alias("rate"), "i")

    def round_up(t: pa.Table) -> pa.Table:
        t = t.sort_by([("z", "descending")])
        k = copies(t["z"].to_pylist(), t["n"].to_pylist(), t["rate"].to_pylist())
        return t.drop_columns(["i"]).append_column("k", pa.array(k, pa.int64())).select([x.split()[0] for x in CLASS.split(", ")])

    return C.checkpoint(rows.groupBy("i").applyInArrow(round_up, CLASS))


def copies(sizes: list[int], counts: list[int], rates: list[float]) -> list[int]:
    """Whole copies of each class, sizes descending; what rounding leaves over goes to the next one."""
    out, over = [], 0.0
    for size, n, rate in zip(sizes, counts, rates, strict=True):
        if size:
            want = rate * size * n + over
            out.append(min(MOST * n, max(0, math.floor(want / size + 0.5))))
            over = want - out[-1] * size
        else:
            out.append(n)
    return out


def _with_class(sized: DataFrame, classes: DataFrame, size: str, part: str, mixed: str, cfg: MixConfig) -> tuple[DataFrame, list[Column]]:
    """sized with its class, whose columns are given too, and the part of the class."""
    c = classes.select([F.col(x).alias(f"{mixed}_{x}") for x in classes.columns])
    found = [c[x] for x in c.columns]
    joined = sized.join(F.broadcast(c) if classes.count() <= BROADCAST_SOURCES else c, sized["source"].eqNullSafe(found[0]) & (sized[size] == found[1]))
    return joined.withColumn(part, F.pmod(F.xxhash64("doc_id", joined[sized.columns[-1]]), F.ceil(found[2] / cfg.block))), found


def _numbered(sized: DataFrame, cfg: MixConfig, size: str, part: str, mixed: str) -> tuple[DataFrame, list[Column], Column, Column, Column]:
    """sized (its last column a digest of the text) with classes and parts; the classes' columns; and of a row whether it is of the first, its copies and its rank in the part."""
    classes = _classes(sized.select("source", F.col(size).alias("size")), cfg)
    digest = sized.columns[-1]
    rows, found = _with_class(sized, classes, size, part, mixed, cfg)
    s, z, n, k = found[:4]
    parts = F.ceil(n / cfg.block)
    w = Window.partitionBy(s, z, part)
    own = F.count(F.lit(1)).over(w)
    # a class of one part has its copies as they are; the parts of others round by shifted thresholds, which cancel out
    share = F.when(parts == 1, k).otherwise(F.floor(own * k / n + (F.col(part) + 0.5) / parts))
    first = F.row_number().over(w.orderBy("doc_id", digest)) <= F.pmod(share, own)
    taken = F.least(F.floor(share / own) + first.cast("int"), F.lit(MOST)).cast("int")
    return rows, found, first, taken, F.rank().over(w.orderBy("doc_id", digest))


def _sized(docs: DataFrame, size: str, digest: str) -> DataFrame:
    return docs.withColumn(size, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")).withColumn(digest, F.xxhash64("text"))


def rated(docs: DataFrame, cfg: MixConfig | None = None, lean: bool = False) -> DataFrame:
    """docs and a last column, a struct of size, source_size, target, rate and copies; lean: without their text."""
    size, digest, part, mixed = (C.unused(x, docs) for x in ("size", "digest", "part", "mix"))
    sized = _sized(docs, size, digest)
    rows, (_, _, _, _, source_size, target, rate), _, taken, _ = _numbered(sized.drop("text") if lean else sized, cfg or MixConfig(), size, part, mixed)
    found = F.struct(F.col(size).alias("size"), source_size.alias("source_size"), target.alias("target"), rate.alias("rate"), taken.alias("copies"))
    return rows.withColumn(mixed, found).select(*[F.col(x) for x in docs.columns if not (lean and x == "text")], mixed)


def mix(docs: DataFrame, cfg: MixConfig | None = None) -> DataFrame:
    """The rows of docs, each as many times as the mix takes it.

    Texts are not moved: a part of a class gives its first documents one copy more than the others, so a row is
    compared with the last of the first. Only rows of one doc_id and text that lie on both sides of it are numbered.
    """
    cfg = cfg or MixConfig()
    size, digest, part, mixed, copy = (C.unused(x, docs) for x in ("size", "digest", "part", "mix", "copy"))
    keys = C.written(_sized(docs.select("doc_id", "source", "text"), size, digest).drop("text"), "sizes")
    rows, (s, z, *_), first, taken, rank = _numbered(keys, cfg, size, part, mixed)
    rows = rows.select(s.alias("s"), z.alias("z"), F.col(part).alias("part"), F.struct("doc_id", digest).alias("key"), first.alias("first"), taken.alias("taken"), rank.alias("rank"))
    more, fewer = F.col("first"), ~F.col("first")
    cuts = rows.groupBy("s", "z", "part").agg(F.max(F.when(more, F.col("key"))).alias("last"), F.min(F.when(fewer, F.col("key"))).alias("next"), F.max(F.when(more, F.col("taken"))).alias("high"), F.max(F.when(fewer, F.col("taken"))).alias("low"), (F.count_if(more) - F.max(F.when(more, F.col("rank"))) + 1).alias("among"), F.count(F.lit(1)).alias("own"))
    cuts = C.written(cuts.withColumn("tied", F.coalesce(F.col("last") == F.col("next"), F.lit(False))).drop("next"), "cuts")
    classes = C.checkpoint(cuts.groupBy("s", "z").agg(F.sum("own").alias("n")))
    dealt, _ = _with_class(_sized(docs, size, digest), classes, size, part, mixed, cfg)
    c = cuts.select([F.col(x).alias(f"{mixed}_cut_{x}") for x in cuts.columns if x != "own"])
    at, last, high, low, among, tied = (c[x] for x in c.columns[2:])
    joined = dealt.join(F.broadcast(c) if cuts.count() <= BROADCAST_SOURCES else c, dealt["source"].eqNullSafe(c[c.columns[0]]) & (dealt[size] == c[c.columns[1]]) & (dealt[part] == at))
    key = F.struct("doc_id", digest)
    out = joined.withColumn(copy, F.when(key <= last, high).otherwise(low))
    if not cuts.where("tied").isEmpty():
        on = tied & (key == last)
        number = F.row_number().over(Window.partitionBy(c.columns[:3]).orderBy("doc_id"))
        out = out.where(~on).unionByName(joined.where(on).withColumn(copy, F.when(number <= among, high).otherwise(low)))
    return out.where(F.col(copy) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy)))).select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rated(C.table(spark, sf_dir, "documents").select("doc_id", "text", "source"), lean=True)
    m = F.col(rows.columns[-1])
    return rows.select("doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"), (m["size"] * m["copies"]).cast("long").alias("taken"), m["rate"].alias("rate"))
