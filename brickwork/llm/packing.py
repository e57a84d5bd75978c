"""Best-fit packing of token pieces into sequences by a grouping genetic algorithm.

Chromosomes are lists of bins. Crossover injects the well-filled bins of one parent whole into the
other, dissolves the other's bins that share a document with them and a few more. One or two of the
displaced pieces take the place of up to two in a bin where that fills it better, as long as there are
any; the rest is best-fitted.
Pieces are dealt into blocks of bounded size; every block evolves on several islands, which pass
their best packing on to the next island between the rounds.

Where plain best fit already meets the least number of sequences that the pieces need (Martello and Toth's
L2), it can't be bettered, and no generation runs; nor do further ones once a packing meets it.

Defined results: an empty or null text is one piece of the closing id alone; an empty table gives
no rows; repeated rows and rows without doc_id are packed each; further columns are ignored; long texts
are encoded in parts that end between words, where the encoding splits anyway.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickwork.llm import common as C
from brickwork.llm.tokens import Encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


@dataclass(frozen=True)
class PackConfig:
    capacity: int = 2048
    end_id: int = 0
    tokenizer: str = ""
    block: int = 4096
    islands: int = 2
    rounds: int = 2
    population: int = 16
    generations: int = 40
    seed: int = 7

    def path(self) -> str:
        if self.tokenizer:
            return self.tokenizer
        import public_tokenizers

        return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, cfg: PackConfig) -> DataFrame:
    """A row per piece: the whole document, or pieces of which only the first may be short."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(cfg.path())
        for batch in C.slices(batches, "text"):
            counts, ids = encoder.ids(batch.column("text"))
            out: tuple[list, ...] = ([], [], [], [], [])
            ends = np.concatenate([[0], np.cumsum(counts)])
            for d, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                own = np.append(ids[ends[d] : ends[d + 1]], cfg.end_id).astype("<u4")
                at, k = 0, 0
                while at < len(own):
                    n = min(cfg.capacity, len(own)) if k else (len(own) - 1) % cfg.capacity + 1
                    for column, value in zip(out, (doc_id, k, at, n, zlib.crc32(own[at : at + n].tobytes())), strict=True):
                        column.append(value)
                    at, k = at + n, k + 1
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return C.bounded(docs).select("doc_id", "text").mapInArrow(cut, PIECES)


class Packing:
    """Bins of items with the given sizes."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bins: list[list[int]] = []
        self.free: list[int] = []

    def copy(self) -> Packing:
        new = Packing(self.sizes, self.capacity)
        new.bins, new.free = [x[:] for x in self.bins], self.free[:]
        return new

    def fit(self, items: list[int]) -> None:
        """Puts each item, in the order given, where it leaves the least room."""
        room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        mask = 0
        for b, free in enumerate(self.free):
            room[free].append(b)
            mask |= 1 << free
        for i in items:
            size = self.sizes[i]
            fits = mask >> size
            if fits:
                free = size + (fits & -fits).bit_length() - 1
                b = room[free].pop()
                if not room[free]:
                    mask &= ~(1 << free)
                self.bins[b].append(i)
            else:
                free, b = self.capacity, len(self.bins)
                self.bins.append([i])
                self.free.append(free)
            self.free[b] = free - size
            room[free - size].append(b)
            mask |= 1 << free - size

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first; of as many, those filled less evenly, which leave more to gain."""
        return -len(self.bins), sum((1 - x / self.capacity) ** 2 for x in self.free)

    def assignment(self) -> np.ndarray:
        out = np.zeros(len(self.sizes), np.int32)
        for b, items in enumerate(self.bins):
            out[items] = b
        return out

    @staticmethod
    def of(sizes: list[int], capacity: int, assignment: np.ndarray) -> Packing:
        new = Packing(sizes, capacity)
        n = int(assignment.max()) + 1 if len(assignment) else 0
        new.bins, new.free = [[] for _ in range(n)], [capacity] * n
        for i, b in enumerate(assignment.tolist()):
            new.bins[b].append(i)
            new.free[b] -= sizes[i]
        return new


def crossover(a: Packing, b: Packing, rng: np.random.Generator) -> Packing:
    """a's well-filled bins whole, then b's bins that share nothing with them, then the rest by best fit."""
    order = np.argsort(np.array(a.free) + rng.random(len(a.free)), kind="stable")
    taken = order[: max(1, int(len(order) * rng.uniform(0.3, 0.8)))].tolist()
    child = Packing(a.sizes, a.capacity)
    used: set[int] = set()
    for k in taken:
        child.bins.append(a.bins[k][:])
        child.free.append(a.free[k])
        used.update(a.bins[k])
    displaced: list[int] = []
    loose = a.capacity // 50
    for items, free in zip(b.bins, b.free, strict=True):
        # shares a document, is a badly filled bin, or mutates
        if not used.isdisjoint(items) or free > loose or rng.random() < 0.02:
            displaced += [i for i in items if i not in used]
        else:
            child.bins.append(items[:])
            child.free.append(free)
    displaced = replaced(child, displaced)
    displaced.sort(key=lambda i: -a.sizes[i])
    child.fit(displaced)
    return child


def replaced(child: Packing, out: list[int]) -> list[int]:
    """What lies outside of child's bins after up to two items of each have been replaced by one or two of `out` that fill it better."""
    sizes = child.sizes
    out = sorted(out, key=lambda i: sizes[i])
    ds = [sizes[i] for i in out]
    d = np.array(ds, np.int64)
    for k, items in enumerate(child.bins):
        free = child.free[k]
        if not free or len(d) < 2:
            continue
        best, swap = 0, None
        own = [(i,) for i in items] + [(i, j) for n, i in enumerate(items[:MOST_PAIRED]) for j in items[:n]]
        for leave in own:
            room = free + sum(sizes[i] for i in leave)
            one = bisect_right(ds, room) - 1
            if one >= 0 and (gain := ds[one] - room + free) > best:
                best, swap = gain, (leave, (one,))
            if len(leave) == 2 and best < free:
                with_ = np.searchsorted(d, room - d, "right") - 1
                np.minimum(with_, np.arange(-1, len(d) - 1), out=with_)  # each pair once, the lesser second
                sums = np.where(with_ >= 0, d + d[with_], 0)
                sums[sums > room] = 0
                two = int(np.argmax(sums))
                if (gain := int(sums[two]) - room + free) > best:
                    best, swap = gain, (leave, (two, int(with_[two])))
            if best == free:
                break
        if swap:
            leave, take = swap
            child.bins[k] = [i for i in items if i not in leave] + [out[t] for t in take]
            child.free[k] = free - best
            for t in sorted(take, reverse=True):
                del out[t], ds[t]
            for i in leave:
                to = bisect_right(ds, sizes[i])
                out.insert(to, i)
                ds.insert(to, sizes[i])
            d = np.array(ds, np.int64)
    return out


#: Items of a bin whose pairs are tried for replacement.
MOST_PAIRED = 12


def least_bins(sizes: list[int], capacity: int) -> int:
    """Martello and Toth's L2: no packing has fewer bins."""
    n = np.bincount(np.array(sizes, np.int64), minlength=capacity + 1)
    many, total = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * np.arange(capacity + 1))])
    half = capacity // 2
    least = np.arange(half + 1)
    # those over capacity - least lie alone; those over half apart, in whose room the ones from least to half may lie
    apart = many[-1] - many[half + 1]
    room = capacity * (many[capacity - least + 1] - many[half + 1]) - (total[capacity - least + 1] - total[half + 1])
    more = -((room - (total[half + 1] - total[least])) // capacity)
    return max(int((apart + np.maximum(more, 0)).max()), -(-sum(sizes) // capacity))


def evolve(sizes: list[int], elites: list[np.ndarray], cfg: PackConfig, seed: int) -> Packing:
    rng = np.random.default_rng(seed)
    population = [Packing.of(sizes, cfg.capacity, x) for x in elites]
    bound = least_bins(sizes, cfg.capacity)
    if not population:
        population.append(Packing(sizes, cfg.capacity))
        population[0].fit(sorted(range(len(sizes)), key=lambda i: -sizes[i]))
    for p in population:
        if len(p.bins) <= bound:
            return p
    while len(population) < cfg.population:
        p = Packing(sizes, cfg.capacity)
        p.fit(np.argsort(-np.array(sizes) * (1 + 0.1 * rng.random(len(sizes))), kind="stable").tolist())
        population.append(p)
    ranked = sorted(((p.fitness(), k, p) for k, p in enumerate(population)), key=lambda x: x[:2])
    serial = len(ranked)
    for _ in range(cfg.generations):
        if -ranked[-1][0][0] <= bound:
            break
        a = ranked[-1][2]
        b = ranked[int(rng.integers(len(ranked) - 1))][2] if len(ranked) > 1 else a
        for child in (crossover(a, b, rng), crossover(b, a, rng)):
            insort(ranked, (child.fitness(), serial, child), key=lambda x: x[:2])
            serial += 1
        del ranked[: len(ranked) - cfg.population]
    return ranked[-1][2]


def pack(docs: DataFrame, cfg: PackConfig | None = None) -> DataFrame:
    """Rows of COLUMNS for (doc_id, text) rows."""
    cfg = cfg or PackConfig()
    found = C.written(pieces(docs, cfg), "pieces")
    full = found.where(F.col("length") == cfg.capacity).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = found.where(F.col("length") < cfg.capacity)
    blocks = max(1, -(-short.count() // cfg.block))
    dealt = short.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    block = dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("items"))
    block = C.checkpoint(block)
    state = block.select("block", F.explode(F.sequence(F.lit(0), F.lit(cfg.islands - 1))).alias("island"), F.col("items.length").alias("sizes"))
    elites = None
    for r in range(cfg.rounds):
        rows = state.withColumn("elites", F.array().cast("array<binary>")) if elites is None else state.join(elites, ["block", "island"])
        best = C.checkpoint(rows.mapInArrow(lambda batches, r=r: _evolved(batches, cfg, r), "block long, island int, bins int, fitness double, elite binary"))
        # migration: each island sees its own best and that of the island before it
        moved = best.select("block", ((F.col("island") + 1) % cfg.islands).cast("int").alias("island"), "elite")
        elites = best.select("block", "island", "elite").unionByName(moved).groupBy("block", "island").agg(F.collect_list("elite").alias("elites"))
    winner = best.groupBy("block").agg(F.min_by("elite", F.struct("bins", -F.col("fitness"), "island")).alias("elite"))
    placed = block.join(winner, "block").mapInArrow(lambda batches: _placed(batches), f"{PIECES}, sequence_id long, offset long")
    return full.select(COLUMNS).unionByName(placed.select(COLUMNS))


def _evolved(batches: Iterator[pa.RecordBatch], cfg: PackConfig, r: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            elites = [np.frombuffer(x, np.int32) for x in row["elites"]]
            p = evolve(row["sizes"], elites, cfg, hash((cfg.seed, row["block"], row["island"], r)) & 0x7FFFFFFF)
            bins, fitness = p.fitness()
            yield pa.RecordBatch.from_pydict({"block": pa.array([row["block"]], pa.int64()), "island": pa.array([row["island"]], pa.int32()), "bins": pa.array([-bins], pa.int32()), "fitness": pa.array([fitness], pa.float64()), "elite": pa.array([p.assignment().tobytes()], pa.binary())})


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The items of each block with their sequence and their place in it."""
    for batch in batches:
        for k in range(batch.num_rows):
            items = batch.column("items").slice(k, 1).flatten()
            bins = np.frombuffer(batch.column("elite")[k].as_py(), np.int32).astype(np.int64)
            length = np.asarray(items.field("length"))
            order = np.argsort(bins, kind="stable")
            before = np.cumsum(length[order]) - length[order]
            starts = np.flatnonzero(np.diff(bins[order], prepend=-1))
            offset = np.empty(len(bins), np.int64)
            offset[order] = before - np.repeat(before[starts], np.diff(np.append(starts, len(bins))))
            sequence = batch.column("block")[k].as_py() * (1 << 20) + bins
            yield pa.RecordBatch.from_arrays([*(items.field(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=COLUMNS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(C.table(spark, sf_dir, "documents"))
