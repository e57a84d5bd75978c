"""Language-model scores from an Elias-Fano n-gram trie of the corpus itself.

Level by level, workers count n-grams by index and merge them by shard, each of which one task
writes to the shared folder (spark.checkpoint.dir); the number of shards grows with the corpus, so that
a shard does not. Scoring maps the files. An n-gram's probability is
its discounted share in its context plus the context's back-off weight times the probability in the
shorter context; a word alone has (c + 1) / (N + V + 1).

Defined results: a null or empty text is the end token alone; without learnt documents every token is
unknown; words are told by 64-bit hashes; rows without doc_id are not held out; repeated rows count
and score each; further columns are ignored; an empty table gives no rows; long texts are counted and
scored in runs that share a context. The shards' numbers of keys come to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickwork.llm import common as C
from brickwork.llm import eftrie
from brickwork.llm.quality import remainder

U = np.uint64
END = U(0x1D8E4E27C47D124F)
#: n-grams that a worker gathers before it passes them on.
GATHERED = 1 << 20
#: Bytes of text that are looked up at once: the more, the fewer times each shard is asked.
SLICE = 1 << 21


@dataclass(frozen=True)
class LanguageConfig:
    order: int = 3
    discount: float = 0.75
    #: Bytes of learnt text for each shard, which one task merges.
    shard_bytes: int = 32 << 20


@dataclass
class Model:
    vocabulary: eftrie.Vocabulary
    levels: list[eftrie.Level]

    def open(self) -> Model:
        self.vocabulary.open()
        for level in self.levels:
            level.open()
        return self


class Tokens:
    """Word hashes of a slice with an end after each document; `own`: without the words that the run before it had."""

    def __init__(self, column: pa.Array, begins: bool = True, ends: bool = True, shared: int = 0):
        w = C.Words(column, lower=True)
        self.hash = np.insert(w.hash, w.first[1:], END) if ends else w.hash
        self.count = w.count + ends
        self.last = np.cumsum(self.count) - 1
        self.first = np.zeros(len(self.hash), bool)
        if begins:
            self.first[self.last - self.count + 1] = True
        self.own = slice(shared, None)

    @staticmethod
    def of(column: pa.Array, order: int) -> Iterator[Tokens]:
        """The tokens of a slice, or of the runs of one long text, which share the words of a context."""
        held, begins = None, True
        for part in C.runs(column, order - 1, SLICE):
            if held is not None:
                yield Tokens(held, begins, False, 0 if begins else order - 1)
                begins = False
            held = part
        yield Tokens(held, begins, True, 0 if begins else order - 1)

    def indices(self, model: Model, values: bool) -> Iterator[tuple[np.ndarray, ...]]:
        """Of each level from the first: index of the n-gram that ends at each token, share and weight; of the first, index and count."""
        index, count = model.vocabulary.find(self.hash)
        yield index, count
        word = index
        for k, level in enumerate(model.levels):
            found = level.find(self.before(index, model.vocabulary.size if not k else -1), word, values)
            yield found
            index = found[0]

    def before(self, index: np.ndarray, start: int) -> np.ndarray:
        """Of each token, the index at the one before; start at a document's first."""
        out = np.full_like(index, -1)  # a run's first word has no context here, and is not its own
        out[1:] = index[:-1]
        out[self.first] = start
        return out


def _pack(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte planes apart, which Spark's compression shrinks."""
    steps = np.diff(values, prepend=U(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


class _Counter:
    """Gathers (shard, key) pairs and gives them out counted."""

    def __init__(self) -> None:
        self.held: list[np.ndarray] = []
        self.shards: list[np.ndarray] = []
        self.n = 0

    def add(self, shard: np.ndarray, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(key)
        self.shards.append(shard.astype(np.int32))
        self.n += len(key)
        if self.n >= GATHERED:
            yield from self.out()

    def out(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            shard, key = np.concatenate(self.shards), np.concatenate(self.held)
            self.__init__()
            order = np.lexsort((key, shard))
            shard, key = shard[order], key[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (shard[1:] != shard[:-1])
            at = np.flatnonzero(new)
            count = np.diff(np.append(at, len(key))).astype(np.uint32)
            shard, key = shard[at], key[at]
            some, edge = np.unique(shard, return_index=True)
            edge = np.append(edge, len(shard))
            yield pa.RecordBatch.from_pydict({"shard": pa.array(some, pa.int32()), "keys": pa.array([_pack(key[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary()), "counts": pa.array([count[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary())})


def _merged(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([_unpack(x) for x in t["keys"].to_pylist()])
    counts = np.concatenate([np.frombuffer(x, np.uint32) for x in t["counts"].to_pylist()]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(counts, at)


def _counted(docs: DataFrame, cfg: LanguageConfig, pairs: Callable[[Tokens], tuple[np.ndarray, np.ndarray]], start: Callable[[], None], write: Callable[[int, np.ndarray, np.ndarray], None]) -> dict[int, tuple[int, int]]:
    """Counts what pairs() finds in the texts, has each shard written, and returns its number of keys and their count: one row a shard comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start()
        counter = _Counter()
        for b in C.slices(batches, "text", SLICE):
            for tokens in Tokens.of(b.column("text"), cfg.order):
                yield from counter.add(*pairs(tokens))
        yield from counter.out()

    def merge(t: pa.Table) -> pa.Table:
        shard = t["shard"][0].as_py()
        keys, counts = _merged(t)
        write(shard, keys, counts)
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(keys)], pa.int64()), "total": pa.array([int(counts.sum())], pa.int64())})

    rows = C.bounded(docs).select("text").mapInArrow(count, "shard int, keys binary, counts binary").groupBy("shard").applyInArrow(merge, "shard int, n long, total long").collect()
    return {r["shard"]: (r["n"], r["total"]) for r in rows}


def build(docs: DataFrame, cfg: LanguageConfig) -> Model:
    """The trie of all texts of docs, in files of the shared folder."""
    uri = f"{C.shared_dir(docs.sparkSession)}/ngrams-{uuid.uuid4().hex}"
    uri = uri if "://" in uri else f"file://{uri.removeprefix('file:')}"
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path, recursive=True)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // cfg.shard_bytes))

    def words(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        hashes = tokens.hash[tokens.own]
        return eftrie.shard_of(hashes, shards), hashes

    found = _counted(docs, cfg, words, lambda: None, lambda s, keys, counts: eftrie.build_words(uri, s, shards, keys, counts))
    sizes = [found.get(s, (0, 0)) for s in range(shards)]
    model = Model(eftrie.Vocabulary(uri, [n for n, _ in sizes], sum(c for _, c in sizes)), [])
    known = sum(model.vocabulary.sizes)
    contexts = known + 1  # the last is the start of a document
    for n in range(2, cfg.order + 1):
        width = max(1, -(-contexts // shards))
        if width * (known + 1) >= 2**63:
            raise OverflowError(f"{width} contexts of a shard by {known} words are over 2^63 keys; more shuffle partitions make more shards")
        below = Model(eftrie.Vocabulary(uri, model.vocabulary.sizes, model.vocabulary.total), list(model.levels))
        name = f"level{n}"

        def ngrams(tokens: Tokens, below=below, width=width, n=n) -> tuple[np.ndarray, np.ndarray]:
            found = list(tokens.indices(below, values=False))
            word = found[0][0]
            context = tokens.before(found[-1][0], below.vocabulary.size if n == 2 else -1)
            keep = (context >= 0) & (word >= 0)
            keep[: tokens.own.start] = False
            shard = context[keep] // width
            return shard, (context[keep] - shard * width).astype(np.uint64) * U(below.vocabulary.size + 1) + word[keep].astype(np.uint64)

        def put(s: int, keys: np.ndarray, counts: np.ndarray, width=width, name=name) -> None:
            eftrie.build_shard(uri, f"{name}-{s}", keys, counts, known, width, cfg.discount)

        found = _counted(docs, cfg, ngrams, lambda below=below: below.open() and None, put)
        sizes = [found.get(s, (0, 0))[0] for s in range(shards)]
        model.levels.append(eftrie.Level(uri, name, known, contexts, width, sizes))
        contexts = max(1, sum(sizes))
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model.open()
        total, size, order = model.vocabulary.total, model.vocabulary.size, len(model.levels) + 1
        for b in C.slices(batches, "text", SLICE):
            sums = np.zeros((b.num_rows, 4))
            for tokens in Tokens.of(b.column("text"), order):
                levels = tokens.indices(model, values=True)
                _, count = next(levels)
                p = (count + 1) / (total + size + 1)
                each = [np.ones(len(p)), count > 0, np.log10(p)]
                for _, share, weight in levels:
                    p = share + weight * p
                each.append(np.log10(p))
                # documents have a token at least, so that sums by document never run empty; a run is one document's
                starts = tokens.last - tokens.count + 1 if b.num_rows > 1 else np.zeros(1, np.int64)
                sums += np.stack([np.add.reduceat(x[tokens.own].astype(float), starts) for x in each], axis=1)
            count, known, base, score = sums.T
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(count.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(np.full(len(known), total), pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())], names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return C.bounded(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out(name: str = "doc_id"):
    return F.coalesce(remainder(name, 7) == 2, F.lit(False))


def query(spark: SparkSession, sf_dir: str, cfg: LanguageConfig | None = None) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    model = build(docs.where(~held_out()), cfg or LanguageConfig())
    return scored(docs, model).withColumn("held_out", held_out()).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
