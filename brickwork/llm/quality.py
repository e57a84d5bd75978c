"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters of WIDTH bytes slide over the whole document. Their responses are max-pooled over
overlapping chunks; the chunks' mean and maximum are combined into one probability. The network
sees bytes only. It learns from at most `rows` labelled rows, the least by a hash of doc_id among
those whose crc32 modulo 4 is not 2, so the sample is the same each time; of these, texts of over
`longest` bytes are not learnt from. Every text is scored whole, a long one run by run.

Defined results: a null text is empty, and an empty one is a document of padding with its own
score; labels of unknown documents and labels that are null are not learnt from; of several labels
of one document the least counts; without labels to learn from every score is 0.5, and `keep` rejects
nothing; repeated rows are scored each, and rows without doc_id too; an empty table gives no rows;
further columns are kept by `keep` and ignored by `classify`, a `__score` among them too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brickwork.llm import common as C

WIDTH = 4
BLOCK = 32  # a chunk is two neighbouring blocks, so chunks overlap by half
#: Bytes whose responses, and whose chunks, are held at once.
STEP, RUN = 1 << 16, 1 << 20


@dataclass(frozen=True)
class QualityConfig:
    #: Bounds of the sample that the network learns from: so many rows, of texts of at most so many bytes.
    rows: int = 1600
    longest: int = 1 << 16
    filters: int = 16
    epochs: int = 8
    rate: float = 0.02
    batch: int = 24
    threshold: float = 0.7
    seed: int = 11


@dataclass
class Network:
    table: np.ndarray  # WIDTH x 256 x filters
    bias: np.ndarray
    mean: np.ndarray
    most: np.ndarray
    offset: float
    learnt: bool = True

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The filters' responses to two bytes at a time."""
        t = self.table
        return tuple((t[k][:, None, :] + t[k + 1][None, :, :]).reshape(65536, -1).astype(np.float32) for k in (0, 2))


def padded(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents one after the other, each between WIDTH zeros at least, in whole blocks; blocks of each.

    The zeros on both sides keep a document's responses from its neighbours' bytes.
    """
    length = np.diff(ends)
    blocks = -(-(length + 2 * WIDTH) // BLOCK)
    start = (np.cumsum(blocks) - blocks) * BLOCK + WIDTH
    out = np.zeros(int(blocks.sum()) * BLOCK + WIDTH, np.uint8)
    out[np.arange(len(data)) + np.repeat(start - ends[:-1], length)] = data
    return out, blocks


def responses(x: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The filters' responses at every byte of padded documents, by block."""
    two = x[:-1].astype(np.int32) * 256 + x[1:]
    n = len(x) - WIDTH
    out = pairs[0][two[:n]]
    out += pairs[1][two[2 : 2 + n]]
    return out.reshape(-1, BLOCK, out.shape[1])


def chunks(most: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each chunk the maximum, and whether the second block has it. A document's last chunk is its last block."""
    after = np.full_like(most, -np.inf)
    after[:-1] = most[1:]
    after[np.cumsum(blocks) - 1] = -np.inf
    second = after > most
    return np.where(second, after, most), second


def block_maxima(x: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The filters' maxima by block, in steps of STEP bytes: a long text's responses are never held whole."""
    n = len(x) - WIDTH
    return np.concatenate([responses(x[at : min(at + STEP, n) + WIDTH], pairs).max(1) for at in range(0, n, STEP)])


def scores(net: Network, pairs: tuple[np.ndarray, np.ndarray], data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The probabilities of a slice of texts, or of one long text of which no more than RUN bytes are pooled at once."""
    if len(ends) == 2 and len(data) > RUN:
        return _long_score(net, pairs, data)
    x, blocks = padded(data, ends)
    pooled, _ = chunks(block_maxima(x, pairs), blocks)
    pooled = np.maximum(pooled + net.bias, 0)
    start = np.cumsum(blocks) - blocks
    return _probability(net, np.add.reduceat(pooled, start) / blocks[:, None], np.maximum.reduceat(pooled, start))


def _probability(net: Network, mean: np.ndarray, most: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(mean @ net.mean + most @ net.most + net.offset, -30, 30)))


def _long_score(net: Network, pairs: tuple[np.ndarray, np.ndarray], data: np.ndarray) -> np.ndarray:
    """The probability of one text: its chunks' sum and maximum, gathered run by run."""
    blocks = -(-(len(data) + 2 * WIDTH) // BLOCK)
    per = RUN // BLOCK
    total, most = np.zeros(net.bias.shape), np.zeros(net.bias.shape)
    for at in range(0, blocks, per):
        to = min(at + per + 1, blocks)  # and the block that the run's last chunk ends with
        x = np.zeros((to - at) * BLOCK + WIDTH, np.uint8)
        before = 0 if at else WIDTH
        own = data[max(at * BLOCK - WIDTH, 0) : to * BLOCK]
        x[before : before + len(own)] = own
        pooled, _ = chunks(block_maxima(x, pairs), np.array([to - at]))
        pooled = np.maximum(pooled[:per] + net.bias, 0)
        total, most = total + pooled.sum(0), np.maximum(most, pooled.max(0))
    return _probability(net, total[None] / blocks, most[None])


def train(texts: list[bytes], labels: np.ndarray, cfg: QualityConfig) -> Network:
    rng = np.random.default_rng(cfg.seed)
    f = cfg.filters
    net = Network(rng.normal(0, 0.3, (WIDTH, 256, f)), np.zeros(f), rng.normal(0, 0.3, f), rng.normal(0, 0.1, f), 0.0)
    if not len(texts):
        net.mean[:] = 0
        net.most[:] = 0
        net.learnt = False
        return net
    names = ("table", "bias", "mean", "most", "offset")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    step, per_epoch = 0, -(-len(texts) // cfg.batch)
    epochs = max(cfg.epochs, min(60, 400 // per_epoch))
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), cfg.batch):
            rows = order[at : at + cfg.batch]
            own = [np.frombuffer(texts[i], np.uint8) for i in rows]
            x, blocks = padded(np.concatenate(own), np.concatenate([[0], np.cumsum([len(o) for o in own])]))
            r = responses(x, net.pairs())
            most, place = r.max(1), r.argmax(1)
            pooled, later = chunks(most, blocks)
            active = pooled + net.bias > 0
            pooled = np.where(active, pooled + net.bias, 0)
            start = np.cumsum(blocks) - blocks
            doc = np.repeat(np.arange(len(rows)), blocks)
            mean, top = np.add.reduceat(pooled, start) / blocks[:, None], np.maximum.reduceat(pooled, start)
            p = 1 / (1 + np.exp(-np.clip(mean @ net.mean + top @ net.most + net.offset, -30, 30)))
            error = (p - labels[rows]) / len(rows)
            d_chunk = (error / blocks)[doc][:, None] * net.mean
            d_chunk = d_chunk + np.where(pooled == top[doc], error[doc][:, None] * net.most / 1.0, 0)
            d_chunk = np.where(active, d_chunk, 0)
            block = np.arange(len(pooled))[:, None] + later
            byte = block * BLOCK + place[block, np.arange(f)]
            g_table = np.zeros(WIDTH * 256 * f)
            for k in range(WIDTH):
                g_table += np.bincount(((k * 256 + x[byte + k].astype(np.int64)) * f + np.arange(f)).ravel(), weights=d_chunk.ravel(), minlength=len(g_table))
            grads = {"table": g_table.reshape(WIDTH, 256, f), "bias": d_chunk.sum(0), "mean": error @ mean, "most": error @ top, "offset": error.sum()}
            step += 1
            rate = cfg.rate * (1 - epoch / epochs)
            for k in names:
                g = grads[k] + 1e-4 * getattr(net, k)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                change = rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                setattr(net, k, getattr(net, k) - change)
    return net


def remainder(doc_id: str, modulus: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def learn(docs: DataFrame, labels: DataFrame, cfg: QualityConfig) -> Network:
    """The network for the labelled rows of docs that are open to learning."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("__label"))
    known = known.where(remainder("doc_id", 4) != 2).withColumn("__order", F.xxhash64("doc_id", F.lit(cfg.seed))).orderBy("__order", "doc_id").limit(cfg.rows)
    # limit() is the documented bound of the sample: cfg.rows ids, then their texts
    rows = docs.select("doc_id", "text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= cfg.longest).join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.min("__label").alias("label"), F.min("__order").alias("order"))
    found = sorted(rows.collect(), key=lambda r: (r["order"], r["doc_id"]))
    return train([r["text"].encode() for r in found], np.array([r["label"] for r in found], float), cfg)


def score(docs: DataFrame, net: Network, name: str = "score") -> DataFrame:
    """docs with a score column."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = net.pairs()
        for b in C.slices(batches, "text", 1 << 17):
            data, ends = C.column_bytes(b.column("text"))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores(net, pairs, data, ends), pa.float64())], names=[*names, name])

    from pyspark.sql import types as T

    return C.bounded(docs).mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, cfg: QualityConfig | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    cfg = cfg or QualityConfig()
    rows = score(docs.select("doc_id", "text"), learn(docs, labels, cfg))
    return rows.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= cfg.threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame, cfg: QualityConfig | None = None) -> DataFrame:
    """The rows of docs that the classifier does not reject."""
    cfg = cfg or QualityConfig()
    net = learn(docs, labels, cfg)
    if not net.learnt:
        return docs
    own = C.unused("score", docs)
    return score(docs, net, own).where(F.col(own) >= cfg.threshold).drop(own)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))
