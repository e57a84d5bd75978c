"""Substring dedup by repeated-phrase automata.

A window is `window` consecutive words of a document. Each has a least phrase of `phrase` words, by
hash, that its content alone decides; neighbouring windows mostly share it and form a segment. Every
document is cut so; a phrase that occurs once cannot lie in a repeated window, which leaves the segments
of recurring phrases. Equal segments (by 128 bits: phrase and segment) are one, with the number of their
places and the earliest.

Segments are dealt out by phrase into shards. A shard confirms its recurring passages: the windows whose
64-bit hash occurs in two segments, or in one of several places. An Aho-Corasick automaton of these
passages, over numbered words, is compiled, and all segments of all documents that came to the shard are
streamed through it; where it locates a passage decides which windows are repeated, and the earliest
place of each. All windows of the segments go, save those that the automaton does not locate, and the
earliest place of each that it does. (Two windows of one shard with one hash and different words would
leave one of them unremoved; for n windows of one phrase the probability is under n^2 / 2^65.)

Phrases in more than `hot` different segments are dealt out by window instead, so that no shard
gathers a frequent phrase; equal windows are then joined as they arrive.

Defined results: a null or empty text has no words; fewer words than a window has are all kept;
rows of one doc_id and text are one document and are each returned; a document is told by its doc_id
and 64 bits of its text, so different texts under one doc_id, or without any, are documents of their own,
in the order of those bits; rows without doc_id come before all others; an empty table gives no rows;
further columns are ignored; long texts are cut in runs of whole words that overlap by a window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickwork.llm import common as C


@dataclass(frozen=True)
class RepeatConfig:
    window: int = 20
    phrase: int = 6
    hot: int = 256
    shard: int = 1000


def _rolled(total: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return C.mix((total[b] - total[a]) * C.inverses(len(total))[a] + (b - a).astype(np.uint64))


def segments(w: C.Words, cfg: RepeatConfig) -> tuple[np.ndarray, ...]:
    """Of each run of windows with one least phrase: phrase hash, segment hash, document, first window, windows, phrase's word.

    The places count words from the slice's start; a segment is the words of the run's windows.
    """
    n = len(w.hash)
    none = np.zeros(0, np.int64)
    if n < cfg.window:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), none, none, none, none
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(w.hash * C.powers(n), out=total[1:])
    at = np.arange(n - cfg.phrase + 1)
    phrase = _rolled(total, at, at + cfg.phrase)
    doc = w.doc()
    first = np.arange(n - cfg.window + 1)
    whole = doc[first] == doc[first + cfg.window - 1]
    least = np.lib.stride_tricks.sliding_window_view(phrase, cfg.window - cfg.phrase + 1).argmin(1) + first
    first, least = first[whole], least[whole]
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), none, none, none, none
    new = np.ones(len(first), bool)
    new[1:] = (least[1:] != least[:-1]) | (first[1:] != first[:-1] + 1)
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(first)))
    start, anchor = first[begin], least[begin]
    return phrase[anchor], _rolled(total, start, start + count + cfg.window - 1), doc[start], start, count, anchor


RUNS = "h long, sh long, doc_id long, digest long, start int, n int"
#: Stands for a missing doc_id; it sorts first.
NO_ID = -(2**63)


def runs(docs: DataFrame, cfg: RepeatConfig) -> DataFrame:
    """A row per segment: phrase and segment hash, document, first window, number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.slices(batches, "text"):
            ids, digest = np.asarray(b.column("doc_id")), np.asarray(b.column("digest"))
            for w, base in _words(b.column("text"), cfg):
                h, sh, doc, start, count, _ = segments(w, cfg)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(sh.view(np.int64)), pa.array(ids[doc], pa.int64()), pa.array(digest[doc], pa.int64()), pa.array((start - w.first[doc] + base).astype(np.int32)), pa.array(count.astype(np.int32))], names=["h", "sh", "doc_id", "digest", "start", "n"])

    return docs.mapInArrow(run, RUNS)


def _words(column: pa.Array, cfg: RepeatConfig) -> Iterator[tuple[C.Words, int]]:
    """The words of a slice, or of the runs of one long text; and the words of that text before the run."""
    base = 0
    for part in C.runs(column, cfg.window - 1):
        w = C.Words(part)
        yield w, base
        base += len(w.hash) - (cfg.window - 1)


SEGMENT = "key long, doc_id long, digest long, start int, n int, many boolean, words binary"


def _cut(batches: Iterator[pa.RecordBatch], cfg: RepeatConfig) -> Iterator[pa.RecordBatch]:
    """The wanted segments of documents with their words. Those of frequent phrases go window by window, keyed by its words."""
    for b in C.slices(batches, "text"):
        ids, digests = b.column("doc_id").to_pylist(), b.column("digest").to_pylist()
        wanted = [{x["start"]: x for x in items} for items in b.column("wanted").to_pylist()]
        for w, base in _words(b.column("text"), cfg):
            h, _, doc, start, count, _ = segments(w, cfg)
            raw = w.data.tobytes()
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            for i, (d, local) in enumerate(zip(doc.tolist(), (start - w.first[doc] + base).tolist(), strict=True)):
                if (item := wanted[d].get(local)) is None:
                    continue
                first, n = int(start[i]), int(count[i])
                words = [raw[x:y] for x, y in zip(w.start[first : first + n + cfg.window - 1].tolist(), w.end[first : first + n + cfg.window - 1].tolist(), strict=True)]
                if not item["hot"]:
                    rows = [(int(h[i].view(np.int64)), ids[d], digests[d], local, n, item["many"], b" ".join(words))]
                else:
                    rows = [(_key(own), ids[d], digests[d], local + k, 1, item["many"], own) for k in range(n) for own in [b" ".join(words[k : k + cfg.window])]]
                for row in rows:
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()), strict=True)], names=[x.split()[0] for x in SEGMENT.split(", ")])


def _key(words: bytes) -> int:
    return xxhash.xxh3_64_intdigest(words) - 2**63


MARK = "doc_id long, digest long, start int, n int, first int"


def _located(batches: Iterator[pa.RecordBatch], cfg: RepeatConfig) -> Iterator[pa.RecordBatch]:
    """For segments sorted by key: MARKs, document, first window and the bits of those windows that stay there."""
    rows: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if rows and row[0] == rows[-1][0] and row[4] == rows[-1][4] == 1 and row[6] == rows[-1][6]:
                rows[-1] = (row[0], *min(row[1:4], rows[-1][1:4]), 1, True, row[6])  # a frequent phrase's window again
                continue
            if len(rows) >= cfg.shard and row[0] != rows[-1][0]:
                yield _shard(rows, cfg)
                rows = []
            rows.append(row)
    if rows:
        yield _shard(rows, cfg)


def _shard(rows: list[tuple], cfg: RepeatConfig) -> pa.RecordBatch:
    """Confirms one shard's recurring windows, compiles their automaton and streams the segments through it."""
    number: dict[bytes, int] = {}
    texts = [tuple([number.setdefault(x, len(number)) for x in row[6].split(b" ")]) for row in rows]
    patterns = _recurring(rows, texts, cfg)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for i, (r, k) in enumerate(patterns):
        automaton.add_word(texts[r][k : k + cfg.window], i)
    stays = [(1 << row[4]) - 1 for row in rows]  # bits of the windows that are not located, or first
    earliest: list[tuple | None] = [None] * len(patterns)
    if patterns:
        automaton.make_automaton()
        for i, ((_, doc_id, digest, start, _, _, _), text) in enumerate(zip(rows, texts, strict=True)):
            for end, pattern in automaton.iter(text):
                k = end - cfg.window + 1
                stays[i] &= ~(1 << k)
                place = (doc_id, digest, start + k, i, k)
                if earliest[pattern] is None or place < earliest[pattern]:
                    earliest[pattern] = place
    for place in earliest:
        if place is not None:
            stays[place[3]] |= 1 << place[4]
    out = [(row[1], row[2], row[3], 0, bits) for row, bits in zip(rows, stays, strict=True) if bits]
    columns = list(zip(*out, strict=True)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()), strict=True)], names=[x.split()[0] for x in MARK.split(", ")])


def _recurring(rows: list[tuple], texts: list[tuple], cfg: RepeatConfig) -> list[tuple[int, int]]:
    """A (segment, window) for each window hash that recurs: in two places of the shard, or in a segment of several."""
    length = np.array([len(t) for t in texts])
    flat = C.mix(np.fromiter((x for t in texts for x in t), np.uint64, int(length.sum())) + np.uint64(1))
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(flat * C.powers(len(flat)), out=total[1:])
    n = np.array([row[4] for row in rows])
    row = np.repeat(np.arange(len(rows)), n)
    window = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(np.cumsum(length) - length, n) + window
    _, first, inverse = np.unique(_rolled(total, at, at + cfg.window), return_index=True, return_inverse=True)
    many = np.array([r[5] for r in rows])
    times = np.bincount(inverse) + np.bincount(inverse, weights=many[row])
    chosen = first[times >= 2]
    return list(zip(row[chosen].tolist(), window[chosen].tolist(), strict=True))


def _removed(batches: Iterator[pa.RecordBatch], cfg: RepeatConfig) -> Iterator[pa.RecordBatch]:
    for b in C.slices(batches, "text"):
        out: tuple[list, ...] = ([], [], [], [], [])
        marks = b.column("marks")
        flat = marks.flatten()
        start, n, first = (np.asarray(flat.field(c)) for c in ("start", "n", "first"))
        size = np.asarray(marks.value_lengths().fill_null(0))
        ends = np.cumsum(size)
        for i, (doc_id, to, count) in enumerate(zip(b.column("doc_id").to_pylist(), ends.tolist(), size.tolist(), strict=True)):
            parts = [C.column_bytes(x)[0].tobytes() for x in C.runs(b.column("text").slice(i, 1))]
            total = sum(len(x.split()) for x in parts) if len(parts) > 1 else len(parts[0].split())
            keep = None
            if count and total >= cfg.window:
                s, k, f = start[to - count : to], n[to - count : to], first[to - count : to]
                repeated = np.zeros(total - cfg.window + 1, bool)
                for a, m in zip(s[k > 0].tolist(), k[k > 0].tolist(), strict=True):
                    repeated[a : a + m] = True
                for a, bits in zip(s[f > 0].tolist(), f[f > 0].tolist(), strict=True):
                    while bits:
                        low = bits & -bits
                        if (at := a + low.bit_length() - 1) < len(repeated):
                            repeated[at] = False
                        bits ^= low
                edge = np.zeros(total + 1, np.int64)
                where = np.flatnonzero(repeated)
                np.add.at(edge, where, 1)
                np.add.at(edge, where + cfg.window, -1)
                keep = np.cumsum(edge[:-1]) == 0
            kept, place = [], 0
            for x in parts:
                words = x.split()
                if keep is not None:
                    mask = keep[place : place + len(words)].tolist()
                    place += len(words)
                    words = list(compress(words, mask))
                if words:
                    kept.append(b" ".join(words))
            joined = b" ".join(kept)
            gone = 0 if keep is None else int(total - keep.sum())
            for column, value in zip(out, (None if doc_id == NO_ID else doc_id, total, gone, hashlib.sha256(joined).hexdigest(), joined.decode()), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def dedup(docs: DataFrame, cfg: RepeatConfig | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (the kept words) of every row."""
    cfg = cfg or RepeatConfig()
    docs = C.bounded(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("digest"), "text")
    found = runs(docs, cfg)
    # what is known of each phrase is written before it is joined: a join of two tables can be split at a frequent phrase
    recurring = C.written(found.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h"), "phrases")
    places = C.written(found.join(recurring, "h"), "repeats")
    variants = C.written(places.groupBy("h", "sh").agg(F.min(F.struct("doc_id", "digest", "start")).alias("f"), (F.count(F.lit(1)) > 1).alias("many")), "variants")
    frequent = C.written(variants.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > cfg.hot).select("h", F.lit(True).alias("hot")), "frequent")
    marked = variants.join(frequent, "h", "left").select("f", F.struct(F.col("f.start").alias("start"), F.coalesce("hot", F.lit(False)).alias("hot"), "many").alias("x"))
    wanted = marked.groupBy(F.col("f.doc_id").alias("doc_id"), F.col("f.digest").alias("digest")).agg(F.collect_list("x").alias("wanted"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = docs.join(wanted, ["doc_id", "digest"]).select("doc_id", "digest", "text", "wanted").mapInArrow(lambda batches: _cut(batches, cfg), SEGMENT)
    first = cut.repartition(parts, "key").sortWithinPartitions("key", "words").mapInArrow(lambda batches: _located(batches, cfg), MARK)
    marks = places.select("doc_id", "digest", "start", "n", F.lit(0).alias("first")).unionByName(first)
    by_doc = marks.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start", "n", "first")).alias("marks"))
    joined = docs.join(by_doc, ["doc_id", "digest"], "left").select("doc_id", "text", F.coalesce("marks", F.array().cast("array<struct<start:int,n:int,first:int>>")).alias("marks"))
    return joined.mapInArrow(lambda batches: _removed(batches, cfg), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(C.table(spark, sf_dir, "documents")).drop("kept")
