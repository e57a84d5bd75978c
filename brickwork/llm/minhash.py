"""Near-duplicate documents by MinHash, with every link confirmed on the full shingle sets.

Texts with equal shingle sets form a class, and only a class's representative goes on. Minima of
`bands * rows` universal hash functions are cut into bands; documents that share a band's minima are
a bucket. Links are sought in rounds. In the first, that document of each bucket leads, and is compared with
the others, which shares most buckets with others; an original does so more than its copies.

Where buckets still hold documents of several components, those documents are active, and a shingle
that at most `rare` of them have is rare. Documents that share a rare one are compared unless those
they share and the common ones can't reach the similarity. Any other pair can only be alike on its
common shingles; documents that have too few of these for any pair are done. Of the rest, further
ones lead their buckets, more each round, and are compared with those of other components, until in
each bucket all pairs across components have been compared or can't reach the similarity. They can't
if they have too few common shingles, or if their parity maps differ in too many bits: each shingle
flips one of `PARITY_WORDS * 64` bits of its set's map, so two sets differ in at least as many
shingles as their maps in bits. No pairs
inside a component are made, and none is left out: a bucket of any size is done so. Candidates pass if their signatures
agree in `agree` of the places, then if the sets of their whole texts reach the similarity.
Components grow by alternating large-star and small-star.

With 24 bands of 5 rows, a pair of similarity 0.85 shares no band with probability under 1e-6. Sets are
of 64-bit shingle hashes, equal sets are told by 128 bits: two of n different shingles of the corpus
share a hash with probability under n^2 / 2^65, and a link's test is then off by one shingle.

Defined results: null and empty texts, or texts without words, have an empty set and are linked with
nothing; with fewer words than a shingle has, the whole sequence is the one shingle; repeated rows
have equal sets and so one component; rows of one doc_id with different texts are one document, whose
least text `keep` keeps; further columns are kept by `keep`, whatever their names, and ignored by
`linked`; an empty table gives no rows; long texts are hashed in runs that share words - 1 words. Rows
without doc_id are told apart by their texts and linked like all others: each text has a number from
2^62 on for an id, which is its component_id if no row of a lesser id is linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brickwork.llm import common as C


#: 64-bit words of a set's parity map.
PARITY_WORDS = 16
#: A list of so many ids is small enough to broadcast: some 32 MB.
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class MinHashConfig:
    words: int = 5
    #: Per cent of the union that the intersection must reach.
    percent: int = 80
    bands: int = 24
    rows: int = 5
    agree: float = 0.65
    leaders: tuple[int, ...] = (1, 8, 4096)
    #: A shingle of at most so many active documents is rare; the others are common, and told apart no further.
    rare: int = 8
    seed: int = 5


def shingles(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit shingles of all documents in order, number of each document), repeats included."""
    w = C.Words(column, lower=True)
    n = w.count
    total = C.mix(w.hash + np.uint64(words))
    out = total[: max(0, len(total) - words + 1)].copy() if len(total) >= words else np.zeros(0, np.uint64)
    for k in range(1, words):
        out = C.mix(out * np.uint64(3) + total[k : k + len(out)])
    each = np.where(n >= words, n - words + 1, 0)
    at = np.arange(int(each.sum())) + np.repeat(w.first[:-1] - (np.cumsum(each) - each), each)
    found = out[at] if len(at) else np.zeros(0, np.uint64)
    short = np.flatnonzero((n > 0) & (n < words))
    if len(short):
        values = []
        for d in short.tolist():
            x = np.array([n[d]], np.uint64)
            for k in range(w.first[d], w.first[d + 1]):
                x = C.mix(x * np.uint64(5) + total[k : k + 1])
            values.append(x[0])
        found = np.insert(found, (np.cumsum(each) - each)[short], np.array(values, np.uint64))
        each[short] = 1
    return found, each


def sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each document; one long text goes run by run."""
    if len(parts := list(C.runs(column, words - 1))) > 1:
        return [np.unique(np.concatenate([np.unique(shingles(x, words)[0]) for x in parts]))]
    found, each = shingles(column, words)
    ends = np.cumsum(each)
    return [np.unique(found[e - n : e]) for e, n in zip(ends.tolist(), each.tolist(), strict=True)]


def functions(cfg: MinHashConfig) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(cfg.seed)
    n = cfg.bands * cfg.rows
    return rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**64, n, dtype=np.uint64)


def row_id() -> Column:
    """The row's doc_id, or a number by its text that comes after all usual ids."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text").bitwiseAND(F.lit(2**62 - 1)) + F.lit(2**62))


def signatures(docs: DataFrame, cfg: MinHashConfig) -> DataFrame:
    """doc_id, id, n_shingles, the set's two digests, the bands' keys, a byte of each minimum and the parity map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = functions(cfg)
        for batch in C.slices(batches, "text"):
            own = sets(batch.column("text"), cfg.words)
            n = np.array([len(x) for x in own], np.int64)
            full = np.flatnonzero(n)
            allof = np.concatenate(own) if len(own) else np.zeros(0, np.uint64)
            starts = (np.cumsum(n) - n)[full]
            low = np.empty((len(full), len(a)), np.uint64)
            fp1, fp2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            parity = np.zeros((len(full), PARITY_WORDS), np.uint64)
            if len(full):
                for k in range(len(a)):
                    low[:, k] = np.minimum.reduceat(allof * a[k] + b[k], starts)
                fp1[full] = np.add.reduceat(C.mix(allof), starts)
                fp2[full] = np.add.reduceat(C.mix(allof ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
                place = C.mix(allof ^ np.uint64(0x3C3C3C3C3C3C3C3C)) % np.uint64(64 * PARITY_WORDS)
                word, bit = place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63))
                for k in range(PARITY_WORDS):
                    parity[:, k] = np.bitwise_xor.reduceat(np.where(word == k, bit, np.uint64(0)), starts)
            low = C.mix(low)
            keys = np.full((len(full), cfg.bands), 1, np.uint64) * np.arange(cfg.bands, dtype=np.uint64)
            for r in range(cfg.rows):
                keys = C.mix(keys * np.uint64(7) + low[:, r :: cfg.rows][:, : cfg.bands])
            marks = (low & np.uint64(0xFF)).astype(np.uint8)
            counts = np.where(n > 0, cfg.bands, 0)
            sig: list = [None] * len(n)
            for i, d in enumerate(full.tolist()):
                sig[d] = marks[i].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("id"), pa.array(n, pa.int64()), pa.array(fp1.view(np.int64)), pa.array(fp2.view(np.int64)), C.rows_list(counts, keys.view(np.int64).ravel(), pa.int64()), pa.array(sig, pa.binary()), C.rows_list(np.where(n > 0, PARITY_WORDS, 0), parity.view(np.int64).ravel(), pa.int64())], names=["doc_id", "id", "n_shingles", "fp1", "fp2", "bands", "sig", "parity"])

    return C.bounded(docs).select("doc_id", row_id().alias("id"), "text").mapInArrow(run, "doc_id long, id long, n_shingles long, fp1 long, fp2 long, bands array<long>, sig binary, parity array<long>")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of the nodes of edges (a, b); comp is the least node reachable.

    Alternating large-star and small-star; neighbours are never gathered, only their least is.
    """
    e = C.checkpoint(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = C.checkpoint(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _stars(e: DataFrame) -> bool:
    """Whether each node of edges u > v either has one lesser neighbour, and no greater, or greater ones only."""
    sides = e.select(F.col("u").alias("n"), F.lit(1).alias("lesser"), F.lit(0).alias("greater")).unionByName(e.select(F.col("v").alias("n"), F.lit(0).alias("lesser"), F.lit(1).alias("greater")))
    nodes = sides.groupBy("n").agg(F.sum("lesser").alias("lesser"), F.max("greater").alias("greater"))
    return nodes.where("lesser > 1 or (lesser = 1 and greater = 1)").isEmpty()


def _joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """The components with more links: those of the stars and the links."""
    return components(comp.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(links.select("a", "b")))


def _confirmed(pairs: DataFrame, sig: DataFrame, texts: DataFrame, cfg: MinHashConfig) -> DataFrame:
    """The pairs (a, b) whose signatures agree well enough and whose sets reach the similarity."""
    least = int(cfg.agree * cfg.bands * cfg.rows)

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if t.num_rows:
                x, y = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint8).reshape(t.num_rows, -1) for c in ("sa", "sb"))
                yield t.select(["a", "b"]).filter(pa.array((x == y).sum(1) >= least))

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in C.slices(batches, "tb", 1 << 19):
            first, second = t.column("ta").dictionary_encode(), t.column("tb").dictionary_encode()
            x, y = sets(first.dictionary, cfg.words), sets(second.dictionary, cfg.words)
            ok = []
            for i, j in zip(first.indices.to_pylist(), second.indices.to_pylist(), strict=True):
                both = len(np.intersect1d(x[i], y[j], assume_unique=True))
                ok.append(both > 0 and 100 * both >= cfg.percent * (len(x[i]) + len(y[j]) - both))
            yield t.select(["a", "b"]).filter(pa.array(ok))

    s = sig.select("rep", "sig")
    joined = pairs.join(s.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a").join(s.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb")
    passed = joined.mapInArrow(agreeing, "a long, b long")
    full = passed.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("tb")), "b").join(texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")), "a")
    return full.select("a", "b", "ta", "tb").mapInArrow(alike, "a long, b long")


def linked(docs: DataFrame, cfg: MinHashConfig | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    return _linked(docs, cfg or MinHashConfig()).drop("id")


def _linked(docs: DataFrame, cfg: MinHashConfig) -> DataFrame:
    """What `linked` gives, with each row's id."""
    made = C.written(signatures(docs, cfg), "signatures")
    full = made.where("n_shingles > 0")
    reps = C.written(full.groupBy("fp1", "fp2").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig"), F.first("parity").alias("parity"), F.first("n_shingles").alias("size")), "representatives")
    # what is known of each key is written before it is joined: a join of two tables can be split at a hot key, one with an aggregate can't
    keyed = reps.select("rep", F.explode("bands").alias("key"))
    shared = C.written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "keys")
    bucketed = C.written(keyed.join(shared, "key"), "buckets")
    # an original shares more with its copies than they with each other: it has most neighbours, and leads
    near = bucketed.groupBy("rep").agg(F.sum(F.col("n") - 1).alias("near"))
    ranked = C.written(bucketed.join(near, "rep").select("key", "rep", "near"), "ranked")
    leaders = C.written(ranked.groupBy("key").agg(F.max_by("rep", F.struct("near", -F.col("rep"))).alias("leader")), "leaders")
    members = C.written(ranked.join(leaders, "key"), "members")
    # written first, so that texts of documents without a neighbour are dropped where they are read
    wanted = C.written(members.select(F.col("rep").alias("doc_id")).distinct(), "wanted")
    texts = C.written(docs.select(row_id().alias("doc_id"), "text").join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, "doc_id").select(F.col("doc_id").alias("rep"), "text").dropDuplicates(["rep", "text"]), "texts")
    sig = reps.select("rep", "sig")
    # round 1: one document of each bucket leads
    pairs = members.where("rep <> leader").select(F.least("leader", "rep").alias("a"), F.greatest("leader", "rep").alias("b")).distinct()
    comp = components(_confirmed(pairs, sig, texts, cfg))
    rest = members.where("rep <> leader").select("key", "rep", "near")
    for k in _counts(cfg):
        now = rest.join(comp.select(F.col("node").alias("rep"), "comp"), "rep", "left").select("key", "rep", "near", F.coalesce("comp", "rep").alias("comp"))
        # anew each round: fewer documents are active, so that more shingles are rare
        now = C.checkpoint(now)
        open_ = C.checkpoint(_mixed(now))
        if open_.isEmpty():
            break
        bound, alike = _rare(open_, texts, reps, cfg)
        by_rare = C.checkpoint(_confirmed(alike, sig, texts, cfg))
        if not by_rare.isEmpty():
            comp = _joined(comp, by_rare)
            now = rest.join(comp.select(F.col("node").alias("rep"), "comp"), "rep", "left").select("key", "rep", "near", F.coalesce("comp", "rep").alias("comp"))
        marked = C.checkpoint(now.join(bound.where(~F.col("done")), "rep").withColumn("h", F.xxhash64("rep", F.lit(k))))
        active = C.checkpoint(_mixed(marked))
        if active.isEmpty():
            break
        # about k of a bucket's documents lead, one at least, all if there are no more
        share = (F.col("h").cast("double") + 2.0**63) / 2.0**64
        active = active.withColumn("leads", (F.col("rep") == F.col("top")) | (share * F.col("n") < k - 1))
        lead = active.where("leads").select("key", F.col("rep").alias("lead"), F.col("comp").alias("lead_comp"), F.col("size").alias("lead_size"), F.col("rare").alias("lead_rare"), F.col("parity").alias("lead_parity"))
        both = F.least(F.col("size") - F.col("rare"), F.col("lead_size") - F.col("lead_rare"))
        possible = both * 100 >= (F.col("size") + F.col("lead_size") - both) * cfg.percent
        # the sets differ in `differ` shingles at least; asked last, as it costs most
        differ = sum((F.bit_count(F.col("parity")[i].bitwiseXOR(F.col("lead_parity")[i])) for i in range(PARITY_WORDS)), F.lit(0))
        close = differ * (100 + cfg.percent) <= (F.col("size") + F.col("lead_size")) * (100 - cfg.percent)
        once = ~F.col("leads") | (F.col("lead") < F.col("rep"))  # of two that lead, one asks
        pairs = active.join(lead, "key").where((F.col("comp") != F.col("lead_comp")) & once & possible & close).select(F.least("lead", "rep").alias("a"), F.greatest("lead", "rep").alias("b")).distinct()
        more = C.checkpoint(_confirmed(pairs, sig, texts, cfg))
        rest = C.checkpoint(active.select("key", "rep", "near").join(lead.select("key", F.col("lead").alias("rep")), ["key", "rep"], "left_anti"))
        if not more.isEmpty():
            comp = _joined(comp, more)
    classes = reps.select("fp1", "fp2", "rep").join(comp.select(F.col("node").alias("rep"), "comp"), "rep", "left").select("fp1", "fp2", F.coalesce("comp", "rep").alias("component_id"))
    joined = full.select("doc_id", "id", "n_shingles", "fp1", "fp2").join(classes, ["fp1", "fp2"]).select("doc_id", "id", "n_shingles", "component_id")
    alone = made.where("n_shingles = 0").select("doc_id", "id", "n_shingles", F.col("id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("id") == F.col("component_id"))


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of buckets with several components, with the bucket's size and its document of most neighbours."""
    several = rows.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("n"), F.max_by("rep", F.struct("near", -F.col("rep"))).alias("top")).where("low < high").select("key", "n", "top")
    return rows.join(C.checkpoint(several), "key")


def _rare(active: DataFrame, texts: DataFrame, reps: DataFrame, cfg: MinHashConfig) -> tuple[DataFrame, DataFrame]:
    """Of the active documents (rep, size, rare, done), and the pairs (a, b) to compare for their rare shingles.

    An intersection is at most a document's common shingles and the rare ones that both have. done:
    the common ones alone don't reach the similarity with anything.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.slices(batches, "text"):
            found = sets(b.column("text"), cfg.words)
            n = [len(x) for x in found]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.asarray(b.column("rep")), n), pa.int64()), pa.array(np.concatenate(found).view(np.int64))], names=["rep", "shingle"])

    ids = active.select("rep", "comp").distinct()
    rows = C.bounded(texts).join(ids, "rep").select("rep", "text").mapInArrow(run, "rep long, shingle long")
    # one more than `rare` of a shingle's documents tell that it is common; Spark drops others before the shuffle
    first = rows.withColumn("n", F.dense_rank().over(Window.partitionBy("shingle").orderBy("rep"))).where(F.col("n") <= cfg.rare + 1)
    lists = C.checkpoint(first.groupBy("shingle").agg(F.sort_array(F.collect_set("rep")).alias("reps")).where(F.size("reps") <= cfg.rare).select("reps"))
    each = lists.select(F.explode("reps").alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("rare"))
    bound = ids.join(reps.select("rep", "size", "parity"), "rep").join(each, "rep", "left").select("rep", "comp", "size", "parity", F.coalesce("rare", F.lit(0)).alias("rare"))
    bound = C.checkpoint(bound.withColumn("done", (F.col("size") - F.col("rare")) * 100 < F.col("size") * cfg.percent))
    two = F.expr("flatten(transform(reps, (x, i) -> transform(slice(reps, i + 2, size(reps)), y -> struct(x AS a, y AS b))))")
    shared = lists.where(F.size("reps") > 1).select(F.explode(two).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("both"))
    for side in ("a", "b"):
        shared = shared.join(bound.select(*[F.col(c).alias(side if c == "rep" else f"{c}_{side}") for c in ("rep", "comp", "size", "rare")]), side)
    both = F.least(F.col("size_a") - F.col("rare_a"), F.col("size_b") - F.col("rare_b")) + F.col("both")
    possible = both * 100 >= (F.col("size_a") + F.col("size_b") - both) * cfg.percent
    return bound.drop("comp"), shared.where((F.col("comp_a") != F.col("comp_b")) & possible).select("a", "b")


def _counts(cfg: MinHashConfig) -> Iterator[int]:
    yield from cfg.leaders[1:]
    k = cfg.leaders[-1]
    while True:
        k *= 8
        yield k


def keep(docs: DataFrame, cfg: MinHashConfig | None = None) -> DataFrame:
    """docs with one row of each component: of its least id, and of that id's texts the least."""
    own, place = C.unused("id", docs), C.unused("place", docs)
    kept = C.written(_linked(docs, cfg or MinHashConfig()).where("kept").select(F.col("id").alias(own)).distinct(), "kept")
    joined = docs.withColumn(own, row_id()).join(kept, own)
    first = F.row_number().over(Window.partitionBy(own).orderBy(F.asc_nulls_first("text"), *[F.col(c) for c in docs.columns if c not in ("doc_id", "text") and _orderable(docs, c)]))
    return joined.withColumn(place, first).where(F.col(place) == 1).select(docs.columns)


def _orderable(docs: DataFrame, name: str) -> bool:
    return docs.schema[name].dataType.typeName() not in ("map", "variant", "struct", "array")


#: The registered query's parameters.
QUERY = MinHashConfig(words=3, percent=85)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(C.table(spark, sf_dir, "documents"), QUERY)
