"""Canonical exact document fingerprints.

A text's canonical form is NFKC, case-folded, with each run of white space as one space and none at
the ends. Its fingerprint is the 128-bit xxh3 digest of that form's UTF-8. Documents of one digest are a
bucket; inside it each form is compared, byte by byte, with the form of the bucket's first document.
Forms that differ, which takes a collision of 128 bits, get the form's sha256 added to their fingerprint.

Documents stand in the order of doc_id, then of the text's 64-bit hash; those without doc_id come last, by
that hash. Equal rows are one document of the buckets, and each gives its row.

Defined results: a null text is empty, and empty texts share the fingerprint of the empty form; rows of one
doc_id follow each other by hash; a row without doc_id has a row with a null doc_id; likeness of exact
digests is 1.0 or 0.0, confirmed on the bytes; group_id is the least doc_id with the same form (null if none
has one); further columns are ignored; an empty table gives no rows; one document follows itself.
"""

from __future__ import annotations

import hashlib
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brickwork.llm import common as C

SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
KEY = ["unnamed", "k2", "k3"]


def canonical(text: str | None) -> str:
    if not text:
        return ""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    else:
        text = text.lower()
    return " ".join(text.split())


def fingerprint(text: str | None) -> str:
    return xxhash.xxh3_128_hexdigest(canonical(text).encode())


def _keyed(docs: DataFrame) -> DataFrame:
    """KEY and text; KEY is a document's place in the order, and tells it from others."""
    text = F.coalesce("text", F.lit(""))
    named = F.col("doc_id").isNotNull()
    return docs.select((~named).alias("unnamed"), F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("k2"), F.when(named, F.xxhash64(text)).otherwise(0).alias("k3"), text.alias("text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """KEY and digest of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.slices(batches, "text"):
            digests = [xxhash.xxh3_128_digest(canonical(x).encode()) for x in C.strings(b.column("text"))]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in KEY), pa.array(digests, pa.binary())], names=[*KEY, "digest"])

    return C.bounded(_keyed(docs)).mapInArrow(run, "unnamed boolean, k2 long, k3 long, digest binary").distinct()


def _rank() -> Column:
    return F.struct(*KEY)


def with_edits(docs: DataFrame) -> DataFrame:
    """SCHEMA and group_id: each document's fingerprint, and that of its text with the second half taken from the next one.

    Documents are dealt into ranges of their order, so that the text moves once. The first document of a
    range goes to the range before too; only these firsts' keys, one a range, come to the driver. The
    documents of buckets come out with their forms, which then meet the form of the bucket's first.
    """
    spark = docs.sparkSession
    lean = C.written(fingerprints(docs), "fingerprints")
    buckets = C.written(lean.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(_rank()).alias("first")).where("n > 1").select("digest", "first"), "fingerprint-buckets")
    member = lean.join(buckets, "digest").select(*KEY, "digest", (_rank() == F.col("first")).alias("leads"))
    parts = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")) * 2)
    spread = lean.select(KEY).repartitionByRange(parts, *KEY).select(*KEY, F.spark_partition_id().alias("part"))
    bounds = sorted(tuple(r[1]) for r in spread.groupBy("part").agg(F.min(_rank())).collect())  # empty only if there are no rows

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = list(zip(*(b.column(k).to_pylist() for k in KEY), strict=True))
            part = [max(bisect_right(bounds, k) - 1, 0) for k in keys]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([False] * len(part)), *b.columns], names=["part", "ahead", *b.schema.names])
            is_text = b.column("is_text").to_pylist()
            at = [i for i, k in enumerate(keys) if is_text[i] and (j := bisect_left(bounds, k)) < len(bounds) and bounds[j] == k]
            if at:
                to = [(part[i] - 1) % len(bounds) for i in at]
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array([True] * len(at)), *(c.take(pa.array(at)) for c in b.columns)], names=["part", "ahead", *b.schema.names])

    texts = _keyed(docs).select(*KEY, F.lit(True).alias("is_text"), "text", F.lit(None).cast("boolean").alias("leads"))
    flags = member.select(*KEY, F.lit(False).alias("is_text"), F.lit(None).cast("string").alias("text"), "leads")
    kind = "part int, ahead boolean, unnamed boolean, k2 long, k3 long, is_text boolean, text string, leads boolean"
    dealt = C.bounded(texts.unionByName(flags)).mapInArrow(deal, kind)
    ordered = dealt.repartition(parts, "part").sortWithinPartitions("part", "ahead", *KEY, "is_text", "text")
    made = C.written(ordered.mapInArrow(_edited, f"{SCHEMA}, leads boolean, form string"), "edits")
    return _compared(made)


def _compared(made: DataFrame) -> DataFrame:
    """SCHEMA and group_id of rows with the forms of buckets' documents; forms are compared with the first's."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    first = made.where("leads").groupBy("fingerprint").agg(F.first("form").alias("first_form"), F.first("doc_id").alias("group_id"))
    # a sort-merge join of two tables, which Spark splits at a large bucket; forms go no further than it
    firsts = C.written(first, "fingerprint-firsts").hint("merge")
    differs = F.when(F.col("form") != F.col("first_form"), F.sha2("form", 256))
    compared = C.written(made.where("form IS NOT NULL").join(firsts, "fingerprint").select(*names, "group_id", differs.alias("own")), "fingerprint-compared")
    same = compared.where("own IS NULL").select(*names, "group_id")
    apart = compared.where("own IS NOT NULL").drop("group_id")
    least = apart.groupBy("fingerprint", "own").agg(F.min("doc_id").alias("group_id"))
    other = apart.join(least, ["fingerprint", "own"]).withColumn("fingerprint", F.concat_ws("-", "fingerprint", "own"))
    alone = made.where("form IS NULL").select(*names, F.col("doc_id").alias("group_id"))
    return alone.unionByName(same).unionByName(other.select(*names, "group_id"))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    held = None  # part, doc_id, text, fingerprint, leads of the document that waits for the next one
    flag: tuple | None = None  # key and leads of the bucket's document that comes next
    for b in C.slices(batches, "text"):
        for part, ahead, unnamed, k2, k3, is_text, text, leads in zip(*(c.to_pylist() for c in b.columns), strict=True):
            key = (unnamed, k2, k3)
            if not is_text:
                flag = (key, leads)
                continue
            own = (part, None if unnamed else k2, text, fingerprint(text), flag[1] if flag is not None and flag[0] == key else None)
            if held is not None and held[0] == part:
                out.append(_row(held, own))
                held = None
            if not ahead:
                held = own
        if out:
            yield _batch(out)
            out = []


def _row(held: tuple, following: tuple) -> tuple:
    _, doc_id, text, print_, leads = held
    half = len(text) // 2
    edited = text[: len(text) - half] + following[2][:half]
    changed = print_ if edited == text else fingerprint(edited)
    near = [float(p == print_ and (x == text or canonical(x) == canonical(text))) for p, x in ((changed, edited), (following[3], following[2]))]
    return doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), print_, changed, *near, leads, None if leads is None else canonical(text)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.bool_(), pa.string()]
    names = [*(x.split()[0] for x in SCHEMA.split(", ")), "leads", "form"]
    return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_edits(C.table(spark, sf_dir, "documents"))
