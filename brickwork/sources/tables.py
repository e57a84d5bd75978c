"""Scans, snapshot tables and the set-oriented writes of the pipeline.

A table is a folder of parts and numbered manifests that list them. Appending writes a part and a new
manifest, so it costs what is new; no path that is read is overwritten.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brickwork.schemas import HIT_DDL, TABLES, VERSION


def read_hits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON lines with the untouched line as raw_data, and the file's name and time; a bad line raises, an empty folder is an error."""
    return parsed_hits(spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_modification_time").alias("file_time")))


def parsed_hits(lines: DataFrame) -> DataFrame:
    return lines.where(F.trim("value") != "").select("file", "file_time", F.col("value").alias("raw_data"), F.from_json("value", HIT_DDL, {"mode": "FAILFAST"}).alias("hit"))


def write_hits(hits: DataFrame, path: str) -> None:
    hits.write.mode("append").json(path)


def read_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A CSV with at least the columns of ddl, in any order; a missing one raises."""
    found = spark.read.option("header", True).csv(path)
    return contract(found, ddl)


def contract(df: DataFrame, ddl: str) -> DataFrame:
    """The columns of ddl with their types; raises if one is missing."""
    wanted = [tuple(x.split()) for x in re.split(r",\s*(?![^<]*>)", ddl)]
    missing = [n for n, _ in wanted if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select([F.col(n).try_cast(t).alias(n) for n, t in wanted])


def external_id(named: Column, number: Column) -> Column:
    """The portal's own id, else the number; "" and 0 count as missing."""
    return F.coalesce(F.nullif(named, F.lit("")), F.when(number != 0, number.cast("string")))


def scraped_at(stamp: Column, hits: DataFrame) -> Column:
    """The scrape's time; where it is missing or bad the file's, which stays the same when the file is read again."""
    other = F.col("file_time") if "file_time" in hits.columns else F.lit(None).cast("timestamp")
    return F.coalesce(F.try_to_timestamp(stamp, F.lit("yyyyMMdd'T'HHmmss'Z'")), other, F.to_timestamp(F.lit("1970-01-01")))


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality of keys where null equals null."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage in the shared folder spark.checkpoint.dir; only where that is unset in local mode (tests) in one of our own."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not sc.getConf().get("spark.checkpoint.dir") and not re.match(r"local($|\[)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir") or "file://" + tempfile.mkdtemp(prefix="checkpoint"))
    return df.checkpoint()


def first_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def absent(incoming: DataFrame, existing: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The rows to append: the first of each key that existing hasn't got."""
    new = first_per(incoming, keys, order)
    return new.join(existing.select(keys).distinct().alias("e"), [new[k].eqNullSafe(F.col(f"e.{k}")) for k in keys], "left_anti")


def upserted(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """incoming over existing; incoming has one row a key."""
    kept = existing.join(incoming.select(keys).distinct().alias("i"), [existing[k].eqNullSafe(F.col(f"i.{k}")) for k in keys], "left_anti")
    return kept.unionByName(incoming)


def newest(existing: DataFrame, incoming: DataFrame, keys: list[str], stamp: str, order: list[Column]) -> DataFrame:
    """incoming over existing where its stamp is later; on ties the existing row stays."""
    both = existing.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)))
    return first_per(both, keys, [F.desc(stamp), F.asc("__new"), *order]).drop("__new")


def updated(df: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """df with the columns of the rows that changes names."""
    new = changes.select(F.col(key).alias("__key"), F.lit(True).alias("__hit"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = df.join(new, df[key] == new["__key"], "left")
    return joined.select(*[F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])


def with_ids(df: DataFrame, order: list[str], base: int = 0) -> DataFrame:
    """Dense ids from base + 1 in natural order, without one task for all rows.

    Rows are dealt into sorted ranges; the ranges' sizes, one number each, shift the ids within.
    """
    ranged = checkpoint(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()))
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("low")).orderBy("__part").collect()
    shift, rows = base, []
    for r in sizes:
        rows.append((r["__part"], shift + 1 - r["low"]))
        shift += r["n"]
    if not rows:
        return df.withColumn("id", F.lit(0).cast("bigint")).limit(0)
    shifts = df.sparkSession.createDataFrame(rows, "__part int, __shift bigint")
    return ranged.join(F.broadcast(shifts), "__part").withColumn("id", F.col("__at") + F.col("__shift")).select("id", *df.columns)


#: Parts of a table from which on an append writes them anew as one, and manifests that stay readable.
MOST_PARTS, KEPT = 64, 3


class Store:
    """Tables of Parquet parts under a root that Spark can reach; one writer a table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        p = self._path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _manifests(self, name: str) -> list[int]:
        fs, p = self._fs(f"{self.root}/{name}")
        names = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(m[1]) for x in names if (m := re.fullmatch(r"manifest-(\d+)\.json", x)))

    def _load(self, name: str, number: int) -> dict:
        fs, p = self._fs(f"{self.root}/{name}/manifest-{number:08d}.json")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, name: str, last: int, parts: list[str]) -> None:
        """Manifest last + 1, written aside and renamed; raises if another writer was first."""
        fs, to = self._fs(f"{self.root}/{name}/manifest-{last + 1:08d}.json")
        aside = self._path(f"{self.root}/{name}/_aside-{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps({"parts": parts, "schema": VERSION}).encode()))
        out.close()
        if fs.exists(to) or not fs.rename(aside, to):
            fs.delete(aside, False)
            raise RuntimeError(f"{name} was changed by another writer")

    def parts(self, name: str) -> list[str]:
        found = self._manifests(name)
        return self._load(name, found[-1])["parts"] if found else []

    def exists(self, name: str) -> bool:
        return bool(self._manifests(name))

    def read(self, name: str) -> DataFrame:
        """The current parts, or an empty frame of the table's schema; columns that older parts lack are null."""
        if not (parts := self.parts(name)):
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(*[f"{self.root}/{name}/{p}" for p in parts])

    def _part(self, name: str, df: DataFrame) -> str:
        part = f"part-{uuid.uuid4().hex}"
        columns = [c.name for c in self.spark.createDataFrame([], TABLES[name]).schema]
        df.select(columns).write.parquet(f"{self.root}/{name}/{part}")
        return part

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Replaces the table's rows by df's; parts that no kept manifest lists are removed."""
        found = self._manifests(name)
        self._commit(name, found[-1] if found else 0, [self._part(name, df)])
        self.clean(name)
        return self.read(name)

    def append(self, name: str, df: DataFrame) -> DataFrame:
        """Adds df's rows as a part; what is there is neither read nor written, but for many small parts."""
        found, parts = self._manifests(name), self.parts(name)
        if len(parts) >= MOST_PARTS:
            return self.write(name, self.read(name).unionByName(df))
        self._commit(name, found[-1] if found else 0, [*parts, self._part(name, df)])
        return self.read(name)

    def clean(self, name: str) -> int:
        """Removes manifests but the last ones, and parts that these don't list; returns how many paths."""
        numbers = self._manifests(name)
        kept = {p for n in numbers[-KEPT:] for p in self._load(name, n)["parts"]} | {f"manifest-{n:08d}.json" for n in numbers[-KEPT:]}
        fs, p = self._fs(f"{self.root}/{name}")
        gone = [x.getPath() for x in fs.listStatus(p) if x.getPath().getName().startswith(("part-", "manifest-")) and x.getPath().getName() not in kept]
        for path in gone:
            fs.delete(path, True)
        return len(gone)

    def pending(self, source: str) -> list[tuple[str, str, int]]:
        """(path, name, time) of the folder's files that no run has taken, by name and modification time."""
        fs, p = self._fs(source)
        there = [(x.getPath().toString(), x.getPath().getName(), x.getModificationTime()) for x in fs.listStatus(p) if x.isFile() and not x.getPath().getName().startswith(("_", "."))]
        if not there:
            return []
        files = self.spark.createDataFrame(there, "path string, file string, modified_at bigint")
        return sorted(tuple(r) for r in files.join(self.read("processed_files").select("file", "modified_at"), ["file", "modified_at"], "left_anti").select("path", "file", "modified_at").collect())

    def archive(self, files: list[str], target: str) -> int:
        """Moves files that were read; returns how many."""
        fs, to = self._fs(target)
        fs.mkdirs(to)
        return sum(bool(fs.rename(self._path(f), self._path(f"{target}/{f.rsplit('/', 1)[-1]}"))) for f in files)

    def check(self) -> dict[str, str]:
        """Of each table "ok", "missing", or how its newest part's columns differ from the schema."""
        out = {}
        for name, ddl in TABLES.items():
            if not (parts := self.parts(name)):
                out[name] = "missing"
                continue
            wanted = {f.name: f.dataType.simpleString() for f in self.spark.createDataFrame([], ddl).schema}
            there = dict(self.spark.read.parquet(f"{self.root}/{name}/{parts[-1]}").dtypes)
            differs = sorted(c for c in {*wanted, *there} if wanted.get(c) != there.get(c))
            out[name] = f"differs in {differs}" if differs else "ok"
        return out
