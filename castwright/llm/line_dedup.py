"""Operator 5: line deduplication with levelled sorted runs of line hashes.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` and lower-cased (A-Z); keys of at least
``min_chars`` code points count. Each document gives one record per distinct key: a 128-bit hash.

``LineRuns`` keeps what is known about keys as sorted runs in levels: hash-bucketed tables in the shared
folder, sorted by the line hash. Each new batch of documents is aggregated (map-side first), merge-anti-joined
with the live runs, one after another and read by their buckets, which splits its keys into unseen and
known ones; both become the batch's run at level 0 (n documents, largest doc_id, and whether the run is the
first to hold the key). As soon as a level has ``fanout`` runs they are merged to one run of the next
level, so each record is rewritten once per level. Batches hold at most about ``BATCH_RECORDS`` records a bucket.

``dedup_lines`` adds the whole corpus to the runs in batches, adds up the counts of each key over the runs
that are left, and joins the records with the keys that at least ``min_docs`` documents hold; each
document loses those lines unless it has the largest doc_id. The runs' tables and files are dropped then.

* A hot line (a third of all documents) is pre-aggregated in each task; the few lines that more than 1/1000
  of all records share meet their records by a broadcast, the others by a shuffle (``common.join_groups``).
* Texts are shuffled once, to meet the hashes that they lose. Both sides go by id and a hash of the text, so
  rows that share an id, or have none, do not meet unless their texts are the same.

Edge cases: each row is a document, repeated rows and equal ids included; a null ``doc_id`` ranks
below every id. Null text gives one empty line and the text ''. Ties of the largest id all keep
their lines. Empty table: empty result. Other columns pass through; helper names avoid theirs.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from castwright.llm.common import clashless, join_groups, utf8
from castwright.session import drop_folder, ensure_checkpoint_dir, materialize

MIN_CHARS = 20
MIN_DOCS = 3
FANOUT = 2
#: Batches of a corpus at least, and records of a batch for each bucket of its run.
MIN_BATCHES = 4
BATCH_RECORDS = 1 << 20
BLANK = b" \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> tuple[int, int] | None:
    """128-bit hash (two signed longs) of a line's key; None for a short key."""
    key = line.strip(BLANK).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "surrogatepass")) < min_chars:
        return None
    whole = xxhash.xxh3_128_digest(key)
    return int.from_bytes(whole[:8], "big", signed=True), int.from_bytes(whole[8:], "big", signed=True)


def text_hash(text) -> Column:
    """Tells rows of the same id apart by what they hold."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_records(docs: DataFrame, batches: int = MIN_BATCHES, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_hash, h1, h2, batch: one row for each document and distinct long key in it."""
    ids = dict(docs.dtypes)["doc_id"]

    def run(parts):
        for part in parts:
            at, one, two = [], [], []
            for i, text in enumerate(part.column(2).to_pylist()):
                keys = {k for x in utf8(text).split(b"\n") if (k := line_key(x, min_chars))}
                at += [i] * len(keys)
                one += [k[0] for k in keys]
                two += [k[1] for k in keys]
            took = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0).take(took), part.column(1).take(took), pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=["doc_id", "text_hash", *KEY])

    made = docs.select("doc_id", text_hash(F.col("text")).alias("text_hash"), "text").mapInArrow(run, f"doc_id {ids}, text_hash long, h1 long, h2 long")
    return in_batches(made, batches)


def in_batches(records: DataFrame, batches: int) -> DataFrame:
    return records.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(batches)).cast("int"))


class LineRuns:
    """Levelled sorted runs of line hashes in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/line-runs-{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def _write(self, run: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = f"{self.root}/{len(self.paths)}"
        dealt = run.repartition(self.buckets, *KEY)
        dealt.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", self.paths[name]).saveAsTable(name)
        return name

    def _together(self, names: list[str]) -> DataFrame | None:
        """Runs under one another. A single run is read as its bucketed table. Several are read as plain
        files: a union of bucketed tables claims their bucketing, the planner drops the exchange on that
        claim and then the bucketed reads, and equal keys of two runs would not meet."""
        if len(names) > 1:
            schema = self.spark.table(names[0]).schema  # runs without a row have no file to tell it
            return self.spark.read.schema(schema).parquet(*[self.paths[name] for name in names])
        return self.spark.table(names[0]) if names else None

    def all(self) -> DataFrame | None:
        """Every live run (a key may stand in several)."""
        return self._together([name for level in self.levels for name in level])

    def add(self, records: DataFrame) -> None:
        """The run of a batch at level 0, its unseen and its known keys; full levels are merged."""
        batch = self._write(records.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_id")))
        rows = self.spark.table(batch)
        unseen = self.unseen(rows)
        known = rows.join(unseen.select(*KEY).hint("merge"), KEY, "left_anti")
        self._push(0, unseen.withColumn("first", F.lit(True)).unionByName(known.withColumn("first", F.lit(False))))
        self._drop([batch])

    def _push(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self._write(run))
        if len(self.levels[level]) >= self.fanout:
            self._compact(level, level + 1)

    def _compact(self, level: int, into: int) -> None:
        names, self.levels[level] = self.levels[level], []
        merged = self._together(names).groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("last_id").alias("last_id"), F.max("first").alias("first"))
        self._push(into, merged)
        self._drop(names)

    def unseen(self, records: DataFrame) -> DataFrame:
        """Records whose key no run holds: a merge anti-join with each live run, read by its buckets. Of
        the runs that hold a key one is its first, so only first keys are looked at."""
        for name in (name for level in self.levels for name in level):
            records = records.join(self.spark.table(name).where("first").select(*KEY).hint("merge"), KEY, "left_anti")
        return records

    def frequent(self, min_docs: int) -> DataFrame:
        """Keys that at least ``min_docs`` documents hold over all runs, their number and the largest id."""
        runs = self.all()
        merged = runs.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("last_id").alias("last_id"))
        return merged.where(F.col("n_docs") >= min_docs)

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            drop_folder(self.spark, self.paths[name])

    def drop(self) -> None:
        """Remove the live runs, their tables and the folder."""
        self._drop([name for level in self.levels for name in level])
        self.levels = []
        drop_folder(self.spark, self.root)


def lost_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None, fanout: int = FANOUT) -> DataFrame:
    """doc_id, text_hash and the hashes (array of structs h1, h2) of the keys that the document loses."""
    spark = docs.sparkSession
    records = materialize(line_records(docs, 1, min_chars).drop("batch"), "line-records")
    runs = LineRuns(spark, fanout)
    batches = batches or max(MIN_BATCHES, -(-records.count() // (BATCH_RECORDS * runs.buckets)))
    dealt = in_batches(records, batches)
    for batch in range(batches):
        runs.add(dealt.where(F.col("batch") == batch))
    frequent = materialize(runs.frequent(min_docs).withColumn("shared", F.lit(True)), "frequent-lines")
    runs.drop()
    met = join_groups(records, frequent, {k: k for k in KEY}, "n_docs", ["shared", "last_id"], F.xxhash64("doc_id", "text_hash"))
    drops = met.where(F.col("shared") & ~F.col("doc_id").eqNullSafe(F.col("last_id")))
    return drops.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct(*KEY)).alias("lost"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None, fanout: int = FANOUT, counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with ``text`` less its lost lines; ``counts`` names two more columns, the lines
    before dropping and the dropped ones."""
    id_, own, lost, n_lines, n_dropped = clashless(docs, "lost_id", "own_hash", "lost", *(counts or ("n_lines", "n_dropped")))
    gone = lost_lines(docs, min_chars, min_docs, batches, fanout).select(F.col("doc_id").alias(id_), F.col("text_hash").alias(own), F.col("lost").alias(lost))
    same = docs["doc_id"].eqNullSafe(gone[id_]) & (text_hash(docs["text"]) == gone[own])
    met = docs.join(gone, same, "left").drop(id_, own)
    at, to = met.columns.index("text"), met.columns.index(lost)
    names = [x for x in met.columns if x != lost]

    def run(parts):
        for part in parts:
            texts, n, dropped = [], [], []
            for text, keys in zip(part.column(at).to_pylist(), part.column(to).to_pylist()):
                lines = utf8(text).split(b"\n")
                gone = {(k["h1"], k["h2"]) for k in keys or ()}
                kept = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
                texts.append(b"\n".join(kept).decode("utf-8", "surrogatepass"))
                n.append(len(lines))
                dropped.append(len(lines) - len(kept))
            cols = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(part.columns) if i != to]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(dropped, pa.int64())], names=[*names, n_lines, n_dropped])

    schema = docs.select("*", F.lit(0).cast("long").alias(n_lines), F.lit(0).cast("long").alias(n_dropped)).schema
    out = met.mapInArrow(run, schema)
    return out if counts else out.drop(n_lines, n_dropped)
