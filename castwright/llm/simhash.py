"""Operator 1: SimHash near-duplicates by tiled exact comparison.

Fingerprints (64 bits over word shingles, XXH64 seed 42) are made row by row. Equal ones
collapse by an aggregate first, so only distinct fingerprints are compared. They are dealt into
tiles by the population counts of their two halves; a tile is compared with another only where
those counts are within the radius (|pop(a) - pop(b)|, summed over the halves, never exceeds the
number of differing bits). Within a pair of tiles the same rule skips blocks by the counts of the
four quarters, and what remains is compared exactly with numpy exclusive-or and bit counts.

* A tile holds at most about ``tile`` fingerprints: crowded counts are cut by a hash, and the
  cuts of two such tiles meet pairwise. No fingerprint, bucket or group is left out.
* A task returns a star per local component, not the pairs of a group, so a group of thousands
  of near copies costs as many links as it has fingerprints.
* Components over all links come from rounds of large-star and small-star steps, each written to
  the shared checkpoint folder; nothing is gathered on the driver.

Edge cases: null and empty texts have no words and the fingerprint zero, which links like any
other. Repeated rows each get a row. A null ``doc_id`` is ignored by the minimum; a component
without any id has a null ``component_id``. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castwright.llm.common import add_arrow_columns, clashless, components, utf8, word_chunks
from castwright.session import materialize

SHINGLE = 4
RADIUS = 4
SEED = 42
TILE = 16384
BLOCK = 256


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """64-bit SimHash of the whole text (bit set in over half of the shingles)."""
    data = utf8(text).lower()  # bytes.lower touches A-Z only
    ones, total, tail = np.zeros(64, np.int64), 0, []
    for words in word_chunks(data):
        words = tail + words
        if len(words) >= k:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            first, last = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
            h = np.fromiter((xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(first, last)), np.uint64, len(first))
            for at in range(0, len(h), 8192):
                part = h[at : at + 8192]
                ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            total += len(h)
            tail = words[len(words) - k + 1 :]
        else:
            tail = words
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED) if tail else 0
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of each row."""

    def run(batches):
        for batch in batches:
            made = np.fromiter((fingerprint(t, k) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["doc_id", "fp"])

    ids = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {ids}, fp long")


def _quarters(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp.view(np.uint16).reshape(len(fp), 4)).astype(np.int16)


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int, block: int = BLOCK):
    """Index pairs (i, j) with at most ``radius`` differing bits, in bounded parts."""
    qa, qb = _quarters(a), _quarters(b)
    oa, ob = np.lexsort(qa.T), np.lexsort(qb.T)
    a, b, qa, qb = a[oa], b[ob], qa[oa], qb[ob]
    cuts = np.arange(0, len(b), block)
    low, high = np.minimum.reduceat(qb, cuts, axis=0), np.maximum.reduceat(qb, cuts, axis=0)
    ends = np.minimum(cuts + block, len(b))
    for at in range(0, len(a), block):
        part, q = a[at : at + block], qa[at : at + block]
        gap = np.maximum(0, np.maximum(low - q.max(0), q.min(0) - high)).sum(1)
        near = np.flatnonzero(gap <= radius)
        for some in np.array_split(near, -(-len(near) // 64)) if len(near) else ():
            cols = np.concatenate([np.arange(cuts[x], ends[x]) for x in some])
            i, j = np.nonzero(np.bitwise_count(part[:, None] ^ b[cols][None, :]) <= radius)
            yield oa[at + i], ob[cols[j]]


def tile_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars (member, smallest member) of the components that close pairs of two tiles form."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    ia, ib = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    for i, j in close_pairs(a, b, radius):
        u, v = label[ia[i]], label[ib[j]]
        if (u != v).any():
            label = components(u, v, len(nodes))[label]
    away = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[away], nodes[label[away]]


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(u, v) long links that join every pair of distinct fingerprints within the radius.

    ``fps`` has one column fp without repeats. The number of fingerprints of each pair of counts
    (at most 33 x 33 rows) is broadcast to find how often a crowded tile is cut.
    """
    counts = [F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).cast("int"), F.bit_count(F.shiftrightunsigned("fp", 32)).cast("int")]
    keyed = fps.select("fp", counts[0].alias("p"), counts[1].alias("q"))
    cuts = keyed.groupBy("p", "q").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("cuts"))
    placed = keyed.join(F.broadcast(cuts), ["p", "q"])
    tiles = placed.groupBy("p", "q", "cuts", F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int").alias("cut")).agg(F.collect_list("fp").alias("fps"))
    around = [(dp, dq) for dp in range(-radius, radius + 1) for dq in range(-radius, radius + 1) if abs(dp) + abs(dq) <= radius]
    half = [x for x in around if x >= (0, 0)]
    steps = F.explode(F.array(*[F.struct(F.lit(p).alias("dp"), F.lit(q).alias("dq")) for p, q in half]))
    left = tiles.select("p", "q", "cut", "fps", steps.alias("s"))
    left = left.select(F.col("fps").alias("a"), F.col("p").alias("p0"), F.col("q").alias("q0"), F.col("cut").alias("cut0"), (F.col("p") + F.col("s.dp")).alias("p"), (F.col("q") + F.col("s.dq")).alias("q"))
    pairs = left.join(tiles.select("p", "q", "cut", F.col("fps").alias("b")).hint("shuffle_merge"), ["p", "q"])
    pairs = pairs.where((F.col("p") != F.col("p0")) | (F.col("q") != F.col("q0")) | (F.col("cut0") <= F.col("cut")))

    def run(batches):
        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1)):
                u, v = tile_links(a.values.to_numpy().view(np.uint64), b.values.to_numpy().view(np.uint64), radius)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    spread = fps.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return pairs.select("a", "b").repartition(int(spread)).mapInArrow(run, "u long, v long")


def star_components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for every node that has an edge.

    Large-star and small-star steps by turns until neither changes the edges; each round is written
    to the shared checkpoint folder. At the end every node hangs on its root.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    print_of = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    before = now.agg(*print_of).first()
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lower, "u")
        small = joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = materialize(small.distinct(), "links")
        after = now.agg(*print_of).first()
        if after == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after


def grouped(owned: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``owned`` (a row for each distinct fingerprint fp) with the root of its component."""
    roots = star_components(links(owned.select("fp"), radius, tile))
    return owned.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable) of each row."""
    made = materialize(fingerprints(docs, k), "fingerprints")
    owned = materialize(made.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    placed = grouped(owned, radius, tile)
    first = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = placed.join(first, "root").select("fp", "component_id")
    return made.join(groups, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (rows without an id
    come last), the first of them where rows repeat an id. Row numbers are fixed by a write."""
    fp, row = clashless(docs, "fp", "row")
    made = add_arrow_columns(docs, "text", f"`{fp}` long", lambda texts: [pa.array(np.fromiter((fingerprint(t, k) for t in texts), np.uint64, len(texts)).view(np.int64))])
    made = materialize(made.withColumn(row, F.monotonically_increasing_id()), "fingerprinted")
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", F.col(row).alias("row"))
    owned = materialize(made.groupBy(F.col(fp).alias("fp")).agg(F.min(place).alias("first")), "distinct-fingerprints")
    chosen = grouped(owned, radius, tile).groupBy("root").agg(F.min("first").alias("first"))
    return made.join(chosen.select(F.col("first.row").alias(row)), row, "left_semi").drop(fp, row)
