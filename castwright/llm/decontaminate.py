"""Operator 8: benchmark decontamination by greedy string tiling.

Words are runs of ``[a-z0-9]`` and non-ASCII characters after lower-casing A-Z. Seeds are windows of
``min_tile`` words that a document shares with a benchmark item: their Karp-Rabin hashes (a running
polynomial over word numbers, modulo 2^64) are joined with the item's, and the words themselves are
compared, so a collision adds nothing. Seeds on one diagonal form maximal matches; the longest match
whose words are all unmarked is marked as a tile in both texts, again and again, what is left of an
overlapped match going back into the queue, until none of ``min_tile`` words is left. Tiles may lie
in any order, so a passage with its parts moved about is covered all the same. An item leaks into a
document when its tiles cover ``min_cover`` of its words.

The benchmark is a stated query set: it is held against all rows in blocks of at most
``block_bytes`` of text. One block travels to the tasks; with more, each block is a pass of its own
over the rows with its result written to the shared folder, so neither the driver nor a task ever
holds more than a block. Rows never meet: no shuffle, no hot key.

Edge cases: null and empty texts leak nothing; items without words never leak; an item shorter than
``min_tile`` words is matched as one tile. Repeated rows and items each count. Rows of a table with
the same or no ``doc_id`` are judged each on its own text. Empty tables give no pairs.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castwright.llm.common import utf8
from castwright.session import materialize

MIN_TILE = 5
MIN_COVER = 0.6
BLOCK_BYTES = 4 << 20
#: About how many seeds of a text are in memory at a time.
SEEDS = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(_PLAIN).lower().split()


def _hashes(ids: np.ndarray, size: int, at: np.ndarray) -> np.ndarray:
    """Karp-Rabin hashes of the windows of ``size`` words that start at ``at``."""
    h = np.zeros(len(at), np.uint64)
    for k in range(size):
        h = h * np.uint64(BASE) + ids[at + k].astype(np.uint64)
    return h


class Block:
    """Benchmark items ready for tiling."""

    def __init__(self, items: list[tuple], min_tile: int = MIN_TILE):
        self.vocab: dict[bytes, int] = {}
        self.items, self.ids = [], []
        starts = defaultdict(list)
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            ids = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words], np.int64)
            size = min(min_tile, len(ids))
            at = np.arange(len(ids) - size + 1)
            starts[size].append((np.full(len(at), len(self.items)), at, _hashes(ids, size, at)))
            self.items.append((item_id, ids, size))
        self.words = np.concatenate([ids for _, ids, _ in self.items]) if self.items else np.zeros(0, np.int64)
        self.first = np.cumsum([0, *(len(ids) for _, ids, _ in self.items)])
        self.seeds = {}
        for size, parts in starts.items():
            item, at, h = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h, kind="stable")
            self.seeds[size] = (h[order], item[order], at[order])

    def matches(self, ids: np.ndarray, size: int):
        """(item, place in the item, place in the text, seeds) of each maximal match of a text. Seeds are
        taken in parts of bounded number, and matches cut by a part are put together again."""
        keys, item, start = self.seeds[size]
        inside = np.concatenate(([0], np.cumsum(ids > 0)))
        at = np.flatnonzero(inside[size:] - inside[:-size] == size)
        h = _hashes(ids, size, at)
        low = np.searchsorted(keys, h, "left")
        n = np.searchsorted(keys, h, "right") - low
        at, low, n = at[n > 0], low[n > 0], n[n > 0]
        part = np.cumsum(n) // SEEDS
        found = []
        for a, b in _spans(np.diff(part) != 0, len(n)):
            m = n[a:b]
            row = np.repeat(low[a:b] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            k, i, j = item[row], start[row], np.repeat(at[a:b], m)
            same = np.ones(len(k), bool)
            for w in range(size):
                same &= self.words[self.first[k] + i + w] == ids[j + w]
            found.append(_joined(k[same], i[same], j[same], np.ones(same.sum(), np.int64)))
        return _joined(*(np.concatenate(x) for x in zip(*found))) if len(found) > 1 else found[0] if found else (at, at, at, at)

    def tiles(self, text: str | None) -> list[tuple]:
        """(item_id, tiles, covered words, words) for each item that shares a seed with the text."""
        ids = np.fromiter(map(self.vocab.get, words := words_of(text), [0] * len(words)), np.int64, len(words))
        out = []
        for size in self.seeds:
            if len(ids) < size:
                continue
            item, i, j, n = self.matches(ids, size)
            for a, b in _spans(np.diff(item) != 0, len(item)):
                item_id, own, _ = self.items[item[a]]
                n_tiles, covered = greedy_tiles(len(own), len(ids), i[a:b], j[a:b], n[a:b] + size - 1, size)
                out.append((item_id, n_tiles, covered, len(own)))
        return out


def _spans(new: np.ndarray, n: int):
    """(start, end) of the stretches of ``n`` rows; ``new`` says where the next row begins another."""
    cuts = (np.flatnonzero(new) + 1).tolist()
    return list(zip([0, *cuts], [*cuts, n])) if n else []


def _joined(item: np.ndarray, i: np.ndarray, j: np.ndarray, n: np.ndarray):
    """Stretches of seeds put together where one goes on from another on its diagonal."""
    order = np.lexsort((i, j - i, item))
    item, i, j, n = item[order], i[order], j[order], n[order]
    new = np.ones(len(i), bool)
    new[1:] = (item[1:] != item[:-1]) | (np.diff(j - i) != 0) | (i[1:] != i[:-1] + n[:-1])
    first = np.flatnonzero(new)
    return item[first], i[first], j[first], np.add.reduceat(n, first) if len(first) else n


def greedy_tiles(len_a: int, len_b: int, i: np.ndarray, j: np.ndarray, length: np.ndarray, size: int) -> tuple[int, int]:
    """Number of tiles and of words of the first text in them, from the maximal matches of two texts."""
    queue = list(zip((-length).tolist(), i.tolist(), j.tolist()))
    heapq.heapify(queue)
    in_a, in_b, tiles = np.zeros(len_a, bool), np.zeros(len_b, bool), 0
    while queue and not in_a.all():
        n, x, y = heapq.heappop(queue)
        n = -n
        taken = in_a[x : x + n] | in_b[y : y + n]
        if not taken.any():
            in_a[x : x + n] = in_b[y : y + n] = True
            tiles += 1
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([1], taken.astype(np.int8), [1]))))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if e - s >= size:
                heapq.heappush(queue, (s - e, x + s, y + s))
    return tiles, int(in_a.sum())


def blocks(benchmark: DataFrame, min_tile: int = MIN_TILE, block_bytes: int = BLOCK_BYTES):
    """The benchmark as blocks of bounded size, one after another."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        part = benchmark.where(dealt == k) if n > 1 else benchmark
        yield Block([(r["item_id"], r["text"]) for r in part.select("item_id", "text").collect()], min_tile), n


def leaks(docs: DataFrame, benchmark: DataFrame, min_tile: int = MIN_TILE, min_cover: float = MIN_COVER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, n_tiles, covered_words, coverage of each document and item that leaks into it."""
    kinds = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, n_tiles int, covered_words int, coverage double"
    spark = docs.sparkSession
    out = None
    for block, n_blocks in blocks(benchmark, min_tile, block_bytes):
        held = spark.sparkContext.broadcast(block)

        def run(parts, held=held):
            own = held.value
            for part in parts:
                rows = [(d, item, n, c, c / w) for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) for item, n, c, w in own.tiles(t) if c >= min_cover * w]
                yield pa.RecordBatch.from_pylist([dict(zip(("doc_id", "item_id", "n_tiles", "covered_words", "coverage"), r)) for r in rows], schema=arrow)

        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)
        one = docs.select("doc_id", "text").mapInArrow(run, schema)
        one = materialize(one, "leaks") if n_blocks > 1 else one
        out = one if out is None else out.unionByName(one)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_tile: int = MIN_TILE, min_cover: float = MIN_COVER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that an item leaks into."""
    at = docs.columns.index("text")
    for block, n_blocks in blocks(benchmark, min_tile, block_bytes):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(parts, held=held):
            own = held.value
            for part in parts:
                yield part.filter(pa.array([all(c < min_cover * w for _, _, c, w in own.tiles(t)) for t in part.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        docs = materialize(docs, "decontaminated") if n_blocks > 1 else docs
    return docs
