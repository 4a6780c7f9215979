"""Operator 13: product codes of vectors, with memoised grid cells for the nearest codebook entry.

Vectors become integers, are cut into equal parts, and each part is coded by the nearest entry of its
position's codebook. To find it, the part is hashed to its cell of a coarse grid; for each cell met a
task keeps the entries that can be nearest anywhere in the cell's box (an entry falls out if its
smallest distance to the box exceeds another entry's largest one), and only those are evaluated
exactly. All arithmetic is in integers, so ties and sums are exact in any order.

* Each round is one pass over the written integer parts: a task adds up its parts for every entry, so
  what is shuffled and what reaches the driver (entries x components) does not grow with the table.
* Cells are exact keys (a byte for each dimension; outer cells reach to the limit of the integers),
  and the memory of cells is bounded: it is forgotten when full, which changes no result.
* Errors are added up by label over all rows; a label that a third of the rows share meets its rows by a
  broadcast of at most ``SHARE`` frequent labels, the others by a shuffle.

Edge cases: null vectors and those with null or non-finite components are dropped. Shorter vectors are
filled up with zeros to the longest one's length, rounded up to a multiple of the number of parts. Scaled
components beyond +-2^26 count as that. Repeated rows each count and may fill several entries; with
fewer rows than entries the codebook has as many entries as rows. A null id comes last. Ties of ids are
ordered by the vector. Empty table: empty result. Columns of the input with the names of new ones give way.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castwright.llm.common import join_groups
from castwright.session import materialize

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LIMIT = 1 << 26
#: Rows that a step of a task works on, cells a task remembers for each part.
STEP = 8192
CELLS = 1 << 17


class Cells:
    """Entries of one codebook that can be nearest, remembered by grid cell."""

    def __init__(self, book: np.ndarray):
        self.book = book  # entries x dimensions, int64
        spread = int((book.max(0) - book.min(0)).max()) if book.size else 0
        self.width = max(1, -(-spread // 4))
        self.base = (book.min(0) if len(book) else np.zeros(book.shape[1], np.int64)) // self.width - 126
        self.words = -(-book.shape[1] // 8)
        self.keys = np.zeros(0, np.dtype((np.void, 8 * self.words)) if self.words > 1 else np.uint64)
        self.can = np.zeros((0, len(book)), bool)
        self.evaluated = 0

    def _key(self, coords: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(coords), 8 * self.words), np.uint8)
        wide[:, : coords.shape[1]] = coords
        return wide.view(self.keys.dtype).ravel()

    def candidates(self, coords: np.ndarray) -> np.ndarray:
        """Which entries can be nearest within each cell's box."""
        low = np.where(coords == 0, -LIMIT, (coords + self.base) * self.width)[:, None, :]
        high = np.where(coords == 255, LIMIT, (coords + self.base + 1) * self.width - 1)[:, None, :]
        book = self.book[None]
        least = (np.maximum(0, np.maximum(low - book, book - high)) ** 2).sum(2)
        most = (np.maximum(np.abs(book - low), np.abs(high - book)) ** 2).sum(2)
        return least <= most.min(1)[:, None]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (the lower one in ties) and its squared distance."""
        coords = np.clip(parts // self.width - self.base, 0, 255)
        cells, first, cell_of = np.unique(self._key(coords.astype(np.uint8)), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, cells)
        known = np.zeros(len(cells), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == cells[inside]
        can = np.empty((len(cells), len(self.book)), bool)
        can[known] = self.can[at[known]]
        if not known.all():
            fresh = self.candidates(coords[first[~known]])
            can[~known] = fresh
            if len(self.keys) + len(fresh) > CELLS:
                self.keys, self.can = self.keys[:0], self.can[:0]
            keys = np.concatenate([self.keys, cells[~known]])
            order = np.argsort(keys)
            self.keys, self.can = keys[order], np.concatenate([self.can, fresh])[order]
        row, entry = np.nonzero(can[cell_of.ravel()])
        self.evaluated += len(row)
        far = ((parts[row] - self.book[entry]) ** 2).sum(1)
        starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        least = np.minimum.reduceat(far, starts)
        hits = np.flatnonzero(far == least[row])
        best = hits[np.concatenate(([True], row[hits][1:] != row[hits][:-1]))]
        return entry[best], least


def _assigned(data: np.ndarray, cells: list[Cells]) -> tuple[np.ndarray, np.ndarray]:
    """Entry (rows x parts) and error of each row; ``data`` is rows x parts x dimensions."""
    codes, error = np.empty((len(data), len(cells)), np.int64), np.zeros(len(data), np.int64)
    for p, own in enumerate(cells):
        codes[:, p], far = own.nearest(data[:, p])
        error += far
    return codes, error


def _steps(batches, rows: int = STEP):
    """Arrow batches put together to about ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _ints(column: pa.Array, parts: int, size: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.int32)
    return raw.reshape(len(column), parts, size).astype(np.int64)


def scaled(df: DataFrame, vector: str, keep: list[str], length: int, scale: int = SCALE) -> DataFrame:
    """``keep`` and ints (binary int32, ``length`` numbers) of the rows with a whole finite vector."""
    base = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{vector}`").cast("array<double>").alias("v"))

    def run(batches):
        for batch in batches:
            made = []
            for v in batch.column(len(keep)).to_pylist():
                full = np.zeros(length, np.int32)
                full[: len(v)] = np.clip(np.floor(np.array(v, np.float64) * scale), -LIMIT, LIMIT)
                made.append(full.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(made, pa.binary())], names=[*keep, "ints"])

    schema = base.select(*[f"`{c}`" for c in keep], F.lit(b"").alias("ints")).schema
    return base.mapInArrow(run, schema)


def whole(vector) -> "F.Column":
    """True for a vector without null or non-finite components."""
    v = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad


def fit(ints: DataFrame, id_: str, parts: int, size: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x size) after ``rounds`` rounds over all rows."""
    first = ints.select(F.col(f"`{id_}`").alias("id"), "ints").orderBy(F.asc_nulls_last("id"), "ints").limit(entries).collect()
    books = np.array([np.frombuffer(r["ints"], np.int32) for r in first], np.int64).reshape(len(first), parts, size).transpose(1, 0, 2)
    for _ in range(rounds if len(first) else 0):
        now = books.copy()

        def run(batches, now=now):
            cells = [Cells(b) for b in now]
            sums, n = np.zeros(now.shape, np.int64), np.zeros(now.shape[:2], np.int64)
            for batch in _steps(batches):
                data = _ints(batch.column(0), parts, size)
                codes, _ = _assigned(data, cells)
                for p in range(parts):
                    np.add.at(sums[p], codes[:, p], data[:, p])
                    n[p] += np.bincount(codes[:, p], minlength=now.shape[1])
            cell = np.arange(n.size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(cell, size)), pa.array(np.tile(np.arange(size), n.size)), pa.array(sums.ravel()), pa.array(np.repeat(n.ravel(), size))],
                names=["cell", "pos", "total", "n"])

        made = ints.select("ints").mapInArrow(run, "cell long, pos long, total long, n long")
        made = made.groupBy("cell", "pos").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        for row in made.where("n > 0").collect():
            books[row["cell"] // books.shape[1], row["cell"] % books.shape[1], row["pos"]] = int(row["total"]) // row["n"]
    return books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(ints: DataFrame, books: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep``, code (binary: a byte for each part) and error of every row."""
    parts, _, size = books.shape

    def run(batches):
        cells = [Cells(b) for b in books]
        for batch in _steps(batches):
            codes, error = _assigned(_ints(batch.column(len(keep)), parts, size), cells)
            made = pa.array([row.tobytes() for row in codes.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], made, pa.array(error)], names=[*keep, "code", "error"])

    schema = ints.select(*[f"`{c}`" for c in keep], F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")).schema
    return ints.select(*[f"`{c}`" for c in keep], "ints").mapInArrow(run, schema)


def decode(code: bytes, books: np.ndarray) -> np.ndarray:
    """Integers that a code stands for."""
    return np.concatenate([books[p, e] for p, e in enumerate(code)])


def compress(df: DataFrame, id_: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(id, label, code, error, label_error) of every kept row, and the codebooks."""
    good = df.where(whole(vector))
    longest = good.agg(F.max(F.size(F.col(f"`{vector}`")))).first()[0] or 0
    size = max(1, -(-longest // parts))
    ints = materialize(scaled(good, vector, [id_, label], parts * size, scale), "vector-ints")
    books = fit(ints, id_, parts, size, entries, rounds)
    coded = materialize(encode(ints, books, [id_, label]), "vector-codes")
    sums = materialize(coded.groupBy(F.col(f"`{label}`").alias("of")).agg(F.try_sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors")
    return join_groups(coded, sums, {label: "of"}, "n", ["label_error"], F.xxhash64("code", f"`{id_}`")), books
