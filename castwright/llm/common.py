"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from castwright.session import ensure_checkpoint_dir, ship_package

#: Rows per Arrow batch: documents are whole texts, so a batch must stay small in memory.
BATCH_ROWS = 200
#: Bytes of text that one step of a long document works on at a time.
CHUNK_BYTES = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def prepare(spark: SparkSession) -> None:
    """Shared checkpoint folder, package on the executors, small Arrow batches."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def read(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    """The named columns of a table, read by Spark's reader (any path that Spark opens)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return df.select(*cols) if cols else df


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes of a text; null is empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def word_chunks(data: bytes, size: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text in lists of bounded size.

    ``bytes.split()`` cuts exactly at those six characters; long texts are cut at white space.
    """
    at = 0
    while len(data) - at > size:
        gap = _SPACE.search(data, at + size)
        if gap is None:
            break
        yield data[at : gap.start()].split()
        at = gap.end()
    yield data[at:].split()


def clashless(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has (case ignored, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        free = name
        while free.lower() in taken:
            free = f"_{free}"
        taken.add(free.lower())
        out.append(free)
    return out


def add_arrow_columns(df: DataFrame, source: str, schema: str, fn) -> DataFrame:
    """``df`` with more columns computed by ``fn(list of texts) -> list of Arrow arrays``.

    The other columns pass through the task as they are, so no join or row id is needed to
    bring a result back to its row.
    """
    spark = df.sparkSession
    extra = spark.createDataFrame([], schema).schema
    clash = {f.name.lower() for f in extra} & {c.lower() for c in df.columns}
    kept = [c for c in df.columns if c.lower() not in clash]
    base = df.select(*[F.col(f"`{c}`") for c in kept])
    at = kept.index(source)

    def run(batches):
        for batch in batches:
            made = fn(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*kept, *extra.names])

    out = type(extra)([*base.schema.fields, *extra.fields])
    return base.mapInArrow(run, out)


def crc_mod(col, mod: int):
    """crc32 of a value written as text, modulo ``mod`` (the split of rows into folds)."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % mod


def components(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Smallest index of each node's component, over nodes 0..n-1 and edges (u, v)."""
    parent = np.arange(n)
    while True:
        a, b = parent[u], parent[v]
        apart = a != b
        if not apart.any():
            return parent
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


#: A group with more than 1/SHARE of all rows is met by a broadcast; there are fewer than SHARE of them.
SHARE = 1000


def join_groups(df: DataFrame, groups: DataFrame, keys: dict[str, str], n: str, cols: list[str], spread: Column, partitions: int | None = None, early=None) -> DataFrame:
    """``df`` with the columns ``cols`` of each row's group (null where it has none).

    ``groups`` has a row for each group, its number of rows in ``n``; ``keys`` maps columns of ``df`` to
    its columns, null meets null. The few groups with more than 1/SHARE of all rows are broadcast (fewer
    than SHARE rows); their rows are dealt by ``spread`` instead of their key, so that no task gets a hot group.
    ``partitions`` fixes the number of result partitions, for keys that are never null.
    ``early(df, columns)`` may change rows of the broadcast groups before the shuffle.
    """
    total = groups.agg(F.sum(n)).first()[0] or 0
    hot = groups.where(F.col(n) * SHARE > total)
    salt, met, *names = clashless(df, "group_salt", "group_met", *[f"group_{x}" for x in [*keys.values(), *cols]])
    key_names, col_names = names[: len(keys)], names[len(keys) :]

    def side(g: DataFrame, *more: str) -> DataFrame:
        return g.select(*[F.col(k).alias(x) for k, x in zip(keys.values(), key_names)], *[F.col(c).alias(x) for c, x in zip(cols, col_names)], *more)

    def on(right: DataFrame):
        # with ``partitions`` the keys are never null: plain equality keeps the partitioning asked for
        same = [df_now[k] == right[x] if partitions else df_now[k].eqNullSafe(right[x]) for k, x in zip(keys, key_names)]
        return functools.reduce(lambda a, b: a & b, same)

    df_now = df
    first = side(hot).withColumn(met, F.lit(True))
    out = df.join(F.broadcast(first), on(first), "left").drop(*key_names)
    out = out.withColumn(salt, F.when(F.col(met), 1 + F.pmod(spread, F.lit(1 << 20))).otherwise(F.lit(0)).cast("long"))
    out = out.withColumnsRenamed({x: f"{x}_hot" for x in col_names})
    if early:
        out = early(out, F.col(met), {c: F.col(f"{x}_hot") for c, x in zip(cols, col_names)})
    # 0 for every group, in a form that the planner keeps as a join key
    rest = groups.where(F.col(n) * SHARE <= total).withColumn(f"{salt}_r", F.least(F.col(n).cast("long"), F.lit(0).cast("long")))
    rest = side(rest, f"{salt}_r")
    if partitions:
        out, rest = out.repartition(partitions, *keys, salt), rest.repartition(partitions, *key_names, f"{salt}_r")
    df_now = out
    out = out.join(rest, on(rest) & (out[salt] == rest[f"{salt}_r"]), "left")
    taken = [F.coalesce(F.col(f"{x}_hot"), F.col(x)).alias(c) for c, x in zip(cols, col_names)]
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *taken)
