"""Operator 11: importance resampling of documents towards a target distribution.

Separators of a lower-cased text collapse to single spaces; one pattern, matched at every word start
(``finditer`` with ``overlapped=True``, a look-behind for the start and a look-ahead for the end), gives
the spans of all runs of 1 to n words at once, each with its CRC-32 carried on from the run before.
A document keeps the bucket of each feature. Bucket counts of the corpus are summed over all documents
(each task adds up its own first), so are those of the target; the gain of a bucket is the log of the
two smoothed shares, a document's weight the floored mean of its features' gains, its score the
weight and Gumbel noise from a hash of its id. The highest scores are drawn.

* The number of buckets is a parameter, so the table of gains has a fixed size; it is the one thing that
  reaches the driver and the tasks.
* Ranks come from one range-partitioned sort of narrow rows, written once; each range then needs only
  the number of rows before it. ``resample`` needs no join: a row is drawn if it does not come after
  the last drawn place.
* Features are computed once and written as two bytes each.

Edge cases: null and empty texts have no words, weight 0, and take part in the draw only if ``min_words``
allows. A null id is hashed as an empty text and comes last in ties; rows that tie in score and id are
placed by their row number in the written features. Empty table: empty result. Empty target: all its
counts are 0. Columns of the input with the names of new ones give way.
"""

from __future__ import annotations

import functools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castwright.llm.common import add_arrow_columns, utf8
from castwright.session import materialize

NGRAMS = 2
BUCKETS = 10_000
PERCENT = 25
MIN_WORDS = 20
SEED = 7

_GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@functools.lru_cache(maxsize=8)
def span_pattern(ngrams: int):
    """Matches at each word start; group k ends where the run of k words ends."""
    more = rb""
    for _ in range(ngrams - 1):
        more = rb"(?: ([^ ]++)" + more + rb")?+"
    return regex.compile(rb"(?<![^ ])([^ ]++)" + more + rb"(?![^ ])")


def feature_buckets(text: str | None, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words and the bucket of every feature of a whole text, repeats included."""
    line = _GAP.sub(b" ", utf8(text).lower()).strip(b" ")
    codes, crc32, n_words = [], zlib.crc32, 0
    groups = range(2, ngrams + 1)
    for m in span_pattern(ngrams).finditer(line, overlapped=True):
        n_words += 1
        start, end = m.span(1)
        code = crc32(line[start:end])
        codes.append(code)
        for k in groups:
            longer = m.end(k)
            if longer < 0:
                break
            code = crc32(line[end:longer], code)
            end = longer
            codes.append(code)
    return n_words, np.array(codes, np.uint32) % np.uint32(buckets)


def _width(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def with_features(df: DataFrame, text: str = "text", ngrams: int = NGRAMS, buckets: int = BUCKETS) -> DataFrame:
    """``df`` with n_words and feature_buckets (binary: an unsigned number for each feature)."""
    width = _width(buckets)

    def run(texts):
        made = [feature_buckets(t, ngrams, buckets) for t in texts]
        return [pa.array([n for n, _ in made], pa.int64()), pa.array([b.astype(width).tobytes() for _, b in made], pa.binary())]

    return add_arrow_columns(df, text, "n_words long, feature_buckets binary", run)


def bucket_counts(featured: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows; at most ``buckets`` numbers leave a task."""
    width = _width(buckets)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                total += np.bincount(np.frombuffer(raw.as_buffer(), width), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in featured.select("feature_buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket: the floored thousandfold log of the target's smoothed share over the corpus'."""
    more, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    shares = [(float(t) + 1) * (s_all + more) / ((float(s) + 1) * (t_all + more)) for s, t in zip(corpus, target)]
    return np.array([math.floor(1000 * math.log(x)) for x in shares], np.int64)


def noise(id_: Column, seed: int = SEED) -> Column:
    """Floored thousandfold Gumbel noise from the hash of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def with_scores(featured: DataFrame, gain: np.ndarray, id_: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Rows of ``with_features`` with n_features, weight and score."""
    width = _width(len(gain))

    def run(rows):
        codes = [np.frombuffer(b, width) for b in rows]
        n = [len(c) for c in codes]
        return [pa.array(n, pa.int64()), pa.array([int(gain[c].sum()) // k if k else 0 for c, k in zip(codes, n)], pa.int64())]

    made = add_arrow_columns(featured, "feature_buckets", "n_features long, weight long", run).drop("feature_buckets")
    return made.withColumn("score", F.col("weight") + noise(F.col(f"`{id_}`"), seed))


def _placed(scored: DataFrame, id_: str, min_words: int, percent: int) -> tuple[DataFrame, int]:
    """``scored`` (narrow, with feature_row) with place, 1 for the first row of the draw's order, and how
    many rows are drawn. One sort by range; places before a range are a sum over the ranges."""
    fits = F.col("n_words") >= min_words
    order = [F.desc(fits), F.desc("score"), F.asc_nulls_last(id_), F.asc("feature_row")]
    done = materialize(scored.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "importance-order")
    part = F.shiftright("at", 33)
    sizes = done.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(fits, 1)).alias("fit")).orderBy("part").collect()
    before, rows = 0, []
    for size in sizes:  # one row for each range of the sort
        rows.append((size["part"], before))
        before += size["n"]
    offsets = done.sparkSession.createDataFrame(rows, "part long, before long")
    met = done.withColumn("part", part).join(F.broadcast(offsets), "part")
    place = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    return met.withColumn("place", place).drop("part", "before", "at"), percent * sum(s["fit"] for s in sizes) // 100


def _scored(docs: DataFrame, target: DataFrame, id_: str, text: str, keep: list[str], ngrams: int, buckets: int, seed: int) -> tuple[DataFrame, np.ndarray]:
    """Written features of the documents (columns ``keep``) and the gains."""
    made = with_features(docs, text, ngrams, buckets).withColumn("feature_row", F.monotonically_increasing_id())
    made = materialize(made.select(*[f"`{c}`" for c in keep], "n_words", "feature_buckets", "feature_row"), "importance-features")
    wanted = with_features(target.select(F.col(text).alias("text")), "text", ngrams, buckets)
    return made, gains(bucket_counts(made, buckets), bucket_counts(wanted, buckets))


def rank(docs: DataFrame, target: DataFrame, id_: str = "doc_id", text: str = "text", ngrams: int = NGRAMS, buckets: int = BUCKETS,
         percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """id, n_words, n_features, weight, score and rank (1, 2, ...; null: not drawn) of every document."""
    made, gain = _scored(docs, target, id_, text, [id_], ngrams, buckets, seed)
    scored = materialize(with_scores(made, gain, id_, seed), "importance-scores")
    placed, drawn = _placed(scored, id_, min_words, percent)
    return placed.select(f"`{id_}`", "n_words", "n_features", "weight", "score", F.when(F.col("place") <= drawn, F.col("place")).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, id_: str = "doc_id", text: str = "text", ngrams: int = NGRAMS, buckets: int = BUCKETS,
             percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """The drawn documents, whole rows, with n_words, n_features, weight and score."""
    new = {"n_words", "n_features", "weight", "score", "feature_buckets", "feature_row"}
    made, gain = _scored(docs, target, id_, text, [c for c in docs.columns if c.lower() not in new], ngrams, buckets, seed)
    scored = with_scores(made, gain, id_, seed)
    placed, drawn = _placed(materialize(scored.select(f"`{id_}`", "n_words", "score", "feature_row"), "importance-scores"), id_, min_words, percent)
    last = placed.where(F.col("place") == drawn).select("score", F.col(f"`{id_}`").alias("id"), "feature_row").first()
    if last is None:
        return scored.where(F.lit(False)).drop("feature_row")
    own = F.col(f"`{id_}`")
    late, last_late = own.isNull(), F.lit(last["id"] is None)
    sooner = F.when(late != last_late, ~late).otherwise(own < F.lit(last["id"]))
    in_tie = F.when(own.eqNullSafe(F.lit(last["id"])), F.col("feature_row") <= last["feature_row"]).otherwise(sooner)
    taken = (F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & in_tie)
    return scored.where((F.col("n_words") >= min_words) & taken).drop("feature_row")
