"""Operator 3: quality rules with tokeniser fertility.

Base rules count words, symbols, repeated lines and repeated three-word windows. The method's rules
come from two public vocabularies, a SentencePiece BPE with byte fallback and a byte-level BPE:
characters per token in either, the share of byte-fallback tokens and the entropy of the tokens (as a
share of the largest that their number allows). Each measure has a rejection band for the language of
the document (the column ``lang``, or the script of the text where it is missing): far outside the
quartiles of all documents of that language which pass the base rules. A text that a vocabulary cuts
much finer or coarser than its language's usual prose, or whose tokens repeat far more, is rejected.

Each distinct word is encoded once per task (a bounded memory of words). Texts are read once; the
measures are written to the shared folder, and the bands are aggregates over all of them (sketches of
quartiles, merged map-side), one small row a language.

Edge cases: null and empty texts have no words and fail the base rules; repeated rows each get a row;
an empty table gives an empty result. A language with one document has a band around it. Columns
other than doc_id, text and lang are not read.
"""

from __future__ import annotations

import base64
import functools
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castwright.llm.bpe import RANKS
from castwright.llm.common import join_groups, utf8
from castwright.session import materialize

PIECES = "piece_bpe_32k.model"
#: Distinct words that a task remembers; it forgets them all when full.
WORDS = 400_000
MIN_WORDS, MAX_REPEAT = 50, 50
#: How many quartile ranges outside the quartiles a band reaches, and its least half width.
REACH = 4.0
SLACK = {"chars_per_token": 0.04, "chars_per_byte_token": 0.04, "fallback_share": 0.02, "entropy_share": 0.05}
_SYMBOLS, _BLANK = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
#: First bytes of UTF-8 characters by script (fixed values).
_SCRIPTS = {"greek": (0xCD, 0xD0), "cyrillic": (0xD0, 0xD4), "arabic": (0xD8, 0xDC), "indic": (0xE0, 0xE1), "cjk": (0xE3, 0xED)}
MEASURES = list(SLACK)


def script(data: bytes) -> str:
    """The script that most letters belong to, by the first bytes of characters."""
    n = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    most = {name: int(n[a:b].sum()) for name, (a, b) in _SCRIPTS.items()}
    most["latin"] = int(n[65:91].sum() + n[97:123].sum() + n[0xC2:0xCA].sum())
    return max(sorted(most), key=lambda k: most[k]) if any(most.values()) else "none"


def repeat_words(words: list[bytes]) -> int:
    """Words that stand in a three-word window found at least twice in the text."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    w = np.array([number.setdefault(x, len(number)) for x in words], np.int64)
    pair = w[:-2] * len(number) + w[1:-1]
    if len(number) >= 1 << 21:
        pair = np.unique(pair, return_inverse=True)[1]
    _, which, count = np.unique(pair * len(number) + w[2:], return_inverse=True, return_counts=True)
    twice = count[which] > 1
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k : n - 2 + k] |= twice
    return int(inside.sum())


class Meter:
    """Token measures of texts in two vocabularies, word by word."""

    def __init__(self, pieces: str, ranks: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])
        with open(ranks, "rb") as file:
            pairs = (line.split() for line in file if line.strip())
            found = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=found, special_tokens={})
        self.ids: dict[bytes, tuple[int, ...]] = {}
        self.n_bytes: dict[bytes, int] = {}

    def learn(self, words: set[bytes]) -> None:
        fresh = [w for w in words if w not in self.ids]
        if len(self.ids) + len(fresh) > WORDS:
            self.ids.clear()
            self.n_bytes.clear()
            fresh = list(words)
        texts = [w.decode("utf-8", "replace") for w in fresh]
        for w, made in zip(fresh, self.pieces.encode(texts, num_threads=1)):
            self.ids[w] = tuple(made)
        self.n_bytes.update((w, len(self.ranks.encode_ordinary(f" {t}"))) for w, t in zip(fresh, texts))

    def measure(self, words: list[bytes], chars: int) -> tuple[float, float, float, float]:
        """The four MEASURES of a text, given its words and their characters."""
        ids = np.fromiter(chain.from_iterable(map(self.ids.__getitem__, words)), np.int64)
        if not len(ids):
            return 0.0, 0.0, 0.0, 1.0
        count = np.bincount(ids, minlength=len(self.is_byte))
        p = count[count > 0] / len(ids)
        most = np.log2(min(len(ids), len(count)))
        share = float(-(p * np.log2(p)).sum() / most) if most > 0 else 1.0
        return chars / len(ids), chars / sum(map(self.n_bytes.__getitem__, words)), float(count[self.is_byte].sum() / len(ids)), share


@functools.lru_cache(maxsize=1)
def meter(pieces: str, ranks: str) -> Meter:
    """One meter per worker process."""
    return Meter(pieces, ranks)


def measures(docs: DataFrame, pieces: str | None = None, ranks: str | None = None) -> DataFrame:
    """doc_id, the base counts, the language or script, and the token measures of each row."""
    files = pieces or public_tokenizers.path(PIECES), ranks or public_tokenizers.path(RANKS)
    ids = dict(docs.dtypes)["doc_id"]
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(parts):
        own = meter(*files)
        for part in parts:
            rows = []
            texts = [utf8(t) for t in part.column(1).to_pylist()]
            cut = [t.split() for t in texts]
            own.learn({w for words in cut for w in words})
            for data, words, lang in zip(texts, cut, part.column(2).to_pylist()):
                chars = sum(map(len, words)) - len(data) + len(data.decode("utf-8", "surrogatepass"))
                lines = [x for x in data.split(b"\n") if x.strip(_BLANK)]
                base = len(words), chars, len(data) - len(data.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeat_words(words)
                rows.append((*base, lang or script(data), *own.measure(words, chars)))
            kinds = [*[pa.int64()] * len(counts), pa.string(), *[pa.float64()] * len(MEASURES)]
            cols = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([part.column(0), *cols], names=["doc_id", *counts, "language", *MEASURES])

    schema = f"doc_id {ids}, {', '.join(f'{c} long' for c in counts)}, language string, {', '.join(f'{m} double' for m in MEASURES)}"
    return docs.select("doc_id", "text", "lang").mapInArrow(run, schema)


def bands(measured: DataFrame, reach: float = REACH) -> DataFrame:
    """language, its rows, and the low and high end of each measure's band, from all rows that pass the base rules."""
    quartiles = measured.where("NOT base_failed").groupBy("language").agg(F.count(F.lit(1)).alias("n_passed"), *[F.percentile_approx(m, [0.25, 0.75]).alias(m) for m in MEASURES])
    out = [F.col("language"), F.col("n_passed")]
    for m in MEASURES:
        room = reach * F.greatest(F.col(m)[1] - F.col(m)[0], F.lit(SLACK[m]))
        out += [(F.col(m)[0] - room).alias(f"{m}_low"), (F.col(m)[1] + room).alias(f"{m}_high")]
    return quartiles.select(*out)


def judge(docs: DataFrame, reach: float = REACH) -> DataFrame:
    """The measures of each row with base_failed, the reasons of the bands and kept."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    measured = materialize(measures(docs).withColumn("base_failed", failed), "fertility")
    ends = [f"{m}_{end}" for m in MEASURES for end in ("low", "high")]
    by_language = materialize(bands(measured, reach), "fertility-bands")
    met = join_groups(measured, by_language, {"language": "language"}, "n_passed", ends, F.xxhash64("doc_id"))
    outside = [F.when(~F.col(m).between(F.col(f"{m}_low"), F.col(f"{m}_high")), F.lit(m)) for m in MEASURES]
    reasons = F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*outside)))
    return met.withColumn("reasons", reasons).withColumn("kept", ~F.col("base_failed") & (F.size("reasons") == 0)).select(*measured.columns, "reasons", "kept")
