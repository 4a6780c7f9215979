"""Operator 4: toxicity, a convolutional text classifier trained in numpy.

Words (lower-cased, punctuation off) and their beginnings of four and six bytes are hashed to buckets
with an embedding each; a word is the sum of the three, so forms of one stem share what is learnt.
Filters of one, two and three words slide over the whole text, each gives its largest response (max
pooling), and a linear layer over those gives a logit. Training is minibatch Adam on a bounded sample;
buckets that fewer than ``MIN_DOCS`` training texts hold count as zero, so rare words cannot be learnt
by heart, and only the others get a row in the model.
For scoring, embedding and filters are multiplied out to one table for each filter position, so a
text costs a few lookups and a maximum per word.

Thresholds are calibrated by language: the language is guessed from function words of the text (never
from the column ``lang``), the best cut of each language is found on a fold that training did not
see, and the logit is moved so that this cut is the score 0.5.

The sample is bounded by ``per_class`` rows of at most ``MAX_WORDS`` words and 10 characters a word of that, and by
``SAMPLE_WORDS`` words in all (those of the smallest hashes of doc_id first); scoring uses whole texts
of all rows, without a shuffle. Edge cases: null and empty texts score as a text without known words;
without labelled rows of both classes every score is 0. Repeated rows score alike; empty table, empty
result; extra columns pass through.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from castwright.llm.common import add_arrow_columns
from castwright.llm.decontaminate import words_of
from castwright.llm.training import labelled_sample, one_per_document

BUCKETS, DIM, FILTERS, WIDTHS, STEMS = 1 << 20, 8, 6, (1, 2, 3), (4, 6)
PER_CLASS, MAX_WORDS, SAMPLE_WORDS, MIN_DOCS = 2000, 20_000, 8_000_000, 5
MOD, HELD_OUT, CALIBRATION = 5, 0, 4
EPOCHS, BATCH, RATE, DECAY = 4, 32, 0.02, 1e-4
#: Distinct words that a task remembers; it forgets them all when full.
WORDS = 200_000
#: Words of a long text whose responses are in memory at a time.
PART = 1 << 16
_SCORERS: dict = {}
#: Function words that tell languages apart (fixed values).
LANGUAGES = {
    "en": "the of and to in is that it with was for be on are this by from",
    "de": "der die und das ein eine nicht mit den ist von zu auf sich dem",
    "fr": "le la les des et que dans pour une du est qui sur pas par",
    "es": "el los las del que para una por con se su y al no lo",
}


def bucket_ids(words: list[bytes]) -> np.ndarray:
    """Buckets, 1 to BUCKETS - 1, of each word and of its beginnings (words x 3)."""
    out = np.zeros((len(words), 1 + len(STEMS)), np.int64)
    out[:, 0] = np.fromiter(map(crc32, words), np.int64, len(words))
    for k, size in enumerate(STEMS, 1):
        out[:, k] = np.fromiter((crc32(w[:size], k) if len(w) > size else 0 for w in words), np.int64, len(words))
    return np.where(out > 0, out % (BUCKETS - 1) + 1, 0)


def _language_table() -> np.ndarray:
    table = np.zeros(BUCKETS, np.int8)
    owners: dict[str, list[int]] = {}
    for k, words in enumerate(LANGUAGES.values(), 1):
        for w in words.split():
            owners.setdefault(w, []).append(k)
    for w, ks in owners.items():
        if len(ks) == 1:
            table[bucket_ids([w.encode()])[:, 0]] = ks[0]
    return table


class TextCnn:
    """Hashed embeddings, filters of several widths, max pooling, a linear layer, cuts by language."""

    def __init__(self, texts: list[np.ndarray], y: np.ndarray, calibration: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        seen, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for ids, v, off in zip(texts, y, calibration):
            if not off:
                some = np.unique(ids)
                seen[some] += 1
                toxic[some] += v
        seen[0] = 0
        known = np.flatnonzero(seen >= MIN_DOCS)
        self.row = np.zeros(BUCKETS, np.int32)  # row of a bucket in the model; 0: not known
        self.row[known] = np.arange(1, len(known) + 1)
        n1, n0 = max(1, (y[~calibration] == 1).sum()), max(1, (y[~calibration] == 0).sum())
        odds = np.log((toxic[known] + 0.5) / (n1 + 1)) - np.log((seen[known] - toxic[known] + 0.5) / (n0 + 1))
        self.emb = rng.normal(0, 0.1, (len(known) + 1, DIM))
        self.emb[1:, 0] = np.clip(odds, -3, 3) / 3  # start from the words' odds
        self.emb[0] = 0
        self.w = {k: rng.normal(0, 0.3, (k, DIM, FILTERS)) for k in WIDTHS}
        for k in WIDTHS:
            self.w[k][0, 0, 0] = 1.0
        self.b = {k: np.zeros(FILTERS) for k in WIDTHS}
        self.v, self.c = rng.normal(0, 0.3, FILTERS * len(WIDTHS)), 0.0
        self.languages = _language_table()
        self.cuts = np.zeros(len(LANGUAGES) + 1)
        train = np.flatnonzero(~calibration)
        self._train([self.row[texts[i]] for i in train], y[train].astype(float), rng)
        self.table = np.concatenate([self.emb @ self.w[k][j] for k in WIDTHS for j in range(k)], axis=1).astype(np.float32)
        self._calibrate(texts, y, np.flatnonzero(calibration))

    def _train(self, ids: list[np.ndarray], y: np.ndarray, rng) -> None:
        params = {("w", k): self.w[k] for k in WIDTHS} | {("b", k): self.b[k] for k in WIDTHS} | {("v", 0): self.v}
        m = {k: np.zeros_like(p) for k, p in params.items()}
        s = {k: np.zeros_like(p) for k, p in params.items()}
        adagrad = np.full(len(self.emb), 1e-3)
        weight = np.where(y == 1, len(y) / (2 * max(1, y.sum())), len(y) / (2 * max(1, (1 - y).sum())))
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(ids))
            for at in range(0, len(order), BATCH):
                step += 1
                grads = {k: DECAY * p for k, p in params.items()}
                rows, slopes, grad_c = [], [], 0.0
                batch = order[at : at + BATCH]
                for i in batch:
                    t, n = self._padded(ids[i])
                    x, pooled, where = self.emb[t].sum(1), [], []
                    for k in WIDTHS:
                        r = sum(x[j : j + n] @ self.w[k][j] for j in range(k)) + self.b[k]
                        best = r.argmax(0)
                        where.append(best)
                        pooled.append(r[best, np.arange(FILTERS)])
                    raw = np.concatenate(pooled)
                    keep = (rng.random(len(raw)) > 0.2) / 0.8
                    hidden = np.maximum(raw, 0) * keep
                    p = 1 / (1 + np.exp(-np.clip(hidden @ self.v + self.c, -30, 30)))
                    d = weight[i] * (p - y[i]) / len(batch)
                    grads[("v", 0)] = grads[("v", 0)] + d * hidden
                    grad_c += d
                    back = d * self.v * (raw > 0) * keep
                    for q, k in enumerate(WIDTHS):
                        part = back[q * FILTERS : (q + 1) * FILTERS]
                        grads[("b", k)] = grads[("b", k)] + part
                        for j in range(k):
                            place = where[q] + j
                            grads[("w", k)][j] += x[place].T * part
                            for part_of_word in t[place].T:
                                rows.append(part_of_word)
                                slopes.append((self.w[k][j] * part).T)
                for k, p in params.items():
                    m[k] = 0.9 * m[k] + 0.1 * grads[k]
                    s[k] = 0.999 * s[k] + 0.001 * grads[k] ** 2
                    p -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
                self.c -= RATE * grad_c
                r, g = np.concatenate(rows), np.concatenate(slopes)
                some, inverse = np.unique(r, return_inverse=True)
                total = np.zeros((len(some), DIM))
                np.add.at(total, inverse, g)
                adagrad[some] += (total**2).sum(1)
                self.emb[some] -= RATE * total / np.sqrt(adagrad[some])[:, None]
                self.emb[0] = 0

    @staticmethod
    def _padded(rows: np.ndarray) -> tuple[np.ndarray, int]:
        """Rows of a text with zero words after it, for the last windows; an empty text is one zero word."""
        n = max(1, len(rows))
        out = np.zeros((n + max(WIDTHS) - 1, 1 + len(STEMS)), np.int64)
        out[: len(rows)] = rows
        return out, n

    def responses(self, ids: np.ndarray) -> np.ndarray:
        """What each word adds to each filter at each of its positions (words x 36)."""
        return self.table[self.row[ids]].sum(1)

    def logit(self, responses: np.ndarray, at: np.ndarray | None = None) -> float:
        """Largest response of each filter over a text whose words have the rows ``at`` of ``responses``
        (all, if not given), through the linear layer; a long text is pooled in parts of ``PART`` words."""
        at = np.arange(len(responses)) if at is None else at
        n, reach, best = max(1, len(at)), max(WIDTHS) - 1, None
        for start in range(0, n, PART):
            size = min(PART, n - start)
            r = responses[at[start : start + size + reach]]
            r = np.concatenate((r, np.zeros((size + reach - len(r), responses.shape[1]), np.float32)))
            pooled, column = [], 0
            for k in WIDTHS:
                whole = sum(r[j : j + size, column + j * FILTERS : column + (j + 1) * FILTERS] for j in range(k))
                pooled.append(whole.max(0) + self.b[k])
                column += k * FILTERS
            part = np.concatenate(pooled)
            best = part if best is None else np.maximum(best, part)
        return float(np.maximum(best, 0) @ self.v + self.c)

    def language(self, spoken: np.ndarray) -> int:
        """Number of the language with most function words among a text's words (0: none)."""
        n = np.bincount(spoken, minlength=len(LANGUAGES) + 1)
        n[0] = 0
        return int(n.argmax()) if n.any() else 0

    def _calibrate(self, texts, y, rows) -> None:
        logits = np.array([self.logit(self.responses(texts[i])) for i in rows])
        spoken = np.array([self.language(self.languages[texts[i][:, 0]]) for i in rows])
        whole = self._best_cut(logits, y[rows])
        for k in range(len(self.cuts)):
            own = spoken == k
            enough = min((y[rows][own] == v).sum() for v in (0, 1)) >= 20
            self.cuts[k] = self._best_cut(logits[own], y[rows][own]) if enough else whole

    @staticmethod
    def _best_cut(logits: np.ndarray, y: np.ndarray) -> float:
        """Cut with the best balanced accuracy, in the middle of the gap around it."""
        if len(set(y.tolist())) < 2:
            return 0.0
        order = np.argsort(logits)
        x, one = logits[order], y[order] == 1
        right = one[::-1].cumsum()[::-1] / one.sum() + np.concatenate(([0], (~one).cumsum()[:-1])) / (~one).sum()
        new = np.concatenate(([True], np.diff(x) > 0))
        at = int(np.argmax(np.where(new, right, -1)))
        return float((x[at - 1] + x[at]) / 2) if at else float(x[0] - 1)

    def __getstate__(self):
        keep = ("row", "table", "b", "v", "c", "languages", "cuts")
        return {k: self.__dict__[k] for k in keep}


class Scorer:
    """A model and what it gives for each distinct word (a bounded memory of words)."""

    def __init__(self, model: TextCnn):
        self.model, self.known = model, {}
        self.responses = np.zeros((0, model.table.shape[1]), np.float32)
        self.spoken = np.zeros(0, np.int8)

    def _learn(self, words: set[bytes]) -> None:
        fresh = [w for w in words if w not in self.known]
        if len(self.known) + len(fresh) > WORDS:
            self.known.clear()
            fresh, self.responses, self.spoken = list(words), self.responses[:0], self.spoken[:0]
        if fresh:
            ids = bucket_ids(fresh)
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            self.responses = np.concatenate((self.responses, self.model.responses(ids)))
            self.spoken = np.concatenate((self.spoken, self.model.languages[ids[:, 0]]))

    def scores(self, texts: list[str | None]) -> list[float]:
        """Probability of being toxic of each whole text."""
        cut = [words_of(t) for t in texts]
        self._learn({w for words in cut for w in words})
        out = []
        for words in cut:
            at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            z = self.model.logit(self.responses, at) - self.model.cuts[self.model.language(self.spoken[at])]
            out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return out


def bounded(rows: DataFrame, each: int = MAX_WORDS, whole: int = SAMPLE_WORDS) -> DataFrame:
    """The rows of at most ``each`` words, taken in the order of a hash of doc_id until they have ``whole``
    words. Only ids and sizes of the sample's few thousand rows are put in order."""
    sized = rows.select("doc_id", (F.size("x") / (1 + len(STEMS))).alias("n")).where(F.col("n") <= each)
    upto = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    kept = sized.withColumn("upto", upto).where(F.col("upto") <= whole).select("doc_id")
    return rows.join(F.broadcast(kept), "doc_id", "left_semi")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> TextCnn | None:
    """Model of ``labels.toxic``; None without rows of both classes."""
    short = docs.where(F.length("text") <= 10 * MAX_WORDS)
    sample = labelled_sample(short, labels, "toxic", per_class, MOD, HELD_OUT)
    made = add_arrow_columns(sample, "text", "x array<int>", lambda texts: [pa.array([bucket_ids(words_of(t)).ravel().astype(np.int32) for t in texts], pa.list_(pa.int32()))])
    rows = bounded(one_per_document(made, "label", "fold")).toArrow().sort_by("doc_id")
    y = rows["label"].to_numpy().astype(np.int64)
    if len(set(y.tolist())) < 2:
        return None
    texts = [np.asarray(x.values).reshape(-1, 1 + len(STEMS)) for x in rows["x"].combine_chunks()]
    calibration = rows["fold"].to_numpy() == CALIBRATION
    if min((y[~calibration] == v).sum() for v in (0, 1)) == 0:
        calibration[:] = False
    return TextCnn(texts, y, calibration)


def score(docs: DataFrame, model: TextCnn | None, column: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is toxic."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    spec = f"`{column}` double"

    def run(texts):
        model = held.value
        if model is None:
            return [pa.array(np.zeros(len(texts)))]
        if _SCORERS.get("model") is not model:
            _SCORERS.update(model=model, scorer=Scorer(model))
        return [pa.array(_SCORERS["scorer"].scores(texts), pa.float64())]

    return add_arrow_columns(docs, "text", spec, run)
