"""Operator 2: URL filter by segmented host words and multinomial naive Bayes.

Rules come first: the longest rule whose host is the url's host or a parent of it and whose path
starts the url's path decides. All other urls are judged by the method: the letters of host and path
are cut into words by a unigram Viterbi search (word probabilities by Zipf's law over the rank of a
word in a public vocabulary of lower-case words, so ``cheappills`` becomes ``cheap pills``), and naive
Bayes over those words gives block or allow.

There are no labelled urls, so training is weak: urls with one of the seed words stand for block, the
others that no rule blocks for allow, but for the doubtful ones, which share a word with seeded pages that those
hold most of (so hosts whose own word is no seed are still blocked by the words beside it). Word counts by class are aggregated over all pages, and every word
counts with both of them. Tasks hold the odds of the ``held_words`` most frequent words (that parameter
bounds memory, not the model); a page's other words, each a small share of all words, are joined with the
table of counts, so no frequent word is a join key. Pages and their words are written once, which fixes the
row numbers of that join. A host that a third of all pages share is segmented once per task.

Edge cases: a null url or one without ``://`` has empty host and path and is judged without words (the
prior). A word of unlabelled pages only (blocked by a rule) adds nothing. Repeated pages each get a row; an empty table gives an empty result; other columns
pass through, those with the names of new ones give way.
"""

from __future__ import annotations

import functools
import json
import math
import re

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castwright.llm.common import clashless, join_groups
from castwright.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = "word_bpe_49k.json"
#: (verdict, rule) of the production filter.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
#: Words that stand for unwanted pages in training (fixed values).
SEEDS = ["adult", "ads", "bet", "bets", "betting", "casino", "gambling", "lottery", "pills", "poker", "porn", "sex", "spam", "viagra", "xxx"]
#: Words whose odds every task holds; the others are joined.
MODEL_WORDS = 20_000
#: Seeded occurrences from which a word marks a page as doubtful.
SUPPORT = 5
LONGEST = 24
#: Distinct names that a task remembers.
NAMES = 100_000


def with_parts(pages: DataFrame) -> DataFrame:
    """``pages`` with host (A-Z lower-cased) and path of each url."""
    after = F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return pages.withColumn("host", F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))


def with_rule(parts: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """``parts`` with the rule that decides (null: none) and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # a longer rule overrides
        host, slash, rest = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return parts.withColumn("rule", rule).withColumn("rule_verdict", verdict)


class Segmenter:
    """Unigram Viterbi over a vocabulary in order of frequency."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            vocab = json.load(file)["model"]["vocab"]
        ends = sorted((i, t[:-4]) for t, i in vocab.items() if t.endswith("</w>") and re.fullmatch(r"[a-z]+</w>", t))
        words = [w for _, w in ends if len(w) > 1 or w in "ai"]
        total = sum(1 / (r + 10) for r in range(len(words)))
        self.cost = {w: math.log(total * (r + 10)) for r, w in enumerate(words)}
        self.unknown = math.log(total * 10 * (len(words) + 10))
        self.known: dict[str, list[str]] = {}

    def _price(self, word: str) -> float:
        """Cost of a word; unknown ones cost more with each letter."""
        return self.cost.get(word, self.unknown + 2.3 * len(word))

    def cut(self, name: str) -> list[str]:
        """The cheapest cut of a run of letters into words; names over ``LONGEST`` letters are cut
        with the same search, words being at most that long."""
        best = [(0.0, 0)]
        for end in range(1, len(name) + 1):
            best.append(min((best[at][0] + self._price(name[at:end]), at) for at in range(max(0, end - LONGEST), end)))
        words, end = [], len(name)
        while end:
            at = best[end][1]
            words.append(name[at:end])
            end = at
        return words[::-1]

    def words(self, text: str) -> list[str]:
        """Words of the letters of a host or path."""
        out = []
        for name in re.findall(r"[a-z]+", text.lower()):
            if name not in self.known:
                if len(self.known) >= NAMES:
                    self.known.clear()
                self.known[name] = self.cut(name)
            out += self.known[name]
        return out


@functools.lru_cache(maxsize=1)
def segmenter(path: str) -> Segmenter:
    """One segmenter per worker process."""
    return Segmenter(path)


def with_words(parts: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``parts`` with the array of segmented host and path words."""
    file = vocabulary or public_tokenizers.path(WORDS)

    @F.pandas_udf("array<string>")
    def cut(host, path):
        own = segmenter(file)
        return pd.Series([own.words(h) + own.words(p) for h, p in zip(host, path)])

    return parts.withColumn("words", cut("host", "path"))


def _counts(labelled: DataFrame, name: str) -> DataFrame:
    """word, n_block, n_allow, n over the pages' labels."""
    met = labelled.select("label", F.explode("words").alias("word"))
    counts = met.groupBy("word").agg(F.count_if(F.col("label") == 1).alias("n_block"), F.count_if(F.col("label") == 0).alias("n_allow"), F.count(F.lit(1)).alias("n"))
    return materialize(counts, name)


def doubtful(labelled: DataFrame, counts: DataFrame, rid: str, support: int = SUPPORT) -> DataFrame:
    """Row numbers of the pages that no seed labels and that share a marked word with those that one does:
    a word of at least ``support`` seeded occurrences, which are no fewer than the others. Such a page is no
    sure example of what to allow."""
    marked = counts.where((F.col("n_block") >= support) & (F.col("n_block") >= F.col("n_allow"))).select("word", "n", F.lit(True).alias("marked"))
    met = labelled.where("label = 0").select(rid, F.explode("words").alias("word"))
    found = join_groups(met, marked, {"word": "word"}, "n", ["marked"], F.xxhash64(rid))
    return found.where("marked").select(rid).distinct()


def word_counts(worded: DataFrame, seeds: list[str] = SEEDS, rid: str = "rid") -> tuple[DataFrame, dict[int, int]]:
    """word, n_block, n_allow, n of every word of all pages, and the number of pages of each label.

    Pages with a seed word stand for block; those without one, unless a rule blocks them, for allow, less
    the doubtful ones. So a name that goes with seeded names' words is not learnt as allowed for want of a seed."""
    seeded = F.arrays_overlap("words", F.array(*[F.lit(s) for s in seeds]))
    label = F.when(seeded, F.lit(1)).when(F.coalesce("rule_verdict", F.lit("allow")) == "allow", F.lit(0))
    labelled = worded.select(rid, label.alias("label"), "words")
    out = materialize(doubtful(labelled, _counts(labelled, "url-words-first"), rid).withColumn("out", F.lit(True)), "url-doubtful")
    sure = labelled.join(out, rid, "left").withColumn("label", F.when(F.col("out").isNull(), F.col("label")))
    pages = {r["label"]: r["count"] for r in sure.groupBy("label").count().collect()}
    return _counts(sure, "url-words"), pages


class Bayes:
    """Log odds (block over allow) of the prior and of words by their counts; holds the hot words."""

    def __init__(self, counts: DataFrame, pages: dict[int, int], held_words: int):
        sums = counts.agg(F.sum("n_block"), F.sum("n_allow"), F.count_if(F.col("n_block") + F.col("n_allow") > 0)).first()
        self.size = sums[2] + 1
        self.total = (sums[1] or 0, sums[0] or 0)
        self.prior = math.log((pages.get(1, 0) + 1) / (pages.get(0, 0) + 1))
        hot = counts.orderBy(F.desc("n"), "word").limit(held_words).collect()
        self.words = {r["word"]: self.odds(r["n_block"], r["n_allow"]) for r in hot}

    def odds(self, n_block: int, n_allow: int) -> float:
        """Log odds of a word; a word of unlabelled pages only says nothing."""
        if not n_block + n_allow:
            return 0.0
        one, zero = (math.log((n + 1) / (self.total[v] + self.size)) for v, n in ((1, n_block), (0, n_allow)))
        return one - zero

    def page(self, words: list[str], rare: list[dict] | None) -> float:
        """Log odds of a page, from its words and the counts of those that are not held."""
        more = {r["word"]: self.odds(r["n_block"], r["n_allow"]) for r in rare} if rare is not None else {}
        return self.prior + sum(self.words[w] if w in self.words else more[w] for w in words)


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, seeds: list[str] = SEEDS, held_words: int = MODEL_WORDS) -> DataFrame:
    """``pages`` with host, path, rule, words, block_odds and verdict (the rule's, else the method's)."""
    rid, rare = clashless(pages, "rid", "rare_words")
    worded = with_words(with_rule(with_parts(pages), rules))
    worded = materialize(worded.withColumn(rid, F.monotonically_increasing_id()), "url-pages")
    counts, labelled = word_counts(worded, seeds, rid)
    model = Bayes(counts, labelled, held_words)
    held = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<string>")
    def others(words):
        hot = held.value.words
        return pd.Series([sorted({w for w in row if w not in hot}) for row in words])

    asked = worded.select(rid, F.explode(others("words")).alias("word")).join(counts, "word")
    found = asked.groupBy(rid).agg(F.collect_list(F.struct("word", "n_block", "n_allow")).alias(rare))

    @F.pandas_udf("double")
    def odds(words, rare):
        return pd.Series([held.value.page(*row) for row in zip(words, rare)])

    scored = worded.join(found, rid, "left").withColumn("block_odds", odds("words", rare)).drop(rid, rare)
    method = F.when(F.col("block_odds") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return scored.withColumn("verdict", F.coalesce("rule_verdict", method))
