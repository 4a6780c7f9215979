"""Operator 9: secret scan by grammar inference.

Three base patterns find labelled credentials: assignments, access keys, long hex strings. From a
bounded sample of them a prefix tree is built for each kind, over classes of characters; states whose frequencies are compatible
(Hoeffding bounds on ending and on each next class, down the whole tree) and that the same separators rule
are merged, which leaves a small probabilistic automaton, and the lengths, for each format. Ordinary long tokens give one more automaton. Every candidate is scored by the
likelihood that the formats' automata give it: base spans carry theirs; where a format fits another token
as well as its own sample does and far better than ordinary text does, the token is a further span of kind ``format``. Candidates are the whole runs of ``[A-Za-z0-9+/_=-]``
of at least ``SHORTEST`` characters, the length from which values are learnt, with or without a digit; a
run that a base span touches is reported and scored with that span.

Tasks scan whole texts; long words are found first, so patterns run only where they can match. The
class strings of the values to learn from, with a hash of each value, are written to the shared folder in one pass over the texts (no value is), the spans come
from a second one. Only the bounded sample (``per_kind`` values of at most ``MAX_LENGTH`` characters, those
with the smallest hashes) reaches the driver; candidates are rated whole, however long. Texts are not shuffled.

Edge cases: null and empty texts have no spans; repeated rows each get a row; without any credential
to learn from there are base spans only (none); an empty table gives an empty result; columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castwright.llm.common import utf8
from castwright.session import materialize

KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # a run of the class is taken whole, so 18 or more in all
HEX = re.compile(r"[0-9a-f]{16,}")
#: Shortest labelled value, and so the shortest candidate.
SHORTEST = 12
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
#: Words that are long enough for an ordinary token.
WORD = re.compile(r"(?<!\S)\S{%d,}(?!\S)" % SHORTEST)
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
PER_KIND, MAX_LENGTH = 300, 96
#: Share of a format's own sample that may score lower than a hit, and bits a character that the
#: format must be ahead of ordinary text.
LOWEST, AHEAD = 0.02, 0.5
PLAIN = "plain"


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind) of the base matches, in order."""
    if not text:
        return []
    data = utf8(text)
    found = []
    low = data.lower()
    if any(n in low for n in NAMES):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= SHORTEST]
    if any(len(w) >= 16 for w in data.split()):
        if b"AKIA" in data:
            found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
        found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def candidates(text: str | None, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans of tokens of at least ``SHORTEST`` characters that no base match touches."""
    if not text or not any(len(w) >= SHORTEST for w in utf8(text).split()):
        return []
    return untouched(CANDIDATE, text, taken)


def untouched(pattern: re.Pattern, text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans of a pattern that no base match touches."""
    out, k, reach = [], 0, 0
    for m in pattern.finditer(text):
        while k < len(taken) and taken[k][0] < m.end():
            reach, k = max(reach, taken[k][1]), k + 1
        if reach <= m.start():
            out.append((m.start(), m.end()))
    return out


def symbols(value: str) -> str:
    """A value as classes: digit, hex letter or other letter (by case), every other sign itself."""
    return value.translate(_CLASSES)


_CLASSES = {ord(c): "d" for c in "0123456789"} | {ord(c): "h" for c in "abcdef"} | {ord(c): "l" for c in "ghijklmnopqrstuvwxyz"} | {ord(c): "H" for c in "ABCDEF"} | {ord(c): "L" for c in "GHIJKLMNOPQRSTUVWXYZ"}
ALPHABET = 11
END = ""
#: Bits of a sign where the automaton has no state.
LOST = math.log2(0.05 / (0.05 * (ALPHABET + 1)))


#: Signs that give a format its structure.
SEPARATORS = frozenset("+/_=-.")
#: Values that must have met a state before its separators count against a merge.
ENOUGH = 3


class Automaton:
    """Probabilistic automaton learnt from strings by merging states of their prefix tree.

    Two states merge if their frequencies (of ending and of each next class, down their whole trees) are
    compatible by Hoeffding bounds and (with ``structured``) the same separators rule their next sign, which
    keeps a format's structure; a state joins the settled one that is most like it. Runs of like signs become
    loops, so the lengths of the values are kept beside the states."""

    def __init__(self, words: list[str], alpha: float = 0.05, structured: bool = True):
        self.structured = structured
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, float]] = [defaultdict(float)]
        for word in words:
            at = 0
            for c in word:
                self.count[at][c] += 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.count.append(defaultdict(float))
                at = self.next[at][c]
            self.count[at][END] += 1
        self._merge_all()
        self.bits = [self._bits(seen) for seen in self.count]
        self.lengths, self.longest = set(map(len, words)), max(map(len, words), default=0)
        own = sorted(self.rate(w) for w in words)
        self.lowest = own[int(LOWEST * len(own))] if own else 0.0

    def _visits(self, q: int) -> float:
        return sum(self.count[q].values())

    def _ruled(self, q: int) -> frozenset[str]:
        """Separators that are at least half of what comes next."""
        n = self._visits(q)
        return frozenset(c for c in SEPARATORS if 2 * self.count[q].get(c, 0) >= n)

    def _apart(self, a: int, b: int) -> float | None:
        """How far the frequencies of two states are apart; None if they, or states that they lead to, are
        not compatible."""
        todo, first = [(a, b)], None
        while todo:
            a, b = todo.pop()
            n, m = self._visits(a), self._visits(b)
            if self.structured and min(n, m) >= ENOUGH and self._ruled(a) != self._ruled(b):
                return None
            room = self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            gaps = [abs(self.count[a].get(c, 0) / n - self.count[b].get(c, 0) / m) for c in {*self.count[a], *self.count[b]}]
            if max(gaps) > room:
                return None
            first = sum(gaps) if first is None else first
            todo += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys()]
        return first

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below state b to state a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            for c, n in self.count[b].items():
                self.count[a][c] += n
            for c, to in self.next[b].items():
                if c in self.next[a]:
                    todo.append((self.next[a][c], to))
                else:
                    self.next[a][c] = to

    def _merge_all(self) -> None:
        """Settle states outward from the root, those met most often first: each either joins a settled
        one or is settled."""
        settled = [0]
        while True:
            edge = [(q, c) for q in settled for c in sorted(self.next[q]) if self.next[q][c] not in settled]
            if not edge:
                break
            q, c = max(edge, key=lambda e: self._visits(self.next[e[0]][e[1]]))
            state = self.next[q][c]
            near = [(gap, r) for r in settled if (gap := self._apart(r, state)) is not None]
            if near:
                self.next[q][c] = min(near)[1]
                self._fold(min(near)[1], state)
            else:
                settled.append(state)
        number = {q: k for k, q in enumerate(settled)}
        self.next = [{c: number[t] for c, t in self.next[q].items()} for q in settled]
        self.count = [dict(self.count[q]) for q in settled]

    @staticmethod
    def _bits(seen: dict[str, float]) -> tuple[dict[str, float], float]:
        """Bits of each sign met in a state, and of any other sign."""
        whole = sum(seen.values()) + 0.05 * (ALPHABET + 1)
        return {c: math.log2((n + 0.05) / whole) for c, n in seen.items()}, math.log2(0.05 / whole)

    def known_length(self, word: str) -> bool:
        """Whether values about as long were learnt; what is longer than all of them is a long run of
        the format, if of the format at all."""
        return len(word) > self.longest or any(len(word) + d in self.lengths for d in (-1, 0, 1))

    def fits(self, word: str) -> bool:
        """Whether a string is of the format: as long as learnt values, and no less likely than they are."""
        return self.known_length(word) and self.rate(word) >= self.lowest

    def rate(self, word: str) -> float:
        """Bits a character (minus sign: less likely) that the automaton gives a string of any length."""
        at, bits = 0, 0.0
        for k, c in enumerate(word):
            known, other = self.bits[at]
            bits += known.get(c, other)
            at = self.next[at].get(c)
            if at is None:  # no state: every sign to come, the end included, is as likely as any other
                return (bits + (len(word) - k) * LOST) / (len(word) + 1)
        known, other = self.bits[at]
        return (bits + known.get(END, other)) / (len(word) + 1)


def sample(docs: DataFrame, per_kind: int = PER_KIND) -> dict[str, list[str]]:
    """Labelled values of each kind, and ordinary long tokens, at most ``per_kind`` of each, as classes.

    What is written to the shared folder is the class string of a value and a hash that tells values apart,
    never the value itself."""
    def run(parts):
        for part in parts:
            kinds, values = [], []
            for text in part.column(0).to_pylist():
                taken = base_spans(text)
                for start, end, kind in taken:
                    kinds.append(KINDS[kind])
                    values.append(value_of(text, start, end, kind))
                for start, end in untouched(WORD, text or "", taken) if text and any(len(w) >= SHORTEST for w in utf8(text).split()) else ():
                    word = text[start:end]
                    if word.isascii() and not any(c.isdigit() for c in word):
                        kinds.append(PLAIN)
                        values.append(word)
                for start, end in candidates(text, taken):
                    if re.fullmatch(r"[a-z]+[0-9]+|[A-Za-z/-]+[0-9/-]*", text[start:end]) and any(c.isdigit() for c in text[start:end]):
                        kinds.append(PLAIN)
                        values.append(text[start:end])
            kept = [(k, symbols(v), xxhash.xxh3_64_intdigest(v.encode(), 9) >> 1) for k, v in zip(kinds, values) if len(v) <= MAX_LENGTH]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in kept], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["kind", "classes", "hash"])

    made = materialize(docs.select("text").mapInArrow(run, "kind string, classes string, hash long").distinct(), "credential-classes")
    out = {}
    for kind in (*KINDS[:3], PLAIN):
        out[kind] = [r["classes"] for r in made.where(F.col("kind") == kind).orderBy("hash", "classes").limit(per_kind).collect()]
    return out


def value_of(text: str, start: int, end: int, kind: int) -> str:
    """The credential in a base span: an assignment's value, else the whole span."""
    found = ASSIGN.match(text, start, end) if kind == 0 else None
    return found[2] if found else text[start:end]


class Formats:
    """Automata of the credential formats and of ordinary text."""

    def __init__(self, values: dict[str, list[str]]):
        self.formats = {k: Automaton(v) for k, v in values.items() if k != PLAIN and len(v) >= 5}
        self.plain = Automaton(values.get(PLAIN, []), structured=False)

    def ahead(self, value: str) -> float | None:
        """Bits a character that the best format is ahead of ordinary text; None without a format."""
        word = symbols(value)
        plain = self.plain.rate(word)
        return max((a.rate(word) - plain for a in self.formats.values()), default=None)

    def likelihood(self, value: str) -> tuple[str | None, float]:
        """The format that fits best, and how far it is ahead of ordinary text; None: no format."""
        word = symbols(value)
        plain, best = self.plain.rate(word), (None, 0.0)
        for kind, automaton in self.formats.items():
            rate = automaton.rate(word)
            if automaton.fits(word) and rate - plain >= AHEAD and rate - plain > best[1]:
                best = kind, rate - plain
        return best


def scan(docs: DataFrame, per_kind: int = PER_KIND) -> DataFrame:
    """doc_id and spans: array of (kind, start, end, base, likelihood), ends exclusive, in order."""
    held = docs.sparkSession.sparkContext.broadcast(Formats(sample(docs, per_kind)))
    ids = dict(docs.dtypes)["doc_id"]
    kind_of = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("likelihood", pa.float64())]))

    def run(parts):
        own = held.value
        for part in parts:
            rows = []
            for text in part.column(1).to_pylist():
                taken = base_spans(text)
                spans = [(s, k, {"kind": KINDS[k], "start": s, "end": e, "base": True, "likelihood": own.ahead(value_of(text, s, e, k))}) for s, e, k in taken]
                for s, e in candidates(text, taken):
                    kind, ahead = own.likelihood(text[s:e])
                    if kind:
                        spans.append((s, 3, {"kind": KINDS[3], "start": s, "end": e, "base": False, "likelihood": ahead}))
                rows.append([x for _, _, x in sorted(spans, key=lambda x: x[:2])])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, kind_of)], names=["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {ids}, spans array<struct<kind: string, start: int, end: int, base: boolean, likelihood: double>>")

