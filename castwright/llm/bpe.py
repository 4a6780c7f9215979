"""Operator 10: byte-level BPE encoding and decoding with the ``tokenizers`` library.

A rank file gives the vocabulary; its merges are derived from the ranks (every way to cut a token
into two tokens, in rank order), and the ``tokenizers`` BPE model runs over pieces written in the
byte-to-character alphabet. Each Arrow batch of whole texts is cut by the pattern, each distinct
piece is encoded once per task (a bounded memory of pieces), and the ids are put together with the
offsets of their characters. Decoding reverses the byte table; ``decode_text`` joins characters
that are split over tokens before it turns bytes into text.

Rows never meet, so there is no shuffle and no key to be hot. Edge cases: null and empty texts give
no ids and empty bytes; repeated rows are encoded alike; an empty table gives an empty result;
columns of the input with the names of the new ones give way.
"""

from __future__ import annotations

import base64
import functools
import re
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from castwright.llm.common import add_arrow_columns

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Distinct pieces that a task remembers; it forgets them all when full.
PIECES = 300_000
#: Letters, numbers and white space below U+0250, for the pattern of texts that stay below it.
LOW = {"L": "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "N": "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "S": "\\t-\\r \u0085\u00a0"}


def byte_letters() -> list[str]:
    """The character that stands for each byte: itself where it prints, else from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.letters = byte_letters()
        self.bytes_of = {c: b for b, c in enumerate(self.letters)}
        written = [self.write(t) for t in self.tokens]
        merges = []
        for token, name in zip(self.tokens, written):
            cuts = [(ranks[token[:i]], ranks[token[i:]], i) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
            merges += [(name[:i], name[i:]) for _, _, i in sorted(cuts)]
        vocab = {name: rank for rank, name in enumerate(written)}
        self.model = Tokenizer(models.BPE(vocab=vocab, merges=merges))
        self.model.pre_tokenizer = pre_tokenizers.Split("\n", "removed")  # no byte is written as \n
        self.any_pieces = pre_tokenizers.Split(Regex(pattern), "isolated").pre_tokenize_str
        low = self._with_classes(pattern, f"[{LOW['L']}]", f"[{LOW['N']}]", f"[^{LOW['S']}{LOW['L']}{LOW['N']}]")
        self.low_pieces = re.compile(low.replace(r"\S", f"[^{LOW['S']}]").replace(r"\s", f"[{LOW['S']}]")).findall
        self.high = re.compile("[\u0250-\U0010ffff]").search
        self.known: dict[str, tuple[int, ...]] = {}

    def write(self, data: bytes) -> str:
        """Bytes in the byte-to-character alphabet."""
        return "".join([self.letters[b] for b in data])

    def read(self, letters: str) -> bytes:
        """The reverse of ``write``."""
        return bytes([self.bytes_of[c] for c in letters])

    @staticmethod
    def _with_classes(pattern: str, letter: str, number: str, other: str) -> str:
        """The pattern with its three character classes written as given."""
        return pattern.replace(r"[^\s\p{L}\p{N}]", other).replace(r"\p{L}", letter).replace(r"\p{N}", number)

    def pieces_of(self, text: str) -> list[str]:
        """Matches of the pattern: by the library, or by ``re`` (faster) for texts below U+0250."""
        return [p for p, _ in self.any_pieces(text)] if self.high(text) else self.low_pieces(text)

    def _learn(self, pieces: set[str]) -> None:
        """Encode the pieces that are not known yet, many in one call (one word each)."""
        fresh = [p for p in pieces if p not in self.known]
        if len(self.known) + len(fresh) > PIECES:
            self.known.clear()
            fresh = list(pieces)
        groups = [fresh[at : at + 1000] for at in range(0, len(fresh), 1000)]
        lines = ["\n".join([self.write(p.encode("utf-8", "surrogatepass")) for p in g]) for g in groups]
        for group, made in zip(groups, self.model.encode_batch(lines, add_special_tokens=False)):
            ends = np.cumsum(np.bincount(np.array(made.word_ids, np.int64), minlength=len(group))).tolist()
            ids, at = made.ids, 0
            for piece, end in zip(group, ends):
                self.known[piece] = tuple(ids[at:end])
                at = end

    def encode_all(self, texts: list[str | None]) -> list[list[int]]:
        """Token ids of whole texts."""
        cut = [self.pieces_of(t) if t else [] for t in texts]
        self._learn({p for pieces in cut for p in pieces})
        known = self.known.__getitem__
        return [list(chain.from_iterable(map(known, pieces))) for pieces in cut]

    def encode(self, text: str | None) -> list[int]:
        """Token ids of one whole text."""
        return self.encode_all([text])[0]

    def offsets(self, text: str | None, ids: list[int]) -> np.ndarray:
        """(start, end) in code points of each token; both parts of a split character cover it."""
        data = (text or "").encode("utf-8", "surrogatepass")
        begins = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
        upto = np.concatenate(([0], np.cumsum(begins)))
        ends = np.cumsum([len(self.tokens[i]) for i in ids], dtype=np.int64)
        starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
        inside = np.concatenate((begins, [True]))
        return np.stack([upto[starts] - ~inside[starts], upto[ends]], axis=1) if len(ids) else np.zeros((0, 2), np.int64)

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of a list of ids, through the characters of the vocabulary and the reversed table."""
        return b"".join(map(self._token_bytes.__getitem__, ids))

    @functools.cached_property
    def _token_bytes(self) -> list[bytes]:
        return [self.read(self.model.id_to_token(i) or "") for i in range(len(self.tokens))]

    def decode_text(self, ids: list[int], before: bytes = b"") -> tuple[str, bytes]:
        """Text of the ids and the bytes of a last character that is not complete yet; ``before``
        are such bytes of the ids that came earlier. Bytes that are no UTF-8 become U+FFFD."""
        data = before + self.decode(ids)
        for back in range(1, min(4, len(data) + 1)):
            lead = data[-back]
            if lead & 0xC0 != 0x80:
                need = 4 if lead >= 0xF0 else 3 if lead >= 0xE0 else 2 if lead >= 0xC0 else 1
                if need > back:
                    return data[:-back].decode("utf-8", "replace"), data[-back:]
                break
        return data.decode("utf-8", "replace"), b""


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process."""
    return Codec(path)


def encode(df: DataFrame, text: str = "text", path: str | None = None, offsets: bool = False) -> DataFrame:
    """``df`` with ids (array of int) and decoded (their bytes); on request starts and ends too."""
    file = path or public_tokenizers.path(RANKS)

    def run(texts):
        own = codec(file)
        ids = own.encode_all(texts)
        made = [pa.array(ids, pa.list_(pa.int32())), pa.array([own.decode(x) for x in ids], pa.binary())]
        if offsets:
            spans = [own.offsets(t, x) for t, x in zip(texts, ids)]
            made += [pa.array([s[:, k] for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
        return made

    more = ", starts array<int>, ends array<int>" if offsets else ""
    return add_arrow_columns(df, text, f"ids array<int>, decoded binary{more}", run)


def decode(df: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """``df`` with decoded: the bytes of an array of ids (null: none)."""
    file = path or public_tokenizers.path(RANKS)
    return add_arrow_columns(df, ids, "decoded binary", lambda rows: [pa.array([codec(file).decode(x or []) for x in rows], pa.binary())])
