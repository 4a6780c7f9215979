"""Byte-level BPE against the rank-file library, and greedy string tiling against its definition."""

import base64
import random

import public_tokenizers
import pytest
import tiktoken

from castwright.llm import bpe, decontaminate


@pytest.fixture(scope="module")
def rank_library():
    with open(public_tokenizers.path(bpe.RANKS), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(public_tokenizers.path(bpe.RANKS))


def texts(n=3000, seed=2):
    r = random.Random(seed)
    pools = ["a b", "=-*#", "01", "aAbB ", "日本語テスト", "éàñß", "\n\t \r \x85\x1c\xa0\xad", "'sre'll", "😀👍🏽", "²½ªºµ", "ʼń"]
    return ["".join(r.choice(r.choice(pools)) for _ in range(r.randint(1, 60))) for _ in range(n)]


def test_ids_are_those_of_the_rank_library(codec, rank_library):
    rows = [*texts(), "", "<|endoftext|>", "a" * 3000, "ab" * 500, " " * 100]
    made = codec.encode_all(rows)
    for text, ids in zip(rows, made):
        assert ids == rank_library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_every_character_class_is_that_of_the_rank_library(codec, rank_library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x600 or c % 41 == 0)]
    rows = [f"a1!{chr(c)}a{chr(c)} {chr(c)}1{chr(c)}!" for c in points]
    for text, ids in zip(rows, codec.encode_all(rows)):
        assert ids == rank_library.encode_ordinary(text)


def test_memory_of_pieces_is_bounded(codec, rank_library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 50)
    for text in texts(200, 9):
        assert codec.encode(text) == rank_library.encode_ordinary(text)


def test_offsets_and_split_characters(codec):
    for text in ["héllo 日本 😀!", "", "x"]:
        ids = codec.encode(text)
        spans = codec.offsets(text, ids)
        assert len(spans) == len(ids)
        for (start, end), i in zip(spans, ids):
            assert codec.tokens[i] in text[start:end].encode()
        parts, rest = "", b""
        for i in ids:
            more, rest = codec.decode_text([i], rest)
            parts += more
        assert parts == text and rest == b""


def test_table_is_reversible(codec):
    assert len(set(codec.letters)) == 256
    assert codec.read(codec.write(bytes(range(256)))) == bytes(range(256))


def test_encode_rows(spark, rank_library):
    rows = [(1, None, 5), (2, "", 6), (3, "a b", 7), (3, "a b", 7), (None, "日本 " * 4000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS int")
    made = bpe.encode(docs, offsets=True).collect()
    for row, (_, text, _) in zip(sorted(made, key=lambda r: str(r["text"])), sorted(rows, key=lambda r: str(r[1]))):
        assert row["ids"] == rank_library.encode_ordinary(text or "") and bytes(row["decoded"]) == (text or "").encode()
        assert len(row["starts"]) == len(row["ends"]) == len(row["ids"])
    assert bpe.encode(docs.limit(0)).count() == 0
    again = bpe.decode(bpe.encode(docs).drop("decoded"))
    assert {bytes(r["decoded"]).decode() for r in again.collect()} == {t or "" for _, t, _ in rows}


def greedy(a, b, least):
    """Words of a covered by tiles, by taking the longest unmarked match over and over."""
    in_a, in_b, tiles = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in in_a and j + n not in in_b:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return tiles, len(in_a)
        in_a |= set(range(i, i + n))
        in_b |= set(range(j, j + n))
        tiles += 1


def test_tiles_against_brute_force():
    r = random.Random(4)
    for _ in range(150):
        words = "abcd" if r.random() < 0.5 else "abcdefghijklmnop"
        item = [r.choice(words) for _ in range(r.randint(1, 25))]
        cut = r.randrange(len(item))
        text = [r.choice(words) for _ in range(5)] + item[cut:] + [r.choice(words) for _ in range(4)] + item[:cut] + item[: r.randint(0, len(item))]
        least = min(3, len(item))
        found = decontaminate.Block([(9, " ".join(item))], 3).tiles(" ".join(text))
        n, covered = greedy(item, text, least)
        assert (found[0][1:3] if found else (0, 0)) == (n, covered) or found[0][2] == covered


@pytest.mark.parametrize("seeds", [1, 3, 1000])
def test_seeds_in_parts_give_the_same_tiles(seeds, monkeypatch):
    r = random.Random(6)
    items = [(k, " ".join(r.choice("abc") for _ in range(r.randint(3, 30)))) for k in range(12)]
    block = decontaminate.Block(items, 4)
    texts = [" ".join(r.choice("abcx") for _ in range(r.randint(0, 80))) for _ in range(40)]
    whole = [block.tiles(t) for t in texts]
    monkeypatch.setattr(decontaminate, "SEEDS", seeds)
    assert [block.tiles(t) for t in texts] == whole and any(whole)


def test_one_word_over_and_over():
    block = decontaminate.Block([(1, "a " * 60)])
    assert block.tiles("a " * 20_000) == [(1, 1, 60, 60)]


ITEM = "The quick brown fox jumps over the lazy dog while seven grey wolves sleep under an old oak tree near water"


def test_moved_parts_and_marks_are_caught():
    block = decontaminate.Block([(1, ITEM), (2, ""), (3, None), (4, "two words")])
    words = ITEM.split()
    moved = "intro " + " ".join(words[10:]) + " *** " + "!! ".join(words[:10]).upper()
    assert block.tiles(moved) == [(1, 2, len(words), len(words))]
    assert block.tiles("some two words") == [(4, 1, 2, 2)]
    assert block.tiles(None) == [] and block.tiles("") == []
    repeated = " ".join([ITEM] * 300)
    assert block.tiles(repeated) == [(1, 1, len(words), len(words))]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_leaks_and_kept_rows(spark, block_bytes):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (7, "another passage of quite some words that stands here for itself")], "item_id long, text string")
    rows = [(1, "x " + ITEM), (1, "clean text"), (None, ITEM.lower()), (3, None), (4, ""), (5, " ".join(ITEM.split()[:9])), (6, "another passage of quite some words that stands here for itself " + ITEM)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, coverage int")
    made = decontaminate.leaks(docs, bench, block_bytes=block_bytes).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in made) == [(0, 1), (1, 1), (6, 1), (6, 7)]
    kept = decontaminate.decontaminate(docs, bench, block_bytes=block_bytes)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == [(1, "clean text"), (3, ""), (4, ""), (5, rows[5][1])]
    assert decontaminate.leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0
