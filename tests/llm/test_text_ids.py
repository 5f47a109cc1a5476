"""Encoding and packing against the tokenizers library, and their edge cases."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wardlight.llm import bpe, packing

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Plain words, and more of them.",
    "",
    None,
    "it's  WE'LL\n\n  x  ",
    "naïve café ß Œuvre 北京 😀 ՘a \x85\xa0 ２",
    "a<|endoftext|>b <|endoftext|> <|endoftex",
    "x" * 3000 + "-" * 700 + "ab" * 500,
]


@pytest.fixture(scope="module")
def vocab():
    with open(BYTES, encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=80))
def test_ids_are_those_of_the_library(vocab, library, text):
    ids = vocab.encode(text)
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert vocab.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_the_split_pattern_is_the_vocabulary_s():
    assert bpe.PATTERN == public_tokenizers.PATTERN


def test_long_words_merge_as_short_ones(vocab):
    rnd = random.Random(3)
    for _ in range(50):
        word = bytes(rnd.choice(b"abcdeth ") for _ in range(bpe.SHORT))
        assert vocab.merge(word) == vocab._merge_long([vocab.byte_id[b] for b in word])


def test_the_cache_stays_bounded_and_right():
    made = []
    cache = bpe.WordCache(lambda words: [made.append(w) or w.upper() for w in words], 4)
    for words in (["a", "b", "c"], ["c", "d", "e"], ["a", "f"], ["g", "h", "i", "j", "k", "l"]):
        assert cache.values(words) == [w.upper() for w in words]
        assert len(cache.young) <= max(4, len(set(words)))


def test_documents_round_trip(spark, library):
    rows = [(i, t, 7, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", 1, "y"), (0, TEXTS[0], 2, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int, ids string")
    out = bpe.encode_documents(df, BYTES, with_ids=True, with_text=True).collect()
    assert len(out) == len(rows)
    by_text = {r["decoded"]: r for r in out}
    for _, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        r = by_text[text or ""]
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    back = bpe.decode_ids(spark.createDataFrame([(1, by_text[TEXTS[0]]["ids"]), (2, None)], "doc_id bigint, ids array<int>"), BYTES)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {1: TEXTS[0], 2: ""}
    assert bpe.encode_documents(df.limit(0), BYTES).collect() == []


def test_plain_texts_have_the_library_s_ids():
    with open(WORDS, encoding="utf-8") as f:
        mine = packing.TextIds(f.read())
    theirs = Tokenizer.from_file(WORDS)
    rnd = random.Random(1)
    letters = [chr(c) for c in [*range(0x20, 0x7F), *range(0xA1, 0x100)]] + list(" \n\t '") * 8
    texts = ["".join(rnd.choices(letters, k=rnd.randrange(200))) for _ in range(500)] + [t or "" for t in TEXTS]
    for text in texts:
        assert mine.encode(text) == np.array(theirs.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=60, deadline=None)
@given(lengths=st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_finds_the_tightest_bin(lengths):
    bins, offsets = packing.best_fit_decreasing(np.array(lengths, np.int64), 20)
    room, expected = [], []
    for at in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fitting = [(r, b) for b, r in enumerate(room) if r >= lengths[at]]
        tight = min(fitting)[0] if fitting else None
        if tight is None:
            room.append(20 - lengths[at])
        else:
            room[room.index(tight)] -= lengths[at]
        expected.append(sorted(room))
    used = np.bincount(bins, weights=lengths, minlength=len(room)) if lengths else np.zeros(0)
    assert sorted(20 - used) == (expected[-1] if expected else [])
    for b in set(bins.tolist()):
        inside = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == b))
        assert [o for o, _ in inside] == np.cumsum([0, *[n for _, n in inside]])[:-1].tolist()


def test_packed_documents(spark):
    theirs = Tokenizer.from_file(WORDS)
    rows = [(i, t, 9, 1) for i, t in enumerate([*TEXTS, "long words here " * 9000])] + [(None, "no id", 1, 1), (1, "again", 1, 1), (1, "again", 1, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, length int, offset int")
    out = packing.pack_documents(df, WORDS).collect()
    expected = []
    for doc_id, text, *_ in rows:
        ids = [*theirs.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[start : start + 4096], "<u4")
            expected.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    found = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out]
    assert sorted(found, key=str) == sorted(expected, key=str)
    places = {}
    for r in out:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        held.sort()
        assert [o for o, _ in held] == np.cumsum([0, *[n for _, n in held]])[:-1].tolist()
        assert sum(n for _, n in held) <= 4096
    total = sum(r["length"] for r in out)
    assert len(places) <= total // 4096 + 2
    assert packing.pack_documents(df.limit(0), WORDS).collect() == []


def test_groups_of_pieces_follow_their_number(spark):
    pieces = spark.range(500).selectExpr("id as doc_id", "0 as piece", "id % 37 + 1 as length")
    out = packing.pack_pieces(pieces, capacity=40, per_group=100).collect()
    assert len(out) == 500 and len({r["sequence_id"] >> 32 for r in out}) == 5
    assert len({r["sequence_id"] for r in out}) <= 1.15 * sum(r["length"] for r in out) / 40
